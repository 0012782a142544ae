from __future__ import annotations

import pytest

import __spark_entry__ as entry
from vaultframe.adapters import Tables
from vaultframe.checks import registry
from vaultframe.operators import versions
from vaultframe.operators.versions import newest

SF = "/root/testdata/sf0.001"
SURVEY_KEYS = """
scan_parquet scan_csv_plain scan_csv_inferred scan_vault_table sink_overwrite sink_rebuild sink_replace_run typed_table
sink_truncate compact_rows file_manifest as_of_inclusive as_of_strict effective_on open_only scan_window incremental_window
retain_days code_filter not_blank like_filter event_code_semi null_if_blank decode_map fold_category default_end recency_flag
floor_date stamp_columns feed_layout point_lookup current_version current_per_slice current_per_subkey live_after live_before
live_all_versions filter_before_rank filter_after_rank current_by_version_no current_with_ties current_per_day validity_periods
dedup_chain eav_pivot top2_values sat_link_hub same_as_roles vault_chain left_join anti_join not_exists_mapped case_key_join
overlap_inner overlap_left tree_parent_clone default_branch asset_key_match ref_filter_join boundaries slices clean_slices
closed_end time_slice dedup_slices rank_slices array_timeline leading_gap span_collapse interval_keys group_count group_avg
global_agg group_min_max distinct_rows group_distinct dup_keys win_row_number win_rank win_lead win_lag win_running_min_max
global_sort top_n union_distinct union_all union_three fn_dates fn_timestamps fn_strings fn_arrays fn_casts fn_nulls hash_key
hash_diff wkt_point lcc_inverse count_tables count_live freshness compare_variants audit_hash domain_audit length_audit
null_audit p_comms_fault p_active_meter p_comms_card p_device_interval p_read_type p_customer_slices p_site_register
p_life_support p_meter_timeline p_site_address p_suffix p_suffix_running p_meter_channels p_interval_reads
p_interval_reads_hourly p_service_point_device p_site_geometry p_lights p_device_events p_alarm_history p_alarm_updates
p_components p_feed_status p_asset_key_match p_site_substation
""".split()


def test_every_surveyed_operator_is_registered_with_sql():
    assert not set(SURVEY_KEYS) - set(entry.queries())
    assert set(registry.QUERIES) == set(registry.ORACLES)


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_current_version_limits_groups_before_the_shuffle(spark):
    t = Tables(spark, SF)
    text = plan(versions.live(t.sat, ["user_id"], newest("extract_ts", "event_id")))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


@pytest.mark.parametrize("key,column", [("as_of_inclusive", "l_shipdate"), ("scan_window", "ts"), ("retain_days", "o_orderdate")])
def test_day_filters_reach_the_scan(spark, key, column):
    text = plan(entry.queries()[key](spark, SF))
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert any(column in line for line in pushed)


@pytest.mark.parametrize(
    "key",
    ["p_suffix", "p_components", "p_asset_key_match", "p_lights", "overlap_left", "not_exists_mapped", "p_site_address", "p_device_events"],
)
def test_no_cross_join_and_no_python(spark, key):
    text = plan(entry.queries()[key](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert word not in text
