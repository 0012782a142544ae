"""Site to substation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from vaultframe.functions.columns import lookup
from vaultframe.operators.joins import sat_link_hub


def site_substation(sat: DataFrame, link: DataFrame, hub_site: DataFrame, only_sites: Iterable[object] | DataFrame | None = None) -> DataFrame:
    """Satellite rows of the site-substation link with the site id, for all or some sites."""
    hub = hub_site if only_sites is None else lookup(hub_site, "site_id", only_sites)
    return sat_link_hub(sat, link, "link_key", [(hub, "site_key", "site_key", {"site_id": "site_id"})])
