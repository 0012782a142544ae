"""Spark operators and data products for history-keeping (Data Vault) tables."""

__version__ = "0.1.0"
