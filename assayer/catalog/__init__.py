"""Operators bound to tables. Importing the package fills the registry."""
from assayer.catalog import judgement_queries, ledger_queries, race_queries, series_queries, source_queries, stat_queries, stream_queries, text_queries, vote_queries  # noqa: F401
from assayer.catalog.base import REGISTRY, Tables

__all__ = ["REGISTRY", "Tables"]
