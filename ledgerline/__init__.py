"""Spark-native daily transaction enrichment and analytics.

Everything here is plain DataFrame / SQL / Structured Streaming code:
functions take and return DataFrames, Catalyst chooses join strategies,
pruning and code generation.  See README.md for the module map.
"""

from ledgerline.session import configure, build_session, scratch_path

__all__ = ["configure", "build_session", "scratch_path"]
