"""Shopflow: online-shop behaviour analytics written as Spark DataFrame jobs.

Layout
  sources/    table readers, fixture views over the driver tables, ad-log parsing
  functions/  column expressions shared by the jobs (buckets, rounding, lists)
  operators/  the jobs themselves, each ``f(df, ..., **params) -> DataFrame``
  plans/      the query catalogue (Spark) and its DuckDB oracle SQL
  streaming/  Structured Streaming forms of the ad statistics
"""

from shopflow.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
