"""cohortex: propensity audiences from web-analytics sessions, as Spark jobs.

Layout:
  sources/    session schema, date-sharded scans, sinks, parameterised SQL,
              adapters that derive nested sessions from the benchmark tables
  functions/  column expressions (scalar functions, event rules, hashing)
  operators/  DataFrame operators: sessions, aggregates, joins, sampling,
              learning, registry, export
  plans/      composite jobs: feature tables (literal and fused), full run
  streaming/  (intentionally empty: the workload is batch only)
  catalog/    the registered queries on the benchmark tables and their DuckDB oracle SQL
"""

from cohortex.config import AudienceConfig, Windows, window_bounds

__all__ = ["AudienceConfig", "Windows", "window_bounds"]
