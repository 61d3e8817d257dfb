"""Sources and sinks: session schema, sharded scans, sinks, parameterised SQL, fixtures."""

from cohortex.sources.schema import SESSION_SCHEMA
from cohortex.sources.sessions import load_table, read_sessions, scan_suffix_range, scan_window

__all__ = ["SESSION_SCHEMA", "load_table", "read_sessions", "scan_suffix_range", "scan_window"]
