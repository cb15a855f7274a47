"""tidemark: event-time trade streams and versioned tables on Spark.

Subpackages: ``functions`` (column helpers), ``sources`` (tables, trade
messages, connectors), ``operators`` (bars, windows, sessions, upsert,
checks), ``plans`` (versioned tables, partition layouts, catalog) and
``streaming`` (Structured Streaming jobs).  ``registry`` holds every
registered query with its DuckDB oracle SQL.
"""

from .session import get_session, scratch_path, shared_dir

__all__ = ["get_session", "scratch_path", "shared_dir"]
__version__ = "0.1.0"
