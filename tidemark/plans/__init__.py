from .layout import (Part, bucket, bucket_of, days, derived_predicate, hours, months,
                     pruned_read, read_layout, truncate, union_layouts, with_layout,
                     write_layout, years)
from .catalog import (AGG_1M_SCHEMA, RAW_TRADES_SCHEMA, SAMPLE_TRADES_SCHEMA, create_table_if_missing,
                      ensure_database, insert)
from .versioned import COMMIT_SCHEMA, VersionedTable

__all__ = ["Part", "bucket", "bucket_of", "days", "derived_predicate", "hours", "months",
           "pruned_read", "read_layout", "truncate", "union_layouts", "with_layout",
           "write_layout", "years", "COMMIT_SCHEMA", "VersionedTable", "AGG_1M_SCHEMA",
           "RAW_TRADES_SCHEMA", "SAMPLE_TRADES_SCHEMA", "create_table_if_missing", "ensure_database", "insert"]
