"""Writers (K1-K7, P21): Parquet overwrite, idempotent partition replace, safe rewrites, CSV feeds."""

from tidemark.sinks.writers import (append_blast_history, feed_name, overwrite_from_self, overwrite_table, path_exists,
                                    read_csv, read_documents, replace_partitions, write_audience_lists, write_blast_exports, write_csv,
                                    write_documents, write_feed, write_parquet, write_quality_split, write_registry)
from tidemark.sinks.upload import read_upload, upload_files, write_upload
from tidemark.sinks.versioned import read_versioned

__all__ = ["write_parquet", "replace_partitions", "append_blast_history", "write_csv", "read_csv", "overwrite_from_self",
           "overwrite_table", "path_exists", "write_registry", "write_audience_lists", "write_feed", "write_blast_exports",
           "feed_name", "read_documents", "write_documents", "read_versioned", "write_quality_split", "write_upload", "read_upload", "upload_files"]
