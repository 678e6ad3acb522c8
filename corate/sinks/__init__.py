"""Writers for tables, similarity text, packed rows, recommendations and CSV exports."""

from corate.sinks.tables import (
    create_bucket_table,
    read_bucket_table,
    upsert_bucket_table,
    write_clustered,
    write_observed,
)
from corate.sinks.writers import (
    export_items,
    key_ordered,
    packed_lines,
    pair_key,
    run_path,
    similarity_lines,
    write_bucketed,
    write_packed,
    write_packed_lines,
    write_recommendations,
    write_similarity,
    write_table,
)

__all__ = ["create_bucket_table", "export_items", "key_ordered", "packed_lines", "pair_key", "read_bucket_table", "run_path",
           "similarity_lines", "upsert_bucket_table", "write_bucketed", "write_clustered", "write_observed", "write_packed",
           "write_packed_lines", "write_recommendations", "write_similarity", "write_table"]
