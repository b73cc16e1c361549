"""Column expressions (SCL-*).  All are built-in Spark functions, so they stay
inside whole-stage codegen; nothing here runs Python per row."""

from obslake.functions.expr import (  # noqa: F401
    batch_key,
    day_key,
    day_of_batch,
    document_key,
    hash_bucket,
    json_text,
    map_text,
    pct_text,
    sorted_map,
    source_from_path,
)
