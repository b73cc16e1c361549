"""Sinks (SNK-*): landing documents, the keyed insert-if-absent flat table,
JDBC append, JSON documents (metadata, reports) and previews."""

from obslake.sinks.lake import land_documents  # noqa: F401
from obslake.sinks.table import (  # noqa: F401
    append_jdbc,
    insert_if_absent,
    preview,
    read_table_or_none,
    write_documents,
)
