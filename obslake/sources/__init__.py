"""Sources (SRC-*): the JSON document lake, raw payload decoding, and driver
tables read with column pruning."""

from obslake.sources.lake import (  # noqa: F401
    decode_payload,
    scan_batch,
    scan_lake,
    with_reject_reason,
)
from obslake.sources.tables import read_table  # noqa: F401
