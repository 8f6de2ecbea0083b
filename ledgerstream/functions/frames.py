"""Wire frame of a message value: a marker byte, a 4-byte schema id, then the payload."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Fixed values of the frame format.
MARKER = b"\x00"
ID_BYTES = 4
HEADER_BYTES = len(MARKER) + ID_BYTES

_TO_END = 2**31 - 1


def header(schema_id: int) -> bytes:
    return MARKER + schema_id.to_bytes(ID_BYTES, "big")


def frame(schema_id: int, payload: Column) -> Column:
    """Frame a payload; a null payload gives a null message."""
    return F.concat(F.lit(header(schema_id)), payload)


def is_framed(value: str | Column) -> Column:
    """Whether the header is complete and starts with the marker."""
    return (F.octet_length(value) >= HEADER_BYTES) & (F.substring(value, 1, len(MARKER)) == F.lit(MARKER))


def written_by(value: str | Column, schema_ids: Iterable[int]) -> Column:
    """Whether the message has one of these schema ids; compares the header's bytes as they are."""
    return F.substring(value, 1, HEADER_BYTES).isin(*(F.lit(header(i)) for i in schema_ids))


def schema_id(value: str | Column) -> Column:
    return F.conv(F.hex(F.substring(value, len(MARKER) + 1, ID_BYTES)), 16, 10).cast("long")


def payload(value: str | Column) -> Column:
    return F.substring(value, HEADER_BYTES + 1, _TO_END)
