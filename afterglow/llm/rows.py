"""Reading Arrow columns in Python workers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """Texts as UTF-8 bytes one at a time; nulls are empty."""
    for value in column.cast(pa.binary()) if pa.types.is_string(column.type) else column.cast(pa.large_binary()):
        yield value.as_py() or b""


def texts_of(column: pa.Array) -> Iterator[str]:
    """Texts one at a time; nulls are empty. Bytes that are no UTF-8 become U+FFFD."""
    for value in raw_texts(column):
        yield value.decode("utf-8", "replace")
