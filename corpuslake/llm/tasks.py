"""Helpers of the functions that run in Python tasks."""

from __future__ import annotations

import pyarrow as pa


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes, NULL as empty. Bytes split at ASCII white space only and lower-case A-Z only."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return [b or b"" for b in texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    return text.lower().split()
