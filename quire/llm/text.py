"""Column helpers shared by the operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space of the contracts: ``[\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; the plain ``lower`` does for texts of one byte a character."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def carried(df, kept: list[str] | None = None, **own: Column):
    """``row`` (the columns ``kept`` of ``df``, all by default) beside the columns in ``own``."""
    return df.select(F.struct(*[df[c] for c in (df.columns if kept is None else kept)]).alias("row"), *[c.alias(k) for k, c in own.items()])


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a column's texts one behind another (null: as empty), and where each ends."""
    texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset :][: len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at[1:] - at[0]
