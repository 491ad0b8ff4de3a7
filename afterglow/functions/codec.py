"""Curves as bytes. Fixed format: zlib over unsigned 32-bit numbers, least byte first."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

WORDS = np.dtype("<u4")
MOST = np.iinfo(WORDS).max


@F.pandas_udf(BinaryType())
def encode_curve(values: pd.Series) -> pd.Series:
    """An array of counts as bytes; null stays null. Counts below 0 or over 32 bits are refused."""
    out = []
    for counts in values:
        if counts is None:
            out.append(None)
            continue
        wide = np.asarray(counts, np.int64)
        if len(wide) and (wide.min() < 0 or wide.max() > MOST):
            raise ValueError(f"a count is outside 0..{MOST}")
        out.append(zlib.compress(wide.astype(WORDS).tobytes(), zlib.Z_BEST_COMPRESSION))
    return pd.Series(out, dtype=object)


@F.pandas_udf(ArrayType(LongType()))
def decode_curve(data: pd.Series) -> pd.Series:
    """The array behind the bytes of `encode_curve`; null stays null."""
    return pd.Series([None if b is None else np.frombuffer(zlib.decompress(b), WORDS).astype(np.int64) for b in data], dtype=object)
