"""Compressed JSON blobs: zstandard at level 9, and the SHA-256 of the compressed bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LEVEL = 9


def _pack(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    for part in texts:
        yield part.map(lambda x: None if x is None else squeeze.compress(x.encode()))


def _unpack(blobs: Iterator[pd.Series]) -> Iterator[pd.Series]:
    import zstandard

    expand = zstandard.ZstdDecompressor()
    for part in blobs:
        yield part.map(lambda x: None if x is None else expand.decompressobj().decompress(bytes(x)).decode())


def compressed(text: Column) -> Column:
    return F.pandas_udf(_pack, "binary")(text)


def decompressed(blob: Column) -> Column:
    return F.pandas_udf(_unpack, "string")(blob)


def digest(blob: Column) -> Column:
    return F.sha2(blob, 256)
