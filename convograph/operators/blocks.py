"""Small tables that meet every row of a large one, in parts whose size is known before they are broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that are broadcast at once.
ROWS = 10_000


def in_blocks(few: DataFrame, size: int = ROWS) -> list[DataFrame]:
    """A table in parts of about ``size`` rows, by the hash of its columns."""
    n = max(1, -(-few.count() // size))
    return [few] if n == 1 else [few.where(F.pmod(F.xxhash64(*few.columns), F.lit(n)) == i) for i in range(n)]


def against(rows: DataFrame, few: DataFrame, on: Column | None = None, size: int = ROWS) -> DataFrame:
    """``rows`` with every row of ``few`` that meets ``on``: a stated set against all rows, one pass over them for each block."""
    parts = [rows.join(F.broadcast(b), on) if on is not None else rows.crossJoin(F.broadcast(b)) for b in in_blocks(few, size)]
    return reduce(DataFrame.unionByName, parts)
