"""A filter of fixed size that lets through the rows whose key may be in a table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the filter: 2 MB, whatever the number of keys; with very many keys more rows pass.
BITS = 24


def _places(key: str) -> list[tuple[str, str]]:
    """(word, bit) of the two places of a key, as SQL."""
    places = [f"pmod(xxhash64({seed}, `{key}`), {1 << BITS})" for seed in (31, 32)]
    return [(f"CAST(shiftright({p}, 6) AS INT)", f"CAST({p} & 63 AS INT)") for p in places]


def sieve(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` (long) is not among the ``key`` column of ``keys``; none that is goes missing.

    A join with the rest shuffles about as many rows as match, at every size of ``rows``. The bits are added up by an aggregation;
    at most 2^(``BITS`` - 6) words reach the driver, and every task gets the same ``BITS`` bits.
    """
    marks = F.expr("array(" + ", ".join(f"struct({word} AS word, shiftleft(1L, {bit}) AS mark)" for word, bit in _places(key)) + ")")
    words = (keys.select(F.explode(marks).alias("m")).groupBy("m.word").agg(F.bit_or("m.mark").alias("mark"))).toArrow()
    bits = np.zeros(1 << (BITS - 6), dtype=np.int64)
    bits[words["word"].to_numpy()] = words["mark"].to_numpy()
    name = "_bits"
    while name in rows.columns:
        name += "_"
    table = rows.sparkSession.createDataFrame(pa.table({name: pa.array([bits], pa.list_(pa.int64()))}))
    held = " AND ".join(f"shiftright(get(`{name}`, {word}), {bit}) & 1L = 1L" for word, bit in _places(key))
    return rows.join(F.broadcast(table), F.expr(held)).select(*rows.columns)
