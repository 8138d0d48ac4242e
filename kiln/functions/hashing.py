"""Deterministic pseudo-randomness shared by Spark and SQL oracles.

``md5(concat_ws('|', key..., seed, purpose))`` -> first 8 hex digits -> an
unsigned 32-bit integer. The same value is computable in DuckDB with
``('0x' || substr(md5(concat_ws('|', ...)), 1, 8))::BIGINT``. Never ``rand()``:
it is not reproducible across engines or re-executions after executor loss.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def hash_digits(*parts) -> Column:
    """``hash32`` as eight hex digits, which order as the numbers do. Cheaper where a draw is only compared."""
    return F.substring(F.md5(_key(parts)), 1, 8)


def hash32(*parts) -> Column:
    """Unsigned 32-bit integer (as BIGINT) from md5 of the joined parts."""
    return F.conv(hash_digits(*parts), 16, 10).cast("bigint")


def unit_hash(*parts) -> Column:
    """Uniform double in [0, 1) from ``hash32``."""
    return hash32(*parts) / F.lit(TWO_32)


def with_prefix(parts: list, made: Callable[[Column], Column]) -> Column:
    """``made`` of the joined parts that are the same for all elements of a row. They are bound once; named in a lambda over the
    elements, they would be cast and joined again for each."""
    return F.get(F.transform(F.array(_key([*parts, F.lit("")])), made), F.lit(0))


def digits_after(prefix: Column, part: Column) -> Column:
    """``hash_digits`` of the parts of ``with_prefix`` and one more, which must not be null."""
    return F.substring(F.md5(F.concat(prefix, part.cast("string"))), 1, 8)


def above_after(p: float, prefix: Column, part: Column) -> Column:
    """Whether ``unit_hash`` of the parts of ``with_prefix`` and one more is greater than ``p``, by comparing digits."""
    least = math.floor(p * TWO_32)
    if not 0 <= least < TWO_32:
        return F.lit(least < 0)
    return F.md5(F.concat(prefix, part.cast("string"))) > F.lit(f"{least:08x}".ljust(32, "f"))


def sql_hash32(*parts: str) -> str:
    """DuckDB/ANSI form of ``hash32`` (parts are SQL expressions)."""
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT"


def sql_unit_hash(*parts: str) -> str:
    return f"({sql_hash32(*parts)}::DOUBLE / 4294967296.0::DOUBLE)"
