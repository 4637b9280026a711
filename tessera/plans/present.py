"""Presentation for cross-engine comparison: round doubles, flatten arrays.

Double sums depend on summation order in every engine, so results that are
compared with an independent engine are rounded to 6 decimals, and arrays
are emitted as comma-joined strings. The SQL side uses the same rules
(``r()`` / ``arr()`` in ``tessera.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMALS = 6


def _rounded(c: Column, decimals: int) -> Column:
    """``F.round(c, decimals)``, which goes by a decimal's digits: those are formed only where the scaled value is next
    to a half, or so large that it is not exact; elsewhere the nearest whole number divided is the same double.
    """
    scale = F.lit(10.0**decimals)
    scaled = c * scale
    whole = F.rint(scaled)
    plain = (F.abs(scaled) < F.lit(1e12)) & (F.abs(scaled - whole) < F.lit(0.499))
    return F.when(plain, whole / scale + F.lit(0.0)).otherwise(F.round(c, decimals))


def present(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = _rounded(c, decimals)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)
