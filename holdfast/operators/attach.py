"""Join on keys that may be null, with the strategy left to Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Inner (or left) join on equal keys, null keys equal to each other.

    Lazy: adaptive execution broadcasts ``small`` when its real size allows and
    splits hot keys when it does not. Without keys, ``small`` is one row, which is
    fetched at once, and its values become constants.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not keys:
        (row,) = small.collect()
        return df.select("*", *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in small.schema])
    renamed = small.withColumnsRenamed({name: f"_r_{name}" for name in keys})
    condition = [F.col(name).eqNullSafe(F.col(f"_r_{name}")) for name in keys]
    return df.join(renamed, condition, how).drop(*[f"_r_{name}" for name in keys])
