"""One row per business key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def first_per_key(
    df: DataFrame, keys: list[str], order: str, keep_null_keys: bool = True
) -> DataFrame:
    """Keep of each key the row that is first by ``order``, then by its values.

    The choice is an aggregate, so copies are thinned out before the shuffle
    and a key with many copies does not end in one task. Rows whose key has a
    NULL part are no copies of each other; they stay unless told otherwise.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    firsts = df.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("_row"))
    if not keep_null_keys:
        return firsts.select(*keys, "_row.*").select(*df.columns)
    unknown = F.lit(False)
    for key in keys:
        unknown = unknown | F.col(key).isNull()
    unique = (
        df.where(~unknown)
        .groupBy(*keys)
        .agg(F.min(F.struct(order, *rest)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )
    return unique.unionByName(df.where(unknown))


def topmost(
    df: DataFrame, measure: str, key: str | list[str], k: int, nulls: str = "first"
) -> DataFrame:
    """The ``k`` rows with the largest ``measure``, ties by ``key``.

    NULL counts as largest, as in the source dialect, unless ``nulls="last"``.
    """
    m = F.col(measure)
    order = m.desc_nulls_first() if nulls == "first" else m.desc_nulls_last()
    keys = [key] if isinstance(key, str) else key
    return df.orderBy(order, *[F.col(c).asc_nulls_last() for c in keys]).limit(k)
