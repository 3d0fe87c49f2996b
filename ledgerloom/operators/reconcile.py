"""Reconciliation of two layers: which keys were lost, added or changed on the way."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import release, stored

BUCKETS = 4096
SEEDS = (42, 4711)
#: Bits of a hash that one sum takes: sums of 2 ** 39 rows fit a long.
PIECE = 24


def _texts(columns: list[str]) -> list[Column]:
    """Values as texts, so a date and its ISO text are equal."""
    return [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns]


def _digest(columns: list[str]) -> list[Column]:
    """Row count and two sums of 64-bit hashes: the same for the same rows in any order.

    Each sum has a seed of its own; rows that repeat count as often as they are there.
    """
    hashes = [F.sum(F.xxhash64(F.lit(seed), *_texts(columns)).cast("decimal(38,0)")) for seed in SEEDS]
    return [F.count("*").alias("n"), *[h.alias(f"h{i}") for i, h in enumerate(hashes)]]


def _sums(columns: list[str], sign: Column | None = None) -> list[Column]:
    """Sums of 24-bit pieces, two of the hash of each seed: digests whose state is four longs.

    A hash leaves NULL out, so the places of NULL are hashed as well.
    """
    gaps = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    sums = []
    for seed in SEEDS:
        h = F.xxhash64(F.lit(seed), gaps, *[F.col(c).cast("string") for c in columns])
        for piece in (F.shiftrightunsigned(h, 64 - PIECE), h.bitwiseAND(F.lit((1 << PIECE) - 1))):
            sums.append(F.sum(piece if sign is None else piece * sign))
    return sums


def _differ(sums: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, [s != 0 for s in sums])


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(_hash(keys), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, h0 to h3): the digest of the rows of each key bucket, combined before the shuffle."""
    sums = [h.alias(f"h{i}") for i, h in enumerate(_sums([*keys, *columns]))]
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(F.count("*").alias("n"), *sums)


def differing_buckets(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> list[int]:
    """Buckets whose digests differ; at most ``buckets`` numbers."""
    return _parted(*(bucket_digests(df, keys, columns, buckets) for df in (before, after)))


def _parted(before: DataFrame, after: DataFrame) -> list[int]:
    a, b = before.alias("a"), after.alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in before.columns if c != "bucket"])
    joined = a.join(b, F.col("a.bucket") == F.col("b.bucket"), "full").where(~same)
    return sorted(r[0] for r in joined.select(F.coalesce("a.bucket", "b.bucket")).collect())


def _both(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of both layers as texts, with a sign: 1 before, -1 after."""
    own = [F.col(c).cast("string").alias(f"k_{c}") for c in keys] + [F.col(c).cast("string").alias(f"c_{c}") for c in columns]
    return before.select(*own, F.lit(1).alias("_sign")).unionAll(after.select(*own, F.lit(-1).alias("_sign")))


def differing_keys(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(_hash): hashes of the keys whose rows differ between two layers, stored.

    What is shuffled of a key is its hash and five longs, whatever its columns
    hold; rows that both layers have cancel out. The shuffle files are dropped
    once the hashes are stored.
    """
    rows = _both(before, after, keys, columns)
    sums = [F.sum("_sign"), *_sums(rows.columns[:-1], F.col("_sign"))]
    states = rows.groupBy(_hash(rows.columns[: len(keys)]).alias("_hash")).agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)])
    found = stored(states.where(_differ([F.col(f"s{i}") for i in range(len(sums))])).select("_hash"), "differing-keys")
    release(found.sparkSession, [])
    return found


def reconcile(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys that differ between two layers: the keys, kind, columns, n_before, n_after.

    ``kind`` is ``lost``, ``added`` or ``changed``; ``columns`` names, in order, the
    columns whose values differ for a changed key, ``n_rows`` among them where it
    has more or fewer rows. All rows of a key are compared as a multiset, NULL
    keys included. Digests of key buckets are compared first, then, in buckets
    that differ, digests of keys; only rows of keys that differ are grouped with
    digests of each column.
    """
    return _reconcile(before, after, keys, columns, buckets, differing_buckets(before, after, keys, columns, buckets))


def _reconcile(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str], buckets: int, found: list[int]) -> DataFrame:
    if found:
        if len(found) < buckets:
            before, after = (df.where(_bucket(keys, buckets).isin(found)) for df in (before, after))
        apart = differing_keys(before, after, keys, columns)
        # Below the union, so that values of keys that do not differ are not derived.
        before, after = (df.join(apart, _hash(keys) == apart["_hash"], "left_semi") for df in (before, after))
    else:
        before, after = before.limit(0), after.limit(0)
    rows = _both(before, after, keys, columns)
    sign, named, values = F.col("_sign"), [f"k_{k}" for k in keys], [f"c_{c}" for c in columns]
    digests = {f"d{i}": _sums(some, sign) for i, some in enumerate([values, *([v] for v in values)])}
    grouped = rows.groupBy(*named).agg(
        F.count_if(sign > 0).alias("n_before"), F.count_if(sign < 0).alias("n_after"),
        *[s.alias(f"{d}_{j}") for d, sums in digests.items() for j, s in enumerate(sums)],
    )
    uneven = F.col("n_before") != F.col("n_after")
    differs = [uneven | _differ([F.col(f"{d}_{j}") for j in range(len(sums))]) for d, sums in digests.items()]
    lost, added = F.col("n_after") == 0, F.col("n_before") == 0
    changed = [F.when(uneven, F.lit("n_rows"))]
    changed += [F.when(differs[i + 1], F.lit(c)) for i, c in enumerate(columns)]
    # Equal values by column, but dealt to other rows of the key.
    names = F.array_compact(F.array(*changed))
    names = F.when(F.size(names) > 0, names).otherwise(F.array(F.lit("rows")))
    return grouped.where(lost | added | differs[0]).select(
        *[F.col(f"k_{k}").alias(k) for k in keys],
        F.when(lost, "lost").when(added, "added").otherwise("changed").alias("kind"),
        F.when(~lost & ~added, names).alias("columns"),
        "n_before",
        "n_after",
    )


def reconcile_layers(layers: dict[str, DataFrame], keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Differences between each layer and the next one: layer, next_layer and the columns of ``reconcile``.

    Layers are compared in the columns they all have among ``columns``. The bucket
    digests of a layer are made once, for both of its neighbours.
    """
    names = list(layers)
    shared = [c for c in columns if all(c in df.columns for df in layers.values())]
    each = [bucket_digests(df, keys, shared, buckets).select(F.lit(name).alias("layer"), "*") for name, df in layers.items()]
    digests = stored(reduce(DataFrame.unionByName, each), "layer-digests")
    own = {name: digests.where(F.col("layer") == name).drop("layer") for name in names}
    steps = []
    for first, second in zip(names, names[1:]):
        found = _reconcile(layers[first], layers[second], keys, shared, buckets, _parted(own[first], own[second]))
        steps.append(found.select(F.lit(first).alias("layer"), F.lit(second).alias("next_layer"), "*"))
    return reduce(DataFrame.unionByName, steps)


def layer_counts(layers: dict[str, DataFrame], keys: list[str], columns: list[str]) -> DataFrame:
    """One row per layer: rows and the digest of all rows, to tell at a glance where layers part."""
    shared = [c for c in columns if all(c in df.columns for df in layers.values())]
    rows = [
        df.agg(*_digest([*keys, *shared])).select(F.lit(name).alias("layer"), "*")
        for name, df in layers.items()
    ]
    return stored(reduce(DataFrame.unionByName, rows), "layer-counts")
