"""Exact self-join of texts by the Jaccard similarity of their word shingles.

Two documents link when |A n B| / |A u B| of their five-word shingle sets
reaches the threshold. Every link between different texts is decided exactly:

1. Documents with equal sets are one class, which stands for all of them.
2. Linked sets share a shingle among the first ``n - ceil(t * n) + 1`` of each,
   in any fixed order of shingles. The order puts frequent ones last (a bitmap
   of fixed size tells which; it moves work, never the result), so common
   passages seldom meet. Tasks exchange those shingles by hash bucket.
3. Shingles that few classes share give candidate pairs, those that more than
   ``CROWD`` share give crowds. Pairs whose sizes rule a link out are dropped.
4. Every set is a point: its shingles are hashed into groups, and the group
   counts are the coordinates. The sum of the smaller coordinates bounds the
   overlap of two sets from above. Candidate pairs must pass that bound.
   Crowds are indexed: members of a family of crowds are packed by size into
   the leaves of an R-tree whose boxes hold the largest coordinates; leaf pairs
   whose boxes fail the bound are dropped, the rest are tasks of their own.
   Inside, points must pass the bound, and pairs already connected are skipped.
5. Surviving pairs are verified on the sets of the whole texts.

Links form components. Nothing lists all pairs of a group: a crowd yields at
most a spanning forest per leaf pair.

Sets are compared by 64-bit shingle hashes and classes by 128-bit fingerprints.

Cases: NULL and empty texts, or texts of white space alone, have no shingles
and link with nothing. Fewer than five words are one shingle. Repeated rows and
equal sets share a class. Rows that share a doc_id count as that document in
links. Rows without doc_id link with nothing and have no component. Other
columns are not read. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bitmap import bitmap, may_hold, rows_that_may_match
from ledgerloom.llm.common import bounded_batches, byte_sizes, mix, pair_runs, ragged, slices, table, text_bytes, tidy
from ledgerloom.llm.components import Forest, components
from ledgerloom.llm.exchange import Outbox, by_bucket, received
from ledgerloom.llm.shingles import fingerprint, overlap, shingle_sets
from ledgerloom.session import stored

CROWD = 64
LEAF_ROWS, LEAF_BYTES = 256, 2 << 20
BOX = 128
BATCH_BYTES = 1 << 20
#: Shingles a task looks at together to see which repeat; a shingle seen to repeat this often is frequent.
COUNTED, OFTEN = 2 << 20, 4
BUCKET_ROWS = 1 << 20
ROW_KINDS = ["<u4", "<i8", "u1"]
SIZE_STEP = 1.02
PAIRS_AT_ONCE = 1 << 20


def sets_of(batch: pa.RecordBatch, column: str = "text", budget: int = BATCH_BYTES) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and shingle sets of consecutive parts of a batch."""
    texts = batch.column(column)
    for a, b in slices(byte_sizes(texts), budget):
        yield a, shingle_sets(*text_bytes(texts.slice(a, b - a)))


def size_class(n: np.ndarray) -> np.ndarray:
    """Sizes on a logarithmic scale that fits a byte for all but absurd sizes, which share the last value."""
    return np.minimum(np.floor(np.log(np.maximum(n, 1)) / np.log(SIZE_STEP) / 4), 255).astype(np.uint8)


def point(own: np.ndarray) -> np.ndarray:
    """Group counts of a set; the number of groups is a power of two of about its size."""
    groups = 1 << max(6, int(len(own) - 1).bit_length() if len(own) else 6)
    return np.bincount((own & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """The same point with fewer groups."""
    return counts.reshape(-1, groups).sum(axis=0)


def point_bytes(counts: np.ndarray) -> bytes:
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def point_from(data: bytes, n: int) -> np.ndarray:
    groups = 1 << max(6, int(n - 1).bit_length() if n else 6)
    return np.frombuffer(data, np.uint8 if len(data) == groups else np.uint32).astype(np.int64)


class Threshold:
    def __init__(self, similarity: Fraction) -> None:
        self.top, self.bottom = similarity.numerator, similarity.denominator
        self.value = float(similarity)

    def prefix(self, n: int) -> int:
        return n - -(-self.top * n // self.bottom) + 1 if n else 0

    def enough(self, shared, total):
        """Whether sets of ``total`` elements together that share ``shared`` link."""
        return shared * self.bottom >= self.top * (total - shared)


PAIR_KINDS = ["<i8", "<i8"]
COUNT_KINDS = ["<i8", "<u4"]
_BLOBS = ("bucket", "c0", "c1")


def _survey(n_buckets: int):
    """Rows of doc_id, size and fingerprint; in others (bucket is not NULL) shingles that repeat within a task, with their count."""

    def sent(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            none = [pa.nulls(r.num_rows, pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([*none, *r.columns], names=["doc_id", "n", "p", "q", *_BLOBS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outbox = Outbox(n_buckets, COUNT_KINDS)
        held: dict = {}
        count = 0

        def repeated() -> Iterator[pa.RecordBatch]:
            found, times = np.unique(np.concatenate(list(held.values())), return_counts=True)
            found, times = found[times > 1], times[times > 1]
            held.clear()
            yield from sent(outbox.put((found >> np.uint64(32)).astype(np.int64) % n_buckets, found.view(np.int64), times))

        for batch in batches:
            doc_ids = batch.column("doc_id")
            for a, sets in sets_of(batch):
                names = [fingerprint(s) for s in sets]
                prints = np.array(names, np.int64).reshape(-1, 2)
                k = len(sets)
                none = [pa.nulls(k, t) for t in (pa.int32(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(a, k), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy()), *none],
                    names=["doc_id", "n", "p", "q", *_BLOBS],
                )
                # Equal sets are one class and count once.
                held.update(zip(names, sets, strict=True))
                count += sum(map(len, sets))
                if count > COUNTED:
                    yield from repeated()
                    count = 0
        if held:
            yield from repeated()
        yield from sent(outbox.flush())

    return run


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that tasks saw repeat OFTEN times in all."""
    keys, times = received(batches, COUNT_KINDS)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        total = np.add.reduceat(times[order].astype(np.int64), starts)
        yield pa.RecordBatch.from_arrays([pa.array(keys[starts][total >= OFTEN])], names=["p"])


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of a bucket."""
    pairs = np.stack(received(batches, PAIR_KINDS), axis=1)
    if len(pairs):
        pairs = np.unique(pairs, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])


def _send(rule: Threshold, frequent, n_buckets: int):
    """Prefix shingles by bucket, and the point of every set once per task (bucket is NULL)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outbox = Outbox(n_buckets, ROW_KINDS)
        none = lambda k, kind: pa.nulls(k, kind)

        def sent(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in rows:
                k = r.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*r.columns, none(k, pa.int64()), none(k, pa.int64()), none(k, pa.int64()), none(k, pa.binary())],
                    names=["bucket", "c0", "c1", "c2", "p", "q", "n", "point"],
                )

        for batch in batches:
            for _, sets in sets_of(batch):
                prints = [fingerprint(s) for s in sets]
                own = {p: s for p, s in zip(prints, sets, strict=True) if len(s)}
                if not own:
                    continue
                k = len(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(none(k, t) for t in (pa.int32(), pa.binary(), pa.binary(), pa.binary())),
                        pa.array([p for p, _ in own], pa.int64()),
                        pa.array([q for _, q in own], pa.int64()),
                        pa.array([len(s) for s in own.values()], pa.int64()),
                        pa.array([point_bytes(point(s)) for s in own.values()], pa.binary()),
                    ],
                    names=["bucket", "c0", "c1", "c2", "p", "q", "n", "point"],
                )
                n = np.array([len(s) for s in own.values()])
                first = np.concatenate([[0], np.cumsum(n)])
                every = np.concatenate(list(own.values()))
                late = may_hold(frequent.value, every.view(np.int64))
                chosen = []
                for i, size in enumerate(n.tolist()):
                    s, f = every[first[i] : first[i + 1]], late[first[i] : first[i + 1]]
                    take = rule.prefix(size)
                    rare = s[~f][:take]
                    chosen.append(rare if len(rare) == take else np.concatenate([rare, s[f][: take - len(rare)]]))
                lengths = [len(c) for c in chosen]
                keys = np.concatenate(chosen)
                bucket = ((keys >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int32)
                ids = np.repeat(np.array([p for p, _ in own], np.int64), lengths)
                classes = np.repeat(size_class(n), lengths)
                yield from sent(outbox.put(bucket, (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), ids, classes))
        yield from sent(outbox.flush())

    return run


def _meet(rule: Threshold, n_buckets: int):
    """Pairs of classes that share a prefix shingle, by bucket of the pair, and members of crowds (bucket is NULL)."""
    apart = int(np.ceil(np.log(1 / rule.value) / np.log(SIZE_STEP) / 4)) + 1

    def sent(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            none = [pa.nulls(r.num_rows, pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([*r.columns, *none], names=[*_BLOBS, "a", "crowd"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None or not first.num_rows:
            return
        bucket = first.column("bucket")[0].as_py()
        outbox = Outbox(n_buckets, PAIR_KINDS)

        def every() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        keys, ids, sizes = received(every(), ROW_KINDS)
        order = np.lexsort((ids, keys))
        keys, ids, sizes = keys[order], ids[order], sizes[order].astype(np.int64)
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
        keys, ids, sizes = keys[fresh], ids[fresh], sizes[fresh]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        count = np.diff(np.append(starts, len(keys)))
        large = np.repeat(count > CROWD, count)
        if large.any():
            crowd = (keys[large].astype(np.int64) << 24) ^ np.int64(bucket)
            none = [pa.nulls(int(large.sum()), t) for t in (pa.int32(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(ids[large]), pa.array(crowd)], names=[*_BLOBS, "a", "crowd"])
        last = np.repeat(starts + count, count)
        after = np.where(large, 0, last - np.arange(len(keys)) - 1)
        found = np.zeros((0, 2), np.int64)

        def give(pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
            to = (mix(pairs[:, 0].view(np.uint64)) >> np.uint64(33)).astype(np.int64) % n_buckets
            yield from sent(outbox.put(to, pairs[:, 0], pairs[:, 1]))

        for a, b in pair_runs(after, PAIRS_AT_ONCE):
            i = np.repeat(np.arange(a, b), after[a:b])
            j = ragged(np.arange(a, b) + 1, after[a:b])
            near = np.abs(sizes[i] - sizes[j]) <= apart
            pairs = np.stack([ids[i[near]], ids[j[near]]], axis=1)
            found = np.unique(np.concatenate([found, pairs]), axis=0) if len(pairs) else found
            if len(found) > PAIRS_AT_ONCE:
                yield from give(np.ascontiguousarray(found))
                found = found[:0]
        yield from give(np.ascontiguousarray(found))
        yield from sent(outbox.flush())

    return run


def _bounded(rule: Threshold):
    """Pairs whose summed coordinate minima allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("an").to_numpy(), batch.column("bn").to_numpy()
            kept = np.zeros(batch.num_rows, bool)
            for i in np.flatnonzero(rule.enough(np.minimum(n, m), n + m)).tolist():
                a, b = point_from(batch.column("ap")[i].as_py(), n[i]), point_from(batch.column("bp")[i].as_py(), m[i])
                groups = min(len(a), len(b))
                kept[i] = rule.enough(int(np.minimum(folded(a, groups), folded(b, groups)).sum()), n[i] + m[i])
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(kept)) for c in ("a", "aq", "b", "bq")], names=["a", "aq", "b", "bq"])

    return run


def _verified(rule: Threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [s for _, sets in sets_of(batch, "atext") for s in sets]
            right = [s for _, sets in sets_of(batch, "btext") for s in sets]
            kept = [rule.enough(overlap(a, b), len(a) + len(b)) for a, b in zip(left, right, strict=True)]
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return run


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by family and size, packed into leaves with their boxes."""
    held: list[tuple] = []

    def leaf() -> pa.RecordBatch:
        sets = shingle_sets(*text_bytes(pa.array([h[2] for h in held])))
        box = np.max([np.bincount((s & np.uint64(BOX - 1)).astype(np.int64), minlength=BOX) for s in sets], axis=0)
        sizes = [len(s) for s in sets]
        row = {
            "family": held[0][0], "leaf": held[0][1], "small": min(sizes), "large": max(sizes),
            "box": box.astype("<u4").tobytes(), "docs": [h[1] for h in held], "texts": [h[2] for h in held],
        }
        held.clear()
        return pa.RecordBatch.from_pylist([row], schema=LEAF)

    total = 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("family", "rep", "text"))
        for row in zip(*columns, strict=True):
            if held and (row[0] != held[0][0] or len(held) >= LEAF_ROWS or total + len(row[2]) > LEAF_BYTES):
                yield leaf()
                total = 0
            held.append(row)
            total += len(row[2])
    if held:
        yield leaf()


LEAF = pa.schema(
    [("family", pa.int64()), ("leaf", pa.int64()), ("small", pa.int64()), ("large", pa.int64()), ("box", pa.binary()), ("docs", pa.list_(pa.int64())), ("texts", pa.list_(pa.string()))]
)
LEAF_SQL = "family long, leaf long, small long, large long, box binary, docs array<long>, texts array<string>"


def _boxes_meet(rule: Threshold):
    """Leaf pairs whose boxes allow a link: the overlap is at most the summed minima of the boxes and the smaller largest size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = lambda c: batch.column(c).to_numpy()  # noqa: E731, B023
            boxes = [np.array([np.frombuffer(v.as_buffer(), "<u4") for v in batch.column(c)], np.int64).reshape(-1, BOX) for c in ("abox", "bbox")]
            most = np.minimum(np.minimum(*boxes).sum(axis=1), np.minimum(col("alarge"), col("blarge")))
            # For the smallest sizes of either leaf the bound is easiest to pass; their sizes differ by what t allows at most.
            kept = pa.array(rule.enough(most, col("asmall") + col("bsmall")))
            yield pa.RecordBatch.from_arrays([batch.column("aleaf").filter(kept), batch.column("bleaf").filter(kept)], names=["aleaf", "bleaf"])

    return run


def leaf_links(rule: Threshold, left: list, right: list | None) -> list[tuple[int, int]]:
    """Links that connect documents (doc, set) of one leaf, or across two; a spanning forest of them."""
    docs = left + (right or [])
    forest, links = Forest(len(docs)), []
    names, flat = np.unique(np.concatenate([s for _, s in docs]), return_inverse=True)
    n = np.array([len(s) for _, s in docs])
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    groups = 1 << max(6, int(np.median(n)).bit_length())
    points = np.stack([np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups) for _, s in docs]).astype(np.int32)
    mark = np.zeros(len(names), np.int64)
    others = np.arange(len(left), len(docs)) if right else None
    for i in range(len(left)):
        j = others if right else np.arange(i + 1, len(docs))
        j = j[rule.enough(np.minimum(n[j], n[i]), n[j] + n[i])]
        root = forest.root(i)
        j = j[[forest.root(int(x)) != root for x in j]] if len(j) else j
        if not len(j):
            continue
        j = j[rule.enough(np.minimum(points[j], points[i]).sum(axis=1), n[j] + n[i])]
        if not len(j):
            continue
        own = flat[starts[i] : starts[i] + n[i]]
        mark[own] = 1
        lengths = n[j]
        shared = np.add.reduceat(mark[flat[ragged(starts[j], lengths)]], np.cumsum(lengths) - lengths)
        mark[own] = 0
        for x in j[rule.enough(shared, lengths + n[i])].tolist():
            if forest.join(i, x):
                links.append((docs[i][0], docs[x][0]))
    return links


def _join_leaves(rule: Threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                side = lambda s: list(zip(row[f"{s}docs"], shingle_sets(*text_bytes(pa.array(row[f"{s}texts"], pa.string()))), strict=True))  # noqa: E731, B023
                same = row["adocs"] == row["bdocs"] and row["atexts"] == row["btexts"]
                links = leaf_links(rule, side("a"), None if same else side("b"))
                if links:
                    a, b = zip(*links, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _with_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps rows whose text has the asked fingerprint (rows may share a doc_id)."""
    for batch in batches:
        prints = np.array([fingerprint(s) for _, sets in sets_of(batch) for s in sets], np.int64).reshape(-1, 2)
        same = (prints[:, 0] == batch.column("p").to_numpy()) & (prints[:, 1] == batch.column("q").to_numpy())
        yield batch.filter(pa.array(same))


def class_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """p, q, rep and the text of each of ``classes``: only rows a fixed-size bitmap lets through are shuffled."""
    few = rows_that_may_match(docs, "doc_id", classes, "rep")
    rows = few.join(classes, few["doc_id"] == classes["rep"]).select("p", "q", "rep", "n", "text")
    return rows.mapInArrow(tidy(_with_prints), "p long, q long, rep long, n long, text string")


def similar_texts(docs: DataFrame, similarity: Fraction = Fraction(3, 4)) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    spark, rule = docs.sparkSession, Threshold(Fraction(similarity))
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    survey = stored(docs.mapInArrow(tidy(_survey(n_tasks)), "doc_id long, n long, p long, q long, bucket int, c0 binary, c1 binary"), "survey")
    sizes = survey.where("bucket IS NULL").select("doc_id", "n", "p", "q")
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    grouped = sizes.where("doc_id IS NOT NULL AND n > 0").groupBy("p", "q")
    classes = stored(grouped.agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "classes")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    repeated = by_bucket(survey.where("bucket IS NOT NULL").select(*_BLOBS), n_tasks).mapInArrow(tidy(_often), "p long")
    frequent = spark.sparkContext.broadcast(bitmap(repeated, "p"))
    n_buckets = max(n_tasks, int(total * (1 - rule.value) // BUCKET_ROWS) + 1)
    sent = stored(
        named.mapInArrow(
            tidy(_send(rule, frequent, n_buckets)), "bucket int, c0 binary, c1 binary, c2 binary, p long, q long, n long, point binary"
        ),
        "prefixes",
    )
    met = by_bucket(sent.where("bucket IS NOT NULL").select("bucket", "c0", "c1", "c2"), n_buckets)
    met = stored(met.mapInArrow(tidy(_meet(rule, n_buckets)), "bucket int, c0 binary, c1 binary, a long, crowd long"), "meetings")

    pairs = by_bucket(met.where("bucket IS NOT NULL").select(*_BLOBS), n_buckets).mapInArrow(tidy(_once), "a long, b long")
    points = sent.where("bucket IS NULL").select("p", "q", "n", "point").dropDuplicates(["p", "q"])
    near = pairs.join(points.select(*[F.col(c).alias(x) for c, x in (("p", "a"), ("q", "aq"), ("n", "an"), ("point", "ap"))]), "a")
    near = near.join(points.select(*[F.col(c).alias(x) for c, x in (("p", "b"), ("q", "bq"), ("n", "bn"), ("point", "bp"))]), "b")
    near = stored(near.mapInArrow(tidy(_bounded(rule)), "a long, aq long, b long, bq long"), "near")
    asked = near.select("a", "aq").union(near.select("b", "bq")).toDF("p", "q").distinct()
    texts = stored(class_texts(named, classes.join(asked, ["p", "q"])), "texts")
    left = texts.select(F.col("p").alias("a"), F.col("q").alias("aq"), F.col("rep").alias("arep"), F.col("text").alias("atext"))
    right = texts.select(F.col("p").alias("b"), F.col("q").alias("bq"), F.col("rep").alias("brep"), F.col("text").alias("btext"))
    both = near.join(left, ["a", "aq"]).join(right, ["b", "bq"])
    both = both.select(F.col("arep").alias("a"), F.col("brep").alias("b"), "atext", "btext")
    links = both.mapInArrow(tidy(_verified(rule)), "a long, b long")

    crowds = met.where("bucket IS NULL").select("a", "crowd").distinct()
    families = components(crowds.select("a", F.col("crowd").alias("b"))).select(F.col("node").alias("p"), F.col("component").alias("family"))
    members = classes.join(families, "p")
    crowd_texts = class_texts(named, members.select("p", "q", "rep", "n")).join(families, "p")
    packed = crowd_texts.select("family", "rep", "text", "n").repartitionByRange("family", "n", "rep")
    leaves = stored(packed.sortWithinPartitions("family", "n", "rep").mapInArrow(tidy(_leaves), LEAF_SQL), "leaves")
    head = ("leaf", "small", "large", "box")
    a = leaves.select("family", *[F.col(c).alias(f"a{c}") for c in head])
    b = leaves.select("family", *[F.col(c).alias(f"b{c}") for c in head])
    fits = (F.col("asmall") <= F.col("blarge") / rule.value) & (F.col("bsmall") <= F.col("alarge") / rule.value)
    leaf_pairs = a.join(b, "family").where((F.col("aleaf") <= F.col("bleaf")) & fits)
    leaf_pairs = leaf_pairs.mapInArrow(tidy(_boxes_meet(rule)), "aleaf long, bleaf long")
    left = leaves.select(F.col("leaf").alias("aleaf"), F.col("docs").alias("adocs"), F.col("texts").alias("atexts"))
    right = leaves.select(F.col("leaf").alias("bleaf"), F.col("docs").alias("bdocs"), F.col("texts").alias("btexts"))
    tiles = leaf_pairs.join(left, "aleaf").join(right, "bleaf")
    links = links.union(tiles.repartition(n_buckets, "aleaf", "bleaf").mapInArrow(tidy(_join_leaves(rule)), "a long, b long"))

    groups = components(links)
    by_class = classes.join(groups, classes["rep"] == groups["node"], "left").select(
        F.col("p").alias("_p"), F.col("q").alias("_q"), F.coalesce("component", "rep").alias("_component")
    )
    on = (F.col("p") == F.col("_p")) & (F.col("q") == F.col("_q"))
    return sizes.join(by_class, on, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("_component"))).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_texts(table(spark, sf_dir, "documents"))
