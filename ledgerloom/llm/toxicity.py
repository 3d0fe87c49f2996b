"""Toxicity by two class-conditional Kneser-Ney models over bytes.

Six-byte strings of lower-cased text are counted per class over all labelled
rows that may be learned from. Each class has an interpolated Kneser-Ney model
of the sixth byte given five; both back off to one shared model of the byte
given two, made of continuation counts of both classes together, so that a rare
expression is smoothed alike in both and only class evidence moves the ratio.

A document is scored by length-normalised log-likelihood ratios (toxic against
ordinary): the mean over the document, and the largest mean over any stretch of
``STRETCH`` bytes, since a toxic expression is short and a text may be long. A
logistic curve over the two, the logarithm of the length, turns them into a
probability; it is fitted on learnable rows that were not counted, so it sees
the ratios that unseen text gets.

Counting is a distributed sum by six-byte string, and the model is a table of
one ratio per counted string and one per context, which holds all of them and
grows with the labelled text. Texts that are scored are stored in chunks. A
chunk asks for each of its distinct strings once, in messages by hash bucket of
the context; a bucket holds its part of the model and answers from it, with the
context's ratio where the string was not counted; chunks look their answers up
in the shared folder. What the fit has stored is removed when the curve is fitted. The curve is fitted on a histogram of the features, whose
size is fixed. Nothing else reaches the driver, and nothing is broadcast.

Labels, lang, source and doc_id are no inputs of a score. doc_id picks the
learnable rows: crc32(doc_id as text) mod 5 is 0 for held-out rows, 1 to 3 for
counted ones, 4 for the curve.

Cases: NULL and empty texts get the score of a text without evidence. A row
without doc_id, or without a label, is scored but not learned from; several
labels of a doc_id count as toxic if any is. Repeated documents are learned
from and scored each. If fold 4 or the counted folds lack toxic or ordinary rows,
the curve is fitted on another of the folds 1 to 4 for which both have them, and
the others are counted; if there is none, all learnable rows are both counted
and fitted on. Without a learnable toxic row, or without an ordinary one, the
score is 0 (below 1e-17). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bitmap import rows_that_may_match
from ledgerloom.llm.common import GOLDEN, bounded_batches, byte_sizes, filesystem, mix, slices, table, text_bytes, tidy
from ledgerloom.llm.exchange import Outbox, by_bucket, received
from ledgerloom.session import collecting, release, shared_folder, stored

ORDER, SHARED = 6, 3
DISCOUNT = 0.75
STRETCH = 24
#: Cells per feature of the histogram.
BINS = 64
COUNT_BYTES = 4 << 20
SCORE_BYTES = 1 << 20
CHUNK_BYTES = 8 << 20
TABLE_BITS = 21
FACTORS = (mix(GOLDEN.reshape(1))[0] | np.uint64(1), mix(GOLDEN.reshape(1) + np.uint64(1))[0] | np.uint64(1))
#: What a row adds to a chunk besides its text.
ROW_BYTES = 64
BUCKET_GRAMS = 1 << 20
MODEL_KINDS = ["<u8", "<f4"]
MODEL = "model"
#: Ratios travel to the chunks rounded to 11 binary digits.
ANSWER = "<f2"
MESSAGE = "bucket int, chunk long, c0 binary, c1 binary"
#: Marks the key of a context, whose ratio strings with an unseen last byte get.
CONTEXT = np.uint64(1 << (8 * ORDER))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fold(doc_id) -> object:
    """crc32 of the doc_id's text, mod 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def strings(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The six-byte string that ends at every byte, as a number, and how many of each row there are.

    Every row is preceded by spaces, so its first bytes have a context too.
    """
    lengths = np.diff(at)
    pad = ORDER - 1
    padded = np.full(len(data) + pad * len(lengths), 32, np.uint8)
    place = np.arange(len(data)) + np.repeat(pad * np.arange(1, len(lengths) + 1), lengths)
    padded[place] = _LOWER[data]
    # Two, four and six bytes as numbers, over the padded rows without a gather.
    two = (padded[:-1].astype(np.uint64) << np.uint64(8)) | padded[1:] if len(padded) else np.zeros(0, np.uint64)
    six = (two[:-4] << np.uint64(32)) | (two[2:-2] << np.uint64(16)) | two[4:] if len(two) > 4 else two[:0]
    return six[place - pad], lengths


def bucket_of(five: np.ndarray, n_buckets: int) -> np.ndarray:
    """A context's bucket, which all strings that start with it share."""
    return ((mix(five + np.uint64(1)) >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
        texts = batch.column("text")
        for a, b in slices(byte_sizes(texts), COUNT_BYTES):
            data, own = text_bytes(texts.slice(a, b - a))
            key, lengths = strings(data, own)
            key = key * np.uint64(2) + np.repeat(toxic[a:b], lengths).astype(np.uint64)
            found, n = np.unique(key, return_counts=True)
            is_toxic = (found & np.uint64(1)).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((found >> np.uint64(1)).astype(np.int64)),
                    pa.array(np.where(is_toxic, n, 0)),
                    pa.array(np.where(is_toxic, 0, n)),
                ],
                names=["gram", "toxic", "plain"],
            )


def model_rows(learn: DataFrame) -> tuple[DataFrame, int]:
    """The model as messages by bucket (keys and log ratios as bytes), and the number of buckets.

    Keys are strings, and contexts marked by ``CONTEXT``.
    """
    grams = stored(
        learn.mapInArrow(tidy(_count), "gram long, toxic long, plain long")
        .groupBy("gram")
        .agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain")),
        "grams",
    )
    n_buckets = max(int(learn.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * grams.count() // BUCKET_GRAMS + 1)
    mask = (1 << (8 * SHARED)) - 1
    tail = grams.select(F.col("gram").bitwiseAND(F.lit(mask)).alias("tail")).groupBy("tail").agg(F.count("*").alias("cc"))
    byte = tail.groupBy(F.col("tail").bitwiseAND(F.lit(255)).alias("byte")).agg(F.sum("cc").alias("bc"), F.count("*").alias("bt"))
    total = byte.agg(F.sum("bc").alias("all_c"))
    context = tail.groupBy(F.shiftright("tail", 8).alias("tc")).agg(F.sum("cc").alias("tcc"), F.count("*").alias("tn"))
    d = F.lit(DISCOUNT)
    # At most 256 rows and one row: bounded broadcasts.
    one = byte.join(F.broadcast(total)).select("byte", ((F.col("bc") + 1) / (F.col("all_c") + 256)).alias("p1"))
    shared = (
        tail.join(context, F.shiftright("tail", 8) == F.col("tc"))
        .join(F.broadcast(one), F.col("tail").bitwiseAND(F.lit(255)) == F.col("byte"))
        .select("tail", ((F.greatest(F.col("cc") - d, F.lit(0.0)) + d * F.col("tn") * F.col("p1")) / F.col("tcc")).alias("ps"))
    )
    five = grams.groupBy(F.shiftright("gram", 8).alias("five")).agg(
        F.sum("toxic").alias("ct"), F.sum("plain").alias("cp"),
        F.count_if(F.col("toxic") > 0).alias("nt"), F.count_if(F.col("plain") > 0).alias("np"),
    )
    weight = lambda n, c: F.when(F.col(c) > 0, d * F.col(n) / F.col(c)).otherwise(1.0)
    five = five.select("five", "ct", "cp", weight("nt", "ct").alias("lt"), weight("np", "cp").alias("lp"))
    seen = lambda n, c: F.when(F.col(c) > 0, F.greatest(F.col(n) - d, F.lit(0.0)) / F.col(c)).otherwise(0.0)
    ratios = (
        grams.join(five, F.shiftright("gram", 8) == F.col("five"))
        .join(shared, F.col("gram").bitwiseAND(F.lit(mask)) == F.col("tail"))
        .select(
            F.col("gram").alias("key"), F.lit(False).alias("context"),
            F.log((seen("toxic", "ct") + F.col("lt") * F.col("ps")) / (seen("plain", "cp") + F.col("lp") * F.col("ps"))).alias("ratio"),
        )
    )
    unseen = five.select(F.col("five").alias("key"), F.lit(True).alias("context"), F.log(F.col("lt") / F.col("lp")).alias("ratio"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outbox = Outbox(n_buckets, MODEL_KINDS)
        for batch in batches:
            key = batch.column("key").to_numpy().astype(np.uint64)
            context = batch.column("context").to_numpy(zero_copy_only=False).astype(bool)
            bucket = bucket_of(np.where(context, key, key >> np.uint64(8)), n_buckets)
            yield from outbox.put(bucket, np.where(context, key | CONTEXT, key), batch.column("ratio").to_numpy())
        yield from outbox.flush()

    return stored(ratios.union(unseen).mapInArrow(tidy(pack), "bucket int, c0 binary, c1 binary"), MODEL), n_buckets


def find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``asked`` stands among sorted ``keys``, and whether it does."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


def look_up(keys: np.ndarray, ratios: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Ratio of each string: its own, else its context's, else 0."""
    out = np.zeros(len(grams), np.float32)
    at, own = find(keys, grams)
    out[own] = ratios[at[own]]
    rest = np.flatnonzero(~own)
    at, seen = find(keys, (grams[rest] >> np.uint64(8)) | CONTEXT)
    out[rest[seen]] = ratios[at[seen]]
    return out


def place(key: np.ndarray, factor: np.uint64 = FACTORS[0]) -> np.ndarray:
    """A cell of a worker's table; which one moves work, never results."""
    return ((key * factor) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)


def distinct(key: np.ndarray) -> np.ndarray:
    """Sorted distinct keys; repeats of the last key of a table's cell are left out before the sort."""
    cell, own = np.empty(1 << TABLE_BITS, np.int32), np.arange(len(key), dtype=np.int32)
    at = place(key)
    cell[at] = own
    last = cell[at]
    return np.unique(key[(last == own) | (key[last] != key)])


def find_repeated(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`find`, for many asked: a table finds most, a second one keys that met another there, the few left are searched."""
    own, start = np.arange(len(keys), dtype=np.int32), place(keys)
    cell = np.zeros(1 << TABLE_BITS, np.int32)
    cell[start] = own
    at = cell[place(asked)].astype(np.int64)
    known = keys[at] == asked if len(keys) else np.zeros(len(asked), bool)
    rest = np.flatnonzero(~known)
    met = np.flatnonzero(cell[start] != own)
    if len(met) and len(rest):
        cell[place(keys[met], FACTORS[1])] = met
        again = cell[place(asked[rest], FACTORS[1])].astype(np.int64)
        found = keys[again] == asked[rest]
        at[rest[found]], known[rest[found]] = again[found], True
        rest = rest[~found]
    at[rest], known[rest] = find(keys, asked[rest])
    return at, known


def grams_of(parts: Iterable[np.ndarray]) -> np.ndarray:
    """The distinct strings of some texts, sorted, from the strings of each part; those met in earlier parts drop out first."""
    seen = np.full(1 << TABLE_BITS, CONTEXT, np.uint64)
    found = [np.zeros(0, np.uint64)]
    for key in parts:
        at = place(key)
        fresh = seen[at] != key
        key, at = key[fresh], at[fresh]
        seen[at] = key
        found.append(distinct(key))
    return np.unique(np.concatenate(found))


def text_parts(texts: pa.Array) -> Iterator[tuple[int, int, tuple[np.ndarray, np.ndarray]]]:
    """Rows of some texts with their bytes, about SCORE_BYTES at a time."""
    for a, b in slices([ROW_BYTES + n for n in byte_sizes(texts)], SCORE_BYTES):
        yield a, b, text_bytes(texts.slice(a, b - a))


def dealt(grams: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of sorted strings by bucket, the buckets that have any, and where each one's start in that order, with the end."""
    bucket = bucket_of(grams >> np.uint64(8), n_buckets)
    order = np.argsort(bucket, kind="stable")
    present, starts = np.unique(bucket[order], return_index=True)
    return order, present, np.append(starts, len(grams))


def planes(grams: np.ndarray) -> bytes:
    """Sorted strings with their first bytes together, then their second ones, and so on: they compress well."""
    return grams.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - ORDER :].T.tobytes()


def from_planes(data) -> np.ndarray:
    own = np.frombuffer(data, np.uint8).reshape(ORDER, -1)
    whole = np.zeros((own.shape[1], 8), np.uint8)
    whole[:, 8 - ORDER :] = own.T
    return whole.view(">u8")[:, 0].astype(np.uint64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, rest) in chunks of about CHUNK_BYTES; a chunk is one row."""
    task, count = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    size = 0

    def chunk() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        one = lambda c: pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows.column(c).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([(task << 32) + count]), one("text"), one("rest")], names=["chunk", "texts", "rest"])

    for batch in batches:
        sizes = [ROW_BYTES + n for n in byte_sizes(batch.column("text"))]
        for a, b in slices(sizes, CHUNK_BYTES // 8):
            own = sum(sizes[a:b])
            if held and size + own > CHUNK_BYTES:
                yield chunk()
                held, size, count = [], 0, count + 1
            held.append(batch.slice(a, b - a))
            size += own
    if held:
        yield chunk()


def _asked(n_buckets: int):
    """The distinct strings of each chunk, as messages by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                texts = batch.column("texts")[i].values
                grams = grams_of(strings(*own)[0] for _, _, own in text_parts(texts))
                order, present, at = dealt(grams, n_buckets)
                grams = grams[order]
                n = len(present)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(present, pa.int32()),
                        pa.array([batch.column("chunk")[i].as_py()] * n, pa.int64()),
                        pa.array([planes(grams[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                        pa.nulls(n, pa.binary()),
                    ],
                    names=["bucket", "chunk", "c0", "c1"],
                )

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ratios for the messages of chunks; a bucket's part of the model (chunk is NULL) comes before them."""
    model, keys, ratios = [], np.zeros(0, np.uint64), np.zeros(0, np.float32)
    for batch in batches:
        of_model = batch.column("chunk").is_null()
        model.append(batch.filter(of_model))
        asked = batch.filter(pc.invert(of_model))
        if not asked.num_rows:
            continue
        if model:
            more_keys, more_ratios = received(iter(model), MODEL_KINDS)
            keys, ratios = np.concatenate([keys, more_keys]), np.concatenate([ratios, more_ratios])
            order = np.argsort(keys)
            keys, ratios, model = keys[order], ratios[order], []
        grams = [from_planes(v.as_buffer()) for v in asked.column("c0")]
        found = look_up(keys, ratios, np.concatenate(grams))
        ends = np.cumsum([len(g) for g in grams])
        out = pa.array([found[b - len(g) : b].astype(ANSWER).tobytes() for g, b in zip(grams, ends, strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([asked.column("chunk"), asked.column("bucket"), out], names=["chunk", "bucket", "ratios"])


def answers(folder: str, chunk: int, grams: np.ndarray, n_buckets: int) -> np.ndarray:
    """Ratios of the sorted ``grams`` that the chunk asked for."""
    out = np.zeros(len(grams), np.float32)
    if not len(grams):
        return out
    fs, base = filesystem(folder)
    found = {}
    for info in fs.get_file_info(pafs.FileSelector(f"{base}/chunk={chunk}")):
        if info.path.endswith(".parquet"):
            with fs.open_input_file(info.path) as handle:
                rows = pq.ParquetFile(handle).read(columns=["bucket", "ratios"])
            found |= zip(rows.column("bucket").to_pylist(), rows.column("ratios").to_pylist(), strict=True)
    order, present, _ = dealt(grams, n_buckets)
    out[order] = np.frombuffer(b"".join(found[b] for b in present.tolist()), ANSWER)
    return out


def features(model: tuple[np.ndarray, np.ndarray], data: np.ndarray, at: np.ndarray, key: np.ndarray | None = None) -> np.ndarray:
    """Mean ratio, largest mean over a stretch, and log length of each row; the model is sorted strings and their ratios.

    ``key`` holds the rows' strings where they are known already.
    """
    lengths = np.diff(at)
    if key is None:
        key, lengths = strings(data, at)
    where, known = find_repeated(model[0].astype(np.uint64, copy=False), key)
    ratio = np.where(known, model[1][where] if len(model[1]) else 0, 0)
    sums = np.concatenate([[0.0], np.cumsum(ratio.astype(np.float64))])
    out = np.zeros((len(lengths), 3))
    some = lengths > 0
    out[some, 0] = (sums[at[1:]] - sums[at[:-1]])[some] / lengths[some]
    # The stretch that ends at each byte, cut at the row's start.
    row_start = np.repeat(at[:-1], lengths)
    end = np.arange(1, len(data) + 1)
    stretch = (sums[end] - sums[np.maximum(end - STRETCH, row_start)]) / STRETCH
    if len(data):
        out[some, 1] = np.maximum.reduceat(stretch, at[:-1][some])
    out[:, 2] = np.log1p(lengths)
    return out


def _features_of(folder: str, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                texts, rest = batch.column("texts")[i].values, batch.column("rest")[i].values
                parts = [(a, b, own, strings(*own)[0]) for a, b, own in text_parts(texts)]
                grams = grams_of(key for *_, key in parts)
                model = grams, answers(folder, batch.column("chunk")[i].as_py(), grams, n_buckets)
                for a, b, own, key in parts:
                    both = features(model, *own, key)
                    yield pa.RecordBatch.from_arrays(
                        [texts.slice(a, b - a), rest.slice(a, b - a), *(pa.array(both[:, k]) for k in range(3))], names=["text", "rest", "_f0", "_f1", "_f2"]
                    )

    return run


FEATURES = "_f0 double, _f1 double, _f2 double"
LIMITS = ((-0.5, 0.5), (-0.5, 3.5), (0.0, 16.0))


def fit_curve(cells: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Logistic weights (bias first) from a histogram of features: rows (b0, b1, b2, toxic, n)."""
    rows = np.array(cells, np.float64).reshape(-1, 5)
    if not len(rows) or len(np.unique(rows[:, 3])) < 2:
        return np.array([-40.0, 0, 0, 0])
    middle = np.array([low + (rows[:, i] + 0.5) * (high - low) / BINS for i, (low, high) in enumerate(LIMITS)]).T
    x = np.column_stack([np.ones(len(rows)), middle])
    y, n = rows[:, 3], rows[:, 4]
    w = np.zeros(4)
    penalty = np.array([0, 1e-4, 1e-4, 1e-4])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (n * (y - p)) - penalty * w
        curvature = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curvature, gradient)
        w = w + step * min(1.0, 20 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return w


def with_features(docs: DataFrame, keep: tuple[str, ...], model: DataFrame, n_buckets: int) -> DataFrame:
    """The columns ``keep`` of every document and its features."""
    spark = docs.sparkSession
    rest = F.struct(*[F.col(c) for c in keep if c != "text"]) if set(keep) - {"text"} else F.struct(F.lit(0).alias("_"))
    docs = docs.select("text", rest.alias("rest"))
    kind = docs.schema["rest"].dataType.simpleString()
    chunks = stored(docs.mapInArrow(tidy(_chunks), f"chunk long, texts array<string>, rest array<{kind}>"), "chunks", "zstd")
    asked = chunks.select("chunk", "texts").mapInArrow(tidy(_asked(n_buckets)), MESSAGE)
    sent = model.select("bucket", F.lit(None).cast("long").alias("chunk"), "c0", "c1").union(asked)
    found = by_bucket(sent, n_buckets).sortWithinPartitions(F.asc_nulls_first("chunk")).mapInArrow(tidy(_answered), "chunk long, bucket int, ratios binary")
    folder = shared_folder(spark, "ratios")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found.repartition(n, "chunk").sortWithinPartitions("chunk").write.partitionBy("chunk").parquet(folder)
    # The messages are answered; their shuffle files need not wait for the texts' scores.
    del asked, sent, found
    release(spark, [])
    out = chunks.mapInArrow(tidy(_features_of(folder, n_buckets)), f"text string, rest {kind}, {FEATURES}")
    return out.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in keep], "_f0", "_f1", "_f2")


def curve_fold(classes: set[tuple[int, bool]]) -> int | None:
    """Of folds 4 to 1 the first that has both classes, as the others have, from (fold, toxic) with rows."""
    for own in (4, 3, 2, 1):
        if len({t for f, t in classes if f == own}) == len({t for f, t in classes if f != own}) == 2:
            return own
    return None


def _fitted(docs: DataFrame, labels: DataFrame) -> tuple[tuple[DataFrame, int], list[float]]:
    """The model of the learnable documents, and the weights of the curve."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Labels cover a part of the documents, and one time in five a row is held out: the other texts are not shuffled.
    known = known.where(fold("doc_id") != 0)
    rows = rows_that_may_match(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id", known, "doc_id")
    rows = rows.join(known.hint("merge"), "doc_id")
    learn = stored(rows.withColumn("fold", fold("doc_id")), "labelled", "zstd")
    own = curve_fold({(r.fold, r.y) for r in learn.groupBy("fold", (F.col("toxic") > 0).alias("y")).count().collect()})
    counted = learn.where(F.lit(True) if own is None else F.col("fold") != own).select("text", "toxic")
    model = model_rows(counted)
    found = with_features(learn.where(F.lit(True) if own is None else F.col("fold") == own), ("toxic",), *model)
    bins = [
        F.least(F.greatest(F.floor((F.col(f"_f{i}") - low) * (BINS / (high - low))), F.lit(0)), F.lit(BINS - 1)).alias(f"b{i}")
        for i, (low, high) in enumerate(LIMITS)
    ]
    cells = found.groupBy(*bins, (F.col("toxic") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()
    return model, fit_curve([(r.b0, r.b1, r.b2, r.y, r.n) for r in cells]).tolist()


class ToxicityModel:
    """Fitted on ``documents`` and ``labels``; :meth:`score` adds score and predicted to any documents."""

    def __init__(self, spark, docs: DataFrame, labels: DataFrame) -> None:
        bounded_batches(spark)
        with collecting() as made:
            self.model, self.weights = _fitted(docs, labels)
        # Of what the fit has stored and shuffled only the model is read again.
        release(spark, [f for f in made if not f.endswith(f"/{MODEL}")])

    def score(self, docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """The columns ``keep`` of every document, its score and predicted."""
        found = with_features(docs, keep, *self.model)
        at = F.lit(self.weights[0])
        for i, w in enumerate(self.weights[1:]):
            at = at + F.lit(w) * F.col(f"_f{i}")
        score = 1 / (1 + F.exp(-F.greatest(F.least(at, F.lit(40.0)), F.lit(-40.0))))
        return found.select(*keep, score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = ToxicityModel(spark, docs, table(spark, sf_dir, "labels")).score(docs)
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted")
