"""Phrase collocation mining: scored phrases of each language.

Shards of text count their word windows in automata (``transducer``). The windows
of a shard, in order, are cut at boundaries that all shards share, so that an
automaton holds a range of sequences. A task unites the automata of a range; the
weights of states inside it are final there, the few along its two edges are added
up between ranges. Sequences with enough occurrences make one more set of
automata, with which the parts of all candidates are composed. The boundaries come
from a sample; they decide who counts a window, never what is counted.

Definitions: texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line
breaks and these into words at blanks and tabs. ``n`` is the number of words of a
language, f the number of places where a sequence stands within a piece. A phrase
of 2 to ``longest`` words with a = f >= ``least`` is a candidate; a cut after k words
gives l and r, the f of both sides, and floor(1000 * a * n / (l * r)). The lowest
cut counts, the smallest k of equals. A candidate inside a longer one that has at
least ``inside`` percent of its occurrences goes.

Cases: NULL and empty texts have no words; a NULL language is ``und``, the empty one
stays as it is. Repeated rows count each time. Ties in rank go by a, then by the
phrase's bytes. Empty tables give no rows. Other columns are not read. A long text
is counted in slices that end where a piece ends; only one piece must fit a task.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm import transducer
from ledgerloom.llm.common import bounded_batches, byte_sizes, slices, table, text_bytes, tidy
from ledgerloom.session import stored

LONGEST, LEAST, INSIDE, TOP = 5, 100, 100, 2000
#: Text of a shard, and of the ranges on average.
SHARD_BYTES, RANGE_BYTES = 8 << 20, 8 << 20
#: Ranges at most; beyond 8 TB of text they grow instead.
MOST_RANGES = 1 << 20
#: Sampled text for each range, from which the boundaries are taken.
SAMPLE_BYTES = 64 << 10
#: Automata of a range are united as soon as they have so many paths together.
UNITE_PATHS = 3_000_000
#: Sequences in one automaton of the lookups, on average.
LOOKUP_ROWS = 50_000
#: Groups in which a language's best phrases are found first.
HEATS = 64
#: Languages whose totals may be broadcast.
FEW_LANGS = 10_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# The characters that end a piece, and those between words.
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2


def windows(data: np.ndarray, at: np.ndarray, longest: int) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in byte order, and the window that starts at each word, as places there (0: past the piece)."""
    kind = _KIND[data]
    inner = at[:-1][np.diff(at) > 0]
    word = kind == 0
    first = np.ones(len(data), bool)
    first[1:] = ~word[:-1]
    first[inner] = True
    start = np.flatnonzero(word & first)
    if not len(start):
        return pa.array([], pa.binary()), np.zeros((0, longest), np.int64)
    sizes = np.add.reduceat(word, start, dtype=np.int64)
    # A word ends where the next one starts or before that, so the word bytes up to there are its own.
    clean = _LOWER[data[word]]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    own = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(clean)])
    words, place = transducer.sorted_words(own)
    piece = np.cumsum(kind == 2, dtype=np.int32)[start] + np.searchsorted(inner, start, "right")
    out = np.zeros((len(start), longest), np.int64)
    for k in range(longest):
        n = len(start) - k
        if n > 0:
            out[:n, k] = np.where(piece[k:] == piece[:n], place[k:], 0)
    return words, out


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and row starts of shards; a text that is longer than a shard is cut where a piece ends."""
    for a, b in slices(byte_sizes(column), SHARD_BYTES):
        data, at = text_bytes(column.slice(a, b - a))
        if b - a > 1 or len(data) <= SHARD_BYTES:
            yield data, at
            continue
        start = 0
        while start < len(data):
            stop = min(start + SHARD_BYTES, len(data))
            while stop < len(data) and _KIND[data[stop - 1]] != 2:
                ahead = np.flatnonzero(_KIND[data[stop : stop + SHARD_BYTES]] == 2)
                stop = stop + int(ahead[0]) + 1 if len(ahead) else min(stop + SHARD_BYTES, len(data))
            yield data[start:stop], np.array([0, stop - start])
            start = stop


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    lang, text = batch.column(0).dictionary_encode(), batch.column(1)
    for i, name in enumerate(lang.dictionary.to_pylist()):
        rows = np.flatnonzero(lang.indices.to_numpy() == i)
        yield name, text if len(rows) == len(text) else text.take(pa.array(rows))


def _sampled(longest: int, step: int):
    def run(batches):
        for batch in batches:
            for lang, texts in _by_lang(batch):
                for data, at in _texts(texts):
                    words, found = windows(data, at, longest)
                    paths, _ = transducer.summed(found, np.ones(len(found), np.int64), len(words))
                    names = words.cast(pa.string()).to_pylist()
                    some = [[names[i - 1] for i in row if i] for row in paths[step // 2 :: step].tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.list_(pa.string()))], names=["lang", "path"])

    return tidy(run)


def _boundaries(rows: DataFrame, longest: int) -> list[tuple[bytes, tuple[bytes, ...]]]:
    """Where ranges start, in order: (language, words). One entry less than there are ranges."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(-(-total // RANGE_BYTES), MOST_RANGES)
    if ranges < 2:
        return []
    some = rows.sample(fraction=min(1.0, ranges * SAMPLE_BYTES / total), seed=1).mapInArrow(_sampled(longest, 16), "lang string, path array<string>")
    parts = some.repartitionByRange(ranges, "lang", "path").groupBy(F.spark_partition_id().alias("p"))
    firsts = parts.agg(F.min(F.struct("lang", "path")).alias("first")).collect()
    return sorted({(r["first"]["lang"].encode(), tuple(w.encode() for w in r["first"]["path"])) for r in firsts})[1:]


class Limits(NamedTuple):
    """The boundaries of one language: how many there are before them, their distinct words, their paths as places there."""

    before: int
    words: np.ndarray
    paths: np.ndarray

    def among(self, known: np.ndarray) -> np.ndarray:
        """The paths in the numbers of a shard's ``known`` words: those get even ones, other words the odd ones between."""
        at = np.searchsorted(known, self.words)
        same = known[np.minimum(at, len(known) - 1)] == self.words
        return np.concatenate([[0], 2 * at + np.where(same, 2, 1)])[self.paths + 1]


def _limits(boundaries: list[tuple[bytes, tuple[bytes, ...]]], longest: int) -> dict[bytes, Limits]:
    """Boundaries by language. Their words are looked for once for each shard, however many boundaries share them."""
    out: dict[bytes, Limits] = {}
    before = 0
    for lang, group in groupby(boundaries, key=lambda b: b[0]):
        own = [path for _, path in group]
        words = sorted({w for path in own for w in path})
        place = {w: k for k, w in enumerate(words)}
        paths = np.full((len(own), longest), -1, np.int64)
        for row, path in zip(paths, own, strict=True):
            row[: len(path)] = [place[w] for w in path]
        out[lang] = Limits(before, np.array(words, object), paths)
        before += len(own)
    return out


def _shard(longest: int, boundaries):
    """Per range and language of a shard one automaton of its windows."""

    def run(batches):
        limits, firsts = boundaries.value
        for batch in batches:
            for lang, texts in _by_lang(batch):
                name = lang.encode()
                own = limits.get(name)
                before = own.before if own else bisect.bisect_left(firsts, name)
                for data, at in _texts(texts):
                    words, found = windows(data, at, longest)
                    if not len(found):
                        continue
                    known = np.array(words.cast(pa.binary()).to_pylist(), object)
                    edge = own.among(known) if own else np.zeros((0, longest), np.int64)
                    paths, counts = transducer.summed(found, np.ones(len(found), np.int64), len(words))
                    both = transducer.keys(np.concatenate([edge, 2 * paths]), 2 * len(words) + 1)
                    order = transducer.in_order(both)
                    is_edge = order < len(edge)
                    passed = np.cumsum(is_edge)[~is_edge]
                    starts = np.flatnonzero(np.concatenate([[True], passed[1:] != passed[:-1]]))
                    ends = np.append(starts[1:], len(passed))
                    blobs = [transducer.written(words, paths[a:b], counts[a:b]) for a, b in zip(starts, ends, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(passed[starts] + before, pa.int32()), pa.array([lang] * len(blobs), pa.string()), pa.array(blobs, pa.binary())],
                        names=["bucket", "lang", "paths"],
                    )

    return tidy(run)


def _counted(least: int):
    """Unite the automata of each range and language; give out the states that count."""

    def states(lang: str, several: list) -> Iterator[pa.RecordBatch]:
        words, paths, counts = transducer.union(several)
        names = words.cast(pa.string()).to_pylist()
        length, phrase, weight = [0], [""], [int(counts.sum())]
        for k in range(1, paths.shape[1] + 1):
            found, f, edge = transducer.states(paths, counts, k)
            keep = (f >= least) | edge
            length += [k] * int(keep.sum())
            phrase += [" ".join([names[i - 1] for i in row]) for row in found[keep].tolist()]
            weight += f[keep].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(length), pa.string()), pa.array(length, pa.int32()), pa.array(phrase, pa.string()), pa.array(weight, pa.int64())],
            names=["lang", "length", "phrase", "f"],
        )

    def run(batches):
        at, held, n = None, [], 0
        for batch in batches:
            for bucket, lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if at != (bucket, lang):
                    if held:
                        yield from states(at[1], held)
                    at, held, n = (bucket, lang), [], 0
                held.append(transducer.read(data.as_buffer().to_pybytes()))
                n += len(held[-1][1])
                if n > UNITE_PATHS and len(held) > 1:
                    words, paths, counts = transducer.union(held)
                    held, n = [(words.to_pylist(), paths, counts)], 0
        if held:
            yield from states(at[1], held)

    return tidy(run)


def sequence_counts(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, length, phrase, f): all sequences with ``least`` occurrences; of length 0 the number of words."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text IS NOT NULL")
    found = _boundaries(rows, longest)
    shared = spark.sparkContext.broadcast((_limits(found, longest), [lang for lang, _ in found]))
    shards = rows.mapInArrow(_shard(longest, shared), "bucket int, lang string, paths binary")
    tasks = min(len(found) + 1, 100_000)
    ranges = shards.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)).cast("int")).sortWithinPartitions("bucket", "lang")
    counted = ranges.mapInArrow(_counted(least), "lang string, length int, phrase string, f long")
    return counted.groupBy("lang", "length", "phrase").agg(F.sum("f").alias("f")).where((F.col("length") == 0) | (F.col("f") >= least))


def _composed(longest: int):
    """Counts of the asked sequences of a bucket, along the automaton of its counted ones."""

    def labels(words: list[bytes], place: dict[bytes, int], lang: list[str], phrase: list[str]) -> np.ndarray:
        out = np.zeros((len(phrase), longest + 1), np.int64)
        for i, (own, text) in enumerate(zip(lang, phrase, strict=True)):
            path = [b"\t" + own.encode(), *text.encode().split(b" ")]
            out[i, : len(path)] = [place.get(w, -1) for w in path]
        return out

    def run(asked: pa.Table, counted: pa.Table) -> pa.Table:
        lang, phrase = counted.column("lang").to_pylist(), counted.column("phrase").to_pylist()
        words = sorted({b"\t" + x.encode() for x in lang} | {w for p in phrase for w in p.encode().split(b" ")})
        place = {w: i + 1 for i, w in enumerate(words)}
        paths, counts = transducer.summed(labels(words, place, lang, phrase), counted.column("f").to_numpy(), len(words))
        walk = transducer.Lookup(paths, counts, len(words))
        f = walk.walk(labels(words, place, asked.column("lang").to_pylist(), asked.column("part").to_pylist())) if len(asked) else np.zeros(0, np.int64)
        return pa.table({"chunk": asked.column("chunk"), "lang": asked.column("lang"), "part": asked.column("part"), "f": pa.array(f)})

    return run


def phrase_scores(counts: DataFrame, longest: int = LONGEST, inside: int = INSIDE) -> DataFrame:
    """Of the sequences of :func:`sequence_counts`, the candidates that stay: lang, phrase, a, l, r, n, score."""
    spark = counts.sparkSession
    # As many groups as tasks, so that a part that most candidates have in common is asked for in each of them once.
    chunks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    totals = counts.where("length = 0").select(F.col("lang").alias("_lang"), F.col("f").alias("n"))
    if totals.count() <= FEW_LANGS:
        totals = F.broadcast(totals)
    held = counts.where("length > 0")
    buckets = max(chunks, -(-held.count() // LOOKUP_ROWS))
    phrases = held.where("length > 1").withColumn("words", F.split("phrase", " ")).withColumn("chunk", F.pmod(F.xxhash64("lang", "phrase"), F.lit(chunks)).cast("int"))
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), "words", "chunk", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "chunk", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"),
    )
    asks = cuts.select("chunk", "lang", F.explode(F.array("left", "right")).alias("part")).distinct()
    bucket = lambda part: F.pmod(F.xxhash64("lang", part), F.lit(buckets)).cast("int").alias("bucket")
    asked = asks.select("*", bucket("part")).groupBy("bucket")
    known = held.select("lang", "phrase", "f", bucket("phrase")).groupBy("bucket")
    answers = stored(asked.cogroup(known).applyInArrow(_composed(longest), "chunk int, lang string, part string, f long"), "part-counts")
    found = cuts
    for side, name in (("left", "l"), ("right", "r")):
        own = answers.select("chunk", "lang", F.col("part").alias(side), F.col("f").alias(name))
        found = found.join(own, ["chunk", "lang", side])
    found = found.join(totals, F.col("lang") == F.col("_lang"))
    exact = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    # Counts of up to 10**15 and 10**16: all products fit 38 digits.
    over, under = F.lit(1000).cast("decimal(4,0)") * exact("a", 16) * exact("n", 16), exact("l", 16) * exact("r", 16)
    scored = found.withColumn("over", over).withColumn("under", under).withColumn("score", F.expr("over div under").cast("long"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # A longer candidate around a phrase has at most as many occurrences as one that is longer by one word.
    ends = [F.array_join(F.slice("words", start, F.size("words") - 1), " ") for start in (1, 2)]
    longer = phrases.where("length > 2").select("lang", F.explode(F.array(*ends)).alias("phrase"), "f")
    around = longer.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    stays = F.col("around").isNull() | (F.lit(100) * F.col("around") < F.lit(inside) * F.col("a"))
    return best.join(around, ["lang", "phrase"], "left").where(stays).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, top: int = TOP
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    counts = stored(sequence_counts(docs, lang, text, longest, least), "sequences")
    scores = phrase_scores(counts, longest, inside)
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    # A language's best are among the best of its groups, so no task sorts a whole language.
    heat = F.pmod(F.xxhash64("phrase"), F.lit(HEATS))
    near = scores.withColumn("heat", heat).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "heat").orderBy(*order)))
    final = near.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return final.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_OP11 = rf"""WITH pieces AS (
    SELECT COALESCE(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
  totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
  grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS phrase
            FROM worded, range(1, {LONGEST} + 1) AS lengths(k) WHERE len(w) >= k),
  f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
  cuts AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
  scored AS (SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, n,
                    (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
             FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
             JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')
             JOIN totals t ON t.lang = c.lang),
  best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
  parts AS (SELECT lang, f, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda p: array_to_string(string_split(phrase, ' ')[p:p + m - 1], ' '))))) AS part
            FROM f WHERE k > 2),
  around AS (SELECT lang, part, max(f) AS most FROM parts GROUP BY ALL),
  stays AS (SELECT b.* FROM best b LEFT JOIN around p ON p.lang = b.lang AND p.part = b.phrase WHERE most IS NULL OR 100 * most < {INSIDE} * a)
  SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM stays
  WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= {TOP}"""
