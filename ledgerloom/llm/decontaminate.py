"""Benchmark decontamination: word windows of benchmark items found in training texts.

Only DataFrame operations: texts are split, every window of words is hashed, and
a broadcast hash table of the benchmark's windows is asked for it. What it finds
is compared word by word before it counts.

Words are runs of digits, letters a-z (A-Z lower-cased) and all characters
outside ASCII. A window is ``size`` consecutive words of an item; an item of
fewer words is one window of its own. A document's word is hit if it lies in an
occurrence of any window.

Cases: a NULL or empty text has no words and is never hit. Items without words
have no window; windows of an item whose id is NULL hit words, but such an item
cannot be named and is not counted. Repeated items and repeated documents are
fine: an item id counts once, each row of ``documents`` gives a row. Empty tables
give no rows or no hits. Columns of the inputs never clash with the operator's
own: they travel in one struct. One text is held whole by its task, as its words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.llm.common import table
from ledgerloom.session import stored

SIZE = 10
# The classes of characters that the definition of a word names.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A table of windows that is broadcast takes about this much; larger benchmarks are met part by part.
BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 200


def words(text: Column) -> Column:
    """Words of a text; none for NULL."""
    split = F.split(F.translate(text, UPPER, LOWER), BETWEEN)
    return F.coalesce(F.array_remove(split, ""), F.array().cast("array<string>"))


def _windows(benchmark: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(window, key, gram, items): every distinct window with the items that hold it."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("words"))
    items = items.withColumn("n", F.least(F.size("words"), F.lit(size))).where("n > 0")
    grams = items.select("item", "words", "n", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)).alias("at"))
    grams = grams.select("item", F.slice("words", F.col("at"), F.col("n")).alias("gram"))
    found = grams.groupBy("gram").agg(F.collect_set("item").alias("items"))
    numbered = found.select(F.monotonically_increasing_id().alias("window"), F.xxhash64("gram").alias("key"), "gram", "items")
    return stored(numbered, "windows")


def _hits(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """One row (at = -1) per document, and one per verified window of it: (row, doc, n_words, at, n, window).

    Splitting, hashing and asking are one stage; only what is found leaves it.
    """
    held = windows.select("key", "gram", "window")
    places = docs.select("row", "doc", "words", F.explode(F.sequence(F.lit(-1), F.size("words") - 1)).alias("at"))
    if len(lengths) == 1:
        places = places.withColumn("n", F.lit(lengths[0]))
    else:
        places = places.withColumn("n", F.explode(F.array(*[F.lit(n) for n in lengths])))
        places = places.where((F.col("at") >= 0) | (F.col("n") == lengths[0]))
    inside = (F.col("at") >= 0) & (F.col("at") + F.col("n") <= F.size("words"))
    own = F.slice("words", F.greatest(F.col("at"), F.lit(0)) + 1, F.col("n"))
    asked = places.withColumn("ask", F.when(inside, F.xxhash64(own)))
    met = asked.join(F.broadcast(held), F.col("ask") == F.col("key"), "left")
    # After the join, so that words are compared for windows that were found only.
    verified = F.col("window").isNotNull() & (F.slice("words", F.col("at") + 1, F.col("n")) == F.col("gram"))
    return met.where((F.col("at") == -1) | verified).select(
        "row", F.when(F.col("at") == -1, F.col("doc")).alias("doc"), F.size("words").alias("n_words"), "at", "n", "window"
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    size: int = SIZE,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per row of ``docs``: ``doc`` (a struct of the columns to ``keep``), n_words, n_hit, spans, items.

    ``spans`` are the maximal runs of hit words as (start, end) places, ``items``
    the ids, as sorted strings, of the items with an occurring window.
    """
    windows = _windows(benchmark, item_id, item_text, size)
    weight = F.octet_length(F.array_join("gram", " ")) + F.lit(_ROW_BYTES)
    lengths, total = windows.agg(F.sort_array(F.collect_set(F.size("gram"))), F.coalesce(F.sum(weight), F.lit(0))).first()
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(c) for c in keep]).alias("doc"), words(F.col(text)).alias("words")
    )
    if total > broadcast_bytes:
        # The benchmark in parts, each of a size that may be broadcast; the rows keep their numbers.
        parts = -(-total // broadcast_bytes)
        numbered = stored(numbered, "numbered")
        some = [windows.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == i) for i in range(parts)]
        each = [_hits(numbered, part, lengths) for part in some]
        hits = reduce(DataFrame.unionByName, [each[0], *[e.where("at >= 0") for e in each[1:]]])
    else:
        hits = _hits(numbered, windows, lengths or [size])
    before = Window.partitionBy("row").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.when(F.col("at") >= 0, F.col("at") + F.col("n"))
    runs = hits.withColumn("end", end).withColumn("reach", F.max("end").over(before))
    runs = runs.withColumn("opens", (F.col("reach").isNull() | (F.col("at") > F.col("reach"))).cast("int"))
    runs = runs.withColumn("run", F.sum("opens").over(upto))
    spans = runs.groupBy("row", "run").agg(
        F.first("doc", True).alias("doc"), F.max("n_words").alias("n_words"),
        F.when(F.max("end").isNotNull(), F.struct(F.min(F.when(F.col("at") >= 0, F.col("at"))).alias("start"), F.max("end").alias("end"))).alias("span"),
        F.collect_set("window").alias("windows"),
    )
    by_doc = spans.groupBy("row").agg(
        F.first("doc", True).alias("doc"), F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_list("span")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"),
    )
    names = windows.select(F.col("window").alias("known"), "items")
    if total <= broadcast_bytes:
        names = F.broadcast(names)
    named = by_doc.select("row", "doc", "n_words", "spans", F.explode_outer("windows").alias("window"))
    named = named.join(names, F.col("window") == F.col("known"), "left")
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]), F.lit(0))
    done = named.groupBy("row").agg(
        F.first("doc").alias("doc"), F.first("n_words").alias("n_words"), F.first("spans").alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return done.select("doc", "n_words", n_hit.alias("n_hit"), "spans", "items")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a window (``mode="documents"``) or
    with the hit words, and what stands between two of them, cut out (``"spans"``).

    The columns of ``docs`` stay as they are; texts that are not hit stay untouched.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode: {mode}")
    found = contamination(docs, benchmark, tuple(docs.columns), text=text, **options)
    if mode == "documents":
        return found.where("n_hit = 0").select("doc.*")
    return found.select(*[
        F.when(F.col("n_hit") > 0, _without(F.col(f"doc.`{c}`"))).otherwise(F.col(f"doc.`{c}`")).alias(c) if c == text else F.col(f"doc.`{c}`").alias(c)
        for c in docs.columns
    ])


def _without(text: Column) -> Column:
    """The text up to each span and from its end on; words and separators alternate."""
    own = F.split(text, BETWEEN.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60"))
    gaps = F.split(text, "[^" + BETWEEN[1:-2].replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60") + "]+")
    # ``own`` starts with "" where the text starts with a separator; ``gaps`` where it starts with a word.
    first = F.when(F.element_at(own, 1) == "", 1).otherwise(0)
    n = F.size(own) - F.when(F.element_at(own, -1) == "", 1).otherwise(0) - first
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def kept(i: Column) -> Column:
        hit = F.exists("spans", lambda s: (s["start"] <= i) & (i < s["end"]))
        inner = F.exists("spans", lambda s: (s["start"] < i) & (i < s["end"]))
        # The separator before word i, then the word.
        return F.concat(F.when(inner, F.lit("")).otherwise(F.get(gaps, i)), F.when(hit, F.lit("")).otherwise(F.get(own, i + first)))

    return F.concat(F.array_join(F.transform(places, kept), ""), F.coalesce(F.get(gaps, n), F.lit("")))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), F.col("n_words").cast(T.LongType()).alias("n_words"), F.col("n_hit").cast(T.LongType()).alias("n_hit"),
        F.size("items").cast(T.LongType()).alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = rf"list_filter(string_split_regex(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}'), lambda w: w <> '')"

ORACLE_OP13 = f"""WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
  windows AS (
    SELECT DISTINCT item_id, least(len(w), {SIZE}) AS n, array_to_string(w[p:p + least(len(w), {SIZE}) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), {SIZE}) + 2)) AS p FROM items WHERE len(w) > 0)),
  docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
  places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
  hits AS (SELECT r, p, h.n, item_id FROM places h JOIN windows i ON array_to_string(w[p:p + h.n - 1], ' ') = gram AND h.n = i.n),
  covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
  named AS (SELECT r, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY r)
  SELECT doc_id, len(w) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
         sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
  FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""
