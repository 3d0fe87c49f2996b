"""Records of large CSV files whose quoted fields may hold line breaks, found in parallel.

A file is read by lines, in byte ranges. What a line does to the reader is a
function of two states: a line that starts outside a quoted field ends outside or
inside one, and so does a line that starts inside. Lines compose to ranges,
ranges to files, and so every range learns in which state it starts. A task then
owns the records that start in its range; what a record has beyond the range's
end is stitched on afterwards.

The tasks that compose lines need them in file order, which no SQL operator
keeps without a shuffle of all lines; they run as ``mapInArrow`` over whole
batches. Quotes count only where a field starts, as the CSV reader has it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerloom.session import stored

# A quoted field from its first quote to its last; a doubled quote is part of it.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'
_REST = '^[^"]*+(?:""[^"]*+)*+"'
_OPENS = '(?:^|,)[ \\t]*+"'
RECORD = "file string, block bigint, row bigint, record string"
#: Bytes of lines worth a task of their own; a task takes several ranges where they are smaller.
TASK_BYTES = 32 << 20


def _ends_inside(text: Column) -> Column:
    """Whether a line that starts outside a quoted field ends inside one."""
    closed = F.regexp_replace(text, f"(^|,)[ \\t]*+{_QUOTED}", "$1")
    return closed.rlike(_OPENS).cast("int")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their place and both ends of their function: f0 from outside, f1 from inside.

    A task reads whole ranges one after the other, so that small ones do not
    cost the start of a task and a Python worker's turn each.
    """
    line = F.col("value")
    has = line.contains('"')
    inside = ~line.rlike(_REST)
    after = F.concat(F.lit("x"), F.regexp_replace(line, _REST, ""))
    raw = spark.read.option("lineSep", "\n").text(path)
    tasks = max(-(-_listed(spark, path, F.sum) // TASK_BYTES), spark.sparkContext.defaultParallelism)
    lines = raw.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.when(has, _ends_inside(line)).otherwise(0).cast("byte").alias("f0"),
        F.when(has & ~inside, _ends_inside(after)).otherwise(1).cast("byte").alias("f1"),
    )
    return lines.coalesce(tasks)


def _states(f0: np.ndarray, f1: np.ndarray, start: int) -> np.ndarray:
    """State before each line and after the last one (one more than there are lines)."""
    fixed, swaps = f0 == f1, f0 > f1
    n = np.arange(len(f0))
    last = np.maximum.accumulate(np.where(fixed, n, -1)) if len(f0) else n
    turned = np.concatenate([[0], np.cumsum(swaps)])
    base = np.where(last >= 0, f0[last], start)
    since = turned[1:] - np.where(last >= 0, turned[last + 1], 0)
    return np.concatenate([[start], (base + since) % 2]).astype(np.int8)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, block, first row, end row) of each range that a batch holds rows of."""
    file, block = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
    code = file.indices.to_numpy()
    cuts = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(code)], strict=True):
        if b > a:
            yield file.dictionary[code[a]].as_py(), int(block[a]), a, b


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The function of each range, from the functions of its lines."""
    at, ends = None, (0, 1)

    def done():
        return pa.RecordBatch.from_pydict({"file": [at[0]], "block": pa.array([at[1]], pa.int64()), "g0": pa.array([ends[0]], pa.int8()), "g1": pa.array([ends[1]], pa.int8())})

    for batch in batches:
        f0, f1 = (batch.column(c).to_numpy() for c in ("f0", "f1"))
        for file, block, a, b in _runs(batch):
            if at != (file, block):
                if at:
                    yield done()
                at, ends = (file, block), (0, 1)
            own = [int(_states(f0[a:b], f1[a:b], s)[-1]) for s in (0, 1)]
            ends = (own[ends[0]], own[ends[1]])
    if at:
        yield done()


def _key(file: str | Column, block: int | Column) -> Column:
    return F.xxhash64(file, block)


def _inside_starts(lines: DataFrame) -> np.ndarray:
    """Keys, in order, of the ranges that start inside a quoted field.

    At most one number for each range that is not the first of its file, so 8
    bytes for each ``spark.sql.files.maxPartitionBytes`` of the input.
    """
    ranges = lines.select("file", "block", "f0", "f1").mapInArrow(_composed, "file string, block bigint, g0 byte, g1 byte")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("g0") == F.col("g1")
    ranges = ranges.withColumn("part", F.coalesce(F.count_if(fixed).over(before), F.lit(0)))
    ranges = ranges.withColumn("base", F.coalesce(F.last(F.when(fixed, F.col("g0")), True).over(before), F.lit(0)))
    # Swaps since the last range that fixes the state: those of ranges with the same count of fixed ones before them.
    since = Window.partitionBy("file", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.count_if(F.col("g0") > F.col("g1")).over(since), F.lit(0))
    start = (F.col("base") + swaps) % 2
    found = ranges.select(_key("file", "block").alias("key"), start.alias("start")).where("start = 1").select("key").toArrow()
    return np.sort(found.column("key").to_numpy())


def _records(starts):
    """Whole records of a range, and of those that cross its edges the part inside it.

    ``kind`` 0 is a whole record, 1 the start of one, 2 the end, 3 a part without either.
    """
    names = ["file", "block", "row", "kind", "record"]

    def run(batches):
        at, state, row, held = None, 0, 0, []

        def piece(kind: int):
            text = "\n".join(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([row], pa.int64()), pa.array([kind], pa.int8()), pa.array([text], pa.string())], names=names
            )

        first = True  # whether the lines held so far began before the range
        for batch in batches:
            value = batch.column("value")
            f0, f1, key = (batch.column(c).to_numpy() for c in ("f0", "f1", "key"))
            for file, block, a, b in _runs(batch):
                if at != (file, block):
                    if at and held:
                        yield piece(3 if first and row == 0 else 1)
                    at, row, held = (file, block), 0, []
                    place = np.searchsorted(starts.value, key[a])
                    state = int(place < len(starts.value) and starts.value[place] == key[a])
                    first = state == 1
                states = _states(f0[a:b], f1[a:b], state)
                closes = np.flatnonzero(states[1:] == 0)
                opens = np.concatenate([[0], closes[:-1] + 1]) if len(closes) else closes
                if len(closes):
                    if held or first:
                        held += value.slice(a, int(closes[0]) + 1).to_pylist()
                        yield piece(2 if first and row == 0 else 0)
                        row, held, first = row + 1, [], False
                        opens, closes = opens[1:], closes[1:]
                    alone = opens == closes
                    text = value.slice(a, b - a)
                    if alone.all():
                        texts = text.take(pa.array(opens)) if len(opens) != len(text) else text
                    else:
                        lines = text.to_pylist()
                        texts = pa.array(["\n".join(lines[i : j + 1]) for i, j in zip(opens.tolist(), closes.tolist(), strict=True)], pa.string())
                    n = len(opens)
                    if n:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([at[0]] * n), pa.array([at[1]] * n, pa.int64()), pa.array(np.arange(row, row + n)), pa.array(np.zeros(n, np.int8)), texts], names=names
                        )
                        row += n
                    tail = int(np.flatnonzero(states[1:] == 0)[-1]) + 1
                else:
                    tail = 0
                held += value.slice(a + tail, b - a - tail).to_pylist()
                state = int(states[-1])
        if at and held:
            yield piece(3 if first and row == 0 else 1)

    return run


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, row, record): the records of the files, header lines and blank records left out.

    ``block`` is the byte at which the range starts in which the record starts,
    ``row`` its number there. Two passes over the lines; only records that cross
    the end of a range are shuffled.
    """
    lines = _lines(spark, path)
    starts = spark.sparkContext.broadcast(_inside_starts(lines))
    found = lines.withColumn("key", _key("file", "block")).mapInArrow(_records(starts), "file string, block bigint, row bigint, kind byte, record string")
    parts = stored(found, "csv-records")
    whole = parts.where("kind = 0").drop("kind")
    # Parts without a start belong to the last start before them in the file.
    before = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("kind") == 1, F.struct("block", "row")), True).over(before)
    crossing = parts.where("kind > 0").withColumn("owner", owner)
    stitched = crossing.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("block", "row", "record"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
    stitched = stitched.select("file", "owner.block", "owner.row", text.alias("record"))
    records = whole.unionByName(stitched)
    header = (F.col("block") == 0) & (F.col("row") == 0)
    record = F.regexp_replace("record", "\r$", "")
    return records.where(~header).withColumn("record", record).where(F.trim("record") != "")


def largest_file(spark: SparkSession, path: str | list[str]) -> int:
    """Bytes of the largest file below ``path``, from the listing alone."""
    return _listed(spark, path, F.max)


def _listed(spark: SparkSession, path: str | list[str], of: Callable[[str], Column]) -> int:
    listed = spark.read.format("binaryFile").load(path).select("length")
    return listed.agg(of("length")).first()[0] or 0
