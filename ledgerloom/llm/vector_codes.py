"""Vectors as short codes: one codebook entry for each part of a vector.

A task takes its vectors in chunks. Of each part of a chunk it sorts the integer
pieces along a Hilbert curve and cuts them into flat blocks, each with its box
(least and largest value per coordinate) and its sum; chunks are stored once. In
every round a block compares its box with the codebook: an entry whose nearest
corner is farther than another's farthest corner is nearest to none of its
pieces. What is left is the block's shortlist. A shortlist of one takes the whole
block by its stored sum; else an integer kernel compares the pieces with the
shortlist alone. Rounds exchange sums and counts per entry only.

All numbers are integers; 32 or 64 bits are used as the values of a chunk allow.

Cases: vectors that are NULL or hold NULL or non-finite components are dropped.
All kept vectors are as long as the first one by id (ties by the vector, NULL ids
last); vectors of another length have no place in its codebooks and are dropped
too. Parts are cut at ``i * length // parts``, so they differ by one where the
length is no multiple, and a vector without components has empty parts, entry 0
and error 0. Fewer vectors than entries give smaller codebooks. Repeated rows
count and come back as often as they are there. Components beyond 2**24, whose
distances might not fit a long, are an error. Empty tables give no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import bounded_batches, table, tidy
from ledgerloom.llm.hilbert import hilbert_order
from ledgerloom.session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK = 32
CHUNK_ROWS, CHUNK_BYTES = 65_536, 16 << 20
LARGEST = 1 << 24
#: A label is common if it holds this share of the rows: there are at most 1,000 such labels.
COMMON = 1000

CHUNK = "ids array<bigint>, pieces binary, orders binary, boxes binary, sums binary, wide int"


class Shape(NamedTuple):
    """How vectors of one length are cut."""

    length: int
    parts: int

    @property
    def cuts(self) -> list[tuple[int, int]]:
        return [(i * self.length // self.parts, (i + 1) * self.length // self.parts) for i in range(self.parts)]


def integers(column: pa.Array, length: int, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors of one length, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), length)
    if flat.size and np.abs(flat).max() * scale > LARGEST:
        raise ValueError(f"components beyond {LARGEST / scale:g} cannot be coded")
    return np.floor(flat * scale).astype(np.int64)


class Blocks:
    """One part of a chunk: pieces in Hilbert order, blocks of ``BLOCK`` pieces with boxes and sums."""

    def __init__(self, pieces: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray) -> None:
        self.pieces, self.order, self.low, self.high, self.sums = pieces, order, low, high, sums

    @classmethod
    def build(cls, pieces: np.ndarray) -> Blocks:
        order = hilbert_order(pieces)
        pieces = pieces[order]
        starts = np.arange(0, len(pieces), BLOCK)
        ends = np.stack([f.reduceat(pieces, starts, axis=0) for f in (np.minimum, np.maximum, np.add)])
        return cls(pieces, order, *ends)

    def counts(self) -> np.ndarray:
        n = len(self.pieces)
        return np.minimum(BLOCK, n - np.arange(0, n, BLOCK))

    def shortlists(self, book: np.ndarray) -> np.ndarray:
        """(blocks, entries): whether an entry may be nearest to a piece of the block."""
        near = np.empty((len(self.low), len(book)), np.int64)
        far = np.empty_like(near)
        for e, entry in enumerate(book):
            below, above = self.low - entry, entry - self.high
            outside = np.maximum(np.maximum(below, above), 0)
            corner = np.maximum(np.abs(below), np.abs(above))
            near[:, e] = np.einsum("ij,ij->i", outside, outside)
            far[:, e] = np.einsum("ij,ij->i", corner, corner)
        return near <= far.min(axis=1, keepdims=True)

    def nearest(self, book: np.ndarray, blocks: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the given blocks, their nearest entry (the lower one of equals) and its squared distance."""
        n, width = self.pieces.shape
        rows = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        real = rows < n
        rows = np.minimum(rows, n - 1)
        # 32 bits hold every distance of these pieces where the widest one does.
        most = int(max(np.abs(self.low[blocks]).max(initial=0), np.abs(self.high[blocks]).max(initial=0), np.abs(book).max(initial=0)))
        kind = np.int32 if 4 * most * most * max(width, 1) < 1 << 31 else np.int64
        own, book = self.pieces[rows].astype(kind).reshape(len(blocks), BLOCK, width), book.astype(kind)
        best, least = np.zeros((len(blocks), BLOCK), np.int8), np.full((len(blocks), BLOCK), np.iinfo(kind).max, kind)
        for e, entry in enumerate(book):
            at = np.flatnonzero(listed[blocks, e])
            if len(at):
                apart = own[at] - entry
                distance = np.einsum("ijk,ijk->ij", apart, apart)
                closer = distance < least[at]
                least[at] = np.where(closer, distance, least[at])
                best[at] = np.where(closer, e, best[at])
        return rows[real], best.ravel()[real], least.ravel()[real].astype(np.int64)

    def add_to(self, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add every piece to the sum and the count of its nearest entry."""
        listed = self.shortlists(book)
        alone = listed.sum(axis=1) == 1
        only = listed[alone].argmax(axis=1)
        np.add.at(sums, only, self.sums[alone])
        np.add.at(counts, only, self.counts()[alone])
        mixed = np.flatnonzero(~alone)
        if len(mixed):
            rows, entry, _ = self.nearest(book, mixed, listed)
            counts += np.bincount(entry, minlength=len(book))
            by = np.argsort(entry, kind="stable")
            at = np.searchsorted(entry[by], np.arange(len(book)))
            held = np.bincount(entry, minlength=len(book)) > 0
            if held.any():
                sums[held] += np.add.reduceat(self.pieces[rows[by]], at[held], axis=0)

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and error of every piece, in the chunk's order."""
        rows, entry, error = self.nearest(book, np.arange(len(self.low)), self.shortlists(book))
        out, errors = np.zeros(len(self.pieces), np.int8), np.zeros(len(self.pieces), np.int64)
        out[self.order[rows]], errors[self.order[rows]] = entry, error
        return out, errors


def _packed(shape: Shape, matrix: np.ndarray) -> tuple[bytes, bytes, bytes, bytes, int]:
    """A chunk's blocks as bytes, with the width of its numbers."""
    wide = 2 if not matrix.size or np.abs(matrix).max() < 1 << 15 else 4
    blocks = [Blocks.build(matrix[:, a:b]) for a, b in shape.cuts]
    return (
        b"".join(b.pieces.astype(f"<i{wide}").tobytes() for b in blocks),
        b"".join(b.order.astype("<u4").tobytes() for b in blocks),
        b"".join(np.stack([b.low, b.high]).astype(f"<i{wide}").tobytes() for b in blocks),
        b"".join(b.sums.astype("<i8").tobytes() for b in blocks),
        wide,
    )


def _unpacked(shape: Shape, n: int, row: dict) -> Iterator[Blocks]:
    wide, m = row["wide"], -(-n // BLOCK)
    pieces, orders = np.frombuffer(row["pieces"], f"<i{wide}"), np.frombuffer(row["orders"], "<u4").reshape(shape.parts, n)
    boxes, sums = np.frombuffer(row["boxes"], f"<i{wide}"), np.frombuffer(row["sums"], "<i8")
    for i, (a, b) in enumerate(shape.cuts):
        w = b - a
        own = pieces[a * n : b * n].reshape(n, w).astype(np.int64)
        box = boxes[2 * a * m : 2 * b * m].reshape(2, m, w).astype(np.int64)
        yield Blocks(own, orders[i], box[0], box[1], sums[a * m : b * m].reshape(m, w))


def _kept(df: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    v = F.col("vector")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    return rows.where(v.isNotNull() & ~bad)


def _first(kept: DataFrame, n: int) -> tuple[int, list]:
    """The length that counts, and the ``n`` smallest rows of that length."""
    order = (F.col("vec_id").asc_nulls_last(), F.col("vector"))
    rows = kept.select("vec_id", "vector")
    first = rows.orderBy(*order).first()
    if first is None:
        return 0, []
    length = len(first["vector"])
    return length, [r["vector"] for r in rows.where(F.size("vector") == length).orderBy(*order).limit(n).collect()]


class VectorCodes:
    """Codebooks fitted to all vectors of ``df``, and the code of each.

    ``books`` is a list with a matrix of integers (entries, width) per part. The
    driver holds them and a round's sums, whose size the parameters fix.
    """

    def __init__(
        self,
        df: DataFrame,
        vec_id: str = "vec_id",
        embedding: str = "embedding",
        label: str = "label",
        parts: int = PARTS,
        entries: int = ENTRIES,
        rounds: int = ROUNDS,
        scale: int = SCALE,
    ) -> None:
        if entries > 127:
            raise ValueError("codebooks have 127 entries at most")
        spark = df.sparkSession
        bounded_batches(spark)
        kept = _kept(df, vec_id, embedding, label)
        length, first = _first(kept, entries)
        self.shape = shape = Shape(length, parts)
        start = integers(pa.array(first, pa.list_(pa.float64())), length, scale) if first else np.zeros((0, 0), np.int64)
        self.books = [start[:, a:b] for a, b in shape.cuts]
        rows = kept.where(F.size("vector") == length)
        self.label_type = rows.schema["label"].dataType
        schema = T.StructType([*T.StructType.fromDDL(CHUNK).fields, T.StructField("labels", T.ArrayType(self.label_type))])
        self.chunks = stored(rows.mapInArrow(_chunks(shape, scale), schema), "vector-chunks")
        for _ in range(rounds if first else 0):
            self._round()

    def _round(self) -> None:
        shape, books = self.shape, self.books

        def sums(batches):
            own = [(np.zeros(b.shape, np.int64), np.zeros(len(b), np.int64)) for b in books]
            for batch in batches:
                for row in batch.to_pylist():
                    for part, blocks in enumerate(_unpacked(shape, len(row["ids"]), row)):
                        blocks.add_to(books[part], *own[part])
            for part, (total, count) in enumerate(own):
                at = np.flatnonzero(count)
                yield pa.RecordBatch.from_pydict({
                    "part": [part] * len(at), "entry": at.tolist(), "n": count[at].tolist(), "total": total[at].tolist(),
                }, schema=SUMS)

        each = self.chunks.drop("labels").mapInArrow(tidy(sums), "part int, entry int, n long, total array<long>")
        wide = each.select("part", "entry", "n", F.posexplode_outer("total").alias("place", "x"))
        found = wide.groupBy("part", "entry", "place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
        new = [b.copy() for b in books]
        for r in found.collect():
            if r["place"] is not None:
                new[r["part"]][r["entry"], r["place"]] = int(r["x"]) // int(r["n"])
        self.books = new

    def codes(self) -> DataFrame:
        """vec_id, label, code and error of every kept vector."""
        shape, books = self.shape, self.books
        schema = T.StructType([*T.StructType.fromDDL("vec_id long, code string, error long").fields, T.StructField("label", self.label_type)])

        def assign(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
                    row = {c: batch.column(c)[i].as_py() for c in ("pieces", "orders", "boxes", "sums", "wide")}
                    code, error = np.zeros((len(ids), shape.parts), np.uint8), np.zeros(len(ids), np.int64)
                    for part, blocks in enumerate(_unpacked(shape, len(ids), row)):
                        code[:, part], errors = blocks.codes(books[part])
                        error += errors
                    text = [row.tobytes().hex() for row in code]
                    yield pa.RecordBatch.from_arrays([ids, pa.array(text, pa.string()), pa.array(error), labels], names=["vec_id", "code", "error", "label"])

        return self.chunks.mapInArrow(tidy(assign), schema)

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and place, as decimal texts between commas."""
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()


SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))])


def _chunks(shape: Shape, scale: int):
    """Batches of vectors as rows of ``CHUNK`` with the labels."""
    most = max(1, min(CHUNK_ROWS, CHUNK_BYTES // (8 * max(shape.length, 1))))

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        column = lambda name: whole.column(name).combine_chunks() if whole.column(name).num_chunks != 1 else whole.column(name).chunk(0)
        pieces, orders, boxes, sums, wide = _packed(shape, integers(column("vector"), shape.length, scale))
        at = pa.array([0, whole.num_rows], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(at, column("vec_id")), *[pa.array([x], pa.binary()) for x in (pieces, orders, boxes, sums)],
                pa.array([wide], pa.int32()), pa.ListArray.from_arrays(at, column("label")),
            ],
            names=["ids", "pieces", "orders", "boxes", "sums", "wide", "labels"],
        )

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                if held and n + part.num_rows > most:
                    yield pack(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield pack(held)

    return tidy(run)


def with_group_sum(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over rows of equal ``group``, NULL being one group.

    Groups with a thousandth of the rows or more, a thousand at most, are
    broadcast; the others, none of them hot, are joined by a shuffle.
    """
    is_null, key = F.col(group).isNull(), F.col(group)
    sums = stored(rows.groupBy(group).agg(F.sum(value).alias(name), F.count("*").alias("_n")), "group-sums")
    total, groups = sums.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count("*")).first()
    common = F.col("_n") * COMMON >= total if groups > COMMON else F.lit(True)
    sums = sums.select(key.alias("_group"), name, common.alias("_common"))
    meets = F.col(group).eqNullSafe(F.col("_group"))
    hot = rows.join(F.broadcast(sums.where("_common")), meets, "left")
    if groups <= COMMON:
        return hot.select(*rows.columns, name)
    rest = hot.where(F.col("_common").isNull()).select(*rows.columns)
    cold = rest.join(sums.where("NOT _common"), meets, "left").select(*rows.columns, name)
    return hot.where("_common").select(*rows.columns, name).unionByName(cold)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = VectorCodes(table(spark, sf_dir, "embeddings"))
    coded = stored(model.codes(), "codes")
    return with_group_sum(coded, "label", "error", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(model.digest()).alias("codebooks_sha256")
    )


def _oracle() -> str:
    """Every round as a query of its own over the integer pieces (long form)."""
    steps = [f"""kept AS (
      SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pieces AS MATERIALIZED (SELECT r, p, d, v[p * (len(v) // {PARTS}) + d + 1] AS x
      FROM kept, range(0, {PARTS}) AS parts(p), range(0, 4096) AS places(d) WHERE d < len(v) // {PARTS}),
    book0 AS MATERIALIZED (SELECT p, r - 1 AS e, d, x FROM pieces WHERE r <= {ENTRIES})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""apart{i} AS (SELECT r, a.p, e, CAST(sum((a.x - b.x) * (a.x - b.x)) AS BIGINT) AS far
          FROM pieces a JOIN book{i} b ON a.p = b.p AND a.d = b.d GROUP BY ALL),
        near{i} AS MATERIALIZED (SELECT r, p, arg_min(e, (far, e)) AS e, min(far) AS far FROM apart{i} GROUP BY r, p)""")
        if i < ROUNDS:
            steps.append(f"""sums{i} AS (SELECT n.p, n.e, d, sum(x) AS s, count(*) AS c FROM near{i} n JOIN pieces USING (r, p) GROUP BY ALL),
            book{i + 1} AS MATERIALIZED (SELECT b.p, b.e, b.d,
              CAST(CASE WHEN s IS NULL THEN b.x ELSE (s - ((s % c) + c) % c) // c END AS BIGINT) AS x
              FROM book{i} b LEFT JOIN sums{i} t ON b.p = t.p AND b.e = t.e AND b.d = t.d)""")
    return "WITH " + ", ".join(steps) + f""",
    coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY r)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           sha256((SELECT string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, d) FROM book{ROUNDS})) AS codebooks_sha256
    FROM kept JOIN coded USING (r)"""


ORACLE_OP12 = _oracle()
