"""Bulk loads that know what they have loaded.

A ledger in the database holds a row for every file of every load. A file whose
path, size and time stand there is skipped without being read; one that only
looks new is compared by the checksum of its content. So repeating a load adds
nothing, and a file that was changed is loaded again, as a whole.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.session import stored
from ledgerloom.sources.csv_files import accepted, check_rows, read_csv_text, rejected
from ledgerloom.sources.store import append_run

LEDGER = "load_history"
LEDGER_COLUMNS = (
    "table_name string, path string, bytes bigint, modified timestamp, checksum string, "
    "status string, run_id string"
)


class Load(NamedTuple):
    """What one load did: files read, files skipped, rows by outcome."""

    loaded: int
    skipped: int
    accepted: int
    rejected: int


def listed_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, bytes, modified) of the files below ``paths``, from the listing alone; files without a byte are left out."""
    listed = spark.read.format("binaryFile").load(paths)
    return listed.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def checksums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, checksum) of each file's content: lines and a sum of their hashes with their length.

    Lines are added up in any order, so a file is read by as many tasks as it
    has ranges.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    total = F.sum(F.xxhash64("value", F.octet_length("value")).cast("decimal(38,0)"))
    return lines.groupBy("path").agg(F.concat_ws(":", F.count("*").cast("string"), total.cast("string")).alias("checksum"))


def ledger(spark: SparkSession, database: str) -> DataFrame:
    """The files of all loads; without rows before the first one."""
    if spark.catalog.tableExists(f"{database}.{LEDGER}"):
        return spark.table(f"{database}.{LEDGER}")
    return spark.createDataFrame([], LEDGER_COLUMNS)


def load_new_files(
    spark: SparkSession,
    paths: str | list[str],
    table: str,
    database: str,
    run_id: str,
    multiline: bool | str = True,
) -> Load:
    """Load the files below ``paths`` that ``table`` does not hold yet.

    Good rows are appended to ``table`` and faulty ones to ``<table>_rejected``,
    both as rows of ``run_id``; the ledger follows last. A load that broke off is
    repeated under its own ``run_id`` and replaces what it had written. A run that
    has finished cannot be used for more files, since those would replace its rows.
    """
    known = ledger(spark, database).where(F.col("table_name") == table)
    files = listed_files(spark, paths)
    before = known.select("path", "bytes", "modified").distinct()
    strange = files.join(before, ["path", "bytes", "modified"], "left_anti").collect()
    total = files.count()
    if not strange:
        return Load(0, total, 0, 0)
    if not known.where(F.col("run_id") == f"{run_id}.{table}").isEmpty():
        raise ValueError(f"run {run_id} has already loaded files into {table}")
    held = known.select("path", "checksum", F.lit(True).alias("held")).distinct()
    marked = checksums(spark, [r["path"] for r in strange]).join(held, ["path", "checksum"], "left")
    # As many rows as the listing that Spark itself keeps of these files.
    sums = {r["path"]: (r["checksum"], r["held"]) for r in marked.collect()}
    fresh = [path for path, (_, same) in sums.items() if not same]
    good = bad = 0
    if fresh:
        checked = stored(check_rows(read_csv_text(spark, fresh, table, multiline), table), "checked")
        append_run(accepted(checked, table), database, table, run_id)
        append_run(rejected(checked), database, f"{table}_rejected", run_id)
        good, bad = checked.agg(F.count_if(F.col("reject_reason").isNull()), F.count("reject_reason")).first()
    rows = [
        (table, r["path"], r["bytes"], r["modified"], sums[r["path"]][0], "unchanged" if sums[r["path"]][1] else "loaded")
        for r in strange
    ]
    append_run(spark.createDataFrame(rows, LEDGER_COLUMNS.rsplit(",", 1)[0]), database, LEDGER, f"{run_id}.{table}")
    return Load(len(fresh), total - len(fresh), good, bad)
