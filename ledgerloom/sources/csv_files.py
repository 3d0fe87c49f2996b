"""CSV bulk load with a quarantine, and CSV write."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.sources.csv_ranges import csv_records, largest_file
from ledgerloom.sources.schemas import RAW_TABLES, Field, text_schema

# Field texts that mean NULL, and the options of the file format.
NULL_TOKENS = ("NULL", "null", "")
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
}


def read_csv_text(
    spark: SparkSession, path: str | list[str], table: str, multiline: bool | str = True
) -> DataFrame:
    """Read files as text columns plus ``ingest_order``, the place of the row.

    Short rows are padded with NULL, extra fields are dropped. Quoted fields may
    hold line breaks: a file of one scan range is read by one task, larger ones
    are read range by range (``csv_ranges``). ``multiline="ranges"`` asks for that
    way at any size. ``multiline=False`` is one pass less, for files that are
    known to have no such fields.
    """
    schema = text_schema(table)
    if multiline == "ranges" or multiline and largest_file(spark, path) > _range_bytes(spark):
        records = csv_records(spark, path)
        options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
        ddl = ", ".join(f"`{f.name}` string" for f in schema)
        row = F.from_csv("record", ddl, options)
        raw = records.select(row.alias("fields"), *_PLACE).select("fields.*", *_PLACE)
        return raw.select(*_nulled(table), F.struct(*_PLACE).alias("ingest_order"))
    raw = (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS)
        .option("multiLine", str(bool(multiline)).lower())
        .csv(path)
    )
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select(*_nulled(table), place.alias("ingest_order"))


_PLACE = ("file", "block", "row")


def _range_bytes(spark: SparkSession) -> int:
    """Bytes of a scan range; files of more are worth more than one task."""
    said = spark.sql("SET spark.sql.files.maxPartitionBytes").first()["value"]
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", said.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _nulled(table: str) -> list[Column]:
    return [
        F.when(~F.col(f.name).isin(*NULL_TOKENS), F.col(f.name)).alias(f.name)
        for f in RAW_TABLES[table]
    ]


def header_echo(table: str) -> Column:
    """True for a row that repeats the header line."""
    same = [F.lower(F.col(f.name)) == f.name.lower() for f in RAW_TABLES[table]]
    return F.coalesce(reduce(lambda a, b: a & b, same), F.lit(False))


def _fault(field: Field) -> Column:
    value = F.col(field.name)
    if isinstance(field.dtype, T.StringType):
        return F.when(F.length(value) > field.width, F.lit(f"too_long:{field.name}"))
    return F.when(
        value.isNotNull() & value.try_cast(field.dtype).isNull(),
        F.lit(f"bad_number:{field.name}"),
    )


def check_rows(rows: DataFrame, table: str) -> DataFrame:
    """Add ``reject_reason``: NULL for a row that loads, else the first fault."""
    faults = [_fault(f) for f in RAW_TABLES[table]]
    reason = F.when(header_echo(table), F.lit("header_echo")).otherwise(F.coalesce(*faults))
    return rows.withColumn("reject_reason", reason)


def accepted(checked: DataFrame, table: str) -> DataFrame:
    """Rows without a fault, in their declared types."""
    casts = {
        f.name: F.col(f.name).try_cast(f.dtype)
        for f in RAW_TABLES[table]
        if not isinstance(f.dtype, T.StringType)
    }
    return checked.where(F.col("reject_reason").isNull()).drop("reject_reason").withColumns(casts)


def rejected(checked: DataFrame) -> DataFrame:
    """The quarantine: text as read, with the reason."""
    return checked.where(F.col("reject_reason").isNotNull())


def load_csv(
    spark: SparkSession, path: str, table: str, multiline: bool | str = True
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows) of the files under ``path``."""
    checked = check_rows(read_csv_text(spark, path, table, multiline), table)
    return accepted(checked, table), rejected(checked)


def land_csv(
    spark: SparkSession, path: str, table: str, target: str, multiline: bool | str = True
) -> tuple[DataFrame, DataFrame]:
    """Parse the files once into Parquet, split by outcome, and read both parts back."""
    checked = check_rows(read_csv_text(spark, path, table, multiline), table)
    outcome = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
    checked.withColumn("outcome", outcome).write.mode("errorifexists").partitionBy(
        "outcome"
    ).parquet(target)
    shape = T.StructType([*checked.schema.fields, T.StructField("outcome", T.StringType())])
    landed = spark.read.schema(shape).parquet(target)
    good = landed.where(F.col("outcome") == "accepted").drop("outcome")
    bad = landed.where(F.col("outcome") == "rejected").drop("outcome")
    return accepted(good, table), rejected(bad)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a folder of CSV parts, each with a header line."""
    df.write.mode("errorifexists").option("header", "true").option("escape", '"').csv(path)
