"""Tables and views in the catalog: replace, create, append, snapshot, list."""

from __future__ import annotations

import re
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.session import stored


#: Property of tables that share, or have shared, a folder with a clone.
CLONED = "ledgerloom.cloned"


def open_database(spark: SparkSession, name: str, location: str) -> None:
    """Create the database, with its files under ``location``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def database_location(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri


def _new_path(spark: SparkSession, database: str, name: str) -> str:
    return f"{database_location(spark, database)}/{name}-{uuid.uuid4().hex}"


def _point(spark: SparkSession, database: str, name: str, path: str) -> DataFrame:
    table = f"`{database}`.`{name}`"
    shape = spark.read.parquet(path).schema
    if spark.catalog.tableExists(f"{database}.{name}"):
        if spark.table(table).schema.simpleString() == shape.simpleString():
            # One change in the catalog: readers find either the old rows or the new ones.
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return spark.table(table)
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    return spark.table(table)


def replace_table(df: DataFrame, database: str, name: str) -> DataFrame:
    """Write the rows to a new folder, then point the table at it.

    The switch is one step unless the columns change. The old folder stays, so
    ``df`` and readers that have started may still read the table it replaces.
    """
    spark = df.sparkSession
    path = _new_path(spark, database, name)
    df.write.mode("errorifexists").parquet(path)
    return _point(spark, database, name, path)


def create_table(df: DataFrame, database: str, name: str) -> DataFrame:
    """Like ``replace_table``, but an existing table is an error."""
    if df.sparkSession.catalog.tableExists(f"{database}.{name}"):
        raise ValueError(f"table {database}.{name} already exists")
    return replace_table(df, database, name)


def replace_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def publish_views(spark: SparkSession, database: str, views: dict[str, str]) -> None:
    """Create or replace views of the catalog, which other sessions see and which last.

    The values are queries; a view that another one of them reads is made first.
    Names inside the queries are taken in ``database``. Each view changes in one
    step, so readers meet its old query or the new one. A session that has read a
    table keeps its files in mind: ``refreshTable`` shows it what came later.
    """
    made: list[str] = []

    def make(name: str, above: tuple[str, ...] = ()) -> None:
        if name in above:
            raise ValueError(f"views read each other: {' -> '.join((*above, name))}")
        for other in views:
            if other != name and other not in made and re.search(rf"\b{re.escape(other)}\b", views[name]):
                make(other, (*above, name))
        if name not in made:
            spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {views[name]}")
            made.append(name)

    here = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        for name in views:
            make(name)
    finally:
        spark.catalog.setCurrentDatabase(here)


def _facts(spark: SparkSession, table: str, part: str = "") -> dict[str, str]:
    """What the catalog says about a table or a partition beyond its columns."""
    found: dict[str, str] = {}
    for r in spark.sql(f"DESCRIBE EXTENDED {table} {part}").collect():
        # A partition's own facts come before those of its table.
        found.setdefault(r["col_name"], r["data_type"])
    return found


def table_location(spark: SparkSession, database: str, name: str) -> str:
    return _facts(spark, f"`{database}`.`{name}`")["Location"]


def _partitions(spark: SparkSession, database: str, name: str) -> list[str]:
    """PARTITION clauses of a table; none for a table without partitions."""
    table = f"`{database}`.`{name}`"
    if not any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{name}")):
        return []
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    specs = [dict(p.split("=", 1) for p in r["partition"].split("/")) for r in rows]
    return ["PARTITION (" + ", ".join(f"`{k}` = '{v}'" for k, v in spec.items()) + ")" for spec in specs]


def clone_table(spark: SparkSession, database: str, name: str, target: str) -> DataFrame:
    """``target`` with the rows that the table has now, without a copy of them.

    Both point at the same folders. A table that is replaced gets a new folder,
    and one that is appended to leaves a folder it shares, so neither sees what
    happens to the other later. An existing ``target`` that is itself a table is
    replaced.
    """
    source, copy = f"`{database}`.`{name}`", f"`{database}`.`{target}`"
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(source).schema)
    split = [c.name for c in spark.catalog.listColumns(f"{database}.{name}") if c.isPartition]
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in split)})" if split else ""
    parts = [(p, _facts(spark, source, p)["Location"]) for p in _partitions(spark, database, name)]
    spark.sql(f"DROP TABLE IF EXISTS {copy}")
    spark.sql(f"CREATE TABLE {copy} ({shape}) USING parquet {by} LOCATION '{table_location(spark, database, name)}'")
    for table in (source, copy):
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{CLONED}' = 'true')")
    for part, path in parts:
        spark.sql(f"ALTER TABLE {copy} ADD {part} LOCATION '{path}'")
    return spark.table(copy)


def snapshot_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    """The rows of now as ``<name>_backup``; a clone, so that nothing is copied."""
    return clone_table(spark, database, name, f"{name}_backup")


def _tables(spark: SparkSession, database: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary and t.tableType != "VIEW"]


def named_folders(spark: SparkSession) -> set[str]:
    """Folders that some table or partition of the catalog points at."""
    found = set()
    for base in spark.catalog.listDatabases():
        for name in _tables(spark, base.name):
            table = f"`{base.name}`.`{name}`"
            found.add(_plain(table_location(spark, base.name, name)))
            found |= {_plain(_facts(spark, table, p)["Location"]) for p in _partitions(spark, base.name, name)}
    return found


def _plain(uri: str) -> str:
    """A folder's name without the marks that Spark and Hadoop write in different ways."""
    return re.sub(r"^file:/+", "/", uri.rstrip("/"))


_OWN = re.compile(r".+-[0-9a-f]{32}")


def vacuum(spark: SparkSession, database: str, older_than_hours: float = 168.0) -> list[str]:
    """Remove the folders of replaced tables and reruns that no table points at; their names.

    Only folders that this module has made below the database's location are
    looked at, and only those last changed ``older_than_hours`` ago or before,
    since readers and loads of now may use younger ones that no table names yet.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(database_location(spark, database))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    named = named_folders(spark)
    latest = time.time() * 1000 - older_than_hours * 3_600_000
    below = [f for f in fs.listStatus(path) if f.isDirectory()]
    runs = [f for b in below if b.getPath().getName().endswith("-runs") for f in fs.listStatus(b.getPath()) if f.isDirectory()]
    gone = []
    for folder in [*below, *runs]:
        name = _plain(folder.getPath().toString())
        if _OWN.fullmatch(folder.getPath().getName()) and name not in named and folder.getModificationTime() <= latest:
            fs.delete(folder.getPath(), True)
            gone.append(name)
    return sorted(gone)


def append_run(df: DataFrame, database: str, name: str, run_id: str) -> DataFrame | None:
    """Append the rows of one run; no table is made as long as there are none.

    A run that is tried again replaces its own rows, and only those. Its rows are
    written to a folder of their own first; one change in the catalog then makes
    them the run's partition, so readers meet either try, never a gap.
    """
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"run_id must be a plain word: {run_id}")
    spark = df.sparkSession
    table = f"`{database}`.`{name}`"
    rows = df.drop("run_id")
    base = f"{database_location(spark, database)}/{name}-runs"
    path = f"{base}/{run_id}-{uuid.uuid4().hex}"
    rows.write.mode("errorifexists").parquet(path)
    if not spark.catalog.tableExists(f"{database}.{name}"):
        if spark.read.schema(rows.schema).parquet(path).isEmpty():
            return None
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, run_id STRING) USING parquet "
            f"PARTITIONED BY (run_id) LOCATION '{base}'"
        )
    part = f"PARTITION (run_id = '{run_id}')"
    if spark.sql(f"SHOW PARTITIONS {table} {part}").isEmpty():
        spark.sql(f"ALTER TABLE {table} ADD {part} LOCATION '{path}'")
    else:
        spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def append_new_keys(df: DataFrame, database: str, name: str, keys: list[str]) -> DataFrame:
    """Incremental load: add the rows whose key the table does not hold yet.

    Of rows that repeat a key within the load one is added, the same one
    whenever the load is repeated. Rows without a key are all added.

    The table is not read as a whole. ``<name>_key_ranges`` holds the least and
    the largest key of every file of the table; files that cannot hold a key of
    the load are not opened. Loads are written in key order, which keeps the
    ranges narrow. The keys of the other files are thinned out by a semi-join with
    the load, for which Spark makes a Bloom filter where that pays, before they
    meet the load itself.
    """
    spark = df.sparkSession
    place = F.xxhash64(*[F.col(c) for c in df.columns])
    load = first_per_key(df.withColumn("_place", place), keys, "_place").drop("_place")
    if not spark.catalog.tableExists(f"{database}.{name}"):
        return replace_table(_in_key_order(load, keys), database, name)
    held = spark.table(f"{database}.{name}")
    load = stored(load.select(*held.columns), "load")
    files = _files_with_keys(load, database, name, keys)
    if files:
        known = spark.read.schema(held.schema).parquet(*files).select(*keys)
        known = known.join(load.select(*keys).distinct(), keys, "left_semi").distinct()
        load = load.join(known, keys, "left_anti").select(*held.columns)
    location = _own_location(spark, database, name)
    _in_key_order(load, keys).write.mode("append").parquet(location)
    spark.catalog.refreshTable(f"{database}.{name}")
    return spark.table(f"{database}.{name}")


def _in_key_order(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _own_location(spark: SparkSession, database: str, name: str) -> str:
    """The table's folder; where other tables point at it too, a new one with a copy of its rows.

    Only tables that took part in a clone are compared with the rest of the catalog.
    """
    location = table_location(spark, database, name)
    told = spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{name}`").collect()
    if not any(r["key"] == CLONED for r in told):
        return location
    for base in spark.catalog.listDatabases():
        for other in _tables(spark, base.name):
            if (base.name, other) != (database, name) and _plain(table_location(spark, base.name, other)) == _plain(location):
                replace_table(spark.table(f"`{database}`.`{name}`"), database, name)
                return table_location(spark, database, name)
    return location


def key_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """(path, low, high) of the files that ``df`` reads: least and largest key, texts of JSON."""
    key = F.struct(*keys)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    inside = F.when(known, key)
    path = F.regexp_replace("_metadata.file_path", "^file:/+", "/")
    return df.groupBy(path.alias("path")).agg(
        F.to_json(F.min(inside)).alias("low"), F.to_json(F.max(inside)).alias("high")
    )


def _files_with_keys(load: DataFrame, database: str, name: str, keys: list[str]) -> list[str]:
    """Files of the table whose key range meets a key range of the load."""
    spark = load.sparkSession
    held = spark.table(f"{database}.{name}")
    ranges = f"{name}_key_ranges"
    files = spark.createDataFrame([(_plain(f),) for f in held.inputFiles()], "path string")
    if spark.catalog.tableExists(f"{database}.{ranges}"):
        known = spark.table(f"{database}.{ranges}").select("path", "low", "high")
        strange = [r["path"] for r in files.join(known, "path", "left_anti").collect()]
    else:
        known, strange = None, [r["path"] for r in files.collect()]
    if strange:
        # Only files that came since the last load.
        new = key_ranges(spark.read.schema(held.schema).parquet(*strange), keys)
        append_run(new, database, ranges, uuid.uuid4().hex)
        known = spark.table(f"{database}.{ranges}").select("path", "low", "high")
    if known is None:
        return []
    shape = held.select(*keys).schema
    bounds = [F.from_json(c, shape).alias(c) for c in ("low", "high")]
    own = known.join(files, "path", "left_semi").select("path", *bounds)
    # The load in order, cut into as many ranges as a shuffle has partitions.
    parts = load.select(F.struct(*keys).alias("k")).where(reduce(lambda a, b: a & b, [F.col(f"k.`{c}`").isNotNull() for c in keys]))
    cuts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.repartitionByRange(cuts, "k").groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("first"), F.max("k").alias("last"))
    meets = (F.col("low") <= F.col("last")) & (F.col("high") >= F.col("first"))
    return sorted(r["path"] for r in own.join(parts, meets, "left_semi").select("path").distinct().collect())


def materialize(df: DataFrame, name: str, kind: str = "view", database: str = "default") -> DataFrame:
    """Publish a model as a view (the default) or as a table."""
    if kind == "view":
        return replace_view(df, name)
    if kind == "table":
        return replace_table(df, database, name)
    raise ValueError(f"unknown kind: {kind}")


def scan(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Stored Parquet, all columns or those named."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_jdbc(
    spark: SparkSession, options: dict[str, str], split: str, low: str, high: str, parts: int
) -> DataFrame:
    """A table of an outside database, read in ``parts`` ranges of ``split``."""
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("partitionColumn", split)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", str(parts))
        .load()
    )


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``key``."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views that a session sees."""
    where = f" IN `{database}`" if database else ""
    return spark.sql(f"SHOW TABLES{where}").withColumnsRenamed(
        {"namespace": "database_name", "tableName": "table_name", "isTemporary": "is_temporary"}
    )


def list_relations(spark: SparkSession, database: str) -> DataFrame:
    """The catalog as one relation: each column of each table and view, with the kind it is of.

    (relation, kind, position, col_name, data_type); ``kind`` is ``table``,
    ``view`` for one that lasts, or ``temporary view`` for one of this session.
    """
    rows = []
    for t in sorted(spark.catalog.listTables(database), key=lambda t: (t.isTemporary, t.name)):
        kind = "temporary view" if t.isTemporary else "view" if t.tableType == "VIEW" else "table"
        name = f"`{t.name}`" if t.isTemporary else f"`{database}`.`{t.name}`"
        for i, f in enumerate(spark.table(name).schema):
            rows.append((t.name, kind, i + 1, f.name, f.dataType.simpleString()))
    return spark.createDataFrame(rows, "relation string, kind string, position int, col_name string, data_type string")


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")
