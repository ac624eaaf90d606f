"""Discovery of source tables and their copy into the raw layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from hashlib import sha1

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .layers import Layer, run_together

SCHEMA_NAME = "dbo"
#: The table of a raw layer that says which files its copies were made from.
MANIFEST = "copied_files"


def discover_files(spark: SparkSession, folder: str, schema: str = SCHEMA_NAME) -> DataFrame:
    """(SchemaName, TableName, Path) of the parquet tables in a folder, in order.

    A table is an entry ``name.parquet`` (a file or a folder of parts) or a folder
    ``name`` of parts; a folder of such entries is a schema of that name. Only entries
    are listed, two levels deep, never the parts of a table.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def entries(place) -> list:
        return [e for e in files.listStatus(place) if not e.getPath().getName().startswith((".", "_"))]

    found = []
    for entry in entries(path):
        name, where = entry.getPath().getName(), entry.getPath().toString()
        if name.endswith(".parquet"):
            found.append((schema, name.removesuffix(".parquet"), where))
        elif entry.isDirectory():
            inside = entries(entry.getPath())
            partitioned = any("=" in e.getPath().getName() for e in inside)
            if partitioned or any(e.isFile() and e.getPath().getName().startswith("part-") for e in inside):
                found.append((schema, name, where))
            else:
                found += [
                    (name, e.getPath().getName().removesuffix(".parquet"), e.getPath().toString())
                    for e in inside if e.isDirectory() or e.getPath().getName().endswith(".parquet")
                ]
    listed = spark.createDataFrame(found, "SchemaName string, TableName string, Path string")
    return listed.orderBy("SchemaName", "TableName")


def discover_database(spark: SparkSession, url: str, options: Mapping[str, str]) -> DataFrame:
    """The same list from a relational source's standard catalogue, over JDBC."""
    query = (
        "SELECT table_schema AS SchemaName, table_name AS TableName FROM information_schema.tables "
        "WHERE table_type = 'BASE TABLE' AND table_schema <> 'information_schema'"
    )
    listed = spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()
    return listed.orderBy("SchemaName", "TableName")


def read_database(
    spark: SparkSession, url: str, table: str, options: Mapping[str, str], split_by: tuple[str, int, int, int] | None = None
) -> DataFrame:
    """One source table. ``split_by`` (numeric column, low, high, parts) reads it in
    parallel ranges; without it a JDBC read is a single task."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split_by:
        column, low, high, parts = split_by
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()


def convert(df: DataFrame, types: Mapping[str, str | DataType]) -> DataFrame:
    """Type conversion on copy: values that do not fit become NULL, over-long
    fractions are cut. Booleans are not taken for numbers."""
    columns = []
    for name, kind in df.dtypes:
        wanted = types.get(name)
        if wanted is None:
            columns.append(F.col(name))
        elif kind == "boolean" and str(wanted) not in ("boolean", "string"):
            raise TypeError(f"{name} is a boolean and does not convert to {wanted}")
        else:
            columns.append(F.col(name).try_cast(wanted).alias(name))
    return df.select(*columns)


def copy_tables(tables: Mapping[str, DataFrame], raw: Layer, at_once: int = 4) -> dict[str, DataFrame]:
    """Verbatim copy of each table ("<schema>.<table>"): data and schema replaced."""
    return run_together({name: lambda n=name, df=df: raw.overwrite(df, n) for name, df in tables.items()}, at_once)


def copy_folder(spark: SparkSession, folder: str, raw: Layer, at_once: int = 4) -> dict[str, DataFrame]:
    """Discover and copy, each table under its own schema. Only names reach the driver."""
    listed = discover_files(spark, folder).collect()
    sources = {f"{r['SchemaName']}.{r['TableName']}": spark.read.parquet(r["Path"]) for r in listed}
    return copy_tables(sources, raw, at_once)


def source_files(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """(table_name, path, length, modified) of the files of each table (name -> its place).
    Spark lists them; nothing of their content is read."""
    listed = [
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(place)
        .select(F.lit(name).alias("table_name"), "path", "length", F.col("modificationTime").alias("modified"))
        .where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]"))
        for name, place in tables.items()
    ]
    return reduce(DataFrame.unionByName, listed)


def _mark(raw: Layer, table: str) -> str:
    """What stands in the manifest for the present version of a copy; "" if there is none."""
    live = raw.live(table)
    return "" if live is None else sha1(live.text().encode()).hexdigest()


def _compared(now: DataFrame, known: DataFrame | None, marks: Mapping[str, str]) -> DataFrame:
    """The files of now and of the manifest (table_name, path, added, gone); a changed file is there
    as both. Files known for another version of a copy are not known."""
    if known is None:
        before = now.where(F.lit(False))
    else:
        live = now.sparkSession.createDataFrame([*marks.items()], "table_name string, mark string")
        before = known.join(F.broadcast(live), ["table_name", "mark"], "left_semi").select(*now.columns)
    both = now.withColumn("_now", F.lit(True)).join(before.withColumn("_before", F.lit(True)), now.columns, "full_outer")
    return both.select("table_name", "path", F.col("_before").isNull().alias("added"), F.col("_now").isNull().alias("gone"))


def copy_changes(spark: SparkSession, folder: str, raw: Layer, at_once: int = 4) -> DataFrame:
    """Copies what differs since the last call: (table_name, action, files), a row per source table.

    A table whose files are all as the manifest says (path, length and time) is ``kept``; one that
    only got further files is ``extended`` by these, and nothing else of it is read; one with changed or
    missing files, or never copied, is ``copied`` whole, data and schema replaced. So is one
    whose copy something else has written since. ``files`` counts the files that were read.

    The manifest is written after the data and names the version of the copy it belongs to: where a
    run is lost in between, the next one copies that table whole, and never adds a file twice. A
    file that changes while it is copied has another time at the next call. Copies of
    tables that the source has no more stay. The driver gets a row per table and the paths
    of files that are new in a known table.
    """
    listed = discover_files(spark, folder).collect()
    places = {f"{r['SchemaName']}.{r['TableName']}": r["Path"] for r in listed}
    shown = "table_name string, action string, files long"
    if not places:
        return spark.createDataFrame([], shown)
    # the files as they are before anything is copied
    now = raw.overwrite(source_files(spark, places), f"{MANIFEST}_now")
    known = raw.table(MANIFEST) if raw.exists(MANIFEST) else None
    compared = _compared(now, known, {t: _mark(raw, t) for t in places})
    counted = compared.groupBy("table_name").agg(
        F.count_if(~F.col("gone")).alias("files"), F.count_if("added").alias("added"), F.count_if("gone").alias("gone")
    )
    found = {r["table_name"]: r for r in counted.collect()}
    kept = {t for t, r in found.items() if not r["added"] and not r["gone"]}
    extended = {t: [] for t, r in found.items() if 0 < r["added"] < r["files"] and not r["gone"]}
    if extended:
        for r in compared.where(F.col("added") & F.col("table_name").isin(*extended)).collect():
            extended[r["table_name"]].append(r["path"])

    def bring(table: str) -> tuple[str, str, int]:
        if table in kept:
            return table, "kept", 0
        if table in extended:
            raw.append(spark.read.option("basePath", places[table]).parquet(*extended[table]), table)
            return table, "extended", len(extended[table])
        raw.overwrite(spark.read.parquet(places[table]), table)
        return table, "copied", found[table]["files"] if table in found else 0

    done = run_together({t: lambda t=t: bring(t) for t in places}, at_once)
    written = [t for t, action, _ in done.values() if action != "kept"]
    if written:
        marks = spark.createDataFrame([(t, _mark(raw, t)) for t in written], "table_name string, mark string")
        raw.swap_days(now.join(F.broadcast(marks), "table_name"), MANIFEST, "table_name", written)
    raw.drop(f"{MANIFEST}_now")
    return spark.createDataFrame([done[t] for t in sorted(done)], shown)
