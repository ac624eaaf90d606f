"""A layer of the lakehouse: versioned tables under one folder.

Each write makes a new folder of files, a load. What a table consists of is said by one small
file beside its loads, the live note: schema, loads, and the partitions of each that count.
It is swapped last, in one step, so that a reader sees a table as it was before
a write or after it, never between, and a write that fails leaves the table as it was. Nothing
is kept in the catalog: every session that knows the folder finds the same tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Column of load folders where a table has several.
LOAD = "_load"
_NULL = "__HIVE_DEFAULT_PARTITION__"


def stored_name(table: str) -> str:
    return table.replace(".", "__").lower()


@dataclass(frozen=True)
class Load:
    """One write. ``parts`` lists the partition values that still count; None: all of it."""

    id: str
    parts: tuple[str | None, ...] | None = None


@dataclass(frozen=True)
class Live:
    """What a table consists of."""

    version: int
    schema: StructType
    partition: str | None
    loads: tuple[Load, ...]
    before: tuple[str, ...] = ()  # loads of the version before, which running queries may still read

    def text(self) -> str:
        loads = [{"id": one.id, "parts": one.parts} for one in self.loads]
        return json.dumps({
            "version": self.version, "schema": self.schema.jsonValue(), "partition": self.partition, "loads": loads, "before": self.before,
        })

    @staticmethod
    def of(text: str) -> Live:
        said = json.loads(text)
        loads = tuple(Load(one["id"], None if one["parts"] is None else tuple(one["parts"])) for one in said["loads"])
        return Live(said["version"], StructType.fromJson(said["schema"]), said["partition"], loads, tuple(said["before"]))


class Folder:
    """File operations in a folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path
        self._files = self._path(path).getFileSystem(self._conf)

    def read(self, name: str) -> str | None:
        place = self._path(f"{self.path}/{name}")
        if not self._files.exists(place):
            return None
        stream = self._files.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def swap(self, name: str, text: str) -> None:
        """Puts a file in the place of another in one step."""
        fresh = self._path(f"{self.path}/.{name}.{uuid4().hex}")
        stream = self._files.create(fresh, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        over = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
        options = self._jvm.java.lang.reflect.Array.newInstance(over.getClass(), 1)
        options[0] = over
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        context.rename(fresh, self._path(f"{self.path}/{name}"), options)

    def list(self, below: str = "") -> list[str]:
        place = self._path(f"{self.path}/{below}" if below else self.path)
        if not self._files.exists(place):
            return []
        return [s.getPath().getName() for s in self._files.listStatus(place)]

    def remove(self, name: str = "") -> None:
        self._files.delete(self._path(f"{self.path}/{name}" if name else self.path), True)


class Layer:
    """Tables of one layer. A table name with a schema part (``dbo.customers``) is one
    name here, stored as ``dbo__customers``, so that ``a.b_c`` and ``a_b.c`` stay apart.
    Names are the same in upper and lower case."""

    NOTE = "_live.json"

    def __init__(self, spark: SparkSession, database: str, folder: str):
        self.spark = spark
        self.database = database
        self.folder = folder.rstrip("/")
        self._opened: dict[str, tuple[str, DataFrame]] = {}

    # reading

    def place(self, table: str) -> str:
        return f"{self.folder}/{stored_name(table)}"

    def live(self, table: str) -> Live | None:
        """What the table consists of now; None if there is none."""
        said = Folder(self.spark, self.place(table)).read(self.NOTE)
        return None if said is None else Live.of(said)

    def table(self, table: str) -> DataFrame:
        """The table as it is now. The frame keeps reading this version, whatever is
        written later; the files of the version before stay until the write after next."""
        said = Folder(self.spark, self.place(table)).read(self.NOTE)
        if said is None:
            raise ValueError(f"no table {table} in {self.folder}")
        known = self._opened.get(stored_name(table))
        if known is None or known[0] != said:
            known = self._opened[stored_name(table)] = said, self._frame(table, Live.of(said))
        return known[1]

    def _frame(self, table: str, live: Live) -> DataFrame:
        root, columns = self.place(table), [F.col(f"`{c}`") for c in live.schema.names]
        if not live.loads:
            return self.spark.createDataFrame([], live.schema)
        if len(live.loads) == 1 and live.loads[0].parts is None:
            return self.spark.read.schema(live.schema).parquet(f"{root}/{LOAD}={live.loads[0].id}").select(*columns)
        schema = StructType([*live.schema.fields]).add(LOAD, "string")
        paths = [f"{root}/{LOAD}={one.id}" for one in live.loads]
        rows = self.spark.read.schema(schema).option("basePath", root).parquet(*paths)
        return rows.where(reduce(Column.__or__, (_counts(one, live.partition) for one in live.loads))).select(*columns)

    def query(self, table: str, columns: str = "*") -> DataFrame:
        return self.spark.sql(f"SELECT {columns} FROM {{stored}}", stored=self.table(table))

    def expose(self, *tables: str) -> list[str]:
        """Names the listed tables, or all, for SQL in this session: ``<layer>__<table>``."""
        names = []
        for table in tables or self.tables():
            names.append(f"{self.database}__{stored_name(table)}")
            self.table(table).createOrReplaceTempView(names[-1])
        return names

    def exists(self, table: str) -> bool:
        return self.live(table) is not None

    def present(self, tables: Iterable[str]) -> dict[str, DataFrame]:
        """The listed tables that exist."""
        return {t: self.table(t) for t in tables if self.exists(t)}

    def summed(self, table: str, columns: Sequence[str], values: Sequence[str]) -> DataFrame | None:
        """The table's ``values`` summed up by the columns, if it is stored in a form that gives this without its rows."""
        return None

    def numbered(self, table: str, column: str, columns: Sequence[str]) -> DataFrame | None:
        """The ids in ``column`` as bits, if the table is stored in a form that gives this without its rows."""
        return None

    def all(self) -> Mapping[str, DataFrame]:
        """The layer's tables by name, each looked up when first asked for."""
        return _Tables(self)

    def tables(self) -> list[str]:
        return sorted(t for t in Folder(self.spark, self.folder).list() if Layer.exists(self, t))

    # writing

    def _write(self, df: DataFrame, table: str, partition: str | None) -> Load:
        """New files, which no reader sees until they are in the live note."""
        made = Load(uuid4().hex)
        writer = df.write.mode("error").option("compression", "zstd")
        (writer.partitionBy(partition) if partition else writer).parquet(f"{self.place(table)}/{LOAD}={made.id}")
        return made

    def _commit(self, table: str, was: Live | None, live: Live) -> DataFrame:
        """Swaps the live note. Files of loads that neither this version nor the one before
        has are removed. A write that began from an older version than the live one
        raises, and the table stays as it is."""
        folder = Folder(self.spark, self.place(table))
        now = self.live(table)
        if (now.version if now else 0) != (was.version if was else 0):
            raise RuntimeError(f"{table} was written by another session meanwhile")
        before = tuple(one.id for one in was.loads) if was else ()
        folder.swap(self.NOTE, replace(live, version=(was.version if was else 0) + 1, before=before).text())
        for old in set(was.before if was else ()) - set(before) - {one.id for one in live.loads}:
            folder.remove(f"{LOAD}={old}")
        return Layer.table(self, table)

    def _parts(self, table: str, load: Load, partition: str) -> tuple[str | None, ...]:
        """The partition values that a load brought, from its folders' names."""
        names = Folder(self.spark, self.place(table)).list(f"{LOAD}={load.id}")
        values = (unquote(n.split("=", 1)[1]) for n in names if "=" in n and not n.startswith(("_", ".")))
        return tuple(sorted((None if v == _NULL else v for v in values), key=str))

    def overwrite(self, df: DataFrame, table: str, partition_by: Iterable[str] = ()) -> DataFrame:
        """Replace data and schema; ``df`` may read the table itself. Returns the stored
        table, so what follows reads the files and never repeats the work."""
        partition = next(iter(partition_by), None)
        was = self.live(table)
        load = self._write(df, table, partition)
        return self._commit(table, was, Live(0, _stored_schema(df.schema, partition), partition, (load,)))

    def recreate(self, df: DataFrame, table: str) -> DataFrame:
        """Drop, write again, and return the stored row count as a one-row frame."""
        self.drop(table)
        return self.overwrite(df, table).agg(F.count(F.lit(1)).alias("row_count"))

    def append(self, df: DataFrame, table: str) -> DataFrame:
        """Append, matching columns by name. New columns are added to the table, for
        old rows they are NULL; columns the new rows lack are NULL for them."""
        was = self.live(table)
        if was is None:
            return self.overwrite(df, table)
        schema = _evolved(was.schema, df)
        load = self._write(_aligned(df, schema), table, was.partition)
        if was.partition and any(one.parts is not None for one in was.loads):
            load = replace(load, parts=self._parts(table, load, was.partition))
        return self._commit(table, was, replace(was, schema=_stored_schema(schema, was.partition), loads=(*was.loads, load)))

    def replace_days(self, df: DataFrame, table: str, day: str) -> DataFrame:
        """Append by day: days in ``df`` replace the same days in the table, other
        days stay, so loading a file twice changes nothing. Rows are rebalanced by
        day before writing, which also cuts a day that is too big for one task."""
        return self.swap_days(df, table, day, ())

    def swap_days(self, df: DataFrame, table: str, day: str, days: Iterable) -> DataFrame:
        """``replace_days`` that takes the listed days out as well, where ``df`` has no row of
        them, in the same step."""
        return self._exchange(df, table, day, days, replaced=True)

    def swap_parts(self, df: DataFrame, table: str, part: str, gone: Iterable) -> DataFrame:
        """Takes the listed partitions out and adds the rows of ``df``, in one step. Rows that ``df``
        brings to other partitions join what is there."""
        return self._exchange(df, table, part, gone, replaced=False)

    def _exchange(self, df: DataFrame, table: str, day: str, gone: Iterable, replaced: bool) -> DataFrame:
        was = self.live(table)
        if was is None:
            return self.overwrite(df.hint("rebalance", day), table, [day])
        if was.partition != day:
            raise ValueError(f"{table} is stored by {was.partition}, not by {day}")
        schema = _evolved(was.schema, df)
        load = self._write(_aligned(df.hint("rebalance", day), schema), table, day)
        brought = self._parts(table, load, day)
        listed = {None if v is None else str(v) for v in gone}
        kept = self._without(table, was, {*listed, *brought} if replaced else listed)
        new = () if not brought else (replace(load, parts=brought),)
        return self._commit(table, was, replace(was, schema=_stored_schema(schema, day), loads=(*kept, *new)))

    def drop_days(self, table: str, day: str, days: Iterable) -> None:
        """Removes the given partitions, where they exist."""
        was = self.live(table)
        gone = tuple(None if v is None else str(v) for v in days)
        if was is not None and gone:
            self._commit(table, was, replace(was, loads=self._without(table, was, gone)))

    def _without(self, table: str, live: Live, gone: Iterable[str | None]) -> tuple[Load, ...]:
        """The loads without some partitions. The lists are as long as the table has days."""
        gone, kept = set(gone), []
        for one in live.loads:
            parts = one.parts if one.parts is not None else self._parts(table, one, live.partition)
            left = tuple(p for p in parts if p not in gone)
            if len(left) == len(parts):
                kept.append(replace(one, parts=parts))
            elif left:
                kept.append(replace(one, parts=left))
        return tuple(kept)

    def compact(self, table: str) -> DataFrame:
        """The same rows as one load, where many loads have made many small files."""
        live = self.live(table)
        rows = Layer.table(self, table)
        return self.overwrite(rows.hint("rebalance", live.partition) if live.partition else rows, table, filter(None, [live.partition]))

    def vacuum(self, table: str) -> list[str]:
        """Removes the loads that the live note does not name: those of writes that failed, and
        of the version before. Not to be called while others write or read. Returns their names."""
        folder, live = Folder(self.spark, self.place(table)), self.live(table)
        named = {f"{LOAD}={one.id}" for one in live.loads} if live else set()
        gone = sorted(n for n in folder.list() if n.startswith(f"{LOAD}=") and n not in named)
        for name in gone:
            folder.remove(name)
        return gone

    def drop(self, table: str) -> None:
        """The note goes first: a table is gone as a whole, then its files."""
        folder = Folder(self.spark, self.place(table))
        folder.remove(self.NOTE)
        folder.remove()
        self._opened.pop(stored_name(table), None)

    def store_all(self, frames: Mapping[str, DataFrame], at_once: int = 4) -> dict[str, DataFrame]:
        """Overwrite several tables. The writes do not depend on each other, so a few
        run at a time and share the cluster."""
        return run_together({name: lambda n=name, df=df: self.overwrite(df, n) for name, df in frames.items()}, at_once)


def _counts(load: Load, partition: str | None) -> Column:
    """Whether a row's load and partition are live; Spark decides it by folder names alone."""
    of_load = F.col(LOAD) == load.id
    if load.parts is None:
        return of_load
    value = F.col(f"`{partition}`")
    listed = value.cast("string").isin([p for p in load.parts if p is not None])
    return of_load & (F.coalesce(listed, F.lit(False)) | (value.isNull() if None in load.parts else F.lit(False)))


def _stored_schema(schema: StructType, partition: str | None) -> StructType:
    """Nullable down to the inner fields, the partition column last, as files are read."""
    said = schema.json().replace('"nullable":false', '"nullable":true')
    said = said.replace('"containsNull":false', '"containsNull":true').replace('"valueContainsNull":false', '"valueContainsNull":true')
    return StructType(sorted(StructType.fromJson(json.loads(said)).fields, key=lambda f: f.name == partition))


def _evolved(schema: StructType, df: DataFrame) -> StructType:
    known = set(schema.names)
    return StructType([*schema.fields, *(f for f in df.schema.fields if f.name not in known)])


def _aligned(df: DataFrame, schema: StructType) -> DataFrame:
    there = set(df.columns)
    return df.select(*(
        (F.col(f"`{f.name}`") if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ))


class _Tables(Mapping):
    def __init__(self, layer: Layer):
        self._layer = layer
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._layer.table(name)
        return self._opened[name]

    def summed(self, name: str, columns: Sequence[str], values: Sequence[str]) -> DataFrame | None:
        return self._layer.summed(name, columns, values)

    def numbered(self, name: str, column: str, columns: Sequence[str]) -> DataFrame | None:
        return self._layer.numbered(name, column, columns)

    def __iter__(self):
        return iter(self._layer.tables())

    def __len__(self) -> int:
        return len(self._layer.tables())


def run_together(tasks: Mapping[str, Callable], at_once: int = 4) -> dict:
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: future.result() for name, future in futures.items()}
