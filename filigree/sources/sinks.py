"""Writers: tables, generations with an atomic pointer, manifests, CSV. Small files go through the file system of their path, local or shared."""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.functions.money import format_float


class Store:
    """A folder's file system as Hadoop knows it."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._files = root.rstrip("/"), spark._jvm.org.apache.hadoop.fs
        self._jvm, self._gateway, self._conf = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        # An own instance without checksum files, so that other programs may write small files there too.
        self._system = self._files.FileSystem.newInstance(self._files.Path(self.root).toUri(), self._conf)
        self._system.setVerifyChecksum(False)
        self._system.setWriteChecksum(False)

    def path(self, name: str):
        return self._files.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._system.exists(self.path(name))

    def names(self, name: str = "") -> list[str]:
        return sorted(f.getPath().getName() for f in self._system.listStatus(self.path(name))) if self.exists(name) else []

    def read(self, name: str) -> str | None:
        """A small file's text; null where there is none."""
        if not self.exists(name):
            return None
        stream = self._system.open(self.path(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Replaces a small file in one step: the new one is written beside it and then takes its name. If that fails, the old one stays."""
        part = f"{name}.{uuid.uuid4().hex}.part"
        stream = self._system.create(self.path(part), True)
        try:
            self._io.write(text, stream, "UTF-8")
        finally:
            stream.close()
        try:
            self.move(part, name)
        except Exception:
            self.remove(part)
            raise

    def move(self, name: str, to: str) -> None:
        """Gives a file another name, in place of a file of that name if there is one: one rename, never a delete first. Raises where the store can't."""
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._system.getUri(), self._conf).rename(self.path(name), self.path(to), options)

    def size(self, name: str) -> int:
        return self._system.getContentSummary(self.path(name)).getLength()

    def remove(self, name: str) -> None:
        self._system.delete(self.path(name), True)


POINTERS, _SWAPS = "_tables.json", threading.Lock()


def write_table(df: DataFrame, root: str, name: str) -> None:
    """A parquet table in place of one of that name; an empty one is written too, with its schema.

    Rows go to a folder of their own; then the root's small file of pointers is replaced in one step. Until then, and if
    anything fails, readers see the table that was there. The folder before is removed last.
    """
    spark = df.sparkSession
    store, part = Store(spark, root), f"{name}.{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{part}")
    with _SWAPS:  # threads of a driver take turns; a root has one driver that writes
        pointers = load_manifest(spark, root, POINTERS)
        before = pointers.get(name)
        store.write(POINTERS, json.dumps(pointers | {name: part}, indent=1, sort_keys=True))
    if before:
        store.remove(before)


def table_path(spark: SparkSession, root: str, name: str) -> str | None:
    """The folder that a table's rows are in now; null where there is no such table."""
    found = load_manifest(spark, root, POINTERS).get(name)
    return f"{root}/{found}" if found else None


def open_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    path = table_path(spark, root, name)
    return spark.read.parquet(path) if path else None


def sweep(spark: SparkSession, root: str, name: str) -> list[str]:
    """Removes folders that failed writes of a table have left, and names them; no write of it may be under way."""
    store, kept = Store(spark, root), load_manifest(spark, root, POINTERS).get(name)
    left = [n for n in store.names() if n.rpartition(".")[0] == name and len(n.rpartition(".")[2]) == 32 and n != kept]
    for n in left:
        store.remove(n)
    return left


def csv_cells(df: DataFrame) -> DataFrame:
    """df as text: doubles without exponents, 0 as empty."""
    return df.select(*[format_float(F.col(c)).alias(c) if t == "double" else F.col(c).cast("string").alias(c) for c, t in df.dtypes])


def export_csv(df: DataFrame, path: str) -> None:
    """Rows as text with a header. One file for each partition, as many as df has."""
    csv_cells(df).write.mode("overwrite").csv(path, header=True, emptyValue="", nullValue="")


def export_one_csv(df: DataFrame, root: str, name: str) -> None:
    """Rows as one file root/name that appears whole; for tables that one task may write, such as reports and dimensions."""
    store = Store(df.sparkSession, root)
    part = f"{name}.{uuid.uuid4().hex}"
    csv_cells(df).coalesce(1).write.csv(f"{root}/{part}", header=True, emptyValue="", nullValue="")
    store.move(f"{part}/{next(n for n in store.names(part) if n.endswith('.csv'))}", name)
    store.remove(part)


def rewrite(spark: SparkSession, root: str, name: str, change) -> None:
    """Replaces a table by change(table), as write_table does: the old one stays until the new one is whole."""
    write_table(change(open_table(spark, root, name)), root, name)


def load_manifest(spark: SparkSession, root: str, name: str = "manifest.json") -> dict:
    """The manifest of a folder; empty where there is none or it can't be read."""
    try:
        found = json.loads(Store(spark, root).read(name) or "{}")
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def save_manifest(spark: SparkSession, root: str, manifest: dict, name: str = "manifest.json") -> None:
    Store(spark, root).write(name, json.dumps(manifest, indent=1, sort_keys=True))


def extracted(spark: SparkSession, root: str, sentinel: str, force: bool = False) -> bool:
    """Whether an extract in root is complete: the table written last is there."""
    return not force and table_path(spark, root, sentinel) is not None


def write_generation(tables: dict[str, DataFrame], root: str, generation: str) -> None:
    """Tables under root/generation; then the pointer is replaced in one step, so that readers see whole generations."""
    for name, df in tables.items():
        write_table(df, f"{root}/{generation}", name)
    Store(next(iter(tables.values())).sparkSession, root).write("CURRENT", generation)


def current_generation(spark: SparkSession, root: str) -> str | None:
    """The pointed-to generation; null where there is no pointer or it isn't one plain name."""
    store = Store(spark, root)
    name = (store.read("CURRENT") or "").strip()
    return name if name and "/" not in name and name not in (".", "..") and store.exists(name) else None


def read_generation(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    found = current_generation(spark, root)
    return open_table(spark, f"{root}/{found}", name) if found else None


class Cache:
    """Tables of generations kept in memory: one entry for each root, name and limit, taken up again as long as the pointer is the same."""

    def __init__(self):
        self._kept: dict[tuple, tuple[str, DataFrame]] = {}

    def get(self, spark: SparkSession, root: str, name: str, limit: int | None = None) -> DataFrame | None:
        key, now = (root, name, limit), current_generation(spark, root)
        if key in self._kept and self._kept[key][0] != now:
            self.drop(key)
        if now and key not in self._kept:
            found = read_generation(spark, root, name)
            self._kept[key] = now, (found if limit is None else found.limit(limit)).persist()
        return self._kept[key][1] if key in self._kept else None

    def drop(self, key: tuple) -> None:
        self._kept.pop(key)[1].unpersist()

    def clear(self) -> None:
        for key in list(self._kept):
            self.drop(key)


def write_source_meta(spark: SparkSession, root: str, name: str, **what: str) -> None:
    Store(spark, root).write(name, json.dumps(what, sort_keys=True))
