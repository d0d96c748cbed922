"""What the corpus operators share: tables, the shared folder, byte-level word hashing."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def train_row(doc_id: Column, modulus: int, held_out: int) -> Column:
    """True where crc32 of the id as text leaves another remainder than held_out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus != held_out


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="filigree-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Workspace:
    """A folder for intermediate tables, removed when the driver ends; each step's lineage is cut there."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        root = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        system = root.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(root)
        system.deleteOnExit(root)

    def keep(self, df: DataFrame, name: str = "step") -> DataFrame:
        """Writes df and returns it as read back; a lost executor costs no earlier step."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back.filigree_path = path
        return back

    def keep_only(self, *dfs: DataFrame) -> None:
        """Removes the kept tables but dfs, once nothing reads them any more."""
        files = self.spark._jvm.org.apache.hadoop.fs
        root = files.Path(self.root)
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        left = {df.filigree_path.rpartition("/")[2] for df in dfs}
        for found in system.listStatus(root):
            if found.getPath().getName() not in left:
                system.delete(found.getPath(), True)


# ---- numpy helpers for tasks -------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
INVERSE = pow(int(_BASE), -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def powers(n: int, base: int = int(_BASE)) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out) if n else out


def by_size(batches, column: str, most: int = 2 << 20):
    """The record batches cut so that each holds about most bytes of a text column at most (a longer text stands alone)."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


class Words:
    """The words of some texts, hashed side by side: text[i] and hash[i] of word i, in order."""

    _tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, texts: list[bytes], gap: np.ndarray):
        """gap: a table of 256 booleans, true for the bytes that stand between words; the line feed must be one."""
        self.data = data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        inside = ~gap[data]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.start, self.end = edge[::2], edge[1::2]
        size = 1 << max(16, int(len(data)).bit_length())
        if size not in self._tables:
            self._tables.clear()
            self._tables[size] = powers(size), powers(size, INVERSE)
        up, down = self._tables[size]
        with np.errstate(over="ignore"):
            sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)
            sums = np.concatenate([np.zeros(1, np.uint64), sums])
            self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        self.text = np.searchsorted(ends, self.start, "right")
        self.count = np.bincount(self.text, minlength=len(texts))


def connected(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of the (u, v) edges is connected with.

    Each round hooks every root to the smallest root it has an edge to, follows hooks to hooks, and replaces the
    ends of edges by their roots; edges inside one root go. Nothing is collected but whether edges remain.
    """
    edges = ws.keep(edges.select("u", "v").where("u <> v").distinct(), "edges")
    ids = edges.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    found = ws.keep(ids.select("id", F.col("id").alias("component")), "components")
    left = edges
    while not left.isEmpty():
        hooks = left.groupBy(F.greatest("u", "v").alias("a")).agg(F.min(F.least("u", "v")).alias("b"))
        hooks = ws.keep(hooks, "hooks")
        for _ in range(3):
            to = hooks.select(F.col("a").alias("b"), F.col("b").alias("c"))
            hooks = hooks.join(to, "b", "left").select("a", F.coalesce("c", "b").alias("b"))
        hooks = ws.keep(hooks, "hooks")
        found = ws.keep(found.join(hooks.withColumnRenamed("a", "component"), "component", "left").select("id", F.coalesce("b", "component").alias("component")), "components")
        a, b = hooks.select(F.col("a").alias("u"), F.col("b").alias("ru")), hooks.select(F.col("a").alias("v"), F.col("b").alias("rv"))
        left = left.join(a, "u", "left").join(b, "v", "left").select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")).where("u <> v").distinct()
        left = ws.keep(left, "edges")
    return found


def broadcast_if(df: DataFrame, most: int) -> DataFrame:
    """A kept table, marked for broadcast if it is counted to have most rows at most; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= most else df
