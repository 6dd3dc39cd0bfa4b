"""What the operators of this subpackage share: the shared folder, bounded broadcasts, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of two longs that a side may hold to be broadcast (about 16 MB as a relation); beyond, the join shuffles.
BROADCAST_ROWS = 400_000


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); where it is unset, a folder of its own, on a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        global _OWN_ROOT
        _OWN_ROOT = _OWN_ROOT or f"file://{tempfile.mkdtemp(prefix='orrery-shared-')}"
        root = _OWN_ROOT
    return root.rstrip("/")


_OWN_ROOT: str | None = None


class Workspace:
    """Tables written once to the shared folder: they cut lineage, survive lost executors and are dropped when used up."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/orrery/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _at(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def drop(self, *names: str) -> None:
        """Deletes tables by Hadoop's file system, so any store works."""
        for name in names:
            store, path = self._at(self.path(name))
            store.delete(path, True)

    def keep_only(self, *names: str) -> None:
        """Deletes all else that this workspace wrote."""
        store, root = self._at(self.root)
        for entry in store.listStatus(root):
            if entry.getPath().getName() not in names:
                store.delete(entry.getPath(), True)


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def few(df: DataFrame, most: int | None = None) -> DataFrame:
    """df, marked for a broadcast if a count shows at most ``most`` rows; df reads a saved table of a few numbers a row."""
    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if most is None else most) else df


def keep_ids(df: DataFrame, ids: DataFrame, column: str, how: str = "left_semi", most: int | None = None) -> DataFrame:
    """df's rows whose id is (left_semi) or isn't (left_anti) in ids.

    The ids are broadcast only if a count shows at most ``most`` of them; otherwise both sides shuffle.
    Either way gives the same rows.
    """
    return df.join(few(ids.select(F.col(ids.columns[0]).alias(column)), most), column, how)


class Components:
    """Connected components of a graph that grows by saved edges (a, b); all state is distributed.

    A round hooks each vertex to its smallest neighbour where that is smaller, and to what that one hooks to, then
    contracts the edges, of which only those between different components stay; it ends when none does.
    ``labels`` has (v, c) of the vertices that aren't the smallest of their component.
    """

    def __init__(self, ws: Workspace, name: str = "components"):
        self.ws, self.name, self.k = ws, name, 0
        self.labels = ws.spark.createDataFrame([], "v long, c long")

    def _moved(self, df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
        to = hooks.select(F.col("v").alias(column), F.col("c").alias("_to"))
        return df.join(to, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")

    def add(self, edges: DataFrame) -> None:
        have = few(self.labels)
        edges = self._moved(self._moved(edges.select("a", "b"), "a", have), "b", have)
        while True:
            edges = self.ws.save(edges.where("a <> b"), f"{self.name}-edges-{self.k}")
            if not edges.limit(1).count():
                self.ws.drop(f"{self.name}-edges-{self.k}", f"{self.name}-edges-{self.k - 1}")
                return
            low = edges.select("a", "b").union(edges.select("b", "a")).groupBy("a").agg(F.min("b").alias("c")).where("c < a")
            up = low.select(F.col("a").alias("c"), F.col("c").alias("d"))
            hooks = low.join(up, "c", "left").select(F.col("a").alias("v"), F.coalesce("d", "c").alias("c"))
            hooks = self.ws.save(hooks, f"{self.name}-hooks-{self.k}")
            small = few(hooks)
            self.labels = self.ws.save(self._moved(self.labels, "c", small).select("v", "c").unionByName(hooks), f"{self.name}-{self.k}")
            edges = self._moved(self._moved(edges, "a", small), "b", small)
            self.ws.drop(f"{self.name}-edges-{self.k - 1}", f"{self.name}-hooks-{self.k - 1}", f"{self.name}-{self.k - 1}")
            self.k += 1
