"""An exactly-once sink: tables in versions, and a ledger that says which batches each version holds.

A micro-batch may come again after a failure, whatever its work did by then. apply_once() writes the tables' next version into a folder that nobody
reads yet, and then one ledger row with the batch's number and that folder; only with that row is the version there. A batch whose number is
in the ledger is passed over, so what it does to the tables needn't be idempotent. Rows that are only added (observations, quarantine) go to the
version's folder, too, and are read from all folders in the ledger. Folders of tables that newer versions have replaced are deleted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

ENTRY = "version long, query string, batch long, folder string"
Tables = dict[str, DataFrame]


class Ledger:
    """Tables under a path that all executors share. kinds: each table's schema; added: those whose rows are only added."""

    def __init__(self, spark: SparkSession, path: str, kinds: dict[str, str], added: tuple[str, ...] = (), keep: int = 2):
        self.spark, self.path, self.kinds, self.added, self.keep = spark, path.rstrip("/"), kinds, added, keep

    def _fs(self):  # noqa: ANN202
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm.org.apache.hadoop.fs.Path, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def entries(self) -> DataFrame:
        """The ledger, a row for each version."""
        path, fs = self._fs()
        if not fs.exists(path(f"{self.path}/ledger")):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).json(f"{self.path}/ledger/*")

    def last(self) -> tuple[int, str | None]:
        """The latest version's number and folder; (0, None) before the first."""
        r = self.entries().orderBy(F.col("version").desc()).first()
        return (r.version, r.folder) if r else (0, None)

    def done(self, query: str) -> int:
        """The last batch of a query that the tables hold; -1 for none."""
        r = self.entries().filter(F.col("query") == query).agg(F.max("batch")).first()
        return -1 if r[0] is None else r[0]

    def tables(self) -> Tables:
        """The latest version."""
        folder = self.last()[1]
        read = self.spark.read
        out = {}
        for k, kind in self.kinds.items():
            if folder is None:
                out[k] = self.spark.createDataFrame([], kind)
            elif k in self.added:
                out[k] = read.schema(kind).parquet(*[f"{self.path}/added/{r.folder}/{k}" for r in self.entries().select("folder").collect()])  # a name a batch
            else:
                out[k] = read.schema(kind).parquet(f"{self.path}/tables/{folder}/{k}")
        return out

    def apply_once(self, query: str, batch: int, apply: Callable[[Tables], Tables]) -> bool:
        """Replace the tables by apply(tables) (for added ones: the new rows), unless the query's batch is in the ledger. Whether it did.

        A version is entered under its number, and a number only once: of two writers at the same time the later one fails.
        """
        if batch <= self.done(query):
            return False
        number, _ = self.last()
        folder = f"{number + 1:010d}-{uuid.uuid4().hex}"
        next_ = apply(self.tables())
        for k, kind in self.kinds.items():
            names = [f.split(" ")[0] for f in self.spark.createDataFrame([], kind).columns]
            next_[k].select(*names).write.parquet(f"{self.path}/{'added' if k in self.added else 'tables'}/{folder}/{k}")
        entry = self.spark.createDataFrame([(number + 1, query, batch, folder)], ENTRY)
        entry.coalesce(1).write.mode("error").json(f"{self.path}/ledger/{number + 1:010d}")
        self._tidy()
        return True

    def _tidy(self) -> None:
        """Delete the folders of tables that the last `keep` versions don't need, those of batches that failed halfway, too."""
        path, fs = self._fs()
        top = path(f"{self.path}/tables")
        if not fs.exists(top):
            return
        kept = {r.folder for r in self.entries().orderBy(F.col("version").desc()).limit(self.keep).collect()}
        newest = max(kept)
        for s in fs.listStatus(top):
            if s.getPath().getName() not in kept and s.getPath().getName() < newest:
                fs.delete(s.getPath(), True)

    def sink(self, rows: DataFrame, query: str, apply: Callable[[Tables, DataFrame], Tables], checkpoint: str) -> StreamingQuery:
        """Run what is there of a stream through apply(tables, batch), each micro-batch once."""

        def put(batch: DataFrame, number: int) -> None:
            self.apply_once(query, number, lambda t: apply(t, batch))

        return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
