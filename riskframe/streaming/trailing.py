"""Trailing features on a stream: each card's latest rows are kept between micro-batches."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import sequences
from riskframe.session import materialise


class TrailingState:
    """The last ``length - 1`` rows of every card, in ``buckets`` buckets by a hash of the card.

    A micro-batch reads the newest state of the buckets that it touches, adds the features of its
    rows, and writes these buckets anew below its own batch id. A batch only ever reads what
    earlier ids wrote, and overwrites what its own id wrote, so a batch that failed and is run
    again gives the same rows and the same state. Older versions go once no batch can need them.

    Rows of a card are expected in time order across batches, as in the source; inside a batch any
    order will do. Rows without a card are windows of their own and leave no state.
    """

    def __init__(self, spark: SparkSession, path: str, length: int = 10, buckets: int = 64):
        self.spark, self.path, self.length, self.buckets = spark, path.rstrip("/"), length, buckets

    def _system(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> dict[int, list[int]]:
        """Bucket -> batch ids that wrote it, ascending; at most a few per bucket."""
        glob = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/state/batch_id=*/bucket=*")
        found: dict[int, list[int]] = {}
        for status in self._system().globStatus(glob) or []:
            batch, bucket = map(int, re.search(r"batch_id=(\d+)/bucket=(\d+)$", status.getPath().toString()).groups())
            found.setdefault(bucket, []).append(batch)
        return {k: sorted(v) for k, v in found.items()}

    def _folder(self, batch: int, bucket: int) -> str:
        return f"{self.path}/state/batch_id={batch}/bucket={bucket}"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Write the rows of ``batch`` with their trailing features, and the state after them."""
        card = F.col(sequences.CARD)
        columns = batch.columns
        rows = materialise(batch.withColumn("bucket", F.when(card.isNotNull(), F.pmod(F.xxhash64(card), F.lit(self.buckets)).cast("int"))), "micro-batch")
        touched = [r.bucket for r in rows.select("bucket").distinct().collect() if r.bucket is not None]  # at most ``buckets``
        known, history = self.versions(), rows.limit(0)
        newest = {k: max((b for b in known.get(k, []) if b < batch_id), default=None) for k in touched}
        folders = [self._folder(b, k) for k, b in newest.items() if b is not None]
        if folders:
            kept = self.spark.read.schema(batch.schema).option("basePath", f"{self.path}/state").parquet(*folders)
            history = kept.select(*columns, F.pmod(F.xxhash64(card), F.lit(self.buckets)).cast("int").alias("bucket"))
        both = rows.withColumn("_new", F.lit(True)).unionByName(history.withColumn("_new", F.lit(False)))
        found = sequences.sequence_features(both, self.length).where("_new").drop("_new", "bucket")
        found.write.mode("overwrite").parquet(f"{self.path}/data/batch_id={batch_id}")
        latest = sequences.latest_rows(both.drop("_new"), self.length - 1)
        latest.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/state/batch_id={batch_id}")
        self._clear(known, batch_id)

    def _clear(self, known: dict[int, list[int]], batch_id: int) -> None:
        """Delete what a later version below ``batch_id`` has replaced."""
        system, path = self._system(), self.spark._jvm.org.apache.hadoop.fs.Path
        for bucket, batches in known.items():
            for old in [b for b in batches if b < batch_id][:-1]:
                system.delete(path(self._folder(old, bucket)), True)

    def run(self, stream: DataFrame) -> DataFrame:
        """Process what the source has and return all rows so far."""
        query = (
            stream.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return self.rows()

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data").drop("batch_id")
