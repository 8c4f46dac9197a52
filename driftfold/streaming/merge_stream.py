"""The merge as a stream: batches of observations folded over the state so far, written with an idempotent sink."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftfold.operators import merge
from driftfold.session import shared_folder


SHARDS = 64
#: Versions of a shard that stay besides the one being written: a batch may run again, and a reader may be at the last.
KEPT = 2


class StateTable:
    """The folded state in SHARDS shards, each kept as the version of the last batch that touched it.

    A batch reads and writes only the shards of its own entities. A batch that runs again, after a failure between
    its write and the stream's commit, starts from versions older than itself and writes its own ones again.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int = SHARDS):
        self.spark, self.path, self.shards = spark, path, shards

    def shard_of(self, user_id: str = "user_id") -> Column:
        return F.pmod(F.xxhash64(user_id), F.lit(self.shards)).cast("int")

    def _files(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def all_versions(self) -> dict[int, list[int]]:
        """The versions of each shard, newest first: a listing, so a restart needs nothing else."""
        files, pattern = self._files(f"{self.path}/v=*/shard=*")
        found: dict[int, list[int]] = {}
        for status in files.globStatus(pattern) or []:
            name = status.getPath()
            found.setdefault(int(name.getName().partition("=")[2]), []).append(int(name.getParent().getName().partition("=")[2]))
        return {shard: sorted(versions, reverse=True) for shard, versions in found.items()}

    def versions(self, before: int | None = None) -> dict[int, int]:
        """The newest version of each shard, older than `before` where that is given."""
        older = {shard: [v for v in versions if before is None or v < before] for shard, versions in self.all_versions().items()}
        return {shard: versions[0] for shard, versions in older.items() if versions}

    def prune(self, version: int) -> None:
        """Remove what no batch from `version` on can read: of each shard all but the KEPT newest older versions."""
        for shard, versions in self.all_versions().items():
            for old in [v for v in versions if v < version][KEPT:]:
                files, target = self._files(f"{self.path}/v={old}/shard={shard}")
                files.delete(target, True)

    def read(self, shards: set[int] | None = None, before: int | None = None) -> DataFrame | None:
        paths = [f"{self.path}/v={v}/shard={s}" for s, v in sorted(self.versions(before).items()) if shards is None or s in shards]
        return self.spark.read.parquet(*paths) if paths else None

    def write(self, folded: DataFrame, version: int) -> None:
        dealt = folded.withColumn("shard", self.shard_of()).repartition("shard")
        dealt.write.mode("overwrite").partitionBy("shard").parquet(f"{self.path}/v={version}")


def fold_batch(table: StateTable, **rules):
    """A foreachBatch function that folds each micro-batch into the table, shard by shard."""

    def apply(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        touched = {row["shard"] for row in batch.select(table.shard_of().alias("shard")).distinct().collect()}
        if touched:
            table.write(merge.fold_over(batch, table.read(touched, before=epoch), **rules), epoch)
            table.prune(epoch)
        batch.unpersist()

    return apply


def replay(obs: DataFrame, batches: int = 3, watermark: str | None = None, **rules) -> DataFrame:
    """The state after obs have run through a file stream, in `batches` files in order of seq.

    A watermark drops observations that come later than it allows; without one late ones are folded as they come.
    """
    spark = obs.sparkSession
    base = f"{shared_folder(spark)}/driftfold/stream-{uuid.uuid4().hex}"
    low, high = obs.agg(F.min("seq"), F.max("seq")).collect()[0]
    if low is None:
        return merge.fold_over(obs, None, **rules)
    step = (high - low) // batches + 1
    for n in range(batches):
        part = obs.where((F.col("seq") >= low + n * step) & (F.col("seq") < low + (n + 1) * step))
        # One file is one batch of the stream.
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    table = StateTable(spark, f"{base}/state")
    stream = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    if watermark:
        stream = stream.withWatermark("observed_at", watermark)
    running = stream.writeStream.foreachBatch(fold_batch(table, **rules)).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
    running.awaitTermination()
    return table.read()

