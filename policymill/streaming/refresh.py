"""Incremental refresh: files that arrive are upserted, and orphan references kept, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from policymill.operators import orphans
from policymill.operators.tables import keep_one, upsert


@dataclass(frozen=True)
class Buckets:
    """A table in folders by hash of its key, of which a batch writes only those it touches.

    `base`/rows/<batch>/bucket=<n> holds rows; `base`/manifest/<batch> says in which batch's folder each bucket is. A batch
    that is run again after a failure writes the same folders again. Errors of reading are never taken for an empty table.
    """

    spark: SparkSession
    base: str
    key: Sequence[str]
    schema: StructType
    count: int = 64

    def placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.count)).cast("int"))

    def touched(self, df: DataFrame) -> list[int]:
        return [r[0] for r in self.placed(df).select("bucket").distinct().collect()]  # at most `count`

    def manifest(self, batch: int) -> dict[int, int]:
        """Bucket -> batch after a batch; empty before the first."""
        return {r.bucket: r.batch for r in self.spark.read.parquet(f"{self.base}/manifest/{batch}").collect()} if batch >= 0 else {}

    def read(self, batch: int, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table after a batch, or the given buckets of it."""
        at = self.manifest(batch)
        paths = [f"{self.base}/rows/{at[b]}/bucket={b}" for b in (at if buckets is None else buckets) if b in at]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame, batch: int) -> None:
        """`df` holds every row of the buckets that it has rows of."""
        self.placed(df).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.base}/rows/{batch}")
        own = {r[0] for r in self.spark.read.parquet(f"{self.base}/rows/{batch}").select("bucket").distinct().collect()} if df.take(1) else set()
        at = self.manifest(batch - 1) | {b: batch for b in own}
        self.spark.createDataFrame(list(at.items()), "bucket int, batch bigint").coalesce(1).write.mode("overwrite").parquet(f"{self.base}/manifest/{batch}")


def upsert_stream(spark: SparkSession, landing: str, schema: StructType, target: str, key: Sequence[str], order: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Keep a table under `target` with each batch of parquet files; of equal keys the last in `order` counts.

    Read it with Buckets(spark, target, key, schema).read(batch).
    """

    def apply(df: DataFrame, batch: int) -> None:
        table = Buckets(df.sparkSession, target, key, schema)
        new = keep_one(df, key, [F.desc(c) for c in order])
        table.write(upsert(table.read(batch - 1, table.touched(new)), new, key), batch)

    stream = spark.readStream.schema(schema).parquet(landing)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def orphan_stream(spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> StreamingQuery:
    """Advance the pending-orphan state with each batch; `split` gives a batch's references and parents.

    `target`/parents and /refs hold the state in buckets of the parent key; only buckets of the keys in a batch are read and
    written. `target`/found, /withdrawn, /changes and /deltas get what each batch brings, in a folder of its own.
    """
    parts = {"parents": orphans.PARENT, "refs": orphans.REFERENCE}

    def apply(df: DataFrame, batch: int) -> None:
        s = df.sparkSession
        held = {n: Buckets(s, f"{target}/{n}", ["parent_table", "key"], s.createDataFrame([], kind).schema) for n, kind in parts.items()}
        refs, log = split(df)
        own = sorted({*held["refs"].touched(refs), *held["refs"].touched(log)})
        got = orphans.advance(orphans.OrphanState(*(held[n].read(batch - 1, own) for n in parts)), refs, log)
        for name in ("found", "withdrawn", "changes", "deltas"):
            getattr(got, name).write.mode("overwrite").parquet(f"{target}/{name}/{batch}")
        held["parents"].write(got.state.parents, batch)
        held["refs"].write(got.state.refs, batch)

    stream = spark.readStream.schema(schema).parquet(landing)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events of each kind per window; works on a stream, where records later than `late` are dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")
