"""Generic table maintenance: duplicates, references, upserts, stale rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from policymill.runtime import materialize


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_one(df: DataFrame, key: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in `order`; give descending columns for last-wins. NULL keys equal each other."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def keep_known(df: DataFrame, parents: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key exists in `parents`."""
    return df.join(parents.select(*key).distinct(), list(key), "left_semi")


def unknown(df: DataFrame, parents: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key does not exist in `parents`; NULL keys never do."""
    return df.join(parents.select(*key).distinct(), list(key), "left_anti")


def null_unknown(df: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """`column` set to NULL where `parents` lacks it."""
    known = parents.select(F.col(column).alias("__k")).dropna().distinct()
    return df.join(known, df[column] == known["__k"], "left").withColumn(column, F.col("__k")).drop("__k").select(df.columns)


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of `new`, and those of `old` whose key is not in it; keys must be unique in `new`."""
    return new.unionByName(old.join(new.select(*key), list(key), "left_anti").select(new.columns))


def drop_stale(old: DataFrame, loaded: DataFrame, key: Sequence[str], scope: str) -> DataFrame:
    """`old` without rows of the loaded scopes (document types) that the load no longer has."""
    scopes = loaded.select(scope).distinct()
    kept = old.join(loaded.select(*key).distinct(), list(key), "left_semi")
    return kept.unionByName(old.join(scopes, scope, "left_anti").select(kept.columns))


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0, most: int = 100) -> DataFrame:
    """One page in a total order; the limit is clamped to 1 .. `most`."""
    return df.orderBy(*order).offset(max(0, offset)).limit(max(1, min(most, limit)))


def top_counts(df: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """(*by, rows): the n most frequent values, the smaller one first on equal counts; NULL counts as a value."""
    per = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    return per.orderBy(F.desc("rows"), *[F.asc_nulls_first(c) for c in by]).limit(n)


def running(df: DataFrame, group: Sequence[str], order: Sequence[str], length: Column, label: str, carry: str | None = None) -> DataFrame:
    """`df` with `__at`, the summed `length` of the rows before in the group, and `__no`, whether there are none (0).

    With `carry` also `__prev`, that column's value in the row before. A group of any size is spread over range
    partitions: lengths are summed within each range, then over the ranges of a group, so that no task holds a whole
    group. `order` must be total within a group; NULL group values form a group.
    """
    spread = df.withColumn("__n", length.cast("bigint")).repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id())
    ranged = materialize(spread, label)
    ends = ranged.groupBy(*group, "__range").agg(F.sum("__n").alias("__sum"), F.max_by(carry or "__n", F.struct(*order)).alias("__end"))
    ranges = Window.partitionBy(*group).orderBy("__range")  # ranges of a group, not its rows
    starts = ends.select(
        F.col("__range").alias("__r"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
        F.coalesce(F.sum("__sum").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"), F.lag("__end").over(ranges).alias("__last"), F.row_number().over(ranges).alias("__rno"),
    )
    w = Window.partitionBy("__range", *group).orderBy(*order)
    within = ranged.withColumn("__before", F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("__no", F.row_number().over(w))
    if carry:
        within = within.withColumn("__lag", F.lag(carry).over(w))
    on = [F.col("__range") == F.col("__r"), *[F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]]
    out = within.join(starts, on).withColumn("__at", F.col("__before") + F.col("__start"))
    prev = [F.when(F.col("__no") > 1, F.col("__lag")).otherwise(F.col("__last")).alias("__prev")] if carry else []
    return out.select(*df.columns, "__at", (F.col("__no") + F.col("__rno") - 2).alias("__no"), *prev)


def mark_greatest(df: DataFrame, key: Sequence[str], value: str, name: str) -> DataFrame:
    """`df` with a flag on the rows that hold their key's greatest `value`; NULL where either is NULL.

    The greatest values are found before any shuffle of rows, and a hot key is split in the join.
    """
    most = df.groupBy(*key).agg(F.max(value).alias("__most"))
    most = most.select("__most", *[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)])
    out = df.join(most, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)], "left")
    return out.withColumn(name, F.col(value) == F.col("__most")).drop("__most", *[f"__k{i}" for i in range(len(key))])
