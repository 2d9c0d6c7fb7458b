"""Bulk sources of string tables, and sinks that replace, append or merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from policymill.operators.tables import upsert


# Where windows-1252 differs from ISO-8859-1: the characters that the latter, and the former, give the same bytes.
_BYTES = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_WESTERN = ("".join(map(chr, _BYTES)), bytes(_BYTES).decode("cp1252"))


def csv_tables(spark: SparkSession, directory: str) -> dict[str, str]:
    """Table name (lower-case stem) -> file, of all CSV files below a directory of any storage; the newest of equal names."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[cC][sS][vV]").load(directory)
    stem = F.lower(F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1))
    newest = files.select(stem.alias("stem"), "modificationTime", "path").groupBy("stem").agg(F.max(F.struct("modificationTime", "path"))["path"].alias("path"))
    return {r.stem: r.path for r in newest.collect()}  # one row a table


def is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether the bytes of every line of a file are UTF-8."""
    return spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty()


def read_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """A CSV file as text columns: names stripped and lower-case, short records padded, empty values NULL.

    Without an `encoding` files are UTF-8, or windows-1252 where they are not. Quoted fields may hold doubled quotes and line
    breaks, for which a file is read by one task; for records that are lines use problem 4's structural index.
    """
    western = encoding is None and not is_utf8(spark, path)
    encoding = encoding or ("ISO-8859-1" if western else "UTF-8")
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE").option("encoding", encoding).csv(path)
    named = raw.toDF(*[c.strip().lstrip("\ufeff").lower() for c in raw.columns])
    text = {c: F.translate(F.col(f"`{c}`"), *_WESTERN) if western else F.col(f"`{c}`") for c in named.columns}
    return named.select(*[F.when(x != "", x).alias(c) for c, x in text.items()])


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation items, one JSON object a line."""
    schema = (
        "id string, input struct<question:string>, expected_output struct<answer:string,public_ids:array<string>>,"
        "metadata struct<category:string,state:string,state_name:string,tools:array<string>>"
    )
    return spark.read.schema(schema).json(path).where("id is not null")


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that `df` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def merge(spark: SparkSession, new: DataFrame, path: str, target: str, key: Sequence[str], dry_run: bool = False) -> DataFrame:
    """Upsert `new` into the table at `path`, written to the new directory `target`; readers swap when it is whole.

    A dry run writes nothing and gives the rows that would be written.
    """
    merged = upsert(spark.read.parquet(path), new, key)
    if dry_run:
        return merged
    merged.write.parquet(target)
    return spark.read.parquet(target)
