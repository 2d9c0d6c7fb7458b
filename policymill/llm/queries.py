"""Queries of the llm problems and the SQL that answers the same, where there is any."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from policymill.llm import near_duplicates, neighbours, packing, splitting, subjects, tokenizer
from policymill.runtime import materialize, shared_dir, table


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered pieces of oversized chunks and indications."""
    chunks = table(spark, sf_dir, "doc_chunk").select(F.lit("doc_chunk").alias("source_table"), F.col("chunk_id").alias("item_id"), F.col("content").alias("text"), F.col("heading_path").alias("heading"))
    texts = table(spark, sf_dir, "lcd").select(F.lit("lcd").alias("source_table"), F.col("doc_pk").alias("item_id"), F.col("indication").alias("text"), F.lit(None).cast("string").alias("heading"))
    return splitting.split_texts(chunks.unionByName(texts), ["source_table", "item_id"], "text", "heading")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_pieces(spark, sf_dir).where("piece_no = 0").select("source_table", F.col("item_id").cast("bigint").alias("item_id"))


def _uncovered(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces with `fresh`, their characters that the piece before does not hold, and whether they fit and overlap as they should."""
    before = F.lag("end").over(Window.partitionBy(*keys).orderBy("piece_no"))  # pieces of one text
    at = pieces.withColumn("__shared", before - F.col("start"))
    fits = (F.length("content") <= splitting.LIMIT) & F.coalesce(F.col("__shared").between(1, splitting.OVERLAP), (F.col("piece_no") == 0) & (F.col("start") == 0))
    return at.withColumns({"fresh": F.col("end") - F.col("start") - F.coalesce("__shared", F.lit(0)), "fits": fits}).drop("__shared")


def p2_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every oversized item put together again, and whether all of them fit and overlap."""
    key = ["source_table", "item_id"]
    own = _uncovered(p2_pieces(spark, sf_dir), key)
    text = F.expr("substring(content, length(content) - cast(fresh as int) + 1)")
    per = own.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("piece_no", text.alias("x")))).alias("all"), F.every("fits").alias("in_bounds"))  # one text
    return per.select(*key, F.sha2(F.array_join("all.x", ""), 256).alias("digest"), "in_bounds")


def p2_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written one after another to files, split by ranges of bytes: characters covered, and whether the pieces fit."""
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    table(spark, sf_dir, "documents").where("text is not null").select("text").write.text(folder)
    own = _uncovered(splitting.split_files(spark, spark.read.text(folder).inputFiles()), ["path"])
    return own.agg(F.coalesce(F.sum("fresh"), F.lit(0)).cast("bigint").alias("chars"), F.coalesce(F.every("fits"), F.lit(True)).alias("in_bounds"))


def p3_neighbours(spark: SparkSession, sf_dir: str, model: str = "policy-embed:v2", dim: int = 768) -> DataFrame:
    """The five most similar chunks of every chunk with a usable vector."""
    rows = table(spark, sf_dir, "chunk_embedding").where(F.col("model") == model)
    # Only the vectors of chunks with several are brought together.
    several = materialize(rows.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("chunk_id"), "several")
    latest = rows.join(several, "chunk_id", "left_semi").groupBy("chunk_id").agg(F.max_by("embedding", F.struct("created_at", F.xxhash64("embedding"))).alias("embedding"))
    latest = latest.unionByName(rows.join(several, "chunk_id", "left_anti").select("chunk_id", "embedding"))
    return neighbours.nearest(latest, "chunk_id", "embedding", dim)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.pairs(p3_neighbours(spark, sf_dir), "chunk_id")


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, copies and number of links of every chunk and indication of at least 20 words."""
    chunks = table(spark, sf_dir, "doc_chunk").select(F.lit("doc_chunk").alias("item_table"), F.col("chunk_id").alias("id"), F.col("content").alias("text"))
    texts = table(spark, sf_dir, "lcd").select(F.lit("lcd").alias("item_table"), F.col("doc_pk").alias("id"), F.col("indication").alias("text"))
    return near_duplicates.near_duplicate_groups(chunks.unionByName(texts), "id", "text", "item_table", width=3, threshold=0.7, least_words=20)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.group_pairs(p6_groups(spark, sf_dir), ["item_table", "id"])


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer.encode_texts(table(spark, sf_dir, "documents"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of each document or piece of one."""
    return packing.fill_containers(table(spark, sf_dir, "documents"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill_report(p8_containers(spark, sf_dir))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects of each document with their share of its sentences."""
    return subjects.subjects(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_label"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_shares(spark, sf_dir).select("doc_id", "subject_id")


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and summed shares of each subject over the corpus."""
    per = p9_shares(spark, sf_dir).groupBy("subject_id").agg(F.count(F.lit(1)).alias("documents"), F.sum("share").alias("share"))
    return table(spark, sf_dir, "subject_area").select(F.col("subject_id").cast("bigint").alias("subject_id"), "subject_name").join(per, "subject_id", "left")


def p9_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every topic with its top terms, the subject they point to and how clearly, for inspection."""
    return subjects.topic_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_label"))


QUERIES = {f.__name__: f for f in (p2_found, p2_pieces, p2_cover, p2_files, p3_found, p3_neighbours, p6_found, p6_groups, p7_ids, p8_containers, p8_fill, p9_found, p9_shares, p9_composition, p9_topics)}

ORACLE = {
    "p2_found": """
SELECT 'doc_chunk' AS source_table, chunk_id AS item_id FROM doc_chunk WHERE length(content) + coalesce(length(heading_path) + 1, 0) > 2000
UNION ALL SELECT 'lcd', doc_pk FROM lcd WHERE length(indication) > 2000""",
    "p2_cover": """
SELECT 'doc_chunk' AS source_table, chunk_id AS item_id, sha256(CASE WHEN length(heading_path) > 1499 THEN heading_path || chr(10) ELSE '' END || content) AS digest, true AS in_bounds FROM doc_chunk WHERE length(content) + coalesce(length(heading_path) + 1, 0) > 2000
UNION ALL SELECT 'lcd', doc_pk, sha256(indication), true FROM lcd WHERE length(indication) > 2000""",
    "p2_files": "SELECT CAST(coalesce(sum(length(text) + 1), 0) AS bigint) AS chars, true AS in_bounds FROM documents WHERE text IS NOT NULL",
}
