"""References between documents: edges by (type, number), resolved to the document that stands for the number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policymill.operators import tables
from policymill.operators.corpus import Corpus

EDGE = ["doc_pk", "to_type", "to_id"]


def edges(c: Corpus) -> DataFrame:
    """(doc_pk, to_type, to_id), each once: the named source document, and documents of other types with the same number.

    NULL and 0 mean that nothing is named and give no edge.
    """
    named = c.read("lcd").select("doc_pk", F.lit("LCD").alias("to_type"), F.col("source_lcd_id").alias("to_id"))
    d = c.read("policy_doc")
    types = F.array_except(F.array(F.lit("LCD"), F.lit("ART"), F.lit("NCD")), F.array("doc_type"))
    same = d.where("doc_type is not null").select("doc_pk", F.explode(types).alias("to_type"), F.col("doc_id").alias("to_id"))
    return tables.union_all([named, same]).where("to_id <> 0").distinct()


def _targets(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_type").alias("to_type"), F.col("doc_id").alias("to_id"), F.col("doc_pk").alias("to_pk"), F.col("public_id").alias("to_public_id"), F.col("status").alias("to_status"))


def related(c: Corpus, e: DataFrame) -> DataFrame:
    """Edges whose target has a latest version that is no draft, active or not."""
    return e.join(_targets(c.read("policy_doc").where("is_latest and not is_draft")), ["to_type", "to_id"]).select("doc_pk", "to_type", "to_pk", "to_public_id", "to_status")


def related_or_missing(c: Corpus, e: DataFrame) -> DataFrame:
    """Every edge with its latest target, drafts included; to_pk is NULL where there is none."""
    return e.join(_targets(c.read("policy_doc").where("is_latest")), ["to_type", "to_id"], "left").select(*EDGE, "to_pk", "to_public_id")


def referenced_by(c: Corpus, e: DataFrame) -> DataFrame:
    """(doc_pk, from_pk, from_public_id): active documents that point at a document's type and number, for all documents."""
    source = c.active().select("doc_pk", "public_id")
    pointing = e.join(source, "doc_pk").select("to_type", "to_id", F.col("doc_pk").alias("from_pk"), F.col("public_id").alias("from_public_id"))
    target = c.read("policy_doc").select("doc_pk", F.col("doc_type").alias("to_type"), F.col("doc_id").alias("to_id"))
    return target.join(pointing, ["to_type", "to_id"]).select("doc_pk", "from_pk", "from_public_id")


def active_pairs(c: Corpus, e: DataFrame, from_type: str, to_type: str) -> DataFrame:
    """(from_pk, to_pk) of edges between active documents of two types."""
    a = c.active()
    ends = _targets(a.where(F.col("doc_type") == to_type))
    return e.where(F.col("to_type") == to_type).join(a.where(F.col("doc_type") == from_type).select("doc_pk"), "doc_pk", "left_semi").join(ends, ["to_type", "to_id"]).select(F.col("doc_pk").alias("from_pk"), "to_pk")


def related_line(c: Corpus, docs: DataFrame, most: int = 15) -> DataFrame:
    """(doc_pk, related): the first `most` documents that each of `docs` refers to, by name; those that are missing by type and number."""
    own = edges(c).join(docs.select("doc_pk"), "doc_pk", "left_semi")
    latest = c.read("policy_doc").where("is_latest").select(F.col("doc_type").alias("to_type"), F.col("doc_id").alias("to_id"), "public_id", "title")
    name = F.coalesce("public_id", F.concat_ws(" ", "to_type", F.col("to_id").cast("string")))
    each = own.join(latest, ["to_type", "to_id"], "left").select("doc_pk", F.concat(name, F.coalesce(F.concat(F.lit(" ("), "title", F.lit(")")), F.lit(""))).alias("n"))
    return each.groupBy("doc_pk").agg(F.array_join(F.slice(F.array_sort(F.collect_set("n")), 1, most), "; ").alias("related"))
