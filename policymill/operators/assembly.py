"""All chunks of a document: its overview, its narrative sections and its code lists, each under a heading path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policymill.functions import values
from policymill.operators import chunking, corpus, relations
from policymill.operators.chunking import Sizes
from policymill.operators.corpus import Corpus
from policymill.operators.tables import union_all

# Headings of the sections and code lists, and texts that stand for none.
SECTION_LABELS = {"issue": "Issue", "indication": "Coverage Indications, Limitations and/or Medical Necessity", "coding_guidelines": "Coding Guidelines"}
CODE_LABELS = {
    ("HCPCS", "listed"): "CPT/HCPCS Codes",
    ("HCPCS_MOD", "listed"): "CPT/HCPCS Modifiers",
    ("ICD10CM", "covered"): "ICD-10-CM Codes that Support Medical Necessity",
    ("ICD10CM", "noncovered"): "ICD-10-CM Codes that DO NOT Support Medical Necessity",
    ("ICD10PCS", "covered"): "ICD-10-PCS Codes",
    ("REV", "listed"): "Revenue Codes",
    ("BILL", "listed"): "Bill Types",
}
PLACEHOLDERS = ("n/a", "na", "none", "not applicable")
LEAST_TEXT = 25  # characters below which a section is not worth a chunk
LEAST_BELOW = 40  # characters below a heading from which the heading is left to the path

CHUNK = ["doc_pk", "section", "source_table", "source_key", "chunk_index", "heading_path", "content"]


@dataclass(frozen=True)
class Plan:
    """Which documents and parts are chunked, and how large the chunks are."""

    doc_types: Sequence[str] = ("LCD", "ART", "NCD")
    statuses: Sequence[str] = ("A",)
    code_lists: bool = True
    left_out: Sequence[str] = ()  # sections of little value
    sizes: Sizes = Sizes()


def substantive(text: Column) -> Column:
    """Whether a text is long enough and no placeholder; never for NULL."""
    t = F.lower(values.clean(text))
    return F.coalesce((F.length(t) >= LEAST_TEXT) & ~F.regexp_replace(t, r"^[ .]+|[ .]+$", "").isin(*PLACEHOLDERS), F.lit(False))


def selected(c: Corpus, plan: Plan = Plan()) -> DataFrame:
    """Latest, final documents of the types and statuses; their dates play no part."""
    d = c.read("policy_doc")
    return d.where(F.col("doc_type").isin(*plan.doc_types) & F.col("status").isin(*plan.statuses) & ~F.col("is_draft") & F.col("is_latest"))


def sections(texts: DataFrame, key: str, labels: Mapping[str, str]) -> DataFrame:
    """(key, section, label, text) of the substantive ones among the columns named in `labels`."""
    each = F.array(*[F.struct(F.lit(n).alias("section"), F.lit(v).alias("label"), F.col(n).cast("string").alias("text")) for n, v in labels.items()])
    return texts.select(key, F.inline(each)).where(substantive(F.col("text")))


def narrative_chunks(rows: DataFrame, keys: Sequence[str], base: str, label: str, text: str, sizes: Sizes = Sizes()) -> DataFrame:
    """(*keys, chunk_index, heading_path, content): chunks whose path names the section and the heading they begin under.

    A heading that begins a chunk is left to the path unless hardly anything follows it.
    """
    pieces = chunking.pieces(rows, [*keys, base, label], text, sizes)
    lead = F.concat(F.lit("### "), F.col("head"), F.lit("\n\n"))
    bare = F.startswith(F.col("body"), lead) & (F.length("body") > F.length(lead) + LEAST_BELOW)
    path = F.concat_ws(" > ", base, label, F.when(F.col("head") != F.col(label), F.nullif(F.col("head"), F.lit(""))))
    body = F.when(bare, F.substring(F.col("body"), F.length(lead) + 1, F.length("body"))).otherwise(F.col("body"))
    return pieces.select(*keys, "chunk_index", path.alias("heading_path"), body.alias("content"))


def code_list_chunks(c: Corpus, docs: DataFrame, size: int = 1400) -> DataFrame:
    """Chunks of every code list of `docs` (doc_pk, base); NULL systems, roles and groups count as `other`, `listed`, 0."""
    rows = c.codes().withColumn("line", values.code_line(F.col("code"), F.coalesce("description", "short_description"), F.col("range_pos")))
    system, role = F.coalesce("code_system", F.lit("other")), F.coalesce("role", F.lit("listed"))
    rows = rows.withColumns({"code_system": system, "role": role, "group_no": F.coalesce("group_no", F.lit(0)), "so": F.coalesce("sort_order", F.lit(2147483647))})
    rows = rows.join(docs.select("doc_pk"), "doc_pk", "left_semi")
    group = ["doc_pk", "code_system", "role", "group_no"]
    packed = chunking.packed_lines(rows, group, ["so", "code", "code_pk"], "line", size).join(docs, "doc_pk")
    known = F.create_map(*[F.lit(x) for k, v in CODE_LABELS.items() for x in ("/".join(k), v)])
    name = F.coalesce(known[F.concat_ws("/", "code_system", "role")], F.concat("code_system", F.lit(" Codes")))
    part = F.when(F.col("group_no") != 0, F.concat(F.lit("Group "), F.col("group_no").cast("string")))
    return packed.select(
        "doc_pk", F.concat(F.lower(F.concat_ws("_", "code_system", "role")), F.lit("_codes")).alias("section"), F.lit("policy_code").alias("source_table"),
        F.concat(F.lit("group="), F.col("group_no").cast("string")).alias("source_key"), "chunk_index", F.concat_ws(" > ", "base", name, part).alias("heading_path"), "content",
    )


def build_chunks(c: Corpus, plan: Plan = Plan()) -> DataFrame:
    """(doc_pk, section, source_table, source_key, chunk_index, heading_path, content, token_count, content_hash).

    (doc_pk, section, source_key, chunk_index) is unique. Documents without texts or codes still have an overview.
    """
    chosen = selected(c, plan)
    docs = chosen.select("doc_pk", F.concat_ws(": ", "public_id", F.coalesce("title", F.lit("(untitled)"))).alias("base"))
    over = corpus.overview(c, chosen, relations.related_line(c, chosen)).join(docs, "doc_pk")
    over = over.select("doc_pk", F.lit("overview").alias("section"), F.lit("policy_doc").alias("source_table"), F.lit("").alias("source_key"), F.lit(0).alias("chunk_index"), F.concat_ws(" > ", "base", F.lit("Overview")).alias("heading_path"), "content")
    labels = {n: v for n, v in SECTION_LABELS.items() if n not in plan.left_out}
    texts = sections(c.read("lcd"), "doc_pk", labels).join(docs, "doc_pk")
    told = narrative_chunks(texts, ["doc_pk", "section"], "base", "label", "text", plan.sizes)
    told = told.withColumns({"source_table": F.lit("lcd"), "source_key": F.lit("")})
    parts = [over, told.select(*CHUNK)] + ([code_list_chunks(c, docs, plan.sizes.target)] if plan.code_lists else [])
    h, t = F.col("heading_path"), F.col("content")
    return union_all(parts).withColumns({"token_count": values.tokens_estimate(h, t), "content_hash": values.content_hash(h, t)})
