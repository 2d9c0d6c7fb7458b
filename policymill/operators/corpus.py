"""The policy corpus: documents, codes, contractors, jurisdictions and the questions asked of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from policymill.functions import values
from policymill.operators import tables
from policymill.runtime import materialize, table

CONTRACTOR_KEY = ["contractor_id", "contractor_type_id", "contractor_version"]
PART, ENTIRE = " - ", "entire state"  # fixed values: what splits the name of a part of a state, and marks the whole of it
CODE_SYSTEMS = ("HCPCS", "HCPCS_MOD", "ICD10CM", "ICD10PCS", "REV", "BILL")


@dataclass(frozen=True)
class Corpus:
    """Tables of one data directory, read lazily."""

    spark: SparkSession
    sf_dir: str
    as_of: str = "2025-06-01"

    def read(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def active(self) -> DataFrame:
        """Active, final, latest documents whose dates hold on the day, both ends included."""
        d, day = self.read("policy_doc"), F.lit(self.as_of).cast("date")
        return d.where(
            (F.col("status") == "A") & ~F.col("is_draft") & F.col("is_latest")
            & (F.col("effective_date").isNull() | (F.col("effective_date") <= day)) & (F.col("end_date").isNull() | (F.col("end_date") >= day))
        )

    def contractors(self) -> DataFrame:
        """The last delivery of each contractor, unless it is a deletion; unknown states are NULL."""
        last = tables.keep_one(self.read("contractor"), CONTRACTOR_KEY, [F.desc("loaded_at"), F.desc("load_id")])
        last = last.where(~F.coalesce(F.col("status") == "D", F.lit(False)))
        return tables.null_unknown(last, self.states(), "state_id")

    def states(self) -> DataFrame:
        return tables.keep_one(self.read("state_lookup"), ["state_id"], [F.desc("loaded_at"), F.desc("load_id")])

    def codes(self) -> DataFrame:
        """Code rows without repeats: of equal keys the first counts."""
        key = ["doc_pk", "code_system", "role", "code", F.coalesce("code_version", F.lit(0)), F.coalesce("group_no", F.lit(0)), F.coalesce("range_pos", F.lit("-"))]
        return tables.keep_one(self.read("policy_code").where("code is not null and code <> ''"), key, [F.asc("code_pk")])

    def doc_states(self) -> DataFrame:
        """(doc_pk, state_abbrev) by the contractors of each document."""
        links = self.read("policy_contractor").select("doc_pk", *CONTRACTOR_KEY).distinct()
        held = links.join(self.contractors().select(*CONTRACTOR_KEY, "state_id"), CONTRACTOR_KEY)
        named = held.join(self.states().select("state_id", "state_abbrev"), "state_id")
        return named.where("state_abbrev is not null").select("doc_pk", "state_abbrev").distinct()

    def with_states(self, docs: DataFrame) -> DataFrame:
        """Documents with their sorted states; an empty array where there are none."""
        arrays = self.doc_states().groupBy("doc_pk").agg(F.array_sort(F.collect_set("state_abbrev")).alias("states"))
        return docs.join(arrays, "doc_pk", "left").withColumn("states", F.coalesce("states", F.array().cast("array<string>")))


def in_jurisdiction(states: list[str] | None) -> Column:
    """National documents, and those of any of the states; all without states."""
    if states is None:
        return F.lit(True)
    return (F.col("doc_type") == "NCD") | F.arrays_overlap("states", F.array(*[F.lit(s) for s in states]).cast("array<string>"))


def resolve_states(states: DataFrame, name: str) -> DataFrame:
    """(state_id, state_abbrev): jurisdictions meant by a name, found by abbreviation, else description, else base name.

    `Base - Part` describes a part of a state. A part found alone stands for itself and the rows of its base that are
    the entire state; otherwise every row of the bases found counts. Case and blanks around the name don't matter; an
    unknown or NULL name gives no rows.
    """
    base = F.trim(F.split_part(F.col("description"), F.lit(PART), F.lit(1)))
    n, described = (name or "").strip().lower(), F.lower(F.trim("description"))
    tier = F.when(F.lower("state_abbrev") == n, 1).when(described == n, 2).when(F.lower(base) == n, 3)
    rows = states.withColumn("base", F.lower(base)).withColumn("entire", F.contains(described, F.lit(ENTIRE))).withColumn("tier", tier)
    hits = rows.join(rows.agg(F.min("tier").alias("tier")), "tier", "left_semi")  # NULL tiers never meet
    part = F.contains(F.col("description"), F.lit(PART)) & ~F.col("entire")
    found = hits.agg(F.min("base").alias("base"), ((F.count(F.lit(1)) == 1) & F.every(part)).alias("alone"), F.min("tier").alias("found"))
    wider = rows.join(hits.select("base").distinct(), "base", "left_semi").join(found, "base", "left")
    stays = ~F.coalesce("alone", F.lit(False)) | F.col("entire") | (F.col("tier") == F.col("found"))
    return wider.where(stays).select("state_id", "state_abbrev").distinct()


def lookup_code(c: Corpus, code: str, states: list[str] | None = None, system: str | None = None, limit: int = 25) -> DataFrame:
    """Active documents that list a code, with their matches; the first `limit` documents (1 to 100)."""
    if system is not None and system not in CODE_SYSTEMS:
        raise ValueError(f"code_system must be one of {', '.join(CODE_SYSTEMS)}")
    hits = c.codes().where(F.col("code").isin(values.code_candidates(code, system)))
    if system:
        hits = hits.where(F.col("code_system") == system)
    docs = c.with_states(c.active().select("doc_pk", "doc_type", "public_id", "title")).where(in_jurisdiction(states))
    line = F.concat_ws("/", "code_system", "role", F.coalesce(F.col("group_no").cast("string"), F.lit("-")), "code")
    per = hits.join(docs, "doc_pk").groupBy("doc_pk", "doc_type", "public_id", "title", F.array_join("states", ",").alias("state_list"))
    per = per.agg(F.count(F.lit(1)).alias("matches"), F.array_join(F.array_sort(F.collect_set(line)), "; ").alias("listed"))
    return tables.page(per, [F.desc("doc_type"), F.asc("public_id"), F.asc("doc_pk")], limit)


def find_doc(c: Corpus) -> DataFrame:
    """The row that stands for each public id: latest first, then active, then the greatest version."""
    active = F.coalesce(F.col("status") == "A", F.lit(False))
    return tables.keep_one(c.read("policy_doc").where("public_id is not null"), ["public_id"], [F.desc_nulls_last("is_latest"), active.desc(), F.desc_nulls_last("doc_version"), F.asc("doc_pk")])


def profile(c: Corpus) -> DataFrame:
    """Per active document: sections, chunks, characters, code lists and contractors."""
    docs = c.with_states(c.active().select("doc_pk", "doc_type", "public_id"))
    text = c.read("doc_chunk").groupBy("doc_pk").agg(F.countDistinct("section").alias("sections"), F.count(F.lit(1)).alias("chunks"), F.sum(F.length("content")).alias("chars"))
    codes = c.codes().groupBy("doc_pk").agg(F.count(F.lit(1)).alias("codes"))
    held = c.read("policy_contractor").join(c.contractors().select(*CONTRACTOR_KEY, "contractor_bus_name"), CONTRACTOR_KEY)
    held = held.groupBy("doc_pk").agg(F.countDistinct("contractor_bus_name").alias("contractors"))
    out = docs
    for extra in (text, codes, held):
        out = out.join(extra, "doc_pk", "left")
    out = out.withColumn("jurisdiction", F.when(F.col("doc_type") == "NCD", "national (all states)").otherwise(F.array_join("states", ",")))
    return out.drop("states").fillna(0, ["sections", "chunks", "chars", "codes", "contractors"])


_SECTION = ["doc_pk", "section"]


def _placed_parts(chunks: DataFrame) -> DataFrame:
    """(doc_pk, section, __at, __part): the parts of each section text, a heading where it changes, and the characters before them.

    Parts are joined by an empty line, so the next one begins two characters after the end of one.
    """
    shown = F.when(~F.col("heading_path").eqNullSafe(F.col("__prev")) | (F.col("__first") == 0), F.col("heading_path"))
    order = ["source_key", "chunk_index", "chunk_id"]
    rows = chunks.select(*_SECTION, *order, "heading_path", "content")
    # The heading before each chunk says which headings show; their lengths then give the positions.
    rows = tables.running(rows, _SECTION, order, F.lit(0), "section-headings", "heading_path").withColumnRenamed("__no", "__first")
    rows = rows.select(*_SECTION, *order, F.concat_ws("\n", shown, F.coalesce("content", F.lit(""))).alias("__part"))
    return tables.running(rows, _SECTION, order, F.length("__part") + 2, "section-parts").select(*_SECTION, "__at", "__part")


def section_pages(c: Corpus, size: int = 20_000) -> DataFrame:
    """(doc_pk, section, page_no, text): the text of every section in pages of `size` characters, put together in order.

    Joined in the order of page_no they are the whole text. A section of any length is spread over its pages.
    """
    placed = materialize(_placed_parts(c.read("doc_chunk")), "placed-parts")
    total = placed.groupBy(*_SECTION).agg(F.max(F.col("__at") + F.length("__part")).alias("__total"))
    piece, first = F.concat("__part", F.lit("\n\n")), F.expr(f"__at div {size}")
    rows = placed.withColumn("page_no", F.explode(F.sequence(first, F.expr(f"(__at + length(__part) + 1) div {size}"))))
    start = F.greatest(F.col("page_no") * size, F.col("__at"))
    cut = F.substring(piece, (start - F.col("__at") + 1).cast("int"), ((F.col("page_no") + 1) * size - start).cast("int"))
    pages = rows.groupBy(*_SECTION, "page_no").agg(F.array_sort(F.collect_list(F.struct("__at", cut.alias("x")))).alias("p"))  # one page
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in _SECTION]
    pages = pages.join(total.withColumnsRenamed({k: f"__{k}" for k in _SECTION}), on).where((F.col("page_no") == 0) | (F.col("page_no") * size < F.col("__total")))
    text = F.substring(F.array_join("p.x", ""), F.lit(1), F.least(F.lit(size).cast("bigint"), F.col("__total") - F.col("page_no") * size).cast("int"))
    return pages.select(*_SECTION, "page_no", text.alias("text"))


def text_page(c: Corpus, offset: int = 0, most: int = 6000, chunks: DataFrame | None = None) -> DataFrame:
    """(doc_pk, section, total_chars, text, next_offset): a stretch of each section text; `most` is clamped to 500 .. 20000.

    `next_offset` is where the next page begins, NULL at the end. Only the chunks that reach into the page are brought
    together, so a section of any length costs no more than the page. `chunks` are those of doc_chunk unless others are given.
    """
    offset, most, key = max(0, offset), max(500, min(20000, most)), _SECTION
    placed = _placed_parts(chunks if chunks is not None else c.read("doc_chunk"))
    end = F.col("__at") + F.length("__part")
    total = placed.groupBy(*key).agg(F.max(end).cast("bigint").alias("total_chars"))
    within = placed.where((F.col("__at") - 2 < offset + most) & (end + 2 > offset))
    page = within.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("__at", "__part"))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: x["__part"]), "\n\n")
    page = page.select(*key, F.substring(joined, (F.lit(offset + 1) - F.col("p")[0]["__at"]).cast("int"), F.lit(most)).alias("text"))
    out = total.join(page, key, "left")
    return out.select(*key, "total_chars", F.coalesce("text", F.lit("")).alias("text"), F.when(F.col("total_chars") > offset + most, F.lit(offset + most)).cast("bigint").alias("next_offset"))


def contractor_overview(c: Corpus, names: int = 8, numbers: int = 4, docs: DataFrame | None = None) -> DataFrame:
    """Contractors of each of `docs` (default: active ones) in one line: the first names with their first numbers, then how many more names."""
    held = c.read("policy_contractor").select("doc_pk", *CONTRACTOR_KEY).distinct().join(c.contractors().select(*CONTRACTOR_KEY, "contractor_bus_name", "contractor_number"), CONTRACTOR_KEY)
    held = held.join((docs if docs is not None else c.active()).select("doc_pk"), "doc_pk", "left_semi")
    named = held.where("contractor_bus_name is not null").groupBy("doc_pk", "contractor_bus_name").agg(F.array_sort(F.collect_set(F.coalesce("contractor_number", F.lit("?")))).alias("no"))
    item = F.concat("contractor_bus_name", F.lit(" ("), F.array_join(F.slice("no", 1, numbers), ", "), F.when(F.size("no") > numbers, "...").otherwise(""), F.lit(")"))
    per = named.groupBy("doc_pk").agg(F.array_sort(F.collect_set(item)).alias("n"))
    more = F.when(F.size("n") > names, F.concat(F.lit("; +"), (F.size("n") - names).cast("string"), F.lit(" more"))).otherwise("")
    return per.where(F.size("n") > 0).select("doc_pk", F.concat(F.array_join(F.slice("n", 1, names), "; "), more).alias("line"))


def overview(c: Corpus, docs: DataFrame | None = None, related: DataFrame | None = None) -> DataFrame:
    """(doc_pk, content): one text of labelled lines for each of `docs` (default: active ones); lines without a value are left out.

    `related` (doc_pk, related) names the documents that each one refers to.
    """
    docs = docs if docs is not None else c.active()
    head = docs.select("doc_pk", "doc_type", "public_id", "title", "status", "is_draft", "effective_date", "end_date")
    full = c.with_states(head).join(contractor_overview(c, docs=docs), "doc_pk", "left")
    full = full.join(related, "doc_pk", "left") if related is not None else full.withColumn("related", F.lit(None).cast("string"))
    first = F.concat_ws(": ", "public_id", F.coalesce("title", F.lit("(untitled)")))
    where = F.when(F.col("doc_type") == "NCD", "national (all states)").when(F.size("states") > 0, F.array_join("states", ", "))
    status = F.when(F.col("is_draft"), "draft").otherwise(values.label(F.col("status"), values.STATUS_LABELS))
    lines = {
        "Type": F.col("doc_type"), "Status": status, "Effective": F.col("effective_date").cast("string"), "Ends": F.col("end_date").cast("string"),
        "Contractors": F.col("line"), "Applies in": where, "Related": F.col("related"),
    }
    return full.select("doc_pk", F.concat_ws("\n", first, *[F.concat(F.lit(f"{k}: "), v) for k, v in lines.items()]).alias("content"))
