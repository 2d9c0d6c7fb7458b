"""The questions that users ask of the corpus, each as one frame: headers, codes, passages, descriptions and notes.

A scope (states, type, document ids) is applied before anything is ranked. Lists in a row are short by what they list
(states, sections, code lists of a document) or cut to a stated length before rows are brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from policymill.functions import values
from policymill.operators import corpus, relations, retrieval, tables
from policymill.operators.corpus import CODE_SYSTEMS, CONTRACTOR_KEY, Corpus

DOC_TYPES, ROLES = ("LCD", "ART", "NCD"), ("listed", "covered", "noncovered")
MOST_REFERENCES, NOTE_CHARS = 50, 700
NATIONAL = "national (all states)"
HEADER = ["doc_pk", "public_id", "doc_type", "title", "effective_date", "jurisdiction", "other_states", "contractors"]


def doc_type_of(name: str | None) -> str | None:
    """LCD, ART or NCD for a name of any case, `article` included; NULL and empty mean any."""
    given = (name or "").strip().upper()
    given = "ART" if given == "ARTICLE" else given
    if given and given not in DOC_TYPES:
        raise ValueError("doc_type must be 'NCD', 'LCD' or 'ART'")
    return given or None


def _one_of(name: str, given: str | None, known: Sequence[str], upper: bool) -> str | None:
    got = (given or "").strip()
    got = got.upper() if upper else got.lower()
    if got and got not in known:
        raise ValueError(f"{name} must be one of {', '.join(known)}")
    return got or None


def state_list(c: Corpus, state: str | None) -> list[str] | None:
    """Abbreviations that a state name stands for, sorted (a lookup of some dozens of rows); an unknown name is an error."""
    if not state:
        return None
    got = sorted({r[0] for r in corpus.resolve_states(c.states(), state).select("state_abbrev").where("state_abbrev is not null").collect()})
    if not got:
        raise ValueError(f"unknown state {state!r}; use an abbreviation or a full name")
    return got


def headers(c: Corpus, docs: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """HEADER columns of each of `docs`. jurisdiction: `national (all states)` for NCDs, else the states, or those of the ones
    asked for; other_states then counts the rest. contractors: their names."""
    full = c.with_states(docs.select("doc_pk", "public_id", "doc_type", "title", "effective_date"))
    held = c.read("policy_contractor").select("doc_pk", *CONTRACTOR_KEY).distinct().join(c.contractors().select(*CONTRACTOR_KEY, "contractor_bus_name"), CONTRACTOR_KEY)
    names = held.groupBy("doc_pk").agg(F.array_join(F.array_sort(F.collect_set("contractor_bus_name")), "; ").alias("contractors"))
    asked = F.array(*[F.lit(s) for s in states or []]).cast("array<string>")
    shown = F.col("states") if states is None else F.array_sort(F.array_intersect("states", asked))
    national = F.col("doc_type") == "NCD"
    where = F.when(national, NATIONAL).otherwise(F.array_join(shown, ", "))
    rest = F.lit(None).cast("int") if states is None else F.when(~national, F.size("states") - F.size(shown))
    return full.join(names, "doc_pk", "left").select("doc_pk", "public_id", "doc_type", "title", "effective_date", where.alias("jurisdiction"), rest.alias("other_states"), "contractors")


def in_scope(c: Corpus, states: Sequence[str] | None = None, doc_type: str | None = None, public_ids: Sequence[str] | None = None) -> DataFrame:
    """Active documents of a jurisdiction (national ones always), type and set of ids; None means any."""
    docs = c.active()
    if doc_type:
        docs = docs.where(F.col("doc_type") == doc_type)
    if public_ids is not None:
        wanted = c.spark.createDataFrame([(p,) for p in public_ids], "p string").select(values.public_id(F.col("p")).alias("public_id")).distinct()
        docs = docs.join(wanted, "public_id", "left_semi").select(*c.active().columns)
    if states is not None:
        docs = c.with_states(docs).where(corpus.in_jurisdiction(list(states)))
    return docs


def search_policy_text(
    c: Corpus, query_text: str, vectors: DataFrame | None = None, query_vector: list[float] | None = None, state: str | None = None, doc_type: str | None = None,
    public_ids: Sequence[str] | None = None, include_code_lists: bool = False, limit: int = 8, analyzer: str = "english",
) -> DataFrame:
    """Passages (HEADER, chunk_id, section, heading_path, content, score), best first by reciprocal-rank fusion; 1 to 25 of them.

    `vectors` (chunk_id, embedding) with `query_vector` give the second ranking; without them keywords rank alone. Any word
    of the query may match. A passage found by one ranking only is kept. Chunks of code lists are left out unless asked for.
    """
    if not query_text.strip():
        raise ValueError("query_text is empty")
    states = state_list(c, state)
    docs = in_scope(c, states, doc_type_of(doc_type), public_ids)
    scope = c.read("doc_chunk").join(docs.select("doc_pk"), "doc_pk", "left_semi")
    if not include_code_lists:
        scope = scope.where(~F.col("section").endswith("_codes"))
    ranked = [retrieval.keyword_topk(scope, "chunk_id", "content", query_text, analyzer=analyzer)]
    if vectors is not None and query_vector is not None:
        ranked.append(retrieval.vector_topk(vectors.join(scope.select("chunk_id"), "chunk_id", "left_semi"), "chunk_id", "embedding", query_vector))
    best = retrieval.fuse(ranked, "chunk_id", max(1, min(25, limit)))
    found = scope.join(F.broadcast(best), "chunk_id")  # at most 25 rows
    told = headers(c, docs.join(F.broadcast(found.select("doc_pk").distinct()), "doc_pk", "left_semi"), states)
    return told.join(found.select("doc_pk", "chunk_id", "section", "heading_path", "content", "score"), "doc_pk").orderBy(F.desc("score"), "chunk_id")


def search_note(found: DataFrame, keyword_only: bool = False) -> DataFrame:
    """One row (results, note) about the passages of search_policy_text."""
    n = found.agg(F.count(F.lit(1)).alias("results"))
    text = F.when(F.col("results") == 0, "No passages matched. Use other words, or leave out the state or document type.")
    return n.select("results", F.coalesce(text, F.lit("Ranked by keywords only, as there is no query vector." if keyword_only else None)).alias("note"))


def _matches(c: Corpus, code: str, states: Sequence[str] | None, system: str | None) -> DataFrame:
    """Code rows of active documents in the states that list a code."""
    system = _one_of("code_system", system, CODE_SYSTEMS, upper=True)
    hits = c.codes().where(F.col("code").isin(values.code_candidates(code, system)))
    if system:
        hits = hits.where(F.col("code_system") == system)
    return hits.join(in_scope(c, states).select("doc_pk", "public_id", "doc_type"), "doc_pk")


def group_notes(c: Corpus, lists: DataFrame) -> DataFrame:
    """(doc_pk, code_system, role, group_no, group_note): the first NOTE_CHARS characters of the introductions to code groups."""
    keys = ["doc_pk", "code_system", "role", "group_no"]
    wanted = lists.select(*keys).distinct().withColumn("section", F.concat(F.lower("code_system"), F.lit("_"), "role", F.lit("_intro"))).withColumn("source_key", F.concat(F.lit("group="), F.col("group_no").cast("string")))
    rows = c.read("doc_chunk").where("content is not null").select("doc_pk", "section", "source_key", "chunk_index", "chunk_id", F.substring("content", 1, NOTE_CHARS).alias("content"))
    first = Window.partitionBy(*keys).orderBy("chunk_index", "chunk_id")
    rows = wanted.join(rows, ["doc_pk", "section", "source_key"]).withColumn("i", F.row_number().over(first)).where(F.col("i") <= NOTE_CHARS)  # a line break each
    per = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "content"))).alias("x"))
    return per.select(*keys, F.substring(F.array_join("x.content", "\n"), 1, NOTE_CHARS).alias("group_note"))


def lookup_code(c: Corpus, code: str, state: str | None = None, system: str | None = None, limit: int = 25) -> DataFrame:
    """(HEADER, code_system, code, role, group_no, description, group_note, related) of a code's matches in the first `limit` documents.

    Documents come in the order of type (descending) and id; `related` names the documents that each refers to.
    """
    states = state_list(c, state)
    hits = _matches(c, code, states, system)
    docs = hits.select("doc_pk", "public_id", "doc_type").distinct()
    docs = tables.page(docs, [F.desc("doc_type"), F.asc("public_id"), F.asc("doc_pk")], limit).select("doc_pk")  # at most 100 rows
    own = hits.join(F.broadcast(docs), "doc_pk", "left_semi").drop("public_id", "doc_type")
    notes = group_notes(c, own)
    same = own.join(notes.withColumnsRenamed({k: f"n_{k}" for k in ("doc_pk", "code_system", "role", "group_no")}), [F.col(k).eqNullSafe(F.col(f"n_{k}")) for k in ("doc_pk", "code_system", "role", "group_no")], "left")
    told = headers(c, c.active().join(F.broadcast(docs), "doc_pk", "left_semi"), states).join(_related_ids(c, docs), "doc_pk", "left")
    return told.join(same.select("doc_pk", "code_system", "code", "role", "group_no", F.coalesce("description", "short_description").alias("description"), "group_note"), "doc_pk")


def lookup_note(c: Corpus, code: str, state: str | None = None, system: str | None = None, limit: int = 25) -> DataFrame:
    """One row (policy_count, note): how many documents list a code; that none does is no finding of non-coverage."""
    n = _matches(c, code, state_list(c, state), system).agg(F.countDistinct("doc_pk").alias("policy_count"))
    shown = max(1, min(100, limit))
    more = F.concat((F.col("policy_count") - shown).cast("string"), F.lit(" more policies are not shown; name a state or code system"))
    none = F.lit("No active policy lists this code here. That is no finding of non-coverage: look for national policies and policy text.")
    return n.select("policy_count", F.when(F.col("policy_count") == 0, none).when(F.col("policy_count") > shown, more).alias("note"))


def code_lists(c: Corpus, docs: DataFrame) -> DataFrame:
    """(doc_pk, code_system, role, group_no, codes) of all code lists of `docs`."""
    return c.codes().join(docs.select("doc_pk"), "doc_pk", "left_semi").groupBy("doc_pk", "code_system", "role", "group_no").agg(F.count(F.lit(1)).alias("codes"))


def list_policy_codes(
    c: Corpus, public_id: str, system: str | None = None, role: str | None = None, starts_with: str | None = None, limit: int = 50, offset: int = 0
) -> DataFrame:
    """(public_id, title, code_system, role, group_no, code, description, matching_codes, truncated, next_offset): one page of a document's codes.

    matching_codes counts all that fit the filters; 1 to 100 codes a page. Prefixes are literal.
    """
    system, role = _one_of("code_system", system, CODE_SYSTEMS, upper=True), _one_of("role", role, ROLES, upper=False)
    doc = document(c, public_id).select("doc_pk", "public_id", "title")
    rows = c.codes().join(F.broadcast(doc), "doc_pk")  # one row
    for column, value in (("code_system", system), ("role", role)):
        if value:
            rows = rows.where(F.col(column) == value)
    if starts_with and starts_with.strip():
        rows = rows.where(F.startswith("code", F.lit(starts_with.strip().upper())))
    limit, offset = max(1, min(100, limit)), max(0, offset)
    order = [F.asc("code_system"), F.asc("role"), F.asc_nulls_last("group_no"), F.asc("code"), F.asc("code_pk")]
    total = rows.groupBy("doc_pk").agg(F.count(F.lit(1)).alias("matching_codes"))
    page = tables.page(rows, order, limit, offset).join(total, "doc_pk")
    more = F.col("matching_codes") > offset + limit
    return page.select("public_id", "title", "code_system", "role", "group_no", "code", F.coalesce("description", "short_description").alias("description"), "matching_codes", more.alias("truncated"), F.when(more, F.lit(offset + limit)).alias("next_offset"))


def document(c: Corpus, public_id: str) -> DataFrame:
    """The row that stands for a public id in any of its spellings; no row for an unknown one."""
    wanted = c.spark.createDataFrame([(public_id,)], "p string").select(values.public_id(F.col("p")).alias("public_id"))
    return corpus.find_doc(c).join(F.broadcast(wanted), "public_id", "left_semi")


def _first_ids(pairs: DataFrame, most: int, order: Sequence[Column]) -> DataFrame:
    """(doc_pk, ids): the first `most` ids of each document, cut before they are brought together."""
    first = Window.partitionBy("doc_pk").orderBy(*order)
    few = pairs.withColumn("i", F.row_number().over(first)).where(F.col("i") <= most)
    per = few.groupBy("doc_pk").agg(F.array_sort(F.collect_list(F.struct("i", "id"))).alias("x"))
    return per.select("doc_pk", F.array_join("x.id", "; ").alias("ids"))


def _related_ids(c: Corpus, docs: DataFrame) -> DataFrame:
    pairs = relations.related(c, relations.edges(c).join(docs.select("doc_pk"), "doc_pk", "left_semi")).select("doc_pk", F.col("to_public_id").alias("id")).where("id is not null").distinct()
    return _first_ids(pairs, MOST_REFERENCES, [F.asc("id")]).withColumnRenamed("ids", "related")


def get_policies(c: Corpus, docs: DataFrame | None = None) -> DataFrame:
    """Each of `docs` (default: the document of every public id) described in one row.

    HEADER without other_states, then doc_status, is_draft, end_date, retired_date, related and referenced_by (ids, at most
    MOST_REFERENCES), code_lists (`system/role=codes`), sections (`section=chunks/characters` in the order of the
    document) and a note where there is no text.
    """
    docs = docs if docs is not None else corpus.find_doc(c)
    head = docs.select("doc_pk", values.label(F.col("status"), values.STATUS_LABELS).alias("doc_status"), "is_draft", "end_date", "retired_date")
    back = relations.referenced_by(c, relations.edges(c)).join(docs.select("doc_pk"), "doc_pk", "left_semi").select("doc_pk", F.col("from_public_id").alias("id")).where("id is not null").distinct()
    back = _first_ids(back, MOST_REFERENCES, [F.asc("id")]).withColumnRenamed("ids", "referenced_by")
    lists = code_lists(c, docs).groupBy("doc_pk", "code_system", "role").agg(F.sum("codes").alias("codes"))
    item = F.concat(F.concat_ws("/", "code_system", "role"), F.lit("="), F.col("codes").cast("string"))
    lists = lists.groupBy("doc_pk").agg(F.array_join(F.array_sort(F.collect_list(item)), "; ").alias("code_lists"))
    parts = c.read("doc_chunk").join(docs.select("doc_pk"), "doc_pk", "left_semi").groupBy("doc_pk", "section").agg(
        F.min("chunk_id").alias("first"), F.count(F.lit(1)).alias("chunks"), F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("chars")
    )
    item = F.concat(F.coalesce("section", F.lit("")), F.lit("="), F.col("chunks").cast("string"), F.lit("/"), F.col("chars").cast("string"))
    parts = parts.groupBy("doc_pk").agg(F.array_join(F.array_sort(F.collect_list(F.struct("first", item.alias("x"))))["x"], "; ").alias("sections"))
    out = headers(c, docs).drop("other_states").join(head, "doc_pk")
    for more in (_related_ids(c, docs), back, lists, parts):
        out = out.join(more, "doc_pk", "left")
    return out.withColumn("note", F.when(F.col("sections").isNull(), "No text is indexed for this document."))


def get_policy(c: Corpus, public_id: str) -> DataFrame:
    """The description of one document."""
    return get_policies(c, document(c, public_id))


def get_policy_text(c: Corpus, public_id: str, section: str, offset: int = 0, most: int = 6000) -> DataFrame:
    """(public_id, title, section, total_chars, text, next_offset): a stretch of one section; no row if there is none."""
    doc, wanted = document(c, public_id).select("doc_pk", "public_id", "title"), section.strip().lower()
    chunks = c.read("doc_chunk").where(F.col("section") == wanted).join(F.broadcast(doc.select("doc_pk")), "doc_pk", "left_semi")  # one row
    return corpus.text_page(c, offset, most, chunks).join(F.broadcast(doc), "doc_pk").select("public_id", "title", "section", "total_chars", "text", "next_offset")
