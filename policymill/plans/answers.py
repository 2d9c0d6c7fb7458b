"""Queries of the questions that users ask, with each of their parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from policymill.operators import answers
from policymill.operators.corpus import Corpus
from policymill.plans.loading import _EDGES
from policymill.plans.reference import (
    _ACTIVE, _CODES, _CONTRACTORS, _DIST, _DOC_STATES, _FIRST, _HITS, _Q768, _STATES, AS_OF, CODE, MODEL, QUERY_768, WORDS, _resolved, query,
)
from policymill.runtime import table

_ASKED = f"(SELECT DISTINCT state_abbrev FROM {_resolved(_FIRST, _STATES)} WHERE state_abbrev IS NOT NULL)"


def _headers(docs: str, state: bool = False) -> str:
    """SQL of answers.headers over rows of policy_doc."""
    shown = f"WHERE state_abbrev IN {_ASKED}" if state else ""
    rest = "CASE WHEN d.doc_type <> 'NCD' THEN CAST(coalesce(a.n, 0) - coalesce(s.n, 0) AS integer) END" if state else "CAST(NULL AS integer)"
    return f"""(SELECT d.doc_pk, d.public_id, d.doc_type, d.title, d.effective_date, CASE WHEN d.doc_type = 'NCD' THEN '{answers.NATIONAL}' ELSE coalesce(s.x, '') END AS jurisdiction, {rest} AS other_states, h.contractors FROM {docs} d
LEFT JOIN (SELECT doc_pk, string_agg(state_abbrev, ', ' ORDER BY state_abbrev) AS x, count(*) AS n FROM {_DOC_STATES} {shown} GROUP BY 1) s USING (doc_pk)
LEFT JOIN (SELECT doc_pk, count(*) AS n FROM {_DOC_STATES} GROUP BY 1) a USING (doc_pk)
LEFT JOIN (SELECT doc_pk, coalesce(string_agg(DISTINCT contractor_bus_name, '; ' ORDER BY contractor_bus_name), '') AS contractors FROM policy_contractor JOIN {_CONTRACTORS} USING (contractor_id, contractor_type_id, contractor_version) GROUP BY 1) h USING (doc_pk))"""


def _search(scope: str = "true", codes: bool = False, vectors: bool = True, limit: int = 8, state: bool = False) -> str:
    """SQL of answers.search_policy_text."""
    docs = f"(SELECT * FROM {_ACTIVE} d WHERE {scope})"
    chunks = f"(SELECT * FROM doc_chunk WHERE doc_pk IN (SELECT doc_pk FROM {docs}) AND ({str(codes).lower()} OR NOT ends_with(section, '_codes')))"
    kw = f"SELECT chunk_id, row_number() OVER (ORDER BY hits DESC, chunk_id) AS rank FROM (SELECT chunk_id, {_HITS} AS hits FROM {chunks}) WHERE hits > 0 ORDER BY hits DESC, chunk_id LIMIT 50"
    vec = f"SELECT chunk_id, row_number() OVER (ORDER BY dist, chunk_id) AS rank FROM (SELECT chunk_id, {_DIST.format(q=_Q768)} AS dist FROM (SELECT chunk_id, arg_max(embedding, (created_at, len(embedding)))::DOUBLE[] AS v FROM chunk_embedding WHERE model = '{MODEL}' AND len(embedding) = 768 GROUP BY 1) WHERE chunk_id IN (SELECT chunk_id FROM {chunks}) AND list_inner_product(v, v) > 0) WHERE NOT isnan(dist) AND dist IS NOT NULL ORDER BY dist, chunk_id LIMIT 50"
    both = f"SELECT * FROM ({kw})" + (f" UNION ALL SELECT * FROM ({vec})" if vectors else "")
    best = f"(SELECT chunk_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM ({both}) GROUP BY 1 ORDER BY score DESC, chunk_id LIMIT {limit})"
    return f"SELECT h.*, k.chunk_id, k.section, k.heading_path, k.content, b.score FROM {best} b JOIN doc_chunk k USING (chunk_id) JOIN {_headers(docs, state)} h USING (doc_pk)"


def _vectors(spark, sf_dir):
    rows = table(spark, sf_dir, "chunk_embedding").where((F.col("model") == MODEL) & (F.size("embedding") == 768))
    return rows.groupBy("chunk_id").agg(F.max_by("embedding", "created_at").alias("embedding"))


def _state(c: Corpus) -> str:
    return c.states().agg(F.min("description")).first()[0]


@query(_search())
def search_policy_text(spark, sf_dir):
    return answers.search_policy_text(Corpus(spark, sf_dir, AS_OF), WORDS, _vectors(spark, sf_dir), QUERY_768, analyzer="simple")


@query(_search(f"doc_type = 'NCD' OR doc_pk IN (SELECT doc_pk FROM {_DOC_STATES} WHERE state_abbrev IN {_ASKED})", limit=25, state=True))
def search_in_state(spark, sf_dir):
    c = Corpus(spark, sf_dir, AS_OF)
    return answers.search_policy_text(c, WORDS, _vectors(spark, sf_dir), QUERY_768, state=_state(c), limit=25, analyzer="simple")


@query(_search("doc_type = 'ART'", codes=True, vectors=False))
def search_articles_by_keyword(spark, sf_dir):
    """One document type, code lists included, and no query vector."""
    return answers.search_policy_text(Corpus(spark, sf_dir, AS_OF), WORDS, doc_type="article", include_code_lists=True, analyzer="simple")


_SOME = f"(SELECT public_id FROM {_ACTIVE} WHERE public_id IS NOT NULL ORDER BY hash_of LIMIT 40)".replace("hash_of", "sha256(public_id), public_id")


@query(_search(f"public_id IN {_SOME}"))
def search_in_documents(spark, sf_dir):
    """A set of documents, named in lower case."""
    c = Corpus(spark, sf_dir, AS_OF)
    some = [r[0].lower() for r in c.active().where("public_id is not null").select("public_id").orderBy(F.sha2("public_id", 256), "public_id").limit(40).collect()]
    return answers.search_policy_text(c, WORDS, _vectors(spark, sf_dir), QUERY_768, public_ids=some, analyzer="simple")


_NOTES = """(SELECT doc_pk, section, source_key, left(string_agg(content, chr(10) ORDER BY chunk_index, chunk_id), 700) AS group_note FROM doc_chunk WHERE content IS NOT NULL GROUP BY ALL)"""
_RELATED = f"(SELECT doc_pk, array_to_string(list(to_public_id ORDER BY to_public_id)[1:50], '; ') AS related FROM (SELECT DISTINCT e.doc_pk, d.public_id AS to_public_id FROM {_EDGES} e JOIN policy_doc d ON d.doc_type = e.to_type AND d.doc_id = e.to_id WHERE d.is_latest AND NOT d.is_draft AND d.public_id IS NOT NULL) GROUP BY 1)"
_WITH_CODE = f"(SELECT k.* FROM {_CODES} k JOIN {_ACTIVE} d USING (doc_pk) WHERE k.code IN ('{CODE}', '{CODE[:3]}.{CODE[3:]}'))"


@query(f"""SELECT h.*, k.code_system, k.code, k.role, k.group_no, coalesce(k.description, k.short_description) AS description, n.group_note, r.related
FROM (SELECT DISTINCT doc_pk, doc_type, public_id FROM {_WITH_CODE} JOIN policy_doc USING (doc_pk) ORDER BY doc_type DESC, public_id, doc_pk LIMIT 25) p JOIN {_headers(_ACTIVE)} h USING (doc_pk) JOIN {_WITH_CODE} k USING (doc_pk)
LEFT JOIN {_NOTES} n ON n.doc_pk = k.doc_pk AND n.section = lower(k.code_system) || '_' || k.role || '_intro' AND n.source_key = 'group=' || k.group_no LEFT JOIN {_RELATED} r ON r.doc_pk = k.doc_pk""")
def lookup_code_answer(spark, sf_dir):
    return answers.lookup_code(Corpus(spark, sf_dir, AS_OF), CODE.lower())


@query(f"SELECT count(DISTINCT doc_pk) AS policy_count, CASE WHEN count(DISTINCT doc_pk) > 3 THEN (count(DISTINCT doc_pk) - 3) || ' more policies are not shown; name a state or code system' END AS note FROM {_WITH_CODE}")
def lookup_code_note(spark, sf_dir):
    return answers.lookup_note(Corpus(spark, sf_dir, AS_OF), CODE, limit=3)


_FOUND = "(SELECT * FROM policy_doc WHERE public_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY public_id ORDER BY is_latest DESC NULLS LAST, coalesce(status = 'A', false) DESC, doc_version DESC NULLS LAST, doc_pk) = 1)"
_LARGEST = f"(SELECT d.public_id FROM {_FOUND} d JOIN {_CODES} k USING (doc_pk) WHERE k.role = 'covered' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query(f"""WITH r AS (SELECT d.public_id, d.title, k.* FROM {_CODES} k JOIN {_FOUND} d USING (doc_pk) WHERE d.public_id = {_LARGEST} AND k.code_system = 'ICD10CM' AND k.role = 'covered')
SELECT public_id, title, code_system, role, group_no, code, coalesce(description, short_description) AS description, (SELECT count(*) FROM r) AS matching_codes, (SELECT count(*) FROM r) > 15 AS truncated, CASE WHEN (SELECT count(*) FROM r) > 15 THEN 15 END AS next_offset
FROM r ORDER BY code_system, role, group_no NULLS LAST, code, code_pk LIMIT 10 OFFSET 5""")
def list_policy_codes(spark, sf_dir):
    """A page of the covered diagnoses of the document that has most covered codes."""
    c = Corpus(spark, sf_dir, AS_OF)
    docs = answers.corpus.find_doc(c).select("doc_pk", "public_id")
    most = c.codes().where("role = 'covered'").join(docs, "doc_pk").groupBy("public_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "public_id").first()
    return answers.list_policy_codes(c, most.public_id.lower() if most else "", "icd10cm", " Covered ", limit=10, offset=5)


@query(f"""SELECT h.* EXCLUDE (other_states), CASE d.status WHEN 'A' THEN 'active' WHEN 'R' THEN 'retired' WHEN 'P' THEN 'proposed' ELSE d.status END AS doc_status, d.is_draft, d.end_date, d.retired_date, r.related, b.referenced_by, k.code_lists, t.sections,
CASE WHEN t.sections IS NULL THEN 'No text is indexed for this document.' END AS note FROM {_FOUND} d JOIN {_headers(_FOUND)} h USING (doc_pk) LEFT JOIN {_RELATED} r USING (doc_pk)
LEFT JOIN (SELECT doc_pk, array_to_string(list(p ORDER BY p)[1:50], '; ') AS referenced_by FROM (SELECT DISTINCT d.doc_pk, a.public_id AS p FROM policy_doc d JOIN {_EDGES} e ON d.doc_type = e.to_type AND d.doc_id = e.to_id JOIN {_ACTIVE} a ON a.doc_pk = e.doc_pk WHERE a.public_id IS NOT NULL) GROUP BY 1) b USING (doc_pk)
LEFT JOIN (SELECT doc_pk, string_agg(x, '; ' ORDER BY x) AS code_lists FROM (SELECT doc_pk, concat_ws('/', code_system, role) || '=' || count(*) AS x FROM {_CODES} GROUP BY doc_pk, code_system, role) GROUP BY 1) k USING (doc_pk)
LEFT JOIN (SELECT doc_pk, string_agg(x, '; ' ORDER BY f) AS sections FROM (SELECT doc_pk, min(chunk_id) AS f, section || '=' || count(*) || '/' || CAST(coalesce(sum(length(content)), 0) AS bigint) AS x FROM doc_chunk GROUP BY doc_pk, section) GROUP BY 1) t USING (doc_pk)""")
def get_policies(spark, sf_dir):
    """The document of every public id described."""
    return answers.get_policies(Corpus(spark, sf_dir, AS_OF))


_LONGEST = f"(SELECT d.public_id, c.section FROM doc_chunk c JOIN {_FOUND} d USING (doc_pk) GROUP BY 1, 2 ORDER BY sum(length(content)) DESC NULLS LAST, 1, 2 LIMIT 1)"


@query(f"""WITH w AS {_LONGEST}, r AS (SELECT d.public_id, d.title, c.*, lag(heading_path) OVER w2 AS before, row_number() OVER w2 AS rn FROM doc_chunk c JOIN {_FOUND} d USING (doc_pk) JOIN w ON w.public_id = d.public_id AND w.section = c.section WINDOW w2 AS (ORDER BY source_key NULLS FIRST, chunk_index NULLS FIRST, chunk_id)),
t AS (SELECT public_id, title, section, string_agg(CASE WHEN heading_path IS NOT NULL AND (rn = 1 OR heading_path IS DISTINCT FROM before) THEN heading_path || chr(10) ELSE '' END || coalesce(content, ''), chr(10) || chr(10) ORDER BY rn) AS x FROM r GROUP BY ALL)
SELECT public_id, title, section, length(x) AS total_chars, substring(x, 101, 900) AS text, CASE WHEN length(x) > 1000 THEN 1000 END AS next_offset FROM t""")
def get_policy_text(spark, sf_dir):
    """A stretch of the longest section."""
    c = Corpus(spark, sf_dir, AS_OF)
    docs = answers.corpus.find_doc(c).select("doc_pk", "public_id")
    sizes = c.read("doc_chunk").join(docs, "doc_pk").groupBy("public_id", "section").agg(F.sum(F.length("content")).alias("n"))
    most = sizes.orderBy(F.desc_nulls_last("n"), "public_id", "section").first()
    return answers.get_policy_text(c, f" {most.public_id} " if most else "", most.section.upper() if most else "", 100, 900)
