"""Queries over the corpus tables and the SQL that answers the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from policymill.functions import markup, values
from policymill.operators import chunking, corpus, embedding, evaluate, retrieval, tables
from policymill.operators.corpus import CONTRACTOR_KEY, Corpus
from policymill.runtime import materialize, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
AS_OF, CODE, WORDS, MODEL = "2025-06-01", "Y8385", "oxygen ventilator apnea", "policy-embed:v2"
QUERY_64 = [((i * 37) % 64 - 31.5) / 64 for i in range(64)]
QUERY_768 = [((i * 331) % 768 - 383.5) / 768 for i in range(768)]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_ACTIVE = f"(SELECT * FROM policy_doc WHERE status = 'A' AND NOT is_draft AND is_latest AND (effective_date IS NULL OR effective_date <= DATE '{AS_OF}') AND (end_date IS NULL OR end_date >= DATE '{AS_OF}'))"
_STATES = "(SELECT * FROM state_lookup QUALIFY row_number() OVER (PARTITION BY state_id ORDER BY loaded_at DESC, load_id DESC) = 1)"
_CONTRACTORS = f"(SELECT c.* EXCLUDE (state_id), s.state_id FROM (SELECT * FROM contractor QUALIFY row_number() OVER (PARTITION BY contractor_id, contractor_type_id, contractor_version ORDER BY loaded_at DESC, load_id DESC) = 1) c LEFT JOIN {_STATES} s ON s.state_id = c.state_id WHERE coalesce(c.status, '') <> 'D')"
_CODES = "(SELECT * FROM policy_code WHERE code <> '' QUALIFY row_number() OVER (PARTITION BY doc_pk, code_system, role, code, coalesce(code_version, 0), coalesce(group_no, 0), coalesce(range_pos, '-') ORDER BY code_pk) = 1)"
_DOC_STATES = f"(SELECT DISTINCT pc.doc_pk, s.state_abbrev FROM policy_contractor pc JOIN {_CONTRACTORS} c USING (contractor_id, contractor_type_id, contractor_version) JOIN {_STATES} s ON s.state_id = c.state_id WHERE s.state_abbrev IS NOT NULL)"

_NAMES = f"""m AS (SELECT DISTINCT pc.doc_pk, contractor_bus_name AS b, coalesce(contractor_number, '?') AS no FROM policy_contractor pc JOIN {_CONTRACTORS} c USING (contractor_id, contractor_type_id, contractor_version) WHERE contractor_bus_name IS NOT NULL),
n AS (SELECT doc_pk, b || ' (' || array_to_string(list(no ORDER BY no)[1:4], ', ') || CASE WHEN count(*) > 4 THEN '...' ELSE '' END || ')' AS n FROM m GROUP BY doc_pk, b)"""


@query(f"SELECT doc_pk, public_id, doc_type FROM {_ACTIVE}")
def active_policies(spark, sf_dir):
    return Corpus(spark, sf_dir, AS_OF).active().select("doc_pk", "public_id", "doc_type")


@query("SELECT doc_pk, doc_version = max(doc_version) OVER (PARTITION BY doc_type, doc_id) AS newest FROM policy_doc")
def latest_version(spark, sf_dir):
    docs = table(spark, sf_dir, "policy_doc").select("doc_pk", "doc_type", "doc_id", "doc_version")
    return tables.mark_greatest(docs, ["doc_type", "doc_id"], "doc_version", "newest").select("doc_pk", "newest")


@query("SELECT public_id, doc_pk FROM (SELECT public_id, doc_pk, row_number() OVER (PARTITION BY public_id ORDER BY is_latest DESC NULLS LAST, coalesce(status = 'A', false) DESC, doc_version DESC NULLS LAST, doc_pk) AS rn FROM policy_doc WHERE public_id IS NOT NULL) WHERE rn = 1")
def find_doc(spark, sf_dir):
    return corpus.find_doc(Corpus(spark, sf_dir)).select("public_id", "doc_pk")


@query(f"SELECT code_pk, doc_pk, code FROM {_CODES}")
def code_dedupe_first(spark, sf_dir):
    return Corpus(spark, sf_dir).codes().select("code_pk", "doc_pk", "code")


@query(f"SELECT load_id, contractor_bus_name, state_id FROM {_CONTRACTORS}")
def contractor_last(spark, sf_dir):
    return Corpus(spark, sf_dir).contractors().select("load_id", "contractor_bus_name", "state_id")


@query(f"SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def refresh_upsert_last(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    half = e.agg(F.max("event_id")).select((F.col("max(event_id)") / 2).alias("h"))
    old, new = e.join(F.broadcast(half), F.col("event_id") <= F.col("h")).drop("h"), e.join(F.broadcast(half), F.col("event_id") > F.col("h")).drop("h")
    key, order = ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]
    return tables.upsert(tables.keep_one(old, key, order), tables.keep_one(new, key, order), key).select("user_id", "event_type", "event_id", "value")


@query(f"SELECT pc.load_id, pc.doc_pk FROM policy_contractor pc SEMI JOIN {_CONTRACTORS} c USING (contractor_id, contractor_type_id, contractor_version)")
def fk_drop(spark, sf_dir):
    c = Corpus(spark, sf_dir)
    return tables.keep_known(c.read("policy_contractor"), c.contractors(), CONTRACTOR_KEY).select("load_id", "doc_pk")


@query(f"SELECT contractor_id, count(*) AS dropped FROM (SELECT pc.* FROM policy_contractor pc ANTI JOIN {_CONTRACTORS} c USING (contractor_id, contractor_type_id, contractor_version)) GROUP BY 1")
def orphan_count(spark, sf_dir):
    c = Corpus(spark, sf_dir)
    return tables.unknown(c.read("policy_contractor"), c.contractors(), CONTRACTOR_KEY).groupBy("contractor_id").agg(F.count(F.lit(1)).alias("dropped"))


@query(f"SELECT doc_pk, string_agg(state_abbrev, ',' ORDER BY state_abbrev) AS states FROM {_DOC_STATES} GROUP BY 1")
def policy_states(spark, sf_dir):
    c = Corpus(spark, sf_dir)
    return c.with_states(c.doc_states().select("doc_pk").distinct()).select("doc_pk", F.array_join("states", ",").alias("states"))


@query(f"""SELECT d.doc_pk, count(*) AS matches, string_agg(DISTINCT x, '; ' ORDER BY x) AS listed FROM (SELECT *, code_system || '/' || role || '/' || coalesce(CAST(group_no AS varchar), '-') || '/' || code AS x FROM {_CODES} WHERE code IN ('{CODE}', '{CODE[:3]}.{CODE[3:]}')) k
JOIN {_ACTIVE} d USING (doc_pk) GROUP BY d.doc_pk, d.doc_type, d.public_id ORDER BY d.doc_type DESC, d.public_id, d.doc_pk LIMIT 25""")
def lookup_code(spark, sf_dir):
    return corpus.lookup_code(Corpus(spark, sf_dir, AS_OF), CODE).select("doc_pk", "matches", "listed")


@query(f"""SELECT d.doc_pk, count(*) AS matches FROM (SELECT * FROM {_CODES} WHERE code_system = 'HCPCS' AND code = '{CODE}') k JOIN {_ACTIVE} d USING (doc_pk)
WHERE d.doc_type = 'NCD' OR d.doc_pk IN (SELECT doc_pk FROM {_DOC_STATES} WHERE state_abbrev IN (SELECT state_abbrev FROM {_STATES} ORDER BY state_abbrev LIMIT 20)) GROUP BY d.doc_pk, d.doc_type, d.public_id ORDER BY d.doc_type DESC, d.public_id, d.doc_pk LIMIT 100""")
def lookup_code_state(spark, sf_dir):
    c = Corpus(spark, sf_dir, AS_OF)
    states = [r[0] for r in c.states().where("state_abbrev is not null").select("state_abbrev").orderBy("state_abbrev").limit(20).collect()]
    return corpus.lookup_code(c, CODE, states, "HCPCS", 100).select("doc_pk", "matches")


@query(f"SELECT doc_pk, code_system, role, group_no, count(*) AS codes FROM {_CODES} GROUP BY ALL")
def code_list_summary(spark, sf_dir):
    return Corpus(spark, sf_dir).codes().groupBy("doc_pk", "code_system", "role", "group_no").agg(F.count(F.lit(1)).alias("codes"))


@query(f"SELECT doc_pk, code_system, role, group_no, code, coalesce(description, short_description) AS description FROM {_CODES} WHERE starts_with(code, 'W') ORDER BY doc_pk, code_system, role, group_no NULLS LAST, sort_order NULLS LAST, code, code_pk LIMIT 100 OFFSET 50")
def code_list_page(spark, sf_dir):
    rows = Corpus(spark, sf_dir).codes().where(F.col("code").startswith("W"))
    order = [F.asc("doc_pk"), F.asc("code_system"), F.asc("role"), F.asc_nulls_last("group_no"), F.asc_nulls_last("sort_order"), F.asc("code"), F.asc("code_pk")]
    return tables.page(rows, order, 100, 50).select("doc_pk", "code_system", "role", "group_no", "code", F.coalesce("description", "short_description").alias("description"))


@query(f"""SELECT d.doc_pk, CASE WHEN d.doc_type = 'NCD' THEN 'national (all states)' ELSE coalesce(s.states, '') END AS jurisdiction, coalesce(t.sections, 0) AS sections, coalesce(t.chunks, 0) AS chunks, CAST(coalesce(t.chars, 0) AS bigint) AS chars, coalesce(k.codes, 0) AS codes, coalesce(h.contractors, 0) AS contractors
FROM {_ACTIVE} d LEFT JOIN (SELECT doc_pk, string_agg(state_abbrev, ',' ORDER BY state_abbrev) AS states FROM {_DOC_STATES} GROUP BY 1) s USING (doc_pk)
LEFT JOIN (SELECT doc_pk, count(DISTINCT section) AS sections, count(*) AS chunks, sum(length(content)) AS chars FROM doc_chunk GROUP BY 1) t USING (doc_pk)
LEFT JOIN (SELECT doc_pk, count(*) AS codes FROM {_CODES} GROUP BY 1) k USING (doc_pk)
LEFT JOIN (SELECT pc.doc_pk, count(DISTINCT contractor_bus_name) AS contractors FROM policy_contractor pc JOIN {_CONTRACTORS} c USING (contractor_id, contractor_type_id, contractor_version) GROUP BY 1) h USING (doc_pk)""")
def policy_profile(spark, sf_dir):
    return corpus.profile(Corpus(spark, sf_dir, AS_OF)).select("doc_pk", "jurisdiction", "sections", "chunks", "chars", "codes", "contractors")


_TEXTS = """WITH r AS (SELECT *, lag(heading_path) OVER w AS before, row_number() OVER w AS rn FROM doc_chunk WINDOW w AS (PARTITION BY doc_pk, section ORDER BY source_key NULLS FIRST, chunk_index NULLS FIRST, chunk_id)),
t AS (SELECT doc_pk, section, string_agg(CASE WHEN heading_path IS NOT NULL AND (rn = 1 OR heading_path IS DISTINCT FROM before) THEN heading_path || chr(10) ELSE '' END || coalesce(content, ''), chr(10) || chr(10) ORDER BY rn) AS x FROM r GROUP BY 1, 2)"""


@query(f"{_TEXTS} SELECT doc_pk, section, CAST(i AS bigint) AS page_no, sha256(substring(x, CAST(i * 3000 + 1 AS bigint), 3000)) AS digest FROM (SELECT *, unnest(range(greatest(1, CAST(ceil(length(x) / 3000.0) AS bigint)))) AS i FROM t)")
def policy_text(spark, sf_dir):
    """Whole section texts, page by page."""
    return corpus.section_pages(Corpus(spark, sf_dir), 3000).select("doc_pk", "section", "page_no", F.sha2("text", 256).alias("digest"))


@query("""WITH r AS (SELECT *, lag(heading_path) OVER w AS before, row_number() OVER w AS rn FROM doc_chunk WINDOW w AS (PARTITION BY doc_pk, section ORDER BY source_key NULLS FIRST, chunk_index NULLS FIRST, chunk_id)),
t AS (SELECT doc_pk, section, string_agg(CASE WHEN heading_path IS NOT NULL AND (rn = 1 OR heading_path IS DISTINCT FROM before) THEN heading_path || chr(10) ELSE '' END || coalesce(content, ''), chr(10) || chr(10) ORDER BY rn) AS x FROM r GROUP BY 1, 2)
SELECT doc_pk, section, length(x) AS total_chars, substring(x, 501, 1000) AS text, CASE WHEN length(x) > 1500 THEN 1500 END AS next_offset FROM t""")
def policy_text_page(spark, sf_dir):
    return corpus.text_page(Corpus(spark, sf_dir), 500, 1000)


@query(f"""WITH {_NAMES}, l AS (SELECT doc_pk, list(n ORDER BY n) AS a FROM n GROUP BY 1) SELECT doc_pk, array_to_string(a[1:8], '; ') || CASE WHEN len(a) > 8 THEN '; +' || (len(a) - 8) || ' more' ELSE '' END AS line FROM l WHERE doc_pk IN (SELECT doc_pk FROM {_ACTIVE})""")
def contractor_overview(spark, sf_dir):
    return corpus.contractor_overview(Corpus(spark, sf_dir, AS_OF))


# State names with parts: the reference table has none, so the bases are the types of contractors' states put to parts.
_PARTS = f"""(SELECT state_id, CASE WHEN state_id % 4 = 1 THEN state_abbrev ELSE substring(state_abbrev, 1, 1) || (state_id % 4) END AS state_abbrev,
substring(description, 1, 2) || CASE state_id % 4 WHEN 0 THEN '' WHEN 1 THEN ' - Entire State' WHEN 2 THEN ' - Northern' ELSE ' - Southern' END AS description FROM {_STATES})"""


def _resolved(name: str, src: str) -> str:
    return f"""(WITH r AS (SELECT state_id, state_abbrev, description, lower(trim(split_part(description, ' - ', 1))) AS base, lower(description) LIKE '%entire state%' AS entire,
CASE WHEN lower(state_abbrev) = {name} THEN 1 WHEN lower(trim(description)) = {name} THEN 2 WHEN lower(trim(split_part(description, ' - ', 1))) = {name} THEN 3 END AS tier FROM {src}),
h AS (SELECT * FROM r WHERE tier = (SELECT min(tier) FROM r)), o AS (SELECT count(*) = 1 AND bool_and(description LIKE '% - %' AND NOT entire) AS alone FROM h)
SELECT DISTINCT state_id, state_abbrev FROM r WHERE base IN (SELECT base FROM h) AND (NOT (SELECT alone FROM o) OR entire OR state_id IN (SELECT state_id FROM h)))"""


_FIRST = f"(SELECT lower(min(description)) FROM {_STATES})"
_NORTH = f"(SELECT lower(min(description)) FROM {_PARTS} WHERE description LIKE '% - Northern')"


@query(f"SELECT 'whole' AS asked, * FROM {_resolved(_FIRST, _STATES)} UNION ALL SELECT 'part', * FROM {_resolved(_NORTH, _PARTS)} UNION ALL SELECT 'base', * FROM {_resolved(f'substring({_NORTH}, 1, 2)', _PARTS)}")
def resolve_states(spark, sf_dir):
    """A state of the table, then a part and its base among names that are given parts."""
    s = Corpus(spark, sf_dir).states()
    kind = F.col("state_id") % 4
    end = F.when(kind == 0, "").when(kind == 1, " - Entire State").when(kind == 2, " - Northern").otherwise(" - Southern")
    short = F.when(kind == 1, F.col("state_abbrev")).otherwise(F.concat(F.substring("state_abbrev", 1, 1), kind.cast("string")))
    parts = s.select("state_id", short.alias("state_abbrev"), F.concat(F.substring("description", 1, 2), end).alias("description"))
    north = parts.where(F.endswith("description", F.lit(" - Northern"))).agg(F.min("description")).first()[0] or ""
    asked = {"whole": (s, s.agg(F.min("description")).first()[0]), "part": (parts, north), "base": (parts, north[:2])}
    return tables.union_all([corpus.resolve_states(frame, name).select(F.lit(k).alias("asked"), "state_id", "state_abbrev") for k, (frame, name) in asked.items()])


_Q64 = "[" + ",".join(f"{x!r}" for x in QUERY_64) + "]::DOUBLE[]"
_Q768 = "[" + ",".join(f"{x!r}" for x in QUERY_768) + "]::DOUBLE[]"
_DIST = "1 - list_inner_product(v, {q}) / (sqrt(list_inner_product(v, v)) * sqrt(list_inner_product({q}, {q})))"


@query(f"SELECT vec_id, round({_DIST.format(q=_Q64)}, 6) AS distance FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) ORDER BY {_DIST.format(q=_Q64)}, vec_id LIMIT 50")
def vector_topk(spark, sf_dir):
    return retrieval.vector_topk(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", QUERY_64).select("vec_id", F.round("distance", 6).alias("distance"))


@query(f"SELECT vec_id, round({_DIST.format(q=_Q64)}, 6) AS distance FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE label IN (1, 4)) ORDER BY {_DIST.format(q=_Q64)}, vec_id LIMIT 20")
def vector_topk_filtered(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").where(F.col("label").isin(1, 4))
    return retrieval.vector_topk(rows, "vec_id", "embedding", QUERY_64, 20).select("vec_id", F.round("distance", 6).alias("distance"))


_WORDS = "[" + ",".join(f"'{w}'" for w in WORDS.split()) + "]"
_SCOPE = f"(SELECT c.* FROM doc_chunk c WHERE c.doc_pk IN (SELECT doc_pk FROM {_ACTIVE}) AND NOT ends_with(section, '_codes'))"
_HITS = f"len(list_filter(string_split_regex(lower(content), '[^a-z0-9]+'), lambda x: list_contains({_WORDS}, x)))"
_KW = f"SELECT chunk_id, hits, row_number() OVER (ORDER BY hits DESC, chunk_id) AS rank FROM (SELECT chunk_id, CAST({_HITS} AS bigint) AS hits FROM {_SCOPE}) WHERE hits > 0 ORDER BY hits DESC, chunk_id LIMIT 50"


def _scope(spark, sf_dir) -> DataFrame:
    c = Corpus(spark, sf_dir, AS_OF)
    return c.read("doc_chunk").join(c.active().select("doc_pk"), "doc_pk", "left_semi").where(~F.col("section").endswith("_codes"))


_SCORED = f"SELECT chunk_id, hits, rank, round(hits * 0.1::DOUBLE / (hits * 0.1::DOUBLE + 1), 6) AS score FROM ({_KW})"


@query(_SCORED)
def keyword_topk(spark, sf_dir):
    return retrieval.keyword_topk(_scope(spark, sf_dir), "chunk_id", "content", WORDS).withColumn("score", F.round("score", 6))


@query("SELECT lexeme, count(*) AS chunks, CAST(sum(n) AS bigint) AS occurrences FROM (SELECT chunk_id, lexeme, count(*) AS n FROM (SELECT chunk_id, unnest(string_split_regex(lower(content), '[^a-z0-9]+')) AS lexeme FROM doc_chunk) WHERE lexeme <> '' GROUP BY 1, 2) GROUP BY 1")
def lexeme_counts(spark, sf_dir):
    """In how many chunks and how often each lexeme occurs."""
    words = retrieval.lexeme_table(table(spark, sf_dir, "doc_chunk"), "chunk_id", "content")
    return words.groupBy("lexeme").agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("occurrences"))


@query(_SCORED)
def lexeme_topk(spark, sf_dir):
    """The ranking of keyword_topk from a written lexeme table."""
    words = materialize(retrieval.lexeme_table(_scope(spark, sf_dir), "chunk_id", "content"), "lexemes")
    return retrieval.lexeme_topk(words, "chunk_id", WORDS).withColumn("score", F.round("score", 6))


@query()
def keyword_english(spark, sf_dir):
    return retrieval.keyword_topk(_scope(spark, sf_dir), "chunk_id", "content", "the monitoring of patients with ventilators", analyzer="english")


_VEC = f"SELECT chunk_id, row_number() OVER (ORDER BY dist, chunk_id) AS rank FROM (SELECT chunk_id, {_DIST.format(q=_Q768)} AS dist FROM (SELECT chunk_id, arg_max(embedding, (created_at, len(embedding)))::DOUBLE[] AS v FROM chunk_embedding WHERE model = '{MODEL}' AND len(embedding) = 768 GROUP BY 1) WHERE chunk_id IN (SELECT chunk_id FROM {_SCOPE}) AND list_inner_product(v, v) > 0) WHERE NOT isnan(dist) AND dist IS NOT NULL ORDER BY dist, chunk_id LIMIT 50"


@query(f"SELECT chunk_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT chunk_id, rank FROM ({_VEC}) UNION ALL SELECT chunk_id, rank FROM ({_KW})) GROUP BY 1 ORDER BY score DESC, chunk_id LIMIT 8")
def hybrid_search(spark, sf_dir):
    scope = _scope(spark, sf_dir)
    vectors = table(spark, sf_dir, "chunk_embedding").where((F.col("model") == MODEL) & (F.size("embedding") == 768))
    vectors = vectors.groupBy("chunk_id").agg(F.max_by("embedding", "created_at").alias("embedding"))
    vec = retrieval.vector_topk(vectors.join(scope.select("chunk_id"), "chunk_id", "left_semi"), "chunk_id", "embedding", QUERY_768)
    return retrieval.fuse([vec, retrieval.keyword_topk(scope, "chunk_id", "content", WORDS)], "chunk_id")


@query()
def chunk_text(spark, sf_dir):
    return chunking.chunk_texts(table(spark, sf_dir, "lcd"), ["doc_pk"], "indication")


_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(f"SELECT doc_pk, sha256(regexp_replace(indication, '{_WS}', '', 'g')) AS digest, true AS in_bounds FROM lcd WHERE regexp_replace(indication, '{_WS}', '', 'g') <> ''")
def chunk_cover(spark, sf_dir):
    """The chunks of a text, without what they carry over, hold all its characters but blanks, in order and within the sizes."""
    z = chunking.Sizes()
    c = chunking.pieces(table(spark, sf_dir, "lcd"), ["doc_pk"], "indication")
    fresh = F.regexp_replace(F.substring("body", F.col("carried") + 1, F.length("body")), _WS, "")
    fits = (F.length("body") <= z.hard + z.carry + 2) & (F.col("carried") <= z.carry + 2) & ((F.col("chunk_index") > 0) | (F.col("carried") == 0))
    per = c.groupBy("doc_pk").agg(F.array_sort(F.collect_list(F.struct("chunk_index", fresh.alias("x")))).alias("all"), F.every(fits).alias("in_bounds"))  # the rows of one text
    return per.select("doc_pk", F.sha2(F.array_join("all.x", ""), 256).alias("digest"), "in_bounds")


@query("SELECT chunk_id, sha256(CASE WHEN heading_path IS NULL THEN coalesce(content, '') ELSE heading_path || CASE WHEN content IS NULL THEN '' ELSE chr(10) || content END END) AS digest, greatest(1, (coalesce(length(heading_path), 0) + coalesce(length(content), 0)) // 4)::INTEGER AS tokens FROM doc_chunk")
def chunk_hash(spark, sf_dir):
    h, c = F.col("heading_path"), F.col("content")
    return table(spark, sf_dir, "doc_chunk").select("chunk_id", values.content_hash(h, c).alias("digest"), values.tokens_estimate(h, c).alias("tokens"))


_EDITED = "(SELECT doc_pk, section, source_key, chunk_index, CASE WHEN chunk_index % 3 = 1 THEN sha256(content_hash) ELSE content_hash END AS content_hash FROM doc_chunk WHERE section <> 'description' UNION ALL SELECT doc_pk, section, source_key, chunk_index + 100000, content_hash FROM doc_chunk WHERE section = 'indication')"


@query(f"SELECT doc_pk, section, source_key, chunk_index, CASE WHEN o.h IS NULL THEN 'inserted' WHEN n.h IS NULL THEN 'deleted' WHEN o.h = n.h THEN 'unchanged' ELSE 'updated' END AS action FROM (SELECT doc_pk, section, source_key, chunk_index, content_hash AS h FROM doc_chunk) o FULL JOIN (SELECT doc_pk, section, source_key, chunk_index, content_hash AS h FROM {_EDITED}) n USING (doc_pk, section, source_key, chunk_index)")
def chunk_diff(spark, sf_dir):
    old = table(spark, sf_dir, "doc_chunk").select(*chunking.CHUNK_KEY, "content_hash")
    edited = old.where("section <> 'description'").withColumn("content_hash", F.when(F.col("chunk_index") % 3 == 1, F.sha2("content_hash", 256)).otherwise(F.col("content_hash")))
    added = old.where("section = 'indication'").withColumn("chunk_index", F.col("chunk_index") + 100000)
    return chunking.diff(old, edited.unionByName(added))


def _applied(spark, sf_dir):
    """The chunks and vectors after the edits of chunk_diff."""
    chunks = table(spark, sf_dir, "doc_chunk").select("chunk_id", *chunking.CHUNK_KEY, "content_hash")
    own = chunks.drop("chunk_id")
    edited = own.where("section <> 'description'").withColumn("content_hash", F.when(F.col("chunk_index") % 3 == 1, F.sha2("content_hash", 256)).otherwise(F.col("content_hash")))
    added = own.where("section = 'indication'").withColumn("chunk_index", F.col("chunk_index") + 100000)
    return chunking.apply_diff(chunks, edited.unionByName(added), table(spark, sf_dir, "chunk_embedding"))


_OLD = "(SELECT chunk_id, doc_pk, section, source_key, chunk_index, content_hash AS old_hash FROM doc_chunk)"


@query(f"SELECT n.doc_pk, n.section, n.source_key, n.chunk_index, n.content_hash, o.chunk_id AS kept_id FROM {_EDITED} n LEFT JOIN {_OLD} o USING (doc_pk, section, source_key, chunk_index)")
def chunk_apply(spark, sf_dir):
    """The chunks after an applied diff; NULL for the ids of new ones."""
    chunks, _ = _applied(spark, sf_dir)
    most = table(spark, sf_dir, "doc_chunk").agg(F.max("chunk_id")).first()[0] or 0
    return chunks.select(*chunking.CHUNK_KEY, "content_hash", F.when(F.col("chunk_id") <= most, F.col("chunk_id")).alias("kept_id"))


_SAME = f"(SELECT o.chunk_id, n.content_hash FROM {_EDITED} n JOIN {_OLD} o USING (doc_pk, section, source_key, chunk_index) WHERE n.content_hash = o.old_hash)"


@query(f"SELECT e.model, count(*) AS vectors FROM chunk_embedding e SEMI JOIN {_SAME} s USING (chunk_id) GROUP BY 1")
def vectors_kept(spark, sf_dir):
    """Vectors that an applied diff leaves, per model."""
    return _applied(spark, sf_dir)[1].groupBy("model").agg(F.count(F.lit(1)).alias("vectors"))


@query(f"""SELECT n.doc_pk, n.section, n.source_key, n.chunk_index, h.from_chunk FROM {_EDITED} n LEFT JOIN {_OLD} o USING (doc_pk, section, source_key, chunk_index)
JOIN (SELECT s.content_hash, arg_max(s.chunk_id, (e.created_at, s.chunk_id)) AS from_chunk FROM {_SAME} s JOIN chunk_embedding e USING (chunk_id) WHERE e.model = '{MODEL}' AND e.embedding IS NOT NULL GROUP BY 1) h ON h.content_hash = n.content_hash
WHERE o.chunk_id IS NULL OR o.chunk_id NOT IN (SELECT s.chunk_id FROM {_SAME} s JOIN chunk_embedding e USING (chunk_id) WHERE e.model = '{MODEL}')""")
def reuse_after_edit(spark, sf_dir):
    """New chunks, after an applied diff, that take the vector of a chunk with the same hash."""
    chunks, vectors = _applied(spark, sf_dir)
    chunks = materialize(chunks, "applied")
    return embedding.reusable(chunks, vectors, MODEL).join(chunks, "chunk_id").select(*chunking.CHUNK_KEY, "from_chunk")


@query("SELECT doc_type, status, count(*) AS documents FROM policy_doc GROUP BY 1, 2")
def status_counts(spark, sf_dir):
    return table(spark, sf_dir, "policy_doc").groupBy("doc_type", "status").agg(F.count(F.lit(1)).alias("documents"))


@query("SELECT code, count(*) AS rows FROM policy_code GROUP BY 1 ORDER BY rows DESC, code NULLS FIRST LIMIT 20")
def frequent_codes(spark, sf_dir):
    return tables.top_counts(table(spark, sf_dir, "policy_code"), ["code"], 20)


@query(f"SELECT chunk_id FROM doc_chunk WHERE doc_pk NOT IN (SELECT doc_pk FROM {_ACTIVE})")
def chunk_prune(spark, sf_dir):
    c = Corpus(spark, sf_dir, AS_OF)
    return c.read("doc_chunk").join(c.active().select("doc_pk"), "doc_pk", "left_anti").select("chunk_id")


_MISSING = f"(SELECT * FROM doc_chunk WHERE chunk_id NOT IN (SELECT chunk_id FROM chunk_embedding WHERE model = '{MODEL}'))"
_REUSE = f"(SELECT m.chunk_id, arg_max(h.chunk_id, (h.created_at, h.chunk_id)) AS from_chunk FROM {_MISSING} m JOIN (SELECT c.content_hash, e.created_at, e.chunk_id FROM doc_chunk c JOIN chunk_embedding e USING (chunk_id) WHERE e.model = '{MODEL}' AND e.embedding IS NOT NULL) h ON h.content_hash = m.content_hash GROUP BY 1)"


@query(f"SELECT chunk_id, from_chunk FROM {_REUSE}")
def hash_reuse(spark, sf_dir):
    return embedding.reusable(table(spark, sf_dir, "doc_chunk"), table(spark, sf_dir, "chunk_embedding"), MODEL)


@query(f"SELECT content_hash, min(chunk_id) AS first_chunk, count(*) AS chunks FROM {_MISSING} WHERE chunk_id NOT IN (SELECT chunk_id FROM {_REUSE}) GROUP BY 1")
def pending_embeddings(spark, sf_dir):
    return embedding.pending(table(spark, sf_dir, "doc_chunk"), table(spark, sf_dir, "chunk_embedding"), MODEL)


@query()
def embed_pending(spark, sf_dir):
    chunks = table(spark, sf_dir, "doc_chunk")
    todo = embedding.pending(chunks, table(spark, sf_dir, "chunk_embedding"), MODEL).join(chunks.select(F.col("chunk_id").alias("first_chunk"), F.concat_ws("\n\n", "heading_path", "content").alias("text")), "first_chunk")
    return embedding.embed(todo, "content_hash", "text", embedding.hashing_provider(), 64)


@query(r"""SELECT doc_pk, nullif(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(indication, '(?is)<(script|style)\b.*?</(script|style)>', ' ', 'g'), '<[^<>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[ \t\n\r\f]+', ' ', 'g')), '') AS text FROM lcd""")
def html_strip_native(spark, sf_dir):
    return table(spark, sf_dir, "lcd").select("doc_pk", markup.strip_tags(F.col("indication")).alias("text"))


@query()
def html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "lcd").select("doc_pk", markup.to_text(F.col("indication")).alias("text"))


@query("SELECT snapshot_date, doc_type, doc_id, doc_version, loaded_at, CAST(coalesce(try_strptime(trim(effective_date), '%Y-%m-%d'), try_strptime(trim(effective_date), '%m/%d/%Y')) AS date) AS effective FROM policy_doc_snapshot")
def values_parse_date(spark, sf_dir):
    return table(spark, sf_dir, "policy_doc_snapshot").select("snapshot_date", "doc_type", "doc_id", "doc_version", "loaded_at", values.day(F.col("effective_date")).alias("effective"))


@query("SELECT code_pk, CASE WHEN abs(trunc(try_cast(code AS double))) <= 2147483647 THEN CAST(trunc(try_cast(code AS double)) AS bigint) END AS n, CASE WHEN lower(range_pos) IN ('1','-1','true','t','y','yes') THEN true WHEN lower(range_pos) IN ('0','false','f','n','no') THEN false END AS flag, left(trim(description), 1) AS initial FROM policy_code")
def values_parse(spark, sf_dir):
    return table(spark, sf_dir, "policy_code").select("code_pk", values.whole(F.col("code")).cast("bigint").alias("n"), values.flag(F.col("range_pos")).alias("flag"), values.first_char(F.col("description")).alias("initial"))


@query(r"""SELECT chunk_id, array_to_string(list_sort(list_distinct(list_concat(list_transform(regexp_extract_all(heading_path, '(?i)\b([LA]\d{5})\b', 1), lambda x: upper(x)), list_transform(regexp_extract_all(heading_path, '(?i)\bNCD\s*(\d+(?:\.\d+)*)', 1), lambda x: 'NCD ' || x)))), ',') AS ids FROM doc_chunk WHERE heading_path IS NOT NULL""")
def mentioned_ids(spark, sf_dir):
    return table(spark, sf_dir, "doc_chunk").where("heading_path is not null").select("chunk_id", F.array_join(values.mentioned_ids(F.col("heading_path")), ",").alias("ids"))


@query(r"""WITH t AS (SELECT c.doc_pk, d.public_id, coalesce(heading_path, '') || ' ' || coalesce(content, '') AS x FROM doc_chunk c JOIN policy_doc d USING (doc_pk) WHERE d.public_id IS NOT NULL),
r AS (SELECT doc_pk, public_id, list_concat(list_transform(regexp_extract_all(x, '(?i)\b([LA]\d{5})\b', 1), lambda i: upper(i)), list_transform(regexp_extract_all(x, '(?i)\bNCD\s*(\d+(?:\.\d+)*)', 1), lambda i: 'NCD ' || i)) AS ids FROM t)
SELECT doc_pk, max(CASE WHEN list_contains(ids, public_id) THEN 1.0::DOUBLE ELSE 0.0 END) AS recall FROM r GROUP BY 1""")
def citation_recall(spark, sf_dir):
    c = table(spark, sf_dir, "doc_chunk").join(table(spark, sf_dir, "policy_doc").where("public_id is not null").select("doc_pk", "public_id"), "doc_pk")
    cited = values.mentioned_ids(F.concat_ws(" ", "heading_path", "content"))
    return c.groupBy("doc_pk").agg(F.max(evaluate.recall(F.array("public_id"), cited)).alias("recall"))


@query("WITH r AS (SELECT doc_pk, chunk_id, coalesce(sum(length(content)) OVER (PARTITION BY doc_pk ORDER BY chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, length(content) AS n FROM doc_chunk) SELECT doc_pk, chunk_id, CAST(least(n, 24000 - before) AS bigint) AS chars FROM r WHERE before < 24000")
def evidence_cut(spark, sf_dir):
    return evaluate.evidence(table(spark, sf_dir, "doc_chunk").select("doc_pk", "chunk_id", "content"), "doc_pk", ["chunk_id"], "content").select("doc_pk", "chunk_id", F.length("content").cast("bigint").alias("chars"))


@query("SELECT event_type, count(value) AS runs, round(avg(value), 6) AS mean_s, round(quantile_cont(value, 0.95), 2) AS p95_s FROM events GROUP BY 1")
def latency_p95(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.count("value").alias("runs"), F.round(F.avg("value"), 6).alias("mean_s"), F.round(F.expr("percentile(value, 0.95)"), 2).alias("p95_s"))


@query("SELECT count(*) AS chunks, CAST(quantile_disc(length(content), 0.5) AS bigint) AS median, CAST(quantile_disc(length(content), 0.95) AS bigint) AS p95, CAST(max(length(content)) AS bigint) AS longest FROM doc_chunk WHERE content IS NOT NULL")
def chunk_size_stats(spark, sf_dir):
    return chunking.size_stats(table(spark, sf_dir, "doc_chunk"), "content")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark, sf_dir):
    from policymill.streaming.refresh import windowed_counts as counts

    e = table(spark, sf_dir, "events").withColumn("t", F.col("ts").cast("timestamp"))
    return counts(e, "t", "event_type").withColumn("start", F.col("start").cast("timestamp_ntz"))
