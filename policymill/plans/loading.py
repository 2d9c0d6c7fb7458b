"""Queries of loaders, references between documents and composed texts, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from policymill.functions import values
from policymill.operators import assembly, chunking, corpus, loaders, relations, tables
from policymill.operators.corpus import CONTRACTOR_KEY, Corpus
from policymill.plans.reference import _ACTIVE, _CODES, _CONTRACTORS, _DOC_STATES, _NAMES, _STATES, AS_OF, ORACLE, QUERIES, query
from policymill.runtime import table

_LAST = "(SELECT * FROM policy_doc_snapshot WHERE snapshot_date = (SELECT max(snapshot_date) FROM policy_doc_snapshot))"
_T = r"nullif(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '')"
_D = "CAST(coalesce(try_strptime(" + _T + ", '%Y-%m-%d'), try_strptime(" + _T + ", '%m/%d/%Y')) AS date)"
_HEADERS = f"""(SELECT *, doc_version = max(doc_version) OVER (PARTITION BY doc_type, doc_id) AS is_latest FROM (
SELECT {_T.format('doc_type')} AS doc_type, doc_id, doc_version, coalesce({_T.format('title')}, '(untitled)') AS title, {_T.format('status')} AS status, {_D.format('effective_date')} AS effective_date, {_D.format('end_date')} AS end_date, loaded_at FROM {{src}}
QUALIFY row_number() OVER (PARTITION BY {_T.format('doc_type')}, doc_id, doc_version ORDER BY loaded_at DESC, coalesce({_T.format('title')}, '(untitled)'), {_T.format('status')} NULLS FIRST, {_D.format('effective_date')} NULLS FIRST, {_D.format('end_date')} NULLS FIRST) = 1))"""


def _snapshots(spark, sf_dir, back: int = 0):
    """The newest snapshot, or one some steps before it."""
    s = table(spark, sf_dir, "policy_doc_snapshot")
    day = s.select("snapshot_date").distinct().orderBy(F.desc("snapshot_date")).offset(back).limit(1)
    return s.join(F.broadcast(day), "snapshot_date", "left_semi")  # one row


@query(f"SELECT doc_type, doc_id, doc_version, title, status, effective_date, end_date, is_latest FROM {_HEADERS.format(src=_LAST)}")
def load_documents(spark, sf_dir):
    return loaders.document_headers(_snapshots(spark, sf_dir)).drop("keywords", "loaded_at")


_KEPT = f"""WITH s AS (SELECT *, {_T.format('doc_type')} AS t, dense_rank() OVER (ORDER BY snapshot_date DESC) AS back FROM policy_doc_snapshot),
a AS (SELECT DISTINCT t, doc_id, doc_version FROM s WHERE back = 2), b AS (SELECT DISTINCT t, doc_id, doc_version FROM s WHERE back = 1 AND t <> 'NCD')"""


@query(f"{_KEPT} SELECT t AS doc_type, doc_id, doc_version FROM a WHERE t NOT IN (SELECT t FROM b) OR (t, doc_id, doc_version) IN (SELECT (t, doc_id, doc_version) FROM b)")
def stale_documents(spark, sf_dir):
    """A load of two document types leaves the third alone and drops what vanished from the two."""
    key = ["doc_type", "doc_id", "doc_version"]
    old, new = (loaders.document_headers(_snapshots(spark, sf_dir, n)).select(*key) for n in (1, 0))
    return tables.drop_stale(old, new.where("doc_type <> 'NCD'"), key, "doc_type")


def _contractor_spec() -> loaders.Spec:
    cols = ["load_id", "loaded_at", *CONTRACTOR_KEY, "contractor_bus_name", "state_id"]
    return loaders.Spec(columns={n: F.col(n) for n in cols}, key=CONTRACTOR_KEY, order=(F.desc("loaded_at"), F.desc("load_id")), required=("contractor_id", "contractor_bus_name"), null_unknown={"states": "state_id"})


@query(f"SELECT c.load_id, c.contractor_bus_name, s.state_id FROM (SELECT * FROM contractor WHERE contractor_id IS NOT NULL AND contractor_bus_name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY contractor_id, contractor_type_id, contractor_version ORDER BY loaded_at DESC, load_id DESC) = 1) c LEFT JOIN (SELECT DISTINCT state_id FROM state_lookup) s ON s.state_id = c.state_id")
def fk_null(spark, sf_dir):
    c = Corpus(spark, sf_dir)
    return loaders.load(c.read("contractor"), _contractor_spec(), {"states": c.states()}).select("load_id", "contractor_bus_name", "state_id")


def _link_spec() -> loaders.Spec:
    cols = ["load_id", "doc_pk", *CONTRACTOR_KEY]
    return loaders.Spec(columns={n: F.col(n) for n in cols}, key=("doc_pk", *CONTRACTOR_KEY), order=(F.asc("load_id"),), required=("contractor_id",), drop_unknown={"contractor": CONTRACTOR_KEY, "document": ("doc_pk",)})


@query(f"SELECT load_id, doc_pk, contractor_id FROM (SELECT pc.* FROM policy_contractor pc SEMI JOIN {_CONTRACTORS} c USING (contractor_id, contractor_type_id, contractor_version)) WHERE doc_pk IN (SELECT doc_pk FROM policy_doc) QUALIFY row_number() OVER (PARTITION BY doc_pk, contractor_id, contractor_type_id, contractor_version ORDER BY load_id) = 1")
def load_links(spark, sf_dir):
    c = Corpus(spark, sf_dir)
    return loaders.load(c.read("policy_contractor"), _link_spec(), {"contractor": c.contractors(), "document": c.read("policy_doc")}).select("load_id", "doc_pk", "contractor_id")


@query(f"""SELECT reason, count(*) AS rows FROM (SELECT CASE WHEN pc.contractor_id IS NULL THEN 'no contractor_id' WHEN c.k IS NULL THEN 'unknown contractor' WHEN pc.doc_pk NOT IN (SELECT doc_pk FROM policy_doc) THEN 'unknown document' END AS reason
FROM policy_contractor pc LEFT JOIN (SELECT DISTINCT contractor_id, contractor_type_id, contractor_version, 1 AS k FROM {_CONTRACTORS}) c USING (contractor_id, contractor_type_id, contractor_version)) WHERE reason IS NOT NULL GROUP BY 1""")
def load_skipped(spark, sf_dir):
    c = Corpus(spark, sf_dir)
    return loaders.skipped(c.read("policy_contractor"), _link_spec(), {"contractor": c.contractors(), "document": c.read("policy_doc")})


@query("SELECT doc_pk, code_system, role, group_no, description FROM policy_code WHERE group_no IS NOT NULL AND code_system IS NOT NULL AND role IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_pk, code_system, role, group_no ORDER BY code_pk) = 1")
def load_code_groups(spark, sf_dir):
    cols = ["code_pk", "doc_pk", "code_system", "role", "group_no", "description"]
    spec = loaders.Spec(columns={n: F.col(n) for n in cols}, key=("doc_pk", "code_system", "role", "group_no"), order=(F.asc("code_pk"),), required=("group_no", "code_system", "role"))
    return loaders.load(table(spark, sf_dir, "policy_code"), spec).drop("code_pk")


@query(f"""SELECT d.doc_pk, coalesce(s.x, '') AS states, coalesce(k.x, '') AS systems FROM policy_doc d LEFT JOIN (SELECT doc_pk, string_agg(state_abbrev, ',' ORDER BY state_abbrev) AS x FROM {_DOC_STATES} GROUP BY 1) s USING (doc_pk)
LEFT JOIN (SELECT doc_pk, string_agg(DISTINCT code_system, ',' ORDER BY code_system) AS x FROM policy_code GROUP BY 1) k USING (doc_pk)""")
def filter_arrays(spark, sf_dir):
    c = Corpus(spark, sf_dir)
    systems = c.read("policy_code").groupBy("doc_pk").agg(F.array_sort(F.collect_set("code_system")).alias("systems"))
    docs = c.with_states(c.read("policy_doc").select("doc_pk")).join(systems, "doc_pk", "left")
    return docs.select("doc_pk", F.array_join("states", ",").alias("states"), F.coalesce(F.array_join("systems", ","), F.lit("")).alias("systems"))


@query(f"SELECT d.doc_pk, k.code_system, k.code, count(*) AS listed FROM {_CODES} k JOIN {_ACTIVE} d USING (doc_pk) WHERE starts_with(k.code, 'Y8') GROUP BY ALL")
def code_prefix(spark, sf_dir):
    c = Corpus(spark, sf_dir, AS_OF)
    hits = c.codes().where(F.col("code").startswith("Y8")).join(c.active().select("doc_pk"), "doc_pk", "left_semi")
    return hits.groupBy("doc_pk", "code_system", "code").agg(F.count(F.lit(1)).alias("listed"))


_EDGES = "(SELECT doc_pk, 'LCD' AS to_type, source_lcd_id AS to_id FROM lcd WHERE source_lcd_id <> 0 UNION SELECT doc_pk, t, doc_id FROM policy_doc, (VALUES ('LCD'), ('ART'), ('NCD')) v(t) WHERE doc_type <> t AND doc_id <> 0)"


@query(f"SELECT e.doc_pk, e.to_type, d.doc_pk AS to_pk, d.public_id AS to_public_id, d.status AS to_status FROM {_EDGES} e JOIN policy_doc d ON d.doc_type = e.to_type AND d.doc_id = e.to_id WHERE d.is_latest AND NOT d.is_draft")
def related_docs(spark, sf_dir):
    c = Corpus(spark, sf_dir, AS_OF)
    return relations.related(c, relations.edges(c))


@query(f"SELECT e.doc_pk, e.to_type, e.to_id, d.doc_pk AS to_pk, d.public_id AS to_public_id FROM {_EDGES} e LEFT JOIN (SELECT * FROM policy_doc WHERE is_latest) d ON d.doc_type = e.to_type AND d.doc_id = e.to_id")
def related_or_missing(spark, sf_dir):
    c = Corpus(spark, sf_dir, AS_OF)
    return relations.related_or_missing(c, relations.edges(c))


@query(f"SELECT d.doc_pk, a.doc_pk AS from_pk, a.public_id AS from_public_id FROM policy_doc d JOIN {_EDGES} e ON d.doc_type = e.to_type AND d.doc_id = e.to_id JOIN {_ACTIVE} a ON a.doc_pk = e.doc_pk")
def referenced_by(spark, sf_dir):
    c = Corpus(spark, sf_dir, AS_OF)
    return relations.referenced_by(c, relations.edges(c))


@query(f"SELECT a.doc_pk AS from_pk, b.doc_pk AS to_pk FROM {_ACTIVE} a JOIN {_EDGES} e ON e.doc_pk = a.doc_pk JOIN {_ACTIVE} b ON b.doc_type = e.to_type AND b.doc_id = e.to_id WHERE a.doc_type = 'LCD' AND b.doc_type = 'ART'")
def lcd_articles(spark, sf_dir):
    c = Corpus(spark, sf_dir, AS_OF)
    return relations.active_pairs(c, relations.edges(c), "LCD", "ART")


@query(f"""WITH {_NAMES}, l AS (SELECT doc_pk, list(n ORDER BY n) AS a FROM n GROUP BY 1), s AS (SELECT doc_pk, string_agg(state_abbrev, ', ' ORDER BY state_abbrev) AS states FROM {_DOC_STATES} GROUP BY 1),
r AS (SELECT DISTINCT e.doc_pk, coalesce(d.public_id, e.to_type || ' ' || e.to_id) || coalesce(' (' || d.title || ')', '') AS n FROM {_EDGES} e LEFT JOIN (SELECT * FROM policy_doc WHERE is_latest) d ON d.doc_type = e.to_type AND d.doc_id = e.to_id),
t AS (SELECT doc_pk, array_to_string(list(n ORDER BY n)[1:15], '; ') AS related FROM r GROUP BY 1)
SELECT doc_pk, concat_ws(chr(10), concat_ws(': ', public_id, coalesce(title, '(untitled)')), 'Type: ' || doc_type, 'Status: active', 'Effective: ' || CAST(effective_date AS varchar), 'Ends: ' || CAST(end_date AS varchar),
'Contractors: ' || array_to_string(a[1:8], '; ') || CASE WHEN len(a) > 8 THEN '; +' || (len(a) - 8) || ' more' ELSE '' END, 'Applies in: ' || CASE WHEN doc_type = 'NCD' THEN 'national (all states)' ELSE states END, 'Related: ' || related) AS content
FROM {_ACTIVE} LEFT JOIN l USING (doc_pk) LEFT JOIN s USING (doc_pk) LEFT JOIN t USING (doc_pk)""")
def overview_text(spark, sf_dir):
    c = Corpus(spark, sf_dir, AS_OF)
    return corpus.overview(c, related=relations.related_line(c, c.active()))


_LINE = "concat_ws(' - ', code, coalesce(description, short_description)) || CASE range_pos WHEN 'B' THEN ' (start of range)' WHEN 'E' THEN ' (end of range)' ELSE '' END"


@query(f"""WITH r AS (SELECT doc_pk, code_system, role, group_no, {_LINE} AS line, coalesce(sort_order, 2147483647) AS so, code, code_pk FROM {_CODES}),
p AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_pk, code_system, role, group_no ORDER BY so, code, code_pk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM r)
SELECT doc_pk, code_system, role, group_no, CAST(pos // 1400 AS integer) AS chunk_index, count(*) AS lines, sha256(string_agg(line, chr(10) ORDER BY pos)) AS digest FROM p GROUP BY ALL""")
def code_chunks(spark, sf_dir):
    rows = Corpus(spark, sf_dir).codes().withColumn("line", values.code_line(F.col("code"), F.coalesce("description", "short_description"), F.col("range_pos")))
    rows = rows.withColumn("so", F.coalesce("sort_order", F.lit(2147483647)))
    group = ["doc_pk", "code_system", "role", "group_no"]
    return chunking.packed_lines(rows, group, ["so", "code", "code_pk"], "line").select(*group, "chunk_index", "lines", F.sha2("content", 256).alias("digest"))


@query("SELECT doc_id, CAST(i AS integer) AS chunk_index, sha256(substring(text, CAST(i * 900 + 1 AS bigint), 1000)) AS digest FROM (SELECT doc_id, text, unnest(range(greatest(1, CAST(ceil((length(text) - 100) / 900) AS bigint)))) AS i FROM documents WHERE length(text) > 0)")
def chunk_fixed(spark, sf_dir):
    return chunking.fixed_windows(table(spark, sf_dir, "documents"), ["doc_id"], "text", 1000, 100).select("doc_id", "chunk_index", F.sha2("content", 256).alias("digest"))


_BASE = "concat_ws(': ', d.public_id, coalesce(d.title, '(untitled)'))"
_SOLID = r"length(regexp_replace({0}, '^\s+|\s+$', '', 'g')) >= 25"
_TOLD = " UNION ALL ".join(f"SELECT doc_pk, '{n}' AS section, 'lcd' AS source_table, '' AS source_key, '{v}' AS label FROM lcd WHERE {_SOLID.format(n)}" for n, v in assembly.SECTION_LABELS.items())
_NAMED = "CASE " + " ".join(f"WHEN s = '{s}' AND r = '{r}' THEN '{v}'" for (s, r), v in assembly.CODE_LABELS.items()) + " ELSE s || ' Codes' END"


@query(f"""WITH k AS (SELECT DISTINCT doc_pk, coalesce(code_system, 'other') AS s, coalesce(role, 'listed') AS r, coalesce(group_no, 0) AS g FROM {_CODES}),
p AS (SELECT doc_pk, 'overview' AS section, 'policy_doc' AS source_table, '' AS source_key, 'Overview' AS label FROM policy_doc UNION ALL {_TOLD} UNION ALL
SELECT doc_pk, lower(s || '_' || r) || '_codes', 'policy_code', 'group=' || g, {_NAMED} || CASE WHEN g <> 0 THEN ' > Group ' || g ELSE '' END FROM k)
SELECT p.doc_pk, section, source_table, source_key, {_BASE} || ' > ' || label AS heading FROM p JOIN policy_doc d USING (doc_pk) WHERE d.status = 'A' AND NOT d.is_draft AND d.is_latest""")
def chunk_sections(spark, sf_dir):
    """The sections that are chunked, with the path that all their chunks share."""
    chunks = assembly.build_chunks(Corpus(spark, sf_dir)).where("chunk_index = 0")
    label = F.create_map(*[F.lit(x) for kv in assembly.SECTION_LABELS.items() for x in kv])[F.col("section")]
    told = F.concat(F.split_part(F.col("heading_path"), F.concat(F.lit(" > "), label), F.lit(1)), F.lit(" > "), label)
    return chunks.select("doc_pk", "section", "source_table", "source_key", F.when(F.col("source_table") == "lcd", told).otherwise(F.col("heading_path")).alias("heading"))


@query()
def build_chunks(spark, sf_dir):
    """Every chunk of the selected documents, keyed and hashed for `chunking.diff`."""
    return assembly.build_chunks(Corpus(spark, sf_dir))


@query(r"SELECT doc_id, array_to_string(list_sort(list_distinct(x)), ' ') AS marks FROM (SELECT doc_id, regexp_extract_all(text, '<\|[^|>\n]*\|>|【|】|\bto=functions\.') AS x FROM documents) WHERE len(x) > 0")
def leaked_markup(spark, sf_dir):
    """Documents in which marks of a chat template or of a raw tool call are left."""
    marks = values.leaked_markup(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", marks.alias("x")).where(F.size("x") > 0).select("doc_id", F.array_join("x", " ").alias("marks"))
