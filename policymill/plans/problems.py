"""Queries of the general problems (1, 4, 5) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from policymill.operators import delimited, orphans, snapshot_diff
from policymill.operators.tables import union_all
from policymill.runtime import materialize, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = snapshot_diff.snapshot_changes(table(spark, sf_dir, "policy_doc_snapshot"))
    return d.select(
        F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"), "doc_type", F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("doc_version").cast("bigint").alias("doc_version"), "change_kind",
    )


def p1_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of each kind per snapshot."""
    return p1_found(spark, sf_dir).groupBy("snapshot_date", "change_kind").agg(F.count(F.lit(1)).alias("changes"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.rejects(table(spark, sf_dir, "raw_record")).select(F.col("row_id").cast("bigint").alias("row_id"))


def p4_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected record with its place and reason."""
    return delimited.rejects(table(spark, sf_dir, "raw_record")).select("row_id", "source_table", "file_name", "line_no", "reason")


def p4_policy_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed rows of policy_code."""
    return delimited.valid_rows(table(spark, sf_dir, "raw_record"), "policy_code")


def p4_state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed rows of state_lookup."""
    return delimited.valid_rows(table(spark, sf_dir, "raw_record"), "state_lookup")


CONTRACTOR_KEY = ("contractor_id", "contractor_type_id", "contractor_version")


def _p5_logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All references and all parent records."""
    contractor, links, states = (table(spark, sf_dir, t) for t in ("contractor", "policy_contractor", "state_lookup"))
    refs = orphans.references(links, "policy_contractor", "contractor", "load_id", CONTRACTOR_KEY, "loaded_at", "contractor_id")
    refs = refs.unionByName(orphans.references(contractor, "contractor", "state_lookup", "load_id", ["state_id"], "loaded_at", "state_id"))
    log = orphans.parents(contractor, "contractor", "load_id", CONTRACTOR_KEY, "loaded_at", F.col("status") == "D")
    return refs, log.unionByName(orphans.parents(states, "state_lookup", "load_id", ["state_id"], "loaded_at", F.lit(False)))


def _p5(spark: SparkSession, sf_dir: str) -> tuple[orphans.OrphanState, list[tuple[int | None, orphans.Advance]]]:
    """The last state and what each batch brought: the logs fed to the state year by year of loading; a batch's state is written before the next."""
    refs, log = _p5_logs(spark, sf_dir)
    years = refs.select(F.year("at").alias("y")).union(log.select(F.year("at").alias("y"))).distinct().orderBy(F.asc_nulls_first("y"))
    state, out = orphans.OrphanState.empty(spark), []
    for (y,) in years.collect():  # one row a year
        of = F.year("at").eqNullSafe(F.lit(y))
        got = orphans.advance(state, refs.where(of), log.where(of))
        state = orphans.OrphanState(got.state.parents, materialize(got.state.refs, "orphan-refs"))  # parents: parts of the given log
        out.append((y, got))
    return state, out


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p5(spark, sf_dir)[0].refs.where("missing").select("ref_table", F.date_format("at", "yyyy-MM").alias("period"), F.col("ref_id").alias("load_id"))


def p5_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans open at the end of each month, per referring table."""
    deltas = [got.deltas for _, got in _p5(spark, sf_dir)[1]] or [spark.createDataFrame([], "ref_table string, month timestamp, delta bigint")]
    return orphans.open_by_month(union_all(deltas)).select("ref_table", F.date_format("month", "yyyy-MM").alias("period"), "open_refs")


def p5_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each yearly batch brought: references found without a parent, and earlier ones resolved or reopened."""
    frames = [spark.createDataFrame([], "year int, ref_table string, kind string")]
    for y, got in _p5(spark, sf_dir)[1]:
        kinds = [got.found.withColumn("kind", F.lit("found")), got.withdrawn.withColumn("kind", F.lit("withdrawn")), got.changes]
        frames += [f.select(F.lit(y).cast("int").alias("year"), "ref_table", "kind") for f in kinds]
    return union_all(frames).groupBy("year", "ref_table", "kind").agg(F.count(F.lit(1)).alias("refs"))


QUERIES = {f.__name__: f for f in (p1_found, p1_summary, p4_found, p4_reasons, p4_policy_code, p4_state_lookup, p5_found, p5_open, p5_events)}

_D = "coalesce(strftime(try_strptime(CASE WHEN regexp_matches({0},'^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN {0} END,'%Y-%m-%d'),'%Y-%m-%d'), strftime(try_strptime(CASE WHEN regexp_matches({0},'^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$') THEN {0} END,'%m/%d/%Y'),'%Y-%m-%d'), {0})"
_B = "nullif(trim({0}),'')"
_P1 = f"""
WITH r AS (SELECT snapshot_date AS snap, trim(doc_type) AS doc_type, CAST(doc_id AS bigint) AS doc_id, CAST(doc_version AS bigint) AS doc_version, loaded_at,
  {_B.format("title")} AS t, {_B.format("status")} AS s, {_B.format("keywords")} AS k, {_D.format(_B.format("effective_date"))} AS e, {_D.format(_B.format("end_date"))} AS x
  FROM policy_doc_snapshot WHERE snapshot_date IS NOT NULL),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snap, doc_type, doc_id, doc_version ORDER BY loaded_at DESC NULLS LAST, t DESC NULLS LAST, s DESC NULLS LAST) AS rn FROM r) WHERE rn = 1),
n AS (SELECT snap, lead(snap) OVER (ORDER BY snap) AS nxt FROM (SELECT DISTINCT snap FROM l)),
o AS (SELECT l.*, n.nxt FROM l JOIN n USING (snap) WHERE n.nxt IS NOT NULL),
w AS (SELECT l.* FROM l WHERE snap > (SELECT min(snap) FROM l)),
f AS (SELECT strftime(coalesce(w.snap, o.nxt), '%Y-%m-%d') AS snapshot_date, coalesce(w.doc_type, o.doc_type) AS doc_type, coalesce(w.doc_id, o.doc_id) AS doc_id,
  coalesce(w.doc_version, o.doc_version) AS doc_version,
  CASE WHEN o.snap IS NULL THEN 'added' WHEN w.snap IS NULL THEN 'removed'
       WHEN w.t IS DISTINCT FROM o.t OR w.s IS DISTINCT FROM o.s OR w.k IS DISTINCT FROM o.k OR w.e IS DISTINCT FROM o.e OR w.x IS DISTINCT FROM o.x THEN 'changed' END AS change_kind
  FROM w FULL JOIN o ON w.snap = o.nxt AND w.doc_type = o.doc_type AND w.doc_id = o.doc_id AND w.doc_version = o.doc_version)
SELECT * FROM f WHERE change_kind IS NOT NULL"""

_Q = r'"(?:[^"]|"")*"|[^",]?|[^",][^",]*'
_F = rf"(?:{_Q})"
_TIME = r"(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"


def _field(i: int) -> str:
    before = rf"(?:{_F},){{{i}}}" if i else ""
    raw = f"regexp_extract(line, '(?s)^{before}({_F})(?:,|$)', 1)"
    return f"trim(CASE WHEN {raw} LIKE '\"%' THEN replace({raw}[2:-2], '\"\"', '\"') ELSE {raw} END)"


_P4 = rf"""
WITH r AS (SELECT row_id, source_table, file_name, line_no, regexp_replace(raw_line, '(?s)^(.*)\r$', '\1') AS line FROM raw_record),
s AS (SELECT *, regexp_matches(line, '(?s)^{_F}(?:,{_F})*$') AS quoted,
  CASE source_table WHEN 'policy_code' THEN regexp_matches(line, '(?s)^{_F}(?:,{_F}){{9}}$') ELSE regexp_matches(line, '(?s)^{_F}(?:,{_F}){{2}}$') END AS counted FROM r),
f AS (SELECT *, CASE WHEN counted AND source_table = 'policy_code' THEN {_field(3)} END AS version, CASE WHEN counted AND source_table = 'policy_code' THEN {_field(9)} END AS stamp,
  CASE WHEN counted AND source_table = 'state_lookup' THEN {_field(0)} END AS state FROM s),
d AS (SELECT *, regexp_extract(stamp, '^([^ T]*)', 1) AS day FROM f),
j AS (SELECT *, regexp_matches(stamp, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(?:[ T]{_TIME})?$') AS iso, regexp_matches(stamp, '^[0-9]{{1,2}}/[0-9]{{1,2}}/(?:[0-9]{{4}}|[0-9]{{2}})(?: {_TIME})?$') AS us FROM d),
v AS (SELECT row_id, source_table, file_name, line_no, CASE
  WHEN NOT quoted THEN 'broken_quoting' WHEN NOT counted THEN 'field_count'
  WHEN version IS NOT NULL AND NOT regexp_matches(version, '^(?:[0-9]{{1,4}}(?:\.0)?)?$') THEN 'invalid_code_version'
  WHEN stamp <> '' AND NOT ((iso AND try_strptime(day, '%Y-%m-%d') IS NOT NULL) OR (us AND coalesce(CASE WHEN length(regexp_extract(day, '([0-9]+)$', 1)) = 4 THEN try_strptime(day, '%m/%d/%Y') ELSE try_strptime(day, '%m/%d/%y') END) IS NOT NULL)) THEN 'invalid_last_updated'
  WHEN state IS NOT NULL AND NOT (regexp_matches(state, '^[0-9]{{1,3}}$') AND NOT regexp_matches(state, '^0+$')) THEN 'invalid_state_id' END AS reason FROM j)
"""



def _typed_sql(source: str) -> str:
    """SQL of the typed rows of a source: whole numbers, stamps, and texts without the empty ones."""
    f, out = delimited.FORMATS[source], []
    for i, c in enumerate(f.fields):
        x = _field(i)
        if f.types.get(c) == "int":
            n = rf"regexp_replace({x}, '\.0$', '')"
            x = f"CASE WHEN regexp_matches({n}, '^[+-]?[0-9]+$') THEN try_cast({n} AS integer) END"
        elif f.types.get(c) == "timestamp":
            day = f"regexp_extract({x}, '^([^ T]*)', 1)"
            at = f"coalesce(try_strptime({day}, '%Y-%m-%d'), CASE WHEN regexp_matches({day}, '/[0-9]{{4}}$') THEN try_strptime({day}, '%m/%d/%Y') ELSE try_strptime({day}, '%m/%d/%y') END)"
            x = f"{at} + coalesce(try_cast(nullif(regexp_extract({x}, '[ T](.*)$', 1), '') AS interval), INTERVAL 0 SECOND)"
            x = f"CAST({x} AS timestamp)"
        else:
            x = f"nullif({x}, '')"
        out.append(f"{x} AS {c}")
    return f"{_P4} SELECT row_id, {', '.join(out)} FROM (SELECT row_id, line FROM r JOIN (SELECT row_id FROM v WHERE reason IS NULL AND source_table = '{source}') USING (row_id))"


_P5 = """
WITH p AS (SELECT 'contractor' AS pt, contractor_id || '|' || contractor_type_id || '|' || contractor_version AS k, loaded_at AS ts, load_id AS seq, coalesce(status = 'D', false) AS gone FROM contractor
  UNION ALL SELECT 'state_lookup', CAST(state_id AS varchar), loaded_at, load_id, false FROM state_lookup),
r AS (SELECT 'policy_contractor' AS ref_table, 'contractor' AS pt, contractor_id || '|' || contractor_type_id || '|' || contractor_version AS k, loaded_at AS ts, load_id FROM policy_contractor WHERE contractor_id IS NOT NULL
  UNION ALL SELECT 'contractor', 'state_lookup', CAST(state_id AS varchar), loaded_at, load_id FROM contractor WHERE state_id IS NOT NULL)"""

ORACLE = {
    "p1_found": _P1,
    "p1_summary": f"SELECT snapshot_date, change_kind, count(*) AS changes FROM ({_P1}) GROUP BY ALL",
    "p4_found": _P4 + "SELECT CAST(row_id AS bigint) AS row_id FROM v WHERE reason IS NOT NULL",
    "p4_reasons": _P4 + "SELECT * FROM v WHERE reason IS NOT NULL",
    "p4_policy_code": _typed_sql("policy_code"),
    "p4_state_lookup": _typed_sql("state_lookup"),
    "p5_found": _P5 + """
SELECT ref_table, strftime(ts, '%Y-%m') AS period, load_id FROM (
  SELECT r.ref_table, r.ts, r.load_id, arg_max(p.gone, (p.ts, p.seq)) AS gone FROM r LEFT JOIN p ON p.pt = r.pt AND p.k = r.k AND p.ts <= r.ts GROUP BY ALL)
WHERE coalesce(gone, true)""",
    "p5_open": _P5 + """,
months AS (SELECT DISTINCT ref_table, date_trunc('month', m) AS m FROM (
  SELECT ref_table, ts AS m FROM r UNION ALL SELECT x.ref_table, p.ts FROM p JOIN (SELECT DISTINCT ref_table, pt, k FROM r) x USING (pt, k))),
counted AS (SELECT m.ref_table, m.m, r.pt, r.k, count(r.load_id) AS n FROM months m LEFT JOIN r ON r.ref_table = m.ref_table AND r.ts < m.m + INTERVAL 1 MONTH GROUP BY ALL),
stated AS (SELECT c.ref_table, c.m, c.n, arg_max(p.gone, (p.ts, p.seq)) AS gone FROM counted c LEFT JOIN p ON p.pt = c.pt AND p.k = c.k AND p.ts < c.m + INTERVAL 1 MONTH GROUP BY c.ref_table, c.m, c.pt, c.k, c.n)
SELECT ref_table, strftime(m, '%Y-%m') AS period, CAST(sum(CASE WHEN coalesce(gone, true) THEN n ELSE 0 END) AS bigint) AS open_refs FROM stated GROUP BY ALL""",
    "p5_events": _P5 + """,
years AS (SELECT *, lag(y) OVER (ORDER BY y) AS before FROM (SELECT year(ts) AS y FROM r UNION SELECT year(ts) FROM p)),
at_end AS (SELECT years.y, years.before, r.ref_table, r.load_id, year(r.ts) AS arrived, coalesce(arg_max(p.gone, (p.ts, p.seq)), true) AS waits,
  coalesce(arg_max(p.gone, (p.ts, p.seq)) FILTER (WHERE p.ts <= r.ts), true) AS missing FROM years JOIN r ON year(r.ts) <= years.y LEFT JOIN p ON p.pt = r.pt AND p.k = r.k AND year(p.ts) <= years.y GROUP BY ALL),
e AS (SELECT y, ref_table, 'found' AS kind FROM at_end WHERE arrived = y AND missing UNION ALL
  SELECT n.y, n.ref_table, CASE WHEN o.waits THEN 'resolved' ELSE 'reopened' END FROM at_end n JOIN at_end o ON o.y = n.before AND o.ref_table = n.ref_table AND o.load_id = n.load_id WHERE o.waits <> n.waits)
SELECT CAST(y AS integer) AS year, ref_table, kind, count(*) AS refs FROM e GROUP BY ALL""",
}
