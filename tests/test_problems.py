"""The general problems against brute force on small tables with every kind of dirt."""

import csv
import datetime as dt
import io
import random

from pyspark.sql import functions as F

from policymill.operators import delimited, orphans, snapshot_diff


def _snapshots(spark, rows):
    schema = "snapshot_date date, doc_type string, doc_id int, doc_version int, title string, status string, effective_date string, end_date string, keywords string, last_updated timestamp, loaded_at timestamp, chunk string, n int"
    return spark.createDataFrame(rows, schema)


def test_snapshot_changes(spark):
    d1, d2, d3 = (dt.date(2025, 1, x) for x in (1, 8, 20))
    t = lambda h: dt.datetime(2025, 1, 1, h)
    row = lambda d, i, title="t", eff=None, at=1, kind="LCD", kw=None: (d, kind, i, 1, title, "A", eff, None, kw, t(at), None if at is None else t(at), "x", 1)
    rows = [row(d1, i) for i in range(200)] + [row(d2, i) for i in range(1, 200)] + [row(d3, i) for i in range(1, 201)]
    rows[200 + 9] = row(d2, 10, eff="2024-03-05", kw="")  # d2, key 10
    rows += [row(d1, 500, eff="3/5/2024"), row(d2, 500, eff="2024-03-05", kind="LCD "), row(d3, 500, eff="2024-03-06")]
    rows += [row(d1, 600, "old", at=1), row(d1, 600, "new", at=2), row(d2, 600, " new ", at=1), row(d2, 600, "zzz", at=0), row(d3, 600, "new")]
    rows += [(None, "LCD", 9, 9, None, None, None, None, None, None, None, None, None)]
    got = {tuple(r) for r in snapshot_diff.snapshot_changes(_snapshots(spark, rows), chunk_bits=3).collect()}
    assert got == {
        (d2, "LCD", 0, 1, "removed"), (d2, "LCD", 10, 1, "changed"), (d3, "LCD", 10, 1, "changed"), (d3, "LCD", 200, 1, "added"), (d3, "LCD", 500, 1, "changed"),
    }
    assert snapshot_diff.snapshot_changes(_snapshots(spark, rows[:5])).count() == 0
    assert snapshot_diff.snapshot_changes(_snapshots(spark, [])).count() == 0


def _fields(line):
    """Reference parser, one character at a time; None for broken quoting."""
    line = line[:-1] if line.endswith("\r") else line
    out, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            i += 1
            value = ""
            while True:
                j = line.find('"', i)
                if j < 0:
                    return None
                value += line[i:j]
                i = j + 1
                if line[i : i + 1] != '"':
                    break
                value += '"'
                i += 1
            if i < len(line) and line[i] != ",":
                return None
        else:
            j = line.find(",", i)
            value = line[i : j if j >= 0 else len(line)]
            i = j if j >= 0 else len(line)
            if '"' in value:
                return None
        out.append(value)
        if i >= len(line):
            return out
        i += 1


def test_structural_index_matches_a_plain_parser():
    import pyarrow as pa

    rng = random.Random(3)
    lines = ["".join(rng.choice('a,"\n\r é') for _ in range(rng.randrange(0, 12))) for _ in range(20000)]
    buf = io.StringIO()
    csv.writer(buf).writerow(['x "y"', "a,b", ""])
    lines += [buf.getvalue().rstrip("\n"), "", ",", '"', '""', '"""', "\r", "x" * 100_000]
    array = pa.array([None, *lines])[1:]
    broken, fields = delimited.structural_index(array)
    got = fields.cast(pa.list_(pa.string())).to_pylist()
    for line, b, f in zip(lines, broken, got):
        want = _fields(line)
        assert b == (want is None), repr(line)
        assert want is None or f == want, repr(line)
    assert len(delimited.structural_index(pa.array([], pa.string()))[0]) == 0


def test_records_are_judged(spark):
    ok = "1,2,X1,{v},1,B,3,text,Y,{s}"
    stamps = {"": True, "2024-02-29": True, "2023-02-29": False, "2/29/2024 23:59:59": True, "2/9/24": True, "2024-01-01T00:00:00": True, "2024-1-1": False, "1/1/2024T00:00:00": False, "2024-01-01 24:00:00": False, "2024-01-01  00:00:00": False, "0000-01-01": False}
    versions = {"": True, "1234": True, "1.0": True, "12345": False, "1.5": False, "x": False, '" 7 "': True}
    rows = [("policy_code", ok.format(v=v, s=""), w) for v, w in versions.items()] + [("policy_code", ok.format(v="", s=s), w) for s, w in stamps.items()]
    rows += [("state_lookup", f"{s},AA,b", w) for s, w in {"1": True, "000": False, "": False, "1000": False, '" 12"': True}.items()]
    rows += [("state_lookup", "1,2", False), ("other", "1", False), (None, "1", False), ("state_lookup", None, False), ("state_lookup", '1,"a"b,c', False)]
    df = spark.createDataFrame([(i, s, x, "clash") for i, (s, x, _) in enumerate(rows)], "row_id bigint, source_table string, raw_line string, reason string")
    bad = {r.row_id for r in delimited.rejects(df).collect()}
    assert bad == {i for i, (_, _, w) in enumerate(rows) if not w}
    typed = delimited.valid_rows(df.drop("reason"), "state_lookup").collect()
    assert {(r.state_id, r.state_abbrev) for r in typed} == {(1, "AA"), (12, "AA")}
    assert delimited.rejects(df.limit(0)).count() == 0


def test_orphans_whole_and_in_batches(spark):
    rng = random.Random(5)
    day = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
    refs = [("r", "p", i, rng.choice(["hot", "hot", "a", "b", "none", None]), day(rng.randrange(300))) for i in range(400)] + [("r", "p", 999, "a", None), ("r", "p", 0, "a", day(5))]
    log = [("p", rng.choice(["hot", "a", "b", "unused"]), day(rng.randrange(300)), i, rng.random() < 0.6) for i in range(80)]
    refs, log = [*refs, ("r", "p", 2000, "c", day(200))], [*log, ("p", "c", day(10), 900, True)]
    rf = lambda x: spark.createDataFrame(x, "ref_table string, parent_table string, ref_id bigint, key string, at timestamp")
    pf = lambda x: spark.createDataFrame(x, "parent_table string, key string, at timestamp, seq bigint, ok boolean")

    def holds(key, at):
        own = [(p[2], p[3], p[4]) for p in log if at is not None and p[1] == key and p[2] <= at]
        return bool(own) and max(own)[2]

    want = sorted((r[2] for r in refs if not holds(r[3], r[4])))
    whole = orphans.advance(orphans.OrphanState.empty(spark), rf(refs), pf(log), slice_rows=10)
    assert sorted(r.ref_id for r in whole.found.collect()) == want
    cut = day(150)
    early = lambda x, at: [y for y in x if y[at] is None or y[at] < cut]
    late = lambda x, at: [y for y in x if y[at] is not None and y[at] >= cut]
    one = orphans.advance(orphans.OrphanState.empty(spark), rf(early(refs, 4)), pf(early(log, 2)), slice_rows=10)
    two = orphans.advance(one.state, rf(late(refs, 4)), pf(late(log, 2)), slice_rows=10)
    assert sorted(r.ref_id for x in (one, two) for r in x.found.collect()) == want
    counts = lambda d: {(r.month): r.open_refs for r in orphans.open_by_month(d).collect()}
    a, b = counts(whole.deltas), counts(one.deltas.unionByName(two.deltas))
    last = max(m for m in a if m)
    end = dt.datetime(2025, 1, 1)
    assert a[last] == b[last] == sum(not holds(r[3], end) for r in refs)
    # The later half first: what comes late corrects what was found, and the state ends the same.
    two = orphans.advance(orphans.OrphanState.empty(spark), rf(late(refs, 4)), pf(late(log, 2)), slice_rows=10)
    one = orphans.advance(two.state, rf(early(refs, 4)), pf(early(log, 2)), slice_rows=10)
    ids = lambda *frames: sorted(r.ref_id for f in frames for r in f.collect())
    gone = ids(one.withdrawn)
    net = ids(two.found, one.found)
    for i in gone:
        net.remove(i)
    assert gone and net == want == ids(one.state.refs.where("missing"))
    assert ids(one.state.refs.where("waits")) == sorted(r[2] for r in refs if not holds(r[3], end if r[4] else None))
    assert counts(two.deltas.unionByName(one.deltas)) == a
    empty = orphans.advance(orphans.OrphanState.empty(spark), rf([]), pf([]))
    assert empty.found.count() == 0 and empty.deltas.count() == 0


def test_parents_resolve_and_deletions_reopen(spark):
    day = lambda i: dt.datetime(2024, 1, i)
    rf = lambda x: spark.createDataFrame([("r", "p", i, k, t) for i, k, t in x], "ref_table string, parent_table string, ref_id bigint, key string, at timestamp")
    pf = lambda x: spark.createDataFrame([("p", k, t, i, ok) for i, k, t, ok in x], "parent_table string, key string, at timestamp, seq bigint, ok boolean")
    state = orphans.OrphanState.empty(spark)
    steps = [
        ([(1, "a", day(2)), (2, "b", day(2)), (3, None, day(2))], [(1, "b", day(1), True)], [], {1, 3}),
        ([(4, "b", day(5))], [(2, "a", day(4), True)], [(1, "resolved")], set()),
        ([], [(3, "a", day(6), False), (4, "b", day(6), False)], [(1, "reopened"), (2, "reopened"), (4, "reopened")], set()),
        ([(5, "b", day(8))], [(5, "b", day(7), True)], [(2, "resolved"), (4, "resolved")], set()),
    ]
    for refs, log, changes, found in steps:
        got = orphans.advance(state, rf(refs), pf(log))
        assert sorted((r.ref_id, r.kind) for r in got.changes.collect()) == changes and {r.ref_id for r in got.found.collect()} == found
        assert got.withdrawn.count() == 0
        state = got.state
    assert {r.ref_id for r in state.refs.where("waits").collect()} == {1, 3}


def test_orphan_stream(spark, tmp_path):
    from policymill.streaming import refresh

    landing, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = spark.createDataFrame([], "what string, key string, id bigint, at timestamp, ok boolean").schema
    day = lambda i: dt.datetime(2024, 1, i)

    def split(df):
        refs = df.where("what = 'ref'").select(F.lit("r").alias("ref_table"), F.lit("p").alias("parent_table"), F.col("id").alias("ref_id"), "key", "at")
        return refs, df.where("what = 'parent'").select(F.lit("p").alias("parent_table"), "key", "at", F.col("id").alias("seq"), "ok")

    batches = [[("ref", "a", 1, day(1), None), ("ref", "b", 2, day(1), None)], [("parent", "a", 1, day(2), True)], [("parent", "a", 2, day(3), False), ("ref", "c", 3, day(3), None)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        refresh.orphan_stream(spark, landing, schema, target, check, split).awaitTermination()
    read = lambda name, batch: sorted(tuple(r) for r in spark.read.parquet(f"{target}/{name}/{batch}").select("ref_id", *(["kind"] if name == "changes" else [])).collect())
    assert [read("found", b) for b in range(3)] == [[(1,), (2,)], [], [(3,)]]
    assert [read("changes", b) for b in range(3)] == [[], [(1, "resolved")], [(1, "reopened")]]
    refs = refresh.Buckets(spark, f"{target}/refs", ["parent_table", "key"], spark.createDataFrame([], orphans.REFERENCE).schema)
    assert {(r.ref_id, r.waits) for r in refs.read(2).collect()} == {(1, True), (2, True), (3, True)}


def test_hot_key_is_spread(spark):
    n = 20000
    refs = spark.range(n).select(F.lit("r").alias("ref_table"), F.lit("p").alias("parent_table"), F.col("id").alias("ref_id"), F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("at"))
    log = spark.createDataFrame([("p", "hot", dt.datetime(2023, 11, 20), 1, True)], "parent_table string, key string, at timestamp, seq bigint, ok boolean")
    found = orphans.advance(orphans.OrphanState.empty(spark), refs, log, slice_rows=500).found
    assert found.count() == refs.where(F.col("at") < dt.datetime(2023, 11, 20)).count()
