"""Loaders, references and composed texts on small tables, against literal results or brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from policymill.operators import chunking, loaders, tables


def spec():
    return loaders.Spec(
        columns={"k": F.col("id").try_cast("int"), "v": F.trim("v"), "s": F.col("s"), "n": F.col("n")}, key=("k",), order=(F.desc("n"),),
        required=("k", "v"), drop_unknown={"kind": ("s",)},
    )


SOURCE = "id string, v string, s int, n int, __skip string, __rn string"


def test_load_and_skipped(spark):
    rows = [("1", " a ", 1, 1), ("1", "b", 1, 2), ("x", "c", 1, 3), (None, "d", 1, 4), ("2", None, 1, 5), ("3", "e", 9, 6), ("4", "f", None, 7), ("5", "", 2, 8)]
    df = spark.createDataFrame([(*r, "extra", "extra") for r in rows], SOURCE)
    parents = {"kind": spark.createDataFrame([(1,), (2,), (2,), (None,)], "s int")}
    assert {tuple(r) for r in loaders.load(df, spec(), parents).collect()} == {(1, "b", 1, 2), (5, "", 2, 8)}
    assert {tuple(r) for r in loaders.skipped(df, spec(), parents).collect()} == {("no k", 2), ("no v", 1), ("unknown kind", 2)}
    none = spark.createDataFrame([], SOURCE)
    assert loaders.load(none, spec(), parents).count() == 0 and loaders.skipped(none, spec(), parents).count() == 0


def test_family_unpivot_surrogate(spark):
    a, b = spark.createDataFrame([(1, 7, 0), (2, None, 8)], "k int, lcd int, art int"), spark.createDataFrame([(1, 9, 9)], "k int, lcd int, art int")
    both = loaders.family({"a": a, "b": b}, "source")
    got = loaders.unpivot_ids(both, ["source", "k"], {"lcd": "LCD", "art": "ART"})
    assert {tuple(r) for r in got.collect()} == {("a", 1, "LCD", 7), ("a", 2, "ART", 8), ("b", 1, "LCD", 9), ("b", 1, "ART", 9)}
    keys = loaders.surrogate(both, ["source", "k"], "pk").select("pk")
    assert keys.distinct().count() == 3


def test_jurisdictions(spark):
    day = dt.date
    links = spark.createDataFrame([(1, 10), (1, 10), (2, 10), (2, 11), (3, 12), (4, None)], "doc_pk int, contractor_id int")
    primary = spark.createDataFrame([(1, 50), (1, 50), (2, 51), (4, 52)], "doc_pk int, state_id int")
    held = spark.createDataFrame([(10, 60, None), (10, 61, day(2025, 6, 1)), (11, 62, day(2025, 5, 31)), (12, 63, None), (12, None, None)], "contractor_id int, state_id int, term_date date")
    got = {tuple(r) for r in loaders.jurisdictions(links, primary, held, "2025-06-01").collect()}
    assert got == {(1, 50), (2, 60), (2, 61), (3, 63), (4, 52)}


def test_packed_lines(spark):
    rnd = random.Random(5)
    rows = [(None if g == 0 else g, i, None if rnd.random() < 0.05 else "é" * rnd.randint(0, 90)) for g, n in ((0, 40), (1, 900), (2, 1), (3, 0)) for i in range(n)] + [(4, 0, "y" * 9000), (4, 1, "z")]
    want: dict = {}
    at: dict = {}
    for g, _, line in rows:
        if line is not None:
            want.setdefault((g, at.get(g, 0) // 200), []).append(line)
            at[g] = at.get(g, 0) + len(line) + 1
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, i int, line string").repartition(7)
    got = {(r.g, r.chunk_index): (r.lines, r.content) for r in chunking.packed_lines(df, ["g"], ["i"], "line", 200).collect()}
    assert got == {k: (len(v), "\n".join(v)) for k, v in want.items()}
    assert chunking.packed_lines(df.limit(0), ["g"], ["i"], "line").count() == 0


def test_fixed_windows(spark):
    texts = ["", None, "a", "abcdefghij", "abcdefghijk", "é🙂" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got: dict = {}
    for r in chunking.fixed_windows(df, ["k"], "t", 10, 3).orderBy("k", "chunk_index").collect():
        got.setdefault(r.k, []).append(r.content)
    assert set(got) == {2, 3, 4, 5}
    for k, parts in got.items():
        assert parts[0] + "".join(p[3:] for p in parts[1:]) == texts[k] and all(len(p) <= 10 for p in parts)


def test_running(spark):
    rnd = random.Random(9)
    rows = [(g, i, None if rnd.random() < 0.2 else rnd.choice("ab"), rnd.randint(0, 9)) for g, n in ((None, 30), (1, 700), (2, 1)) for i in range(n)]
    want: dict = {}
    for g, i, h, n in rows:
        before = want.setdefault(g, [])
        last = before[-1] if before else None
        before.append((last[0] + last[3] if last else 0, last[2] if last else None, h, n))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, i int, h string, n int").repartition(5)
    got = {(r.g, r.i): (r["__at"], r["__prev"], r["__no"] == 0) for r in tables.running(df, ["g"], ["i"], F.col("n"), "t", "h").collect()}
    assert got == {(g, i): (x[0], x[1], i == 0) for g, xs in want.items() for i, x in enumerate(xs)}
    assert tables.running(df.limit(0), ["g"], ["i"], F.col("n"), "t").count() == 0


def test_mark_greatest(spark):
    rows = [(1, "a", 1), (2, "a", 3), (3, "a", 3), (4, None, 2), (5, None, None), (6, "b", None)]
    df = spark.createDataFrame([(*r, "extra", "extra") for r in rows], "i int, k string, v int, most string, k0 string")
    got = {r.i: r.top for r in tables.mark_greatest(df, ["k"], "v", "top").collect()}
    assert got == {1: False, 2: True, 3: True, 4: True, 5: None, 6: None}
    assert tables.mark_greatest(df.limit(0), ["k"], "v", "top").count() == 0
