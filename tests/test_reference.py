"""Every core query against its SQL, and the pure functions against literal cases."""

import datetime as dt
import glob
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from policymill.functions import english, markup, values
from policymill.operators import chunking, corpus, embedding, evaluate, retrieval, tables
from policymill.plans import catalogue
from policymill.sources import bulk

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return c


def _text(v):
    return "~" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(map(_text, r)) for r in df.select(*cols).collect())
    if name in catalogue.ORACLE:
        want = duck.execute(f"SELECT {', '.join(cols)} FROM ({catalogue.ORACLE[name]})").fetchall()
        assert got == sorted(tuple(map(_text, r)) for r in want)


def test_values(spark):
    rows = [("1/5/2020", "2020-01-05 00:00:00"), ("01/05/99", "1999-01-05 00:00:00"), ("2020-01-05T01:02:03", "2020-01-05 01:02:03"), ("2020-01-05 00:00:00", "2020-01-05 00:00:00"), ("garbage", None), ("", None), (None, None)]
    got = spark.createDataFrame(rows, "s string, w string").select(values.stamp(F.col("s")).cast("string").alias("g"), "w").collect()
    assert [r.g for r in got] == [w for _, w in rows]
    one = spark.createDataFrame([("12.7", " y ", "  ab ")], "n string, b string, c string")
    r = one.select(values.whole(F.col("n")).alias("n"), values.flag(F.col("b")).alias("b"), values.first_char(F.col("c")).alias("c"), values.public_id(F.lit("ncd 20.4")).alias("p")).first()
    assert tuple(r) == (12, True, "a", "NCD 20.4")
    bad = spark.createDataFrame([("nan",), ("inf",), ("1e99",), ("",), (None,)], "n string").select(values.whole(F.col("n")).alias("n")).collect()
    assert all(x.n is None for x in bad)
    links = spark.createDataFrame([(" http://",), ("HTTPS://",), ("http://a.b",), ("",), (None,)], "u string").select(values.url(F.col("u")).alias("u")).collect()
    assert [x.u for x in links] == [None, None, "http://a.b", None, None]
    assert values.code_candidates("w1234", "ICD10CM") == ["W1234", "W12.34"]


def test_states_and_their_parts(spark):
    rows = [(1, "CA", "Cala - Entire State"), (2, "NF", "Cala - Northern"), (3, "SF", "Cala - Southern"), (4, "MN", "Mina"), (5, None, None), (6, "ZZ", "Zed - East"), (7, "QQ", "cala")]
    s = spark.createDataFrame([(*r, "x") for r in rows], "state_id int, state_abbrev string, description string, base string")
    got = lambda name: sorted(r.state_abbrev for r in corpus.resolve_states(s, name).collect())
    assert got(" nf ") == got("Cala - northern") == ["CA", "NF"]
    assert got("CA") == ["CA", "NF", "QQ", "SF"] == got("cala")
    assert got("mina") == ["MN"] and got("zed") == got("ZZ") == ["ZZ"] and got("nowhere") == got("") == got(None) == []
    assert corpus.resolve_states(s.limit(0), "CA").count() == 0


def test_markup(spark):
    page = "<p><b>Heading one</b></p><p>a &amp; b</p><script>x</script><ul><li>one<li>two</ul><table><tr><td>1</td><td>2</td></tr><tr><td></td></tr></table><h2>Sub</h2>x<br>y"
    df = spark.createDataFrame([(page,), ("plain",), ("",), (None,), ("<b>unclosed",)], "h string").select(markup.to_text(F.col("h")).alias("t"))
    a, b, c, d, e = (r.t for r in df.collect())
    assert a == "### Heading one\n\na & b\n\n- one\n- two\n\n1 | 2\n\n### Sub\n\nx\ny"
    assert (b, c, d, e) == ("plain", None, None, "unclosed")


def test_chunks(spark):
    z = chunking.Sizes()
    text = "### One\n\n" + "\n\n".join("word " * 60 for _ in range(12)) + "\n\n### Two\n\n" + "x" * 5000 + "\n\n" + "A sentence here. " * 200 + "\n\nend"
    got = chunking.pack(text)
    assert all(len(b) <= z.hard + 200 for _, b, _ in got) and got[0][0] == "One" and got[-1][0] == "Two"
    assert set(text.split()) - {"x" * 5000} <= set(" ".join(b for _, b, _ in got).split())
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "k int, t string")
    new = chunking.chunk_texts(df, ["k"], "t")
    assert {r.k for r in new.collect()} == {1}
    same = chunking.diff(new, new, ["k", "chunk_index"]).select("action").distinct().collect()
    assert [r.action for r in same] == ["unchanged"]


def test_tables_and_sources(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert {tuple(r) for r in tables.upsert(old, new, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    (tmp_path / "LCD.csv").write_text('﻿ID, Name \n1,"a ""b""\nc"\n2\n', encoding="utf-8")
    got = bulk.read_csv(spark, bulk.csv_tables(spark, str(tmp_path))["lcd"])
    assert got.columns == ["id", "name"] and {tuple(r) for r in got.collect()} == {("1", 'a "b"\nc'), ("2", None)}
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "Old.CSV").write_bytes("id,name\n1,caf\u00e9 \u2013 \u20ac\n".encode("cp1252"))
    assert set(bulk.csv_tables(spark, str(tmp_path))) == {"lcd", "old"}
    assert [tuple(r) for r in bulk.read_csv(spark, bulk.csv_tables(spark, str(tmp_path))["old"]).collect()] == [("1", "caf\u00e9 \u2013 \u20ac")]
    (tmp_path / "items.jsonl").write_text('{"id": "a", "input": {"question": "q"}, "expected_output": {"public_ids": ["L1"]}, "metadata": {"tools": ["t"], "state": "MN"}}\n{"x": 1}\n')
    item = bulk.read_evaluation(spark, str(tmp_path / "items.jsonl")).collect()
    assert len(item) == 1 and item[0].expected_output.public_ids == ["L1"] and item[0].metadata.state == "MN" and item[0].expected_output.answer is None
    parts = str(tmp_path / "parts")
    spark.createDataFrame([("LCD", 1), ("ART", 2)], "t string, k int").write.partitionBy("t").parquet(parts)
    bulk.replace_partitions(spark.createDataFrame([("ART", 3)], "t string, k int"), parts, ["t"])
    assert {(r.t, r.k) for r in spark.read.parquet(parts).collect()} == {("LCD", 1), ("ART", 3)}
    bulk.append(old, str(tmp_path / "t"))
    assert bulk.merge(spark, new, str(tmp_path / "t"), str(tmp_path / "none"), ["k"], dry_run=True).count() == 3 and not (tmp_path / "none").exists()
    merged = bulk.merge(spark, new, str(tmp_path / "t"), str(tmp_path / "t2"), ["k"])
    assert merged.count() == 3


def test_ranking_and_metrics(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "a b"), (2, [0.0, 1.0], "b b c"), (3, [0.0, 0.0], None), (4, None, "")], "id int, v array<float>, t string")
    assert [r.id for r in retrieval.vector_topk(df, "id", "v", [1.0, 0.1]).orderBy("rank").collect()] == [1, 2]
    kw = retrieval.keyword_topk(df, "id", "t", "B!")
    assert [(r.id, r.hits) for r in kw.orderBy("rank").collect()] == [(2, 2), (1, 1)]
    assert retrieval.keyword_topk(df, "id", "t", "  ").count() == 0
    assert retrieval.fuse([kw, kw], "id").agg(F.max("score")).first()[0] <= 2 / 61 + 1e-6
    m = spark.createDataFrame([(["a", "b"], ["b"], [])], "e array<string>, g array<string>, n array<string>")
    r = m.select(evaluate.recall(F.col("e"), F.col("g")).alias("x"), evaluate.recall(F.col("n"), F.col("g")).alias("y"), evaluate.grounded(F.col("g"), F.col("e"), F.col("n")).alias("z")).first()
    assert tuple(r) == (0.5, None, 1.0)
    got = embedding.embed(spark.createDataFrame([(1, "a b"), (2, None)], "k int, t string"), "k", "t", embedding.hashing_provider(8), 8).collect()
    assert len(got) == 1 and abs(sum(x * x for x in got[0].embedding) - 1) < 1e-5


def test_english_words(spark):
    # Cases published with the algorithm.
    for word, want in {"caresses": "caress", "ponies": "poni", "cats": "cat", "agreed": "agre", "feed": "feed", "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "vietnamization": "vietnam", "sensibiliti": "sensibl", "triplicate": "triplic", "hopefulness": "hope", "electrical": "electr", "adoption": "adopt", "replacement": "replac", "probate": "probat", "rate": "rate", "controll": "control", "roll": "roll"}.items():
        assert english.stem(word) == want, word
    chunks = spark.read.parquet(f"{DATA}/doc_chunk.parquet").select("chunk_id", "content").collect()
    words = {w for r in chunks for w in english._WORD.findall((r.content or "").lower())}
    assert all(w.startswith(english.stem(w)[:-1] if len(english.stem(w)) > 2 else w[:1]) for w in words)
    asked = "The monitoring of patients, with ventilators"
    stems = english.query_stems(asked)
    assert "the" not in stems and "patient" in stems
    want = {r.chunk_id: sum(english.stem(w) in stems for w in english._WORD.findall((r.content or "").lower())) for r in chunks}
    df = spark.read.parquet(f"{DATA}/doc_chunk.parquet")
    got = {r.chunk_id: r.hits for r in retrieval.keyword_topk(df, "chunk_id", "content", asked, 10**6, "english").collect()}
    assert got == {k: v for k, v in want.items() if v}
    assert retrieval.keyword_topk(df, "chunk_id", "content", "the of", 5, "english").count() == 0


def test_streaming_upsert(spark, tmp_path):
    from policymill.streaming import refresh

    landing, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    row = lambda k, v, h: (k, v, dt.datetime(2025, 1, 1, h))
    schema = "k int, v string, at timestamp"
    for batch in ([row(1, "a", 1), row(1, "b", 2), row(2, "x", 1)], [row(1, "c", 3), row(3, "z", 1)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landing)
        refresh.upsert_stream(spark, landing, spark.createDataFrame([], schema).schema, target, ["k"], ["at"], check).awaitTermination()
    table = refresh.Buckets(spark, target, ["k"], spark.createDataFrame([], schema).schema)
    assert {(r.k, r.v) for r in table.read(1).collect()} == {(1, "c"), (2, "x"), (3, "z")}
    assert {(r.k, r.v) for r in table.read(0).collect()} == {(1, "b"), (2, "x")}
    at = table.manifest(1)
    assert set(at.values()) == {0, 1}  # the bucket of 2 was not written again


def test_citation_recall_of_every_kind_of_id(spark, tmp_path):
    spark.createDataFrame([(1, "L12345"), (2, "NCD 20.4"), (3, "A54321"), (4, "NCD 9"), (5, None)], "doc_pk bigint, public_id string").write.parquet(f"{tmp_path}/policy_doc.parquet")
    chunks = [(1, None, "see l12345."), (2, "NCD 20.4 > Uses", None), (3, None, "A5432"), (4, "NCD 9.1", "NCD 99"), (5, "L12345", "")]
    spark.createDataFrame(chunks, "doc_pk bigint, heading_path string, content string").write.parquet(f"{tmp_path}/doc_chunk.parquet")
    got = {r.doc_pk: r.recall for r in catalogue.QUERIES["citation_recall"](spark, str(tmp_path)).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 0.0, 4: 0.0}


def test_values_of_every_code(spark, tmp_path):
    codes = [(1, "12.9", "1", " ab"), (2, "1E2", "no", "x"), (3, "E11.9", "Y", None), (4, "99999999999", "0", "big"), (5, None, "t", "none"), (6, "-1e400", None, "")]
    spark.createDataFrame(codes, "code_pk bigint, code string, range_pos string, description string").write.parquet(f"{tmp_path}/policy_code.parquet")
    got = {r.code_pk: (r.n, r.flag, r.initial) for r in catalogue.QUERIES["values_parse"](spark, str(tmp_path)).collect()}
    assert got == {1: (12, True, "a"), 2: (100, False, "x"), 3: (None, True, None), 4: (None, False, "b"), 5: (None, True, "n"), 6: (None, None, None)}


def test_chunks_are_replaced_and_vectors_refreshed(spark):
    old = spark.createDataFrame([(7, 1, 0, "a", "A"), (8, 1, 1, "b", "B"), (9, 2, 0, "c", "C")], "chunk_id bigint, doc int, i int, content_hash string, content string")
    new = spark.createDataFrame([(1, 0, "a", "A"), (1, 1, "x", "X"), (3, 0, "a", "A"), (3, 1, "y", None)], "doc int, i int, content_hash string, content string").withColumn("heading_path", F.lit(None).cast("string"))
    day = dt.datetime(2025, 1, 1)
    vectors = spark.createDataFrame([(i, "m:1", [float(i), 0.0], day) for i in (7, 8, 9)] + [(7, "n", [1.0, 1.0], day), (8, None, None, day)], "chunk_id bigint, model string, embedding array<float>, created_at timestamp")
    chunks, left = chunking.apply_diff(old, new, vectors, ["doc", "i"])
    got = {(r.doc, r.i): r.chunk_id for r in chunks.collect()}
    assert got[1, 0] == 7 and got[1, 1] == 8 and sorted((got[3, 0], got[3, 1])) == [10, 11] and len(got) == 4
    assert sorted((r.chunk_id, r.model) for r in left.collect()) == [(7, "m:1"), (7, "n")]
    provider = lambda texts: np.array([[len(t), 1.0] for t in texts], np.float32)
    rows = {r.chunk_id: list(r.embedding) for r in embedding.refresh(chunks, left, "m:1", provider, 2, {"m": ("doc: ", "ask: ")}).collect()}
    assert rows == {8: [6.0, 1.0], got[3, 0]: [7.0, 0.0]}  # reused for the same hash, none for an empty text
    forced = {r.chunk_id: list(r.embedding) for r in embedding.refresh(chunks, left, "m:1", provider, 2, force=True).collect()}
    assert forced == {7: [1.0, 1.0], 8: [1.0, 1.0], got[3, 0]: [1.0, 1.0]}
    assert embedding.prefix("m:2", {"m": ("d", "q")}, query=True) == "q" and embedding.prefix("x", {}) == ""
    assert chunking.apply_diff(old.limit(0), new.limit(0), vectors, ["doc", "i"])[0].count() == 0


def test_means_and_top_counts(spark):
    each = spark.createDataFrame([("a", "m", 1.0), ("b", "m", 0.0), ("a", "n", 0.5), ("c", "n", None)], "item_id string, metric string, value double")
    assert {tuple(r) for r in evaluate.run_means(each).collect()} == {("m", 2, 0.5), ("n", 1, 0.5)}
    df = spark.createDataFrame([("b",), ("b",), ("a",), (None,), ("c",)], "k string")
    assert [tuple(r) for r in tables.top_counts(df, ["k"], 3).collect()] == [("b", 2), (None, 1), ("a", 1)]
