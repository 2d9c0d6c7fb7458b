"""Assembly of chunks on small tables, against literal results, and its keys on the whole of the smallest data."""

from pyspark.sql import functions as F

from policymill.operators import assembly, chunking, evaluate
from policymill.operators.chunking import Sizes
from policymill.operators.corpus import Corpus

DATA = "/root/testdata/sf0.001"
LABELS = {"issue": "Issue", "rules": "Rules"}


def test_sections(spark):
    long = "y" * 30
    rows = [(1, long, None), (2, "  " + "z" * 24 + "  ", long), (3, "", "n/a."), (4, None, None), (None, long, long), (1, long, None)]
    df = spark.createDataFrame([(*r, "extra", "extra") for r in rows], "k int, issue string, rules string, section string, label string")
    got = sorted((str(r.k), r.section, r.label, r.text) for r in assembly.sections(df, "k", LABELS).collect())
    assert got == [("1", "issue", "Issue", long), ("1", "issue", "Issue", long), ("2", "rules", "Rules", long), ("None", "issue", "Issue", long), ("None", "rules", "Rules", long)]
    assert assembly.sections(df.limit(0), "k", LABELS).count() == 0


def test_substantive(spark):
    cases = {None: False, "": False, " . " * 20: True, "None.": False, "x" * 24: False, "x" * 25: True, "n/a" + " " * 40: False}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.s for r in df.select("t", assembly.substantive(F.col("t")).alias("s")).collect()} == cases


def test_narrative_chunks(spark):
    body = "word " * 60
    texts = {1: "### Rules\n\n" + body, 2: "### Scope\n\n" + body, 3: "### Scope\n\nshort", 4: body, 5: None, 6: "", 7: "word. " * 3000, 8: "### \n\n" + body}
    df = spark.createDataFrame([(k, "L1: t", "Rules", t, "extra") for k, t in texts.items()], "k int, base string, label string, t string, head string").drop("head")
    got: dict = {}
    for r in assembly.narrative_chunks(df, ["k"], "base", "label", "t", Sizes()).orderBy("k", "chunk_index").collect():
        got.setdefault(r.k, []).append((r.heading_path, r.content))
    b = body.strip()
    assert got[1] == [("L1: t > Rules", b)] and got[2] == [("L1: t > Rules > Scope", b)]
    assert got[3] == [("L1: t > Rules > Scope", "### Scope\n\nshort")] and got[4] == [("L1: t > Rules", b)]
    assert set(got) == {1, 2, 3, 4, 7, 8} and len(got[7]) > 5 and all(p == "L1: t > Rules" for p, _ in got[7])


def test_build_chunks(spark):
    c = Corpus(spark, DATA)
    every = assembly.build_chunks(c).cache()
    assert every.count() > 0 and every.groupBy(*chunking.CHUNK_KEY).count().where("count > 1").count() == 0
    assert every.where("heading_path is null or content is null or content_hash is null or token_count < 1").count() == 0
    docs = assembly.selected(c).select("doc_pk")
    assert every.where("section = 'overview'").select("doc_pk").exceptAll(docs).count() == 0 and every.where("section = 'overview'").count() == docs.count()
    few = assembly.build_chunks(c, assembly.Plan(code_lists=False, left_out=("issue",)))
    want = every.where("source_table <> 'policy_code' and section <> 'issue'")
    assert few.count() == want.count() and few.exceptAll(want).count() == 0
    assert {r.action for r in chunking.diff(every, every).select("action").distinct().collect()} == {"unchanged"}
    none = assembly.build_chunks(c, assembly.Plan(doc_types=("NONE",)))
    assert none.count() == 0


def test_scores(spark):
    items = [(1, "Is L12345 active?", ["L12345", "NCD 240.4"], ["lookup"], "TX", "Texas"), (2, "q", [], ["search"], None, None), (3, None, None, None, "", None), (4, "no run", ["L1"], [], None, None)]
    runs = [
        (1, "See l12345 and A99999.", ["NCD 240.4 says"], [("lookup", " texas ")], None, 2.0), (2, "<|end|>", None, None, "failed", 1.0),
        (3, None, [], [], None, None), (9, "no item", [], [], None, 1.0),
    ]
    i = spark.createDataFrame(items, "item_id int, question string, public_ids array<string>, tools array<string>, state string, state_name string")
    r = spark.createDataFrame(runs, "item_id int, answer string, tool_results array<string>, tool_calls array<struct<name:string,state:string>>, error string, latency_s double")
    got = {(x.item_id, x.metric): x.value for x in evaluate.scores(i, r).collect()}
    common = {"completed", "answered", "clean_output", "tool_selection"}
    assert {k: v for k, v in got.items() if k[0] == 1} == {(1, k): v for k, v in {
        "citation_recall": 0.5, "retrieval_recall": 0.5, "citation_grounded": 0.5, "tool_selection": 1, "state_filter": 1, "completed": 1, "answered": 1, "clean_output": 1, "latency_s": 2, "tool_calls": 1,
    }.items()}
    assert {k: v for k, v in got.items() if k[0] == 2} == {(2, k): float(k == "answered") for k in common}
    assert {k[1] for k in got if k[0] == 3} == common | {"tool_calls"} and got[3, "answered"] == 0 and got[3, "clean_output"] == 1
    assert {k[0] for k in got} == {1, 2, 3} and evaluate.scores(i.limit(0), r).count() == 0
