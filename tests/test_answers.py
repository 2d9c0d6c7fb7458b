"""The questions of users: parameters, notes and edge cases on small tables; whole tables are compared with SQL elsewhere."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from policymill.operators import answers, retrieval
from policymill.operators.corpus import Corpus

TABLES = {
    "policy_doc": "doc_pk bigint, doc_type string, doc_id int, doc_version int, public_id string, title string, status string, is_draft boolean, is_latest boolean, effective_date date, end_date date, retired_date date",
    "lcd": "doc_pk bigint, source_lcd_id int",
    "policy_code": "code_pk bigint, doc_pk bigint, code_system string, role string, code string, code_version int, group_no int, range_pos string, sort_order int, description string, short_description string",
    "contractor": "load_id bigint, loaded_at timestamp, contractor_id int, contractor_type_id int, contractor_version int, contractor_bus_name string, contractor_number string, state_id int, status string",
    "state_lookup": "load_id bigint, loaded_at timestamp, state_id int, state_abbrev string, description string",
    "policy_contractor": "load_id bigint, doc_pk bigint, contractor_id int, contractor_type_id int, contractor_version int",
    "doc_chunk": "chunk_id bigint, doc_pk bigint, section string, source_key string, chunk_index int, heading_path string, content string",
}
T = dt.datetime(2024, 1, 1)
ROWS = {
    "policy_doc": [(1, "LCD", 10, 1, "L00010", "One", "A", False, True, None, None, None), (2, "ART", 10, 1, "A00010", "Two", "A", False, True, None, None, None), (3, "NCD", 7, 1, "NCD 20.4", None, "A", False, True, None, None, None), (4, "LCD", 11, 1, "L00011", "Old", "R", False, True, None, None, None)],
    "lcd": [(1, None), (4, 10)],
    "policy_code": [(1, 1, "ICD10CM", "covered", "E11.9", None, 1, None, None, "Sugar", None), (2, 1, "ICD10CM", "covered", "E11.9", None, 1, None, None, "again", None), (3, 2, "HCPCS", "listed", "E119", None, None, None, None, None, "short"), (4, 4, "HCPCS", "listed", "E119", None, 1, None, None, None, None)],
    "contractor": [(1, T, 5, 1, 1, "Mac", "001", 1, "A"), (2, T, 6, 1, 1, None, None, None, "A")],
    "state_lookup": [(1, T, 1, "MN", "Mina"), (2, T, 2, "CA", "Cala")],
    "policy_contractor": [(1, 1, 5, 1, 1), (2, 1, 5, 1, 1), (3, 2, 6, 1, 1)],
    "doc_chunk": [(1, 1, "indication", "", 0, "L > I", "oxygen for sleep apnea"), (2, 1, "icd10cm_covered_intro", "group=1", 1, None, "second"), (3, 1, "icd10cm_covered_intro", "group=1", 0, None, "x" * 600), (4, 3, "itm", "", 0, None, "oxygen oxygen"), (5, 2, "hcpcs_listed_codes", "", 0, None, "oxygen oxygen oxygen"), (6, 4, "indication", "", 0, None, "oxygen"), (7, 1, "indication", "", 1, "L > I", None)],
}


def _corpus(spark, path, rows=ROWS) -> Corpus:
    for name, schema in TABLES.items():
        spark.createDataFrame([(*r, "clash") for r in rows.get(name, [])], schema + ", hits string").write.parquet(f"{path}/{name}.parquet")
    return Corpus(spark, str(path))


def test_search(spark, tmp_path):
    c = _corpus(spark, tmp_path)
    ids = lambda *a, **k: [r.chunk_id for r in answers.search_policy_text(c, *a, **k).collect()]
    assert ids("Oxygen!") == [4, 1] and ids("oxygen", include_code_lists=True) == [5, 4, 1]
    assert ids("oxygen", state="mina") == [4, 1] and ids("oxygen", state="CA") == [4] and ids("oxygen", doc_type="article", include_code_lists=True) == [5]
    assert ids("oxygen", public_ids=["l00010", "20.4"]) == [4, 1] and ids("oxygen", public_ids=["ncd20.4"]) == [4] and ids("oxygen", public_ids=[]) == [] and ids("nothing") == []
    assert ids("oxygen", limit=0) == [4]
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (4, [0.0, 1.0]), (6, [1.0, 0.0])], "chunk_id bigint, embedding array<float>")
    rows = answers.search_policy_text(c, "sleep", vectors, [1.0, 0.0], state="MN").collect()
    assert [r.chunk_id for r in rows] == [1, 4] and rows[0].jurisdiction == "MN" and rows[0].other_states == 0 and rows[1].jurisdiction == answers.NATIONAL
    assert rows[0].contractors == "Mac" and rows[0].score == pytest.approx(2 / 61, abs=1e-6)
    notes = [answers.search_note(answers.search_policy_text(c, q), keyword_only=True).first() for q in ("oxygen", "nothing")]
    assert notes[0].results == 2 and "keywords" in notes[0].note and notes[1].results == 0 and "No passages" in notes[1].note
    for bad in (lambda: answers.search_policy_text(c, "  "), lambda: answers.search_policy_text(c, "x", doc_type="memo"), lambda: answers.search_policy_text(c, "x", state="nowhere"), lambda: answers.lookup_code(c, "x", system="icd9"), lambda: answers.list_policy_codes(c, "L00010", role="any")):
        with pytest.raises(ValueError):
            bad()


def test_codes(spark, tmp_path):
    c = _corpus(spark, tmp_path)
    rows = {r.doc_pk: r for r in answers.lookup_code(c, " e119 ").collect()}
    assert set(rows) == {1, 2} and rows[1].code == "E11.9" and rows[2].description == "short" and rows[2].group_note is None
    assert rows[1].group_note == "x" * 600 + "\nsecond" and rows[1].related == "A00010"
    assert answers.lookup_code(c, "e119", state="CA").count() == 0 and answers.lookup_code(c, "e119", system="hcpcs").first().doc_pk == 2
    note = answers.lookup_note(c, "e119", limit=1).first()
    assert note.policy_count == 2 and note.note.startswith("1 more")
    none = answers.lookup_note(c, "Z00").first()
    assert none.policy_count == 0 and "no finding of non-coverage" in none.note
    page = answers.list_policy_codes(c, "l00010", starts_with=" e1").collect()
    assert [(r.code, r.matching_codes, r.truncated, r.next_offset) for r in page] == [("E11.9", 1, False, None)]
    assert answers.list_policy_codes(c, "L00010", starts_with="E_").count() == 0 and answers.list_policy_codes(c, "no such").count() == 0


def test_descriptions_and_text(spark, tmp_path):
    c = _corpus(spark, tmp_path)
    one = answers.get_policy(c, "l00010").first()
    assert one.code_lists == "ICD10CM/covered=1" and one.sections == "indication=2/22; icd10cm_covered_intro=2/606" and one.doc_status == "active" and one.jurisdiction == "MN" and one.note is None
    old = answers.get_policy(c, "L00011").first()
    assert old.doc_status == "retired" and old.related == "L00010"
    assert answers.get_policy(c, "L99999").count() == 0
    text = answers.get_policy_text(c, "L00010", " INDICATION ").first()
    assert text.text == "L > I\noxygen for sleep apnea\n\n" and text.next_offset is None and text.total_chars == len(text.text)
    assert answers.get_policy_text(c, "L00010", "none").count() == 0


def test_empty_tables(spark, tmp_path):
    c = _corpus(spark, tmp_path, {})
    assert answers.get_policies(c).count() == answers.search_policy_text(c, "oxygen").count() == answers.lookup_code(c, "E119").count() == 0


def test_lexemes(spark):
    df = spark.createDataFrame([(1, "The patients' PATIENT, twice"), (2, None), (3, ""), (4, "...")], "k int, t string")
    assert {(r.lexeme, r.n) for r in retrieval.lexeme_table(df, "k", "t").collect()} == {("the", 1), ("patients", 1), ("patient", 1), ("twice", 1)}
    english = retrieval.lexeme_table(df, "k", "t", "english")
    assert dict(english.select("lexeme", "n").collect())["patient"] == 2 and not english.where("lexeme = 'the'").count()
    top = retrieval.lexeme_topk(english, "k", "patients of", analyzer="english").collect()
    assert [(r.k, r.hits, r.rank) for r in top] == [(1, 2, 1)] and top[0].score == pytest.approx(0.2 / 1.2)
    both = retrieval.keyword_topk(df, "k", "t", "patients of", analyzer="english").select("k", F.col("hits").alias("h"), "score").collect()
    assert [(r.k, r.h) for r in both] == [(1, 2)] and both[0].score == top[0].score
    assert retrieval.lexeme_topk(english, "k", "the of", analyzer="english").count() == 0
