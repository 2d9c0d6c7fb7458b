"""The llm operators against brute force, invariants and round trips."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from policymill.llm import components, near_duplicates, neighbours, packing, splitting, subjects, tokenizer

WEIRD = [None, "", " ", "  two  blanks ", "a\n\n b\t c ", "<|endoftext|> it's I'LL don't", "x" * 3000, "naïve coöperate ½ µg/m² नीति ページ 😀🏳️‍🌈", " nbsp em ", "a\r\nb", "tail ", " 12 34"]


def test_tokens_match_the_public_library(spark):
    import base64

    import tiktoken

    with open(tokenizer.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    want = tiktoken.Encoding("own", pat_str=tokenizer.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    words = [t.decode("utf-8", "ignore") for t in rng.sample(list(ranks), 3000)]
    texts = WEIRD + ["".join(rng.choices(words, k=30)) for _ in range(200)] + WEIRD[:6]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id bigint, text string, ids int")
    got = {r.doc_id: list(r.ids) for r in tokenizer.encode_texts(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == want.encode_ordinary(t or ""), repr(t)
    assert tokenizer.encode_texts(df.limit(0)).count() == 0


def test_containers(spark, monkeypatch):
    rng = random.Random(2)
    texts = WEIRD + [" ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=rng.randrange(1, 400))) for _ in range(300)] + ["same text"] * 200
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sizes = {r.doc_id: len(r.ids) for r in tokenizer.encode_texts(df).collect()}
    rows = packing.fill_containers(df, capacity=256).collect()
    used, per = {}, {}
    for r in rows:
        used[r.container_id] = used.get(r.container_id, 0) + r.tokens
        per.setdefault(r.doc_id, []).append(r)
    assert max(used.values()) <= 256 and {k for k, n in sizes.items() if n} == set(per)
    for k, own in per.items():
        own.sort(key=lambda r: r.piece)
        assert sum(r.tokens for r in own) == sizes[k] and len(own) == -(-sizes[k] // 256) and [r.first_token for r in own] == [256 * i for i in range(len(own))]
    assert 1 - sum(used.values()) / 256 / len(used) < 0.1
    monkeypatch.setattr(packing, "WINDOW", 16)
    monkeypatch.setattr(packing, "RANGE_ROWS", 100)
    near: dict = {}
    for r in packing.fill_containers(df, capacity=256).collect():
        near.setdefault(r.container_id, []).append((r.container_id >> 40, r.place))
    assert len({x[0][0] for x in near.values()}) > 1  # more than one range
    for own in near.values():
        assert len({part for part, _ in own}) == 1 and max(p for _, p in own) // 16 - min(p for _, p in own) // 16 <= packing.CARRY
    report = packing.fill_report(packing.fill_containers(df.limit(0)), 256).first()
    assert (report.containers, report.tokens, report.unused_share) == (0, 0, None)


def test_hilbert_neighbours_touch():
    bits = 3
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * 3), -1).reshape(-1, 3)
    order = grid[np.argsort(packing.hilbert_key(grid, bits))]
    assert len(set(packing.hilbert_key(grid, bits).tolist())) == len(grid)
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("span", [1 << 16, 8000])
def test_pieces(spark, span):
    rng = random.Random(3)
    block = lambda: rng.choice(["### Head\n", "One sentence here. Another follows! ", "\n\n", "- item\n", "a | b | c\n", "y" * rng.randrange(1, 900), "\r\n", " "])
    rows = [(i, "".join(block() for _ in range(rng.randrange(1, 400))), rng.choice([None, "h", "Path > deeper"])) for i in range(40)]
    rows += [(100, "z" * 70_000, None), (101, None, "h"), (102, "", None), (103, "q " * 600, "H" * 1500), (105, "q " * 600, "H" * 1499), (106, "", "H " * 2500), (107, "\u00e9 end. " * 30_000, "h"), (104, "w" * 1990, "H" * 10)]
    df = spark.createDataFrame(rows, "id int, t string, h string")
    got = {}
    for r in splitting.split_texts(df, ["id"], "t", "h", span=span).collect():
        got.setdefault(r.id, []).append(r)
    assert set(got) == {i for i, t, h in rows if t is not None and len(t) + (len(h) + 1 if h is not None else 0) > 2000}
    for i, t, h in rows:
        own = sorted(got.get(i, []), key=lambda r: r.piece_no)
        if own:
            long = h is not None and len(h) > 1499  # heading and text are then one text
            lead, t = ("", h + "\n" + t) if long else ("" if h is None else h + "\n", t)
            assert [r.piece_no for r in own] == list(range(len(own))) and own[0].start == 0 and own[-1].end == len(t)
            assert all(r.content == lead + t[r.start : r.end] and len(r.content) <= 2000 and r.lead == len(lead) for r in own)
            assert all(1 <= a.end - b.start <= 200 for a, b in zip(own, own[1:]))


def test_file_pieces(spark, tmp_path):
    text = "".join(f"Sentence {i} is naïve — ページ.{' ' if i % 7 else chr(10) * 2}" for i in range(9000))
    (tmp_path / "big.txt").write_text(text, encoding="utf-8")
    (tmp_path / "none.txt").write_text("")
    rows = splitting.split_files(spark, [str(tmp_path / n) for n in ("big.txt", "none.txt")], span=40_000).collect()
    own = sorted((r for r in rows if r.path.endswith("big.txt")), key=lambda r: r.piece_no)
    assert own[0].start == 0 and own[-1].end == len(text) and all(r.content == text[r.start : r.end] for r in own)
    assert all(1 <= a.end - b.start <= 200 for a, b in zip(own, own[1:])) and max(len(r.content) for r in own) <= 2000


def _groups(rows, width, threshold, least):
    runs = {}
    for i, t in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        if len(w) >= max(least, width):
            runs[i] = frozenset(tuple(w[j : j + width]) for j in range(len(w) - width + 1))
    root = {i: i for i in runs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(runs)
    for a in ids:
        for b in ids:
            if a < b and len(runs[a] & runs[b]) >= threshold * len(runs[a] | runs[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(1000, None), (1001, ""), (1002, "too few words")]
    for i in range(60):
        base = rng.choices(vocabulary, k=rng.randrange(40, 160))
        for _ in range(rng.choice([1, 1, 2, 5])):
            own = list(base)
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
    hot = rng.choices(vocabulary, k=100)
    for i in range(700):  # more than a bucket holds
        own = list(hot)
        own[rng.randrange(100)] = f"v{i % 690}"
        rows.append((5000 + i, " ".join(own).upper()))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "id bigint, text string, group_id string")
    got = {r.id: r for r in near_duplicates.near_duplicate_groups(df, "id", "text", None, 3, 0.7, 20).collect()}
    want = _groups(rows, 3, 0.7, 20)
    assert {i: r.group_id for i, r in got.items()} == want
    pairs = near_duplicates.group_pairs(near_duplicates.near_duplicate_groups(df.where("id < 900"), "id", "text", None, 3, 0.7, 20), ["item_table", "id"]).collect()
    small = {i: g for i, g in want.items() if i < 900}
    assert {(r.id_a, r.id_b) for r in pairs} == {(a, b) for a in small for b in small if a < b and small[a] == small[b]}
    assert near_duplicates.near_duplicate_groups(df.limit(0), "id", "text").count() == 0


def test_large_buckets_are_passed_on_whole():
    n = {"a": 9000, "b": 8600, "c": 3}
    g = [x for x, k in n.items() for _ in range(k)]
    rows = {"g": pa.array(g), "rep": pa.array(range(len(g)), pa.int64()), "s0": pa.array([0] * len(g), pa.int64()), "s1": pa.array([0] * len(g), pa.int64()), "key": pa.array([7] * len(g), pa.int64())}
    batches = pa.table(rows).to_batches(max_chunksize=1000)
    out = pa.Table.from_batches(list(near_duplicates._meet(iter(batches)))).to_pylist()
    hot = [r for r in out if r["b"] is None]
    assert sorted(r["a"] for r in hot) == list(range(n["a"] + n["b"]))
    small = {(r["a"], r["b"]) for r in out if r["b"] is not None}
    assert small == {(x, y) for x in range(17600, 17603) for y in range(x + 1, 17603)}


def test_components(spark):
    edges = [("g", i, i + 1) for i in range(60)] + [("g", 100, i) for i in range(101, 160)] + [("h", 1, 2)]
    got = {(r.g, r.node): r.component for r in components.connected(spark.createDataFrame(edges, "g string, a bigint, b bigint"), "g", "a", "b").collect()}
    assert got == {("g", i): 0 for i in range(61)} | {("g", i): 100 for i in range(100, 160)} | {("h", 1): 1, ("h", 2): 1}


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([centres[rng.integers(0, 12, 700)] + 0.4 * rng.normal(size=(700, 16)), rng.normal(size=(40, 16))]).astype(np.float32)
    x[100:130] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9001, [0.0] * 16), (9002, [1.0] * 15), (9003, [float("nan")] * 16), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "id bigint, v array<float>")
    got = {}
    for r in neighbours.nearest(df, "id", "v", 16).collect():
        got.setdefault(r.id, {})[r.rank] = r.neighbour
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -2)
    want = np.argsort(-s, axis=1, kind="stable")[:, :5]
    assert set(got) == set(range(len(x)))
    right = sum(len(set(got[i].values()) & set(want[i].tolist())) for i in got) / want.size
    assert right >= 0.95
    assert [got[110][k] for k in range(1, 6)] == [100, 101, 102, 103, 104]
    assert neighbours.nearest(df.limit(0), "id", "v", 16).count() == 0
    assert neighbours.nearest(df.where("id < 2"), "id", "v", 16).count() == 2


def test_neighbours_beyond_the_blocks_around(spark, monkeypatch):
    for name, v in (("BLOCK", 16), ("SAMPLE", 2), ("ARRAYS", 2), ("LONELY", -1.0)):  # all rows in both arrays, none lonely
        monkeypatch.setattr(neighbours, name, v)
    x = np.random.default_rng(7).normal(size=(500, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<float>")
    got = {}
    for r in neighbours.nearest(df, "id", "v", 8).collect():
        got.setdefault(r.id, set()).add(r.neighbour)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = np.argsort(-s, axis=1, kind="stable")[:, :5]
    assert all(got[i] == set(want[i].tolist()) for i in range(len(x)))


def test_subjects(spark):
    rng = random.Random(6)
    themes = {s: [f"{c}{w}" for w in ("lens", "scan", "court", "burn", "tumour", "ramp", "sleep", "mood")] for s, c in ((1, "a"), (2, "b"), (3, "c"))}
    docs, truth = [], {}
    for i in range(400):
        own = rng.sample([1, 2, 3], rng.choice([1, 1, 2]))
        truth[i] = set(own)
        docs.append((i, " ".join(f"The {rng.choice(themes[s])} was noted by {rng.choice(themes[s])}." for s in own for _ in range(5)) + "\n### Heading\n- see the note", "en"))
    docs += [(1000, None, "en"), (1001, "", None), (1002, "1 2 3", "en")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, s) for i in range(200) for s in truth[i]] + [(5, None), (5, None)], "doc_id bigint, subject_id int")
    settings = subjects.Settings(topics=9, common=0.9)
    got = {}
    for r in subjects.subjects(df, labels, settings=settings).collect():
        got.setdefault(r.doc_id, set()).add(r.subject_id)
    held_out = [i for i in range(200, 400)]
    assert sum(got.get(i) == truth[i] for i in held_out) / len(held_out) > 0.85
    assert not {1000, 1001, 1002} & set(got)
    assert subjects.subjects(df, labels.limit(0), settings=settings).count() == 0
    assert subjects.subjects(df.limit(0), labels, settings=settings).count() == 0


def test_topic_proportions_are_near_their_limit():
    phi = np.array([[0.5, 0.3], [0.3, 0.5]], np.float32)  # topics that share their words
    sizes, terms, counts = np.array([2]), np.array([0, 1]), np.array([60, 20], np.float32)
    (theta, _), (end, _) = (subjects.proportions(sizes, terms, counts, phi, *r) for r in ((), (1000,)))
    assert abs(theta / theta.sum() - end / end.sum()).max() < 0.05


def test_topic_proportions_match_a_plain_loop():
    rng = np.random.default_rng(8)
    phi = rng.dirichlet(np.ones(30), 5).T.astype(np.float32)
    docs = [rng.integers(0, 30, n).tolist() for n in (1, 3, 40, 0, 7, 7, 200)]
    sizes, terms, counts, where = subjects.bags(pa.array(docs, pa.list_(pa.int32())), 30)
    theta, fitted = subjects.proportions(sizes, terms, counts, phi)
    starts = np.cumsum(sizes) - sizes
    for d, words in enumerate(docs):
        own = sorted(set(words))
        assert terms[starts[d] : starts[d] + sizes[d]].tolist() == own and counts[starts[d] : starts[d] + sizes[d]].tolist() == [words.count(w) for w in own]
        t = np.full(5, 1 / 5)
        for _ in range(subjects.FOLDS):
            t = t * sum((phi[w] / (phi[w] @ t) for w in words), np.zeros(5)) + subjects.DOC_PRIOR
        if words:
            assert np.allclose(theta[d], t, rtol=1e-3, atol=1e-3) and np.allclose(fitted[starts[d] : starts[d] + sizes[d]], phi[own] @ theta[d], rtol=1e-3)
    assert [terms[w] for w in where] == [w for words in docs for w in words]


def test_words_of_small_languages_are_kept(spark):
    rows = [(i, f"The court case {['alpha', 'beta', 'gamma', 'delta'][i % 4]} now.", "en") for i in range(2000)] + [(5000 + i, f"{['uno', 'dos'][i % 2]} otro tres{'abcdefghi'[i % 4]}.", "xx") for i in range(20)]
    docs = spark.createDataFrame(rows, "k bigint, t string, lang string")
    got = [w for w, _ in subjects.vocabulary(subjects.read_texts(docs).where("what = 'count'"), subjects.Settings(common=0.3))]
    assert {"alpha", "beta", "gamma", "delta"} <= set(got) and "court" not in got
    assert {"tresa", "tresb"} <= set(got) and "otro" not in got  # judged among the 20 documents of the pool


def test_topic_report(spark):
    docs = [(i, "Lens scan retina. Lens scan eye." if i % 2 else "Court judge trial. Court judge law.", "en") for i in range(200)]
    labels = spark.createDataFrame([(i, 1 if i % 2 else 2) for i in range(100)], "doc_id bigint, subject_id int")
    rows = subjects.topic_report(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), labels, settings=subjects.Settings(topics=4, common=0.9)).collect()
    assert len(rows) == 4 and all(len(r.terms) <= 15 for r in rows)
    for r in rows:
        if r.subject_id is not None:
            assert (r.terms[0] in {"lens", "scan", "retina", "eye"}) == (r.subject_id == 1)
    assert {r.subject_id for r in rows} >= {1, 2}
    assert subjects.topic_report(spark.createDataFrame([], "doc_id bigint, text string, lang string"), labels).count() == 0
