"""Problem 9: the subject areas of each document, by latent Dirichlet topics.

One pass over the texts finds the words of every sentence and counts words over all documents; the counts give the
vocabulary (words that are neither common in a language nor rare). A distributed LDA is fitted on it by incremental
expectation maximisation: documents are dealt into slices, a step fits the topic proportions of one slice with Spark
and replaces that slice's expected counts in the model, so every document is in exactly one step of every pass and
counts once in the model, whatever the size of the corpus. Each topic is mapped to the subject that its top terms
point to in the labelled documents, or to none (`topic_report` shows terms and subjects). A document's topic
proportions then weigh the topics of each sentence, and a subject is assigned if it takes a given share of the sentences.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policymill.runtime import materialize

WORD = re.compile(r"[^\W\d_]+(?:[-'][^\W\d_]+)*")
MARKUP = re.compile(r"<[^<>\s]{1,200}>|&(?:#\d+|#x[0-9a-f]+|[a-z]{2,8});")
END = re.compile(r"[.!?][\"'”’»)]*$")
FOLDS = 20  # rounds in which the topic proportions of a document are fitted
NO_END = {"e.g.", "(e.g.", "i.e.", "(i.e.", "no."}  # abbreviations before which no sentence ends
LIST = re.compile(r"(?:[-*•]|\d{1,3}[.)])$")
DOC_PRIOR, TERM_PRIOR = 0.05, 0.02  # Dirichlet concentrations of a document's topics and of a topic's terms
_CELLS = 20_000  # terms of documents that are fitted together
_TERMS_A_ROW = 64  # terms whose expected counts travel in one row


class Pieces(dict):
    """Blank-separated pieces of lower-case text: (hashes of their words, whether a sentence ends, whether it is more than markup)."""

    def __init__(self) -> None:
        super().__init__()
        self.names: dict[int, str] = {}

    def __missing__(self, piece: str) -> tuple[tuple, bool, bool]:
        plain = MARKUP.sub(" ", piece).replace("’", "'")
        words = []
        for w in WORD.findall(plain):
            if len(w) > 1:
                h = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace")) - (1 << 63)
                self.names[h] = w
                words.append(h)
        got = self[piece] = (tuple(words), piece not in NO_END and END.search(plain) is not None, not plain.isspace())
        return got


@dataclass(frozen=True)
class Settings:
    """Parameters of the model; none depends on the size of the corpus.

    The vocabulary needs no cap: as its terms occur in at least `rare` of a language's documents, a language has at most
    its mean number of different words a document, divided by `rare`, of them.
    """

    topics: int = 72
    slices: int = 10  # steps a pass
    passes: int = 3  # steps that each document is in
    common: float = 0.12  # words in at least this share of a language's documents are background
    rare: float = 0.003  # words in less than this share of every language's documents are left out
    least_language: float = 0.02  # languages below this share of documents are pooled; they judge only words that no other has
    top_terms: int = 15  # terms of a topic that are looked at to name it
    lift: float = 2.0  # how much more often than average a topic's terms must go with its subject
    least_score: float = 0.3  # summed weight of a subject's topics over a sentence's terms from which the sentence can be its
    share: float = 1 / 6
    seed: int = 11


@dataclass
class Topics:
    """A fitted model: terms, topic distributions (terms x topics), subject ids, and of each topic its subject column (or -1) and lift."""

    terms: list[str]
    phi: np.ndarray
    ids: list[int]
    named: np.ndarray
    lift: np.ndarray


def sentence_words(text: str, pieces: Pieces) -> list[list]:
    """The words of each sentence or list line; headings are none."""
    out = []
    for line in text.lower().splitlines():
        own = line.split()
        if not own or own[0][0] == "#":
            continue
        words: list = []
        more = False
        for piece in own[1:] if LIST.match(own[0]) else own:
            w, ends, solid = pieces[piece]
            words += w
            more |= solid
            if ends and more:
                out.append(words)
                words, more = [], False
        if more:
            out.append(words)
    return out


_READ = "what string, k bigint, n int, sizes array<int>, words array<bigint>, lang string, word string, h bigint, docs bigint"


def read_texts(docs: DataFrame) -> DataFrame:
    """One pass over all texts, written once: rows `text` (k, n sentences, words by sentence) and `count` (lang, word, docs).

    The word NULL counts the documents themselves. Counts are summed over a task before they are put out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, seen = Pieces(), {}

        def rows(what: str, size: int, **cols: pa.Array) -> pa.RecordBatch:
            kinds = {"k": pa.int64(), "n": pa.int32(), "sizes": pa.list_(pa.int32()), "words": pa.list_(pa.int64()), "lang": pa.string(), "word": pa.string(), "h": pa.int64(), "docs": pa.int64()}
            given = [cols.get(c, None) if c in cols else pa.nulls(size, t) for c, t in kinds.items()]
            return pa.RecordBatch.from_arrays([pa.array([what] * size, pa.string()), *given], ["what", *kinds])

        def counted() -> pa.RecordBatch:
            flat = [(lang, pieces.names.get(h), h, n) for lang, own in seen.items() for h, n in own.items()]
            lang, word, h, n = zip(*flat) if flat else ((), (), (), ())
            seen.clear()
            return rows("count", len(flat), lang=pa.array(lang, pa.string()), word=pa.array(word, pa.string()), h=pa.array(h, pa.int64()), docs=pa.array(n, pa.int64()))

        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                n, sizes, words = [], [], []
                for lang, text in zip(part.column("lang").to_pylist(), part.column("t").to_pylist()):
                    own = sentence_words(text, pieces)
                    flat = [h for x in own for h in x]
                    count = seen.setdefault(lang, Counter())
                    count.update(set(flat))
                    count[None] += 1
                    n.append(len(own))
                    sizes.append([len(x) for x in own if x])
                    words.append(flat)
                yield rows("text", len(part), k=part.column("k"), n=pa.array(n, pa.int32()), sizes=pa.array(sizes, pa.list_(pa.int32())), words=pa.array(words, pa.list_(pa.int64())))
                if len(pieces) > 500_000:
                    yield counted()
                    pieces = Pieces()
        yield counted()

    return materialize(docs.select("k", "lang", "t").mapInArrow(run, _READ), "texts-read")


def vocabulary(counts: DataFrame, s: Settings) -> list[tuple[str, int]]:
    """(term, hash) of the words that are common in no language and not rare in one, the most frequent first.

    Languages of few documents are pooled, and the pool is asked about the words that no larger language has.
    """
    per = materialize(counts.groupBy("lang", "word", "h").agg(F.sum("docs").alias("docs")), "word-counts")
    sizes = per.where("word is null").select("lang", F.col("docs").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    groups = sizes.withColumn("large", F.col("n") >= total * s.least_language)
    n_pool = F.lit(sizes.where(F.col("n") < total * s.least_language).agg(F.sum("n")).first()[0] or 0)
    words = per.where("word is not null").join(F.broadcast(groups), "lang")  # a row for each language
    docs, rate = F.col("docs"), F.col("docs") / F.col("n")
    words = words.groupBy("word", "h").agg(
        F.max(F.when(F.col("large"), rate)).alias("most"), F.max(F.when(F.col("large") & (docs >= 3), rate)).alias("firm"),
        F.sum(F.when(~F.col("large"), docs)).alias("pooled"), F.sum(docs).alias("docs"),
    )
    known, pooled = F.col("most").isNotNull(), F.col("pooled") / n_pool
    keep = F.when(known, (F.col("most") < s.common) & (F.col("firm") >= s.rare)).otherwise((F.col("pooled") >= 3) & (pooled < s.common) & (pooled >= s.rare))
    return [(r.word, r.h) for r in words.where(keep).orderBy(F.desc("docs"), "word").collect()]


def term_sentences(texts: DataFrame, vocabulary: list[tuple[str, int]], s: Settings) -> DataFrame:
    """(k, n, sizes, terms, slice): the term numbers of each text by sentence, sentences without any left out; written by slice."""
    hashes = np.array([h for _, h in vocabulary], np.int64)
    order = np.argsort(hashes)
    shipped = texts.sparkSession.sparkContext.broadcast((hashes[order], order.astype(np.int32)))  # bounded, see Settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = shipped.value
        for batch in batches:
            sizes, words = batch.column("sizes"), batch.column("words").flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            held = known[at] == words
            upto = np.concatenate([[0], np.cumsum(held)])
            ends = np.concatenate([[0], np.cumsum(sizes.flatten().to_numpy())])
            left = np.diff(upto[ends])  # terms of each sentence
            some = np.concatenate([[0], np.cumsum(left > 0)])
            by_text = np.concatenate([[0], np.cumsum(sizes.value_lengths().to_numpy())])
            of_words = np.concatenate([[0], np.cumsum(batch.column("words").value_lengths().to_numpy())])
            sizes = pa.ListArray.from_arrays(pa.array(some[by_text], pa.int32()), pa.array(left[left > 0], pa.int32()))
            terms = pa.ListArray.from_arrays(pa.array(upto[of_words], pa.int32()), pa.array(number[at[held]], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("n"), sizes, terms], ["k", "n", "sizes", "terms"])

    rows = texts.select("k", "n", "sizes", "words").mapInArrow(run, "k bigint, n int, sizes array<int>, terms array<int>")
    return materialize(rows.withColumn("slice", F.pmod(F.xxhash64("k"), F.lit(s.slices))), "term-sentences", "slice")


def bags(terms: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of term numbers below `size`: how many different terms each has, these, their counts, and where each term is among them."""
    n = terms.value_lengths().to_numpy()
    at, where, count = np.unique(np.repeat(np.arange(len(n)), n) * size + terms.flatten().to_numpy(), return_inverse=True, return_counts=True)
    return np.bincount(at // size, minlength=len(n)), at % size, count.astype(np.float32), where


def proportions(sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, phi: np.ndarray, rounds: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Topic weights of each document (their sum is its length and the priors), and the fitted weight of each of its terms.

    Documents of about the same number of different terms are fitted together.
    """
    topics, starts = phi.shape[1], np.cumsum(sizes) - sizes
    theta, fitted = np.full((len(sizes), topics), 1 / topics, np.float32), np.ones(len(terms), np.float32)
    wide = -(-sizes // 4) * 4
    for width in np.unique(wide[sizes > 0]).tolist():
        alike = np.flatnonzero(wide == width)
        for at in range(0, len(alike), max(1, _CELLS // width)):
            docs = alike[at : at + max(1, _CELLS // width)]
            mine = np.arange(width) < sizes[docs, None]
            cell = starts[docs, None] + np.where(mine, np.arange(width), 0)
            p, c = phi[terms[cell]], counts[cell] * mine
            t = theta[docs, None, :]
            for _ in range(FOLDS if rounds is None else rounds):
                weight = c / (np.matmul(p, t.transpose(0, 2, 1))[:, :, 0] + 1e-20)
                t = t * np.matmul(weight[:, None, :], p) + np.float32(DOC_PRIOR)
            theta[docs] = t[:, 0]
            fitted[cell[mine]] = np.matmul(p, t.transpose(0, 2, 1))[:, :, 0][mine]
    return theta, fitted


def _slice_counts(rows: DataFrame, phi: np.ndarray) -> np.ndarray:
    """Expected counts (terms x topics) of the documents in `rows`: summed in each task, then over tasks by blocks of terms."""
    size, topics = phi.shape
    shipped = rows.sparkSession.sparkContext.broadcast(phi)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phi, total = shipped.value, np.zeros((size, topics), np.float32)
        for batch in batches:
            for at in range(0, len(batch), 2000):
                sizes, terms, counts, _ = bags(batch.column("terms").slice(at, 2000), size)
                if len(terms):
                    theta, fitted = proportions(sizes, terms, counts, phi)
                    order = np.argsort(terms, kind="stable")
                    own, first = np.unique(terms[order], return_index=True)
                    weight = (counts / (fitted + 1e-20))[order, None]
                    total[own] += np.add.reduceat(theta[np.repeat(np.arange(len(sizes)), sizes)[order]] * weight, first, axis=0) * phi[own]
        blocks = range(0, size, _TERMS_A_ROW)
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([total[b : b + _TERMS_A_ROW].tobytes() for b in blocks], pa.binary())], ["block", "counts"])

    def add(key: tuple, t: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(b, np.float32).astype(np.float64) for b in t.column("counts").to_pylist())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([whole.tobytes()], pa.binary())})

    parts = rows.select("terms").mapInArrow(expect, "block int, counts binary").groupBy("block").applyInArrow(add, "block int, counts binary")
    out = np.zeros((size, topics))
    for block, counts in parts.collect():  # the model, bounded by the vocabulary
        out[block : block + _TERMS_A_ROW] = np.frombuffer(counts, np.float64).reshape(-1, topics)
    shipped.unpersist()
    return out


def fit_topics(rows: DataFrame, terms: int, s: Settings) -> np.ndarray:
    """Topic distributions (terms x topics) over all documents: `passes` rounds of steps, each over one slice."""
    rng = np.random.default_rng(s.seed)
    phi = rng.gamma(1.0, size=(terms, s.topics))
    held: dict[int, np.ndarray] = {}
    for _ in range(s.passes):
        for i in range(s.slices):
            held[i] = _slice_counts(rows.where(F.col("slice") == i), (phi / phi.sum(0)).astype(np.float32))
            phi = sum(held.values()) + TERM_PRIOR
    return (phi / phi.sum(0)).astype(np.float32)


def name_topics(phi: np.ndarray, pairs: np.ndarray, labelled: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The subject column of each topic, or -1, and the lift: how much more often than average its top terms occur with the subject.

    phi: terms x topics; pairs: labelled documents with term and subject, terms x subjects; labelled: those per subject.
    """
    total = max(1.0, labelled.sum())
    seen = pairs.sum(1)
    lift = (pairs + 1) / (seen + len(labelled))[:, None] / ((labelled + 1) / (total + len(labelled)))[None, :]
    least = min(np.log(s.lift), np.log(len(labelled)) / 2)  # few subjects leave little room for a lift
    out, found = np.full(phi.shape[1], -1), np.zeros(phi.shape[1])
    for t in range(phi.shape[1]):
        top = np.argsort(-phi[:, t], kind="stable")[: s.top_terms]
        score = (phi[top, t][:, None] * np.log(lift[top])).sum(0) / phi[top, t].sum()
        found[t] = np.exp(score.max())
        if score.max() >= least:
            out[t] = int(score.argmax())
    return out, found


def _assign(rows: DataFrame, m: Topics, s: Settings) -> DataFrame:
    shipped = rows.sparkSession.sparkContext.broadcast((m.phi, m.named, np.array(m.ids, np.int64)))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phi, subject, ids = shipped.value
        of = np.zeros((phi.shape[1], len(ids)), np.float32)
        of[np.flatnonzero(subject >= 0), subject[subject >= 0]] = 1
        for whole in batches:
            for at in range(0, len(whole), 2000):
                batch = whole.slice(at, 2000)
                sizes, terms, counts, where = bags(batch.column("terms"), len(phi))
                per = batch.column("sizes").value_lengths().to_numpy()
                if not per.sum():
                    continue
                theta, fitted = proportions(sizes, terms, counts, phi)
                got = ((phi[terms] * theta[np.repeat(np.arange(len(sizes)), sizes)]) @ of) / (fitted + 1e-20)[:, None]
                ends = np.cumsum(batch.column("sizes").flatten().to_numpy())
                score = np.add.reduceat(got[where], np.concatenate([[0], ends[:-1]]), axis=0)
                doc, best = np.repeat(np.arange(len(per)), per), score.argmax(1)
                sure = score.max(1) > s.least_score
                at_, count = np.unique(doc[sure] * len(ids) + best[sure], return_counts=True)
                doc, j = at_ // len(ids), at_ % len(ids)
                n = batch.column("n").to_numpy()[doc]
                keep = count >= s.share * n - 1e-9
                yield pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(doc[keep])), pa.array(ids[j[keep]]), pa.array(count[keep] / n[keep])], ["k", "subject_id", "share"])

    return rows.select("k", "n", "sizes", "terms").mapInArrow(run, "k bigint, subject_id bigint, share double")


def fitted(df: DataFrame, labels: DataFrame, key: str, text: str, lang: str, s: Settings) -> tuple[DataFrame, Topics] | None:
    """The documents' terms by sentence and the model fitted on them; None without labels or terms."""
    docs = df.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("k"), F.lower(F.trim(F.coalesce(F.col(lang), F.lit("")))).alias("lang"), F.col(text).alias("t"))
    read = read_texts(docs)
    known = vocabulary(read.where("what = 'count'"), s)
    given = labels.select(F.col(key).cast("bigint").alias("k"), F.col("subject_id").cast("bigint").alias("subject_id")).dropna().distinct()
    if not known:
        return None
    rows = term_sentences(read.where("what = 'text'"), known, s)
    per_doc = rows.join(given, "k").where(F.size("terms") > 0).select("subject_id", F.array_distinct("terms").alias("w"))
    per_doc = materialize(per_doc, "labelled")
    sizes = {r[0]: r[1] for r in per_doc.groupBy("subject_id").count().collect()}  # one row per subject
    if not sizes:
        return None
    ids = sorted(sizes)
    pairs = np.zeros((len(known), len(ids)))
    for w, sub, n in per_doc.select(F.explode("w").alias("w"), "subject_id").groupBy("w", "subject_id").count().toLocalIterator():
        pairs[w, ids.index(sub)] = n  # terms x subjects
    phi = fit_topics(rows, len(known), s)
    return rows, Topics([w for w, _ in known], phi, ids, *name_topics(phi, pairs, np.array([sizes[i] for i in ids], float), s))


def subjects(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(key, subject_id, share) of each subject that takes at least the set share of a document's sentences.

    `labels` (key, subject_id) name the topics; all of them count, repeated ones once, NULLs never. NULL, empty and
    wordless texts have no subject; without labels or terms no document has. NULL languages count as one. Rows with
    the same key are documents of their own. Other columns are not read.
    """
    got = fitted(df, labels, key, text, lang, settings)
    if got is None:
        return df.sparkSession.createDataFrame([], f"{key} bigint, subject_id bigint, share double")
    return _assign(*got, settings).withColumnRenamed("k", key)


def topic_report(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(topic, subject_id, lift, terms): the top terms by which each topic is named, and what they point to; NULL if to nothing.

    Without labels or terms there are no rows.
    """
    got = fitted(df, labels, key, text, lang, settings)
    rows = []
    if got is not None:
        m = got[1]
        for t in range(m.phi.shape[1]):
            top = np.argsort(-m.phi[:, t], kind="stable")[: settings.top_terms]
            rows.append((t, m.ids[m.named[t]] if m.named[t] >= 0 else None, float(m.lift[t]), [m.terms[i] for i in top]))
    return df.sparkSession.createDataFrame(rows, "topic int, subject_id bigint, lift double, terms array<string>")
