"""Problem 7: encoding of the whole corpus with a public byte-pair tokenizer.

Texts fall apart at single blanks, which no token crosses; every distinct word of a task is encoded once. Distinct
words are inserted into a trie and traversed depth first (in sorted order, where the path to a word shares its common
prefix with the word before): each node gets the last token of the encoding of its prefix, found from the states
above it, so shared prefixes are computed once. A word's tokens are read back from its leaf. Map-only: no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pre-token pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_MIXED_BLANKS = regex.compile(r"^\s|\s$|\s \S|\S \s|\s{2}")
_SINGLE_BLANK = regex.compile(r"(?<=\S) (?=\S)")
MOST_WORDS, MOST_FITS = 400_000, 1_000_000  # kept by a worker before it starts afresh
TEXTS_AT_ONCE, CHARS_AT_ONCE = 1000, 4_000_000


class TrieEncoder:
    """Encodes sets of words with byte-pair merges by rank, sharing the work of common prefixes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._fits: dict[tuple[int, int], bool] = {}

    def merge(self, word: bytes) -> list[int]:
        """Plain merging by lowest rank, for pairs of tokens."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 40))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def follows(self, a: int, b: int) -> bool:
        """Whether token b may stand after token a in an encoding: merging their joint text gives them back."""
        if (fit := self._fits.get((a, b))) is None:
            if len(self._fits) > MOST_FITS:
                self._fits.clear()
            fit = self._fits[a, b] = self.merge((self.token[a] if a >= 0 else b"") + self.token[b]) == ([a, b] if a >= 0 else [b])
        return fit

    def encode(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Token ids of each distinct word."""
        out, path, before = {}, [-1], b""
        for word in sorted(set(words)):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del path[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - self.longest), end):
                    t = self.ranks.get(word[start:end])
                    if t is not None and self.follows(path[start], t):
                        path.append(t)
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
            ids, at = [], len(word)
            while at:
                ids.append(path[at])
                at -= len(self.token[path[at]])
            out[word] = ids[::-1]
            before = word
        return out


class Corpus:
    """Texts as rows of a growing table of encoded blank-separated words."""

    def __init__(self, vocabulary: bytes):
        self.encoder = TrieEncoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a})
        self.pattern = regex.compile(PATTERN)
        self.clear()

    def clear(self) -> None:
        self.rows: tuple[dict[str, int], dict[str, int]] = ({}, {})  # words at a text's start, words after a blank
        self.words: dict[bytes, list[int]] = {}
        self.ids, self.offsets, self.names = np.zeros(0, np.int32), np.zeros(1, np.int64), []

    def add(self, heads: set[str], tails: set[str]) -> None:
        new = [(0, h) for h in sorted(heads - self.rows[0].keys())] + [(1, t) for t in sorted(tails - self.rows[1].keys())]
        if not new:
            return
        pieces = [[p.encode("utf-8", "replace") for p in self.pattern.findall(" " * k + w)] for k, w in new]
        self.words |= self.encoder.encode({p for ps in pieces for p in ps if p not in self.words})
        lists = [[i for p in ps for i in self.words[p]] for ps in pieces]
        for (k, w), at in zip(new, range(len(self.names), len(self.names) + len(new))):
            self.rows[k][w] = at
        self.names += [w for _, w in new]
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in lists for i in x), np.int32)])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum([len(x) for x in lists])])

    def rows_of(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word rows of all texts in order, and how many each text has."""
        if len(self.names) > MOST_WORDS:
            self.clear()
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif _MIXED_BLANKS.search(t):
                split.append(_SINGLE_BLANK.split(t))
            else:
                split.append(t.split(" "))
        heads, tails = {p[0] for p in split if p}, set()
        for p in split:
            tails.update(p[1:])
        self.add(heads, tails)
        head, tail = self.rows
        at: list[int] = []
        for p in split:
            if p:
                at.append(head[p[0]])
                at.extend(map(tail.__getitem__, p[1:]))
        return np.array(at, np.int64), np.array([len(p) for p in split], np.int64)

    def lengths(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        ends = np.concatenate([[0], np.cumsum(self.offsets[at + 1] - self.offsets[at])])
        stop = np.cumsum(n)
        return ends[stop] - ends[stop - n]

    def gather(self, at: np.ndarray, n: np.ndarray) -> pa.Array:
        """Token ids of each text."""
        size = self.offsets[at + 1] - self.offsets[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.repeat(self.offsets[at] - (ends - size), size) + np.arange(total)]
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(self.lengths(at, n))]), pa.int32()), pa.array(flat, pa.int32()))


_CORPORA: dict[str, Corpus] = {}


def corpus_of(vocabulary: bytes) -> Corpus:
    """The corpus of this Python worker; words met in earlier tasks stay encoded."""
    name = hashlib.sha256(vocabulary).hexdigest()
    if name not in _CORPORA:
        _CORPORA.clear()
        _CORPORA[name] = Corpus(vocabulary)
    return _CORPORA[name]


def text_blocks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of a batch that hold few enough texts and characters to be worked on together."""
    at, texts = 0, batch.column(column).to_pylist()
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and end - at < TEXTS_AT_ONCE and (end == at or chars + len(texts[end] or "") <= CHARS_AT_ONCE):
            chars += len(texts[end] or "")
            end += 1
        yield batch.slice(at, end - at), texts[at:end]
        at = end


def ship_vocabulary(spark: SparkSession, path: str):
    """The vocabulary file as a broadcast; its size is that of the file, under 1 MB, whatever the corpus."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids array<int>) for every row, without special tokens; their strings are ordinary text.

    NULL and empty texts give an empty list. Repeated rows each give a row; NULL keys stay NULL; an empty table gives
    an empty table. Other columns are not read.
    """
    shipped = ship_vocabulary(df.sparkSession, vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = corpus_of(shipped.value)
        for batch in batches:
            for part, texts in text_blocks(batch, "t"):
                yield pa.RecordBatch.from_arrays([part.column("k"), corpus.gather(*corpus.rows_of(texts))], ["k", "ids"])

    schema = T.StructType([T.StructField("k", df.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.select(df[key].alias("k"), df[text].alias("t")).mapInArrow(encode, schema).withColumnRenamed("k", key)
