"""Problem 8: filling containers of fixed capacity with documents.

Documents are hashed to vectors (a signed random direction for each word), which are projected to four dimensions;
their Hilbert key orders them along a space-filling curve. The curve is range-sorted over the cluster, and each range
packs its neighbouring documents window by window: best fit, the largest first, into containers begun in the window or
in the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policymill.llm.tokenizer import VOCABULARY, Corpus, corpus_of, ship_vocabulary, text_blocks
from policymill.runtime import materialize

DIMENSIONS, BITS = 4, 8
WINDOW, CARRY = 512, 1  # documents along the curve that are packed together, and further such windows a container waits for
RANGE_ROWS, MOST_RANGE_ROWS = 4000, 200_000


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of each point (rows of non-negative integers below 2**bits) along the Hilbert curve."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for d in range(dims):
            turned = (x[d] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[d] ^= swap
        q >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    fold, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        fold ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= fold
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


class _Directions:
    """Projected direction of every word row of a corpus, filled as the corpus grows."""

    def __init__(self) -> None:
        self.rows = np.zeros((0, DIMENSIONS), np.float32)

    def upto(self, corpus: Corpus) -> np.ndarray:
        if len(corpus.names) < len(self.rows):
            self.rows = self.rows[:0]
        new = corpus.names[len(self.rows) :]
        if new:
            seeds = np.array([xxhash.xxh64_intdigest(w.strip(".,;:()\n").lower().encode("utf-8", "replace")) for w in new], np.uint64)
            lanes = [((seeds >> np.uint64(16 * d)) & np.uint64(0xFFFF)).astype(np.float32) / 32768 - 1 for d in range(DIMENSIONS)]
            self.rows = np.concatenate([self.rows, np.stack(lanes, 1).astype(np.float32)])
        return self.rows


def curve_sizes(df: DataFrame, key: str, text: str, vocabulary: str) -> DataFrame:
    """(key, tokens, curve) of every document."""
    shipped = ship_vocabulary(df.sparkSession, vocabulary)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, directions = corpus_of(shipped.value), _Directions()
        for batch in batches:
            for part, texts in text_blocks(batch, "t"):
                at, n = corpus.rows_of(texts)
                sums = np.concatenate([np.zeros((1, DIMENSIONS)), np.cumsum(directions.upto(corpus)[at], 0, dtype=np.float64)])
                stop = np.cumsum(n)
                v = (sums[stop] - sums[stop - n]) / np.sqrt(np.maximum(n, 1))[:, None]
                cells = np.clip((np.tanh(v / 3) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(corpus.lengths(at, n)), pa.array(hilbert_key(cells))], ["k", "tokens", "curve"])

    got = df.select(df[key].cast("bigint").alias("k"), df[text].alias("t"))
    return got.mapInArrow(measure, "k bigint, tokens bigint, curve bigint")


class _Packer:
    """Open containers near the current place on the curve, found by their free space.

    A container stays open while the window in which it was begun and `carry` more are packed, so its documents are
    neighbours on the curve, and no more of them are held than two such stretches of documents can fill.
    """

    def __init__(self, capacity: int, first: int, carry: int):
        self.capacity, self.next, self.carry = capacity, first, carry
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0  # bit s is set where containers with s free tokens are open
        self.begun: dict[int, int] = {}  # window in which an open container was begun
        self.window = 0

    def place(self, tokens: int) -> int:
        fit = self.spaces >> tokens
        if fit:
            space = tokens + (fit & -fit).bit_length() - 1
            box = self.open[space].pop()
            if not self.open[space]:
                self.spaces ^= 1 << space
        else:
            space, box = self.capacity, self.next
            self.begun[box] = self.window
            self.next += 1
        if left := space - tokens:
            self.open[left].append(box)
            self.spaces |= 1 << left
        else:
            del self.begun[box]
        return box

    def pack(self, tokens: np.ndarray) -> np.ndarray:
        """Containers of a window's documents, the largest placed first; then containers that are too old are closed."""
        boxes = np.zeros(len(tokens), np.int64)
        for i in np.argsort(-tokens, kind="stable").tolist():
            boxes[i] = self.place(int(tokens[i]))
        old = {x for x, w in self.begun.items() if w <= self.window - self.carry}
        if old:
            for space in range(self.capacity + 1):
                if self.spaces >> space & 1:
                    self.open[space] = [x for x in self.open[space] if x not in old]
                    self.spaces ^= (not self.open[space]) << space
            for x in old:
                del self.begun[x]
        self.window += 1
        return boxes


def fill_containers(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (key, piece, first_token, tokens, place, container_id): every token of every document in exactly one container.

    A document longer than `capacity` fills containers of its own and its rest is packed like a document; no other is
    split. `place` is the position along the curve within a range; ranges are container_id div 2**40. Documents without tokens (NULL, empty) are left out. Repeated rows are packed once each. Documents with
    the same curve key are told apart by `key` and spread over ranges, so copies can't make a range hot.
    """
    sizes = materialize(curve_sizes(df, key, text, vocabulary).where("tokens > 0"), "curve-sizes")
    pieces = sizes.withColumn("piece", F.explode(F.sequence(F.lit(0), F.expr(f"cast((tokens - 1) div {capacity} as int)"))))
    pieces = pieces.withColumn("first_token", F.col("piece").cast("bigint") * capacity)
    pieces = pieces.withColumn("tokens", F.least(F.lit(capacity).cast("bigint"), F.col("tokens") - F.col("first_token")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, done = _Packer(capacity, TaskContext.get().partitionId() << 40, CARRY), 0

        def packed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal done
            tokens = rows.column("tokens").to_numpy()
            boxes = [packer.pack(tokens[at : at + WINDOW]) for at in range(0, len(tokens), WINDOW)]
            places = np.arange(done, done + len(tokens))
            done += len(tokens)
            yield from rows.append_column("place", pa.array(places)).append_column("container_id", pa.array(np.concatenate(boxes))).combine_chunks().to_batches()

        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            whole = len(rows) // WINDOW * WINDOW
            if whole:
                yield from packed(rows.slice(0, whole))
            rest = rows.slice(whole)
        if rest is not None and len(rest):
            yield from packed(rest)

    # Every range ends with containers that its neighbour can't fill, so ranges hold at least RANGE_ROWS pieces.
    n = pieces.count()
    ranges = max(1, min(n // RANGE_ROWS, max(4 * df.sparkSession.sparkContext.defaultParallelism, n // MOST_RANGE_ROWS)))
    along = pieces.repartitionByRange(ranges, "curve", "k", "piece").sortWithinPartitions("curve", "k", "piece").select("k", "piece", "first_token", "tokens")
    packed = along.mapInArrow(pack, "k bigint, piece int, first_token bigint, tokens bigint, place bigint, container_id bigint")
    return packed.withColumnRenamed("k", key)


def fill_report(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: containers, tokens, unused tokens and their share, and the median share of the curve that a container spans."""
    per = packed.groupBy("container_id").agg(F.sum("tokens").alias("used"), F.count(F.lit(1)).alias("pieces"), (F.max("place") - F.min("place")).alias("span"))
    total = per.agg(F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("used"), F.lit(0)).alias("tokens"), F.sum("pieces").alias("pieces"), F.percentile_approx("span", 0.5, 100_000).alias("span"))
    unused = F.col("containers") * capacity - F.col("tokens")
    total = total.withColumn("unused", unused).withColumn("unused_share", F.when(F.col("containers") > 0, unused / (F.col("containers") * capacity)))
    return total.withColumn("spread", F.col("span") / F.col("pieces")).drop("pieces", "span")
