"""Problem 6: near-duplicate texts with small edits.

Word shingles are min-hashed to a signature of SYMBOLS small symbols. The signature is split into CHUNKS parts; two
signatures that differ in fewer than (errors + 1) * CHUNKS symbols agree, by pigeonhole, in one part up to `errors`
symbols. Every part is therefore indexed under its neighbourhoods of one error (one symbol left out), and items that
meet under a key are compared by the symbols in which the two low bits differ (b = 2) before a pair is made. Pairs
are then verified with the exact similarity. Groups are the connected components of the verified links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policymill.llm.components import connected
from policymill.runtime import materialize

WORDS = re.compile(r"[^\W_]+")
CHUNKS, PER_CHUNK = 12, 4
SYMBOLS = CHUNKS * PER_CHUNK
SKETCH_DISTANCE = 21
HOT_PART = 16  # hot keys are looked for in one of so many items
BUCKET = 512  # larger buckets are compared in blocks of this size, spread over tasks
_ODD = np.random.default_rng(20240229).integers(0, 1 << 63, (2, SYMBOLS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_HASHES: dict[str, int] = {}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(word: str) -> int:
    if len(_HASHES) > 1_000_000:
        _HASHES.clear()
    h = _HASHES[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
    return h


def shingles(text: str | None, width: int, least_words: int) -> np.ndarray | None:
    """Sorted 64-bit hashes of the different runs of `width` words; None for texts of fewer than `least_words` words."""
    words = WORDS.findall(text.lower()) if text else []
    if len(words) < max(least_words, width):
        return None
    known = _HASHES.get
    w = np.array([known(x) or _hash(x) for x in words], np.uint64)
    run = w[: len(w) - width + 1].copy()
    for i in range(1, width):
        run ^= run >> np.uint64(32)
        run *= _MIX
        run += w[i : len(w) - width + 1 + i]
    run ^= run >> np.uint64(31)
    run *= _MIX
    run ^= run >> np.uint64(32)
    return np.unique(run)


def signature(runs: np.ndarray) -> np.ndarray:
    """SYMBOLS 16-bit symbols: a mixed part of the least hash value under each of SYMBOLS permutations."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(runs), 1 << 14):
            h = runs[at : at + (1 << 14), None] * _ODD[0]
            h += _ODD[1]
            least = np.minimum(least, h.min(0))
        return ((least ^ (least >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)


_OUT = [[j for j in range(PER_CHUNK) if j != i] for i in range(PER_CHUNK)]


def block_keys(sigs: np.ndarray) -> np.ndarray:
    """Of each signature the keys of all one-error neighbourhoods of all parts."""
    parts = sigs.reshape(-1, CHUNKS, PER_CHUNK)
    left = np.stack([parts[:, :, o] for o in _OUT], 2)  # item, part, symbol left out, the others
    where = np.arange(CHUNKS * PER_CHUNK, dtype=np.uint64).reshape(CHUNKS, PER_CHUNK) << np.uint64(48)
    keys = where | (left[..., 0] << np.uint64(32)) | (left[..., 1] << np.uint64(16)) | left[..., 2]
    return keys.reshape(-1).view(np.int64)


def sketches(sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two low bits of each symbol, as two planes."""
    at, one = np.arange(SYMBOLS, dtype=np.uint64), np.uint64(1)
    return ((sigs & one) << at).sum(1).view(np.int64), ((sigs >> one & one) << at).sum(1).view(np.int64)


def apart(x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray) -> np.ndarray:
    """In how many symbols two sketches differ."""
    return np.bitwise_count((x0 ^ y0) | (x1 ^ y1))


def _keyed(df: DataFrame, width: int, least_words: int) -> DataFrame:
    """(g, id, digest, keys, s0, s1) of items with enough words; texts with the same runs have the same digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, digests, sigs = [], [], []
            for i, text in enumerate(batch.column("t").to_pylist()):
                runs = shingles(text, width, least_words)
                if runs is not None:
                    keep.append(i)
                    digests.append(xxhash.xxh3_128_digest(runs))
                    sigs.append(signature(runs))
            all_ = np.stack(sigs) if sigs else np.zeros((0, SYMBOLS), np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1) * SYMBOLS, pa.int32()), pa.array(block_keys(all_)))
            some = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column("g"), some.column("id"), pa.array(digests, pa.binary()), lists, *map(pa.array, sketches(all_))], ["g", "id", "digest", "keys", "s0", "s1"])

    return df.select("g", "id", "t").mapInArrow(run, "g string, id bigint, digest binary, keys array<bigint>, s0 bigint, s1 bigint")


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs under the sketch distance among rows sorted by (key, g); rows of large buckets are passed on with b NULL.

    A bucket that has been passed on in part is passed on whole, however few of its rows are left.
    """
    begun: tuple[str, int] | None = None  # the bucket (g, key) passed on in part

    def pairs(g: np.ndarray, key: np.ndarray, s0: np.ndarray, s1: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a stretch of whole buckets: pair ends, and which rows are in large buckets."""
        n = len(key)
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (g[1:] != g[:-1])]) if n else np.zeros(0, bool)
        start = np.flatnonzero(new)
        size = np.diff(np.concatenate([start, [n]]))
        hot = np.repeat(size > BUCKET, size) | rest
        left = np.repeat(start + size, size) - np.arange(n) - 1  # rows of the bucket after this one
        left[hot] = 0
        a_all, b_all, step, at = [], [], 1, np.flatnonzero(left >= 1)
        while len(at):
            near = at[apart(s0[at], s1[at], s0[at + step], s1[at + step]) <= SKETCH_DISTANCE]
            a_all.append(near)
            b_all.append(near + step)
            step += 1
            at = at[left[at] >= step]
        return (np.concatenate(a_all) if a_all else np.zeros(0, np.int64)), (np.concatenate(b_all) if b_all else np.zeros(0, np.int64)), hot

    def out(table: pa.Table, whole: int) -> pa.RecordBatch:
        names = pa.concat_arrays(table.column("g").chunks)
        g = names.dictionary_encode().indices.to_numpy(zero_copy_only=False)[:whole]
        key, rep, s0, s1 = (table.column(c).to_numpy()[:whole] for c in ("key", "rep", "s0", "s1"))
        rest = np.zeros(whole, bool)
        if begun:
            rest = pc.equal(names[:whole], begun[0]).to_numpy(zero_copy_only=False) & (key == begun[1])
        a, b, hot = pairs(g, key, s0, s1, rest)
        rest = np.flatnonzero(hot)
        rows = np.concatenate([a, rest])
        lo, hi = np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])
        different = np.concatenate([lo != hi, np.ones(len(rest), bool)])
        none = pa.nulls(len(a), pa.int64())
        kept = [pa.concat_arrays([none, pa.array(x[rest], pa.int64())]) for x in (key, s0, s1)]
        ends = pa.concat_arrays([pa.array(hi, pa.int64()), pa.nulls(len(rest), pa.int64())])
        got = pa.RecordBatch.from_arrays([names.take(pa.array(rows)), pa.array(np.concatenate([lo, rep[rest]])), ends, *kept], ["g", "a", "b", "key", "s0", "s1"])
        return got.filter(pa.array(different))

    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        if len(held) > 4 * BUCKET:
            key = held.column("key").to_numpy()
            whole = int(np.searchsorted(key, key[-1]))
            if whole == 0 and len(held) > 16 * BUCKET:  # one large bucket fills all that is held; pass most of it on
                whole = len(held) - 2 * BUCKET
                begun = (held.column("g")[whole - 1].as_py(), int(key[whole - 1]))
            if whole:
                yield out(held, whole)
                held = held.slice(whole)
    if held is not None and len(held):
        yield out(held, len(held))


def _blocks(hot: DataFrame) -> DataFrame:
    """Pairs in large buckets: every two blocks of a bucket meet in one group, compared by their sketches."""
    n = hot.groupBy("g", "key").agg(F.ceil(F.count(F.lit(1)) / BUCKET).cast("int").alias("blocks"))
    at = hot.join(n, ["g", "key"]).withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    at = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    at = at.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = pdf[pdf.block == pdf.lo], pdf[pdf.block == pdf.hi]
        x0, x1, y0, y1 = one.s0.to_numpy(), one.s1.to_numpy(), two.s0.to_numpy(), two.s1.to_numpy()
        i, j = np.nonzero(apart(x0[:, None], x1[:, None], y0[None, :], y1[None, :]) <= SKETCH_DISTANCE)
        a, b = one.a.to_numpy()[i], two.a.to_numpy()[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        keep = lo != hi
        return pd.DataFrame({"g": key[0], "a": lo[keep], "b": hi[keep]}).drop_duplicates()

    # A block holds about BUCKET rows, so a group holds about twice as many.
    return at.groupBy("g", "key", "lo", "hi").applyInPandas(compare, "g string, a bigint, b bigint")


def candidate_pairs(reps: DataFrame) -> DataFrame:
    """Distinct pairs (g, a, b) of representatives that meet under a key and pass the sketch distance."""
    keyed = reps.select("g", "rep", "s0", "s1", F.explode("keys").alias("key"))
    # Keys seen often in a part of the items are passed by the shuffle that brings equal keys together. This decides the
    # way of their rows only: a large bucket that is not seen here is passed on by _meet.
    part = keyed.where(F.pmod(F.xxhash64("rep"), F.lit(HOT_PART)) == 0)
    often = part.groupBy("g", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2 * BUCKET // HOT_PART)
    often = materialize(often.select("g", "key", F.lit(True).alias("hot")), "near-hot")
    marked = keyed.join(often, ["g", "key"], "left")
    hot = marked.where("hot").select("g", F.col("rep").alias("a"), F.lit(None).cast("bigint").alias("b"), "key", "s0", "s1")
    keyed = marked.where("hot is null")
    met = keyed.repartition("key").sortWithinPartitions("key", "g").select("g", "rep", "s0", "s1", "key")
    met = met.mapInArrow(_meet, "g string, a bigint, b bigint, key bigint, s0 bigint, s1 bigint").unionByName(hot)
    met = materialize(met, "near-met")
    small = met.where("b is not null").select("g", "a", "b")
    return small.unionByName(_blocks(met.where("b is null"))).distinct()


def verified_links(items: DataFrame, pairs: DataFrame, width: int, least_words: int, threshold: float) -> DataFrame:
    """The pairs (g, a, b) whose exact similarity reaches the threshold."""
    wanted = pairs.select("g", F.col("a").alias("id")).unionByName(pairs.select("g", F.col("b").alias("id"))).distinct()

    @F.arrow_udf("array<bigint>")
    def runs(texts: pa.Array) -> pa.Array:
        got = [shingles(t, width, least_words).view(np.int64) for t in texts.to_pylist()]
        return pa.array(got, pa.list_(pa.int64()))

    texts = items.join(wanted, ["g", "id"], "left_semi").select("g", "id", runs("t").alias("r"))

    @F.arrow_udf("boolean")
    def similar(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for i in range(len(x)):
            p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
            both = len(p) + len(q) - len(np.union1d(p, q))
            out.append(both >= threshold * (len(p) + len(q) - both) - 1e-9)
        return pa.array(out, pa.bool_())

    joined = pairs.join(texts.select("g", F.col("id").alias("a"), F.col("r").alias("ra")), ["g", "a"])
    joined = joined.join(texts.select("g", F.col("id").alias("b"), F.col("r").alias("rb")), ["g", "b"])
    return joined.where(similar("ra", "rb")).select("g", "a", "b")


def near_duplicate_groups(df: DataFrame, key: str, text: str, table: str | None = None, width: int = 5, threshold: float = 0.8, least_words: int = 0) -> DataFrame:
    """(table, key, group_id, copies_of, links) of every item with enough words.

    Items are similar if the share of different runs of `width` words in both among those in either reaches
    `threshold`; similar items, and items linked through others, are in one group, whose id is the least key in it.
    Items of different `table` values are not compared. `copies_of` is the least key with the same set of runs, `links`
    the number of other such sets similar to it. NULL and empty texts, and those of fewer than `least_words` or
    `width` words, are in no group and give no row. Keys must tell the items of a table apart; NULL keys are left out.
    A pair is found if fewer than 24 of its 48 symbols differ and fewer than 22 in their two low bits: at a similarity of
    0.7 with a chance above 0.99, which grows with the similarity.
    """
    g = F.col(table).cast("string") if table else F.lit("")
    items = df.where(F.col(key).isNotNull()).select(F.coalesce(g, F.lit("")).alias("g"), F.col(key).cast("bigint").alias("id"), F.col(text).alias("t"))
    keyed = materialize(_keyed(items, width, least_words), "near-keyed")
    digests = keyed.groupBy("g", "digest").agg(F.min("id").alias("rep"))
    members = keyed.select("g", "digest", "id").join(digests, ["g", "digest"]).select("g", "id", "rep")
    reps = keyed.join(digests.select("g", F.col("rep").alias("id"), F.col("rep")), ["g", "id"])
    links = materialize(verified_links(items, candidate_pairs(reps), width, least_words, threshold), "near-links")
    groups = connected(links, "g", "a", "b")
    degree = links.select("g", F.col("a").alias("rep")).unionByName(links.select("g", F.col("b").alias("rep"))).groupBy("g", "rep").agg(F.count(F.lit(1)).alias("links"))
    known = groups.withColumnRenamed("node", "rep").join(degree, ["g", "rep"])
    out = members.join(known, ["g", "rep"], "left")
    return out.select(
        F.col("g").alias(table or "item_table"), F.col("id").alias(key), F.coalesce("component", "rep").alias("group_id"), F.col("rep").alias("copies_of"), F.coalesce("links", F.lit(0)).alias("links")
    )


def group_pairs(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All pairs (item_table, id_a, id_b), id_a < id_b, within a group; the size of the result is asked for."""
    t, k = keys
    m = groups.select(F.col(t).alias("item_table"), F.col("group_id"), F.col(k).alias("id"))
    size = m.groupBy("item_table", "group_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("item_table", "group_id")
    m = m.join(size, ["item_table", "group_id"])
    a, b = m.withColumnRenamed("id", "id_a"), m.withColumnRenamed("id", "id_b")
    return a.join(b, ["item_table", "group_id"]).where("id_a < id_b").select("item_table", "id_a", "id_b")
