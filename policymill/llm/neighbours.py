"""Problem 3: the k most similar vectors of every vector, by collision counting on sorted projections.

Each vector is projected on single directions (pivots: sampled vectors, so that directions follow crowded areas) and
indexed in the sorted arrays of the ARRAYS projections on which it stands out most. A query opens a window around its own
value in each of its arrays; another vector collides with it in an array if it lies in that window. Vectors that collide
in COLLISIONS arrays are verified with their true similarity, no others. Windows of a query whose k-th distance is not
within their radius are widened by doubling it (virtual rehashing): projections shrink distances, so windows of radius r
hold all of their arrays within distance r. Arrays are cut into blocks of bounded size; windows are first opened in the
block of the query, and then in all further blocks that its k-th distance reaches, however many. Queries in lonely areas,
whose windows bring nothing near, widen to all rows, read in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from policymill.runtime import materialize

SAMPLE = 8192  # rows the directions are chosen from, whatever the number of vectors; so there are no more directions
ARRAYS = 6  # sorted arrays a vector is indexed in
COLLISIONS = 2
BLOCK = 4096  # rows of an array that are in one group
EDGES = 1024  # most cuts of an array
FIRST_RADIUS = 0.5
TILE, _CELLS = 128, 1 << 20  # queries that are compared together, and most cells of their table
_ROWS = 1024  # vectors that are unpacked at a time
SPREAD = 4  # home blocks whose queries are compared with a further block in one group
LONELY = 0.45  # a k-th similarity below this widens the query to all rows
_APART = 8.0  # between arrays on the joint axis of all sorted arrays of a group, more than windows can reach


def pack(vectors: pa.Array, dim: int) -> tuple[pa.Array, pa.Array]:
    """Usable vectors as bytes (16-bit floats if they hold one exactly, else 32-bit ones) and their digests; NULL for others.

    Usable: not NULL, of `dim` values, all finite, not all zero.
    """
    packed: list[bytes | None] = []
    for at in range(0, len(vectors), _ROWS):
        part = vectors.slice(at, _ROWS)
        sized = part.value_lengths().fill_null(-1).to_numpy() == dim
        x = part.filter(pa.array(sized)).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)  # NULL values are NaN
        good = np.isfinite(x).all(1) & (x != 0).any(1)
        with np.errstate(over="ignore", invalid="ignore"):
            half = x.astype(np.float16)
        exact = (half == x).all(1)
        own: list[bytes | None] = [None] * len(part)
        for i, j in zip(np.flatnonzero(sized)[good].tolist(), np.flatnonzero(good).tolist()):
            own[i] = (half if exact[j] else x)[j].tobytes()
        packed += own
    return pa.array(packed, pa.binary()), pa.array([b and xxhash.xxh3_128_digest(b) for b in packed], pa.binary())


def unit_rows(packed: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors of packed ones."""
    out = np.empty((len(packed), dim), np.float32)
    for at in range(0, len(packed), _ROWS):
        raw = packed.slice(at, _ROWS).to_pylist()
        half = np.fromiter((len(b) == 2 * dim for b in raw), bool, len(raw))
        some = np.empty((len(raw), dim), np.float64)
        for kind, which in ((np.float16, half), (np.float32, ~half)):
            some[which] = np.frombuffer(b"".join(b for b, w in zip(raw, which) if w), kind).reshape(-1, dim)
        out[at : at + _ROWS] = some / np.sqrt(np.einsum("ij,ij->i", some, some))[:, None]
    return out


def _best(sims: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the k greatest (smaller ids first on equal ones), as column numbers and similarities."""
    k = min(k, sims.shape[1])
    floor = -np.partition(-sims, k - 1, axis=1)[:, k - 1]
    cols, vals = np.full((len(sims), k), -1), np.full((len(sims), k), -2.0, np.float32)
    row, col = np.nonzero(sims >= np.maximum(floor, np.float32(-1.5))[:, None])  # ties with the k-th too; -2 is no similarity
    order = np.lexsort((ids[col], -sims[row, col], row))
    row, col = row[order], col[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < k
    cols[row[keep], rank[keep]], vals[row[keep], rank[keep]] = col[keep], sims[row[keep], col[keep]]
    return cols, vals


def _emit(q: np.ndarray, ids: np.ndarray, cols: np.ndarray, vals: np.ndarray) -> pa.Table:
    good = vals > -1.5
    flat = pa.StructArray.from_arrays([pa.array(-vals[good].astype(np.float64)), pa.array(ids[cols[good]], pa.int64())], ["far", "id"])
    offsets = np.concatenate([[0], np.cumsum(good.sum(1))])
    return pa.table({"q": pa.array(q, pa.int64()), "near": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)})


_NEAR = "q bigint, near array<struct<far:double,id:bigint>>"


class _Arrays:
    """The sorted arrays of the held rows of a group, one after another on a joint axis."""

    def __init__(self, array: np.ndarray, value: np.ndarray):
        axis = (array * _APART + value).ravel()
        order = np.argsort(axis, kind="stable")
        self.axis, self.row, self.rows = axis[order], (order // array.shape[1]).astype(np.int32), len(array)

    def spread(self, low: np.ndarray, size: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Cells (query x row) of the stretches of the axis of length `size` from `low`."""
        at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.repeat(query.astype(np.int32) * np.int32(self.rows), size) + self.row[at]

    def sharing(self, array: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Queries x rows: whether a row is in one of the query's arrays that `which` (queries x arrays) marks."""
        query, of = np.nonzero(which)
        centre = array[query, of] * _APART
        low = np.searchsorted(self.axis, centre - _APART / 2)
        out = np.zeros(len(array) * self.rows, bool)
        out[self.spread(low, np.searchsorted(self.axis, centre + _APART / 2) - low, query)] = True
        return out.reshape(len(array), self.rows)

    def collisions(self, array: np.ndarray, value: np.ndarray, which: np.ndarray, inner: float, outer: np.ndarray) -> np.ndarray:
        """Queries x rows: in how many of the marked arrays a row lies in the window of radius `outer`, but not of `inner` (< 0: none)."""
        query, of = np.nonzero(which)
        centre, outer = array[query, of] * _APART + value[query, of], outer[query]
        low, high = np.searchsorted(self.axis, centre - outer), np.searchsorted(self.axis, centre + outer, "right")
        if inner >= 0:
            within, beyond = np.searchsorted(self.axis, centre - inner), np.searchsorted(self.axis, centre + inner, "right")
            low, high, query = np.concatenate([low, beyond]), np.concatenate([within, high]), np.tile(query, 2)
        cells = self.spread(low, high - low, query)
        return np.bincount(cells, minlength=len(array) * self.rows).reshape(len(array), self.rows)


def _search(t: pa.Table, dim: int, k: int) -> pa.Table:
    """Neighbours of the rows that ask among the rows that a group holds.

    `asks` is NaN for rows that don't, 0 for windows that are widened as needed, else the radius of the windows. Two rows
    meet in each array that they share; they are compared in the first of the query's, where it stands out most.
    """
    asks, ids, here = t.column("asks").to_numpy(), t.column("id").to_numpy(), t.column("array")[0].as_py()
    tops = np.frombuffer(b"".join(t.column("tops").to_pylist()), np.float32).reshape(len(t), 2, -1).astype(np.float64)
    array, value = tops[:, 0], tops[:, 1]
    place = (array == here).argmax(1)
    held = np.flatnonzero(t.column("held").to_numpy())
    asked = np.flatnonzero(~np.isnan(asks) & (place <= array.shape[1] - COLLISIONS))
    keys = [np.where(place[asked] > c, array[asked, c], -1) for c in range(array.shape[1] - 1, -1, -1)]
    asked = asked[np.lexsort([*keys, place[asked]])]  # those with the same arrays before this one in a tile
    parts = [_emit(np.zeros(0, np.int64), ids, np.zeros((0, 1), np.int64), np.zeros((0, 1), np.float32))]
    if not len(held):
        return parts[0]
    unit, arrays = unit_rows(t.column("vec").combine_chunks(), dim), _Arrays(array[held], value[held])
    own, order = ids[held], np.arange(array.shape[1])
    width = max(1, min(TILE, _CELLS // len(held)))
    for at in range(0, len(asked), width):
        rows, inner, outer = asked[at : at + width], -1.0, FIRST_RADIUS
        apart = ~arrays.sharing(array[rows], order < place[rows, None]) & (own[None, :] != ids[rows, None])
        met, sims = np.zeros(apart.shape, np.int16), np.full(apart.shape, -2, np.float32)
        seen = np.zeros(len(held), bool)  # rows compared with the tile
        while len(rows):
            given = asks[rows]
            reach = np.where(given > 0, given + 1e-4, outer)  # rounding
            met += arrays.collisions(array[rows], value[rows], order >= place[rows, None], inner, reach).astype(np.int16)
            near = apart & (met >= COLLISIONS)
            new = np.flatnonzero(near.any(0) & ~seen)
            sims[:, new] = unit[rows] @ unit[held[new]].T
            seen[new] = True
            cols = np.flatnonzero(seen)
            best, vals = _best(np.where(near[:, cols], sims[:, cols], np.float32(-2)), own[cols], k) if len(cols) else (np.zeros((len(rows), 1), np.int64), np.full((len(rows), 1), -2.0, np.float32))
            kth = vals[:, -1] if vals.shape[1] >= k else np.full(len(rows), -2.0)
            done = (given > 0) | (np.sqrt(np.maximum(0, 2 - 2 * kth)) <= outer) | (outer >= 2)
            if done.any():
                parts.append(_emit(ids[rows[done]], own[cols] if len(cols) else own[:1], best[done], vals[done]))
                rows, met, sims, apart = rows[~done], met[~done], sims[~done], apart[~done]
            inner, outer = outer, outer * 2
    return pa.concat_tables(parts)


def _merge(near: DataFrame, k: int) -> DataFrame:
    """(q, near) with the k nearest of all lists of q: at most k for each group, so a bounded number; no two name the same row."""
    return near.groupBy("q").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))


def nearest(df: DataFrame, key: str, vector: str, dim: int, k: int = 5) -> DataFrame:
    """(key, rank, neighbour, similarity): the k most similar other rows of every row with a usable vector.

    Similarity is the cosine; on equal similarity the smaller key comes first. Rows with equal vectors are searched
    once and expanded to at most k each. NULL keys and vectors that are NULL, of another size, not finite or all zero
    take no part. Keys must be unique. Tables of fewer than k + 1 usable rows give what there is. Directions are chosen
    from SAMPLE rows; every row is indexed.
    """
    spark = df.sparkSession

    @F.arrow_udf("struct<vec:binary,digest:binary>")
    def packed(vectors: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(pack(vectors, dim), ["vec", "digest"])

    read = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), packed(vector).alias("p"))
    rows = materialize(read.select("id", "p.vec", "p.digest").where("vec is not null"), "vectors")
    # Equal vectors: one representative, the least key; the k + 1 least keys are all that others can need.
    many = rows.groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("digest", "rep")
    members = materialize(rows.select("id", "digest").join(many, "digest").select("rep", "id"), "copies")
    vectors = rows.select("id", "vec").join(members.where("id <> rep"), "id", "left_anti")
    n = vectors.count()
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    if n:
        units = unit_rows(sample.column("vec").combine_chunks(), dim)
    else:
        units = np.zeros((0, dim), np.float32)
    count = max(1, min(len(units), int(2 * math.sqrt(n))))
    pivots = units[:count]
    arrays = min(ARRAYS, count)
    directions = spark.sparkContext.broadcast(pivots)  # at most SAMPLE vectors

    def project(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays in which a vector stands out most, the first foremost, and its values there."""
        a = unit @ directions.value.T
        top = np.argpartition(-a, arrays - 1, axis=1)[:, :arrays]
        value = np.take_along_axis(a, top, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        return np.take_along_axis(top, order, 1), np.take_along_axis(value, order, 1)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch.slice(at, _ROWS)
                yield part, *project(unit_rows(part.column("vec"), dim))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, top, value in projected(batches):
            yield pa.RecordBatch.from_arrays([pa.array(top.ravel(), pa.int32()), pa.array(value.ravel(), pa.float32())], ["array", "value"])

    # Where arrays can be longer than a block, their edges are quantiles over all rows.
    edges: dict[int, np.ndarray] = {}
    share = np.bincount(project(units)[0].ravel(), minlength=count).max() / len(units) if n else 0
    if share * n > BLOCK / 2:
        index = vectors.mapInArrow(values, "array int, value float").groupBy("array")
        at = [i / EDGES for i in range(1, EDGES)]
        index = index.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value", at, 10_000).alias("q")).where(F.col("n") > BLOCK)
        blocks = F.least(F.lit(EDGES), F.ceil(F.col("n") / BLOCK))
        kept = F.transform(F.sequence(F.lit(1), blocks - 1), lambda i: F.get("q", (i * EDGES / blocks).cast("int") - 1))
        edges = {r.array: np.unique(r.kept) for r in index.select("array", kept.alias("kept")).toLocalIterator()}  # a cut for each BLOCK rows
    cuts = spark.sparkContext.broadcast(edges)

    def placed(batches: Iterator[pa.RecordBatch], blocks, held: bool, asking: bool) -> Iterator[pa.RecordBatch]:
        """A row for each array of a vector and each block that `blocks` gives; queries ask with their reach if they have one."""
        none = np.zeros(0)
        for part, top, value in projected(batches):
            tops = [x.tobytes() for x in np.stack([top.astype(np.float32), value.astype(np.float32)], 1)]
            asks = part.column("reach").to_numpy() if "reach" in part.schema.names else np.full(len(part), 0.0 if asking else np.nan)
            who, array, block, home = [], [], [], []
            for c in range(arrays):
                edge = [cuts.value.get(j, none) for j in top[:, c].tolist()] if cuts.value else [none] * len(part)
                at_home = np.array([np.searchsorted(e, v, "right") for e, v in zip(edge, value[:, c].tolist())], np.int32) if cuts.value else np.zeros(len(part), np.int32)
                take, of = blocks(edge, at_home, value[:, c], asks)
                who.append(take)
                array.append(top[take, c])
                block.append(of)
                home.append(at_home[take])
            w = np.concatenate(who)
            vec = part.take(pa.array(w))
            cols = [pa.array(np.concatenate(array), pa.int32()), pa.array(np.concatenate(block).astype(np.int32)), pa.array(np.concatenate(home) // SPREAD), pa.array([held] * len(w), pa.bool_())]
            cols += [pa.array(asks[w]), vec.column("id"), vec.column("vec"), pa.array(tops, pa.binary()).take(pa.array(w))]
            yield pa.RecordBatch.from_arrays(cols, ["array", "block", "part", "held", "asks", "id", "vec", "tops"])

    def at_home(edge, home, value, asks):
        return np.arange(len(home)), home

    def beyond(edge, home, value, asks):
        """Blocks within the k-th distance of a query, but its own."""
        reach = asks + 1e-4  # rounding
        first = np.array([np.searchsorted(e, v, "right") for e, v in zip(edge, (value - reach).tolist())])
        last = np.array([np.searchsorted(e, v, "right") for e, v in zip(edge, (value + reach).tolist())])
        which = [np.r_[a:h, h + 1 : b + 1] for a, h, b in zip(first.tolist(), home.tolist(), last.tolist())]
        return np.repeat(np.arange(len(home)), [len(x) for x in which]), np.concatenate(which)

    shape = "array int, block int, part int, held boolean, asks double, id bigint, vec binary, tops binary"
    indexed = vectors.mapInArrow(lambda batches: placed(batches, at_home, True, True), shape)
    found = indexed.groupBy("array", "block").applyInArrow(lambda t: _search(t, dim, k), _NEAR)
    near = materialize(_merge(found, k), "near")

    kth = -F.get("near", F.lit(k - 1))["far"]
    if edges:  # else every array is held whole
        reach = F.coalesce(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * kth)), F.lit(2.0))
        asked = vectors.join(near.select(F.col("q").alias("id"), reach.alias("reach")), "id")
        asked = materialize(asked.mapInArrow(lambda batches: placed(batches, beyond, False, True), shape), "further")
        held = vectors.mapInArrow(lambda batches: placed(batches, at_home, True, False), shape).drop("part")
        held = held.join(asked.select("array", "block", "part").distinct(), ["array", "block"]).select(*asked.columns)
        more = asked.unionByName(held).groupBy("array", "block", "part").applyInArrow(lambda t: _search(t, dim, k), _NEAR)
        near = materialize(_merge(near.unionByName(more), k), "near-further")
    lone = vectors.join(near.where(F.coalesce(kth, F.lit(-2.0)) >= LONELY).select(F.col("q").alias("id")), "id", "left_anti")
    lone = materialize(lone, "lonely")
    at = lone.inputFiles()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All lonely queries, a slice at a time, against each stretch of rows."""
        for batch in batches:
            ids, unit = batch.column("id").to_numpy(), unit_rows(batch.column("vec"), dim)
            for path in at:
                store, name = pa.fs.FileSystem.from_uri(path)
                for some in ds.dataset(name, filesystem=store, format="parquet").to_batches(batch_size=2048):
                    if len(some):
                        q = some.column("id").to_numpy()
                        sims = unit_rows(some.column("vec"), dim) @ unit.T
                        sims[q[:, None] == ids[None, :]] = -2
                        yield from _emit(q, ids, *_best(sims, ids, k)).to_batches()

    far = _merge(vectors.mapInArrow(scan, _NEAR), k) if at else None
    if far is not None:
        near = near.join(lone.select(F.col("id").alias("q")), "q", "left_anti").unionByName(far)
    return _expand(members, near, k).withColumnRenamed("id", key)


def _expand(members: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """From representatives to all rows: copies come first, then the neighbours' copies. `members` are rows with copies."""
    by_rep = least_ids(members, k + 1)
    # Neighbours of a representative, each with its copies.
    one = near.select("q", F.explode("near").alias("x")).select("q", F.col("x.id").alias("rep"), F.col("x.far").alias("far"))
    one = one.join(by_rep, "rep", "left").select("q", F.explode(F.coalesce("least", F.array("rep"))).alias("id"), "far")
    own = by_rep.select(F.col("rep").alias("q"), F.explode("least").alias("id"), F.lit(-1.0).alias("far"))
    lists = one.unionByName(own).groupBy("q").agg(F.array_sort(F.collect_list(F.struct("far", "id"))).alias("all"))
    copies = members.where("id <> rep").select(F.col("rep").alias("q"), "id").join(lists, "q")
    lists = lists.withColumn("id", F.col("q")).select(*copies.columns).unionByName(copies)
    lists = lists.withColumn("all", F.expr(f"slice(filter(all, x -> x.id <> id), 1, {k})"))
    return lists.select("id", F.posexplode("all").alias("i", "x")).select("id", (F.col("i") + 1).alias("rank"), F.col("x.id").alias("neighbour"), (-F.col("x.far")).alias("similarity"))


def least_ids(members: DataFrame, n: int) -> DataFrame:
    """(rep, least): the n least ids of each representative; salted, so that many copies are no hot group."""
    by = Window.partitionBy("rep", "salt").orderBy("id")
    few = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64))).withColumn("i", F.row_number().over(by)).where(F.col("i") <= n)
    return few.groupBy("rep").agg(F.slice(F.array_sort(F.collect_list("id")), 1, n).alias("least"))


def pairs(near: DataFrame, key: str) -> DataFrame:
    """Distinct pairs (chunk_a, chunk_b), chunk_a < chunk_b."""
    return near.select(F.least(key, "neighbour").alias("chunk_a"), F.greatest(key, "neighbour").alias("chunk_b")).distinct()
