"""Problem 1: what changed between consecutive full snapshots.

The key-sorted rows of every snapshot are cut into content-defined chunks: a chunk starts at each key whose hash has
its low bits zero, so an inserted or removed record moves no other cut. Rows travel as keys and digests only; all
snapshots are sorted in the same key ranges, where chunks whose digest the neighbouring snapshot also holds are
discarded at once. Only rows of unmatched chunks are then joined by key to classify the changes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from policymill.runtime import materialize


def _blank_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t != "", t)


def date_text(c: Column) -> Column:
    """`YYYY-MM-DD` and `M/D/YYYY` as ISO text; anything else trimmed as it is; empty is NULL."""
    t = _blank_null(c)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(t, F.lit("yyyy-MM-dd")))
    us = F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(t, F.lit("M/d/yyyy")))
    return F.coalesce(F.date_format(F.coalesce(iso, us), "yyyy-MM-dd"), t)


def snapshot_changes(
    df: DataFrame,
    snapshot: str = "snapshot_date",
    keys: Sequence[str] = ("doc_type", "doc_id", "doc_version"),
    values: Sequence[str] = ("title", "status", "effective_date", "end_date", "keywords"),
    dates: Sequence[str] = ("effective_date", "end_date"),
    loaded: str = "loaded_at",
    chunk_bits: int = 6,
) -> DataFrame:
    """Rows (snapshot, *keys, change_kind) for every snapshot but the first against the one before it.

    Text keys and values are trimmed; empty values are NULL and NULL equals NULL; `dates` compare as dates. Of several
    rows of a key in a snapshot the one with the greatest `loaded` counts (NULL is smallest, then the greatest digest).
    NULL key parts equal each other. Rows without a snapshot date belong to no snapshot. An empty table or a single
    snapshot gives no rows; other columns are not read, whatever their names. Values are compared by digests of 128 bits,
    so they never leave the tasks that read them.
    """
    text = {c for c, kind in df.dtypes if kind == "string"}
    key = [(F.trim(F.col(c)) if c in text else F.col(c)).alias(f"k{i}") for i, c in enumerate(keys)]
    ks = [f"k{i}" for i in range(len(keys))]
    plain = [date_text(F.col(c)) if c in dates else _blank_null(F.col(c)) if c in text else F.col(c) for c in values]
    told = [F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("")).alias(f"t{i}") for i, v in enumerate([*key, *plain])]  # NULL is no text
    rows = df.where(F.col(snapshot).isNotNull()).select(F.col(snapshot).alias("snap"), F.col(loaded).alias("at"), *key, *told)
    signs = [f"t{i}" for i in range(len(told))]
    rows = rows.select("snap", "at", *ks, F.xxhash64(*signs).alias("d1"), F.xxhash64(F.lit(7), *signs).alias("d2"))
    last = rows.groupBy("snap", *ks).agg(F.max(F.struct("at", "d1", "d2")).alias("r"))

    # One row per snapshot.
    snaps = df.where(F.col(snapshot).isNotNull()).select(F.col(snapshot).alias("snap")).distinct()
    snaps = snaps.withColumn("no", F.row_number().over(Window.orderBy("snap")).cast("bigint"))
    snaps = materialize(snaps, "snapshots")
    count = snaps.count()
    mark = F.xxhash64(*ks)
    flat = last.join(F.broadcast(snaps), "snap").select("no", *ks, "r.d1", "r.d2", mark.alias("mark"), (F.pmod(mark, F.lit(1 << chunk_bits)) == 0).alias("cut"))
    # The same key ranges hold for all snapshots, so the chunks to compare are in one task; keys are unique in a snapshot.
    sorted_ = flat.repartitionByRange(*ks).sortWithinPartitions("no", *ks)
    kept = [f"{k} {flat.schema[k].dataType.simpleString()}" for k in ks]
    both = sorted_.mapInArrow(lambda batches: unmatched(batches, count), ", ".join(["no bigint", "later boolean", *kept, "d1 bigint", "d2 bigint"]))
    digest = F.struct("d1", "d2")
    pair = both.groupBy("no", *ks).agg(F.max(F.when(F.col("later"), digest)).alias("new"), F.max(F.when(~F.col("later"), digest)).alias("old"))
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("new") != F.col("old"), "changed")
    out = pair.withColumn("change_kind", kind).where("change_kind is not null").join(F.broadcast(snaps), "no")
    return out.select(F.col("snap").alias(snapshot), *[F.col(k).alias(c) for k, c in zip(ks, keys)], "change_kind")


class _Chunks:
    """The content-defined chunks of one snapshot in a key range: first marks, sizes and digests."""

    def __init__(self, rows: pa.Table):
        self.rows = rows
        mark, cut, d1, d2 = (rows.column(c).to_numpy() for c in ("mark", "cut", "d1", "d2"))
        new = cut.astype(bool)
        new[:1] = True
        start = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        first = np.where(cut[start], mark[start], 0)  # rows before the first cut of the range begin nowhere in particular
        size = np.diff(np.append(start, len(mark)))
        self.digests = list(zip(first.tolist(), size.tolist(), np.bitwise_xor.reduceat(d1, start).tolist(), np.bitwise_xor.reduceat(d2, start).tolist())) if len(start) else []

    def not_in(self, other: _Chunks | None) -> pa.Table:
        """The rows of the chunks that `other` does not hold alike."""
        known = set(other.digests) if other else set()
        alone = np.array([d not in known for d in self.digests], bool)
        return self.rows.filter(pa.array(alone[self.of])) if len(alone) else self.rows


def unmatched(batches: Iterator[pa.RecordBatch], snapshots: int) -> Iterator[pa.RecordBatch]:
    """Rows of chunks that the neighbouring snapshot lacks: (no of the later snapshot, whether the row is in it, keys, digests).

    The rows of a key range come sorted by snapshot and key; two snapshots of the range are held at a time.
    """

    def told(rows: pa.Table, no: int, later: bool) -> Iterator[pa.RecordBatch]:
        own = [pa.array([no] * len(rows), pa.int64()), pa.array([later] * len(rows), pa.bool_())]
        rest = [c for c in rows.column_names if c not in ("no", "mark", "cut")]
        yield from pa.table(own + [rows.column(c) for c in rest], ["no", "later", *rest]).to_batches()

    def by_snapshot() -> Iterator[tuple[int, _Chunks]]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            no = batch.column("no").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(no)) + 1).tolist(), len(no)]
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    if held and held[-1].column("no")[0].as_py() != int(no[a]):
                        yield held[-1].column("no")[0].as_py(), _Chunks(pa.Table.from_batches(held))
                        held = []
                    held.append(batch.slice(a, b - a))
        if held:
            yield held[-1].column("no")[0].as_py(), _Chunks(pa.Table.from_batches(held))

    at, before = 0, None
    for no, now in by_snapshot():
        if before is not None and no > at + 1:  # the range is empty in the snapshot after `at`
            yield from told(before.rows, at + 1, False)
            before = None
        if no > 1:
            yield from told(now.not_in(before), no, True)
            if before is not None:
                yield from told(before.not_in(now), no, False)
        at, before = no, now
    if before is not None and at < snapshots:
        yield from told(before.rows, at + 1, False)
