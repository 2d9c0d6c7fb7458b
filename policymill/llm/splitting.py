"""Problem 2: splitting oversized texts at natural boundaries.

A text is cut into ranges. The worker of a range sees it with a halo on either side, finds the natural boundaries in
it and the anchor cut after either edge of the range; neighbouring workers find the same anchor, so ranges need no
exchange. Lengths and piece counts are prefix-summed over the table of ranges, which gives every piece its global
number and offset. Files are read range by range and never loaded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LIMIT, OVERLAP, RANGE = 2000, 200, 1 << 16
# Kinds of boundaries, the best first; each matches at the place of the cut.
KINDS = ("heading", "paragraph", "list", "row", "line", "sentence", "blank", "none")
# They look a bounded way ahead, less than a halo, so that two workers find the same.
_AT = (
    re.compile(r"^(?=#{1,6} )", re.M),
    re.compile(r"\n ?\n(?! ?\n)"),
    re.compile(r"^(?=[ \t]{0,8}(?:[-*•]|\d{1,4}[.)]) )", re.M),
    re.compile(r"^(?=[^\n]{0,190} \| )", re.M),
    re.compile(r"^(?!\Z)", re.M),
    re.compile(r"(?<=[.!?;])\s|(?<=[。！？])"),
    re.compile(r"\s(?!\s)"),
)
_PIECES = "array<struct<start:int,end:int,boundary:string,lead:int,content:string>>"


class Boundaries:
    """Offsets of each kind of boundary in a stretch of text."""

    def __init__(self, text: str):
        flat = text.replace("\r\n", " \n").replace("\r", "\n") if "\r" in text else text  # of the same length
        self.at = [np.array([m.end() for m in p.finditer(flat)], np.int64) for p in _AT]

    def last(self, low: int, high: int) -> tuple[int, int] | None:
        """The best kind with a cut in [low, high], and its last such cut."""
        for kind, at in enumerate(self.at):
            i = np.searchsorted(at, high, "right") - 1
            if i >= 0 and at[i] >= low:
                return kind, int(at[i])
        return None

    def cut(self, start: int, limit: int, least: int) -> tuple[int, int]:
        """Where a piece from `start` ends: in its second half if there is any boundary, else wherever one is."""
        high = start + limit
        return self.last(start + limit // 2, high) or self.last(start + least, high) or (len(KINDS) - 1, high)

    def resume(self, cut: int, overlap: int) -> int:
        """Where the next piece starts: at the first sentence or better in the overlap, else a word, else its far end."""
        low = cut - overlap
        for kinds in (self.at[:6], self.at[6:]):
            found = [int(at[i]) for at in kinds if (i := np.searchsorted(at, low)) < len(at) and at[i] < cut]
            if found:
                return min(found)
        return low


def cut_range(text: str, begin: int, end: int, first: bool, last: bool, limit: int, overlap: int) -> tuple[list[tuple[int, int, int]], int, int]:
    """Pieces (start, end, kind of cut) of the range [begin, end) of `text`, which holds its halos; and its two anchors."""
    seen = Boundaries(text)
    left = begin if first else seen.cut(begin, limit, overlap + 1)[1]
    right = end if last else seen.cut(end, limit, overlap + 1)[1]
    pieces, at = [], left if first else seen.resume(left, overlap)
    while right - at > limit:
        kind, cut = seen.cut(at, limit, overlap + 1)
        pieces.append((at, cut, kind))
        at = seen.resume(cut, overlap)
    pieces.append((at, right, len(KINDS) - 1 if last else seen.cut(end, limit, overlap + 1)[0]))
    return pieces, left, right


def _number(ranges: DataFrame, keys: Sequence[str], several: bool) -> DataFrame:
    """Piece rows of a table of ranges; with `several` of an item, numbers and offsets are prefix sums over its ranges."""
    no, at = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    if several:
        before = Window.partitionBy(*keys).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)  # ranges, not pieces
        no, at = F.coalesce(F.sum(F.size("pieces")).over(before), no), F.coalesce(F.sum("chars").over(before), at)
    both = ranges.withColumns({"base_no": no, "base_at": at}).select(*keys, "base_no", "base_at", F.posexplode("pieces").alias("i", "p"))
    return both.select(
        *keys, (F.col("base_no") + F.col("i")).cast("int").alias("piece_no"), (F.col("base_at") + F.col("p.start")).alias("start"),
        (F.col("base_at") + F.col("p.end")).alias("end"), F.col("p.boundary").alias("boundary"), F.col("p.lead").alias("lead"), F.col("p.content").alias("content"),
    )


def split_texts(df: DataFrame, keys: Sequence[str], text: str, heading: str | None = None, limit: int = LIMIT, overlap: int = OVERLAP, span: int = RANGE) -> DataFrame:
    """Pieces (*keys, piece_no, start, end, boundary, lead, content) of the texts that exceed `limit` characters.

    The size of an item is the length of its text plus, where `heading` is not NULL, that of the heading and 1. Each
    piece repeats the heading and a line break, `lead` characters, before its stretch of text; start and end count in the
    text. A heading that leaves less than a quarter of the limit is not repeated (lead 0): heading, line break and text
    are then split as one text, in which start and end count. Consecutive pieces share 1 to `overlap` characters. NULL,
    empty and fitting texts give no pieces. `keys` must tell items apart: give a unique column where rows repeat. Other
    columns are not read. A text longer than `span` is read through once and its ranges are spread over tasks.
    """
    if not 1 <= overlap < limit // 8 or span < 4 * limit:
        raise ValueError("overlap must be at least 1 and less than an eighth of limit, span at least four limits")
    names = [f"key{i}" for i in range(len(keys))]
    h: Column = F.col(heading) if heading else F.lit(None).cast("string")
    items = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(text).alias("t"), h.alias("h"))
    size = F.length("t") + F.coalesce(F.length("h") + 1, F.lit(0))
    whole = F.coalesce(F.length("h") + 1 <= limit - limit // 4, F.lit(True))  # the heading is repeated
    big = items.where(size > limit).withColumn("t", F.when(whole, F.col("t")).otherwise(F.concat("h", F.lit("\n"), "t"))).withColumn("h", F.when(whole, F.col("h")))
    halo = limit + 2 * overlap
    big = big.withColumn("ranges", F.greatest(F.lit(1), F.ceil(F.length("t") / span)).cast("int"))

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each range of a text, with its halos."""
        for batch in batches:
            for i in range(len(batch)):
                row, value = batch.slice(i, 1), batch.column("t")[i].as_py()
                for no in range(row.column("ranges")[0].as_py()):
                    stretch = value[max(0, no * span - halo) : (no + 1) * span + halo]
                    own = [row.column(c) for c in (*names, "h", "ranges")]
                    yield pa.RecordBatch.from_arrays([*own, pa.array([no], pa.int32()), pa.array([len(value)], pa.int64()), pa.array([stretch])], [*names, "h", "ranges", "range_no", "n", "stretch"])

    kinds = [f"{n} {big.schema[n].dataType.simpleString()}" for n in names]
    long = big.where("ranges > 1").mapInArrow(ranged, ", ".join([*kinds, "h string", "ranges int", "range_no int", "n bigint", "stretch string"]))
    short = big.where("ranges = 1").select(*names, "h", "ranges", F.lit(0).alias("range_no"), F.length("t").cast("bigint").alias("n"), F.col("t").alias("stretch"))

    @F.pandas_udf(f"struct<chars:int,pieces:{_PIECES}>")
    def cut(stretch: pd.Series, h: pd.Series, n: pd.Series, no: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        rows = []
        for s, head, length, k, of in zip(stretch, h, n, no, ranges):
            lead = "" if head is None else head + "\n"
            low = max(0, k * span - halo)
            begin, end = k * span - low, min(length, (k + 1) * span) - low
            pieces, left, right = cut_range(s, begin, end, k == 0, k == of - 1, limit - len(lead), overlap)
            rows.append((right - left, [(a - left, b - left, KINDS[kind], len(lead), lead + s[a:b]) for a, b, kind in pieces]))
        return pd.DataFrame(rows, columns=["chars", "pieces"])

    def pieces(rows: DataFrame, several: bool) -> DataFrame:
        return _number(rows.withColumn("c", cut("stretch", "h", "n", "range_no", "ranges")).select(*names, "range_no", "c.*"), names, several)

    out = pieces(short, False).unionByName(pieces(long.repartition(*names, "range_no"), True))
    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "piece_no", "start", "end", "boundary", "lead", "content")


def split_files(spark: SparkSession, paths: Sequence[str], limit: int = LIMIT, overlap: int = OVERLAP, span: int = 1 << 20) -> DataFrame:
    """Pieces (path, piece_no, start, end, boundary, content) of UTF-8 files, each read in ranges of `span` bytes.

    Offsets count characters. Bytes that are no UTF-8 come out as replacement characters. An empty file gives one
    empty piece. The driver reads file sizes only.
    """
    from pyarrow import fs

    rows = []
    for path in paths:
        store, at = fs.FileSystem.from_uri(path)
        size = store.get_file_info(at).size
        ranges = max(1, -(-size // span))
        rows.append((path, size, ranges))
    halo = 4 * (limit + 2 * overlap)
    listed = spark.createDataFrame(rows, "path string, size bigint, ranges int")
    ranged = listed.withColumn("range_no", F.explode(F.sequence(F.lit(0), F.col("ranges") - 1))).repartition("path", "range_no")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size, of, k in batch[["path", "size", "ranges", "range_no"]].itertuples(index=False):
                store, at = fs.FileSystem.from_uri(path)
                low, high = max(0, k * span - halo), min(size, (k + 1) * span + halo)
                with store.open_input_file(at) as f:
                    raw = f.read_at(high - low, low)
                edges = [k * span - low, min(size, (k + 1) * span) - low]
                for i, e in enumerate(edges):  # an edge inside a character moves to its end, alike for both neighbours
                    while e < len(raw) and raw[e] & 0xC0 == 0x80:
                        e += 1
                    edges[i] = e
                skip = 0
                while low and skip < len(raw) and raw[skip] & 0xC0 == 0x80:
                    skip += 1
                halves = [raw[skip : edges[0]], raw[edges[0] : edges[1]], raw[edges[1] :]]
                a, b, c = (x.decode("utf-8", "replace") for x in halves)
                text = a + b + c
                pieces, left, right = cut_range(text, len(a), len(a) + len(b), k == 0, k == of - 1, limit, overlap)
                row = (path, k, right - left, [(x - left, y - left, KINDS[z], 0, text[x:y]) for x, y, z in pieces])
                yield pd.DataFrame([row], columns=["path", "range_no", "chars", "pieces"])

    table = ranged.mapInPandas(read, f"path string, range_no int, chars int, pieces {_PIECES}")
    return _number(table, ["path"], True).drop("lead")
