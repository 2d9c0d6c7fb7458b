"""Problem 4: rows that fail to parse.

A structural index is built with numpy over the bytes of a whole Arrow batch: positions of quotes and commas, the
parity of the quotes before each comma (which tells delimiters from text), record ends. Field values come out of the
same buffer by one keep-mask. Type checks then run as Spark expressions on the indexed fields.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUOTE, COMMA, RETURN = 34, 44, 13


def structural_index(lines: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Of each record: whether its quoting is broken, and its unquoted fields. NULL records give one empty field."""
    col = pa.array(lines, pa.large_binary()) if not isinstance(lines, pa.Array) else lines.cast(pa.large_binary())
    n = len(col)
    if not n:
        return np.zeros(0, bool), pa.array([], pa.list_(pa.string()))
    col = pa.concat_arrays([col.fill_null(b"")])
    off = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[: off[-1]]
    start, end = off[:-1].copy(), off[1:].copy()
    has = end > start
    cr = np.zeros(n, bool)
    cr[has] = data[end[has] - 1] == RETURN
    end -= cr

    quotes = np.flatnonzero(data == QUOTE)
    q_rec = np.searchsorted(off, quotes, "right") - 1
    first_q = np.searchsorted(quotes, start)
    opens = (np.arange(len(quotes)) - first_q[q_rec]) % 2 == 0
    commas = np.flatnonzero(data == COMMA)
    c_rec = np.searchsorted(off, commas, "right") - 1
    delim = commas[(np.searchsorted(quotes, commas) - first_q[c_rec]) % 2 == 0]
    d_rec = np.searchsorted(off, delim, "right") - 1

    padded = np.concatenate([np.zeros(1, np.uint8), data, np.zeros(1, np.uint8)])
    before, after = padded[quotes], padded[quotes + 2]
    at_start, at_end = quotes == start[q_rec], quotes + 1 == end[q_rec]
    good = np.where(opens, at_start | (before == COMMA) | (before == QUOTE), at_end | (after == COMMA) | (after == QUOTE))
    broken = np.zeros(n, bool)
    np.logical_or.at(broken, q_rec, ~good)
    broken |= np.bincount(q_rec, minlength=n) % 2 == 1

    keep = np.ones(len(data), bool)
    keep[delim] = False
    keep[end[cr]] = False
    keep[quotes[~opens]] = False  # the closing one of a field, or the first of a doubled pair
    keep[quotes[opens & (at_start | (before != QUOTE))]] = False
    kept = np.concatenate([[0], np.cumsum(keep)])
    starts = np.sort(np.concatenate([start, delim + 1]), kind="stable")
    offsets = np.concatenate([kept[starts], kept[-1:]]).astype(np.int64)
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[keep]))])
    per = np.bincount(d_rec, minlength=n) + 1
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), values.cast(pa.binary()))
    return broken, lists


@dataclass(frozen=True)
class Format:
    """Fields of one source table, their types, and which of them are judged: name -> version, id or stamp."""

    fields: Sequence[str]
    types: Mapping[str, str] = field(default_factory=dict)
    judged: Mapping[str, str] = field(default_factory=dict)


FORMATS = {
    "policy_code": Format(
        ("doc_id", "doc_version", "code", "code_version", "group_no", "range_pos", "sort_order", "description", "asterisk", "last_updated"),
        {"doc_id": "int", "doc_version": "int", "code_version": "int", "group_no": "int", "sort_order": "int", "last_updated": "timestamp"},
        {"code_version": "version", "last_updated": "stamp"},
    ),
    "state_lookup": Format(("state_id", "state_abbrev", "description"), {"state_id": "int"}, {"state_id": "id"}),
}

_TIME = r"(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"
_ISO = rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(?:[ T]{_TIME})?$"
_US = rf"^[0-9]{{1,2}}/[0-9]{{1,2}}/(?:[0-9]{{4}}|[0-9]{{2}})(?: {_TIME})?$"


def parse_stamp(c: Column) -> Column:
    """Timestamp of the accepted forms, NULL for any other text; two-digit years from 69 on are 19xx."""
    day = F.regexp_extract(c, r"^[^ T]*", 0)
    short = F.try_to_timestamp(day, F.lit("M/d/yy"))  # 2000 to 2099
    short = F.when(F.year(short) >= 2069, F.add_months(F.to_date(short), -1200).cast("timestamp")).otherwise(short)
    iso, us = c.rlike(_ISO) & ~day.startswith("0000"), c.rlike(_US) & ~day.endswith("/0000")
    at = F.when(iso, F.try_to_timestamp(day, F.lit("yyyy-MM-dd")))
    at = at.when(us & day.rlike(r"/[0-9]{4}$"), F.try_to_timestamp(day, F.lit("M/d/yyyy"))).when(us, short)
    hour, minute, second = (F.substring(c, i, 2).try_cast("int") for i in (-8, -5, -2))
    clock = F.when(F.length(c) > F.length(day), hour * 3600 + minute * 60 + second).otherwise(0)
    return F.timestamp_seconds(F.unix_timestamp(at) + clock)


def _valid(kind: str, c: Column) -> Column:
    if kind == "version":
        return c.rlike(r"^(?:[0-9]{1,4}(?:\.0)?)?$")
    if kind == "id":
        return c.rlike(r"^[0-9]{1,3}$") & ~c.rlike(r"^0+$")
    if kind == "stamp":
        return (c == "") | parse_stamp(c).isNotNull()
    raise ValueError(f"unknown check {kind!r}")


def _typed(kind: str, c: Column) -> Column:
    if kind == "int":
        return F.regexp_replace(c, r"\.0$", "").try_cast("int")
    if kind == "timestamp":
        return parse_stamp(c)
    return F.when(c != "", c)


def judge_records(df: DataFrame, formats: Mapping[str, Format] = FORMATS, line: str = "raw_line", source: str = "source_table") -> DataFrame:
    """`df` with `fields` (trimmed texts, NULL where quoting is broken) and `reason` (NULL for valid records).

    Reasons, the first that applies: `null_record`, `unknown_source`, `broken_quoting`, `field_count`,
    `invalid_<field>`. Empty records have one empty field. An input column named fields or reason is replaced.
    """
    if "fields" in df.columns or "reason" in df.columns:
        df = df.drop("fields", "reason")

    @F.arrow_udf("struct<broken boolean, fields array<string>>")
    def index(lines: pa.Array) -> pa.Array:
        broken, lists = structural_index(lines)
        flat = lists.values.cast(pa.string())
        lists = pa.ListArray.from_arrays(lists.offsets, flat)
        return pa.StructArray.from_arrays([pa.array(broken, pa.bool_()), lists], ["broken", "fields"])

    at = df.withColumn("__i", index(F.col(line)))
    at = at.withColumn("fields", F.transform("__i.fields", lambda x: F.trim(x)))
    n = F.size("fields")
    reason = F.when(F.col(line).isNull(), "null_record").when(~F.coalesce(F.col(source), F.lit("")).isin(*formats), "unknown_source")
    reason = reason.when(F.col("__i.broken"), "broken_quoting")
    for name, f in formats.items():
        reason = reason.when((F.col(source) == name) & (n != len(f.fields)), "field_count")
    for name, f in formats.items():
        for c, kind in f.judged.items():
            x = F.get("fields", F.lit(list(f.fields).index(c)))
            reason = reason.when((F.col(source) == name) & ~_valid(kind, x), f"invalid_{c}")
    at = at.withColumn("reason", reason)
    return at.withColumn("fields", F.when(~F.col("__i.broken") & F.col(line).isNotNull(), F.col("fields"))).drop("__i")


def rejects(df: DataFrame, **options) -> DataFrame:
    """Records that fail, with their reason."""
    return judge_records(df, **options).where("reason is not null").drop("fields")


def valid_rows(df: DataFrame, name: str, carry: Sequence[str] = ("row_id",), **options) -> DataFrame:
    """Typed rows of source table `name`; texts that can't be cast to an unjudged type are NULL."""
    f = options.get("formats", FORMATS)[name]
    ok = judge_records(df.where(F.col(options.get("source", "source_table")) == name), **options).where("reason is null")
    cols = [_typed(f.types.get(c, "string"), F.get("fields", F.lit(i))).alias(c) for i, c in enumerate(f.fields)]
    return ok.select(*carry, *cols)
