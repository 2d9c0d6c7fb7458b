"""Loaders from text tables, each described by a specification: typed columns, key, references, repeats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policymill.functions import values
from policymill.operators import tables


@dataclass(frozen=True)
class Spec:
    """How one table is loaded.

    `columns`: name -> expression over the source. `key`: unique afterwards. `order`: source order as expressions over
    the typed columns, the first row of it stays (descending for last-wins). `required`: rows with NULL there are
    skipped. `drop_unknown`, `null_unknown`: parent name -> the columns that must occur in it, or become NULL.
    """

    columns: Mapping[str, Column]
    key: Sequence[str]
    order: Sequence[Column]
    required: Sequence[str] = ()
    drop_unknown: Mapping[str, Sequence[str]] = field(default_factory=dict)
    null_unknown: Mapping[str, str] = field(default_factory=dict)


def _judged(df: DataFrame, spec: Spec, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Typed rows with `__skip`, the first reason to skip a row (NULL for rows that stay)."""
    out = df.select(*[e.alias(n) for n, e in spec.columns.items()])
    reason = F.lit(None).cast("string")
    for name in reversed(list(spec.drop_unknown)):
        cols, flag = list(spec.drop_unknown[name]), f"__in_{name}"
        known = parents[name].select(*[F.col(c).alias(f"__{name}_{c}") for c in cols]).dropna().distinct().withColumn(flag, F.lit(True))
        on = [F.col(c) == F.col(f"__{name}_{c}") for c in cols]
        out = out.join(known, on, "left").drop(*[f"__{name}_{c}" for c in cols])
        reason = F.when(F.col(flag).isNull(), f"unknown {name}").otherwise(reason)
    for c in reversed(list(spec.required)):
        reason = F.when(F.col(c).isNull(), f"no {c}").otherwise(reason)
    return out.select(*spec.columns, reason.alias("__skip"))


def load(df: DataFrame, spec: Spec, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The loaded rows: typed, with required values and known references, one row a key.

    Repeated keys follow `order`; NULL parts of a key equal each other; an empty source gives an empty table.
    """
    parents = parents or {}
    out = tables.keep_one(_judged(df, spec, parents).where("__skip is null").drop("__skip"), spec.key, spec.order)
    for name, column in spec.null_unknown.items():
        out = tables.null_unknown(out, parents[name], column)
    return out


def skipped(df: DataFrame, spec: Spec, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(reason, rows) of the rows that `load` skips, repeats not counted."""
    return _judged(df, spec, parents or {}).where("__skip is not null").groupBy(F.col("__skip").alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def family(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Tables of one family under each other, their name in column `tag`."""
    return tables.union_all([f.withColumn(tag, F.lit(n)) for n, f in frames.items()])


def unpivot_ids(df: DataFrame, keep: Sequence[str], ids: Mapping[str, str], kind: str = "to_type", value: str = "to_id") -> DataFrame:
    """One row for each id column that names something; NULL and 0 name nothing. `ids`: column -> kind."""
    pairs = F.array(*[F.struct(F.lit(k).alias(kind), F.col(c).cast("bigint").alias(value)) for c, k in ids.items()])
    return df.select(*keep, F.inline(pairs)).where(F.col(value) != 0)


def surrogate(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """A key column that depends on the natural key alone."""
    return df.withColumn(name, F.xxhash64(*key))


def mark_latest(df: DataFrame, key: Sequence[str] = ("doc_type", "doc_id"), version: str = "doc_version") -> DataFrame:
    """The rows with the greatest version of their key marked in `is_latest`."""
    return tables.mark_greatest(df, key, version, "is_latest")


def document_headers(df: DataFrame) -> DataFrame:
    """Document headers from delivered texts: trimmed, typed, of repeated keys the last delivery, the newest version marked."""
    spec = Spec(
        columns={
            "doc_type": values.clean(F.col("doc_type")), "doc_id": F.col("doc_id"), "doc_version": F.col("doc_version"),
            "title": F.coalesce(values.clean(F.col("title")), F.lit("(untitled)")), "status": values.clean(F.col("status")),
            "effective_date": values.day(F.col("effective_date")), "end_date": values.day(F.col("end_date")),
            "keywords": values.clean(F.col("keywords")), "loaded_at": F.col("loaded_at"),
        },
        key=("doc_type", "doc_id", "doc_version"), order=(F.desc("loaded_at"), F.asc("title"), F.asc("status"), F.asc("effective_date"), F.asc("end_date"), F.asc("keywords")), required=("doc_type", "doc_id", "doc_version"),
    )
    return mark_latest(load(df, spec))


def jurisdictions(links: DataFrame, primary: DataFrame, held: DataFrame, as_of: str) -> DataFrame:
    """(doc_pk, state_id): where documents apply.

    `links` (doc_pk, contractor_id), `primary` (doc_pk, state_id), `held` (contractor_id, state_id, term_date). With one
    contractor at most, the primary states; with more, the states that the contractors hold on the day (no end, or an
    end from the day on); documents still without a state take the latter too. Repeated links count once.
    """
    links = links.select("doc_pk", "contractor_id").dropna().distinct()
    count = links.groupBy("doc_pk").agg(F.count(F.lit(1)).alias("n"))
    open_ = held.where(F.col("term_date").isNull() | (F.col("term_date") >= F.lit(as_of).cast("date"))).select("contractor_id", "state_id").dropna().distinct()
    own = primary.select("doc_pk", "state_id").dropna().distinct().join(count.where("n > 1"), "doc_pk", "left_anti")
    by_holder = links.join(open_, "contractor_id").select("doc_pk", "state_id").distinct()
    return own.unionByName(by_holder.join(own.select("doc_pk").distinct(), "doc_pk", "left_anti"))
