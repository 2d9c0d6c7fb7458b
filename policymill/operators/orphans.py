"""Problem 5: references to records that do not exist.

State is kept by parent key: the parent records so far (the parent index) and every reference with whether its parent was
missing on arrival and whether it waits now. A batch of new references and parent records advances it: new references
probe the index as of their own load time; an arriving parent resolves what waits on its key, a deletion reopens it, and
one that comes late corrects what was found before. Only references of keys that the batch touches are looked at again.
Open counts are taken at the end of each month.

Work is sliced by key and month, and a slice with many references is spread over salts, so a key that holds a third of
all references is many groups; only one carried-in parent record per key and month passes between slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from policymill.operators.tables import union_all
from policymill.runtime import materialize

SLICE_ROWS = 100_000  # references of a key and month that stay in one group
PARENT = "parent_table string, key string, at timestamp, seq bigint, ok boolean"
REFERENCE = "ref_table string, parent_table string, ref_id bigint, key string, at timestamp, missing boolean, waits boolean"
_KEY = ["parent_table", "key"]
_SEEN = ["ref_table", "parent_table", "ref_id", "key", "at"]
_RECORD = "struct<at timestamp,seq bigint,ok boolean>"


def key_text(cols: Sequence[str]) -> Column:
    """One text for a compound key; NULL if any part is, as such a key equals none."""
    return F.concat(*[x for i, c in enumerate(cols) for x in ([F.lit("|")] * (i > 0) + [F.col(c).cast("string")])])


def references(df: DataFrame, ref_table: str, parent_table: str, ref_id: str, key: Sequence[str], at: str, required: str) -> DataFrame:
    """The reference log of a table: rows whose column `required` is not NULL."""
    return df.where(F.col(required).isNotNull()).select(
        F.lit(ref_table).alias("ref_table"), F.lit(parent_table).alias("parent_table"), F.col(ref_id).cast("bigint").alias("ref_id"),
        key_text(key).alias("key"), F.col(at).cast("timestamp").alias("at"),
    )


def parents(df: DataFrame, parent_table: str, seq: str, key: Sequence[str], at: str, deleted: Column) -> DataFrame:
    """The parent log of a table; `deleted` tells which records end their key. Records without key or time are none."""
    return df.select(
        F.lit(parent_table).alias("parent_table"), key_text(key).alias("key"), F.col(at).cast("timestamp").alias("at"),
        F.col(seq).cast("bigint").alias("seq"), (~F.coalesce(deleted, F.lit(False))).alias("ok"),
    ).where("key is not null and at is not null")


@dataclass
class OrphanState:
    """All parent records, and all references with whether they were missing their parent on arrival and wait for it now."""

    parents: DataFrame
    refs: DataFrame

    @classmethod
    def empty(cls, spark) -> OrphanState:
        return cls(spark.createDataFrame([], PARENT), spark.createDataFrame([], REFERENCE))


@dataclass
class Advance:
    """What a batch brings; each frame is made when it is asked for.

    state: after it. found: references that miss their parent as of their load time. withdrawn: such ones of earlier
    batches for which a parent has now come that was loaded in time. changes: references of earlier batches that were
    `resolved` or `reopened` (kind), with the load time of the parent record that did it (since). deltas: changes of
    the open counts by month.
    """

    before: OrphanState
    parent_log: DataFrame
    held: DataFrame  # earlier parent records of the keys that are looked at
    judged: DataFrame

    @cached_property
    def state(self) -> OrphanState:
        touched = self.parent_log.select(*_KEY).distinct()
        rest = self.before.refs.join(touched, _KEY, "left_anti")
        return OrphanState(self.before.parents.unionByName(self.parent_log), rest.unionByName(self.judged.select(*rest.columns)))

    @cached_property
    def found(self) -> DataFrame:
        return self.judged.where("missing and not coalesce(was_missing, false)").select(*_SEEN)

    @cached_property
    def withdrawn(self) -> DataFrame:
        return self.judged.where("was_missing and not missing").select(*_SEEN)

    @cached_property
    def changes(self) -> DataFrame:
        kind = F.when(F.col("did_wait"), "resolved").otherwise("reopened")
        return self.judged.where("did_wait is not null and did_wait <> waits").select(*_SEEN, "since", kind.alias("kind"))

    @cached_property
    def deltas(self) -> DataFrame:
        again = self.judged.where("did_wait is not null")
        out = union_all([_monthly(self.judged, self.held.unionByName(self.parent_log)), _monthly(again, self.held, -1)])
        return out.groupBy("ref_table", "month").agg(F.sum("delta").alias("delta"))


def _month(at: str = "at") -> Column:
    return F.date_trunc("month", F.col(at))


def _record() -> Column:
    return F.struct("at", "seq", "ok").alias("p")


def _judge(refs: DataFrame, history: DataFrame, slice_rows: int) -> DataFrame:
    """`refs` with `missing` (no valid parent at their load time), `waits` (none now) and `since` (the last parent record)."""
    placed = refs.where("key is not null and at is not null").withColumn("month", _month())
    lost = refs.where("key is null or at is null")
    sizes = placed.groupBy(*_KEY, "month").agg(F.count(F.lit(1)).alias("n"))
    by_month = history.groupBy(*_KEY, _month().alias("month")).agg(F.max(_record()).alias("p"))
    slices = by_month.unionByName(sizes.select(*_KEY, "month", F.lit(None).cast(_RECORD).alias("p"))).groupBy(*_KEY, "month").agg(F.max("p").alias("p"))
    before = Window.partitionBy(*_KEY).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)  # months of a key, not its rows
    carried = slices.withColumn("c", F.last("p", ignorenulls=True).over(before)).where("c is not null").select(*_KEY, "month", "c.*")

    large = sizes.where(F.col("n") > slice_rows).select(*_KEY, "month", F.ceil(F.col("n") / slice_rows).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    arriving = history.withColumn("month", _month()).unionByName(carried).join(large, [*_KEY, "month"], "left")
    arriving = arriving.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).withColumn("kind", F.lit(0)).drop("salts")
    probing = placed.join(large, [*_KEY, "month"], "left").withColumn("salt", F.pmod(F.xxhash64("ref_table", "ref_id"), salts).cast("int"))
    probing = probing.withColumn("kind", F.lit(1)).drop("salts")
    upto = Window.partitionBy(*_KEY, "month", "salt").orderBy("at", "kind", "seq").rowsBetween(Window.unboundedPreceding, 0)
    both = arriving.unionByName(probing, allowMissingColumns=True)
    probed = both.withColumn("then", F.last("ok", ignorenulls=True).over(upto)).where("kind = 1").select(*refs.columns, "then")
    last = history.groupBy(*_KEY).agg(F.max(_record()).alias("p"))
    known = probed.join(last, _KEY, "left")
    known = known.select(*refs.columns, (~F.coalesce("then", F.lit(False))).alias("missing"), (~F.coalesce("p.ok", F.lit(False))).alias("waits"), F.col("p.at").alias("since"))
    return known.unionByName(lost.withColumns({"missing": F.lit(True), "waits": F.lit(True), "since": F.lit(None).cast("timestamp")}))


def _monthly(refs: DataFrame, history: DataFrame, sign: int = 1) -> DataFrame:
    """(ref_table, month, delta): how the number of open references changes over the months; counters by key and month are enough."""
    n = refs.where("key is not null and at is not null").groupBy(*_KEY, "ref_table", _month().alias("month")).agg(F.count(F.lit(1)).alias("n"))
    ends = history.groupBy(*_KEY, _month().alias("month")).agg(F.max(_record()).alias("p")).join(n.select(*_KEY, "ref_table").distinct(), _KEY)
    ends = ends.withColumn("n", F.lit(0).cast("bigint")).unionByName(n.withColumn("p", F.lit(None).cast(_RECORD)))
    ends = ends.groupBy(*_KEY, "ref_table", "month").agg(F.max("p").alias("p"), F.sum("n").alias("n"))
    run = Window.partitionBy(*_KEY, "ref_table").orderBy("month")  # months of a key
    upto = run.rowsBetween(Window.unboundedPreceding, 0)
    pending = F.when(~F.coalesce(F.last("p.ok", ignorenulls=True).over(upto), F.lit(False)), F.sum("n").over(upto)).otherwise(F.lit(0))
    ends = ends.withColumn("pending", pending).withColumn("delta", F.col("pending") - F.coalesce(F.lag("pending").over(run), F.lit(0)))
    never = refs.where("key is null or at is null").groupBy("ref_table", _month().alias("month")).agg(F.count(F.lit(1)).alias("delta"))
    both = ends.select("ref_table", "month", "delta").unionByName(never)
    return both.groupBy("ref_table", "month").agg((F.sum("delta") * sign).alias("delta"))


def advance(state: OrphanState, refs: DataFrame, parent_log: DataFrame, slice_rows: int = SLICE_ROWS) -> Advance:
    """Apply one batch; its load times may lie before those already in `state`.

    A parent loaded at the same time as a reference counts for it; of parents with equal time the greatest seq does.
    References without a key or a load time miss their parent and never resolve. Repeated references each count.
    Empty batches and states are fine. Inputs are the frames of references() and parents().
    """
    touched = parent_log.select(*_KEY).distinct()
    again = state.refs.withColumnsRenamed({"missing": "was_missing", "waits": "did_wait"}).join(touched, _KEY, "left_semi")
    fresh = refs.select(*_SEEN).withColumns({"was_missing": F.lit(None).cast("boolean"), "did_wait": F.lit(None).cast("boolean")})
    asked = materialize(again.unionByName(fresh), "orphans-asked")
    held = materialize(state.parents.join(asked.select(*_KEY).distinct(), _KEY, "left_semi"), "orphans-held")
    judged = materialize(_judge(asked, held.unionByName(parent_log), slice_rows), "orphans-judged")
    return Advance(state, parent_log, held, judged)


def open_by_month(deltas: DataFrame) -> DataFrame:
    """References open at the end of each month, per referring table: (ref_table, month, open_refs)."""
    w = Window.partitionBy("ref_table").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)  # one row per month
    return deltas.groupBy("ref_table", "month").agg(F.sum("delta").alias("delta")).select("ref_table", "month", F.sum("delta").over(w).alias("open_refs"))
