"""Deterministic metrics of answers against expected document ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policymill.functions import values
from policymill.operators import tables


def recall(expected: Column, got: Column) -> Column:
    """Share of expected ids among those got; NULL when none is expected."""
    return F.when(F.size(expected) > 0, F.size(F.array_intersect(expected, got)) / F.size(expected))


def grounded(cited: Column, retrieved: Column, asked: Column) -> Column:
    """Share of cited ids that were retrieved or asked for; NULL when nothing is cited."""
    return F.when(F.size(cited) > 0, F.size(F.array_intersect(cited, F.array_union(retrieved, asked))) / F.size(cited))


def scores(items: DataFrame, runs: DataFrame) -> DataFrame:
    """(item_id, metric, value) of answered items; a metric that does not apply to an item gives no row.

    `items`: item_id, question, public_ids and tools (arrays), state, state_name. `runs`: item_id, answer, tool_results
    (array), tool_calls (array of name, state), error, latency_s. Items without a run, and runs without an item, give
    none. A NULL answer counts as empty, a NULL array as an empty one.
    """
    text, none = F.coalesce("answer", F.lit("")), F.array().cast("array<string>")
    cited, asked = values.mentioned_ids(text), values.mentioned_ids(F.coalesce("question", F.lit("")))
    found = values.mentioned_ids(F.coalesce(F.array_join("tool_results", "\n"), F.lit("")))
    expected, called = F.array_distinct(F.coalesce("public_ids", none)), F.coalesce(F.col("tool_calls.name"), none)
    states = F.transform(F.coalesce(F.col("tool_calls.state"), none), lambda s: F.lower(F.trim(F.coalesce(s, F.lit("")))))
    named = F.array_compact(F.array(F.lower("state"), F.lower("state_name")))
    completed = F.col("error").isNull()
    metrics = {
        "citation_recall": recall(expected, cited), "retrieval_recall": recall(expected, found), "citation_grounded": grounded(cited, found, asked),
        "tool_selection": F.size(F.array_intersect(called, F.coalesce("tools", none))) > 0, "state_filter": F.when(F.col("state") != "", F.size(F.array_intersect(states, named)) > 0),
        "completed": completed, "answered": F.trim(text) != "", "clean_output": F.size(values.leaked_markup(text)) == 0,
        "latency_s": F.when(completed, F.col("latency_s")), "tool_calls": F.when(completed, F.size(called)),
    }
    each = F.array(*[F.struct(F.lit(n).alias("metric"), m.cast("double").alias("value")) for n, m in metrics.items()])
    return items.join(runs, "item_id").select("item_id", F.inline(each)).where("value is not null")


def evidence(df: DataFrame, group: str, order: list[str], text: str, most: int = 24_000) -> DataFrame:
    """Texts of each group in order, cut where the running length passes `most` characters."""
    placed = tables.running(df, [group], order, F.coalesce(F.length(text), F.lit(0)), "evidence").drop("__no")
    cut = placed.withColumnRenamed("__at", "__before").where(F.col("__before") < most)
    return cut.withColumn(text, F.substring(F.col(text), F.lit(1), (F.lit(most) - F.col("__before")).cast("int"))).drop("__before")


def latency(df: DataFrame, seconds: str) -> DataFrame:
    """One row: runs, mean and 95th percentile by linear interpolation, 0 when there are none."""
    return df.agg(F.count(seconds).alias("runs"), F.round(F.avg(seconds), 6).alias("mean_s"), F.coalesce(F.round(F.expr(f"percentile({seconds}, 0.95)"), 2), F.lit(0.0)).alias("p95_s"))


def run_means(each: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(*by, metric, items, mean) of the rows of scores(), over the items to which a metric applies."""
    return each.groupBy(*(by or []), "metric").agg(F.count("value").alias("items"), F.avg("value").alias("mean"))
