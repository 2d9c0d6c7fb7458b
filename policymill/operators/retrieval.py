"""Vector and keyword ranking under a hard scope, and their fusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from policymill.functions import english
from policymill.functions.values import lexemes

FUSION_K, COVER_WEIGHT = 60, 0.1  # fixed values


def cosine_distance(vector: Column, query: list[float]) -> Column:
    """1 - cosine, in double, summed in index order; NULL for vectors of another size or length zero."""
    q = F.array(*[F.lit(float(x)) for x in query])
    v = F.transform(vector, lambda x: x.cast("double"))
    dot = F.aggregate(F.zip_with(v, q, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)) * float(sum(x * x for x in query) ** 0.5)
    return F.when((F.size(vector) == len(query)) & (norm > 0), 1 - dot / norm)


def vector_topk(df: DataFrame, key: str, vector: str, query: list[float], k: int = 50) -> DataFrame:
    """(key, distance, rank) of the k nearest rows; ties by key."""
    near = df.select(key, cosine_distance(F.col(vector), query).alias("distance")).where("distance is not null and not isnan(distance)")
    top = near.orderBy("distance", key).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("distance", key)))  # k rows


def hits(text: Column, words: list[str]) -> Column:
    """Occurrences of any of the words."""
    wanted = F.array(*[F.lit(w) for w in words]).cast("array<string>")
    return F.size(F.filter(lexemes(text), lambda x: F.array_contains(wanted, x)))


def query_words(query: str) -> list[str]:
    """Distinct words of ASCII letters and digits, sorted."""
    return sorted({w for w in "".join(c if c.isascii() and c.isalnum() else " " for c in query.lower()).split()})


def keyword_topk(df: DataFrame, key: str, text: str, query: str, k: int = 50, analyzer: str = "simple") -> DataFrame:
    """(key, hits, rank, score) of the k rows with most occurrences of the query's words; ties by key; none for no words.

    `simple` compares words as they are, `english` their stems without stop words.
    """
    if analyzer == "english":
        found = english.stem_hits(F.col(text), english.query_stems(query))
    else:
        found = hits(F.col(text), query_words(query)).cast("bigint")
    top = df.select(key, found.alias("hits")).where("hits > 0").orderBy(F.desc("hits"), key).limit(k)
    return _ranked(top, key)


def _ranked(top: DataFrame, key: str) -> DataFrame:
    """k rows with their rank and score.

    Where any word may match, every occurrence is a cover of its own, which weighs 0.1; a sum s is normalised as s / (s + 1).
    """
    s = F.col("hits") * COVER_WEIGHT
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("hits"), key))).withColumn("score", s / (s + 1))


def lexeme_table(df: DataFrame, key: str, text: str, analyzer: str = "simple") -> DataFrame:
    """(key, lexeme, n): how often each lexeme occurs in a text, to be stored once and asked often.

    Words are counted by expressions; `english` then stems every distinct word of the corpus once and leaves stop words out.
    NULL, empty and wordless texts have none.
    """
    words = df.select(key, F.explode(lexemes(F.col(text))).alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))
    if analyzer != "english":
        return words.withColumnRenamed("word", "lexeme")
    stems = words.select("word").distinct().select("word", english.stems(F.col("word")).alias("lexeme")).where("lexeme is not null")
    return words.join(stems, "word").groupBy(key, "lexeme").agg(F.sum("n").alias("n"))


def lexeme_topk(table: DataFrame, key: str, query: str, k: int = 50, analyzer: str = "simple") -> DataFrame:
    """The result of keyword_topk from a lexeme table, of which only the rows of the query's lexemes are read."""
    wanted = english.query_stems(query) if analyzer == "english" else query_words(query)
    found = table.where(F.col("lexeme").isin(wanted)).groupBy(key).agg(F.sum("n").cast("bigint").alias("hits"))
    return _ranked(found.orderBy(F.desc("hits"), key).limit(k), key)


def fuse(rankings: list[DataFrame], key: str, k: int = 8) -> DataFrame:
    """(key, score): reciprocal-rank fusion, the best k; a row found by one ranking only is kept."""
    all_ = rankings[0].select(key, "rank")
    for r in rankings[1:]:
        all_ = all_.unionByName(r.select(key, "rank"))
    score = all_.groupBy(key).agg(F.round(F.sum(F.lit(1.0) / (F.lit(FUSION_K) + F.col("rank"))), 6).alias("score"))
    return score.orderBy(F.desc("score"), key).limit(k)
