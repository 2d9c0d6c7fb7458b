"""Keeping vectors in step with chunks: what is missing, what can be reused, what must be computed."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Provider = Callable[[list[str]], np.ndarray]


def prefix(model: str, prefixes: Mapping[str, tuple[str, str]], query: bool = False) -> str:
    """What a model of a family (the name before `:`) wants before documents, or before queries; nothing for other families."""
    return prefixes.get(model.split(":")[0], ("", ""))[query]


def without_model(vectors: DataFrame, model: str) -> DataFrame:
    """Vectors of the other models, from which a forced refresh starts; NULL models are others."""
    return vectors.where(~F.coalesce(F.col("model") == model, F.lit(False)))


def missing(chunks: DataFrame, vectors: DataFrame, model: str) -> DataFrame:
    """Chunks without a vector of the model."""
    return chunks.join(vectors.where(F.col("model") == model).select("chunk_id").distinct(), "chunk_id", "left_anti")


def reusable(chunks: DataFrame, vectors: DataFrame, model: str) -> DataFrame:
    """(chunk_id, from_chunk): missing chunks that take the newest vector of a chunk with the same hash."""
    have = chunks.select("chunk_id", "content_hash").join(vectors.where((F.col("model") == model) & F.col("embedding").isNotNull()).select("chunk_id", "created_at"), "chunk_id")
    newest = have.groupBy("content_hash").agg(F.max(F.struct("created_at", "chunk_id")).alias("v"))
    return missing(chunks, vectors, model).join(newest, "content_hash").select("chunk_id", F.col("v.chunk_id").alias("from_chunk"))


def pending(chunks: DataFrame, vectors: DataFrame, model: str) -> DataFrame:
    """(content_hash, first_chunk, chunks): the distinct texts still to be embedded."""
    left = missing(chunks, vectors, model).join(reusable(chunks, vectors, model).select("chunk_id"), "chunk_id", "left_anti")
    return left.groupBy("content_hash").agg(F.min("chunk_id").alias("first_chunk"), F.count(F.lit(1)).alias("chunks"))


def hashing_provider(dim: int = 64) -> Provider:
    """A deterministic provider that needs no model: signed feature hashing, unit length."""
    import hashlib

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little")
                out[i, h % dim] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    return embed


def embed(texts: DataFrame, key: str, text: str, provider: Provider, dim: int, batch: int = 64) -> DataFrame:
    """(key, embedding) by a provider, in batches; a vector of another size fails the job."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), batch):
                part = f.iloc[at : at + batch]
                got = provider(part[text].tolist())
                if got.shape != (len(part), dim):
                    raise ValueError(f"expected {len(part)} vectors of {dim} values, got {got.shape}")
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": list(got)})

    kind = texts.schema[key].dataType.simpleString()
    return texts.where(F.col(text).isNotNull()).select(key, text).mapInPandas(run, f"{key} {kind}, embedding array<float>")


def refresh(chunks: DataFrame, vectors: DataFrame, model: str, provider: Provider, dim: int, prefixes: Mapping[str, tuple[str, str]] | None = None, force: bool = False) -> DataFrame:
    """(chunk_id, embedding) still to be added for a model: reused from chunks with the same hash, else computed once a hash.

    `chunks` holds chunk_id, content_hash, heading_path and content; with `force` every chunk is computed anew. A dry run
    looks at reusable() and pending() alone. Chunks without heading and content get no vector.
    """
    held = without_model(vectors, model) if force else vectors
    reused = reusable(chunks, held, model)
    newest = held.where((F.col("model") == model) & F.col("embedding").isNotNull()).groupBy("chunk_id").agg(F.max_by("embedding", "created_at").alias("embedding"))
    taken = reused.join(newest.withColumnRenamed("chunk_id", "from_chunk"), "from_chunk").select("chunk_id", "embedding")
    todo = pending(chunks, held, model)
    words = chunks.select(F.col("chunk_id").alias("first_chunk"), F.concat_ws("\n\n", "heading_path", "content").alias("text")).where("text <> ''")
    text = F.concat(F.lit(prefix(model, prefixes or {})), "text").alias("text")
    made = embed(todo.join(words, "first_chunk").select("content_hash", text), "content_hash", "text", provider, dim)
    left = missing(chunks, held, model).join(reused.select("chunk_id"), "chunk_id", "left_anti")
    return taken.unionByName(left.select("chunk_id", "content_hash").join(made, "content_hash").select("chunk_id", "embedding"))
