"""Text to vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.functions.text import words
from topicweave.functions.vector import unit
from topicweave.operators.blocks import list_column

Encoder = Callable[[list[str]], np.ndarray]


_LOADED: dict[str, Encoder] = {}


def loaded_encoder(key: str, load_encoder: Callable[[], Encoder]) -> Encoder:
    """The encoder of this Python worker; another one takes its place."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = load_encoder()
    return _LOADED[key]


def l2_normalize(df: DataFrame, vec_col: str = "vec") -> DataFrame:
    """Vectors at length one; zero vectors stay zero."""
    return df.withColumn(vec_col, unit(F.col(vec_col)))


def encode_documents(
    df: DataFrame,
    load_encoder: Callable[[], Encoder],
    col: str = "text",
    batch_size: int = 32,
    max_chars: int = 2500,
    normalize: bool = True,
) -> DataFrame:
    """(doc_id, vec): float vectors of the first ``max_chars`` characters of each text.

    ``load_encoder`` runs once in each Python worker and gives a function from a
    list of texts to a 2-D array; texts reach it in batches of ``batch_size``.
    Missing texts are encoded as empty.
    """
    short = F.substring(F.coalesce(F.col(col).cast("string"), F.lit("")), 1, max_chars)

    key = hashlib.sha256(cloudpickle.dumps(load_encoder)).hexdigest()

    def encode(frames):
        for frame in frames:
            encoder = loaded_encoder(key, load_encoder)
            texts = frame["text"].tolist()
            parts = [
                np.asarray(encoder(texts[i : i + batch_size]), dtype=np.float32)
                for i in range(0, len(texts), batch_size)
            ]
            if not parts:
                continue
            rows = np.concatenate(parts)
            if normalize:
                length = np.sqrt((rows.astype(float) ** 2).sum(axis=1, keepdims=True))
                rows = (rows / np.maximum(length, 1e-12)).astype(np.float32)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "vec": list(rows)})

    return df.select("doc_id", short.alias("text")).mapInPandas(
        encode, "doc_id long, vec array<float>"
    )


def token_slots(tokens: Column, dim: int) -> Column:
    """Per token: a slot below ``dim``, plus ``dim`` if its sign is negative."""
    def slot(token: Column) -> Column:
        digest = F.md5(token.cast("binary"))
        number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % dim
        negative = F.conv(F.substring(digest, 9, 1), 16, 10).cast("int") % 2
        return (number + dim * negative).cast("int")

    return F.transform(tokens, slot)


def hash_documents(
    df: DataFrame, col: str = "text", dim: int = 64, max_chars: int | None = None, normalize: bool = True
) -> DataFrame:
    """(doc_id, vec): signed counts of hashed words; an encoder that needs no model.

    Words are hashed in the JVM and counted per Arrow batch, without a shuffle.
    The whole text counts unless ``max_chars`` is given.
    """
    text = F.col(col) if max_chars is None else F.substring(F.col(col), 1, max_chars)
    slots = token_slots(words(text), dim)

    def count(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("slots")
            row = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            slot = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = row * dim + slot % dim
            sign = 1.0 - 2.0 * (slot >= dim)
            rows = np.bincount(at, weights=sign, minlength=batch.num_rows * dim)
            rows = rows.astype(float).reshape(-1, dim)  # integers if there is no word at all
            if normalize:
                rows /= np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), list_column(rows)], ["doc_id", "vec"])

    return df.select("doc_id", slots.alias("slots")).mapInArrow(count, "doc_id long, vec array<double>")


def embedding_info(vectors: DataFrame, **settings) -> DataFrame:
    """One row: dimension and number of vectors, and the given settings."""
    fixed = [F.lit(v).alias(k) for k, v in settings.items()]
    return vectors.agg(
        F.max(F.size("vec")).alias("embedding_dim"), F.count(F.lit(1)).alias("n_documents")
    ).select("*", *fixed)


def check_alignment(vectors: DataFrame, corpus: DataFrame, on: str = "doc_id") -> DataFrame:
    """One row: vectors without document, documents without vector, and the ids that repeat on either side.

    A null id matches nothing.
    """
    left = vectors.groupBy(F.col(on).alias("v")).agg(F.count(F.lit(1)).alias("n_v"))
    right = corpus.groupBy(F.col(on).alias("c")).agg(F.count(F.lit(1)).alias("n_c"))
    return left.join(right, F.col("v") == F.col("c"), "full_outer").agg(
        F.coalesce(F.sum(F.when(F.col("n_c").isNull(), F.col("n_v"))), F.lit(0)).alias("vectors_only"),
        F.coalesce(F.sum(F.when(F.col("n_v").isNull(), F.col("n_c"))), F.lit(0)).alias("documents_only"),
        F.count_if(F.col("n_v") > 1).alias("vectors_repeated"),
        F.count_if(F.col("n_c") > 1).alias("documents_repeated"),
    )


def require_alignment(vectors: DataFrame, corpus: DataFrame) -> None:
    """Raise if vectors and documents do not match one to one by id."""
    row = check_alignment(vectors, corpus).first()
    if any(row):
        raise ValueError(
            f"{row.vectors_only} vectors without document, {row.documents_only} documents without vector, "
            f"{row.vectors_repeated} and {row.documents_repeated} ids of them more than once"
        )
