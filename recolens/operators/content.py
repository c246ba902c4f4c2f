"""Content vectors from product text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from recolens.functions.scalars import corpus_text

DIM = 384
BATCH = 256

Encoder = Callable[[Sequence[str]], np.ndarray]


def build_corpus(products: DataFrame) -> DataFrame:
    """product_id and its text: title plus first description entry."""
    description = F.col("description") if "description" in products.columns else None
    return products.select("product_id", corpus_text(F.col("title"), description).alias("text"))


def content_embed(
    corpus: DataFrame, dim: int = DIM, encoder: Callable[[], Encoder] | None = None
) -> DataFrame:
    """product_id and an L2-normalised vector of the whole text.

    By default hashed terms weighted by inverse document frequency. ``encoder`` builds a
    model inside each task and is called with batches of texts; Spark only partitions.
    """
    if encoder is not None:
        return _encode(corpus, encoder)
    model = Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="terms", pattern=r"[^\p{L}\p{N}]+"),
            HashingTF(inputCol="terms", outputCol="tf", numFeatures=dim),
            IDF(inputCol="tf", outputCol="tfidf"),
            Normalizer(inputCol="tfidf", outputCol="unit"),
        ]
    ).fit(corpus)
    return model.transform(corpus).select(
        "product_id", vector_to_array("unit", "float32").alias("embedding")
    )


def _encode(corpus: DataFrame, factory: Callable[[], Encoder]) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = factory()
        for frame in frames:
            for start in range(0, len(frame), BATCH):
                part = frame.iloc[start : start + BATCH]
                v = np.asarray(encode(part["text"].tolist()), dtype=np.float64)
                length = np.linalg.norm(v, axis=1, keepdims=True)
                v = (v / np.where(length == 0, 1.0, length)).astype(np.float32)
                yield pd.DataFrame(
                    {"product_id": part["product_id"].to_numpy(), "embedding": list(v)}
                )

    return corpus.select("product_id", "text").mapInPandas(
        run, "product_id string, embedding array<float>"
    )
