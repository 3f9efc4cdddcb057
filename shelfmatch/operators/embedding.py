"""Product vectors: batch encoding on Arrow batches, with the encoder as a parameter."""

import hashlib
import re
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"\w+")
MOST_TOKENS = 100_000  # that a Python worker remembers
BATCH_BYTES = 4 << 20  # of texts that go to Python at a time
Encoder = Callable[[list[str]], np.ndarray]


class _Buckets(dict):
    """md5 bucket per token, remembered."""

    def __init__(self, width):
        super().__init__()
        self.width = width

    def __missing__(self, token):
        if len(self) >= MOST_TOKENS:
            self.clear()
        bucket = self[token] = int(hashlib.md5(token.encode()).hexdigest()[-8:], 16) % self.width
        return bucket


class HashedTokens:
    """Default encoder: token counts in md5 buckets, scaled to length one. Needs no model file."""

    def __init__(self, width=64):
        self.buckets = _Buckets(width)

    def _counts(self, value: str) -> np.ndarray:
        buckets = self.buckets
        return np.bincount([buckets[t] for t in WORD.findall(value.lower())] or [0], minlength=buckets.width)

    def __call__(self, texts: list[str]) -> np.ndarray:
        counts = np.array([self._counts(t) if WORD.search(t) else np.zeros(self.buckets.width) for t in texts], dtype=float)
        norms = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        return np.divide(counts, norms, out=np.zeros_like(counts), where=norms > 0).astype(np.float32)


def encode(products: DataFrame, column="product_text", make_encoder: Callable[[], Encoder] = HashedTokens) -> DataFrame:
    """Add ``embedding``. ``make_encoder`` runs once per Python worker task, so a model is loaded once, not per batch.
    Rows are encoded where they are; a caller with few large splits and a slow model repartitions before. The bound on the
    bytes of a batch is a session setting, as it acts when the result is read."""
    products.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for batch in batches:
            yield pd.Series(list(encoder(batch.fillna("").tolist())), index=batch.index, dtype=object)

    # nondeterministic by name only, so that no filter or explode on the result makes the optimizer encode twice
    return products.withColumn("embedding", vectors.asNondeterministic()(F.col(column)))
