"""Pair similarities and the weighted match score."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmatch import constants as K
from shelfmatch.functions.numbers import ratio
from shelfmatch.functions.sequences import Texts

# The two batch functions are marked nondeterministic only so that the optimizer neither evaluates them twice nor moves
# them below the filters that spare them work.

SCORE_DIGITS = 9  # scores are rounded before any threshold, so the order of a sum cannot move a row across it


def jaccard(left: Column, right: Column) -> Column:
    """Shared part of two token sets (arrays without repeats); two empty sets share nothing."""
    shared = F.size(F.array_intersect(left, right))
    union = F.size(left) + F.size(right) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def relative_similarity(left: Column, right: Column, power: int = 1) -> Column:
    """One minus the difference relative to the larger value; null if a value is missing or both are zero."""
    base = 1 - ratio(F.abs(left - right), F.greatest(left, right))
    return base if power == 1 else F.pow(base, F.lit(float(power)))


def quantity_similarity(left: Column, right: Column) -> Column:
    return relative_similarity(left, right, power=2)


def price_similarity(left: Column, right: Column) -> Column:
    return relative_similarity(left, right)


@F.arrow_udf(T.DoubleType())
def _row_products(left: pa.Array, right: pa.Array) -> pa.Array:
    known = pc.and_(left.is_valid(), right.is_valid())
    a, b = (v.filter(known).flatten().to_numpy(zero_copy_only=False).astype(np.float64) for v in (left, right))
    rows = known.true_count
    sums = np.einsum("ij,ij->i", a.reshape(rows, -1), b.reshape(rows, -1)) if rows else np.empty(0)
    result = np.zeros(len(left))
    mask = known.to_numpy(zero_copy_only=False)
    result[mask] = sums
    return pa.array(result, mask=~mask)


def dot_product(left: Column, right: Column) -> Column:
    """In double, whatever the vectors are stored in; the cosine if both have length one. Vectors are of one width.

    An Arrow batch product: ``aggregate(zip_with(..))`` boxes every element and took some 60 microseconds per pair.
    """
    return _row_products.asNondeterministic()(left, right)


@F.arrow_udf(T.BinaryType())
def _pack(vectors: pa.Array) -> pa.Array:
    return pa.array([v.values.to_numpy(zero_copy_only=False).tobytes() if v.is_valid else None for v in vectors], pa.binary())


def packed(vector: Column) -> Column:
    """A vector as the bytes of its numbers: copied whole where an array is copied number by number."""
    return _pack(vector)


def _packed_rows(packed_vectors: pa.Array, dtype: str) -> np.ndarray:
    held = packed_vectors.cast(pa.binary())
    ends = np.frombuffer(held.buffers()[1], np.int32, count=len(held) + 1, offset=4 * held.offset)
    data = np.frombuffer(held.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    return data.view(dtype).reshape(len(held), -1).astype(np.float64)


def packed_product(left: Column, right: Column, dtype: str) -> Column:
    """``dot_product`` of two packed vectors whose numbers are of the NumPy type ``dtype``."""

    @F.arrow_udf(T.DoubleType())
    def products(lefts: pa.Array, rights: pa.Array) -> pa.Array:
        known = pc.and_(lefts.is_valid(), rights.is_valid())
        if known.true_count < len(known):
            lefts, rights = lefts.filter(known), rights.filter(known)
        mask = known.to_numpy(zero_copy_only=False)
        result = np.zeros(len(known))
        if len(lefts):
            result[mask] = np.einsum("ij,ij->i", _packed_rows(lefts, dtype), _packed_rows(rights, dtype))
        return pa.array(result, mask=~mask)

    return products.asNondeterministic()(left, right)


def cosine(left: Column, right: Column) -> Column:
    return ratio(dot_product(left, right), F.sqrt(dot_product(left, left) * dot_product(right, right)))


def weighted_sum(embedding: Column, fuzz: Column, jacc: Column, quantity: Column, price: Column) -> Column:
    """The match score before it is rounded; null as soon as one part is."""
    return (
        K.WEIGHTS["embedding"] * embedding
        + K.WEIGHTS["fuzz"] * fuzz
        + K.WEIGHTS["jaccard"] * jacc
        + K.WEIGHTS["quantity"] * quantity
        + K.WEIGHTS["price"] * price
    )


def weighted_score(embedding: Column, fuzz: Column, jacc: Column, quantity: Column, price: Column) -> Column:
    """The match score; null as soon as one part is."""
    return F.round(weighted_sum(embedding, fuzz, jacc, quantity, price), SCORE_DIGITS)


def fuzz_ceiling(left_length: Column, right_length: Column) -> Column:
    """The fuzzy score cannot exceed this for texts of these lengths, as the shorter one bounds what they share."""
    total = left_length + right_length
    return F.when(total > 0, 2 * F.least(left_length, right_length) / total).otherwise(F.lit(1.0))


@F.arrow_udf(T.DoubleType())
def _text_ratio(lefts: pa.Array, rights: pa.Array) -> pa.Array:
    known = pc.and_(lefts.is_valid(), rights.is_valid())
    both = pa.chunked_array([lefts.filter(known), rights.filter(known)], pa.string()).combine_chunks().dictionary_encode()
    texts, numbers = Texts(both.dictionary.to_pylist()), both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # pairs of one cell arrive together and many are alike; each is compared once per batch
    left, right = numbers[:known.true_count], numbers[known.true_count:]
    pairs, of = np.unique(left * max(1, len(texts.texts)) + right, return_inverse=True)
    left, right = pairs // max(1, len(texts.texts)), pairs % max(1, len(texts.texts))
    total = (texts.lengths[left] + texts.lengths[right]).astype(np.float64)
    ratios = np.where(total > 0, 2 * texts.common(left, right) / np.where(total > 0, total, 1), 1.0)
    mask = known.to_numpy(zero_copy_only=False)
    result = np.zeros(len(mask))
    result[mask] = ratios[of]
    return pa.array(result, mask=~mask)


def fuzz_ratio(left_sorted: Column, right_sorted: Column) -> Column:
    """Twice the longest common subsequence over the summed lengths of two sorted-word texts; two empty texts are equal.

    Spark has no such function (``levenshtein`` is another metric), hence an Arrow batch UDF.
    """
    return _text_ratio.asNondeterministic()(left_sorted, right_sorted)
