"""Language ID: bit-sliced Bloom filters of byte n-grams that return all languages at once."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import quoted, spare, text_blocks, without
from shelfmatch.sources.staging import stage

GRAM = 4  # bytes
LEAST_SHARE = 2e-5  # of a language's n-grams: so a language has at most 50,000 of them in the filter
LEAST_RATIO = 0.2  # to the share in the language that has it most
HASHES = 3
SLOTS_PER_GRAM = 8
UNKNOWN = "und"
PIECE = 1 << 20

_LETTER = regex.compile(r"\p{L}")
_KEPT = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def grams(data: bytes, begins: bool = True, ends: bool = True) -> np.ndarray:
    """The 4-byte windows of lower-case UTF-8 with a blank before its begin and after its end, as numbers; ASCII other
    than letters counts as blank, and windows with two blanks in a row are left out."""
    raw = np.concatenate(([32] * begins, _KEPT[np.frombuffer(data, np.uint8)], [32] * ends)).astype(np.uint32)
    if len(raw) < GRAM:
        return np.empty(0, np.uint32)
    blank = raw == 32
    double = blank[1:] & blank[:-1]
    n = len(raw) - GRAM + 1
    whole = ~(double[:n] | double[1:n + 1] | double[2:n + 2])
    return ((raw[:n] << 24) | (raw[1:n + 1] << 16) | (raw[2:n + 2] << 8) | raw[3:])[whole]


def pieces(text: str) -> Iterator[np.ndarray]:
    """The n-grams of the whole text, in portions that overlap by less than one; how it is cut changes none."""
    data = text.lower().encode()
    for at in range(0, max(1, len(data)), PIECE):
        yield grams(data[max(0, at - GRAM + 1):at + PIECE], at == 0, at + PIECE >= len(data))


def slots(codes: np.ndarray, size: int) -> list[np.ndarray]:
    """The places of each n-gram in a filter of ``size`` (a power of two) slots."""
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bits = np.uint64(size.bit_length() - 1)
    return [(x >> (np.uint64(64) - bits * np.uint64(k + 1))).astype(np.int64) & (size - 1) for k in range(HASHES)]


@dataclass
class Model:
    """``slices[s]`` has bit l set if some n-gram of language l is hashed to slot s; the AND over an n-gram's slots
    gives all languages that may contain it."""

    languages: list[str]  # most n-grams seen first, then by name: the order in which ties are decided
    slices: np.ndarray  # (words of 64 languages, slots)
    false_positive: np.ndarray  # per language: the chance that a foreign n-gram passes

    def hits(self, codes: np.ndarray) -> np.ndarray:
        at = slots(codes, self.slices.shape[1])
        found = np.zeros(len(self.languages), np.int64)
        for w, row in enumerate(self.slices):
            mask = row[at[0]]
            for more in at[1:]:
                mask &= row[more]
            for k in range(w * row.itemsize * 8, min(len(found), (w + 1) * row.itemsize * 8)):
                found[k] = np.count_nonzero(mask & row.dtype.type(1 << (k % (row.itemsize * 8))))
        return found

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language; its part of all corrected counts; its corrected count per n-gram of the text."""
        if not text or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0.0
        if not self.languages:
            return UNKNOWN, 0.0, 0.0
        n, hits = 0, np.zeros(len(self.languages))
        for codes in pieces(text):
            n += len(codes)
            hits += self.hits(codes)
        real = np.maximum(0, (hits - n * self.false_positive) / (1 - self.false_positive))
        best = int(real.argmax())
        return self.languages[best], float(real[best] / real.sum()) if real.sum() else 0.0, float(min(1.0, real[best] / n)) if n else 1.0


def count_grams(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, gram, n) over whole texts, summed within each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        keys, times = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in text_blocks(batches, 1):
            fresh = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                k = np.uint64(names.setdefault(name, len(names)) << 32)
                fresh += [codes | k for codes in pieces(text)]
            own, n = np.unique(np.concatenate(fresh), return_counts=True)
            merged = np.concatenate((keys, own))
            order = np.argsort(merged, kind="stable")
            merged, counts = merged[order], np.concatenate((times, n))[order]
            first = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1]))) if len(merged) else np.empty(0, np.int64)
            keys, times = merged[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys):
            known = pa.array(list(names))
            yield pa.RecordBatch.from_arrays([known.take(pa.array((keys >> np.uint64(32)).astype(np.int64))), pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(times)], ["lang", "gram", "n"])

    rows = docs.select(quoted(lang).alias("lang"), quoted(text).alias("text")).where("lang is not null and text is not null")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", least_share: float = LEAST_SHARE, least_ratio: float = LEAST_RATIO) -> Model:
    """Count the n-grams of all labelled texts and put into each language's filter those that make up ``least_share``
    of its n-grams, unless another language has them ``1 / least_ratio`` times as often.

    Rows with null ``lang`` or null text are left out; so is the name ``und``. The driver gets at most ``1 /
    least_share`` n-grams per language, whatever the size of the corpus. Without rows the model has no language.
    """
    counts = stage(count_grams(docs.where(quoted(lang) != UNKNOWN), lang, text), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("total")).where(F.col("share") >= least_share)
    best = shares.groupBy("gram").agg(F.collect_list(F.struct("lang", "share")).alias("langs"))  # one row per language at most
    top = F.array_max(F.transform("langs", lambda x: x["share"]))
    kept = best.select("gram", F.transform(F.filter("langs", lambda x: x["share"] >= top * least_ratio), lambda x: x["lang"]).alias("langs"))
    languages = [r.lang for r in totals.orderBy(F.desc("total"), "lang").collect()]
    number = {name: k for k, name in enumerate(languages)}
    members: list[list[int]] = [[] for _ in languages]
    for r in kept.collect():
        for name in r.langs:
            members[number[name]].append(r.gram)
    per = [np.array(m, np.uint32) for m in members]
    size = 1 << max(10, (SLOTS_PER_GRAM * max([len(p) for p in per], default=1)).bit_length())
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    wide = np.dtype(kind).itemsize * 8
    slices = np.zeros((max(1, -(-len(languages) // wide)), size), kind)
    filled = []
    for k, codes in enumerate(per):
        row, bit = slices[k // wide], kind(1 << (k % wide))
        for at in slots(codes, size):
            row[at] |= bit
        filled.append(np.count_nonzero(row & bit) / size)
    return Model(languages, slices, np.array(filled) ** HASHES)


def _predictor(model: Model):
    @F.arrow_udf("struct<lang_pred: string, score: double, coverage: double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [model.predict(t.as_py()) for t in texts]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score", "coverage"])

    return run


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the language's part of the corrected counts of all languages) and
    ``coverage`` (its corrected count per n-gram of the text).

    ``und`` with score 0 if the text is null or has no letter. A text with letters but no known n-gram gets the first
    language of the model (that with most n-grams seen) and score 0, as do ties; if it is too short for any n-gram, its
    coverage is 1. Texts of any length are read whole. Columns of these names are replaced, all others pass; repeated
    rows stay. An empty table gives an empty result.
    """
    kept = without(docs, "lang_pred", "score", "coverage")
    held, = spare(docs, "found")
    found = docs.withColumn(held, _predictor(model)(quoted(text)))
    return found.select(*[quoted(c) for c in kept.columns], f"{held}.lang_pred", f"{held}.score", f"{held}.coverage")


def drop_unidentified(docs: DataFrame, model: Model, least_coverage: float = 0.1, text: str = "text") -> DataFrame:
    """``docs`` without the rows in no learned language: no letter at all, or a best language that holds fewer than
    ``least_coverage`` of the n-grams. Texts with letters that are too short for an n-gram stay. All columns stay as
    they are, whatever their names; null and empty texts go, and all rows if the model has no language."""
    found = _predictor(model)(quoted(text))
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["coverage"] >= least_coverage))
