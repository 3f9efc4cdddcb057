"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics, scored as Spark columns."""

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import quoted
from shelfmatch.sources.staging import stage

STATISTICS = (
    "log_bytes", "log_words", "word_length", "longest_word", "upper_share", "digit_share", "punctuation_share",
    "symbol_share", "blank_share", "foreign_share", "upper_words", "plain_words", "distinct_words", "top_word",
    "words_per_sentence", "words_per_line", "repeated_lines", "stop_share", "lone_symbols",
)
TREES, DEPTH, LASSO, SEED = 24, 3, 0.0005, 7
PIECE = 1 << 22

_KINDS = np.zeros(256, np.uint8)  # 1 upper, 2 lower, 3 digit, 4 blank, 5 sentence marks and commas, 6 other ASCII, 7 not ASCII
_KINDS[65:91], _KINDS[97:123], _KINDS[48:58] = 1, 2, 3
_KINDS[[9, 10, 11, 12, 13, 32]] = 4
_KINDS[[ord(c) for c in ".,;:!?'\"-()"]] = 5
_KINDS[(_KINDS == 0) & (np.arange(256) < 128)] = 6
_KINDS[128:] = 7


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of ``STATISTICS``. No text: all zero."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(data, np.uint8)
    kinds = sum(np.bincount(_KINDS[raw[i:i + PIECE]], minlength=8) for i in range(0, len(raw), PIECE))
    words = data.split()
    count = Counter(words)
    lengths = [len(w) for w in count]
    lines = [line for line in data.split(b"\n") if line.strip()]
    n, n_words = len(data), max(1, len(words))
    sentences = sum(data.count(c) for c in (b".", b"!", b"?"))
    upper = sum(k for w, k in count.items() if w.isupper())
    plain = sum(k for w, k in count.items() if w.isalpha() and w.islower())
    lone = sum(k for w, k in count.items() if len(w) == 1 and not w.isalnum())
    short = sum(k for w, k in count.items() if len(w) <= 3 and w.isalpha())
    return [
        math.log1p(n), math.log1p(len(words)), sum(len(w) * k for w, k in count.items()) / n_words, math.log1p(max(lengths, default=0)),
        kinds[1] / n, kinds[3] / n, kinds[5] / n, kinds[6] / n, kinds[4] / n, kinds[7] / n,
        upper / n_words, plain / n_words, len(count) / n_words, max(count.values(), default=0) / n_words,
        n_words / (1 + sentences), n_words / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), short / n_words, lone / n_words,
    ]


def with_statistics(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``name`` of the statistics of every whole text."""
    fields = ", ".join(f"{s}: double" for s in STATISTICS)

    @F.arrow_udf(f"struct<{fields}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = np.array([statistics(t.as_py()) for t in texts]).reshape(-1, len(STATISTICS))
            yield pa.StructArray.from_arrays([pa.array(c) for c in rows.T], list(STATISTICS))

    return docs.withColumn(name, run(quoted(text)))


Condition = tuple[str, str, float]  # statistic, "<=" or ">", threshold


@dataclass
class Rules:
    """The classifier: each rule is a conjunction of conditions with a weight; the score is the logistic of their sum."""

    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]]

    def score(self, statistic) -> Column:
        """The model as one Spark column; ``statistic`` gives the column of a statistic."""
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            total = total + F.when(rule_column(conditions, statistic), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def to_json(self) -> str:
        return json.dumps({"intercept": self.intercept, "rules": self.rules})


def rule_column(conditions: tuple[Condition, ...], statistic) -> Column:
    held = F.lit(True)
    for name, sign, threshold in conditions:
        held = held & (statistic(name) <= threshold if sign == "<=" else statistic(name) > threshold)
    return held


def simplified(conditions: list[Condition]) -> tuple[Condition, ...]:
    """The tightest bound per statistic and side, in a fixed order: equal rules of different trees become one."""
    tight: dict[tuple[str, str], float] = {}
    for name, sign, value in conditions:
        old = tight.get((name, sign), value)
        tight[name, sign] = min(old, value) if sign == "<=" else max(old, value)
    return tuple(sorted((n, s, v) for (n, s), v in tight.items()))


def tree_paths(dump: str) -> list[tuple[Condition, ...]]:
    """The rules of a forest, from its printed form: the path to every node but the roots."""
    found: set[tuple[Condition, ...]] = set()
    path: list[Condition] = []
    for line in dump.splitlines():
        depth = len(line) - len(line.lstrip())
        if m := re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            path = path[:depth - 4] if depth >= 4 else []
            path.append((STATISTICS[int(m[1])], m[2], float(m[3])))
            found.add(simplified(path))
    return sorted(found)


def learn(rows: DataFrame, label: str, statistic=lambda s: F.col(s), trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Rules:
    """Fit on rows with the statistics and a label of 0 or 1 (others, and nulls, are left out): a forest gives the
    candidate rules, a logistic regression with L1 penalty their weights; rules of weight 0 go.

    All labelled rows are used; Spark ML aggregates over them, and the driver sees trees and weights only. With one
    class the model is a constant; without rows the score is 0.5.
    """
    labelled = rows.where(quoted(label).isin(0, 1)).select(quoted(label).cast("double").alias("label"), *[statistic(s).alias(s) for s in STATISTICS])
    labelled = stage(labelled, "labelled")
    classes = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(classes) < 2:
        return Rules(0.0 if not classes else 10.0 if 1.0 in classes else -10.0, [])
    vectors = labelled.withColumn("features", array_to_vector(F.array(*STATISTICS)))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, subsamplingRate=0.7, featureSubsetStrategy="onethird", maxMemoryInMB=64).fit(vectors)
    rules = tree_paths(forest.toDebugString)
    if not rules:
        return Rules(math.log(classes[1.0] / classes[0.0]), [])
    held = F.array(*[rule_column(r, F.col).cast("double") for r in rules])
    fitted = LogisticRegression(regParam=lasso, elasticNetParam=1.0, standardization=False, maxIter=60).fit(labelled.select("label", array_to_vector(held).alias("features")))
    weights = fitted.coefficients.toArray()
    return Rules(float(fitted.intercept), [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w])


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(doc_id, score) of every row, with the model learnt from ``labels`` (doc_id, label).

    Only the statistics of the text enter. Null and empty texts have all statistics zero and get the score of that
    point. Rows without a ``doc_id`` are scored, but not learnt from; a ``doc_id`` with several labels counts once per
    label; repeated rows give repeated results. The texts are read once, for narrow staged rows.
    """
    wide = with_statistics(docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")), "statistics")
    rows = stage(wide.select("doc_id", "statistics.*"), "statistics")
    model = learn(rows.join(labels.select(F.col("doc_id"), quoted(label).alias("label")), "doc_id"), "label")
    return rows.select("doc_id", model.score(F.col).alias("score"))
