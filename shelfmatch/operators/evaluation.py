"""Quality of the score against 0/1 labels."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.operators.ordered import running_totals

STEPS = 100


def labelled(pairs: DataFrame) -> DataFrame:
    return pairs.na.drop(subset=["label"])


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all columns the two tables have in common."""
    return left.join(right, [c for c in left.columns if c in right.columns])


def score_counts(scored: DataFrame) -> DataFrame:
    """(score, positives, rows) per distinct score: partial sums first, so equal scores are one row from here on."""
    return labelled(scored).groupBy("score").agg(
        F.sum(F.col("label").cast("bigint")).alias("positives"), F.count(F.lit(1)).alias("rows")
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve as the share of correctly ordered (positive, negative) pairs, ties counting half."""
    counts = score_counts(scored).withColumn("negatives", F.col("rows") - F.col("positives"))
    ranked = running_totals(counts, ["score"], {"negatives_upto": "negatives"})
    below = F.col("negatives_upto") - F.col("negatives") / 2
    positives, all_pairs = F.col("positives").cast("double"), F.sum("positives").cast("double") * F.sum("negatives")
    return ranked.agg((F.sum(positives * below) / F.nullif(all_pairs, F.lit(0.0))).alias("roc_auc"))


def pr_points(scored: DataFrame) -> DataFrame:
    """One point per distinct score, from the highest down, with the point before it; the first follows (0, 1)."""
    ranked = running_totals(score_counts(scored), [F.desc("score")], {"found": "positives", "taken": "rows"})
    positives = F.nullif(F.col("found_all"), F.lit(0))  # without any the recall is unknown
    before, taken_before = F.col("found") - F.col("positives"), F.col("taken") - F.col("rows")
    return ranked.select(
        "score",
        (F.col("found") / F.col("taken")).alias("precision"),
        (F.col("found") / positives).alias("recall"),
        F.when(taken_before > 0, before / taken_before).otherwise(F.lit(1.0)).alias("precision_before"),
        (before / positives).alias("recall_before"),
    )


def pr_curve(scored: DataFrame) -> DataFrame:
    """(score, precision, recall) per distinct score and the end point at recall 0, precision 1."""
    end = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("score"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return pr_points(scored).select("score", "precision", "recall").unionByName(end)


def pr_auc(scored: DataFrame) -> DataFrame:
    """Area under that curve by trapezoids."""
    width = F.col("recall") - F.col("recall_before")
    height = (F.col("precision") + F.col("precision_before")) / 2
    return pr_points(scored).agg(F.sum(width * height).alias("pr_auc"))


def _quality(tp, fp, fn):
    def part(numerator, denominator):
        return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))

    return {"precision": part(tp, tp + fp), "recall": part(tp, tp + fn), "f1": part(2 * tp, 2 * tp + fp + fn)}


def threshold_sweep(scored: DataFrame) -> DataFrame:
    """Precision, recall and F1 of ``score >= i * 0.01`` for i = 0..99.

    Each row is counted once in the highest step it reaches; the 100 steps are then summed from the top.
    """
    def reach(step):
        return step * F.lit(0.01)

    guess = F.floor(F.col("score") * STEPS)  # may be off by one where i * 0.01 is not exact
    step = F.when(reach(guess + 1) <= F.col("score"), guess + 1).when(reach(guess) > F.col("score"), guess - 1).otherwise(guess)
    step = F.least(F.greatest(step, F.lit(-1)), F.lit(STEPS - 1)).cast("int")
    cells = labelled(scored).groupBy(step.alias("step")).agg(
        F.count_if(F.col("label") == 1).alias("tp"), F.count_if(F.col("label") == 0).alias("fp")
    )
    steps = scored.sparkSession.range(-1, STEPS, 1, 1).select(F.col("id").cast("int").alias("step"))
    upward = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)  # over 101 rows
    whole = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = steps.join(F.broadcast(cells), "step", "left").na.fill(0)  # at most 101 groups
    summed = filled.select(
        "step", F.sum("tp").over(upward).alias("tp"), F.sum("fp").over(upward).alias("fp"), F.sum("tp").over(whole).alias("p")
    )
    quality = _quality(F.col("tp"), F.col("fp"), F.col("p") - F.col("tp"))
    return summed.where(F.col("step") >= 0).select(
        "step", reach(F.col("step")).alias("threshold"), *[column.alias(name) for name, column in quality.items()]
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    return sweep.orderBy(F.desc("f1"), "step").limit(1)


def sweep_tail(sweep: DataFrame, rows=40) -> DataFrame:
    return sweep.where(F.col("step") >= STEPS - rows)


def confusion_at(scored: DataFrame, threshold: float) -> DataFrame:
    """Counts and metrics of ``score >= threshold`` in one pass; an unknown score is no hit."""
    hit, positive = F.coalesce(F.col("score") >= F.lit(threshold), F.lit(False)), F.col("label") == 1
    counts = labelled(scored).agg(
        F.count_if(hit & positive).alias("tp"), F.count_if(hit & ~positive).alias("fp"), F.count_if(~hit & positive).alias("fn")
    )
    return counts.withColumns(_quality(F.col("tp"), F.col("fp"), F.col("fn")))
