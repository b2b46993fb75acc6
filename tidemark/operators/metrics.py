"""Quality of predictions: confusion counts, rates, area under the curve, class report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.quantiles import in_ranges

METRICS = ("accuracy", "precision", "recall", "f1")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    return counts.withColumn("_t", totals).select(
        label, "n", (F.col("_t.rows") / (F.col("_t.classes") * F.col("n"))).alias("weight")
    )


def _guarded(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def confusion_metrics(
    df: DataFrame, label: Column, predicted: Column, by: tuple[str, ...] = (), suffix: str = ""
) -> DataFrame:
    """tp, fp, fn, tn and the ratios made of them, in one aggregation; a division by zero gives zero.

    `label` and `predicted` are 0/1; rows without a label are left out.
    """
    yes, said = label == 1, predicted == 1
    counts = (
        df.where(label.isNotNull())
        .groupBy(*by)
        .agg(
            F.count_if(yes & said).alias("tp"),
            F.count_if(~yes & said).alias("fp"),
            F.count_if(yes & ~said).alias("fn"),
            F.count_if(~yes & ~said).alias("tn"),
        )
    )
    return with_ratios(counts, by, suffix)


def with_ratios(counts: DataFrame, by: tuple[str, ...] = (), suffix: str = "") -> DataFrame:
    """Counts `tp`, `fp`, `fn`, `tn` with the ratios made of them; a division by zero gives zero."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    ratios = {
        "accuracy": _guarded(tp + tn, tp + fp + fn + tn),
        "precision": _guarded(tp, tp + fp),
        "recall": _guarded(tp, tp + fn),
        "f1": _guarded(2 * tp, 2 * tp + fp + fn),
    }
    return counts.select(
        *by,
        *[F.col(c).alias(f"{c}{suffix}") for c in ("tp", "fp", "fn", "tn")],
        *[ratios[m].alias(f"{m}{suffix}") for m in METRICS],
    )


def roc_auc(df: DataFrame, label: str, probability: str) -> float | None:
    """Exact area under the ROC curve; None when only one class occurs."""
    row = auc_by(df.select(label, probability, F.lit(0).alias("_all")), label, probability, ("_all",)).first()
    return row.roc_auc if row else None


def auc_by(df: DataFrame, label: str, probability: str, by: tuple[str, ...], copies: str | None = None) -> DataFrame:
    """Exact area under the ROC curve of every group of `by` (at least one column) in one pass.

    Columns: the group, `positives`, `negatives`, `roc_auc` (null when only one class occurs). Rows without a label or
    probability are left out; a null key is a group like others. `copies` names a column that says how often a row stands.

    Equal scores are merged first. Scores are then dealt to sorted ranges; the negatives of a group before each range and
    those before each score within it give the pairs that are in order, ties counted half, in whole numbers. So a group
    of any size is spread over the ranges, and no task holds more than one.
    """
    by = list(by)
    n = (F.col(copies) if copies else F.lit(1)).cast("long")
    known = df.where(F.col(label).isNotNull() & F.col(probability).isNotNull())
    scores = (
        # -0.0 and 0.0 are one score
        known.select(*by, (F.col(probability).cast("double") + 0.0).alias("_p"), (F.col(label) == 1).alias("_yes"), n.alias("_n"))
        .groupBy(*by, "_p")
        .agg(*[F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0)).alias(name) for c, name in ((F.col("_yes"), "_pos"), (~F.col("_yes"), "_neg"))])
    )
    placed = in_ranges(scores, by, "_p")
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # at most a row per group and range
    ranges = (
        placed.groupBy(*by, "_range")
        .agg(F.sum("_neg").alias("_in_range"))
        .select(*[F.col(c).alias(f"_{c}") for c in [*by, "_range"]], F.coalesce(F.sum("_in_range").over(before), F.lit(0)).alias("_before"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*by, "_range"]]
    within = Window.partitionBy(*by, "_range").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_before") + F.coalesce(F.sum("_neg").over(within), F.lit(0))
    # twice the pairs in order: products may pass 64 bits
    whole = "decimal(38,0)"
    pairs = (F.col("_pos").cast("decimal(18,0)") * (2 * below + F.col("_neg")).cast("decimal(19,0)")).cast(whole)
    sums = placed.join(ranges, same).withColumn("_pairs", pairs).groupBy(*by).agg(
        F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), F.sum("_pairs").alias("_pairs")
    )
    area = F.col("_pairs").cast("double") / (2.0 * F.col("positives") * F.col("negatives"))
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return sums.select(*by, "positives", "negatives", F.when(both, area).alias("roc_auc"))


def class_report(df: DataFrame, label: Column, predicted: Column, names: tuple[str, str] = ("0", "1")) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    base = confusion_metrics(df, label, predicted)
    neg_precision = _guarded(F.col("tn"), F.col("tn") + F.col("fn"))
    neg_recall = _guarded(F.col("tn"), F.col("tn") + F.col("fp"))
    neg_f1 = _guarded(2 * F.col("tn"), 2 * F.col("tn") + F.col("fp") + F.col("fn"))
    n_pos, n_neg = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    n = n_pos + n_neg

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.cast("double").alias("precision"),
            recall.cast("double").alias("recall"),
            f1.cast("double").alias("f1"),
            support.alias("support"),
        )

    def macro(a: Column, b: Column) -> Column:
        return (a + b) / 2

    def weighted(a: Column, b: Column) -> Column:
        return _guarded(a * n_neg + b * n_pos, n)

    positives = tuple(F.col(m) for m in ("precision", "recall", "f1"))
    negatives = (neg_precision, neg_recall, neg_f1)
    accuracy = F.col("accuracy")
    return base.select(
        F.inline(
            F.array(
                line(names[0], *negatives, n_neg),
                line(names[1], *positives, n_pos),
                line("accuracy", accuracy, accuracy, accuracy, n),
                line("macro avg", *[macro(a, b) for a, b in zip(negatives, positives)], n),
                line("weighted avg", *[weighted(a, b) for a, b in zip(negatives, positives)], n),
            )
        )
    )


def metric_delta(challenger: DataFrame, champion: DataFrame) -> DataFrame:
    """Challenger minus champion per metric name, from two long (name, value) tables."""
    return challenger.select("name", F.col("value").alias("challenger")).join(
        champion.select("name", F.col("value").alias("champion")), "name"
    ).withColumn("delta", F.col("challenger") - F.col("champion"))


def rate_shift(
    before: DataFrame, after: DataFrame, positive: object, limit: float = 0.10, prediction: str = "prediction"
) -> DataFrame:
    """Predicted-positive rate of two scored tables, the absolute change, and whether it exceeds the limit."""
    hit = F.when(F.col(prediction).eqNullSafe(F.lit(positive)), 1.0).otherwise(0.0)
    both = before.select(F.lit(0).alias("side"), hit.alias("hit")).unionAll(
        after.select(F.lit(1).alias("side"), hit.alias("hit"))
    )
    rates = both.agg(
        F.avg(F.when(F.col("side") == 0, F.col("hit"))).alias("rate_before"),
        F.avg(F.when(F.col("side") == 1, F.col("hit"))).alias("rate_after"),
    )
    change = F.abs(F.col("rate_after") - F.col("rate_before"))
    return rates.withColumn("rate_change", change).withColumn("shifted", change > limit)
