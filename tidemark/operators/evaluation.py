"""Quality of scores against labels. Ranks come from counts per distinct score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import attach
from tidemark.functions.ranks import running_totals
from tidemark.functions.stats import as_rows


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def predicted(df: DataFrame, probability: str, threshold: float = 0.5, name: str = "prediction") -> DataFrame:
    return df.withColumn(name, (F.col(probability) >= threshold).cast("int"))


def outcome_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, fn, tn."""
    y, z = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(y & z).alias("tp"), F.count_if(~y & z).alias("fp"),
        F.count_if(y & ~z).alias("fn"), F.count_if(~y & ~z).alias("tn"),
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """`actual, predicted, members`, all four cells."""
    cells = outcome_counts(df, label, prediction)
    return cells.select(F.inline(F.array(*[
        F.struct(F.lit(y).alias("actual"), F.lit(z).alias("predicted"), F.col(c).alias("members"))
        for y, z, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ])))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, precision, recall, f1, after the four counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return outcome_counts(df, label, prediction).withColumns({
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    })


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """`class, precision, recall, f1, support` per class, then macro and weighted means and accuracy."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = (tp + fp + fn + tn).cast("double")
    classes = {"0": (tn, fn, fp, tn + fp), "1": (tp, fp, fn, tp + fn)}
    scores = {
        name: (_ratio(hit, hit + wrong), _ratio(hit, hit + missed),
               _ratio(2 * hit, 2 * hit + wrong + missed), support)
        for name, (hit, wrong, missed, support) in classes.items()
    }
    zero, one = scores["0"], scores["1"]
    macro = [(zero[i] + one[i]) / 2 for i in range(3)]
    weighted = [_ratio(zero[i] * zero[3] + one[i] * one[3], total) for i in range(3)]
    accuracy = _ratio(tp + tn, total)
    entries = {
        **scores,
        "accuracy": (accuracy, accuracy, accuracy, total),
        "macro avg": (*macro, total),
        "weighted avg": (*weighted, total),
    }
    typed = {k: (*v[:3], v[3].cast("double")) for k, v in entries.items()}
    return as_rows(
        outcome_counts(df, label, prediction), typed, ["class", "precision", "recall", "f1", "support"]
    )


def _class_totals(df: DataFrame, label: str, score: str) -> DataFrame:
    positive = (F.col(label) == 1).cast("long")
    return running_totals(df, score, {"positives": positive, "negatives": 1 - positive})


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """One row: share of (positive, negative) pairs the score orders rightly, ties counting half."""
    per_score = _class_totals(df, label, score)
    beaten = F.col("negatives_upto") - F.col("negatives") / 2
    sums = per_score.agg(
        F.sum(F.col("positives") * beaten).alias("_wins"),
        F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select("positives", "negatives", _ratio(F.col("_wins"), pairs).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """`threshold, tpr, fpr` for every distinct score, taking scores at or above as churn."""
    per_score = _class_totals(df, label, score)
    totals = df.agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_n")
    )
    tp = F.col("_p") - F.col("positives_upto") + F.col("positives")
    fp = F.col("_n") - F.col("negatives_upto") + F.col("negatives")
    return attach(per_score, totals).select(
        F.col(score).alias("threshold"), _ratio(tp, F.col("_p")).alias("tpr"),
        _ratio(fp, F.col("_n")).alias("fpr"),
    )


def translate(metrics: DataFrame) -> DataFrame:
    """What the metrics mean in members: caught, missed, false alerts, and one sentence."""
    caught = F.floor(F.round("recall", 4) * (F.col("tp") + F.col("fn"))).cast("long")
    flagged = F.col("tp") + F.col("fp")
    return metrics.withColumn("caught", caught).withColumns({
        "missed": F.col("tp") + F.col("fn") - F.col("caught"),
        "false_alerts": F.greatest(flagged - F.col("caught"), F.lit(0)),
        "summary": F.format_string(
            "Catches %.0f%% of churners | %.0f%% of churn alerts are correct | AUC %.2f",
            F.round("recall", 4) * 100, F.round("precision", 4) * 100, F.round("roc_auc", 4),
        ),
    })


def evaluate(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """All metrics of one scored table in one row."""
    hard = predicted(df, score)
    return classification_metrics(hard, label).crossJoin(
        F.broadcast(roc_auc(df, label, score).select("roc_auc"))
    )
