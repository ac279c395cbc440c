"""Scores of a binary classifier, exact under ties and without gathering the predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import settle
from ..plans.ordering import Ordered


def confusion_counts(predictions: DataFrame, label: str, predicted: str) -> dict[tuple[int, int], int]:
    """(actual, predicted) -> rows, empty cells included."""
    found = predictions.groupBy(F.col(label).cast("int").alias("a"), F.col(predicted).cast("int").alias("p")).count()
    cells = {(a, p): 0 for a in (0, 1) for p in (0, 1)}
    cells.update({(row["a"], row["p"]): row["count"] for row in found.collect()})
    return cells


def _twice_area(neg: str, tp: str, pos: str) -> Column:
    """Twice a score's part of the area, in decimals: the counts alone may fit a long, their product need not."""
    return F.col(neg).cast("decimal(18,0)") * (F.col(tp) * 2 - F.col(pos)).cast("decimal(19,0)")


def ranking_scores(predictions: DataFrame, label: str, score: str) -> tuple[float | None, float | None]:
    """Area under the ROC curve and average precision.

    Rows are first reduced to one per distinct score. The area counts, for each negative, the
    positives scored above it plus half of those scored equal; all of it in whole numbers.
    Average precision is the step sum over distinct scores, not the trapezoid area.
    """
    actual = F.col(label).cast("int")
    by_score = predictions.groupBy(F.col(score).alias("score")).agg(
        F.sum(actual).alias("pos"), F.sum(1 - actual).alias("neg")
    )
    ordered = Ordered(by_score, F.col("score").desc())
    curve = ordered.running_sums(ordered.rows, "score", {"tp": "pos", "fp": "neg"}, descending=True)
    sums = curve.agg(
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
        F.sum(_twice_area("neg", "tp", "pos")).alias("twice_area"),
        F.sum(F.col("pos") * F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))).alias("steps"),
    ).first()
    p, n = sums["p"] or 0, sums["n"] or 0
    if not p or not n:
        return None, (sums["steps"] / p if p else None)
    return float(sums["twice_area"]) / (2.0 * p * n), sums["steps"] / p


def report_rows(cells: dict[tuple[int, int], int]) -> list[tuple[str, float | None]]:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages."""
    total = sum(cells.values())
    rows: list[tuple[str, float | None]] = []
    per_class = {}
    for c in (0, 1):
        hit, said, support = cells[(c, c)], cells[(0, c)] + cells[(1, c)], cells[(c, 0)] + cells[(c, 1)]
        precision = hit / said if said else 0.0
        recall = hit / support if support else 0.0
        f1 = 2.0 * hit / (said + support) if said + support else 0.0
        per_class[c] = {"precision": precision, "recall": recall, "f1": f1, "support": float(support)}
        rows += [(f"{name}_{c}", value) for name, value in per_class[c].items()]
    rows.append(("accuracy", (cells[(0, 0)] + cells[(1, 1)]) / total if total else None))
    for name in ("precision", "recall", "f1"):
        values = [per_class[c][name] for c in (0, 1)]
        weights = [per_class[c]["support"] for c in (0, 1)]
        rows.append((f"macro_{name}", (values[0] + values[1]) / 2.0))
        weighted = values[0] * weights[0] + values[1] * weights[1]
        rows.append((f"weighted_{name}", weighted / total if total else None))
    rows += [
        ("true_negatives", float(cells[(0, 0)])),
        ("false_positives", float(cells[(0, 1)])),
        ("false_negatives", float(cells[(1, 0)])),
        ("true_positives", float(cells[(1, 1)])),
    ]
    return rows


def binary_metrics(predictions: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """metric, value: ranking scores (4 places), classification report and confusion matrix (6 places).

    A row is predicted positive when its score lies above the threshold.
    """
    said = (F.col(score) > threshold).cast("int").alias("__said")
    decided = settle(predictions.select(label, score, said))  # read by two jobs
    area, precision = ranking_scores(decided, label, score)
    rows = [("roc_auc", area, 4), ("avg_precision", precision, 4)]
    rows += [(name, value, 6) for name, value in report_rows(confusion_counts(decided, label, "__said"))]
    return metric_table(predictions, rows)


def metric_table(df: DataFrame, rows: list[tuple[str, float | None, int]]) -> DataFrame:
    made = df.sparkSession.createDataFrame(
        [(name, None if value is None else float(value), digits) for name, value, digits in rows],
        "metric string, value double, digits int",
    )
    return made.select("metric", _rounded(F.col("value"), F.col("digits")).alias("value"))


def _rounded(value: Column, digits: Column) -> Column:
    return F.when(digits == 4, F.round(value, 4)).otherwise(F.round(value, 6))
