"""Deployment gate: may the challenger replace the champion?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.metrics import auc_by, confusion_metrics

GATE_METRICS = ("f1", "roc_auc", "recall")


@dataclass(frozen=True)
class GateResult:
    should_deploy: bool
    reason: str
    challenger: dict[str, float | None]
    champion: dict[str, float | None]
    delta: dict[str, float | None]


def gate_sentence(challenger_f1: float, champion_f1: float, threshold: float) -> str:
    # Wording of the gate's verdict
    drop = champion_f1 - challenger_f1
    passed = drop <= threshold
    figures = f"Challenger F1={challenger_f1:.4f} vs Champion F1={champion_f1:.4f}"
    if passed:
        return f"Gate PASSED. {figures} (drop={drop:.4f} ≤ threshold={threshold})."
    return (
        f"Gate FAILED. {figures} (drop={drop:.4f} > threshold={threshold}). "
        "Challenger will NOT be promoted."
    )


def _side_metrics(scored: DataFrame, label: str, sides: dict[str, str]) -> dict[str, dict[str, float | None]]:
    """Metrics of each side's probability column: one pass for the counts of all sides, one for their areas."""
    pairs = [F.struct(F.lit(side).alias("side"), F.col(p).alias("prob")) for side, p in sides.items()]
    tall = scored.select(label, F.inline(F.array(*pairs)))
    counted = confusion_metrics(tall, F.col(label), (F.col("prob") > 0.5).cast("int"), ("side",)).collect()
    rows = {r.side: r for r in counted}
    areas = {r.side: r.roc_auc for r in auc_by(tall, label, "prob", ("side",)).collect()}
    found = {}
    for side in sides:
        row = rows.get(side)
        found[side] = {"f1": row.f1 if row else 0.0, "roc_auc": areas.get(side), "recall": row.recall if row else 0.0}
    return found


def evaluate_gate(
    scored: DataFrame,
    label: str,
    challenger_prob: str,
    champion_prob: str | None,
    threshold: float = 0.05,
) -> GateResult:
    """Compare two probability columns of one scored holdout.

    Passes when the challenger's F1 is at most `threshold` below the champion's, bound included. Without
    a champion its metrics count as zero, so a first deployment passes.
    """
    sides = {"challenger": challenger_prob} | ({"champion": champion_prob} if champion_prob else {})
    # the models' work behind the probabilities is done once; a lost block is computed again
    kept = scored.select(label, *sides.values()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = _side_metrics(kept, label, sides)
    finally:
        kept.unpersist()
    challenger, champion = found["challenger"], found.get("champion", dict.fromkeys(GATE_METRICS, 0.0))
    delta = {
        m: None if challenger[m] is None or champion[m] is None else challenger[m] - champion[m]
        for m in GATE_METRICS
    }
    passed = champion["f1"] - challenger["f1"] <= threshold
    reason = gate_sentence(challenger["f1"], champion["f1"], threshold)
    return GateResult(passed, reason, challenger, champion, delta)


def gate_rows(result: GateResult, df: DataFrame) -> DataFrame:
    """The verdict as one row per metric."""
    rows = [
        (result.should_deploy, result.reason, m, result.challenger[m], result.champion[m], result.delta[m])
        for m in GATE_METRICS
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "should_deploy boolean, reason string, metric string, challenger double, champion double, delta double",
    )


def require_passed(result: GateResult) -> None:
    if not result.should_deploy:
        raise ValueError(f"The challenger is not promoted. {result.reason}")
