"""Calibrate probabilities: refit without weights, then isotonic if still off."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.operators.isotonic import apply_pools, isotonic_pools
from opspark.operators.ranking import reliability
from opspark.plans.models import FULL_SIZE, fit_classifier, score, side_by_side
from opspark.session import cut

TOLERANCE = 0.03


def isotonic(train: DataFrame, df: DataFrame, label: str, p: str, out: str) -> DataFrame:
    """A monotone map from score to observed rate, learned on ``train`` only."""
    return apply_pools(df, isotonic_pools(train, p, label), p, out)


def calibrate(df: DataFrame, label: str, key: Sequence[str], cols: Sequence[str],
              indicators: Sequence[str] = (), dummies: Sequence[str] = (), tol: float = TOLERANCE,
              size: Mapping[str, tuple[int, int]] = FULL_SIZE, bins: int = 10, *,
              forbidden: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(scored table with risk_weighted, risk_uncal, risk_cal; report per stage and fold).

    ``df`` has a fold column. The weighted model is the one whose probabilities
    are off; the unweighted refit is used as it is when its worst bin on the test
    fold is within ``tol``, otherwise through an isotonic map learned on train.
    """
    train = df.filter("fold = 'train'")
    keep = [*key, "fold", label]

    def fit(balanced):
        return fit_classifier(train, "gbt", cols, indicators, dummies, label, balanced, size,
                              forbidden=forbidden)[0]

    weighted, plain = side_by_side(df, [partial(fit, True), partial(fit, False)])
    both = score(plain, weighted_scores(weighted, df), [*keep, "risk_weighted"], "risk_uncal")
    both = cut(both)
    test = both.filter("fold = 'test'")

    def stage(name, rows, p):
        return reliability(rows, label, p, key, bins)[1].select(F.lit(name).alias("stage"), "*")

    before, after = stage("weighted", test, "risk_weighted"), stage(
        "unweighted", test, "risk_uncal")
    worst = after.first()["max_abs_deviation"]
    if worst is not None and worst > tol:
        final = isotonic(both.filter("fold = 'train'"), both, label, "risk_uncal", "risk_cal")
        chosen = "isotonic"
    else:
        final, chosen = both.withColumn("risk_cal", F.col("risk_uncal")), "unweighted"
    report = before.unionByName(after)
    for fold in ("train", "test"):
        report = report.unionByName(stage(
            f"{chosen} {fold}", final.filter(F.col("fold") == fold), "risk_cal"))
    return final, report


def weighted_scores(model, df: DataFrame) -> DataFrame:
    """The input with the weighted model's risk beside it, its working columns dropped."""
    from opspark.functions.columns import positive_probability

    return model.transform(df).withColumn("risk_weighted", positive_probability()).select(
        *df.columns, "risk_weighted")
