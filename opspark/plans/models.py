"""MLlib plans: preparation, classifiers, regressors, evaluation, ablation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import (
    Bucketizer, Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler)
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opspark.functions.columns import invert_log, log_target, positive_probability
from opspark.operators.joins import group_mean_baseline
from opspark.operators.metrics import class_weights, confusion, skill
from opspark.operators.ranking import best_f1, budget_curve, group_budgets, rank_auc
from opspark.session import cut, measured

SEED = 42

# Model sizes as (iterations or trees, depth).
FULL_SIZE = {"gbt": (120, 5), "forest": (150, 8), "tree": (1, 8)}
FULL_REGRESSION = {"gbt": (60, 5), "forest": (100, 10), "tree": (1, 8)}
BINS = 32  # values of a feature that MLlib's trees tell apart (its maxBins)
PIECES = 4  # rows of training, at most, for the rows that fall into the same bins


def as_doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def numeric_pipeline(cols: Sequence[str], indicators: Sequence[str] = (),
                     dummies: Sequence[str] = (), scale: bool = False, out: str = "features",
                     median_error: float = 0.001) -> tuple[Pipeline, list[str]]:
    """Gaps filled with medians, one vector, on request centred and scaled; and the slot names.

    ``median_error`` is the rank error that MLlib's median may have.
    """
    filled = {c: f"{c}_i" for c in cols}
    slots = [*filled.values(), *indicators, *dummies]
    vector = "raw_vector" if scale else out
    plan = [Imputer(inputCols=list(filled), outputCols=list(filled.values()), strategy="median",
                    relativeError=median_error), _assemble(slots, vector, handleInvalid="keep")]
    return Pipeline(stages=plan + ([_scaled(vector, out, centre=True)] if scale else [])), slots


def _assemble(slots: Sequence[str], out: str, **options) -> VectorAssembler:
    return VectorAssembler(inputCols=list(slots), outputCol=out, **options)


def _scaled(vector: str, out: str, centre: bool) -> StandardScaler:
    return StandardScaler(inputCol=vector, outputCol=out, withStd=True, withMean=centre)


def category_pipeline(cats: Sequence[str], nums: Sequence[str],
                      out: str = "features") -> Pipeline:
    """Categories by frequency and one-hot (unseen levels kept), numbers, scaled, not centred."""
    plan, vectors = [], [f"{c}_vec" for c in cats]
    for c, vec in zip(cats, vectors):
        plan += [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"),
                 OneHotEncoder(inputCol=f"{c}_idx", outputCol=vec)]
    return Pipeline(stages=[*plan, _assemble([*vectors, *nums], "raw_vector"),
                            _scaled("raw_vector", out, centre=False)])


# Tree models by task and kind, with the name of the parameter that counts trees.
TREES = {
    "classify": {"gbt": (GBTClassifier, "maxIter"), "forest": (RandomForestClassifier, "numTrees"),
                 "tree": (DecisionTreeClassifier, None)},
    "predict": {"gbt": (GBTRegressor, "maxIter"), "forest": (RandomForestRegressor, "numTrees"),
                "tree": (DecisionTreeRegressor, None)},
}


def _trees(task: str, kind: str, size: Mapping[str, tuple[int, int]], **columns):
    if kind not in TREES[task]:
        raise ValueError(f"unknown model {kind}")
    make, counted = TREES[task][kind]
    trees, depth = size[kind]
    return make(maxDepth=depth, seed=SEED, **({counted: trees} if counted else {}), **columns)


def classifier(kind: str, size: Mapping[str, tuple[int, int]] = FULL_SIZE,
               weight: str | None = None, label: str = "label", features: str = "features"):
    """logistic, gbt, forest or tree."""
    columns = {"featuresCol": features, "labelCol": label,
               **({"weightCol": weight} if weight else {})}
    if kind == "logistic":
        return LogisticRegression(regParam=0.01, **columns)
    return _trees("classify", kind, size, **columns)


def bin_edges(df: DataFrame, cols: Sequence[str]) -> dict[str, list[float]]:
    """Where the bins of each column begin: at its values, if they are few, else at quantiles."""
    inf = float("inf")
    about = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    edges = {}
    for c in cols:
        if about[c] <= 2 * BINS:
            values = sorted(r[0] for r in df.select(c).distinct().dropna().collect())
            if len(values) <= BINS:
                edges[c] = values
                continue
        edges[c] = df.stat.approxQuantile(c, [i / BINS for i in range(BINS)], 0.001)
    # The first bin goes on downwards; a column without values has one bin.
    return {c: [-inf, *sorted({v for v in found[1:] if v == v and abs(v) < inf}), inf]
            for c, found in edges.items()}


def binned(cols: Sequence[str], edges: Mapping[str, Sequence[float]], out: str) -> PipelineModel:
    """A vector of the numbers of the bins that ``cols`` fall into."""
    names = {c: f"{c}_bin" for c in cols}
    return PipelineModel(stages=[
        Bucketizer(inputCols=list(names), outputCols=list(names.values()), handleInvalid="keep",
                   splitsArray=[list(edges[c]) for c in cols]),
        _assemble(list(names.values()), out, handleInvalid="keep")])


def bin_cells(train: DataFrame, label: str, features: str = "features") -> DataFrame:
    """Rows in the same bins as at most ``PIECES`` rows: features, weight w and mean label.

    Trees can't tell rows in the same bins apart, and what the labels of a cell vary by
    among themselves is the same on both sides of any split: a fit on the cells finds the
    splits of a fit on all rows. Bootstraps draw pieces, not rows.
    """
    piece = F.monotonically_increasing_id() % PIECES
    return train.groupBy(features, piece.alias("_piece")).agg(
        F.count(label).cast("double").alias("w"), F.avg(label).alias(label)).drop("_piece")


def regressor(kind: str, size: Mapping[str, tuple[int, int]] = FULL_REGRESSION,
              label: str = "label", features: str = "features", reg: float = 0.0,
              weight: str | None = None):
    """linear (ridge with ``reg``), gbt, forest or tree."""
    columns = {"featuresCol": features, "labelCol": label,
               **({"weightCol": weight} if weight else {})}
    if kind == "linear":
        return LinearRegression(regParam=reg, **columns)
    return _trees("predict", kind, size, **columns)


def assert_no_leak(features: Sequence[str], forbidden: Sequence[str]) -> None:
    """Refuse features that are the label or from which it can be worked out."""
    leaked = sorted(set(features) & set(forbidden))
    if leaked:
        raise ValueError(f"features leak the label: {leaked}")


def fit_classifier(train: DataFrame, kind: str, cols: Sequence[str],
                   indicators: Sequence[str] = (), dummies: Sequence[str] = (),
                   label: str = "label", weighted: bool = True,
                   size: Mapping[str, tuple[int, int]] = FULL_SIZE, *,
                   forbidden: Sequence[str]) -> tuple[PipelineModel, list[str]]:
    """Prepare and fit on ``train``; balanced weights come from it alone.

    ``forbidden`` names the columns that give the label away; every caller has to
    say which they are.
    """
    assert_no_leak(cols, forbidden)
    prep, slots = numeric_pipeline(cols, indicators, dummies, scale=kind == "logistic")
    if weighted:
        train = class_weights(train, label)
    est = classifier(kind, size, "w" if weighted else None, label)
    return Pipeline(stages=[*prep.getStages(), est]).fit(train), slots


def side_by_side(df: DataFrame, jobs: Sequence[Callable]) -> list:
    """What each job returns. They run at once, as fits in a cross-validation do: a fit is many
    short stages, and while one waits for its last task the others use the free cores."""
    if not jobs:
        return []
    with ThreadPool(len(jobs)) as pool:
        return pool.map(lambda job: inheritable_thread_target(df.sparkSession)(job)(), jobs)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str],
          out: str = "risk") -> DataFrame:
    """One row per entity with its probability, not rounded."""
    return model.transform(df).select(*keep, positive_probability().alias(out))


def scorecard(scored: DataFrame, label: str, p: str, key: Sequence[str],
              by: str | None = None) -> DataFrame:
    """Every metric of a scored table in long form (metric, slice, value).

    With ``by`` the same metrics also come per group (a budget's slice is group@budget).
    """
    flat = ("tp", "fp", "tn", "fn", "precision", "recall", "f1", "accuracy", "specificity")

    def long(df: DataFrame, prefix: str, cols: Sequence[str], slice_col=None) -> DataFrame:
        s = F.col(slice_col).cast("string") if slice_col else F.lit("all")
        wide = df.select(s.alias("slice"), *[F.col(c).cast("double").alias(prefix + c)
                                            for c in cols])
        return wide.unpivot(["slice"], [prefix + c for c in cols], "metric", "value").select(
            "metric", "slice", "value")

    ranking = ["roc_auc", "avg_precision", "positives", "n"]
    parts = [
        long(rank_auc(scored, label, p, key), "", ranking),
        long(confusion(scored.withColumn("_pred", (F.col(p) >= 0.5).cast("int")), label,
                       "_pred"), "at_half_", flat),
        long(best_f1(scored, label, p), "best_", ["threshold", "precision", "recall", "f1"]),
        long(budget_curve(scored, label, p, key), "budget_",
             ["contacted", "hits", "precision", "recall", "lift"], "budget"),
        long(scored.agg(F.greatest(F.avg(label), 1 - F.avg(label)).alias("no_skill_accuracy")),
             "", ["no_skill_accuracy"]),
    ]
    if by:
        flagged = scored.withColumn("_pred", (F.col(p) >= 0.5).cast("int"))
        budgets = group_budgets(scored, label, p, key, [by]).withColumn(
            "_slice", F.concat_ws("@", by, "budget"))
        parts += [
            long(rank_auc(scored, label, p, key, [by]), "site_", ranking, by),
            long(confusion(flagged, label, "_pred", [by]), "site_at_half_", flat, by),
            long(best_f1(scored, label, p, [by]), "site_best_",
                 ["threshold", "precision", "recall", "f1"], by),
            long(budgets, "site_budget_", ["contacted", "hits", "precision", "recall", "lift"], "_slice")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def evaluate_regression(pred: DataFrame, y: str, p: str, baseline: str) -> DataFrame:
    """Skill against the stated baseline, with RMSE, MAE and R2 (against the mean)."""
    grand = pred.agg(F.avg(y).alias("m")).scalar()
    r2 = (pred.withColumn("_m", grand).agg(
        F.sum((F.col(y) - F.col(p)) * (F.col(y) - F.col(p))).alias("e"),
        F.sum((F.col(y) - F.col("_m")) * (F.col(y) - F.col("_m"))).alias("t"))
        .select(F.when(F.col("t") > 0, 1 - F.col("e") / F.col("t")).alias("r2")))
    return skill(pred, y, baseline, p).withColumn("r2", r2.scalar())


def importance(model: PipelineModel, slots: Sequence[str], df: DataFrame,
               sources: Mapping[str, str] | None = None) -> DataFrame:
    """Weight of each slot, and the column it came from; strongest first by size.

    The vector has one entry per feature, so it is read on the driver.
    """
    est = model.stages[-1]
    weights = est.coefficients if hasattr(est, "coefficients") else est.featureImportances
    sources = sources or {}
    rows = [(s, sources.get(s, s), float(w)) for s, w in zip(slots, weights.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, source string, weight double")


def vector_slots(df: DataFrame, col: str) -> list[str]:
    """Slot names of an assembled vector, in order, from its metadata."""
    attrs = df.schema[col].metadata["ml_attr"]["attrs"]
    named = [a for kind in attrs.values() for a in kind]
    return [a["name"] for a in sorted(named, key=lambda a: a["idx"])]


def importance_by_source(imp: DataFrame) -> DataFrame:
    """One-hot slots summed back to the column they came from, with their share."""
    table = measured(imp.groupBy("source").agg(F.sum(F.abs("weight")).alias("weight")))
    total = table.agg(F.sum("weight").alias("t")).scalar()
    return table.withColumn(
        "share", F.when(total > 0, F.col("weight") / total))


def ablation(df: DataFrame, label: str, key: Sequence[str],
             feature_sets: Mapping[str, Sequence[str]], kind: str = "gbt",
             size: Mapping[str, tuple[int, int]] = FULL_SIZE, *,
             forbidden: Sequence[str], leaky: Sequence[str] = ()) -> DataFrame:
    """The same model and split on several feature sets: what the leak is worth.

    ``df`` has a fold column. One fit per set, a handful of them. Only the sets
    named in ``leaky`` may use forbidden columns.
    """
    train, test = df.filter("fold = 'train'"), df.filter("fold = 'test'")

    def one(name: str, cols: Sequence[str]) -> DataFrame:
        model, _ = fit_classifier(train, kind, cols, label=label, size=size,
                                  forbidden=() if name in leaky else forbidden)
        scored = cut(score(model, test, [*key, label]))
        return rank_auc(scored, label, "risk", key).select(
            F.lit(name).alias("features"), F.lit(len(cols)).alias("n_features"),
            "roc_auc", "avg_precision")

    out = None
    for row in side_by_side(df, [partial(one, *named) for named in feature_sets.items()]):
        out = row if out is None else out.unionByName(row)
    return out


def target_models(df: DataFrame, targets: Mapping[str, str], cols: Sequence[str], group: str,
                  kind: str = "gbt", size: Mapping[str, tuple[int, int]] = FULL_REGRESSION,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Test rows in long form, one per target: task, group, truth, pred, baseline.

    ``df`` has a fold column and ``targets`` names each task's column. A task is fitted on
    the logarithm (of one plus the target) of the train rows that have a target of zero or
    more, and its predictions are turned back and held inside what train had. The baseline
    is the group's mean in train, or the mean of all where train lacks the group: nothing of
    a test row is used but its features. Trees are fitted on cells of binned features
    (``bin_cells``), so that their work follows the cells and not the rows.
    """
    prep, slots = numeric_pipeline(cols, scale=kind == "linear")
    ready = as_doubles(df, cols)
    ready = cut(prep.fit(ready.filter("fold = 'train'")).transform(ready))
    trees = kind != "linear"
    if trees:
        edges = bin_edges(ready.filter("fold = 'train'"), slots)
        ready = binned(slots, edges, "features").transform(ready.drop("features"))
    out = None
    for task, target in targets.items():
        rows = ready.filter(F.col(target) >= 0).withColumns(
            {"task": F.lit(task), "truth": F.col(target).cast("double"), "_log": log_target(target)})
        train, test = rows.filter("fold = 'train'"), rows.filter("fold = 'test'")
        span = train.agg(F.min("_log").alias("lo"), F.max("_log").alias("hi")).first()
        if span.lo is None:
            continue
        if trees:
            model = regressor(kind, size, "_log", weight="w").fit(cut(bin_cells(train, "_log")))
        else:
            model = regressor(kind, size, "_log", reg=0.1).fit(train)
        if trees:  # a cell's rows have one prediction
            seen = model.transform(test.select("features").distinct())
            pred = test.join(seen, "features")
        else:
            pred = model.transform(test)
        pred = pred.withColumn("pred", invert_log("prediction", *span))
        based = group_mean_baseline(train, pred, [group], "truth")
        part = based.select("task", group, *keep, "truth", "pred", "baseline")
        out = part if out is None else out.unionByName(part)
    return out
