"""Rankings, budgets, calibration bins and ranking metrics.

All of them need a position in one global order. ``running`` gives it without a
single-task window; everything after it is a map-side combined aggregate.
Ties are always broken by the entity's key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opspark.functions.columns import flag_sum
from opspark.operators.scan import HOT_ROWS, Measure, running
from opspark.operators.selection import order_statistics
from opspark.session import cut

# Shares of the population a team may contact, and the cut-points tried.
BUDGETS = (0.05, 0.10, 0.20, 0.25, 0.50)
CUTS_PERCENT = range(5, 96)


def budget_size(share: float | Column, n: Column) -> Column:
    """Entities in a share of the population: halves round up, never fewer than one."""
    share = share if isinstance(share, Column) else F.lit(float(share))
    return F.greatest(F.floor(share * n + 0.5), F.lit(1)).cast("bigint")


def bin_of(rank: Column, n: Column, bins: int) -> Column:
    """Equal-count bin of a row by its rank; the first n mod bins bins get one more."""
    size = F.floor(n / bins)
    extra = n - size * bins
    head = extra * (size + 1)
    return F.when(rank <= head, F.floor((rank - 1) / (size + 1)) + 1).otherwise(
        extra + F.floor((rank - 1 - head) / F.greatest(size, F.lit(1))) + 1).cast("int")


def reliability(df: DataFrame, y: str, p: str, key: Sequence[str],
                bins: int = 10) -> tuple[DataFrame, DataFrame]:
    """Equal-count bins by predicted probability, and their one-row summary.

    deviation is mean predicted minus observed; the summary has the largest
    absolute deviation, the row-weighted mean one (ece) and the squared error.
    """
    ranked = running(df.select(y, p, *key), [F.col(p), *key], [
        Measure("_rank", "count"), Measure("_all", "count", total=True)])
    table = (ranked.groupBy(bin_of(F.col("_rank"), F.col("_all"), bins).alias("bin")).agg(
        F.count("*").alias("n"), F.min(p).alias("p_low"), F.max(p).alias("p_high"),
        F.avg(p).alias("mean_predicted"), F.avg(y).alias("observed"),
        F.sum((F.col(p) - F.col(y)) * (F.col(p) - F.col(y))).alias("squared"))
        .withColumn("deviation", F.col("mean_predicted") - F.col("observed")))
    size = F.abs(F.col("deviation"))
    summary = table.agg(
        F.max(size).alias("max_abs_deviation"),
        (F.sum(size * F.col("n")) / F.sum("n")).alias("ece"),
        (F.sum("squared") / F.sum("n")).alias("brier"),
        (F.sum(F.col("mean_predicted") * F.col("n")) / F.sum("n")).alias("mean_predicted"),
        (F.sum(F.col("observed") * F.col("n")) / F.sum("n")).alias("observed_rate"),
        F.sum("n").alias("n"))
    return table.drop("squared"), summary


def roc_auc(df: DataFrame, y: str, p: str, by: Sequence[str] = (),
            hot_rows: int = HOT_ROWS) -> DataFrame:
    """Area under the ROC curve by average rank, exact under ties, per group.

    Rows of one score are counted together first, so ties cost nothing.
    """
    by = list(by)
    levels = df.groupBy(*by, p).agg(F.count("*").alias("_n"), F.sum(y).alias("_pos"))
    scanned = running(levels, [p], [Measure("_before", "sum", "_n", inclusive=False)],
                      by=by, hot_rows=hot_rows)
    twice_rank = F.coalesce("_before", F.lit(0)) * 2 + F.col("_n") + 1
    s = scanned.groupBy(*by).agg(
        F.sum("_n").alias("n"), F.sum("_pos").alias("positives"),
        F.sum(F.col("_pos") * twice_rank).alias("_ranks"))
    return s.withColumn("roc_auc", _auc()).drop("_ranks")


def _auc() -> Column:
    """From n, positives and twice the rank sum of the positives; null with one class only."""
    pos, n = F.col("positives"), F.col("n")
    pairs = pos * (n - pos)
    return F.when(pairs > 0, (F.col("_ranks") - pos * (pos + 1)) / (pairs * 2))


def rank_auc(df: DataFrame, y: str, p: str, key: Sequence[str], by: Sequence[str] = (),
             hot_rows: int = HOT_ROWS) -> DataFrame:
    """ROC-AUC and average precision (hits so far over rank, at every hit), per group."""
    by = list(by)
    ranked = running(df.select(*by, *[k for k in key if k not in by], y, p), [F.desc(p), *key], [
        Measure("_rank", "count"), Measure("_hits", "sum", y),
        Measure("_all", "count", total=True)], by=by, hot_rows=hot_rows)
    # One row per score: its rows hold ranks (last - n + 1)..last from the top, so
    # their average rank from the bottom is all + 1 minus the middle of those.
    levels = ranked.groupBy(*by, p).agg(
        F.count("*").alias("_n"), F.sum(y).alias("_pos"), F.max("_rank").alias("_last"),
        F.max("_all").alias("_all"),
        F.sum(F.when(F.col(y) == 1, F.col("_hits") / F.col("_rank"))).alias("_ap"))
    twice_rank = (F.col("_all") + 1) * 2 - (F.col("_last") * 2 - F.col("_n") + 1)
    s = levels.groupBy(*by).agg(
        F.sum("_n").alias("n"), F.sum("_pos").alias("positives"),
        F.sum(F.col("_pos") * twice_rank).alias("_ranks"), F.sum("_ap").alias("_ap"))
    pos = F.col("positives")
    return s.withColumn("roc_auc", _auc()).withColumn(
        "avg_precision", F.when(pos > 0, F.col("_ap") / pos)).drop("_ranks", "_ap")


def budget_curve(df: DataFrame, y: str, score: str, key: Sequence[str],
                 budgets: Sequence[float] = BUDGETS) -> DataFrame:
    """For each budget: contacted, hits, precision, recall and lift over chance.

    The highest scores are contacted first, ties in the order of the key, nulls last.
    """
    # The score at the last contacted rank is selected; only rows that tie with it are ordered.
    rows = cut(df.select(y, F.col(score).cast("double").alias("_s"), *key))
    size = rows.agg(F.count("*").alias("n"), F.count("_s").alias("known"), F.sum(y).alias("positives")).first()
    sizes = rows.sparkSession.range(1).select(*[
        budget_size(b, F.lit(size.n)).alias(f"b{i}") for i, b in enumerate(budgets)]).first()
    lowest = order_statistics(rows, {"_s": [size.known - k + 1 for k in sizes if k > 0]})
    marks = [lowest.get(("_s", size.known - k + 1)) for k in sizes]  # null: nulls come last
    higher = [F.col("_s").isNotNull() if m is None else F.col("_s") > m for m in marks]
    one = rows.agg(*[flag_sum(h).alias(f"_above{i}") for i, h in enumerate(higher)],
                   *[flag_sum(h & (F.col(y) == 1)).alias(f"_sure{i}") for i, h in enumerate(higher)]).first()
    real = [m for m in dict.fromkeys(marks) if m is not None]
    ties = rows.filter(F.col("_s").isin(real) | (F.lit(None in marks) & F.col("_s").isNull()))
    ranked = running(ties, list(key), [Measure("_rank", "count")], by=["_s"])
    tied = ranked.agg(*[flag_sum(
        F.col("_s").eqNullSafe(F.lit(m).cast("double")) & (F.col("_rank") <= k - one[f"_above{i}"])
        & (F.col(y) == 1)).alias(f"_tied{i}") for i, (k, m) in enumerate(zip(sizes, marks))])
    one = tied.select(F.lit(size.n).alias("n"), F.lit(size.positives).alias("positives"), *[
        (F.coalesce(f"_tied{i}", F.lit(0)) + F.coalesce(F.lit(one[f"_sure{i}"]), F.lit(0))).alias(f"_hits{i}")
        for i in range(len(sizes))])
    rows = F.explode(F.array(*[
        F.struct(F.lit(float(b)).alias("budget"), F.col(f"_hits{i}").alias("hits"))
        for i, b in enumerate(budgets)]))
    n, pos, k = F.col("n"), F.col("positives"), F.col("contacted")
    return (one.select("n", "positives", rows.alias("r")).select("n", "positives", "r.*")
            .withColumn("contacted", budget_size(F.col("budget"), n))
            .withColumn("precision", F.col("hits") / k)
            .withColumn("recall", F.when(pos > 0, F.col("hits") / pos))
            .withColumn("lift", F.when(pos > 0, F.col("precision") / (pos / n)))
            .drop("n", "positives"))


def group_budgets(df: DataFrame, y: str, score: str, key: Sequence[str], by: Sequence[str],
                  budgets: Sequence[float] = BUDGETS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``budget_curve`` inside every group: each gets its own share of contacts.

    All groups and budgets are counted in one ranked pass; a group above ``hot_rows`` is
    ranked in blocks.
    """
    by = list(by)
    ranked = running(df.select(*by, y, score, *[k for k in key if k not in by]),
                     [F.desc(score), *[F.col(k) for k in key]], [
        Measure("_rank", "count"), Measure("_all", "count", total=True)], by=by, hot_rows=hot_rows)
    one = ranked.groupBy(*by).agg(F.max("_all").alias("n"), F.sum(y).alias("positives"), *[
        flag_sum((F.col("_rank") <= budget_size(b, F.col("_all"))) & (F.col(y) == 1)).alias(f"_hits{i}")
        for i, b in enumerate(budgets)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(float(b)).alias("budget"), F.col(f"_hits{i}").alias("hits"))
        for i, b in enumerate(budgets)]))
    pos, share = F.col("positives"), F.col("hits") / F.col("contacted")
    return (one.select(*by, "n", "positives", rows.alias("r")).select(*by, "n", "positives", "r.*")
            .withColumn("contacted", budget_size(F.col("budget"), F.col("n")))
            .withColumn("precision", share)
            .withColumn("recall", F.when(pos > 0, F.col("hits") / pos))
            .withColumn("lift", F.when(pos > 0, share / (pos / F.col("n")))).drop("n", "positives"))


def _cut_index(score: Column) -> Column:
    """The largest whole percent not above the score, safe against x*100 rounding."""
    guess = F.floor(score * 100)
    return (F.when(score >= (guess + 1) / 100.0, guess + 1)
            .when(score < guess / 100.0, guess - 1).otherwise(guess))


def threshold_table(df: DataFrame, y: str, score: str, by: Sequence[str] = (),
                    cuts: Sequence[int] = CUTS_PERCENT) -> DataFrame:
    """Confusion counts at every whole-percent cut-point.

    One aggregate puts each score at the highest cut it reaches; the counts at a
    cut are then sums over that short table. Work does not grow with the cuts.
    """
    by, low, high = list(by), min(cuts), max(cuts)
    idx = F.greatest(F.least(_cut_index(F.col(score)), F.lit(high)), F.lit(low - 1)).cast("int")
    reached = df.groupBy(*by, idx.alias("_idx")).agg(
        F.count("*").alias("_n"), F.sum(y).alias("_pos"))
    # Each reached index feeds every cut at or below it: at most len(cuts) rows each.
    spread = reached.withColumn("_cut", F.explode(F.sequence(F.lit(low), F.lit(high))))
    at = F.col("_idx") >= F.col("_cut")
    return spread.groupBy(*by, "_cut").agg(
        F.sum(F.when(at, F.col("_pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(at, F.col("_n") - F.col("_pos")).otherwise(0)).alias("fp"),
        F.sum(F.when(~at, F.col("_n") - F.col("_pos")).otherwise(0)).alias("tn"),
        F.sum(F.when(~at, F.col("_pos")).otherwise(0)).alias("fn"))


def best_f1(df: DataFrame, y: str, score: str, by: Sequence[str] = (),
            cuts: Sequence[int] = CUTS_PERCENT) -> DataFrame:
    """The cut-point with the best F1; the lowest one wins a tie."""
    from opspark.operators.metrics import with_rates

    table = with_rates(threshold_table(df, y, score, by, cuts))
    best = table.groupBy(*by).agg(F.max_by(
        F.struct((F.col("_cut") / 100.0).alias("threshold"), "tp", "fp", "tn", "fn",
                 "precision", "recall", "f1"),
        F.struct("f1", (-F.col("_cut")).alias("c"))).alias("b"))
    return best.select(*by, "b.*")


def with_positions(df: DataFrame, orders: Mapping[str, str], key: Sequence[str],
                   totals: Sequence[Measure] = ()) -> DataFrame:
    """One global position column per named order (descending, ties by key)."""
    for name, col in orders.items():
        df = running(df, [F.desc(col), *key], [Measure(f"pos_{name}", "count"), *totals])
        totals = ()
    return df


def ranking_comparison(df: DataFrame, orders: Mapping[str, str], key: Sequence[str],
                       loss: str, value: str, label: str, budget: float = 0.1) -> DataFrame:
    """Lists of one size by several orders: what each reaches, and its overlap with the first."""
    names = list(orders)
    used = list(dict.fromkeys([*key, *orders.values(), loss, value, label]))
    ranked = with_positions(df.select(*used), orders, key, [
        Measure("_all", "count", total=True), Measure("_total", "sum", loss, total=True)])
    ranked = ranked.withColumn("_k", budget_size(budget, F.col("_all")))
    ranked = ranked.withColumns({f"_in_{n}": F.col(f"pos_{n}") <= F.col("_k") for n in names})
    first, fields = F.col(f"_in_{names[0]}"), ("reached", "realised", "hits", "contacted", "shared")
    aggs = [F.max("_total").alias("_total")]
    for n in names:
        inside = F.col(f"_in_{n}")
        aggs += [
            F.sum(F.when(inside, F.col(loss))).alias(f"_{n}_reached"),
            F.sum(F.when(inside, F.col(value) * F.col(label))).alias(f"_{n}_realised"),
            F.sum(F.when(inside, F.col(label))).alias(f"_{n}_hits"),
            flag_sum(inside).alias(f"_{n}_contacted"),
            flag_sum(inside & first).alias(f"_{n}_shared")]
    rows = F.explode(F.array(*[F.struct(
        F.lit(n).alias("ranked_by"), *[F.col(f"_{n}_{f}").alias(f) for f in fields])
        for n in names]))
    one = ranked.agg(*aggs).select("_total", rows.alias("r")).select("_total", "r.*")
    total = F.col("_total")
    return (one.withColumn("share_of_total", F.when(total != 0, F.col("reached") / total))
            .withColumn("precision", F.col("hits") / F.col("contacted"))
            .withColumn("overlap", F.col("shared") / F.col("contacted")).drop("_total"))


def reach_curve(df: DataFrame, order: str, key: Sequence[str], loss: str,
                points: int = 121) -> DataFrame:
    """Loss reached at evenly spaced depths of a ranking, from 0 to everyone."""
    used = list(dict.fromkeys([*key, order, loss]))
    ranked = running(df.select(*used), [F.desc(order), *key], [
        Measure("_rank", "count"), Measure("reached", "sum", loss),
        Measure("_all", "count", total=True)])
    # The point whose depth is nearest to this rank, and the few beside it: a row
    # knows which points sample it, so nothing is joined.
    n, steps = F.col("_all"), points - 1
    near = F.round(F.col("_rank") * steps / n).cast("int")
    spread = F.ceil(F.lit(steps) / n).cast("int") + 1
    point = F.explode(F.sequence(F.greatest(near - spread, F.lit(1)),
                                 F.greatest(F.least(near + spread, F.lit(steps)), F.lit(1))))
    sampled = ranked.withColumn("point", point).filter(
        F.col("_rank") == F.least(F.greatest(
            F.floor(F.col("point") * n / steps + 0.5), F.lit(1)), n))
    curve = sampled.select("point", F.col("_rank").alias("depth"),
                           (F.col("_rank") / n).alias("share"), "reached")
    origin = df.sparkSession.range(1).select(F.lit(0).alias("point"), F.lit(0).alias("depth"),
                                             F.lit(0.0).alias("share"), F.lit(0).alias("reached"))
    return curve.unionByName(origin)


def order_dimension(df: DataFrame, dim: str, value: str) -> DataFrame:
    """Index of each dimension value, 0 for the one holding most of the value."""
    sums = df.groupBy(dim).agg(F.sum(value).alias("value"))
    ranked = running(sums, [F.desc("value"), dim], [Measure("_rank", "count")])
    return ranked.select(dim, "value", (F.col("_rank") - 1).cast("int").alias("index"))


def top_k(df: DataFrame, order: str, key: Sequence[str], k: int) -> DataFrame:
    """The k highest rows, ties by key: each task keeps k, one merge."""
    return df.orderBy(F.desc(order), *key).limit(k)


def list_overlap(df: DataFrame, order_a: str, order_b: str, key: Sequence[str],
                 k: int) -> DataFrame:
    """How many entities two top-k lists share."""
    a = top_k(df.select(*key, order_a), order_a, key, k).select(*key)
    b = top_k(df.select(*key, order_b), order_b, key, k).select(*key)
    return a.intersect(b).agg(F.count("*").alias("shared")).withColumn(
        "share", F.col("shared") / F.lit(k))


def recency_baseline(df: DataFrame, label: str, recency: str, key: Sequence[str],
                     rules: Sequence[int] = (1, 2, 3, 5)) -> DataFrame:
    """What needs no model: flag everyone, and flag who was last seen n days ago."""
    from opspark.operators.metrics import with_rates

    y, r = F.col(label), F.col(recency)
    names = {"everyone": F.lit(True), **{f"recency >= {n}": r >= n for n in rules}}
    one = df.agg(*[F.struct(
        flag_sum(c & (y == 1)).alias("tp"), flag_sum(c & (y == 0)).alias("fp"),
        flag_sum(~c & (y == 0)).alias("tn"), flag_sum(~c & (y == 1)).alias("fn")).alias(n)
        for n, c in names.items()])
    return with_rates(one.unpivot([], list(names), "rule", "s").select("rule", "s.*"))
