"""Ordered replay of an action log, uncalled excess, derived fee.

Verbs: post and ante (forced money), cbr (bet or raise TO a level of this
round), cc (check or call), f (fold), sm (show), board (opens the next round).

No state is carried in Python. Inside a round the level to match only rises, so
it is the running maximum of the raise targets; what an actor has in already is
the last amount they reached; and whether money came in before is known from the
least and greatest actor with money in. Each of these is a running measure, so a
transaction of any length can be replayed over several tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opspark.functions.columns import (
    DERIVED_FEE_CAP, DERIVED_FEE_FLOOR, DERIVED_FEE_TOLERANCE, as_col, flag_sum)
from opspark.operators.attribute import hot_totals
from opspark.operators.joins import skew_join
from opspark.operators.scan import HOT_ROWS, Measure, blocked, hot_keys, split_hot, windowed
from opspark.session import cut

# Names of the rounds; later rounds keep the last name.
ROUND_NAMES = ("preflop", "flop", "turn", "river")


@dataclass(frozen=True)
class LogColumns:
    txn: str = "txn"
    order: str = "order"
    actor: str = "actor"
    verb: str = "verb"
    target: str = "target"


def _verb(c: LogColumns, *verbs: str) -> Column:
    return F.col(c.verb).isin(*verbs)


def _replay(df: DataFrame, c: LogColumns, scan: Callable) -> DataFrame:
    target = F.col(c.target)
    df = df.withColumn("_board", F.when(_verb(c, "board"), 1).otherwise(0))
    df = scan(df, [c.txn], [c.order], [Measure("round", "sum", "_board")])
    raised_to = F.when(_verb(c, "post", "cbr"), target)
    df = scan(df.withColumn("_raised_to", raised_to), [c.txn, "round"], [c.order],
              [Measure("_level", "max", "_raised_to", inclusive=False)])
    df = df.withColumn("_level", F.coalesce("_level", F.lit(0)))
    reached = F.when(_verb(c, "post", "cbr"), target).when(_verb(c, "cc"), F.col("_level"))
    df = df.withColumn("_reached", reached)
    df = df.withColumn("_paying", F.when(F.col("_reached") > 0, F.col(c.actor)))
    df = scan(df, [c.txn, "round"], [c.order], [
        Measure("_least", "min", "_paying", inclusive=False),
        Measure("_greatest", "max", "_paying", inclusive=False)])
    df = scan(df, [c.txn, "round", c.actor], [c.order],
              [Measure("_own", "last", "_reached", inclusive=False)])
    own, actor = F.coalesce("_own", F.lit(0)), F.col(c.actor)
    amount = (F.when(_verb(c, "cbr", "cc"), F.col("_reached") - own)
              .when(_verb(c, "post", "ante"), target).otherwise(F.lit(0)))
    first_money = F.coalesce((F.col("_least") == actor) & (F.col("_greatest") == actor),
                             F.lit(True))
    df = df.withColumn("amount", amount)
    kind = (F.when(_verb(c, "cbr"), F.when(first_money & (target >= F.col("_level")), "bet")
                   .otherwise("raise"))
            .when(_verb(c, "cc"), F.when(F.col("amount") > 0, "call").otherwise("check"))
            .when(_verb(c, "f"), "fold").when(_verb(c, "sm"), "show")
            .otherwise(F.col(c.verb)))
    return df.withColumn("kind", kind).drop(
        "_board", "_raised_to", "_level", "_reached", "_paying", "_least", "_greatest", "_own")


def replay(actions: DataFrame, c: LogColumns = LogColumns(),
           hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds round, amount (money moved by the row) and kind.

    All windows of a transaction share one shuffle on its id. Transactions above
    ``hot_rows`` rows take the block form of the same scans.
    """
    hot = hot_keys(actions, [c.txn], hot_rows)
    if hot is None:
        return _replay(actions.repartition(F.col(c.txn)), c, windowed)
    cold_rows, hot_part = split_hot(actions, [c.txn], hot)
    return _replay(cold_rows.repartition(F.col(c.txn)), c, windowed).unionByName(
        _replay(hot_part, c, blocked))


def round_name(c: Column | str = "round") -> Column:
    out = F.when(as_col(c) == 0, ROUND_NAMES[0])
    for i, name in enumerate(ROUND_NAMES[1:-1], start=1):
        out = out.when(as_col(c) == i, name)
    return out.otherwise(ROUND_NAMES[-1])


def participant_actions(replayed: DataFrame, c: LogColumns = LogColumns()) -> DataFrame:
    """Per transaction and actor: contribution and what they chose to do."""
    chose = F.col("kind").isin("bet", "raise", "call")
    raised = F.col("kind").isin("bet", "raise")
    later = F.col("round") > 0
    return (replayed.filter(F.col(c.actor).isNotNull()).groupBy(c.txn, c.actor).agg(
        F.sum("amount").alias("contributed"),
        F.max(chose.cast("int")).cast("boolean").alias("voluntary"),
        F.max((raised & ~later).cast("int")).cast("boolean").alias("raised_first_round"),
        F.max((F.col("kind") == "fold").cast("int")).cast("boolean").alias("folded"),
        F.max((F.col("kind") == "show").cast("int")).cast("boolean").alias("showed"),
        flag_sum(raised & later).alias("later_bets"),
        flag_sum((F.col("kind") == "call") & later).alias("later_calls")))


def return_excess(df: DataFrame, txn: str, actor: str, amount: str,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Give the unmatched part of the largest contribution back to its owner.

    Adds invested, excess (what this row got back) and total. The top two rows
    per transaction are picked with a rank limit that runs before the shuffle;
    a transaction with one participant has nothing to return.
    """
    w = W.partitionBy(txn).orderBy(F.desc(amount), actor)
    top = (df.select(txn, actor, amount).withColumn("_r", F.row_number().over(w))
           .filter(F.col("_r") <= 2).groupBy(txn).agg(
               F.max(F.when(F.col("_r") == 1, F.col(amount))).alias("_top1"),
               F.max(F.when(F.col("_r") == 2, F.col(amount))).alias("_top2"),
               F.max(F.when(F.col("_r") == 1, F.col(actor))).alias("_owner")))
    sums = df.groupBy(txn).agg(F.sum(amount).alias("_sum"), F.count("*").alias("_n"))
    over = F.coalesce(F.col("_top1") - F.col("_top2"), F.lit(0))
    per = cut(sums.join(top, txn).select(txn, "_owner", "_n", over.alias("_over"),
                                         (F.col("_sum") - over).alias("total")))
    excess = F.when(F.col(actor) == F.col("_owner"), F.col("_over")).otherwise(F.lit(0))
    joined = skew_join(df, per, [txn], hot=hot_totals(per, txn, "_n", hot_rows))
    return (joined.withColumn("excess", excess)
            .withColumn("invested", F.col(amount) - F.col("excess"))
            .drop("_owner", "_over", "_n"))


def derive_fee(txns: DataFrame, total: str, payouts: str, cap: float = DERIVED_FEE_CAP,
               tol: float = DERIVED_FEE_TOLERANCE,
               floor: float = DERIVED_FEE_FLOOR) -> DataFrame:
    """fee = total - payouts where that residual can be a fee, else null.

    Accepted from -tol to the larger of cap*total and floor, and never below 0.
    """
    residual = F.round(F.col(total) - F.col(payouts), 4)
    accepted = ((F.col(payouts) > 0) & (residual >= -tol)
                & (residual <= F.greatest(F.col(total) * cap, F.lit(floor))))
    return txns.withColumn("fee", F.when(accepted, F.greatest(residual, F.lit(0.0))))


def net_result(parts: DataFrame, won: str, invested: str, unit: str | None = None,
               out: str = "net") -> DataFrame:
    """Result per participant, in the unit if given; null where no payout is recorded."""
    net = F.col(won) - F.col(invested)
    return parts.withColumn(out, net / F.col(unit) if unit else net)
