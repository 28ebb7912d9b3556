"""Ordered replay, excess and fee: hand-worked hands, and a plain fold on random logs."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opspark.operators.attribute import contribution_share
from opspark.operators.checks import check_zero_sum
from opspark.operators.replay import (
    derive_fee, net_result, participant_actions, replay, return_excess, round_name)

HAND_A = ["post 1 0.5", "post 2 1.0", "cbr 3 3.0", "f 1", "cc 2", "board", "cc 2", "cbr 3 4.0",
          "f 2"]
HAND_B = ["post 1 0.5", "post 2 1.0", "cc 1", "cc 2", "board", "cbr 2 2.0", "cbr 1 6.0", "cc 2",
          "board", "cc 2", "cc 1", "board", "cc 2", "cc 1", "sm 1", "sm 2"]
SCHEMA = "txn string, order int, actor int, verb string, target double"


def log(name, lines):
    out = []
    for i, line in enumerate(lines):
        verb, *rest = line.split()
        out.append((name, i, int(rest[0]) if rest else None, verb,
                    float(rest[1]) if len(rest) > 1 else None))
    return out


def hands(spark):
    return spark.createDataFrame(log("A", HAND_A) + log("B", HAND_B), SCHEMA)


@pytest.mark.parametrize("hot", [5, 12, 10_000])
def test_hands_worked_by_hand(spark, hot):
    got = replay(hands(spark), hot_rows=hot).filter("verb not in ('post', 'board')").orderBy(
        "txn", "order")
    by = {t: [(r["round"], r["kind"], r["amount"]) for r in got.collect() if r["txn"] == t]
          for t in "AB"}
    assert by["A"] == [(0, "raise", 3.0), (0, "fold", 0), (0, "call", 2.0), (1, "check", 0),
                       (1, "bet", 4.0), (1, "fold", 0)]
    assert by["B"] == [(0, "call", 0.5), (0, "check", 0), (1, "bet", 2.0), (1, "raise", 6.0),
                       (1, "call", 4.0), (2, "check", 0), (2, "check", 0), (3, "check", 0),
                       (3, "check", 0), (3, "show", 0), (3, "show", 0)]


def test_contributions_excess_fee_and_net(spark):
    done = participant_actions(replay(hands(spark)))
    parts = return_excess(done, "txn", "actor", "contributed")
    assert rows(parts, "txn", "actor", "contributed", "invested", "total") == [
        ("A", 1, 0.5, 0.5, 6.5), ("A", 2, 3.0, 3.0, 6.5), ("A", 3, 7.0, 3.0, 6.5),
        ("B", 1, 7.0, 7.0, 14.0), ("B", 2, 7.0, 7.0, 14.0)]
    won = spark.createDataFrame([("A", 1, 0.), ("A", 2, 0.), ("A", 3, 6.2), ("B", 1, 13.3),
                                 ("B", 2, 0.)], "txn string, actor int, won double")
    parts = net_result(parts.join(won, ["txn", "actor"]), "won", "invested")
    txns = derive_fee(parts.groupBy("txn").agg(F.max("total").alias("total"),
                                               F.sum("won").alias("paid")), "total", "paid")
    assert {r["txn"]: round(r["fee"], 6) for r in txns.collect()} == {"A": 0.3, "B": 0.7}
    assert all(r["ok"] for r in check_zero_sum(parts, txns, "txn", "net", "fee").collect())
    flags = {(r["txn"], r["actor"]): r for r in done.collect()}
    assert not flags["A", 1]["voluntary"] and flags["A", 1]["folded"]
    assert flags["A", 3]["raised_first_round"] and flags["A", 3]["later_bets"] == 1
    assert flags["B", 2]["later_calls"] == 1 and flags["B", 2]["showed"]


def test_fee_edges(spark):
    data = [("none", 5.0, 0.0), ("under", 100.0, 100.004), ("below", 100.0, 100.006),
            ("small", 0.1, 0.08), ("large", 100.0, 84.0)]
    df = derive_fee(spark.createDataFrame(data, "id string, total double, paid double"),
                    "total", "paid")
    got = {r["id"]: r["fee"] for r in df.collect()}
    assert got == {"none": None, "under": 0.0, "below": None, "small": 0.02, "large": None}


def test_one_participant_and_equal_split(spark):
    df = spark.createDataFrame([("t", 1, 5.0), ("u", 1, 0.0), ("u", 2, 0.0)],
                               "txn string, actor int, paid double")
    assert rows(return_excess(df, "txn", "actor", "paid"), "txn", "actor", "excess") == [
        ("t", 1, 0), ("u", 1, 0), ("u", 2, 0)]
    assert rows(contribution_share(df, "txn", "paid"), "txn", "actor", "share") == [
        ("t", 1, 1.0), ("u", 1, 0.5), ("u", 2, 0.5)]


def test_round_names(spark):
    df = spark.range(6).select(round_name("id").alias("r"))
    assert [r[0] for r in df.collect()] == ["preflop", "flop", "turn", "river", "river", "river"]


def fold(lines):
    """The same rules as a plain loop with mutable state."""
    out, stake = [], {}
    for _, order, actor, verb, target in lines:
        amount, kind = 0.0, verb
        if verb == "board":
            stake = {}
        elif verb == "post":
            amount, stake[actor] = target, target
        elif verb == "cbr":
            amount = target - stake.get(actor, 0.0)
            stake[actor] = target
            paying = sum(1 for v in stake.values() if v > 0)
            kind = "bet" if max(stake.values()) == target and paying <= 1 else "raise"
        elif verb == "cc":
            level = max(stake.values(), default=0.0)
            amount = level - stake.get(actor, 0.0)
            kind = "call" if amount > 0 else "check"
            if amount > 0:
                stake[actor] = level
        elif verb == "f":
            kind = "fold"
        out.append((order, kind, amount))
    return out


@pytest.mark.parametrize("hot", [15, 10_000])
def test_random_logs_against_a_loop(spark, hot):
    rng, data = random.Random(11), []
    for h in range(40):
        lines, level, order = [], 0.0, 0
        for a in range(rng.randrange(3)):
            level = max(level, 0.5 * (a + 1))
            lines.append((f"h{h}", order, a, "post", 0.5 * (a + 1)))
            order += 1
        for _ in range(rng.randrange(5, 25)):
            verb = rng.choice(["cbr", "cc", "cc", "f", "board"])
            actor, target = rng.randrange(4), None
            if verb == "cbr":
                level += rng.randrange(1, 5)
                target = level
            elif verb == "board":
                actor, level = None, 0.0
            lines.append((f"h{h}", order, actor, verb, target))
            order += 1
        data.append(lines)
    df = spark.createDataFrame([x for lines in data for x in lines], SCHEMA)
    got = {(r["txn"], r["order"]): (r["kind"], r["amount"])
           for r in replay(df, hot_rows=hot).collect()}
    for lines in data:
        for order, kind, amount in fold(lines):
            assert got[lines[0][0], order] == (kind, amount)


def test_replay_runs_without_python(spark):
    plan = replay(hands(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
