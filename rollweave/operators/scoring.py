"""Scores of students: rules for one pair or one rollout as columns, by name, and their means as runs' scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.functions.eed import eed
from rollweave.operators.pairs import named
from rollweave.sources.scratch import shuffle_parts


def ce_margin(row: dict[str, Column]) -> Column:
    """By how much the student finds the losing rollout more surprising than the winning one."""
    return row["lose_ce"] - row["win_ce"]


def preference(row: dict[str, Column]) -> Column:
    """1 where the winning rollout surprises less, 0.5 for equals, else 0."""
    return F.when(row["win_ce"] < row["lose_ce"], 1.0).when(row["win_ce"] == row["lose_ce"], 0.5).otherwise(F.when(row["win_ce"].isNotNull() & row["lose_ce"].isNotNull(), 0.0))


def advantage_weighted(row: dict[str, Column]) -> Column:
    """The rollout's advantage times its likelihood for each token: students that find good rollouts likely score high."""
    return row["advantage"] * F.exp(-row["ce"])


#: Rules for a pair (win_ce, lose_ce, reward_gap) and for a rollout (ce, n_tokens, reward, advantage); add to them to extend.
PAIR_SCORES: dict[str, Callable[[dict[str, Column]], Column]] = {"ce_margin": ce_margin, "preference": preference}
ROLLOUT_SCORES: dict[str, Callable[[dict[str, Column]], Column]] = {"advantage_weighted": advantage_weighted}


def score_pairs(measured: DataFrame, strategy: str = "ce_margin") -> DataFrame:
    """measured (win_ce, lose_ce, reward_gap and others) with ``score``; null where a measure is null."""
    return measured.withColumn("score", named(PAIR_SCORES, strategy, "pair score")({c: F.col(c) for c in ("win_ce", "lose_ce", "reward_gap")}))


def score_rollouts(measured: DataFrame, strategy: str = "advantage_weighted") -> DataFrame:
    """measured (ce, n_tokens, reward, advantage and others) with ``score``; null where a measure is null."""
    return measured.withColumn("score", named(ROLLOUT_SCORES, strategy, "rollout score")({c: F.col(c) for c in ("ce", "n_tokens", "reward", "advantage")}))


def mean_scores(scored: DataFrame, *by: str) -> DataFrame:
    """(by.., mean_score, n_scored): scores that are null don't count; a group of nulls has a null mean."""
    return scored.groupBy(*by).agg(F.avg("score").alias("mean_score"), F.count("score").alias("n_scored"))


def answer_distances(rows: DataFrame, answer: Column, test: Column, *key: str) -> DataFrame:
    """rows with their expression distance (``eed``) as e. A pair takes up to milliseconds and its row few bytes, of which one
    part of a file can hold millions: rows are first dealt out by a key that differs."""
    return rows.repartition(shuffle_parts(rows.sparkSession), *key).withColumn("e", eed(answer, test))
