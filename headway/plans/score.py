"""Score records: ten metrics, their weights and the final score."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.config import WEIGHT_KEYS, WEIGHT_TOLERANCE, Params, Weights
from headway.plans import metrics as M

# --- fixed values: columns of the score record, in order ------------------------
SCORE_COLUMNS = (
    "transit_route_ratio",
    "service_coverage",
    "ridership",
    "travel_time",
    "transit_auto_time_ratio",
    "on_time_perf",
    "productivity",
    "bus_efficiency",
    "bus_effective_travel_distance",
    "bus_transfer_rate",
    "final_score",
)
# ----------------------------------------------------------------------------------

_SCENARIO = ("transit_route_ratio", "service_coverage")


def scenario_facts(coverage: DataFrame, route_ratio: DataFrame) -> DataFrame:
    """One row: population, service coverage and transit route ratio."""
    rows = coverage.unionByName(route_ratio, allowMissingColumns=True)
    return rows.agg(
        *[F.max(c).alias(c) for c in ("population", "service_coverage", "transit_route_ratio")]
    )


def metric_columns(
    population: Column, params: Params, weights: Weights, record: bool
) -> dict[str, Column]:
    """The record-table metrics; one of weight zero is only computed for a record."""
    every = {
        "ridership": M.ridership(population),
        "on_time_perf": M.on_time(),
        "travel_time": M.travel_time(params),
        "transit_auto_time_ratio": M.transit_auto_ratio(),
        "productivity": M.productivity(params),
        "bus_efficiency": M.bus_efficiency(),
        "bus_effective_travel_distance": M.effective_distance(),
        "bus_transfer_rate": M.bus_transfer_rate(),
    }
    w = weights.as_dict()
    return {name: m if record or w[name] > 0 else F.lit(0.0) for name, m in every.items()}


def score(
    facts: DataFrame,
    scenario: DataFrame,
    params: Params,
    weights: Weights,
    record: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """One score row, or one per ``by``, from record facts and scenario facts.

    A scenario without the ``by`` columns is shared by all runs.
    """
    if not by:
        # Two one-row frames side by side: both are worked out at the same time.
        both = facts.unionByName(scenario, allowMissingColumns=True)
        rows = both.agg(*[F.max(c).alias(c) for c in both.columns])
    elif set(by) <= set(scenario.columns):
        rows = facts.join(scenario, list(by))
    else:
        shared = scenario.select(F.struct("population", *_SCENARIO)).scalar()
        rows = facts.withColumn("_shared", shared).select("*", "_shared.*")
    named = rows.select(
        *by, *_SCENARIO, *[c.alias(n) for n, c in metric_columns(F.col("population"), params, weights, record).items()]
    )
    # Added up in one fixed order, so that equal inputs give equal scores.
    terms = [weight * F.col(name) for name, weight in weights.as_dict().items()]
    return named.withColumn("final_score", reduce(lambda a, b: a + b, terms)).select(*by, *SCORE_COLUMNS)


def check_weights(weights: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Do the weights (``name``, ``weight``) of each run name every metric and sum to one?"""
    known = F.col("name").isin(*WEIGHT_KEYS)
    sums = weights.groupBy(*by).agg(
        F.count_if(known).alias("n_weights"), F.sum(F.when(known, F.col("weight"))).alias("total")
    )
    sound = (F.col("n_weights") == len(WEIGHT_KEYS)) & (F.abs(F.col("total") - 1.0) < WEIGHT_TOLERANCE)
    return sums.withColumn("valid", sound)


def weighted_scores(scores: DataFrame, weights: DataFrame, by: Sequence[str]) -> DataFrame:
    """Final score of each run under weights that come as a table (``by``, name, weight).

    A run that lacks the weight of a metric has no score (null).
    """
    long = scores.unpivot(list(by), [c for c in SCORE_COLUMNS if c != "final_score"], "name", "value")
    complete = F.count("weight") == F.count(F.lit(1))
    return long.join(weights, [*by, "name"], "left").groupBy(*by).agg(
        F.when(complete, F.sum(F.col("value") * F.col("weight"))).alias("final_score")
    )
