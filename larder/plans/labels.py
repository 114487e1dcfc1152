"""Labelled interactions from a recommendation log.

Positives are responses, negatives a sample of requests that nobody answered,
kept only for recommendations with at least one positive.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import numbers
from larder.operators import aggregates, joins, sampling


@dataclass(frozen=True)
class LabelSpec:
    """Column names and conditions of a labelling job."""

    request: str
    response: str
    recommendation: str = "recommendation_sid"
    user: str = "user_account_sid"
    item: str = "item_sid"
    time: str = "logged_at"
    extras: Sequence[str] = ()
    user_attributes: Sequence[str] = ()
    negative_fraction: float = 0.1
    null_safe: bool = False
    seed: int = 42

    @property
    def keys(self) -> list[str]:
        return [self.recommendation, self.user, self.item, *self.extras]


def pair_requests(log: DataFrame, spec: LabelSpec) -> DataFrame:
    """Requests beside responses per key: the full outer join of both sides.

    Both sides come from one log, so one aggregation pairs them and no join is
    needed.  Null key parts do not pair unless ``null_safe``: such a group is
    split into its request and its response.
    """
    asked, answered = F.expr(spec.request), F.expr(spec.response)
    paired = (
        log.filter(asked | answered)
        .groupBy(*spec.keys)
        .agg(
            F.min(F.when(asked, F.col(spec.time))).alias("l"),
            F.min(F.when(answered, F.col(spec.time))).alias("r"),
            F.max(F.when(asked, 1)).alias("req"),
            F.max(F.when(answered, 1)).alias("res"),
        )
    )
    sides = F.array(F.struct("l", "r", "req", "res"))
    if not spec.null_safe:
        request_only = F.struct("l", F.lit(None).alias("r"), "req", F.lit(None).alias("res"))
        response_only = F.struct(F.lit(None).alias("l"), "r", F.lit(None).alias("req"), "res")
        incomplete = F.expr(" or ".join(f"`{k}` is null" for k in spec.keys))
        both = F.col("req").isNotNull() & F.col("res").isNotNull()
        sides = F.when(incomplete & both, F.array(request_only, response_only)).otherwise(sides)
    rows = paired.select(*spec.keys, F.explode(sides).alias("s"))
    return rows.select(*spec.keys, numbers.earliest("s.l", "s.r").alias(spec.time), "s.req", "s.res")


def label_pairs(pairs: DataFrame, spec: LabelSpec) -> DataFrame:
    """Label 1 for answered pairs, 0 for a sample of the unanswered ones.

    One filter keeps both kinds, so the pairing is planned and run once.
    """
    positive = F.col("res") == 1
    kept = F.col("res").isNotNull()
    if spec.negative_fraction < 1.0:
        sampled = sampling.in_sample(spec.keys, spec.negative_fraction, spec.seed)
        kept = kept | sampled
    else:
        kept = F.lit(True)
    label = F.when(positive, 1).otherwise(0).alias("label")
    return pairs.filter(kept).select(*spec.keys, spec.time, label)


def positive_recommendations(log: DataFrame, spec: LabelSpec) -> DataFrame:
    """Ids of recommendations with a response, straight from the log."""
    return log.filter(spec.response).select(spec.recommendation).distinct()


def user_attributes(log: DataFrame, spec: LabelSpec) -> DataFrame:
    """One row of attributes per user: that of the latest log row."""
    fields = list(spec.user_attributes)
    return aggregates.latest_per_key(log, [spec.user], [spec.time, *fields], fields)


def labeled_interactions(log: DataFrame, spec: LabelSpec) -> DataFrame:
    """The labelled dataset: keys, extras, time, label, user attributes.

    Negatives are sampled by their key, so it makes no difference that the
    sample is drawn before recommendations without a positive are removed.
    """
    rows = label_pairs(pair_requests(log, spec), spec)
    rows = rows.join(positive_recommendations(log, spec), spec.recommendation, "left_semi")
    if spec.user_attributes:
        rows = joins.attach(rows, user_attributes(log, spec), spec.user)
    return rows
