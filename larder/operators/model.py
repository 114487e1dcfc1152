"""Ranking model: training, scoring, evaluation, leaderboard, explanation."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import session
from larder.functions import hashing, numbers
from larder.operators import aggregates, filters, ranking, sampling
from larder.sources import schemas

# Size and seed of the boosted model.
TREES = 500
LEARNING_RATE = 0.2
MAX_DEPTH = 4
#: Bins of a feature among which the booster looks for splits.
BINS = 32
#: Distinct values of a feature up to which its bins are cut by the values themselves, else by their quantiles.
CUT_VALUES = 10_000
#: Cells of training rows in a task: each level of each tree is a job, of two tasks for each part.
TASK_CELLS = 50_000
#: Values of feature pairs held at once while explaining: rows are taken in slices of that many over the pairs.
PAIR_CELLS = 4_000_000
#: Values of a table that stands for some leaves while explaining, and rows that are looked up at a time.
TABLE_VALUES, TABLE_ROWS = 1 << 15, 4096
SEED = 32

# Fixed value: the threshold of a record that does not name one.
DEFAULT_THRESHOLD = 0.5


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def split_points(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Where each feature is cut into bins of nearly equal numbers of rows, as Spark's trees cut it when they see all rows.

    A feature of at most CUT_VALUES values is cut half-way between two of them; one of more at quantiles of all rows.
    Either way the driver gets a bounded number of values.
    """
    named = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("double").alias("v")) for f in features])).alias("x")
    counts = session.materialise(rows.select(named).groupBy("x.f", "x.v").agg(F.count("*").alias("n")), "feature-values")
    distinct = counts.agg(*[F.count_if(F.col("f") == f).alias(f) for f in features]).first()
    few = [f for f in features if distinct[f] <= CUT_VALUES]
    # at most CUT_VALUES rows for each feature
    known = counts.filter(F.col("f").isin(few)).orderBy("f", "v").toPandas()
    found = {f: _cuts(own["v"].to_numpy(), own["n"].to_numpy(), bins) for f, own in known.groupby("f")}
    many = [f for f in features if distinct[f] > CUT_VALUES]
    if many:
        ranks = [k / bins for k in range(1, bins)]
        places = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), ranks, F.lit(CUT_VALUES)).alias(f"q{i}") for i, f in enumerate(many)]).first()
        found |= {f: sorted(set(places[f"q{i}"])) for i, f in enumerate(many)}
    session.discard(counts)
    return {f: found.get(f, []) for f in features}


def _cuts(values: np.ndarray, counts: np.ndarray, bins: int) -> list[float]:
    """The thresholds of ascending distinct values with their counts: half-way between two, nearest to equal shares."""
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) < bins:
        return middles.tolist()
    stride = counts.sum() / bins
    target, out = stride, []
    for middle, before, upto in zip(middles, np.cumsum(counts)[:-1], np.cumsum(counts)[1:], strict=True):
        if abs(before - target) < abs(upto - target):
            out.append(float(middle))
            target += stride
    return out


def _binner(points: Mapping[str, list[float]]) -> Bucketizer:
    """Bins of the renamed features.  A tree goes left up to a threshold, a bin starts at its split: the next number."""
    splits = [[-math.inf, *np.nextafter(np.array(p or [0.0]), math.inf).tolist(), math.inf] for p in points.values()]
    return Bucketizer(splitsArray=splits, inputCols=list(points), outputCols=[f"{f}_bin" for f in points])


def train_ranker(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    sampling_factor: float = 1.0,
    sample_keys: Sequence[str] = (),
    trees: int = TREES,
) -> PipelineModel:
    """Boosted trees over the features, trained where the rows lie.

    Fails if a feature holds nulls.  A factor below 1 trains on exactly that
    share of the rows.  Training passes over the rows thousands of times, and
    trees see no more of a row than its bins and label; so rows alike in these
    are one cell with their number as its weight, and only cells are passed over.
    """
    rows = df.select(*dict.fromkeys([*sample_keys, *features, label]))
    if sampling_factor < 1.0:
        rows = sampling.sample_exact(rows, sample_keys, sampling_factor)
    rows = session.materialise(rows, "training-rows")
    filters.assert_no_nulls(rows, features)
    mapping = schemas.feature_name_map(features)
    renamed = schemas.rename_features(rows.select(*features, label), mapping)
    binner = _binner(split_points(renamed, list(mapping.values())))
    bins = binner.getOutputCols()
    # without their metadata, which would make categories of bins
    binned = binner.transform(renamed).select(label, *[F.col(b).alias(b, metadata={}) for b in bins])
    cells = binned.groupBy(*bins, label).agg(F.count("*").cast("double").alias("weight"))
    cells = session.materialise(cells, "training-cells")
    number = cells.count()
    assembler = VectorAssembler(inputCols=bins, outputCol="features")
    # Spark looks for splits in a sample of maxBins^2 rows; with as many as there are cells it sees every bin
    booster = GBTClassifier(
        labelCol=label, weightCol="weight", maxIter=trees, maxDepth=MAX_DEPTH, stepSize=LEARNING_RATE, seed=SEED, checkpointInterval=10,
        maxBins=max(BINS, math.isqrt(number) + 1),
    )
    ready = assembler.transform(cells.repartition(max(1, -(-number // TASK_CELLS)))).select("features", label, "weight")
    return PipelineModel([binner, assembler, booster.fit(ready)])


def score_batch(
    model: PipelineModel, df: DataFrame, features: Sequence[str], threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Add ``probability`` of the positive class and the 0/1 ``prediction``."""
    mapping = schemas.feature_name_map(features)
    copies = df.withColumns({new: F.col(old) for old, new in mapping.items()})
    scored = model.transform(copies).drop("prediction", "rawPrediction", "features", *mapping.values(), *_bins_of(model))
    scored = scored.withColumn("probability", vector_to_array("probability").getItem(1))
    return scored.withColumn("prediction", (F.col("probability") > threshold).cast("int"))


def margins(model: PipelineModel, df: DataFrame, features: Sequence[str], out: str = "margin") -> DataFrame:
    """Add the sum of the trees of each row, which its Shapley values explain."""
    mapping = schemas.feature_name_map(features)
    copies = df.withColumns({new: F.col(old) for old, new in mapping.items()})
    scored = model.transform(copies).withColumn(out, vector_to_array("rawPrediction").getItem(1))
    return scored.drop("prediction", "probability", "rawPrediction", "features", *mapping.values(), *_bins_of(model))


def _bins_of(model: PipelineModel) -> list[str]:
    """The columns of bins that scoring adds; a model saved before there were bins has none."""
    return list(model.stages[0].getOutputCols()) if isinstance(model.stages[0], Bucketizer) else []


def evaluate_scores(scored: DataFrame, label: str, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Precision, recall, F1 and counts of a scored table at a threshold."""
    judged = scored.withColumn("__p", (F.col("probability") > threshold).cast("int"))
    return aggregates.classification_metrics(judged, label, "__p").withColumn("threshold", F.lit(threshold))


# --- leaderboard ----------------------------------------------------------

EVALUATIONS = "precision double, recall double, threshold double"
MODELS = "model_configs array<struct<model_name: string>>"


def run_record(metrics: DataFrame, snapshots: Column, models: Sequence[str], extra: Mapping[str, Column]) -> DataFrame:
    """Run records with their evaluation as JSON text, one per metrics row."""
    named = json.dumps({"model_configs": [{"model_name": m, "model_config": {}} for m in models]})
    return metrics.select(
        snapshots.alias("snapshots"),
        F.lit(named).alias("models"),
        F.to_json(F.struct("precision", "recall", "threshold")).alias("evaluations"),
        *[c.alias(n) for n, c in extra.items()],
    )


def append_records(records: DataFrame, new: DataFrame, order: Sequence[str]) -> DataFrame:
    """Append run records, numbered on from the last id, or from 1.

    The new rows of one call are the runs of one job, a handful, so numbering
    them in one place is bounded.
    """
    last = records.agg(F.coalesce(F.max("record_id"), F.lit(0))).scalar()
    place = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    added = new.withColumn("record_id", place + last)
    return records.unionByName(added.select(*records.columns))


def read_metrics(records: DataFrame) -> DataFrame:
    """Metrics and names read from the JSON texts of run records."""
    e, m = F.from_json("evaluations", EVALUATIONS), F.from_json("models", MODELS)
    parsed = records.withColumns({"__e": e, "__m": m})
    names = F.array_join(F.transform("__m.model_configs", lambda c: c["model_name"]), "|")
    return parsed.withColumns(
        {
            "f1": numbers.f1(F.col("__e.precision"), F.col("__e.recall")),
            "record_time": F.get_json_object("snapshots", "$.start_time"),
            "model_name": names,
            "precision": _three_decimals(F.col("__e.precision")),
            "recall": _three_decimals(F.col("__e.recall")),
            "threshold": _three_decimals(F.coalesce("__e.threshold", F.lit(DEFAULT_THRESHOLD))),
        }
    ).drop("__e", "__m")


def _three_decimals(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%.3f", c))


def leaderboard(records: DataFrame, k: int) -> DataFrame:
    """The k records with the best F1, best first."""
    fields = ["record_id", "task_name", "domain_name", "f1", "record_time", "model_name", "precision", "recall", "threshold"]
    return ranking.top_k(read_metrics(records), "f1", k, ["record_id"]).select(*fields)


# --- explanation ----------------------------------------------------------
#
# Shapley values of a tree ensemble are sums over leaves.  For one leaf, let a
# feature's splits on the path leave it the interval (low, high], let o be 1 if
# the row lies in it and 0 otherwise, and let z be the share of training rows
# that pass those splits.  A set S of known features gives the leaf the value
#     value * product of o over S * product of z over the other path features,
# a game of at most ``depth`` players, small enough to enumerate.


@dataclass(frozen=True)
class Leaf:
    """One leaf: its weighted value and, per path feature, interval and share."""

    value: float
    players: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    share: tuple[float, ...]


def tree_nodes(model: PipelineModel) -> pd.DataFrame:
    """Nodes of the boosted trees as (tree, node, feature, threshold, left,
    right, value, rows); values carry the tree weights.  Its size is that of
    the model: at most trees x 2^(depth + 1) rows, whatever it was trained on."""
    booster: GBTClassificationModel = model.stages[-1]
    spark = SparkSession.active()
    path = session.scratch_path(spark, "model")
    booster.save(path)
    data = F.col("nodeData")
    table = (
        spark.read.parquet(f"{path}/data")
        .select(
            F.col("treeID").alias("tree"),
            data["id"].alias("node"),
            data["split"]["featureIndex"].alias("feature"),
            F.get(data["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            data["leftChild"].alias("left"),
            data["rightChild"].alias("right"),
            data["prediction"].alias("value"),
            F.get(data["impurityStats"], F.lit(0)).alias("rows"),
        )
        .orderBy("tree", "node")
        .toPandas()
    )
    table["value"] *= np.asarray(booster.treeWeights)[table["tree"].to_numpy()]
    if _bins_of(model):
        # a threshold between two bins is the last number of the lower one
        inner = table["left"].to_numpy() >= 0
        ends = [np.nextafter(np.array(s[1:]), -math.inf) for s in model.stages[0].getSplitsArray()]
        upper = [ends[f][math.floor(t)] for f, t in zip(table.loc[inner, "feature"], table.loc[inner, "threshold"], strict=True)]
        table.loc[inner, "threshold"] = upper
    return table


def leaves(nodes: pd.DataFrame) -> list[Leaf]:
    found: list[Leaf] = []
    for _, tree in nodes.groupby("tree"):
        by_id = {n.node: n for n in tree.itertuples()}
        open_paths: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
        while open_paths:
            node, bounds = open_paths.pop()
            here = by_id[node]
            if here.left < 0:
                players = tuple(sorted(bounds))
                low, high, share = zip(*[bounds[f] for f in players]) if players else ((), (), ())
                found.append(Leaf(here.value, players, low, high, share))
                continue
            low, high, share = bounds.get(here.feature, (-math.inf, math.inf, 1.0))
            for child, new_low, new_high in (
                (here.left, low, min(high, here.threshold)),
                (here.right, max(low, here.threshold), high),
            ):
                passed = by_id[child].rows / here.rows
                open_paths.append((child, bounds | {here.feature: (new_low, new_high, share * passed)}))
    return found


def _subset_products(o: np.ndarray, z: Sequence[float], players: Sequence[int], weights: Sequence[float]) -> np.ndarray:
    """Sum over subsets of ``players`` of weight(size) * prod(o in) * prod(z out)."""
    total = np.zeros(o.shape[1])
    for size, weight in enumerate(weights):
        for known in combinations(players, size):
            rest = math.prod(z[p] for p in players if p not in known)
            total += weight * rest * (o[list(known)].prod(axis=0) if known else 1.0)
    return total


def _of_leaf(leaf: Leaf, o: np.ndarray, pairs: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Shapley values (players x columns) and interactions of one leaf, where ``o`` says which players a column passes."""
    n = len(leaf.players)
    values = np.zeros(o.shape)
    mixed = np.zeros((n, *o.shape)) if pairs else None
    gain = leaf.value * (o - np.array(leaf.share)[:, None])
    one = [math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n) for k in range(n)]
    two = [math.factorial(k) * math.factorial(n - k - 2) / math.factorial(n - 1) / 2 for k in range(n - 1)]
    for i in range(n):
        others = [p for p in range(n) if p != i]
        values[i] = gain[i] * _subset_products(o, leaf.share, others, one)
        for j in others if mixed is not None else ():
            rest = [p for p in others if p != j]
            mixed[i, j] = gain[i] * (o[j] - leaf.share[j]) * _subset_products(o, leaf.share, rest, two)
    return values, mixed


def _passed(leaf: Leaf, x: np.ndarray) -> np.ndarray:
    columns = x[:, leaf.players].T
    return (columns > np.array(leaf.low)[:, None]) & (columns <= np.array(leaf.high)[:, None])


def _explain_leaves(x: np.ndarray, found: Sequence[Leaf], pairs: bool) -> np.ndarray:
    """Shapley values of rows, or their interactions flattened, leaf by leaf.

    What a leaf gives depends only on which of its players a row passes, so it is computed for each such case, not for each row.
    """
    rows, count = x.shape
    out = np.zeros((rows, count, count)) if pairs else np.zeros((rows, count))
    for leaf in found:
        n = len(leaf.players)
        if not n:
            continue
        cases = (np.arange(1 << n) >> np.arange(n)[:, None] & 1).astype(float)
        values, mixed = _of_leaf(leaf, cases, pairs)
        case = (_passed(leaf, x) << np.arange(n)[:, None]).sum(axis=0)
        if mixed is None:
            out[:, leaf.players] += values.T[case]
            continue
        mixed[np.arange(n), np.arange(n)] = values - mixed.sum(axis=1)
        out[np.ix_(np.arange(rows), leaf.players, leaf.players)] += mixed.transpose(2, 0, 1)[case]
    return out.reshape(rows, -1)


class ShapleyTables:
    """The leaves of a model as tables: neighbouring leaves, together a tree or less, are constant on the cells that their
    thresholds cut, so a row costs one look-up for each table, not a game for each leaf.

    A table has at most ``TABLE_VALUES`` values, or is that of one leaf; there are never more tables than leaves.
    """

    def __init__(self, found: Sequence[Leaf], count: int, pairs: bool):
        self.found, self.count, self.pairs = found, count, pairs
        every = [np.zeros(0)] * count
        for leaf in found:
            for f, *ends in zip(leaf.players, leaf.low, leaf.high, strict=True):
                every[f] = np.append(every[f], [e for e in ends if math.isfinite(e)])
        self.edges = [np.unique(e) for e in every]
        self.tables = [self._table(group) for group in self._groups(found)]

    def _groups(self, found: Sequence[Leaf]) -> Iterator[list[Leaf]]:
        group, cuts = [], {}
        for leaf in found:
            both = {f: set(c) for f, c in cuts.items()}
            for f, *ends in zip(leaf.players, leaf.low, leaf.high, strict=True):
                both.setdefault(f, set()).update(e for e in ends if math.isfinite(e))
            width = len(both) ** 2 if self.pairs else len(both)
            if group and width * math.prod(len(c) + 1 for c in both.values()) > TABLE_VALUES:
                yield group
                group, both = [], {}
                for f, *ends in zip(leaf.players, leaf.low, leaf.high, strict=True):
                    both.setdefault(f, set()).update(e for e in ends if math.isfinite(e))
            group, cuts = [*group, leaf], both
        if group:
            yield group

    def _table(self, group: list[Leaf]) -> tuple[list[int], list[np.ndarray], np.ndarray]:
        """The features, the place that each of their bins has, and the values by the sum of places."""
        features = sorted({f for leaf in group for f in leaf.players})
        at = {f: n for n, f in enumerate(features)}
        cuts = [np.unique([e for leaf in group for f, *ends in zip(leaf.players, leaf.low, leaf.high, strict=True) if f == g for e in ends if math.isfinite(e)]) for g in features]
        # an interval of a tree ends with its upper threshold, which stands for it
        ends = [np.append(c, math.inf) for c in cuts]
        cells = np.stack([g.ravel() for g in np.meshgrid(*ends, indexing="ij")], axis=1) if features else np.zeros((1, 0))
        own = [Leaf(leaf.value, tuple(at[f] for f in leaf.players), leaf.low, leaf.high, leaf.share) for leaf in group]
        steps = [math.prod(len(e) for e in ends[n + 1 :]) for n in range(len(ends))]
        places = [np.searchsorted(c, np.append(self.edges[f], math.inf)) * step for f, c, step in zip(features, cuts, steps, strict=True)]
        return features, places, _explain_leaves(cells, own, self.pairs)

    def explain(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Shapley values (rows x features) and interactions (rows x features x features) of a batch."""
        width = self.count**2 if self.pairs else self.count
        out = np.zeros((len(x), width))
        for at in range(0, len(x), TABLE_ROWS):
            part, own = x[at : at + TABLE_ROWS], out[at : at + TABLE_ROWS]
            bins = [np.searchsorted(e, part[:, f]) for f, e in enumerate(self.edges)]
            for features, places, values in self.tables:
                if not features:
                    continue
                cell = sum(place[bins[f]] for f, place in zip(features, places, strict=True))
                if len(features) == self.count:
                    own += values[cell]
                else:
                    columns = [f * self.count + g for f in features for g in features] if self.pairs else features
                    own[:, columns] += values[cell]
        odd = np.flatnonzero(np.isnan(x).any(axis=1))  # no threshold is passed by what is no number
        if len(odd):
            out[odd] = _explain_leaves(x[odd], self.found, self.pairs)
        if not self.pairs:
            return out, None
        mixed = out.reshape(len(x), self.count, self.count)
        return mixed.sum(axis=2), mixed


def explain_rows(model: PipelineModel, df: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Shapley value of every feature for every row: keys and one column each.

    With the mean prediction they add up to the row's margin.  The trees travel
    with the task; rows stay where they lie.
    """
    found, names = leaves(tree_nodes(model)), list(features)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = ShapleyTables(found, len(names), False)
        for batch in batches:
            values, _ = tables.explain(batch[[f"__{n}" for n in names]].to_numpy(dtype=float))
            yield pd.concat([batch[list(keys)].reset_index(drop=True), pd.DataFrame(values, columns=names)], axis=1)

    rows = df.select(*keys, *[F.col(n).cast("double").alias(f"__{n}") for n in names])
    schema = T.StructType([*[df.schema[k] for k in keys], *[T.StructField(n, T.DoubleType()) for n in names]])
    return rows.mapInPandas(explain, schema)


def attributions(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Global attribution: (feature, other, mean_abs, mean).

    ``other`` null is the Shapley value of the feature, another feature their
    interaction, the feature itself what remains of it alone.  Batches are
    summed where they lie, so a few rows per batch are shuffled.
    """
    found, names = leaves(tree_nodes(model)), list(features)
    count = len(names)
    first = [n for n in names for _ in range(count)] + names
    second = [n for _ in names for n in names] + [None] * count

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows_at_once, tables = max(1, PAIR_CELLS // (count * count)), ShapleyTables(found, count, True)
        for batch in batches:
            for at in range(0, len(batch), rows_at_once):
                part = batch[names].iloc[at : at + rows_at_once].to_numpy(dtype=float)
                values, mixed = tables.explain(part)
                every = np.concatenate([mixed.reshape(len(part), -1), values], axis=1)
                sums = {"abs_sum": np.abs(every).sum(axis=0), "total": every.sum(axis=0), "n": len(part)}
                yield pd.DataFrame({"feature": first, "other": second, **sums})

    schema = "feature string, other string, abs_sum double, total double, n bigint"
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in names]).mapInPandas(explain, schema)
    return parts.groupBy("feature", "other").agg(
        (F.sum("abs_sum") / F.sum("n")).alias("mean_abs"), (F.sum("total") / F.sum("n")).alias("mean")
    )


def explain_features(
    model: PipelineModel, df: DataFrame, features: Sequence[str], sample_keys: Sequence[str] = (), n_sample: int | None = None
) -> DataFrame:
    """Attributions over all rows, or over ``n_sample`` rows with the smallest
    key hashes where a sample is asked for."""
    if n_sample is not None:
        total = max(1, df.count())
        df = sampling.sample_exact(df, sample_keys, min(1.0, n_sample / total))
    return attributions(model, df, features)


def permutation_importance(
    model: PipelineModel, df: DataFrame, features: Sequence[str], label: str, key: str, seed: int = SEED, rows_per_group: int = 100_000
) -> DataFrame:
    """(feature, f1_drop): how much F1 loses when one feature is shuffled.

    A feature is shuffled by moving each value to the next row in hash order of
    the key, inside hash buckets of about ``rows_per_group`` rows each, however
    many rows there are.
    """
    base = df.select(key, label, *features)
    buckets = max(1, -(-base.count() // rows_per_group))
    place = base.withColumn("__b", hashing.key_bucket(key, buckets=buckets, seed=seed))
    order = Window.partitionBy("__b").orderBy(hashing.key_hash(key, seed=seed + 1), key)
    # The last row of a bucket takes the first one's value.
    moved = place.withColumns(
        {
            f"__m{i}": F.coalesce(F.lead(f).over(order), F.first(f).over(order))
            for i, f in enumerate(features)
        }
    )
    versions = [F.struct(F.lit("").alias("feature"), *features)] + [
        F.struct(F.lit(f).alias("feature"), *[F.col(f"__m{i}").alias(g) if g == f else F.col(g) for g in features])
        for i, f in enumerate(features)
    ]
    rows = moved.select(label, F.explode(F.array(*versions)).alias("v")).select(label, "v.*")
    scored = score_batch(model, rows, features)
    judged = aggregates.classification_metrics(scored, label, "prediction", ["feature"])
    whole = F.max(F.when(F.col("feature") == "", F.col("f1")))
    return judged.withColumn("__f1", whole.over(Window.partitionBy())).filter("feature <> ''").select(
        "feature", (F.col("__f1") - F.col("f1")).alias("f1_drop")
    )


def model_summary(model: PipelineModel) -> dict[str, Any]:
    booster: GBTClassificationModel = model.stages[-1]
    return {"trees": booster.getNumTrees, "nodes": booster.totalNumNodes}
