"""Trained models as snapshots: the fitted pipeline, the names of its features and the schema of its rows.

A model is written once and read by whoever scores, evaluates or explains, by the newest name or a pinned one.  A
snapshot counts from when its marker is written, which is last.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from larder.operators import filters, model
from larder.sources import files, schemas, snapshots


@dataclass(frozen=True)
class SavedModel:
    """A model as it was read, with all that scoring needs besides the rows."""

    name: str
    fitted: PipelineModel
    features: list[str]
    label: str
    schema: T.StructType

    def check(self, df: DataFrame) -> DataFrame:
        """The rows, if they have all features, as numbers without nulls."""
        missing = [f for f in self.features if f not in df.columns]
        if missing:
            raise ValueError(f"rows lack features {missing} of model {self.name}")
        kinds = {f: df.schema[f].dataType.simpleString() for f in self.features if not isinstance(df.schema[f].dataType, T.NumericType)}
        if kinds:
            raise ValueError(f"features of model {self.name} are not numbers: {kinds}")
        filters.assert_no_nulls(df, self.features)
        return df

    def score(self, df: DataFrame, threshold: float = model.DEFAULT_THRESHOLD) -> DataFrame:
        return model.score_batch(self.fitted, df, self.features, threshold)


def save(spark: SparkSession, fitted: PipelineModel, root: str, schema: T.StructType, features: list[str], label: str, name: str | None = None) -> str:
    """Write a model as a snapshot below ``root`` and return its name; a name that is there is an error."""
    name = name or snapshots.snapshot_now()
    path = f"{root}/{name}"
    if files.exists(spark, f"{path}/_SUCCESS"):
        raise FileExistsError(f"model snapshot {path} is there already")
    fitted.write().overwrite().save(f"{path}/model")
    files.write_text(spark, f"{path}/schema.json", schema.json())
    files.write_text(spark, f"{path}/features.json", json.dumps({"names": schemas.feature_name_map(features), "label": label}))
    files.write_text(spark, f"{path}/_SUCCESS", "")
    return name


def load(spark: SparkSession, root: str, pinned: str | None = None) -> SavedModel:
    """The newest complete model below ``root``, or the pinned one."""
    path = snapshots.resolve_snapshot(spark, root, pinned)
    known = json.loads(files.read_text(spark, f"{path}/features.json") or "{}")
    schema = T.StructType.fromJson(json.loads(files.read_text(spark, f"{path}/schema.json") or "{}"))
    return SavedModel(path.rpartition("/")[2], PipelineModel.load(f"{path}/model"), list(known["names"]), known["label"], schema)


def train(df: DataFrame, root: str, features: list[str], label: str, name: str | None = None, **more) -> str:
    """Train a ranker and save it; ``more`` are arguments of ``train_ranker``."""
    fitted = model.train_ranker(df, features, label, **more)
    schema = df.select(*features, label).schema
    return save(df.sparkSession, fitted, root, schema, features, label, name)
