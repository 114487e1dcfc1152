"""Serving tables: keyed documents, immutable files, one published pointer.

A full build writes a new version, by directories of key ranges (hashes of the id), and publishes it once it is
complete.  An incremental load writes a batch of changes beside the version, in a directory of its own writer and number,
so writers never meet and a batch that is written again replaces itself.  Readers fold the changes in, the newest by
``max_by``.  ``compact`` folds them for good: it reads and writes only the key ranges that they touch, and the pointer then
names the new fold; all other ranges stay as they are.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators import merge
from larder.sources import files, keyed, snapshots

_BATCH, _WRITER, _SUPPLIED, _FOLD = "change_batch", "change_writer", "change_fields", "fold"


@dataclass(frozen=True)
class ServingTable:
    """A batch of changes holds one row per id.  ``ids`` empty means documents without an id: changes are appended.

    ``rule`` is ``replace`` (whole documents) or ``partial`` (given fields: each change says which fields it gives, so
    batches may give different ones).  ``order`` names the columns of a change that tell which one is newer; after
    them, or without them, the higher batch number wins and between writers of one number the later name.
    """

    spark: SparkSession
    root: str
    ids: Sequence[str] = ()
    rule: str = "replace"
    order: Sequence[str] = ()
    buckets: int = 32

    def versions(self) -> list[str]:
        names = files.child_directories(self.spark, f"{self.root}/versions")
        return [n for n in names if files.exists(self.spark, f"{self.root}/versions/{n}/{_FOLD}=0/_SUCCESS")]

    def _pointer(self) -> tuple[str, int] | None:
        text = files.read_text(self.spark, f"{self.root}/CURRENT")
        return (text.rpartition(" ")[0], int(text.rpartition(" ")[2])) if text else None

    def published(self) -> str | None:
        pointer = self._pointer()
        return pointer and pointer[0]

    def _published(self) -> tuple[str, int]:
        pointer = self._pointer()
        if pointer is None:
            raise FileNotFoundError(f"no published version at {self.root}")
        return pointer

    def _write_fold(self, docs: DataFrame, version: str, fold: int) -> None:
        path = f"{self.root}/versions/{version}"
        files.make_directory(self.spark, path)
        files.write_text(self.spark, f"{path}/_schema-{fold}", docs.schema.json())
        # without ids a fold is a range of its own, which no later one replaces
        range_ = keyed.bucket_of(self.ids, self.buckets) if self.ids else F.lit(fold)
        placed = docs.withColumn(keyed.BUCKET, range_)
        placed = placed.hint("rebalance", F.col(keyed.BUCKET)) if self.ids else placed
        placed.write.mode("overwrite").partitionBy(keyed.BUCKET).parquet(f"{path}/{_FOLD}={fold}")

    def write_version(self, docs: DataFrame, version: str | None = None) -> str:
        name = version or snapshots.snapshot_now()
        self._write_fold(docs, name, 0)
        return name

    def publish(self, version: str, keep: int | None = None) -> str:
        """Point readers at a complete version as it was built, then drop versions beyond ``keep``; this one stays."""
        if version not in self.versions():
            raise FileNotFoundError(f"no complete version {version} below {self.root}")
        files.write_text(self.spark, f"{self.root}/CURRENT", f"{version} 0")
        for name in self.versions()[:-keep] if keep else []:
            if name != version:
                files.delete_child(self.spark, f"{self.root}/versions", name)
                files.delete_child(self.spark, f"{self.root}/changes", name)
        return version

    def write(self, docs: DataFrame, mode: str, version: str | None = None, batch: int | None = None, writer: str | None = None) -> str:
        """``full`` writes a new version, ``incremental`` a batch of changes to the published one.

        Without a ``batch`` the number is the next after those that are there; without a ``writer`` the name is a new one.
        """
        if mode == "full":
            return self.write_version(docs, version)
        if mode != "incremental":
            raise ValueError(f"unknown write mode {mode!r}")
        target = self._published()[0]
        writer = writer or f"manual-{uuid.uuid4().hex}"
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", writer):
            raise ValueError(f"not a writer's name: {writer!r}")
        if self.rule == "partial":
            given = [F.lit(c) for c in docs.columns if c not in self.ids]
            docs = docs.withColumn(_SUPPLIED, F.array(*given).cast("array<string>"))
        number = 1 + max((n for n, _ in self._batches(target)), default=-1) if batch is None else batch
        docs.write.mode("overwrite").parquet(f"{self.root}/changes/{target}/{_BATCH}={number}/{_WRITER}={writer}")
        return target

    def _batches(self, version: str) -> list[tuple[int, str]]:
        """(number, writer) of the batches that are complete, in the order in which they count."""
        path = f"{self.root}/changes/{version}"
        found = [(n, w) for n in files.child_directories(self.spark, path) for w in files.child_directories(self.spark, f"{path}/{n}")]
        whole = [(n, w) for n, w in found if files.exists(self.spark, f"{path}/{n}/{w}/_SUCCESS")]
        return sorted((int(n.partition("=")[2]), w.partition("=")[2]) for n, w in whole)

    def changes(self, version: str, batches: Sequence[tuple[int, str]] | None = None) -> DataFrame | None:
        """All batches of changes of a version, or None."""
        path = f"{self.root}/changes/{version}"
        paths = [f"{path}/{_BATCH}={n}/{_WRITER}={w}" for n, w in (self._batches(version) if batches is None else batches)]
        return self.spark.read.option("basePath", path).option("mergeSchema", True).parquet(*paths) if paths else None

    def _base(self, version: str, fold: int, only: Collection[int] | None = None) -> DataFrame:
        """The documents of all key ranges, or of some, each from the newest fold that has it."""
        path, newest = f"{self.root}/versions/{version}", {}
        for number in range(fold + 1):
            for name in files.child_directories(self.spark, f"{path}/{_FOLD}={number}"):
                newest[int(name.partition("=")[2])] = number
        live = F.lit(False)
        for number in sorted(set(newest.values())):
            ranges = [b for b, f in newest.items() if f == number and (only is None or b in only)]
            live = live | ((F.col(_FOLD) == number) & F.col(keyed.BUCKET).isin(ranges))
        known = T.StructType.fromJson(json.loads(files.read_text(self.spark, f"{path}/_schema-{fold}") or "{}"))
        schema = keyed.with_bucket(T.StructType([*known.fields, T.StructField(_FOLD, T.IntegerType())]))
        rows = self.spark.read.schema(schema).parquet(path).filter(live)
        return rows.drop(_FOLD, keyed.BUCKET)

    def _folded(self, base: DataFrame, changed: DataFrame | None) -> DataFrame:
        if changed is None:
            return base
        if not self.ids:
            return merge.append(base, changed.drop(_BATCH, _WRITER))
        if self.order and set(self.order) <= set(base.columns):
            changed = merge.not_older(base, changed, self.ids, self.order)
        order = [*self.order, _BATCH, _WRITER]
        if self.rule == "partial":
            newest = merge.latest_fields(changed, self.ids, order, _SUPPLIED).drop(_BATCH, _WRITER)
            return merge.upsert_fields(base, newest, self.ids)
        return merge.upsert_replace(base, merge.latest_change(changed, self.ids, order).drop(_BATCH, _WRITER), self.ids)

    def read(self) -> DataFrame:
        version, fold = self._published()
        return self._folded(self._base(version, fold), self.changes(version))

    def load(self, keys: DataFrame) -> DataFrame:
        """The documents of some ids, from their key ranges alone."""
        version, fold = self._published()
        own = keyed.keys_of(keys, self.ids, self.buckets)
        base = self._base(version, fold, self._ranges(own)).join(own.drop(keyed.BUCKET), list(self.ids), "left_semi")
        changed = self.changes(version)
        return self._folded(base, changed if changed is None else changed.join(own.drop(keyed.BUCKET), list(self.ids), "left_semi"))

    def _ranges(self, rows: DataFrame) -> set[int]:
        """The key ranges of some rows: ``buckets`` numbers at most."""
        own = rows.select(keyed.bucket_of(self.ids, self.buckets).alias("b")).distinct()
        return set(own.agg(F.collect_set("b").alias("all")).first()["all"])

    def compact(self) -> str:
        """Fold the changes that are there into their key ranges; batches written meanwhile stay beside them.

        The pointer moves when the fold is complete.  Batches that are folded go oldest first: should that be cut short, the
        rest is folded again onto documents that hold it already.
        """
        version, fold = self._published()
        batches = self._batches(version)
        changed = self.changes(version, batches)
        if changed is None:
            return version
        base = self._base(version, fold, self._ranges(changed)) if self.ids else self._base(version, fold).limit(0)
        self._write_fold(self._folded(base, changed), version, fold + 1)
        files.write_text(self.spark, f"{self.root}/CURRENT", f"{version} {fold + 1}")
        for number, writer in batches:
            files.delete_child(self.spark, f"{self.root}/changes/{version}/{_BATCH}={number}", f"{_WRITER}={writer}")
        return version

    def pointers(self) -> DataFrame:
        """(version, published) for every complete version."""
        current = self.published()
        rows = [(v, v == current) for v in self.versions()]
        return self.spark.createDataFrame(rows, "version string, published boolean").orderBy(F.col("version"))
