"""Snapshots, landing, run state, serving tables."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from support import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import session
from larder.sources import extract, files, keyed, manifest, snapshots
from larder.sources.serving import ServingTable

A, B, C = "20240101_000000_000000", "20240102_000000_000000", "20240103_000000_000000"


def test_snapshot_name():
    assert re.fullmatch(r"\d{8}_\d{6}_\d{6}", snapshots.snapshot_now())


def test_snapshot_path():
    assert str(snapshots.SnapshotPath("/data/", "lake", "items", "badges", "training")) == "/data/lake/items/badges/training"


def test_latest_ignores_incomplete(spark, root):
    df = spark.range(3)
    snapshots.write_parquet(df, root, A)
    files.make_directory(spark, f"{root}/{B}")
    assert snapshots.resolve_snapshot(spark, root).endswith(A)
    with pytest.raises(FileNotFoundError):
        snapshots.resolve_snapshot(spark, root, B)


def test_no_snapshot(spark, root):
    with pytest.raises(FileNotFoundError):
        snapshots.resolve_snapshot(spark, root)


def test_parquet_snapshot_is_not_overwritten(spark, root):
    snapshots.write_parquet(spark.range(3), root, A)
    with pytest.raises(Exception, match="already exists"):
        snapshots.write_parquet(spark.range(4), root, A)
    snapshots.write_parquet(spark.range(4), root, A, mode="overwrite")
    assert snapshots.read_parquet(spark, root).count() == 4


def test_retention_stays_inside_the_table(spark, root):
    for name in (A, B, C):
        snapshots.write_parquet(spark.range(1), f"{root}/t", name)
    snapshots.write_parquet(spark.range(1), f"{root}/other", A)
    assert snapshots.retain_snapshots(spark, f"{root}/t", 2) == [B, C]
    assert snapshots.retain_snapshots(spark, f"{root}/t", None) == [B, C]
    assert snapshots.complete_snapshots(spark, f"{root}/other") == [A]
    for bad in ("", "..", "a/b"):
        with pytest.raises(ValueError):
            files.delete_child(spark, root, bad)


def test_json_keeps_microseconds_and_nulls(spark, root):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:07.179575' as t, timestamp '2024-01-01 00:00:07.000001' as z, cast(null as int) as n")
    snapshots.write_json(df, root)
    assert rows(snapshots.read_json(spark, root, df.schema)) == rows(df)


def test_text_replacement(spark, root):
    files.make_directory(spark, root)
    files.write_text(spark, f"{root}/p", "one")
    files.write_text(spark, f"{root}/p", "zwei ü")
    assert files.read_text(spark, f"{root}/p") == "zwei ü" and files.read_text(spark, f"{root}/q") is None


def test_land_overwrites_and_limits_file_size(spark, root):
    extract.land(spark.range(1000), root)
    landed = extract.land(spark.range(100).coalesce(1), root, rows_per_file=25)
    assert landed.count() == 100 and len(landed.inputFiles()) == 4


def test_batch_callback_adds_fields(spark, root):
    def triple(batch, by):
        return batch.assign(y=batch["id"] * by)

    schema = T.StructType.fromDDL("id bigint, y bigint")
    landed = extract.land(spark.range(5), root, callback=extract.batch_callback(triple, schema, by=3))
    assert rows(landed) == [(i, 3 * i) for i in range(5)]


def test_jdbc_options():
    made = extract.jdbc_options("jdbc:x", "(select 1) q", "id", (0, 100), 8, user="u")
    assert made["numPartitions"] == "8" and made["lowerBound"] == "0" and made["user"] == "u"
    assert "partitionColumn" not in extract.jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        extract.jdbc_options("jdbc:x", "t", "id")


def test_query_values_are_bound_not_pasted(spark):
    df = spark.createDataFrame([("it's",), ("x' or 1=1 --",)], "s string")
    got = extract.run_query(spark, "select * from {t} where s = :v", {"t": df}, {"v": "x' or 1=1 --"})
    assert rows(got) == [("x' or 1=1 --",)]


def test_keys_replace_in_list(spark):
    df, keys = spark.range(10), spark.createDataFrame([(3,), (3,), (42,)], "k bigint")
    assert rows(extract.key_literal_filter(df, "id", keys, "k")) == [(3,)]


def test_manifest(spark, root):
    assert manifest.previous_end_value(spark, root, "j", "t") == manifest.DEFAULT_START
    manifest.record_run(spark, root, "j", "r1", A, "t", {"end_date": A})
    manifest.record_run(spark, root, "j", "r2", B, "t", {"end_date": B, "when": datetime(2024, 1, 1)})
    manifest.record_run(spark, root, "j", "r2", B, "t", {"end_date": C})
    manifest.record_run(spark, root, "other", "r9", C, "t", {"end_date": "2099"})
    runs = manifest.read_runs(spark, root)
    assert runs.count() == 3
    assert manifest.previous_end_value(spark, root, "j", "t") == C
    assert manifest.latest_run(runs, "j", "t").first()["run_id"] == "r2"


def docs(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id int, v string")


def test_publish_moves_only_to_complete_versions(spark, root):
    served = ServingTable(spark, root, ["id"])
    with pytest.raises(FileNotFoundError):
        served.read()
    with pytest.raises(FileNotFoundError):
        served.publish("nowhere")
    served.publish(served.write_version(docs(spark, (1, "a")), "v1"), keep=2)
    served.write_version(docs(spark, (1, "b")), "v2")
    assert rows(served.read()) == [(1, "a")]
    served.publish("v2", keep=2)
    assert rows(served.read()) == [(1, "b")] and served.versions() == ["v1", "v2"]
    served.publish(served.write_version(docs(spark, (1, "c")), "v3"), keep=2)
    assert served.versions() == ["v2", "v3"]
    served.publish("v2", keep=1)
    assert served.versions() == ["v2", "v3"] and served.published() == "v2"


def test_incremental_needs_a_version(spark, root):
    served = ServingTable(spark, root, ["id"])
    with pytest.raises(FileNotFoundError):
        served.write(docs(spark, (1, "a")), "incremental")
    with pytest.raises(ValueError):
        served.write(docs(spark, (1, "a")), "sometimes")


def test_changes_replay_and_compact(spark, root):
    served = ServingTable(spark, root, ["id"])
    served.publish(served.write(docs(spark, (1, "a"), (2, "b")), "full", "v1"))
    served.write(docs(spark, (2, "x"), (3, "c")), "incremental", batch=0, writer="w")
    served.write(docs(spark, (2, "y")), "incremental", batch=1, writer="w")
    wanted = [(1, "a"), (2, "y"), (3, "c")]
    assert rows(served.read()) == wanted
    served.write(docs(spark, (2, "y")), "incremental", batch=1, writer="w")
    assert rows(served.read()) == wanted
    served.compact()
    assert rows(served.read()) == wanted and served.changes("v1") is None


def test_a_replay_replaces_all_of_its_batch(spark, root):
    served = ServingTable(spark, root, ["id"])
    served.publish(served.write(docs(spark, (1, "a")), "full"))
    served.write(docs(spark, (1, "x"), (2, "x")), "incremental", batch=3, writer="w")
    served.write(docs(spark, (2, "y")), "incremental", batch=3, writer="w")
    assert rows(served.read()) == [(1, "a"), (2, "y")]
    served.write(docs(spark, (2, "z")).filter("false"), "incremental", batch=3, writer="w")
    assert rows(served.read()) == [(1, "a")]


def test_writers_do_not_overwrite_each_other(spark, root):
    served = ServingTable(spark, root, ["id"])
    served.publish(served.write(docs(spark, (1, "a")), "full", "v1"))
    served.write(docs(spark, (2, "manual")), "incremental")
    served.write(docs(spark, (3, "s"), (4, "s")), "incremental", batch=0, writer="s")
    served.write(docs(spark, (4, "t")), "incremental", batch=0, writer="t")
    wanted = [(1, "a"), (2, "manual"), (3, "s"), (4, "t")]
    assert rows(served.read()) == wanted
    served.write(docs(spark, (3, "s"), (4, "s")), "incremental", batch=0, writer="s")  # a replay keeps its place
    assert rows(served.read()) == wanted
    with pytest.raises(ValueError):
        served.write(docs(spark, (1, "a")), "incremental", writer="a/b")


def test_writers_at_one_time(spark, root):
    """Batches written side by side, several of which see the same numbers taken, all count."""
    served = ServingTable(spark, root, ["id"])
    served.publish(served.write(docs(spark, (0, "base")), "full"))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: served.write(docs(spark, (i, f"w{i}")), "incremental"), range(1, 9)))
    wanted = [(0, "base"), *((i, f"w{i}") for i in range(1, 9))]
    assert rows(served.read()) == wanted
    served.compact()
    assert rows(served.read()) == wanted


def test_compaction_keeps_batches_written_meanwhile(spark, root, monkeypatch):
    served = ServingTable(spark, root, ["id"])
    served.publish(served.write(docs(spark, (1, "a"), (2, "b")), "full", "v1"))
    served.write(docs(spark, (2, "x")), "incremental")
    write_fold = ServingTable._write_fold

    def slow(self, made, version, fold):
        write_fold(self, made, version, fold)
        if fold == 1:  # another writer, between the read and the publish
            served.write(docs(spark, (1, "z"), (3, "c")), "incremental", writer="other")

    monkeypatch.setattr(ServingTable, "_write_fold", slow)
    served.compact()
    assert rows(served.read()) == [(1, "z"), (2, "x"), (3, "c")]
    served.write(docs(spark, (3, "d")), "incremental")
    served.compact()
    assert rows(served.read()) == [(1, "z"), (2, "x"), (3, "d")] and served.changes("v1") is None


def test_compaction_writes_only_the_ranges_of_its_changes(spark, root):
    served = ServingTable(spark, root, ["id"], buckets=16)
    base = spark.range(400).selectExpr("cast(id as int) as id", "'old' as v")
    served.publish(served.write(base, "full", "v1"))
    served.write(docs(spark, (7, "new"), (9_000, "new")), "incremental")
    served.compact()
    written = files.child_directories(spark, f"{root}/versions/v1/fold=1")
    ranges = base.limit(0).union(docs(spark, (7, ""), (9_000, ""))).select(keyed.bucket_of(["id"], 16)).distinct().collect()
    assert written == sorted(f"{keyed.BUCKET}={r[0]}" for r in ranges)
    assert len(files.child_directories(spark, f"{root}/versions/v1/fold=0")) == 16
    got = {r.id: r.v for r in served.read().collect()}
    assert got == {**{i: "old" for i in range(400)}, 7: "new", 9_000: "new"}


def test_a_compaction_cut_short_is_done_again(spark, root, monkeypatch):
    """The pointer has moved, one of two folded batches is gone: the other is folded again and changes nothing."""
    for rule, order in (("replace", ()), ("partial", ("at",))):
        served = ServingTable(spark, f"{root}/{rule}", ["id"], rule, order)
        made = lambda *r: spark.createDataFrame(list(r), "id int, v string, at int")
        served.publish(served.write(made((1, "a", 0), (2, "b", 0)), "full"))
        served.write(made((1, "x", 1), (2, "late", 1)), "incremental")
        served.write(made((2, "y", 2)), "incremental")
        wanted, gone = rows(served.read()), []

        def once(spark_, parent, name, gone=gone):
            if gone:
                raise RuntimeError("stopped")
            gone.append(name)
            files_delete(spark_, parent, name)

        files_delete = files.delete_child
        monkeypatch.setattr(files, "delete_child", once)
        with pytest.raises(RuntimeError):
            served.compact()
        monkeypatch.setattr(files, "delete_child", files_delete)
        assert rows(served.read()) == wanted
        served.compact()
        assert rows(served.read()) == wanted and served.changes(served.published()) is None


def test_empty_versions_and_loads(spark, root):
    served = ServingTable(spark, root, ["id"])
    served.publish(served.write(docs(spark, (1, "a")).filter("false"), "full"))
    assert rows(served.read()) == [] and served.read().columns == ["id", "v"]
    served.write(docs(spark, (1, "a"), (2, "b")), "incremental")
    keys = spark.createDataFrame([(2,), (2,), (None,), (5,)], "id long")
    assert rows(served.load(keys)) == [(2, "b")]
    served.compact()
    served.write(docs(spark, (5, "e")), "incremental")
    assert rows(served.load(keys)) == [(2, "b"), (5, "e")] and rows(served.load(keys.limit(0))) == []


def files_read(df):
    """Files of keyed tables that the scans of a query that has run took."""
    plan = df._jdf.queryExecution().executedPlan()
    for inner, unwrap in (("AdaptiveSparkPlan", "executedPlan"), ("ResultQueryStage", "plan")):
        plan = getattr(plan, unwrap)() if plan.nodeName() == inner else plan
    leaves = plan.collectLeaves()
    scans = [s for s in map(leaves.apply, range(leaves.size())) if s.nodeName().startswith("Scan parquet") and keyed.BUCKET in s.toString()]
    assert scans
    return sum(s.metrics().get("numFiles").get().value() for s in scans)


def test_keys_read_only_their_directories(spark, root):
    base = spark.range(5_000).selectExpr("id", "concat('v', id) as v")
    stored = keyed.KeyedTable(spark, f"{root}/t", ["id"]).write(base, buckets=32)
    assert rows(stored.read().limit(1)) and stored.read().count() == 5_000
    keys = spark.createDataFrame([(3,), (3,), (None,), (77,), (9_999,)], "id int")
    found = stored.load(keys)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    assert rows(found) == [(3, "v3"), (77, "v77")]
    assert 1 <= files_read(found) <= 3
    assert rows(stored.load(keys.limit(0))) == []
    empty = keyed.KeyedTable(spark, f"{root}/e", ["id"]).write(base.limit(0))
    assert empty.read().count() == 0 and rows(empty.load(keys)) == []
    with pytest.raises(FileNotFoundError):
        keyed.KeyedTable(spark, f"{root}/none", ["id"]).read()


def test_keys_of_several_columns(spark, root):
    base = spark.range(300).selectExpr("id % 10 as a", "concat('k', id div 10) as b", "id as v")
    stored = keyed.KeyedTable(spark, root, ["a", "b"]).write(base)
    keys = spark.createDataFrame([(1, "k2"), (4, "k29"), (4, None)], "a int, b string")
    assert rows(stored.load(keys)) == [(1, "k2", 21), (4, "k29", 294)]


def test_batches_may_give_different_fields(spark, root):
    served = ServingTable(spark, root, ["id"], "partial")
    base = spark.createDataFrame([(1, "a", "b", "c"), (2, "a", "b", "c")], "id int, a string, b string, c string")
    served.publish(served.write(base, "full"))
    served.write(spark.createDataFrame([(1, None)], "id int, a string"), "incremental")
    served.write(spark.createDataFrame([(1, "x", 7), (3, "y", 8)], "id int, b string, d int"), "incremental")
    wanted = [(1, None, "x", "c", 7), (2, "a", "b", "c", None), (3, None, "y", None, 8)]
    assert rows(served.read().select("id", "a", "b", "c", "d")) == wanted
    served.compact()
    assert rows(served.read().select("id", "a", "b", "c", "d")) == wanted


def test_order_decides_over_batches(spark, root):
    schema = "id int, v string, at int"
    served = ServingTable(spark, root, ["id"], "partial", ["at"])
    served.publish(served.write(spark.createDataFrame([(1, "base", 5), (2, "base", 5)], schema), "full"))
    served.write(spark.createDataFrame([(1, "new", 9), (2, "late", 3)], schema), "incremental")
    served.write(spark.createDataFrame([(1, "late", 7)], schema), "incremental")
    assert rows(served.read()) == [(1, "new", 9), (2, "base", 5)]


def test_without_ids_changes_are_appended(spark, root):
    served = ServingTable(spark, root)
    served.publish(served.write(docs(spark, (1, "a")), "full"))
    served.write(docs(spark, (1, "a")), "incremental")
    assert rows(served.read()) == [(1, "a"), (1, "a")]


class Settings(dict):
    """Stands in for a session that only knows its settings."""

    @property
    def conf(self):
        return self


def test_workspace_comes_from_the_session():
    assert session.workspace(Settings({"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"


def test_no_local_folder_on_a_cluster():
    cluster = Settings()
    cluster.sparkContext = type("Context", (), {"master": "spark://host:7077"})
    with pytest.raises(RuntimeError):
        session.workspace(cluster)


def test_materialise(spark):
    df = spark.range(3).withColumn("x", F.lit(1))
    again = session.materialise(df, "m")
    assert rows(again) == rows(df) and "range" not in again._jdf.queryExecution().toString().lower()


def test_discard_deletes_only_what_was_materialised(spark, root):
    spark.range(3).write.parquet(f"{root}/own")
    made, other = session.materialise(spark.range(3), "m"), spark.read.parquet(f"{root}/own")
    path = made.inputFiles()[0].rpartition("/")[0]
    session.discard(other)
    session.discard(made)
    session.discard(made)
    assert files.exists(spark, f"{root}/own/_SUCCESS") and not files.exists(spark, path)


def test_landing_is_sized_by_the_data(spark, root, monkeypatch):
    """One partition in, files of a size out, with no argument for it; small rows get one file."""
    rows_ = spark.range(0, 200_000, numPartitions=1).selectExpr("id", "md5(cast(id as string)) as a", "md5(cast(-id as string)) as b")
    rows_.coalesce(1).write.parquet(f"{root}/source")
    source = spark.read.parquet(f"{root}/source")
    landed = lambda name: [f for f in source_files(spark, f"{root}/{name}")]
    assert extract.land(source, f"{root}/a").count() == 200_000
    sizes = landed("a")
    assert extract.writers_for(source) == len(sizes) >= 8 and max(sizes) < 1.5 * min(sizes)
    monkeypatch.setattr(extract, "FILE_BYTES", 1 << 20)
    assert extract.writers_for(source) >= keyed.plan_bytes(source) >> 20
    small = extract.land(spark.range(10), f"{root}/b")
    assert small.count() == 10 and extract.writers_for(spark.range(10)) == 1


def source_files(spark, path):
    """Sizes of the files that hold rows."""
    listed = files._fs(spark, path).listStatus(files._path(spark, path))
    return [s.getLen() for s in listed if s.getPath().getName().startswith("part-")]


def test_a_bucketed_table_is_not_moved_by_joins(spark):
    made = session.bucketed(spark.range(500).selectExpr("id", "id * 2 as v"), "b", "id", 4)
    joined = made.hint("merge").join(spark.range(300).hint("merge"), "id")
    assert joined.count() == 300
    assert joined._jdf.queryExecution().sparkPlan().toString().count("Bucketed: true") == 1
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1
    path = made._larder_path
    session.discard(made)
    session.release(spark)
    assert not files.exists(spark, path) and made._larder_table not in {t.name for t in spark.catalog.listTables()}
