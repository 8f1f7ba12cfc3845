"""The keyed table that streams upsert into."""

import os

import pytest

from assaylake.sources import scratch
from assaylake.streaming import buckets, incremental


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{path}/data") for f in names}


def rows(spark, path):
    return {r["k"]: (r["at"], r["v"]) for r in buckets.read_table(spark, path).collect()}


def batch(spark, pairs, at):
    return spark.createDataFrame([(k, at, v) for k, v in pairs], "k long, at long, v string")


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    write = lambda df, n, s="s": buckets.upsert_batch(df, n, path, ["k"], ["at"], s, 8)
    assert write(batch(spark, [(k, "a") for k in range(100)], 1), 0)
    before = files(path)
    assert write(batch(spark, [(5, "b"), (5, "c")], 2), 1)
    assert {k: t for k, t in files(path).items() if k in before} == before
    new = {os.path.dirname(f) for f in files(path)} - {os.path.dirname(f) for f in before}
    assert len([d for d in new if "_bucket=" in d]) == 1
    got = rows(spark, path)
    assert len(got) == 100 and got[5][0] == 2 and all(got[k] == (1, "a") for k in range(100) if k != 5)
    # an older row doesn't replace a newer one
    assert write(batch(spark, [(5, "old"), (6, "old")], 0), 2)
    assert rows(spark, path) == got
    # a repeated batch is known, whatever it has
    at, version = files(path), buckets.manifest(spark, path).version
    assert not write(batch(spark, [(7, "again")], 9), 2) and files(path) == at and buckets.manifest(spark, path).version == version
    # numbers of another stream are its own
    assert write(batch(spark, [(7, "other")], 9), 0, "t") and rows(spark, path)[7] == (9, "other")


def test_what_a_failed_batch_left_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    buckets.upsert_batch(batch(spark, [(k, "a") for k in range(20)], 1), 0, path, ["k"], ["at"], "s", 4)
    got = rows(spark, path)

    def lost(*_):
        raise OSError("the driver was lost")

    with monkeypatch.context() as m:
        m.setattr(buckets, "_swap", lost)
        with pytest.raises(OSError):
            buckets.upsert_batch(batch(spark, [(3, "b")], 2), 1, path, ["k"], ["at"], "s", 4)
    assert rows(spark, path) == got
    assert buckets.upsert_batch(batch(spark, [(3, "b")], 2), 1, path, ["k"], ["at"], "s", 4)
    assert rows(spark, path) == got | {3: (2, "b")}
    held = len(files(path))
    assert buckets.expire(spark, path, keep=1) == 2 and len(files(path)) < held and rows(spark, path) == got | {3: (2, "b")}


def test_two_writers_of_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.upsert_batch(batch(spark, [(1, "a")], 1), 0, path, ["k"], ["at"])
    with pytest.raises(RuntimeError):
        buckets._swap(spark, path, buckets.manifest(spark, path))
    with pytest.raises(ValueError):
        buckets.upsert_batch(batch(spark, [(1, "a")], 1), 1, path, ["v"], ["at"])
    with pytest.raises(ValueError):
        buckets.read_table(spark, str(tmp_path / "none"))


def test_nulls_new_columns_and_empty_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    write = lambda df, n: buckets.upsert_batch(df, n, path, ["k"], ["at"], "s", 4)
    assert write(batch(spark, [], 1), 0) and buckets.read_table(spark, path).count() == 0
    assert write(batch(spark, [(None, "a"), (1, None)], 1), 1) and write(batch(spark, [(None, "b")], 2), 2)
    assert rows(spark, path) == {None: (2, "b"), 1: (1, None)}
    assert write(spark.createDataFrame([(2, 3, "c", 7.5)], "k long, at long, v string, more double"), 3)
    assert {r["k"]: r["more"] for r in buckets.read_table(spark, path).collect()} == {None: None, 1: None, 2: 7.5}


def test_three_starts_with_two_checkpoints(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "t")
    for part, state in enumerate(("one", "one", "two")):
        batch(spark, [(k, f"{part}") for k in range(part, 30, 3)], part).write.mode("append").parquet(str(source))
        sink = buckets.bucket_sink(path, ["k"], ["at"], state, 4)
        incremental.process_new_files(spark, str(source), batch(spark, [], 0).schema, sink, str(tmp_path / state))
        assert len(rows(spark, path)) == 10 * (part + 1)
    now = buckets.manifest(spark, path)
    assert now.batches == {"one": 1, "two": 0} and now.version == 3
    assert rows(spark, path) == {k: (k % 3, str(k % 3)) for k in range(30)}


def test_folders_on_a_cluster_need_the_setting():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf: dict = {}

    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        Context.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.shared_folder(Session())
    Context.master = "local[4]"
    assert scratch.shared_folder(Session()) != scratch.shared_folder(Session())
    Context.master, Session.conf = "yarn", {scratch.SETTING: "hdfs://shared/"}
    assert scratch.shared_folder(Session()).startswith("hdfs://shared/")
