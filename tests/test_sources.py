"""Table readers and the shared folder."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

import marlgrid.session
from marlgrid.session import scratch_path, shared_dir
from marlgrid.sources.scratch import materialize, remove_scratch
from marlgrid.sources.tables import SCHEMAS, read_table, stream_table
from marlgrid.streaming.runner import append_available, stream_session

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SCHEMAS)
def test_declared_schema_is_the_files_schema(spark, name):
    stored = spark.read.parquet(f"{SF}/{name}.parquet").schema
    declared = read_table(spark, SF, name).schema
    assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in stored]


def test_a_table_may_be_a_folder_of_files(spark, tmp_path):
    source = read_table(spark, SF, "events")
    source.repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    folder = str(tmp_path)
    assert read_table(spark, folder, "events").count() == source.count()
    stream = stream_table(stream_session(spark), folder, "events", max_bytes_per_trigger=1)
    append_available(stream, f"{folder}/out", f"{folder}/checkpoint")
    copied = spark.read.parquet(f"{folder}/out")
    assert copied.exceptAll(source).isEmpty() and copied.count() == source.count()


def test_materialize_keeps_schema_and_rows(spark):
    df = read_table(spark, SF, "orders")
    copy = materialize(df, "orders")
    assert copy.schema == df.schema
    assert copy.exceptAll(df).isEmpty() and copy.count() == df.count()
    assert materialize(df.limit(0), "none").count() == 0


def test_scratch_is_removed_for_this_application_only(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(marlgrid.session, "shared_dir", lambda session: f"file://{tmp_path}")
    (tmp_path / "marlgrid" / "other").mkdir(parents=True)
    copy = materialize(spark.range(5).toDF("n"), "numbers")
    assert copy.count() == 5
    remove_scratch(spark)
    assert [p.name for p in (tmp_path / "marlgrid").iterdir()] == ["other"]
    remove_scratch(spark)


class FakeSession(SimpleNamespace):
    def __init__(self, master, **settings):
        names = {name.replace("_", "."): value for name, value in settings.items()}
        super().__init__(
            conf=SimpleNamespace(get=names.get),
            sparkContext=SimpleNamespace(master=master, applicationId=str(id(self))),
        )


@pytest.mark.parametrize("master", ["local[2]", "yarn"])
def test_shared_folder_is_the_one_the_session_names(master):
    session = FakeSession(master, spark_checkpoint_dir="hdfs://shared/")
    assert shared_dir(session) == "hdfs://shared"
    first, second = scratch_path(session, "a"), scratch_path(session, "a")
    assert first != second and first.startswith("hdfs://shared/")


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("yarn"))


def test_a_local_run_gets_one_folder_for_the_session():
    session, other = FakeSession("local[2]"), FakeSession("local[2]")
    assert shared_dir(session) == shared_dir(session) != shared_dir(other)
