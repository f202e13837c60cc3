import pytest

from wardline import session


class Conf:
    def __init__(self, **settings):
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


class Session:
    def __init__(self, **settings):
        self.conf = Conf(**settings)


def test_scratch_is_the_folder_the_cluster_names():
    assert session.scratch_root(Session(spark_checkpoint_dir="s3a://lake/tmp/", spark_master="yarn")) == "s3a://lake/tmp"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        session.scratch_root(Session(spark_master="yarn"))


def test_a_local_session_may_use_a_temporary_folder():
    local = Session(spark_master="local[8]", spark_app_id="app")
    assert session.scratch_root(local) == session.scratch_root(local)


def test_paths_are_never_used_twice(spark):
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_materialized_tables_keep_rows_and_schema(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    written = session.materialize(df, "t")
    assert rows(written) == rows(df)
    assert written.dtypes == df.dtypes
