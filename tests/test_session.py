import pytest

from chronovault import session


def test_shuffle_partitions_follow_the_data():
    assert session.cluster_settings(10**9)["spark.sql.shuffle.partitions"] == "200"
    assert session.cluster_settings(20 * 1024**4)["spark.sql.shuffle.partitions"] == "81920"
    assert session.cluster_settings(10**15)["spark.sql.shuffle.partitions"] == "100000"


def test_scratch_is_below_the_shared_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert before is None or session.scratch_path(spark, "x").startswith(before)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(Cluster(), "x")


def test_materialise_keeps_rows_and_schema(spark):
    df = spark.range(3).selectExpr("id", "map('a', double(id)) AS m", "array(id) AS l")
    stored = session.materialise(spark, df, "test")
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted(r.id for r in stored.collect()) == [0, 1, 2]
