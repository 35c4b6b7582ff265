"""Session settings the results depend on, and the shared folder."""

from tidewater.session import CLUSTER_CONF, REQUIRED_CONF, configure, scratch_path, shared_dir


def test_required_settings_applied(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    for k, v in REQUIRED_CONF.items():
        assert spark.conf.get(k) == v


def test_shared_folder_comes_from_session(spark):
    path = shared_dir(spark)
    conf = spark.conf.get("spark.checkpoint.dir", None)
    assert conf is None or path == conf.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(path + "/tidewater/")


def test_cluster_profile_is_adaptive():
    assert CLUSTER_CONF["spark.sql.adaptive.skewJoin.skewedPartitionFactor"] == "5"
    assert int(CLUSTER_CONF["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 10000
