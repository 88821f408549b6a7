from shopscope.session import DEFAULT_CONF, checkpoint_dir
from shopscope.sources.readers import default_parallelism, ensure_min_partitions


def test_checkpoint_dir_reads_the_session_first(spark, tmp_path):
    # spark.checkpoint.dir is a launch-time setting: when the cluster (or the
    # defaults file) names one it wins; otherwise the fallback is installed once.
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert checkpoint_dir(spark, fallback=str(tmp_path / "a")) == configured
        return
    if spark.sparkContext.getCheckpointDir() is None:
        assert checkpoint_dir(spark, fallback=str(tmp_path / "a")) == str(tmp_path / "a")
    current = spark.sparkContext.getCheckpointDir()
    assert checkpoint_dir(spark, fallback=str(tmp_path / "b")) == current      # no second fallback


def test_min_partitions_by_key_only_when_few(spark):
    small = spark.range(1000).coalesce(1)
    n = default_parallelism(spark)
    spread = ensure_min_partitions(small, n, "id")
    assert spread.rdd.getNumPartitions() == n
    assert sorted(r.id for r in spread.collect()) == list(range(1000))
    many = spark.range(0, 1000, numPartitions=n * 2)
    assert ensure_min_partitions(many, n, "id") is many          # enough splits: untouched
    assert ensure_min_partitions(small, None) is small


def test_session_defaults_keep_ui_off_and_aqe_on():
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"
    assert DEFAULT_CONF["spark.sql.adaptive.enabled"] == "true"
    assert DEFAULT_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
