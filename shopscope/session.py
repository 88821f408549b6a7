"""Session construction and cluster-facing settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast when a side turns out small), coalesces small
# shuffle partitions, and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # No broadcast is chosen from a static size estimate (file bytes times
    # a guessed compression ratio bound nothing). A join side is broadcast
    # either after a measured check in the job (fits_broadcast), or by AQE
    # once its shuffle stage has run and its actual output is under this
    # bound; otherwise the join stays sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # A selection beyond the broadcast bound joins by shuffle; a Bloom filter of
    # its ids (at most 8 MB) then keeps other payments from being counted. Spark
    # adds it for scans above its 10 GB default; the ids may be this large.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(1024 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    # Spark defaults the jobs rely on, set so a cluster default cannot turn
    # them off: partitioned writes are rebalanced with large values split
    # (sinks.write_result), and a round-robin spread sorts each input
    # partition first so a re-run task deals the same rows (spread_lines).
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.sortBeforeRepartition": "true",
    # A subquery's result (a gate over all payments) that is pushed into the JSON
    # source fails there, and the source then takes good records for corrupt ones.
    "spark.sql.json.filterPushdown.enabled": "false",
    # Compiled whole-stage code is cached per plan shape; a service running
    # many different queries needs more entries than the default 100.
    "spark.sql.codegen.cache.maxEntries": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "shopscope",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the defaults above.

    ``master`` is left unset on a cluster (spark-submit supplies it).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    A fallback is used only where the setting is unset (tests, local runs);
    it is then also set on the SparkContext so checkpoint() works.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()  # set on the context directly rather than in the conf
    if current:
        return current
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is not set and no fallback was given")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
