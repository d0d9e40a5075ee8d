"""Session settings shared by jobs and tests."""

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "gridseries", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; only a local session gets one, below its warehouse."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    sc.setCheckpointDir(folder)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition rows that are about to fan out.

    The explicit number keeps adaptive execution from merging partitions by the size they have
    before the fan-out. It is one more than joins and aggregates use: where rows come from one by the
    same keys, Spark would leave out an equal shuffle, and the merged partitions of that one would stay.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1, *keys)
