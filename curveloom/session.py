"""Local session for tests and the benchmark. On a cluster the caller's own session is used as it is."""

from pyspark.sql import SparkSession


def local_session(
    cores: str = "8", app: str = "curveloom", memory: str = "12g", shared: str = "/tmp/curveloom-shared",
) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.legacy.parquet.nanosAsLong", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
