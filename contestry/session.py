"""Session settings for tests, benchmarks and local runs; a cluster brings its own."""

from pyspark.sql import SparkSession


def local_session(cores: int = 8, app: str = "contestry") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .getOrCreate()
    )
