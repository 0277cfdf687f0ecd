"""Session settings that the operators count on."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Times are printed in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Requests and writes may name one key very often; joins on such keys are split at run time,
    # also where that costs another shuffle further up.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows with a whole text or a piece of a file are large: few of them go to Python at a time.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
