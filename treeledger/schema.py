"""Table layouts shared by every operator."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODES = T.StructType([
    T.StructField("world", T.StringType()),
    T.StructField("node_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("parent_path", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("location_path", T.StringType()),
    T.StructField("last_updated", T.TimestampType()),
    T.StructField("depth_level", T.IntegerType()),
    T.StructField("size", T.LongType()),
    T.StructField("type", T.StringType()),
])

CONTENTS = T.StructType([
    T.StructField("world", T.StringType()),
    T.StructField("node_id", T.StringType()),
    T.StructField("content", T.BinaryType()),
])

NODE_COLUMNS = NODES.fieldNames()
FOLDER_KEY = ["world", "parent_id"]

# Fixed values that results depend on.
FILE, FOLDER = "file", "folder"
LOCAL, CATALOG = "local", "catalog"
DEFAULT_WORLD = "primary"
DESTINATION_WORLD = "s1"
DEFAULT_ROOT_ID = "root"
DEFAULT_LIMIT = 100
MAX_LIMIT = 1000
COPY_BUFFER_BYTES = 8 * 1024 * 1024
SPILL_BYTES = 10 * 1024 * 1024
PENDING_PREFIX = "pending:"


def byte_length(rows: DataFrame) -> Column:
    """``length`` of the bytes: the stored one where there is one, else counted."""
    if "length" in rows.columns:
        return F.col("length")
    return F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint").alias("length")
