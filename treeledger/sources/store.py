"""Node stores and content stores as Parquet.

Nodes are partitioned by world and sorted by parent, so a listing reads few row groups. Contents are
partitioned by world and by a digest bucket of the node id, so a change rewrites few partitions.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeledger.functions import paths as P
from treeledger.operators.pathjobs import normalize_nodes
from treeledger.operators.sieve import sift
from treeledger.schema import CONTENTS, NODE_COLUMNS, NODES, byte_length

# ``length`` is stored beside the bytes, so that sizes can be read without them; ``buckets``, the number
# of buckets, in every row, so that it cannot be lost or mistaken.
_STORED_CONTENTS = T.StructType([
    *CONTENTS.fields, T.StructField("length", T.LongType()), T.StructField("buckets", T.IntegerType()),
    T.StructField("bucket", T.IntegerType()),
])


# Digests as hex make up much of the tables here, which this writes in about half the bytes.
PACKED = {"compression": "zstd"}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session may do without that setting.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="treeledger-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The same rows read back from a table in the shared folder.

    For narrow intermediate results with several uses: they are computed once, outlive lost
    executors, and their size is known when the joins on them are planned.
    """
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.options(**PACKED).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_nodes(nodes: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Range partitioned on the listing order, so a large folder spreads over many files."""
    (
        nodes.select(*NODE_COLUMNS)
        .repartitionByRange("world", "parent_id", "name", "node_id")
        .sortWithinPartitions("world", "parent_id", "name")
        .write.mode(mode)
        .options(**PACKED)
        .partitionBy("world")
        .parquet(path)
    )


def scan_nodes(spark: SparkSession, path: str, world: str = "") -> DataFrame:
    """Rows of one world of a node store, with both paths in normal form."""
    nodes = spark.read.schema(NODES).parquet(path).where(F.col("world") == P.world_name(world))
    return normalize_nodes(nodes.select(*NODE_COLUMNS))


def with_bucket(contents: DataFrame, buckets: int) -> DataFrame:
    return contents.withColumn(
        "bucket", F.pmod(F.xxhash64("node_id"), F.lit(buckets)).cast("int")
    )


def write_contents(contents: DataFrame, path: str, buckets: int) -> None:
    """A new content store. ``buckets`` is fixed for its life and written into it; size it for buckets of
    about 256 MB."""
    rows = contents.select(*CONTENTS.fieldNames(), byte_length(contents), F.lit(buckets).cast("int").alias("buckets"))
    (
        with_bucket(rows, buckets)
        .repartition("world", "bucket")
        .write.options(**PACKED)
        .partitionBy("world", "bucket")
        .parquet(path)
    )


def stored_buckets(spark: SparkSession, path: str, given: int | None = None) -> int | None:
    """The number of buckets of a content store; None for a store without rows. Another number than the
    store's is refused, since rows would be looked for in the wrong buckets."""
    row = scan_contents(spark, path).select("buckets").limit(1).collect()
    if row and given not in (None, row[0][0]):
        raise ValueError(f"the store at {path} has {row[0][0]} buckets, not {given}")
    return row[0][0] if row else given


def scan_contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STORED_CONTENTS).parquet(path)


def in_buckets(contents: DataFrame, keys: DataFrame) -> DataFrame:
    """Stored contents in the worlds and buckets of ``keys``.

    The buckets are a stored table of at most one row per partition of the store, so their size is
    known: where Spark broadcasts them, the scan is pruned at run time and opens no other partition.
    """
    touched = stored(keys.select("world", "bucket").distinct(), "touched")
    # The filter is always true; pruning at run time asks for one on the small side.
    return contents.join(touched.where("bucket >= 0"), ["world", "bucket"], "left_semi")


def staying(contents: DataFrame, ids: DataFrame) -> DataFrame:
    """Contents, or chunks of them, whose file is not in ``ids(world, node_id)``. Which files stay is decided
    on ids; only the bytes of these are shuffled. A null id stays, since it is not in ``ids``."""
    key = ["world", "node_id"]
    stay = stored(contents.select(*key).distinct().join(ids.select(*key), key, "left_anti"), "staying")
    names = stay.select(F.col("world").alias("_world"), F.col("node_id").alias("_node_id"))
    same = F.col("world").eqNullSafe(F.col("_world")) & F.col("node_id").eqNullSafe(F.col("_node_id"))
    return sift(contents, stay, key).join(names, same).select(*contents.columns)


def replace_contents(spark: SparkSession, changed: DataFrame, path: str, buckets: int | None = None) -> None:
    """Put changed contents in place of the old ones, rewriting only the buckets they fall into.

    The number of buckets is the store's; one that is given must be the same, and is needed for a store
    without rows only. ``sources.chunkstore`` is the store that keeps its old state if a change fails.

    The changed rows are written to the shared folder first: they are used three times, and they may
    have been derived from the store that is rewritten.
    """
    buckets = stored_buckets(spark, path, buckets)
    if buckets is None:
        raise ValueError(f"the store at {path} has no rows: say how many buckets it shall have")
    pending = shared_dir(spark, "replace")
    write_contents(changed, pending, buckets)
    new = scan_contents(spark, pending)
    kept = staying(in_buckets(scan_contents(spark, path), new), new)
    (
        kept.unionByName(new)
        .repartition("world", "bucket")
        .write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", **PACKED)
        .partitionBy("world", "bucket")
        .parquet(path)
    )
