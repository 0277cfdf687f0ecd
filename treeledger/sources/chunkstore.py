"""Content stores of chunks and versions.

A file is rows ``(world, node_id, chunk_no, start_byte, length, content)`` of ``chunk`` bytes each, the
last one shorter, so a file of any size fits, and a read of some bytes takes the chunks that hold them.
Rows lie in ``data/version=V/world=W/bucket=B``; ``bucket`` is a hash of the id. A table of its own, the
manifest, says which version of every bucket counts, how many buckets and which chunk size the store
has. Data of a new version goes beside the old one, and the new manifest is written last, as one file:
until it is there, readers see the old state whole, and what a failed change left behind is never read.
Bucket count and chunk size are not arguments of any later call, so they cannot be wrong.

The manifest has one row per world and bucket. A change reads and writes the buckets that its files fall
into and no other. Two changes that were based on the same state both claim the next version; the store
then refuses to be read (``two changes``) rather than lose one silently.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeledger.schema import COPY_BUFFER_BYTES
from treeledger.sources.store import PACKED, staying, stored

KEY = ["world", "node_id"]
# Bytes a bucket should hold; the most buckets a world gets.
BUCKET_BYTES = 256 * 1024 * 1024
MOST_BUCKETS = 100_000

CHUNKS = T.StructType([
    T.StructField("world", T.StringType()),
    T.StructField("node_id", T.StringType()),
    T.StructField("chunk_no", T.LongType()),
    T.StructField("start_byte", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
_DATA = T.StructType([
    *CHUNKS.fields, T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType()),
])
_MANIFEST = (
    "world string, bucket int, data_version bigint, chunks bigint, bytes bigint, buckets int, chunk bigint, "
    "change string, version bigint"
)


def as_chunks(contents: DataFrame, chunk: int = COPY_BUFFER_BYTES) -> DataFrame:
    """Whole contents ``(world, node_id, content)`` cut into chunks; a null or
    empty file is one empty chunk."""
    size = F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint")
    last = F.greatest(F.ceil(size / chunk).cast("bigint") - 1, F.lit(0).cast("bigint"))
    start = F.col("chunk_no") * chunk
    piece = F.coalesce(F.substring(F.col("content"), (start + 1).cast("int"), F.lit(chunk)), F.lit(b""))
    return (
        contents.select(*KEY, "content", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("chunk_no"))
        .select(*KEY, "chunk_no", start.alias("start_byte"), piece.alias("content"))
        .select(
            *KEY, "chunk_no", "start_byte", F.octet_length("content").cast("bigint").alias("length"), "content",
        )
    )


def file_states(chunks: DataFrame, chunk: int, more: tuple[str, ...] = ()) -> DataFrame:
    """One row per file ``(world, node_id, *more)``: ``size`` and whether its chunks are ``whole``: each
    from 0 to the last there once, all but the last full."""
    counted = chunks.groupBy(*KEY, *more, "chunk_no", "start_byte").agg(
        F.sum("length").alias("length"), F.count(F.lit(1)).alias("times")
    )
    wrong = (
        (F.col("times") > 1) | (F.col("chunk_no") < 0) | (F.col("length") > chunk)
        | (F.col("start_byte") != F.col("chunk_no") * chunk)
    )
    # Different numbers, as many as from 0 to the largest, are all of them; and without a gap the bytes
    # add up to the last one's end.
    whole = (
        (F.count_if(wrong) == 0) & (F.count(F.lit(1)) == F.max("chunk_no") + 1)
        & (F.sum("length") == F.max(F.col("start_byte") + F.col("length")))
    )
    return counted.groupBy(*KEY, *more).agg(
        F.sum("length").cast("bigint").alias("size"), F.coalesce(whole, F.lit(False)).alias("whole")
    )


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the manifest that counts, by the number in its folder's name."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    return rows.where(F.col("version") == rows.agg(F.max("version")).first()[0])


def current(spark: SparkSession, path: str) -> tuple[DataFrame, int, int, int]:
    """The manifest, its version, and the store's bucket count and chunk size."""
    rows = _manifest(spark, path)
    version, buckets, chunk, changes = rows.agg(
        F.max("version"), F.max("buckets"), F.max("chunk"), F.count_distinct("change")
    ).first()
    if version is None:
        raise FileNotFoundError(f"no content store at {path}")
    if changes > 1:
        raise RuntimeError(f"two changes of {path} claim version {version}")
    return rows, version, buckets, chunk


def _with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("node_id"), F.lit(buckets)).cast("int"))


def _write_version(rows: DataFrame, path: str, version: int) -> DataFrame:
    """Write rows with ``bucket`` as data of a version; returns chunks and bytes of every bucket.

    Partitions are rebalanced: a large bucket is split over tasks, small ones share one."""
    target = f"{path}/data/version={version}"
    (
        rows.select(*CHUNKS.fieldNames(), "bucket").hint("rebalance", "world", "bucket")
        .write.mode("overwrite").options(**PACKED).partitionBy("world", "bucket").parquet(target)
    )
    back = rows.sparkSession.read.schema(_DATA).parquet(f"{path}/data").where(F.col("version") == version)
    return back.groupBy("world", "bucket").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum("length").cast("bigint").alias("bytes")
    )


def _publish(rows: DataFrame, path: str, version: int) -> None:
    """Switch to a new manifest: one file, which is there as a whole or not at all."""
    rows.coalesce(1).write.mode("append").parquet(f"{path}/manifest/version={version}")


def write_chunks(chunks: DataFrame, path: str, chunk: int = COPY_BUFFER_BYTES, buckets: int | None = None) -> None:
    """A new store of whole files. Without ``buckets``, buckets of about 256 MB.

    ``chunks(world, node_id, chunk_no, start_byte, length, content)`` are cut at multiples of ``chunk``, as
    ``as_chunks`` does."""
    if not buckets:
        total = chunks.agg(F.sum("length")).first()[0] or 0
        buckets = max(1, min(MOST_BUCKETS, -(-int(total) // BUCKET_BYTES)))
    held = _write_version(_with_bucket(chunks, buckets), path, 1)
    change = uuid.uuid4().hex
    # A row that stands for no bucket keeps the counts of a store without files.
    root = held.sparkSession.createDataFrame([(None, -1, 0, 0)], "world string, bucket int, chunks bigint, bytes bigint")
    _publish(
        held.unionByName(root).select(
            "world", "bucket", F.lit(1).cast("bigint").alias("data_version"), "chunks", "bytes",
            F.lit(buckets).alias("buckets"), F.lit(chunk).cast("bigint").alias("chunk"), F.lit(change).alias("change"),
        ), path, 1,
    )


def _data(spark: SparkSession, path: str, entries: DataFrame) -> DataFrame:
    """Chunks of the manifest's ``entries``. They are a small stored table, so that where Spark
    broadcasts them the scan is pruned at run time to their folders."""
    entries = stored(entries.where("bucket >= 0").select("world", "bucket", F.col("data_version").alias("version")), "entries")
    data = spark.read.schema(_DATA).parquet(f"{path}/data")
    # The filter is always true; pruning at run time asks for one on the small side.
    return data.join(entries.where("bucket >= 0"), ["version", "world", "bucket"], "left_semi")


def scan_chunks(spark: SparkSession, path: str) -> DataFrame:
    """All chunks that count."""
    rows, *_ = current(spark, path)
    return _data(spark, path, rows).select(*CHUNKS.fieldNames())


def near_chunks(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Chunks, with their bucket and version, of the buckets that ``keys(world, node_id)`` fall into."""
    rows, _, buckets, _ = current(spark, path)
    touched = _with_bucket(keys.select(*KEY), buckets).select("world", "bucket").distinct()
    return _data(spark, path, rows.join(touched, ["world", "bucket"], "left_semi"))


def replace_chunks(spark: SparkSession, path: str, chunks: DataFrame, gone: DataFrame | None = None) -> None:
    """Put files in place of the ones with the same ids, add new ones, and take out those in ``gone``
    ``(world, node_id)``; only buckets they fall into are written again."""
    rows, version, buckets, chunk = current(spark, path)
    new = stored(_with_bucket(chunks.select(*CHUNKS.fieldNames()), buckets), "changed")
    ids = new.select(*KEY).distinct()
    ids = stored(ids if gone is None else ids.unionByName(gone.select(*KEY)).distinct(), "ids")
    kept = staying(near_chunks(spark, path, ids).select(*new.columns), ids)
    held = _write_version(kept.unionByName(new), path, version + 1)
    touched = _with_bucket(ids, buckets).select("world", "bucket").distinct()
    change = uuid.uuid4().hex
    old = rows.select("world", "bucket", "data_version", "chunks", "bytes")
    untouched = old.join(touched, ["world", "bucket"], "left_anti")
    _publish(
        stored(
            untouched.unionByName(held.withColumn("data_version", F.lit(version + 1).cast("bigint"))).select(
                "world", "bucket", "data_version", "chunks", "bytes", F.lit(buckets).alias("buckets"),
                F.lit(chunk).cast("bigint").alias("chunk"), F.lit(change).alias("change"),
            ), "manifest",
        ), path, version + 1,
    )


def read_ranges(requests: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Bytes of requests ``(request_id, world, node_id, offset, limit)``: pieces ``(request_id, world,
    node_id, start_byte, length, content, status)``, in as many rows as chunks are touched.

    A negative offset is 0; no limit is up to the end. A request meets only the chunks that it needs, by
    chunk number, in the buckets it falls into. ``not_found`` and ``out_of_range`` (nothing there, or no
    bytes asked for) have one row without bytes."""
    *_, chunk = current(spark, path)
    first = F.greatest(F.coalesce("offset", F.lit(0)), F.lit(0)).cast("bigint")
    data = near_chunks(spark, path, requests).select(*CHUNKS.fieldNames())
    # Sizes are found on narrow columns; the bytes are read once.
    sizes = data.select(*KEY, "length").join(requests.select(*KEY).distinct(), KEY, "left_semi").groupBy(*KEY).agg(
        F.sum("length").cast("bigint").alias("_size")
    )
    asked = requests.select("request_id", *KEY, first.alias("_from"), F.col("limit").cast("bigint").alias("limit")).join(
        sizes, KEY, "left"
    )
    until = F.least(F.col("_size"), F.coalesce(F.col("_from") + F.col("limit"), F.col("_size")))
    asked = stored(asked.withColumn("_until", until), "ranges")
    empty = asked.where(F.col("_size").isNull() | (F.col("_until") <= F.col("_from")))
    number = F.explode(F.sequence(F.expr(f"_from div {chunk}"), F.expr(f"(_until - 1) div {chunk}")))
    wanted = asked.where("_until > _from").withColumn("chunk_no", number)
    begin = F.greatest(F.col("_from"), F.col("start_byte"))
    end = F.least(F.col("_until"), F.col("start_byte") + F.col("length"))
    found = wanted.join(data, [*KEY, "chunk_no"]).select(
        "request_id", *KEY, begin.alias("start_byte"), (end - begin).alias("length"),
        F.substring("content", (begin - F.col("start_byte") + 1).cast("int"), (end - begin).cast("int")).alias("content"),
        F.lit("ok").alias("status"),
    )
    return found.unionByName(empty.select(
        "request_id", *KEY, F.col("_from").alias("start_byte"), F.lit(0).cast("bigint").alias("length"),
        F.lit(None).cast("binary").alias("content"),
        F.when(F.col("_size").isNull(), "not_found").otherwise("out_of_range").alias("status"),
    ))


def sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(world, node_id, size)`` of every file; no bytes are read."""
    return scan_chunks(spark, path).groupBy(*KEY).agg(F.sum("length").cast("bigint").alias("size"))
