"""Row-wise and set-wise operators on node tables. None of these but ``child_counts`` shuffles."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.functions import paths as P
from treeledger.schema import FILE, FOLDER, FOLDER_KEY, NODE_COLUMNS


def as_nodes(folders: DataFrame, files: DataFrame) -> DataFrame:
    """Folders and files as one node table. Folders carry no size."""
    return folders.withColumn("type", F.lit(FOLDER)).unionByName(
        files.withColumn("type", F.lit(FILE)), allowMissingColumns=True
    )


def split_nodes(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node table to (folders without size, files)."""
    return nodes.where(F.col("type") == FOLDER).drop("size"), nodes.where(F.col("type") == FILE)


def world_filter(nodes: DataFrame, world: str | None = "") -> DataFrame:
    """Rows of one world; on a node store this prunes partitions. Empty means ``primary``."""
    return nodes.where(F.col("world") == P.world_name(world or ""))


def folders_only(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("type") == FOLDER)


def classify_entries(entries: DataFrame, root: str) -> DataFrame:
    """Directory entries ``(path, is_dir, length, mtime)`` of a mounted tree as node rows.

    Only true directories are folders; links and everything else are files with a size.
    """
    path = F.col("path")
    parent = F.regexp_replace(path, r"/[^/]*\z", "")
    parent = F.when(parent == "", "/").otherwise(parent)
    parent_path = P.relative_parent(parent, root)
    name = F.substring_index(path, "/", -1)
    rows = entries.select(
        F.lit("local").alias("world"),
        P.forward_slashes(path).alias("node_id"),
        parent.alias("parent_id"),
        parent_path.alias("parent_path"),
        name.alias("name"),
        P.child_location(parent_path, name).alias("location_path"),
        F.date_trunc("second", "mtime").alias("last_updated"),
        F.lit(0).alias("depth_level"),
        F.when(~F.col("is_dir"), F.col("length")).alias("size"),
        F.when(F.col("is_dir"), FOLDER).otherwise(FILE).alias("type"),
    )
    return with_depth(rows)


def format_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes as they are handed out: normalised paths and the time as RFC 3339 text."""
    return nodes.select(
        "world",
        "node_id",
        "parent_id",
        P.normalize_parent(F.col("parent_path")).alias("parent_path"),
        "name",
        P.normalize_location(F.col("location_path")).alias("location_path"),
        P.rfc3339(F.col("last_updated")).alias("last_updated"),
        "depth_level",
        "size",
        "type",
    )


def with_depth(nodes: DataFrame, compat: bool = False) -> DataFrame:
    """Depth from the logical path. With ``compat``, rows of mounted trees keep depth 0."""
    depth = P.depth_of(F.col("location_path"))
    if compat:
        depth = F.when(F.col("world") == "local", 0).otherwise(depth)
    return nodes.withColumn("depth_level", depth.cast("int"))


def totals_by_folder(nodes: DataFrame) -> DataFrame:
    """Child totals of every folder that has children; combined map-side before the shuffle."""
    return (
        nodes.where(F.col("parent_id").isNotNull())
        .groupBy(*FOLDER_KEY)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("type") == FOLDER).alias("total_folders"),
        )
    )


def child_counts(nodes: DataFrame) -> DataFrame:
    """Totals of every folder, zeros where it holds nothing."""
    totals = totals_by_folder(nodes).withColumnRenamed("parent_id", "node_id")
    folders = folders_only(nodes).select("world", "node_id")
    total, sub = F.coalesce("total", F.lit(0)), F.coalesce("total_folders", F.lit(0))
    return folders.join(totals, ["world", "node_id"], "left").select(
        "world",
        "node_id",
        total.alias("total"),
        sub.alias("total_folders"),
        (total - sub).alias("total_files"),
    )
