"""Bringing one world of a node store up to date with another."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.functions import paths as P
from treeledger.plans.copying import copy_plan
from treeledger.plans.writing import create_folders
from treeledger.schema import FILE, FOLDER, NODE_COLUMNS, byte_length
from treeledger.sources.store import stored
from treeledger.sources.tree import read_chunks, write_tree
from treeledger.streaming.content import read_content


class Copied(NamedTuple):
    """What a copy adds to or changes in the destination world, and a status per planned file."""

    new_nodes: DataFrame
    changed_nodes: DataFrame
    contents: DataFrame
    status: DataFrame


def bulk_copy(nodes: DataFrame, contents: DataFrame, source: str, destination: str) -> Copied:
    """Copy every file that :func:`copy_plan` marks ``copy`` or ``overwrite``.

    Missing folders are made, files are placed in them, and all of that is settled and stored as
    narrow tables before any byte moves; then one join on the source id takes the bytes across. A
    file to be made whose bytes are missing or empty is reported as ``no_data`` and not made, nor is
    one whose folder cannot be made since a file is in the way (``blocked``); overwriting with empty bytes truncates. Sizes come from the bytes, not from the plan.
    """
    target = F.lit(destination).alias("world")
    have = contents.where(F.col("world") == source)
    plan = stored(
        copy_plan(nodes, source, destination).join(
            have.select("node_id", byte_length(have).alias("bytes")), "node_id", "left"
        ),
        "plan",
    )
    wanted = plan.where("action = 'copy' and bytes > 0").select(
        target, P.parent_location(F.col("location_path")).alias("path")
    )
    folders, made = create_folders(wanted, nodes)
    folders = stored(folders, "folders")
    blocked = stored(
        made.where("status = 'not_folder'").select(
            F.col("path").alias("parent_path"), F.lit(True).alias("blocked")
        ),
        "blocked",
    )
    plan = plan.withColumn("parent_path", P.parent_location(F.col("location_path"))).join(
        blocked, "parent_path", "left"
    )
    moving = plan.where(
        ((F.col("action") == "copy") & (F.col("bytes") > 0) & F.col("blocked").isNull())
        | ((F.col("action") == "overwrite") & F.col("bytes").isNotNull())
    )
    created = moving.where("action = 'copy'")
    parents = (
        nodes.where((F.col("world") == destination) & (F.col("type") == FOLDER))
        .unionByName(folders)
        .select(F.col("location_path").alias("parent_path"), F.col("node_id").alias("parent_id"))
    )
    new_files = created.join(parents, "parent_path").select(
        target,
        P.node_key(F.col("location_path")).alias("node_id"),
        "parent_id",
        "parent_path",
        P.last_segment(F.col("location_path")).alias("name"),
        "location_path",
        F.current_timestamp().alias("last_updated"),
        P.depth_of(F.col("location_path")).cast("int").alias("depth_level"),
        F.col("bytes").alias("size"),
        F.lit(FILE).alias("type"),
    )
    changed = (
        nodes.where(F.col("world") == destination)
        .join(
            moving.where("action = 'overwrite'").select(
                F.col("dst_node_id").alias("node_id"), "bytes"
            ),
            "node_id",
        )
        .withColumns({"size": F.col("bytes"), "last_updated": F.current_timestamp()})
        .select(*NODE_COLUMNS)
    )
    ids = moving.select(
        F.lit(source).alias("world"),
        "node_id",
        F.coalesce("dst_node_id", P.node_key(F.col("location_path"))).alias("_to"),
    )
    moved = read_content(ids, have).select(target, F.col("_to").alias("node_id"), "content")

    moves = F.col("bytes").isNotNull() & (
        (F.col("bytes") > 0) | (F.col("action") == "overwrite")
    )
    outcome = (
        F.when(F.col("action") == "skip", "skipped")
        .when(F.col("action") == "conflict", "conflict")
        .when(~moves, "no_data")
        .when((F.col("action") == "copy") & F.col("blocked"), "blocked")
        .when(F.col("action") == "copy", "copied")
        .otherwise("overwritten")
    )
    return Copied(
        folders.unionByName(new_files),
        changed,
        moved,
        plan.select("location_path", "action", outcome.alias("status")),
    )


def copy_tree(files: DataFrame, root: str, buffer: int = 0) -> DataFrame:
    """Copy mounted files ``(node_id, location_path, size)`` below another root, piece by piece.

    Pieces go from the task that reads them straight to the staged file. One status row per planned
    file: ``written`` only if all bytes of its planned size arrived, else what went wrong
    (``not_found``, ``short_read``) and nothing is committed.
    """
    chunks = read_chunks(files.select("node_id", "location_path", "size"), buffer)
    return write_tree(
        chunks.select(
            "location_path", "start_byte", "content",
            F.coalesce("size", F.lit(0)).cast("bigint").alias("planned_size"),
            F.when(F.col("status") != "ok", F.col("status")).alias("problem"),
        ),
        root,
    )
