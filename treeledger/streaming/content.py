"""File bytes in bulk.

Who wins, what exists and what is refused is decided on narrow rows without bytes, which are stored
before they are used several times: one pass over the bytes takes their lengths (none where the
writes bring a ``length`` column), one more join takes the bytes across, on a unique key.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.functions import paths as P
from treeledger.operators.sieve import sift
from treeledger.schema import CONTENTS, FILE, NODE_COLUMNS, byte_length
from treeledger.sources.store import in_buckets, scan_contents, stored, stored_buckets, with_bucket

CONTENT_KEY = ["world", "node_id"]
HANDLE = ["world", "parent_id", "name"]


class Written(NamedTuple):
    """Outcome of a write: changed or new node rows, their bytes, and a status per request."""

    nodes: DataFrame
    contents: DataFrame
    status: DataFrame


def read_content(files: DataFrame, contents: DataFrame) -> DataFrame:
    """Add ``content`` and ``status`` to files ``(world, node_id, ..)``; a missing id is
    ``not_found``."""
    # An inner join, whose smaller side may be broadcast, so that a few files do not shuffle all
    # bytes. What is missing is found on ids alone.
    there = files.join(contents.select(*CONTENT_KEY, "content"), CONTENT_KEY).withColumn(
        "status", F.lit("ok")
    )
    known = contents.select(*CONTENT_KEY).join(
        files.select(*CONTENT_KEY).distinct(), CONTENT_KEY, "left_semi"
    )
    missing = files.join(known, CONTENT_KEY, "left_anti").withColumns(
        {"content": F.lit(None).cast("binary"), "status": F.lit("not_found")}
    )
    return there.unionByName(missing)


def read_stored(files: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """:func:`read_content` from a content store; reads only the buckets that the ids fall into. Their
    number is the store's; one that is given must be the same."""
    stored_contents = scan_contents(files.sparkSession, path)
    buckets = stored_buckets(files.sparkSession, path, buckets) or 1
    return read_content(files, in_buckets(stored_contents, with_bucket(files, buckets)))


def commit_files(staged: DataFrame, writes: DataFrame, nodes: DataFrame) -> Written:
    """Turn staged files into nodes with bytes.

    ``writes(world, parent_id, name, commit_seq, content)`` may name a handle several times; the
    first write with bytes is committed and later ones change nothing (``no_op``). Empty data is
    refused (``empty_data``), so is a handle that was never staged (``not_staged``) and a name the
    folder or a node at the same path already holds (``already_exists``). A name that is not its
    own normal form, such as ``x `` or ``../y``, or has a slash would take another file's path and
    id and is an ``invalid_name``. The size of the new node is that of its bytes.
    ``commit_seq`` is unique within a handle.
    """
    attempts = stored(
        writes.select(*HANDLE, "commit_seq", byte_length(writes).alias("_bytes")), "attempts"
    )
    first = (
        attempts.where("_bytes > 0")
        .groupBy(*HANDLE)
        .agg(F.min("commit_seq").alias("_first"))
    )
    stubs = (
        staged.where("status = 'staged'")
        .groupBy(*HANDLE)
        .agg(F.min_by(F.struct("parent_path", "location_path", "depth_level"), "staged_at").alias("_stub"))
    )
    # One row per handle that is written to: its stub, if any, and whether name and path are taken.
    # Stored, so that few handles are broadcast and the nodes are not shuffled to look them up.
    handles = stored(
        attempts.select(*HANDLE).distinct().join(stubs, HANDLE, "left")
        .withColumn("location_path", F.col("_stub.location_path")),
        "handles",
    )
    place = ["world", "location_path"]
    taken = nodes.select(*HANDLE).join(handles.select(*HANDLE), HANDLE, "left_semi").distinct()
    filled = (
        nodes.select("world", P.normalize_location(F.col("location_path")).alias("location_path"))
        .join(handles.select(*place), place, "left_semi").distinct()
    )
    handles = (
        handles.join(taken.withColumn("_taken", F.lit(True)), HANDLE, "left")
        .join(filled.withColumn("_filled", F.lit(True)), place, "left")
        .join(first, HANDLE, "left")
    )
    own_path = P.child_location(F.col("_stub.parent_path"), F.col("name"))
    valid = (F.col("_stub.location_path") == own_path) & ~F.contains("name", F.lit("/"))
    status = (
        F.when(F.col("_stub").isNull(), "not_staged")
        .when(~F.coalesce(valid, F.lit(False)), "invalid_name")
        .when(F.col("_bytes") == 0, "empty_data")
        .when(F.coalesce("_taken", "_filled"), "already_exists")
        .when(F.col("commit_seq") != F.col("_first"), "no_op")
        .otherwise("committed")
    )
    judged = stored(
        attempts.join(handles, HANDLE, "left").select(
            *HANDLE, "commit_seq", "_bytes", "_stub", status.alias("status")
        ),
        "judged",
    )
    won = judged.where("status = 'committed'").select(
        "world",
        P.node_key(F.col("_stub.location_path")).alias("node_id"),
        "parent_id",
        F.col("_stub.parent_path").alias("parent_path"),
        "name",
        F.col("_stub.location_path").alias("location_path"),
        F.current_timestamp().alias("last_updated"),
        F.col("_stub.depth_level").cast("int").alias("depth_level"),
        F.col("_bytes").cast("bigint").alias("size"),
        F.lit(FILE).alias("type"),
        "commit_seq",
    )
    new_contents = writes.join(
        won.select(*HANDLE, "commit_seq", "node_id"), [*HANDLE, "commit_seq"]
    ).select(*CONTENTS.fieldNames())
    return Written(
        won.select(*NODE_COLUMNS), new_contents, judged.select(*HANDLE, "commit_seq", "status")
    )


def overwrite_files(writes: DataFrame, nodes: DataFrame) -> Written:
    """Replace the bytes of files that exist.

    ``writes(world, node_id, write_seq, content)``: the latest write of an id is ``written``, earlier
    ones are ``superseded``; an id that is missing or no file is an error. Empty bytes are fine, they
    truncate. The outcome holds the changed rows only; ``sources.store.replace_contents`` puts them
    in place and rewrites no other bucket. ``write_seq`` is unique within an id.
    """
    attempts = stored(
        writes.select(*CONTENT_KEY, "write_seq", byte_length(writes).alias("_bytes")), "attempts"
    )
    latest = attempts.groupBy(*CONTENT_KEY).agg(F.max("write_seq").alias("_latest"))
    # Nodes nobody writes to are dropped first, without a shuffle of all nodes.
    named = sift(nodes, attempts, CONTENT_KEY)
    targets = latest.join(named, CONTENT_KEY, "left").select(
        *CONTENT_KEY, "_latest", F.struct(*NODE_COLUMNS).alias("_node")
    )
    status = (
        F.when(F.col("_node.type").isNull(), "not_found")
        .when(F.col("_node.type") != FILE, "not_file")
        .when(F.col("write_seq") != F.col("_latest"), "superseded")
        .otherwise("written")
    )
    judged = stored(
        attempts.join(targets, CONTENT_KEY, "left").select(
            *CONTENT_KEY, "write_seq", "_bytes", "_node", status.alias("status")
        ),
        "judged",
    )
    won = judged.where("status = 'written'")
    changed = won.select("_node", "_bytes").select("_node.*", "_bytes").withColumns({
        "size": F.col("_bytes").cast("bigint"), "last_updated": F.current_timestamp(),
    })
    # Bytes that lost are dropped before the others are shuffled.
    write_key = [*CONTENT_KEY, "write_seq"]
    new_contents = sift(writes, won, write_key).join(won.select(*write_key), write_key)
    return Written(
        changed.select(*NODE_COLUMNS),
        new_contents.select(*CONTENTS.fieldNames()),
        judged.select(*CONTENT_KEY, "write_seq", "status"),
    )
