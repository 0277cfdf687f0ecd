"""Planning writes: folders to make, files to stage, pending ids to read."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.functions import paths as P
from treeledger.operators.sieve import sift
from treeledger.schema import FILE, FOLDER, NODE_COLUMNS, PENDING_PREFIX
from treeledger.sources.store import stored


def create_folders(wanted: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(new nodes, status)`` for wanted folders ``(world, path)``.

    Missing ancestors are made too, existing folders are no error, and a path that runs through a
    file is refused as ``not_folder`` without making anything for it. The distinct paths, the
    folders on the way to them and the refused paths are stored since several steps use them.
    """
    paths = stored(
        wanted.select("world", P.normalize_location(F.col("path")).alias("path")).distinct(), "paths"
    )
    step = F.explode(P.prefixes(F.col("path"))).alias("step")
    steps = paths.select("world", "path", step)
    # Nothing is made in a file, so that the ids of files are not needed.
    existing = nodes.select(
        "world", F.col("location_path").alias("step"), F.col("type").alias("_type"),
        F.when(~F.col("type").eqNullSafe(F.lit(FILE)), F.col("node_id")).alias("_id"),
    )
    # Nodes off the way are dropped first, so that a few steps do not shuffle all nodes.
    places = stored(steps.select("world", "step").distinct(), "places")
    known = stored(
        places.join(sift(existing, places, ["world", "step"]), ["world", "step"], "left"), "steps"
    )

    # Steps that are no file are dropped before the join: of every path, its upper folders, which are
    # shared by so many paths that they would come together in a few tasks.
    files = known.where(F.col("_type") == FILE).select("world", "step")
    blocked = stored(
        sift(steps, files, ["world", "step"]).join(files, ["world", "step"])
        .select("world", "path").distinct(), "blocked",
    )
    is_there = known.where(F.col("_type") == FOLDER).select(
        "world", F.col("step").alias("path"), F.lit(True).alias("_there")
    )
    status = (
        paths.join(blocked.withColumn("_blocked", F.lit(True)), ["world", "path"], "left")
        .join(is_there, ["world", "path"], "left")
        .select(
            "world",
            "path",
            F.when(F.col("_blocked"), "not_folder")
            .when(F.col("_there"), "exists")
            .otherwise("created")
            .alias("status"),
        )
    )

    allowed = paths.join(blocked, ["world", "path"], "left_anti").select("world", step).distinct()
    missing = known.where(F.col("_type").isNull()).select("world", "step")
    made = allowed.join(missing, ["world", "step"], "left_semi").withColumn(
        "parent_path", P.parent_location(F.col("step"))
    )
    parents = known.where(F.col("_id").isNotNull()).select(
        "world", F.col("step").alias("parent_path"), F.col("_id").alias("_parent_id")
    )
    new_parent = F.when(
        F.col("parent_path").isNotNull(),
        F.coalesce("_parent_id", P.node_key(F.col("parent_path"))),
    )
    new_nodes = made.join(parents, ["world", "parent_path"], "left").select(
        "world",
        P.node_key(F.col("step")).alias("node_id"),
        new_parent.alias("parent_id"),
        "parent_path",
        P.last_segment(F.col("step")).alias("name"),
        F.col("step").alias("location_path"),
        F.current_timestamp().alias("last_updated"),
        P.depth_of(F.col("step")).cast("int").alias("depth_level"),
        F.lit(None).cast("bigint").alias("size"),
        F.lit(FOLDER).alias("type"),
    )
    return new_nodes.select(*NODE_COLUMNS), status


def stage_files(wanted: DataFrame, nodes: DataFrame, compat: bool = False) -> DataFrame:
    """Stub rows for files to be written: ``wanted(world, parent_id, name, size, metadata)``.

    The stub keeps the caller's size and metadata. Its path is built on the parent's own path; with
    ``compat`` on the parent's parent path. Rows whose parent is missing or no folder carry a status.
    """
    # Nodes nobody names are dropped first: by a broadcast of the names, where these are few.
    parents = nodes.select(
        "world",
        F.col("node_id").alias("parent_id"),
        F.col("type").alias("_type"),
        P.normalize_parent(F.col("parent_path") if compat else F.col("location_path")).alias(
            "parent_path"
        ),
        F.col("depth_level").alias("_depth"),
    ).join(wanted.select("world", "parent_id").distinct(), ["world", "parent_id"], "left_semi")
    parent_path = P.filled(F.col("parent_path"))
    status = (
        F.when(F.col("_type").isNull(), "not_found")
        .when(F.col("_type") != FOLDER, "not_folder")
        .otherwise("staged")
    )
    pending = F.concat(F.lit(PENDING_PREFIX), F.col("parent_id"), F.lit(":"), F.col("name"))
    return wanted.join(parents, ["world", "parent_id"], "left").select(
        pending.alias("pending_id"),
        "world",
        "parent_id",
        F.when(F.col("_type").isNotNull(), parent_path).alias("parent_path"),
        "name",
        F.when(
            F.col("_type").isNotNull(),
            P.normalize_location(P.child_location(parent_path, F.col("name"))),
        ).alias("location_path"),
        "size",
        (F.col("_depth") + 1).alias("depth_level"),
        "metadata",
        F.current_timestamp().alias("staged_at"),
        status.alias("status"),
    )


def decode_pending(staged: DataFrame) -> DataFrame:
    """Replace ``pending_id`` by the parent id and name in it. The name may hold further colons."""
    pending = F.col("pending_id")
    parts = F.split(pending, ":", 3)
    has_prefix = pending.startswith(PENDING_PREFIX)
    complete = has_prefix & (F.size(parts) == 3)
    status = (
        F.when(~F.coalesce(has_prefix, F.lit(False)), "not_pending")
        .when(~complete, "bad_format")
        .otherwise("ok")
    )
    return staged.withColumns({
        "parent_id": F.when(complete, F.get(parts, F.lit(1))),
        "name": F.when(complete, F.get(parts, F.lit(2))),
        "status": status,
    })
