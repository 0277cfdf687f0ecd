"""Copies between storage of any kind, as one stream of pieces.

A reader turns planned files into pieces ``(location_path, planned_size, chunk_no, start_byte, length,
content, problem)``, a writer drains pieces into its storage and says what became of each file. A mounted
tree and a content store are both, so four directions are four pairs, and no pair has code of its own.
Pieces are spread over tasks by bytes; no file has to fit a row, no byte passes the driver.

What is copied is decided on node rows of both sides before any byte is read, and every planned file has
one row in the outcome. A file counts only when all its pieces came and add up to its planned size.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.functions import paths as P
from treeledger.operators.sieve import sift
from treeledger.plans.copying import plan_between
from treeledger.plans.writing import create_folders
from treeledger.schema import COPY_BUFFER_BYTES, FILE, FOLDER, NODE_COLUMNS
from treeledger.sources import chunkstore
from treeledger.sources.store import stored
from treeledger.sources.tree import read_chunks, write_tree

PIECE_COLUMNS = ["location_path", "planned_size", "chunk_no", "start_byte", "length", "content", "problem"]


class Mount(NamedTuple):
    """A tree below ``root``, a path that all executors see. Ids are physical paths."""

    root: str

    def read(self, files: DataFrame, chunk: int) -> DataFrame:
        """Pieces of ``files(node_id, location_path, size)``."""
        pieces = read_chunks(files.select("node_id", "location_path", "size"), chunk)
        return pieces.select(
            "location_path", F.coalesce("size", F.lit(0)).cast("bigint").alias("planned_size"), "chunk_no", "start_byte",
            F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint").alias("length"), "content",
            F.when(F.col("status") != "ok", F.col("status")).alias("problem"),
        )

    def write(self, pieces: DataFrame, chunk: int) -> tuple[DataFrame | None, DataFrame]:
        """``(None, (location_path, size, status))``: the mount itself lists what it holds."""
        return None, write_tree(pieces, self.root)


class Store(NamedTuple):
    """A world of a content store at ``path`` (``sources.chunkstore``), listed by ``nodes``."""

    spark: SparkSession
    path: str
    nodes: DataFrame
    world: str

    def read(self, files: DataFrame, chunk: int) -> DataFrame:
        """Pieces of ``files(node_id, location_path, size)``, cut as ``chunk`` asks for. A file without
        chunks is one piece, ``not_found``."""
        asked = files.select(
            F.lit(self.world).alias("world"), "node_id", "location_path",
            F.coalesce("size", F.lit(0)).cast("bigint").alias("planned_size"),
        )
        *_, own = chunkstore.current(self.spark, self.path)
        data = chunkstore.near_chunks(self.spark, self.path, asked)
        # Bytes of files that nobody asks for are dropped before the others are shuffled.
        there = asked.join(sift(data, asked, chunkstore.KEY), chunkstore.KEY)
        if own != chunk:  # cut at this store's borders and at the other's
            first, last = F.expr(f"start_byte div {chunk}"), F.expr(f"(start_byte + greatest(length, 1) - 1) div {chunk}")
            begin = F.greatest(F.col("start_byte"), F.col("_no") * chunk)
            end = F.least(F.col("start_byte") + F.col("length"), (F.col("_no") + 1) * chunk)
            there = there.withColumn("_no", F.explode(F.sequence(first, last))).select(
                *asked.columns, F.col("_no").alias("chunk_no"), begin.alias("start_byte"), (end - begin).alias("length"),
                F.substring("content", (begin - F.col("start_byte") + 1).cast("int"), (end - begin).cast("int")).alias("content"),
            )
        none = asked.join(data.select(*chunkstore.KEY).distinct(), chunkstore.KEY, "left_anti")
        zero = F.lit(0).cast("bigint")
        return there.withColumn("problem", F.lit(None).cast("string")).select(*PIECE_COLUMNS).unionByName(
            none.withColumns({
                "chunk_no": zero, "start_byte": zero, "length": zero, "content": F.lit(None).cast("binary"),
                "problem": F.lit("not_found"),
            }).select(*PIECE_COLUMNS)
        )

    def write(self, pieces: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
        """``(nodes, (location_path, size, status))``: new and changed node rows, folders among them.

        Bytes are written to the shared folder once; what is whole, what has to be made and what is in
        the way is decided on narrow rows, and then one version of the touched buckets takes the bytes.
        """
        *_, own = chunkstore.current(self.spark, self.path)
        target = F.lit(self.world).alias("world")
        path = P.normalize_location(F.col("location_path"))
        given = stored(pieces.withColumn("location_path", path), "pieces")
        mine = self.nodes.where(F.col("world") == self.world)
        here = mine.select(
            "location_path", F.col("node_id").alias("_id"), F.col("type").alias("_type"), F.struct(*NODE_COLUMNS).alias("_node")
        )
        # Pieces that were cut for another chunk size are joined to whole chunks of this store.
        narrow = given.select(
            F.lit(self.world).alias("world"), F.col("location_path").alias("node_id"),
            F.expr(f"start_byte div {own}").alias("chunk_no"), "start_byte", "length",
        )
        cut = narrow.where(F.col("start_byte") % own != 0).isEmpty() and narrow.where(F.col("length") > own).isEmpty()
        if not cut:
            raise ValueError(f"pieces for this store are cut at multiples of {own} bytes")
        states = chunkstore.file_states(narrow, own).withColumnRenamed("node_id", "location_path").drop("world")
        told = given.groupBy("location_path").agg(F.max("planned_size").alias("planned_size"), F.min("problem").alias("problem"))
        files = stored(
            told.join(states, "location_path").join(here, "location_path", "left").withColumn(
                "refusal",
                F.when(F.col("problem").isNotNull(), F.col("problem"))
                .when(~F.col("whole") | (F.col("size") != F.coalesce("planned_size", "size")), "incomplete")
                .when(F.col("_type") == FOLDER, "conflict"),
            ), "files",
        )
        made = files.where("refusal is null and _id is null")
        folders, asked = create_folders(made.select(target, P.parent_location(F.col("location_path")).alias("path")), self.nodes)
        folders = stored(folders, "folders")
        blocked = stored(asked.where("status = 'not_folder'").select(F.col("path").alias("parent_path")), "blocked")
        judged = stored(
            files.withColumn("parent_path", P.parent_location(F.col("location_path")))
            .join(blocked.withColumn("_blocked", F.lit(True)), "parent_path", "left")
            .withColumn("refusal", F.coalesce("refusal", F.when(F.col("_id").isNull() & F.col("_blocked"), "blocked"))),
            "judged",
        )
        good = judged.where("refusal is null").withColumn("node_id", F.coalesce("_id", P.node_key(F.col("location_path"))))
        ids = stored(good.select("location_path", "node_id"), "ids")
        chunks = given.join(ids, "location_path").select(
            target, "node_id", "chunk_no", "start_byte", "length", F.coalesce("content", F.lit(b"")).alias("content")
        )
        chunkstore.replace_chunks(self.spark, self.path, chunks)
        parents = mine.where(F.col("type") == FOLDER).unionByName(folders).select(
            F.col("location_path").alias("parent_path"), F.col("node_id").alias("parent_id")
        )
        location = F.col("location_path")
        new = good.where("_id is null").join(parents, "parent_path").select(
            target, "node_id", "parent_id", "parent_path", P.last_segment(location).alias("name"), "location_path",
            F.current_timestamp().alias("last_updated"), P.depth_of(location).cast("int").alias("depth_level"), "size",
            F.lit(FILE).alias("type"),
        )
        changed = good.where("_id is not null").select("_node", F.col("size").alias("_size")).select("_node.*", "_size").withColumns(
            {"size": F.col("_size"), "last_updated": F.current_timestamp()}
        ).select(*NODE_COLUMNS)
        status = judged.select("location_path", "size", F.coalesce("refusal", F.lit("written")).alias("status"))
        return folders.unionByName(new).unionByName(changed), status


def transfer(
    source: Mount | Store, source_nodes: DataFrame, destination: Mount | Store, destination_nodes: DataFrame,
    chunk: int = COPY_BUFFER_BYTES,
) -> tuple[DataFrame | None, DataFrame]:
    """Bring the files of ``source_nodes`` to the destination: ``(new nodes or None, outcome)``.

    ``outcome`` has one row per planned file: ``(location_path, action, size, status)``. Files of equal
    size are ``skipped``, a folder in the way is a ``conflict``; others are ``copied`` or ``overwritten``, or
    have the reader's or the writer's problem as status. Into a store, ``chunk`` is that store's.
    """
    if isinstance(destination, Store):
        *_, chunk = chunkstore.current(destination.spark, destination.path)
    plan = stored(plan_between(source_nodes, destination_nodes), "plan")
    moving = plan.where("action in ('copy', 'overwrite')")
    nodes, status = destination.write(source.read(moving, chunk), chunk)
    done = status.select(
        P.normalize_location(F.col("location_path")).alias("location_path"), F.col("size").alias("_size"),
        F.col("status").alias("_status"),
    )
    outcome = (
        F.when(F.col("action") == "skip", "skipped").when(F.col("action") == "conflict", "conflict")
        .when(F.col("_status") != "written", F.col("_status")).when(F.col("_status").isNull(), "lost")
        .when(F.col("action") == "copy", "copied").otherwise("overwritten")
    )
    return nodes, plan.join(done, "location_path", "left").select(
        "location_path", "action", F.coalesce("_size", "size").alias("size"), outcome.alias("status")
    )
