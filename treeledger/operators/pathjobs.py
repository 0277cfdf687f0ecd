"""Table jobs that rewrite or check the path columns of a node table."""

import posixpath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.functions import paths as P


def normalize_nodes(nodes: DataFrame) -> DataFrame:
    """Both logical path columns in normal form. Narrow: no shuffle."""
    return nodes.withColumns({
        "location_path": P.normalize_location(F.col("location_path")),
        "parent_path": P.normalize_parent(F.col("parent_path")),
    })


def path_collisions(nodes: DataFrame) -> DataFrame:
    """Logical paths that several rows of one world share once normalised, with the row count.

    Grouped with map-side counts, so one path with very many copies is no hot task.
    """
    return (
        nodes.select("world", P.normalize_location(F.col("location_path")).alias("location_path"))
        .groupBy("world", "location_path")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def normalize_physical(paths: DataFrame, column: str = "p") -> DataFrame:
    """Add ``physical``, the normal form of a physical path column."""
    return paths.withColumn("physical", P.normalize_physical(F.col(column)))


def relocate_nodes(nodes: DataFrame, root: str, compat: bool = False) -> DataFrame:
    """Fill the logical path columns from physical ``parent_id`` and ``name``."""
    if not root.startswith("/"):
        raise ValueError("the root must be an absolute path")
    parent_path = P.relative_parent(F.col("parent_id"), posixpath.normpath(root), compat)
    return nodes.withColumns({
        "parent_path": parent_path,
        "location_path": P.child_location(parent_path, F.col("name")),
    })


def child_paths(parents: DataFrame, names: DataFrame) -> DataFrame:
    """Logical and physical path of every wanted child.

    ``parents(parent_id, parent_path)`` has one row per folder, ``names(parent_id, name)`` many.
    """
    return names.join(parents.select("parent_id", "parent_path"), "parent_id").select(
        "parent_id",
        "name",
        P.child_location(F.col("parent_path"), F.col("name")).alias("location_path"),
        P.child_physical(F.col("parent_id"), F.col("name")).alias("physical_path"),
    )


def root_guard(
    rows: DataFrame, root: Column | str, column: str = "path", compat: bool = False
) -> DataFrame:
    """Add ``allowed`` and, for paths outside their root, the ``violation`` text."""
    root = P.text(root)
    path = F.col(column)
    allowed = P.under_root(path, root, compat)
    problem = F.concat(F.lit("path "), path, F.lit(" is outside allowed root "), root)
    return rows.withColumns({"allowed": allowed, "violation": F.when(~allowed, problem)})
