"""Every operator as a runnable query over the given tables: ``(spark, folder) -> DataFrame``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger import fixtures as X
from treeledger.functions import paths as P
from treeledger.operators import listing, nodes, paging, pathjobs, routing
from treeledger.oracles import RELOCATE_ROOT
from treeledger.plans import bulkcopy, copying, serving, writing
from treeledger.schema import NODE_COLUMNS, NODES
from treeledger.sources import store, tree
from treeledger.streaming import content

c = F.col


def _shown(*more: str):
    """Select list that prints node rows alike on every engine."""
    printed = {
        "last_updated": P.rfc3339(c("last_updated")),
        "depth_level": c("depth_level").cast("bigint"),
    }
    return [*more, *[printed.get(n, c(n)).alias(n) for n in NODE_COLUMNS]]


def _map_text(column: str):
    pair = F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pair), ",")


def _digest(column: str = "content"):
    return F.md5(column).alias("digest")


def _mount(spark: SparkSession, purpose: str) -> str:
    folder = store.shared_dir(spark, purpose)
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    if not folder.startswith("/"):
        raise RuntimeError("a mounted tree needs a shared folder that is mounted")
    return folder


def flagship(spark, folder) -> DataFrame:
    """Children 3 to 12 of every nation folder of world ``primary``, with totals."""
    tree_nodes = X.star_nodes(spark, folder)
    requests = (
        nodes.world_filter(tree_nodes).where("depth_level = 2 AND type = 'folder'")
        .select(
            F.col("node_id").alias("request_id"), "world", c("node_id").alias("parent_id"),
            F.lit(3).alias("offset"), F.lit(10).alias("limit"), F.lit(False).alias("folders_only"),
        )
    )
    rows = paging.window_children(requests, tree_nodes)
    info = paging.page_info(requests, tree_nodes).select("request_id", "total", "has_more")
    return rows.join(info, "request_id").select(*_shown("idx", "total", "has_more"))


def _document_files(spark, folder, world="primary") -> DataFrame:
    return X.document_nodes(spark, folder).where(c("world") == world)


def write_tree(spark, folder) -> DataFrame:
    files = _document_files(spark, folder)
    written = tree.write_tree(files.select("location_path", "content"), root := _mount(spark, "tree"))
    back = tree.read_chunks(
        tree.scan_tree(spark, root).where("type = 'file'").select("node_id", "location_path", "size")
    )
    return written.join(back.select("location_path", _digest()), "location_path")


def copy_tree(spark, folder) -> DataFrame:
    source, target = _mount(spark, "from"), _mount(spark, "to")
    tree.write_tree(
        _document_files(spark, folder).select("location_path", "content"), source
    )
    files = tree.scan_tree(spark, source).where("type = 'file'")
    # Pieces far below the usual size, so that files are put together from several tasks.
    copied = bulkcopy.copy_tree(files, target, buffer=4096)
    back = tree.read_chunks(
        tree.scan_tree(spark, target).where("type = 'file'").select("node_id", "location_path", "size")
    )
    return copied.join(back.select("location_path", _digest()), "location_path")


def scan_tree(spark, folder) -> DataFrame:
    root = _mount(spark, "tree")
    tree.write_tree(_document_files(spark, folder).select("location_path", "content"), root)
    return tree.scan_tree(spark, root, first_budget=20).select(
        "parent_path", "name", "location_path", c("depth_level").cast("bigint").alias("depth_level"),
        "size", "type",
    )


def write_nodes(spark, folder) -> DataFrame:
    """A new node store from the given tables, read back whole."""
    path = store.shared_dir(spark, "nodes")
    store.write_nodes(X.build_star_nodes(spark, folder), path)
    return spark.read.schema(NODES).parquet(path).select(*_shown())


def read_content(spark, folder) -> DataFrame:
    """All ids of ``primary``, asked in both worlds."""
    ids = _document_files(spark, folder).select(P.node_key(c("location_path")).alias("node_id"))
    asked = ids.withColumn("world", F.explode(F.array(F.lit("primary"), F.lit("s1"))))
    return content.read_content(asked, X.document_contents(spark, folder)).select(
        "world", "node_id", "status", F.octet_length("content").cast("bigint").alias("bytes"), _digest()
    )


def _bulk_copy(spark, folder):
    return bulkcopy.bulk_copy(
        X.document_tree(spark, folder), X.document_contents(spark, folder), "primary", "s1"
    )


def bulk_copy(spark, folder) -> DataFrame:
    copied = _bulk_copy(spark, folder)
    bytes_by_id = copied.contents.select("node_id", _digest())
    return copied.new_nodes.unionByName(copied.changed_nodes).join(
        bytes_by_id, "node_id", "left"
    ).select("location_path", "type", "size", "digest")


def raw_nodes(spark, folder) -> DataFrame:
    """Both worlds with their paths spelt in seven ways, and edge cases."""
    path = c("location_path")
    spelt = (
        F.when(F.length(path) % 7 == 0, path)
        .when(F.length(path) % 7 == 1, F.replace(path, F.lit("/"), F.lit("//")))
        .when(F.length(path) % 7 == 2, F.replace(path, F.lit("/"), F.lit("\\")))
        .when(F.length(path) % 7 == 3, F.concat(F.lit("  "), path, F.lit("\t")))
        .when(F.length(path) % 7 == 4, F.concat(F.lit("/x/.."), path, F.lit("/")))
        .when(F.length(path) % 7 == 5, F.concat(F.lit("x/../.."), path, F.lit("/./y/..")))
        .otherwise(F.expr("substr(location_path, 2)"))
    )
    edges = [
        "", "   ", "/", "//a///b/", "a/b", "\\a\\b", "a\\..\\b", "/../../x", "./a/./b", "/a/../..",
        "...", "/.../x", "a/../../b", "../..", "\t/t\t", "\u00a0n\u3000", "\u200bz", "/é/ü",
        "/home/user2/x", "a/", "\\", "/a\\/b",
    ]
    odd = spark.createDataFrame([(e,) for e in edges], "p string").select(
        F.lit("edge").alias("world"), c("p").alias("node_id"), c("p").alias("location_path"),
        c("p").alias("parent_path"),
    )
    return X.star_nodes(spark, folder).select(
        "world", "node_id", spelt.alias("location_path"), "parent_path"
    ).unionByName(odd)


def _local(spark, folder) -> DataFrame:
    return X.star_nodes(spark, folder, local=True).where("world = 'local'")


def child_paths(spark, folder) -> DataFrame:
    local = _local(spark, folder)
    parents = nodes.folders_only(local).select(
        c("node_id").alias("parent_id"), c("location_path").alias("parent_path")
    )
    return pathjobs.child_paths(parents, local.where("parent_id IS NOT NULL").select("parent_id", "name"))


def classify_entries(spark, folder) -> DataFrame:
    entries = _local(spark, folder).where("parent_id IS NOT NULL").select(
        c("node_id").alias("path"), (c("type") == "folder").alias("is_dir"),
        c("size").alias("length"), c("last_updated").alias("mtime"),
    )
    return nodes.classify_entries(entries, "/data").select(*_shown())


def _skewed(spark, folder) -> DataFrame:
    """A third of all files in one folder."""
    return X.star_nodes(spark, folder).withColumn(
        "parent_id", F.when(c("size") % 3 == 0, "hot").otherwise(c("parent_id"))
    )


def _services(spark, folder) -> DataFrame:
    return routing.service_dimension(X.raw_services(spark, folder)).where("status = 'ok'")


def children_once(spark, folder) -> DataFrame:
    """Both parts in one: the folder of each request, and each child with no request."""
    folders, children = listing.children_once(X.folder_requests(spark, folder), X.star_nodes(spark, folder))
    return folders.unionByName(children.select(*_shown()), allowMissingColumns=True)


def resolve_requests(spark, folder) -> DataFrame:
    return routing.resolve_requests(
        X.requests(spark, folder), _services(spark, folder), X.sessions(spark)
    ).select("request_id", "service_id", "served_by", "kind", "root", "world", "target", "status")


def _serve(spark, folder):
    return serving.serve_listing(
        X.requests(spark, folder), _services(spark, folder), X.sessions(spark),
        X.star_nodes(spark, folder, local=True),
    )


def list_sources(spark, folder) -> DataFrame:
    return routing.list_sources(
        _services(spark, folder), X.star_nodes(spark, folder, local=True)
    ).withColumn("metadata", _map_text("metadata"))


def _folders_wanted(spark, folder):
    tree_nodes = X.star_nodes(spark, folder)
    primary = tree_nodes.where("world = 'primary'")
    under = F.concat(
        c("parent_path"), F.lit("/new"), F.length("name"), F.lit("/"), c("name")
    )
    wanted = (
        primary.where("depth_level = 3").select("world", under.alias("path"))
        .unionByName(
            primary.where("type = 'file'").select(
                "world", F.concat("location_path", F.lit("/sub")).alias("path")
            )
        )
        .unionByName(
            nodes.folders_only(primary).select(F.lit("s1").alias("world"), c("location_path").alias("path"))
        )
        .unionByName(X.web_paths(spark, folder).select("world", "path"))
    )
    return writing.create_folders(wanted, tree_nodes)


def create_folders(spark, folder) -> DataFrame:
    return _folders_wanted(spark, folder)[0].select(
        "world", "node_id", "parent_id", "parent_path", "name", "location_path",
        c("depth_level").cast("bigint").alias("depth_level"),
    )


def stage_files(spark, folder) -> DataFrame:
    tree_nodes = X.star_nodes(spark, folder)
    parent = (
        F.when(F.length("name") % 5 == 0, c("node_id"))
        .when(F.length("name") % 7 == 0, "gone")
        .otherwise(c("parent_id"))
    )
    wanted = tree_nodes.where("type = 'file'").select(
        "world", parent.alias("parent_id"), F.concat(F.lit("new:"), "name").alias("name"), "size",
        F.create_map(F.lit("from"), "location_path").alias("metadata"),
    )
    return writing.stage_files(wanted, tree_nodes).drop("staged_at").withColumns({
        "metadata": _map_text("metadata"), "depth_level": c("depth_level").cast("bigint"),
    })


def decode_pending(spark, folder) -> DataFrame:
    parent, name = c("parent_id"), c("name")
    size = F.length("name") % 4
    pending = (
        F.when(size == 0, F.concat(F.lit("pending:"), parent, F.lit(":"), name))
        .when(size == 1, F.concat(F.lit("pending:"), parent, F.lit(":v1:"), name))
        .when(size == 2, F.concat(F.lit("pending:"), parent))
        .otherwise(F.concat(parent, F.lit(":"), name))
    )
    return writing.decode_pending(
        X.star_nodes(spark, folder).where("parent_id IS NOT NULL").select(pending.alias("pending_id"))
    )


def _commits(spark, folder):
    """Handles that are staged or not, taken or free, written once or twice, with or without data."""
    tree_nodes = X.document_tree(spark, folder)
    k = c("doc_id")
    handles = _document_files(spark, folder).select(
        "world",
        "doc_id",
        P.node_key(P.parent_location(c("location_path"))).alias("parent_id"),
        F.when(k % 10 == 3, F.concat(k, F.lit(".txt"))).otherwise(F.concat(F.lit("new-"), k)).alias("name"),
        "content",
    )
    staged = writing.stage_files(
        handles.where(k % 9 != 2).select(
            "world", "parent_id", "name", F.lit(0).cast("bigint").alias("size"),
            F.lit(None).cast("map<string,string>").alias("metadata"),
        ),
        tree_nodes,
    )
    nothing = F.lit(b"")
    again = F.concat("content", F.lit(b" again"))
    tries = F.array_compact(F.array(
        F.struct(F.lit(0).alias("commit_seq"), F.when(k % 6 == 1, nothing).otherwise(c("content")).alias("data")),
        F.when((k % 4 == 0) | (k % 6 == 1), F.struct(F.lit(1).alias("commit_seq"), again.alias("data"))),
    ))
    writes = handles.select("world", "parent_id", "name", F.inline(tries)).withColumnRenamed("data", "content")
    return content.commit_files(staged, writes, tree_nodes)


def commit_files(spark, folder) -> DataFrame:
    done = _commits(spark, folder)
    return done.nodes.join(done.contents.select("node_id", _digest()), "node_id").select(
        "node_id", "location_path", "size", "digest"
    )


def commit_files_status(spark, folder) -> DataFrame:
    folders = nodes.folders_only(X.document_tree(spark, folder)).select(
        "world", c("node_id").alias("parent_id"), c("location_path").alias("at")
    )
    return _commits(spark, folder).status.join(folders, ["world", "parent_id"]).select(
        P.child_location(c("at"), c("name")).alias("path"),
        c("commit_seq").cast("bigint").alias("commit_seq"), "status",
    )


def _overwrites(spark, folder):
    k = c("doc_id")
    files = _document_files(spark, folder).select(
        "world", "doc_id", "content", P.node_key(c("location_path")).alias("node_id"),
        P.node_key(P.parent_location(c("location_path"))).alias("parent_id"),
    )
    upper = F.concat(F.lit(b"UP:"), "content")
    changed = F.when(k % 6 == 0, F.lit(b"")).otherwise(F.concat("content", F.lit(b"!")))

    def write(node_id, seq, data):
        return F.struct(
            node_id.alias("node_id"), seq.cast("bigint").alias("write_seq"), data.alias("content")
        )

    writes = files.select(
        "world",
        F.inline(F.array_compact(F.array(
            write(F.when(k % 7 == 0, F.concat(F.lit("gone-"), k)).otherwise(c("node_id")), F.lit(0), upper),
            F.when(k % 3 == 0, write(c("node_id"), F.lit(1), changed)),
            write(c("parent_id"), k + 2, c("content")),
        ))),
    )
    return content.overwrite_files(writes, X.document_tree(spark, folder))


def overwrite_files(spark, folder) -> DataFrame:
    """The whole content store, both worlds, after the overwrites went in."""
    path = store.shared_dir(spark, "contents")
    store.write_contents(X.document_contents(spark, folder), path, 8)
    store.replace_contents(spark, _overwrites(spark, folder).contents, path)
    return store.scan_contents(spark, path).select(
        "world", "node_id", F.octet_length("content").cast("bigint").alias("size"), _digest()
    )


def split_nodes(spark, folder) -> DataFrame:
    folders, files = nodes.split_nodes(X.star_nodes(spark, folder))
    return folders.groupBy(F.lit("folder").alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(None).cast("bigint").alias("bytes")
    ).unionByName(
        files.groupBy(F.lit("file").alias("part")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")
        )
    )


QUERIES = {
    "flagship": flagship,
    "scan_tree": scan_tree,
    "write_nodes": write_nodes,
    "scan_nodes": lambda s, d: store.scan_nodes(s, X.node_store(s, d), "s1").select(*_shown()),
    "read_content": read_content,
    "write_tree": write_tree,
    "copy_tree": copy_tree,
    "bulk_copy": bulk_copy,
    "bulk_copy_status": lambda s, d: _bulk_copy(s, d).status,
    "normalize_nodes": lambda s, d: pathjobs.normalize_nodes(raw_nodes(s, d)),
    "normalize_collisions": lambda s, d: pathjobs.path_collisions(
        raw_nodes(s, d).withColumn("world", F.lit("all"))
    ),
    "normalize_physical": lambda s, d: pathjobs.normalize_physical(
        raw_nodes(s, d).select("world", "node_id", c("location_path").alias("p"))
    ),
    "relocate_nodes": lambda s, d: pathjobs.relocate_nodes(
        _local(s, d).where("parent_id IS NOT NULL"), RELOCATE_ROOT
    ).select("node_id", "parent_path", "location_path"),
    "relocate_nodes_compat": lambda s, d: pathjobs.relocate_nodes(
        _local(s, d).where("parent_id IS NOT NULL"), RELOCATE_ROOT, compat=True
    ).select("node_id", "parent_path", "location_path"),
    "child_paths": child_paths,
    "root_guard": lambda s, d: pathjobs.root_guard(
        _local(s, d).select(c("node_id").alias("path")), RELOCATE_ROOT
    ),
    "world_filter": lambda s, d: nodes.world_filter(X.star_nodes(s, d), "").select(*_shown()),
    "folders_only": lambda s, d: nodes.folders_only(X.star_nodes(s, d)).select(*_shown()),
    "classify_entries": classify_entries,
    "format_nodes": lambda s, d: nodes.format_nodes(X.star_nodes(s, d)).withColumn(
        "depth_level", c("depth_level").cast("bigint")
    ),
    "with_depth": lambda s, d: nodes.with_depth(X.star_nodes(s, d).drop("depth_level")).select(
        "world", "node_id", c("depth_level").cast("bigint").alias("depth_level")
    ),
    "validate_parents": lambda s, d: listing.validate_parents(
        X.folder_requests(s, d).select("request_id", "world", "parent_id"), X.star_nodes(s, d)
    ).select("request_id", "world", "parent_id", "status", "message"),
    # Here and in window_children, nodes are printed before requests multiply them.
    "list_children": lambda s, d: listing.list_children(
        X.folder_requests(s, d), X.star_nodes(s, d).select(*_shown())
    ),
    "children_once": children_once,
    "child_counts": lambda s, d: nodes.child_counts(X.star_nodes(s, d)),
    "name_order": lambda s, d: paging.name_order(X.star_nodes(s, d)).select(*_shown("idx")),
    "name_order_skewed": lambda s, d: paging.name_order(_skewed(s, d)).select(*_shown("idx")),
    "page_children": lambda s, d: paging.page_children(X.star_nodes(s, d), 25).select(
        *_shown("idx", "page", "page_size", "total", "has_more")
    ),
    "page_children_skewed": lambda s, d: paging.page_children(_skewed(s, d), 0).select(
        *_shown("idx", "page", "page_size", "total", "has_more")
    ),
    "window_children": lambda s, d: paging.window_children(
        X.folder_requests(s, d), X.star_nodes(s, d).select(*_shown())
    ).select("request_id", "idx", *NODE_COLUMNS),
    "page_info": lambda s, d: paging.page_info(X.folder_requests(s, d), X.star_nodes(s, d)),
    "as_nodes": lambda s, d: nodes.as_nodes(*nodes.split_nodes(X.star_nodes(s, d))).select(*_shown()),
    "split_nodes": split_nodes,
    "service_dimension": lambda s, d: routing.service_dimension(X.raw_services(s, d)),
    "resolve_requests": resolve_requests,
    "serve_listing": lambda s, d: _serve(s, d)[0].select(*_shown("request_id", "idx")),
    "serve_listing_info": lambda s, d: _serve(s, d)[1],
    "list_sources": list_sources,
    "source_order": lambda s, d: routing.source_order(list_sources(s, d).select("id", "display_name")),
    "copy_plan": lambda s, d: copying.copy_plan(X.star_nodes(s, d), "primary", "s1"),
    "chunk_plan": lambda s, d: copying.chunk_plan(
        X.star_nodes(s, d).where("type = 'file'").select("world", "node_id", "size")
    ).drop("size"),
    "buffer_class": lambda s, d: copying.buffer_class(X.star_nodes(s, d).where("type = 'file'")),
    "create_folders": create_folders,
    "create_folders_status": lambda s, d: _folders_wanted(s, d)[1],
    "stage_files": stage_files,
    "decode_pending": decode_pending,
    "commit_files": commit_files,
    "commit_files_status": commit_files_status,
    "overwrite_files": overwrite_files,
    "overwrite_files_status": lambda s, d: _overwrites(s, d).status.select(
        "node_id", "write_seq", "status"
    ),
}
