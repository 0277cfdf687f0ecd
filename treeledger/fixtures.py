"""Inputs for queries and tests, derived from the star schema, events, pages and documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.functions import paths as P
from treeledger.schema import NODE_COLUMNS, NODES
from treeledger.sources.store import shared_dir, write_nodes


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _geography(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.col("n_nationkey").alias("nk"),
        F.concat(F.lit("/"), "r_name").alias("rp"),
        F.concat(F.lit("/"), "r_name", F.lit("/"), "n_name").alias("np"),
        "r_name",
        "n_name",
    )


def _level(rows, parent, name, kind, size, stamp, depth, ck, fk) -> DataFrame:
    return rows.select(
        P.child_location(parent, name).alias("location_path"),
        parent.alias("parent_path"),
        name.alias("name"),
        F.lit(kind).alias("type"),
        size.cast("bigint").alias("size"),
        stamp.cast("timestamp").alias("last_updated"),
        F.lit(depth).alias("depth_level"),
        ck.cast("bigint").alias("ck"),
        fk.cast("bigint").alias("fk"),
    )


def build_star_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Regions, nations and customers as folders, suppliers and orders as files, in the worlds
    ``primary``, ``s1`` and ``local`` (``primary`` again, mounted at ``/data``). Rows are built once
    and then given to their worlds."""
    geo = _geography(spark, folder)
    c, z, n = F.col, F.lit(0), F.lit(None)
    customer = table(spark, folder, "customer").join(geo, c("c_nationkey") == c("nk"))
    supplier = table(spark, folder, "supplier").join(geo, c("s_nationkey") == c("nk"))
    cname = F.concat(F.lit("c"), c("c_custkey").cast("string"))
    orders = table(spark, folder, "orders").join(customer, c("o_custkey") == c("c_custkey"))
    top = spark.sql(
        "SELECT * FROM VALUES ('/', CAST(NULL AS STRING), '/', 0), ('/EMPTY', '/', 'EMPTY', 1) "
        "AS t(location_path, parent_path, name, depth_level)"
    ).withColumns({
        "type": F.lit("folder"), "size": n.cast("bigint"), "last_updated": n.cast("timestamp"),
        "ck": z.cast("bigint"), "fk": z.cast("bigint"),
    })
    key = 1000003
    base = (
        top.unionByName(
            _level(geo.select("r_name").distinct(), F.lit("/"), c("r_name"), "folder", n, n, 1, z, z)
        )
        .unionByName(_level(geo, c("rp"), c("n_name"), "folder", n, n, 2, z, z))
        .unionByName(_level(customer, c("np"), cname, "folder", n, n, 3, c("c_custkey"), z))
        .unionByName(
            _level(
                supplier, c("np"), F.concat(F.lit("s"), c("s_suppkey"), F.lit(".rec")), "file",
                c("s_suppkey") * key, n, 3, z, c("s_suppkey"),
            )
        )
        .unionByName(
            _level(
                orders, P.child_location(c("np"), cname),
                F.concat(F.lit("o"), c("o_orderkey"), F.lit(".ord")), "file",
                c("o_orderkey") % 30 * key, c("o_orderdate"), 4, c("c_custkey"), c("o_orderkey"),
            )
        )
    )
    in_s1 = ((c("ck") == 0) | (c("ck") % 3 != 0)) & ((c("fk") == 0) | (c("fk") % 5 != 0))
    worlds = [F.lit("primary"), F.when(in_s1, "s1"), F.lit("local")]
    mounted = c("world") == "local"

    def physical(path):
        return F.concat(F.lit("/data"), F.when(path == "/", "").otherwise(path))

    rows = base.withColumns({
        "node_id": P.node_key(c("location_path")), "parent_id": P.node_key(c("parent_path")),
    }).withColumn("world", F.explode(F.array_compact(F.array(*worlds))))
    rows = rows.withColumn(
        "size", F.when((c("world") == "s1") & (c("fk") % 7 == 1), c("size") + 1).otherwise(c("size"))
    )
    rows = rows.withColumns({
        "node_id": F.when(mounted, physical(c("location_path"))).otherwise(c("node_id")),
        "parent_id": F.when(mounted & (c("location_path") == "/"), "/")
        .when(mounted, physical(c("parent_path")))
        .otherwise(c("parent_id")),
        "name": F.when(mounted & (c("location_path") == "/"), "data").otherwise(c("name")),
    })
    outside = spark.sql(
        "SELECT * FROM VALUES ('/', CAST(NULL AS STRING), '/', '/', 0, CAST(NULL AS BIGINT), 'folder'), "
        "('/database', '/', 'database', '/', 1, NULL, 'folder'), "
        "('/database/x', '/database', 'x', '/', 2, 10, 'file') "
        "AS t(node_id, parent_id, name, location_path, depth_level, size, type)"
    ).select(
        F.lit("local").alias("world"), "node_id", "parent_id",
        F.lit("/").alias("parent_path"), "name", "location_path",
        n.cast("timestamp").alias("last_updated"), "depth_level", "size", "type",
    )
    return rows.select(*NODE_COLUMNS).unionByName(outside)


_NODE_STORES: dict[tuple[str, str], str] = {}


def node_store(spark: SparkSession, folder: str) -> str:
    """Path of a node store with all of :func:`build_star_nodes`, written once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _NODE_STORES:
        path = shared_dir(spark, "nodes")
        write_nodes(build_star_nodes(spark, folder), path)
        _NODE_STORES[key] = path
    return _NODE_STORES[key]


def star_nodes(spark: SparkSession, folder: str, local: bool = False) -> DataFrame:
    """The worlds ``primary`` and ``s1`` of the node store, and ``local`` if asked for."""
    nodes = spark.read.schema(NODES).parquet(node_store(spark, folder)).select(*NODE_COLUMNS)
    return nodes if local else nodes.where(F.col("world") != "local")


def document_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Files ``/{source}/{lang}/{doc_id}.txt`` with ``content``: world ``primary`` holds all, ``s1``
    lacks every third and has a longer text in every fifth."""
    c = F.col
    path = F.concat(F.lit("/"), c("source"), F.lit("/"), c("lang"), F.lit("/"), c("doc_id"), F.lit(".txt"))
    in_s1 = c("doc_id") % 3 != 0
    return (
        table(spark, folder, "documents")
        .withColumn("world", F.explode(F.array_compact(F.array(F.lit("primary"), F.when(in_s1, "s1")))))
        .select(
            "world",
            "doc_id",
            path.alias("location_path"),
            F.encode(
                F.when((c("world") == "s1") & (c("doc_id") % 5 == 1), F.concat("text", F.lit(" old")))
                .otherwise(c("text")),
                "UTF-8",
            ).alias("content"),
        )
    )


def document_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Node table of :func:`document_nodes`, folders included (``s1`` misses the folders that it
    has no file in)."""
    c = F.col
    files = document_nodes(spark, folder).select(
        "world", "location_path", F.octet_length("content").cast("bigint").alias("size"),
        F.lit("file").alias("type"),
    )
    parents = files.select("world", P.parent_location(c("location_path")).alias("p")).distinct()
    folders = parents.select("world", F.explode(P.prefixes(c("p"))).alias("location_path")).distinct()
    rows = files.unionByName(
        folders.withColumn("type", F.lit("folder")), allowMissingColumns=True
    )
    parent = P.parent_location(c("location_path"))
    return rows.select(
        "world",
        P.node_key(c("location_path")).alias("node_id"),
        P.node_key(parent).alias("parent_id"),
        parent.alias("parent_path"),
        P.last_segment(c("location_path")).alias("name"),
        "location_path",
        F.lit(None).cast("timestamp").alias("last_updated"),
        P.depth_of(c("location_path")).cast("int").alias("depth_level"),
        "size",
        "type",
    )


def document_contents(spark: SparkSession, folder: str) -> DataFrame:
    return document_nodes(spark, folder).select(
        "world", P.node_key(F.col("location_path")).alias("node_id"), "content"
    )


def raw_services(spark: SparkSession, folder: str) -> DataFrame:
    """Service configurations: a few with every odd case, and one or two per supplier."""
    odd = spark.sql(
        "SELECT * FROM VALUES "
        "('local-main', 'Main Local Storage', 'local', '/data', '', '', '', 1L), "
        "('local-open', '', 'local', '', '', '', '', 2L), "
        "('local-dup', 'Old', 'local', '/old', '', '', '', 3L), "
        "('local-dup', 'New', 'local', '/new', '', '', '', 4L), "
        "('cat-primary', '', 'catalog', '', '', '', '/etc/cat.json', 5L), "
        "('cat-s1', '', 'catalog', '', 's1', '', '/etc/cat.json', 6L), "
        "('', 'no id', 'local', '', '', '', '', 7L), "
        "('cat-bare', '', 'catalog', '', '', '', '', 8L) "
        "AS t(service_id, name, kind, root_path, world, root_id, config_path, load_order)"
    )
    k = F.col("s_suppkey")
    nation = F.col("np")
    grown = table(spark, folder, "supplier").join(
        _geography(spark, folder), F.col("s_nationkey") == F.col("nk")
    ).select(
        F.concat(F.lit("svc-"), F.floor(k / 2)).alias("service_id"),
        F.when(k % 4 == 0, "").otherwise(F.col("s_name")).alias("name"),
        F.when(k % 3 == 0, "catalog").otherwise("local").alias("kind"),
        F.when(k % 3 == 1, F.concat(F.lit("/data/./x/.."), nation, F.lit("/")))
        .when(k % 11 == 2, "relative/root").otherwise("").alias("root_path"),
        F.when(k % 2 == 0, "s1").otherwise("").alias("world"),
        F.when(k % 5 == 0, "top").otherwise("").alias("root_id"),
        F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("/etc//cat"), k, F.lit(".json"))).alias("config_path"),
        (k + 100).alias("load_order"),
    )
    return odd.unionByName(grown)


def sessions(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "SELECT * FROM VALUES ('sess-ok', 'catalog', 'open'), ('sess-closed', 'catalog', 'closed'), "
        "('sess-local', 'local', 'open') AS t(session_id, kind, state)"
    )


def _pick(by, *values):
    picked = F.when(by == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        picked = picked.when(by == i, value)
    return picked


def _event_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Each event with a nation folder, a customer folder and a supplier file from its user."""
    c = F.col
    geo = _geography(spark, folder)
    customer = table(spark, folder, "customer").join(geo, c("c_nationkey") == c("nk")).select(
        c("c_custkey").alias("user_id"),
        F.concat("np", F.lit("/c"), c("c_custkey")).alias("customer_path"),
    )
    supplier = table(spark, folder, "supplier").join(geo, c("s_nationkey") == c("nk")).select(
        c("s_suppkey").alias("user_id"),
        F.concat("np", F.lit("/s"), c("s_suppkey"), F.lit(".rec")).alias("file_path"),
    )
    nations = geo.select(c("nk").cast("bigint").alias("_nk"), c("np").alias("nation_path"))
    return (
        table(spark, folder, "events").select("event_id", "user_id")
        .withColumn("_nk", c("user_id") % 25)
        .join(nations, "_nk", "left")
        .join(customer, "user_id", "left")
        .join(supplier, "user_id", "left")
    )


def _paging() -> dict:
    e = F.col("event_id")
    return {
        "offset": (e % 61 - 5).cast("int"),
        "limit": _pick(F.floor(e / 8) % 6, *map(F.lit, (-1, 0, 7, 50, 1000, 5000))),
        "folders_only": F.floor(e / 48) % 2 == 0,
    }


def folder_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per event for a known folder id: ``(request_id, world, parent_id, offset, limit,
    folders_only)``; some name a file or an id that does not exist."""
    c, e = F.col, F.col("event_id")
    which = F.floor(e / 96) % 5
    parent = _pick(
        which, F.md5("nation_path"), F.md5("customer_path"), F.md5("file_path"), F.lit("root"),
        F.lit("missing"),
    )
    return (
        _event_paths(spark, folder)
        .withColumns(_paging())
        .select(
            e.alias("request_id"),
            F.when(e % 3 == 0, "s1").otherwise("primary").alias("world"),
            F.coalesce(parent, F.lit("missing")).alias("parent_id"),
            "offset",
            "limit",
            "folders_only",
        )
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """One routed request per event, over all service ids, roles, sessions and identifiers."""
    c, e, u = F.col, F.col("event_id"), F.col("user_id")
    service = _pick(
        e % 8, *map(F.lit, ("catalog", "catalog", "local", "cat-primary", "cat-s1", "local-main", "no-such", "catalog"))
    )
    local = service.isin("local", "local-main")
    path = _pick(F.floor(e / 96) % 5, c("nation_path"), c("customer_path"), c("file_path"), F.lit(""), F.lit("missing"))
    odd_local = _pick(F.floor(e / 480) % 4, *map(F.lit, ("missing", "/database/x", "/", "/data/missing")))
    case = F.floor(e / 96) % 5
    identifier = (
        F.when(case == 3, "")
        .when(case == 4, F.when(local, odd_local).otherwise("missing"))
        .when(local, F.concat(F.lit("/data"), path))
        .otherwise(F.md5(path))
    )
    return (
        _event_paths(spark, folder)
        .withColumns(_paging())
        .select(
            e.alias("request_id"),
            service.alias("service_id"),
            F.coalesce(identifier, F.lit("missing")).alias("identifier"),
            _pick(u % 4, *map(F.lit, ("source", " Destination ", "", "other"))).alias("role"),
            _pick(
                u % 7, *map(F.lit, ("sess-ok", "sess-ok", "sess-ok", "sess-closed", "", "no-such-session", "sess-local"))
            ).alias("session_id"),
            "offset",
            "limit",
            "folders_only",
        )
    )


def web_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Host and path of every page, one wanted folder each: ``(world, path)``."""
    return table(spark, folder, "pages").select(
        "page_id",
        F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("world"),
        F.regexp_extract("url", "^[a-z]+://[^/?#]*([^?#]*)", 1).alias("path"),
    )
