"""The whole way of a listing request: route, guard, validate, list, cut the page, describe it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.functions import paths as P
from treeledger.operators.listing import validate_parents
from treeledger.operators.paging import page_info, window_children
from treeledger.operators.pathjobs import normalize_nodes
from treeledger.operators.routing import resolve_requests
from treeledger.schema import LOCAL
from treeledger.sources.store import stored


def check_requests(
    requests: DataFrame, services: DataFrame, sessions: DataFrame, nodes: DataFrame
) -> DataFrame:
    """Resolved requests with their final status, the parent included. ``parent_id`` is the folder
    to list."""
    # Stored, since the parents are looked up by the same requests that are joined with them.
    resolved = stored(
        resolve_requests(requests, services, sessions).withColumnsRenamed(
            {"status": "_routing", "target": "parent_id"}
        ), "resolved",
    )
    checked = validate_parents(resolved, nodes)
    return checked.withColumn(
        "status", F.when(F.col("_routing") != "ok", F.col("_routing")).otherwise(F.col("status"))
    ).drop("_routing", "message")


def serve_listing(
    requests: DataFrame,
    services: DataFrame,
    sessions: DataFrame,
    nodes: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, info)`` for requests ``(request_id, service_id, identifier, role, session_id,
    offset, limit, folders_only)``.

    Rows of mounted trees get logical paths relative to the root of the service that served them;
    rows of catalogs get their stored paths in normal form. Info has one row per request, with
    empty totals where ``status`` is not ``ok``. The checked requests are stored once, since both
    results and every step of them start there.
    """
    checked = stored(check_requests(requests, services, sessions, nodes), "requests")
    root = F.coalesce("root", F.lit("/"))
    valid = checked.where("status = 'ok'").withColumn(
        "_listed_at",
        F.when(F.col("kind") == LOCAL, P.relative_parent(F.col("parent_id"), root)),
    )
    # Paths are worked out once per node and once per request, not for every row handed out.
    listed = window_children(valid, normalize_nodes(nodes), carry=("_listed_at",))
    mounted = F.col("_listed_at").isNotNull()
    rows = listed.withColumns({
        "parent_path": F.coalesce("_listed_at", "parent_path"),
        "location_path": F.when(
            mounted, P.child_location(F.col("_listed_at"), F.col("name"))
        ).otherwise(F.col("location_path")),
    }).drop("_listed_at")
    served = F.col("status") == "ok"
    info = page_info(checked, nodes, carry=("served_by", "status"))
    info = info.select(
        "request_id",
        "served_by",
        "status",
        *[F.when(served, F.col(name)).alias(name) for name in info.columns[3:]],
    )
    return rows, info
