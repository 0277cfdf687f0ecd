"""Finding the storage service that has to answer a request.

Service tables ``(service_id, name, kind, root_path, world, root_id, config_path, load_order)`` and
session tables ``(session_id, kind, state)`` are configuration. No broadcast is forced on them:
Spark broadcasts them when their size allows and shuffles otherwise.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.functions import paths as P
from treeledger.schema import (
    CATALOG,
    DEFAULT_ROOT_ID,
    DEFAULT_WORLD,
    DESTINATION_WORLD,
    FOLDER,
    LOCAL,
)
from treeledger.sources.store import stored

SERVICE_COLUMNS = [
    "service_id", "name", "kind", "root_path", "world", "root_id", "config_path", "load_order",
]


def service_dimension(raw: DataFrame) -> DataFrame:
    """Cleaned service rows with ``status``.

    Good rows are unique on ``service_id``: the row loaded last wins, and local services load before
    catalogs. Bad rows are all kept, each with the reason it was refused. The winner is picked by an
    aggregate that combines map-side, so an id loaded very often is no hot task.
    """
    kind = F.col("kind")
    is_catalog = kind == CATALOG
    service_id = P.filled(F.col("service_id"))
    root_path = P.filled(F.col("root_path"))
    config_path = P.filled(F.col("config_path"))
    status = (
        F.when(service_id == "", "missing_id")
        .when(is_catalog & (config_path == ""), "missing_config_path")
        .when(is_catalog & ~P.is_absolute(config_path), "invalid_path")
        .when((kind == LOCAL) & (root_path != "") & ~P.is_absolute(root_path), "invalid_path")
        .otherwise("ok")
    )
    none = F.lit(None).cast("string")
    cleaned = raw.select(
        service_id.alias("service_id"),
        F.when(P.filled(F.col("name")) == "", service_id).otherwise(F.col("name")).alias("name"),
        "kind",
        F.when((kind == LOCAL) & (root_path != ""), P.clean(root_path)).alias("root_path"),
        F.when(is_catalog, P.world_name(F.col("world"))).otherwise(none).alias("world"),
        F.when(is_catalog, F.coalesce(F.nullif(F.col("root_id"), F.lit("")), F.lit(DEFAULT_ROOT_ID)))
        .otherwise(none)
        .alias("root_id"),
        F.when(is_catalog & (config_path != ""), P.clean(config_path)).alias("config_path"),
        "load_order",
        status.alias("status"),
    )
    load_rank = F.struct((kind != LOCAL).alias("late"), F.col("load_order"))
    refused = F.when(F.col("status") != "ok", load_rank)
    record = F.struct(*[c for c in SERVICE_COLUMNS if c != "service_id"])
    return (
        cleaned.groupBy("service_id", "status", refused.alias("_refused"))
        .agg(F.max_by(record, load_rank).alias("_row"))
        .select("service_id", "_row.*", "status")
        .select(*SERVICE_COLUMNS, "status")
    )


def _service_index(services: DataFrame) -> DataFrame:
    """Everything a request can ask for by way and key: an id, a catalog world, or any local
    service without its root restriction. Where several fit, the smallest id serves."""
    kind = F.col("kind")
    found = F.struct("service_id", "kind", "root_path", "world", "root_id", "config_path")

    def entry(via, key, row):
        return F.struct(F.lit(via).alias("_via"), key.alias("_key"), row.alias("_found"))

    unrestricted = found.withField("root_path", F.lit(None).cast("string"))
    entries = F.array_compact(F.array(
        entry("id", F.col("service_id"), found),
        F.when(kind == CATALOG, entry("world", F.col("world"), found)),
        F.when(kind == LOCAL, entry("kind", F.lit(LOCAL), unrestricted)),
    ))
    return (
        services.select(F.inline(entries))
        .groupBy("_via", "_key")
        .agg(F.min_by("_found", F.col("_found.service_id")).alias("_found"))
    )


def resolve_requests(requests: DataFrame, services: DataFrame, sessions: DataFrame) -> DataFrame:
    """Add the service that serves each request, ``target`` (the folder to list) and ``status``.

    The first failing check names the status; ``ok`` rows still need their parent validated.
    """
    role = F.lower(P.trim_space(P.filled(F.col("role"))))
    wanted_world = F.when(role == "destination", DESTINATION_WORLD).otherwise(DEFAULT_WORLD)
    asked = P.filled(F.col("service_id"))
    via = F.when(asked == "catalog", "world").when(asked == "local", "kind").otherwise("id")
    key = F.when(via == "world", wanted_world).when(via == "kind", LOCAL).otherwise(asked)

    # One row per id, so that requests do not multiply: an open catalog session before others.
    usable = (P.filled(F.col("kind")) == CATALOG) & (P.filled(F.col("state")) == "open")
    known_sessions = (
        sessions.groupBy(F.col("session_id").alias("_session"))
        .agg(F.max(F.struct(usable.alias("usable"), "kind", "state")).alias("_best"))
        .select(
            "_session",
            F.col("_best.kind").alias("_session_kind"),
            F.col("_best.state").alias("_session_state"),
        )
    )
    asked = requests.withColumns({"_via": via, "_key": key})
    # Only services that are asked for, in a table whose size is known: requests name a few of many, and
    # then need no shuffle to meet them.
    found_by = stored(
        _service_index(services).join(asked.select("_via", "_key").distinct(), ["_via", "_key"], "left_semi"), "asked"
    )
    matched = (
        asked.join(found_by, ["_via", "_key"], "left")
        .join(known_sessions, F.col("session_id") == F.col("_session"), "left")
    )

    found = F.col("_found")
    kind = found["kind"]
    is_local = kind == LOCAL
    is_catalog = kind == CATALOG
    root = P.filled(found["root_path"])
    identifier = P.filled(F.col("identifier"))
    local_path = F.when(identifier != "", identifier).when(root != "", root).otherwise("/")
    local_target = P.clean(local_path)
    root_id = F.coalesce(F.nullif(found["root_id"], F.lit("")), F.lit(DEFAULT_ROOT_ID))
    target = F.when(is_local, local_target).when(
        is_catalog, F.when(identifier != "", identifier).otherwise(root_id)
    )
    outside = is_local & (root != "") & ~P.under_root(local_target, root)

    status = (
        F.when(found.isNull() & (F.col("_via") == "world"), "world_not_found")
        .when(found.isNull() & (F.col("_via") == "kind"), "no_local_service")
        .when(found.isNull(), "service_not_found")
        .when(~kind.isin(LOCAL, CATALOG) | kind.isNull(), "unsupported_type")
        .when(is_catalog & (P.filled(F.col("session_id")) == ""), "session_required")
        .when(is_catalog & (P.filled(found["config_path"]) == ""), "missing_configuration")
        .when(is_catalog & F.col("_session").isNull(), "session_not_found")
        .when(is_catalog & (P.filled(F.col("_session_kind")) != CATALOG), "session_wrong_kind")
        .when(is_catalog & (P.filled(F.col("_session_state")) != "open"), "session_closed")
        .when(is_local & ~P.is_absolute(local_path), "invalid_path")
        .when(outside, "outside_root")
        .otherwise("ok")
    )
    return matched.select(
        *requests.columns,
        found["service_id"].alias("served_by"),
        kind.alias("kind"),
        found["root_path"].alias("root"),
        F.when(is_local, LOCAL).when(is_catalog, P.world_name(found["world"])).alias("world"),
        target.alias("target"),
        status.alias("status"),
    )


def _local_totals(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Folders, files and bytes strictly below every root.

    Children are summed per folder first; then each folder's sums go to those of its ancestors that
    are roots. So a root above most of the tree receives folders, not files, and the sum again
    combines map-side.
    """
    per_folder = (
        nodes.where((F.col("world") == LOCAL) & F.col("parent_id").isNotNull())
        .groupBy("parent_id")
        .agg(*_sums())
    )
    return (
        per_folder.withColumn("root_path", F.explode(P.prefixes(F.col("parent_id"))))
        .join(roots, "root_path", "left_semi")
        .groupBy("root_path")
        .agg(*[F.sum(c).alias(c) for c in ("folders", "files", "bytes")])
    )


def _sums() -> list:
    return [
        F.count_if(F.col("type") == FOLDER).alias("folders"),
        F.count_if(F.col("type") != FOLDER).alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
    ]


def list_sources(services: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every local service, and one row for all catalogs together, with metadata and totals.

    Totals count what lies below the root of a local service, and below the roots of the worlds of
    the catalogs. Ordered by display name.
    """
    # A service without a root counts what is below "/", but only a root that is set is shown.
    shown_root = F.nullif("root_path", F.lit(""))
    local = services.where(F.col("kind") == LOCAL).withColumns(
        {"_shown_root": shown_root, "root_path": F.coalesce(shown_root, F.lit("/"))}
    )
    local_totals = _local_totals(nodes, local.select("root_path").distinct())
    local_rows = local.join(local_totals, "root_path", "left").select(
        F.col("service_id").alias("id"),
        F.col("name").alias("display_name"),
        "kind",
        F.map_filter(
            F.create_map(
                F.lit("name"), F.col("name"),
                F.lit("rootPath"), F.col("_shown_root"),
            ),
            lambda _, v: v.isNotNull(),
        ).alias("metadata"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("folders", "files", "bytes")],
    )

    catalogs = services.where(F.col("kind") == CATALOG)
    catalog_totals = (
        nodes.where(F.col("parent_id").isNotNull())
        .groupBy("world")
        .agg(*_sums())
        .join(catalogs.select("world").distinct(), "world", "left_semi")
        .groupBy(F.lit(CATALOG).alias("kind"))
        .agg(*[F.sum(c).alias(c) for c in ("folders", "files", "bytes")])
    )
    catalog_rows = (
        catalogs.groupBy("kind")
        .agg(F.min_by("config_path", "service_id").alias("config_path"))
        .join(catalog_totals, "kind", "left")
        .select(
            F.lit("catalog").alias("id"),
            F.lit("Catalog").alias("display_name"),
            "kind",
            F.map_filter(
                F.create_map(
                    F.lit("name"), F.lit("Catalog"), F.lit("configPath"), F.nullif("config_path", F.lit("")),
                ),
                lambda _, v: v.isNotNull(),
            ).alias("metadata"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("folders", "files", "bytes")],
        )
    )
    return source_order(local_rows.unionByName(catalog_rows))


def source_order(sources: DataFrame) -> DataFrame:
    return sources.orderBy("display_name", "id")
