"""Write planning, commits and content stores on small hand-made inputs."""

import os

import pytest
from pyspark.sql import functions as F

from treeledger import fixtures as X
from treeledger.operators import routing
from treeledger.plans import bulkcopy, copying, writing
from treeledger.schema import NODES
from treeledger.sources import store
from treeledger.streaming import content


@pytest.fixture(scope="module")
def nodes(spark):
    rows = [
        ("w", "root", None, None, "/", "/", None, 0, None, "folder"),
        ("w", "a", "root", "/", "a", "/a", None, 1, None, "folder"),
        ("w", "b:c", "a", "/a", "b", "/a/b", None, 2, None, "folder"),
        ("w", "f", "a", "/a", "f", "/a/f", None, 2, 3, "file"),
    ]
    return spark.createDataFrame(rows, NODES)


def test_create_folders(spark, nodes):
    wanted = spark.createDataFrame(
        [("w", "/a/b/x/y"), ("w", "a//b"), ("w", "/a/f/z"), ("v", "/n")], "world string, path string")
    new, status = writing.create_folders(wanted, nodes)
    got = {(r.world, r.location_path): r for r in new.collect()}
    assert set(got) == {("w", "/a/b/x"), ("w", "/a/b/x/y"), ("v", "/"), ("v", "/n")}
    assert got["w", "/a/b/x"].parent_id == "b:c"
    assert got["w", "/a/b/x/y"].parent_id == got["w", "/a/b/x"].node_id
    assert (got["v", "/"].node_id, got["v", "/"].parent_id, got["v", "/n"].parent_id) == ("root", None, "root")
    assert {(r.world, r.path): r.status for r in status.collect()} == {
        ("w", "/a/b/x/y"): "created", ("w", "/a/b"): "exists", ("w", "/a/f/z"): "not_folder", ("v", "/n"): "created"}


def test_stage_paths_and_compat(spark, nodes):
    wanted = spark.createDataFrame(
        [("w", "b:c", "n:1", 7, {"k": "v"}), ("w", "f", "x", 1, None), ("w", "none", "x", 1, None)],
        "world string, parent_id string, name string, size bigint, metadata map<string,string>")
    got = {r.parent_id: r for r in writing.stage_files(wanted, nodes).collect()}
    row = got["b:c"]
    assert (row.location_path, row.depth_level, row.size, row.metadata) == ("/a/b/n:1", 3, 7, {"k": "v"})
    assert row.pending_id == "pending:b:c:n:1"
    assert (got["f"].status, got["none"].status) == ("not_folder", "not_found")
    compat = {r.parent_id: r for r in writing.stage_files(wanted, nodes, compat=True).collect()}
    assert compat["b:c"].location_path == "/a/n:1"


def test_pending_ids(spark):
    ids = spark.createDataFrame(
        [("pending:root:a.txt",), ("pending:root:a:b.txt",), ("pending:x",), ("root:a",), (None,)], "pending_id string")
    got = {r.pending_id: (r.parent_id, r.name, r.status) for r in writing.decode_pending(ids).collect()}
    assert got == {
        "pending:root:a.txt": ("root", "a.txt", "ok"), "pending:root:a:b.txt": ("root", "a:b.txt", "ok"),
        "pending:x": (None, None, "bad_format"), "root:a": (None, None, "not_pending"), None: (None, None, "not_pending")}


def test_commit_keeps_ids_with_colons_apart(spark, nodes):
    wanted = spark.createDataFrame(
        [("w", "b:c", "n", 99), ("w", "a", "f", 1)], "world string, parent_id string, name string, size bigint"
    ).withColumn("metadata", F.lit(None).cast("map<string,string>"))
    writes = spark.createDataFrame(
        [("w", "b:c", "n", 0, b""), ("w", "b:c", "n", 1, b"one"), ("w", "b:c", "n", 2, b"two"),
         ("w", "a", "f", 0, b"z"), ("w", "b", "c:n", 0, b"q")],
        "world string, parent_id string, name string, commit_seq int, content binary")
    done = content.commit_files(writing.stage_files(wanted, nodes), writes, nodes)
    assert {(r.parent_id, r.name, r.commit_seq): r.status for r in done.status.collect()} == {
        ("b:c", "n", 0): "empty_data", ("b:c", "n", 1): "committed", ("b:c", "n", 2): "no_op",
        ("a", "f", 0): "already_exists", ("b", "c:n", 0): "not_staged"}
    assert [(r.location_path, r.size) for r in done.nodes.collect()] == [("/a/b/n", 3)]
    assert [bytes(r.content) for r in done.contents.collect()] == [b"one"]


def test_overwrite_rewrites_only_touched_buckets(spark, tmp_path):
    path, buckets = str(tmp_path / "contents"), 16
    rows = [("w", f"n{i}", f"old{i}".encode()) for i in range(200)]
    old = spark.createDataFrame(rows, "world string, node_id string, content binary")
    store.write_contents(old, path, buckets)

    def files():
        return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
                for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}

    before = files()
    changed = spark.createDataFrame([("w", "n5", b"new")], old.schema)
    store.replace_contents(spark, changed, path, buckets)
    after = files()
    got = {r.node_id: bytes(r.content) for r in store.scan_contents(spark, path).collect()}
    assert got == {n: (b"new" if n == "n5" else c) for _, n, c in rows}
    assert len({os.path.dirname(f) for f in set(before) - set(after)}) == 1


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_stored_reads_and_wide_replacements(spark, tmp_path, limit):
    """With buckets broadcast, which prunes the scan, and too large for it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        stored_reads(spark, tmp_path, pruned=limit != "-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def stored_reads(spark, tmp_path, pruned):
    path = str(tmp_path / "contents")
    rows = [(w, f"n{i}", f"{w}{i}".encode()) for w in ("v", "w") for i in range(40)]
    old = spark.createDataFrame(rows, "world string, node_id string, content binary")
    store.write_contents(old, path, 8)
    asked = spark.createDataFrame([("w", "n1"), ("w", "n2"), ("v", "no")], "world string, node_id string")
    got = content.read_stored(asked, path, 8)
    assert {(r.node_id, r.status, r.content and bytes(r.content)) for r in got.collect()} == {
        ("n1", "ok", b"w1"), ("n2", "ok", b"w2"), ("no", "not_found", None)}
    if pruned:
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "dynamicpruning" in plan and "dynamicpruningexpression(true)" not in plan
    changed = spark.createDataFrame([("w", "n1", b"x"), ("w", "n7", b"y"), ("w", "n9", b"z")], old.schema)
    store.replace_contents(spark, changed, path, 8)
    left = {(r.world, r.node_id): bytes(r.content) for r in store.scan_contents(spark, path).collect()}
    assert left == {(w, n): c for w, n, c in rows} | {("w", "n1"): b"x", ("w", "n7"): b"y", ("w", "n9"): b"z"}


def test_copy_of_missing_and_empty_bytes(spark):
    def node(world, name, size, kind="file"):
        return (world, f"{world}-{name}", "root", "/", name, f"/{name}", None, 1, size, kind)

    nodes = spark.createDataFrame(
        [("p", "root", None, None, "/", "/", None, 0, None, "folder"), node("p", "gone", 4), node("p", "void", 0),
         node("p", "new", 9), node("p", "cut", 0), node("p", "dir", 1), node("p", "same", 2),
         node("d", "cut", 5), node("d", "dir", None, "folder"), node("d", "same", 2)], NODES)
    contents = spark.createDataFrame(
        [("p", "p-void", b""), ("p", "p-new", b"abc"), ("p", "p-cut", b""), ("p", "p-same", b"xx"), ("p", "p-dir", b"d")],
        "world string, node_id string, content binary")
    done = bulkcopy.bulk_copy(nodes, contents, "p", "d")
    assert {r.location_path: r.status for r in done.status.collect()} == {
        "/gone": "no_data", "/void": "no_data", "/new": "copied", "/cut": "overwritten",
        "/dir": "conflict", "/same": "skipped"}
    assert {(r.location_path, r.size) for r in done.new_nodes.collect()} == {("/", None), ("/new", 3)}
    assert {(r.node_id, r.size) for r in done.changed_nodes.collect()} == {("d-cut", 0)}
    assert {bytes(r.content) for r in done.contents.collect()} == {b"abc", b""}


def test_copy_below_a_file_is_blocked(spark):
    """Neither node nor bytes are made where a file of the destination stands for a folder."""
    def node(world, path, kind="file"):
        parent, name = path.rsplit("/", 1)
        return (world, f"{world}{path}", f"{world}{parent or '/'}", parent or "/", name, path, None, path.count("/"),
                3 if kind == "file" else None, kind)

    nodes = spark.createDataFrame(
        [("p", "p/", None, None, "/", "/", None, 0, None, "folder"), node("p", "/a", "folder"), node("p", "/a/b"),
         node("p", "/a/c", "folder"), node("p", "/a/c/d"), node("p", "/e"),
         ("d", "d/", None, None, "/", "/", None, 0, None, "folder"), node("d", "/a")], NODES)
    contents = spark.createDataFrame(
        [("p", "p/a/b", b"one"), ("p", "p/a/c/d", b"two"), ("p", "p/e", b"abc")],
        "world string, node_id string, content binary")
    done = bulkcopy.bulk_copy(nodes, contents, "p", "d")
    assert {r.location_path: r.status for r in done.status.collect()} == {
        "/a/b": "blocked", "/a/c/d": "blocked", "/e": "copied"}
    made = done.new_nodes.collect()
    assert [r.location_path for r in made] == ["/e"]
    assert [(r.node_id, bytes(r.content)) for r in done.contents.collect()] == [(made[0].node_id, b"abc")]


def test_commit_gives_each_file_a_path_of_its_own(spark, nodes):
    """Names that would take another file's path are refused, and so is a path that is taken."""
    names = ["x", "x ", "../y", "s/t", "."]
    stray = nodes.where("false").unionByName(spark.createDataFrame(
        [("w", "stray", "a", "/a", "u ", "/a/u", None, 2, 1, "file")], NODES))
    nodes = nodes.unionByName(stray)
    wanted = spark.createDataFrame(
        [("w", "a", n, 1) for n in [*names, "u"]], "world string, parent_id string, name string, size bigint"
    ).withColumn("metadata", F.lit(None).cast("map<string,string>"))
    writes = spark.createDataFrame(
        [("w", "a", n, 0, n.encode()) for n in [*names, "u"]],
        "world string, parent_id string, name string, commit_seq int, content binary")
    done = content.commit_files(writing.stage_files(wanted, nodes), writes, nodes)
    assert {r.name: r.status for r in done.status.collect()} == {
        "x": "committed", "x ": "invalid_name", "../y": "invalid_name", "s/t": "invalid_name",
        ".": "invalid_name", "u": "already_exists"}
    assert [r.location_path for r in done.nodes.collect()] == ["/a/x"]
    assert [bytes(r.content) for r in done.contents.collect()] == [b"x"]


def test_chunks_cover_files(spark):
    files = spark.createDataFrame([("a", 0), ("b", 10), ("c", 11), ("d", None)], "node_id string, size bigint")
    got = {}
    for r in copying.chunk_plan(files, 5).orderBy("node_id", "chunk_no").collect():
        got.setdefault(r.node_id, []).append((r.start_byte, r.length))
    assert got == {"a": [(0, 0)], "b": [(0, 5), (5, 5)], "c": [(0, 5), (5, 5), (10, 1)], "d": [(0, 0)]}
    default = copying.chunk_plan(spark.createDataFrame([("x", 8 * 1024 * 1024 + 1)], files.schema), -1)
    assert default.count() == 2


def test_unsupported_and_unconfigured_services(spark):
    services = spark.sql(
        "SELECT * FROM VALUES ('odd', 'tape', NULL, NULL, NULL, NULL), ('bare', 'catalog', NULL, 'primary', NULL, '') "
        "AS t(service_id, kind, root_path, world, root_id, config_path)")
    asked = spark.sql(
        "SELECT * FROM VALUES (1L, 'odd', 's'), (2L, 'bare', 's'), (3L, 'bare', ''), (4L, 'local', ''), "
        "(5L, 'catalog', 's'), (6L, NULL, 's') AS t(request_id, service_id, session_id)"
    ).withColumns({"identifier": F.lit(""), "role": F.when(F.col("request_id") == 5, "destination")})
    got = {r.request_id: r.status for r in routing.resolve_requests(asked, services, X.sessions(spark)).collect()}
    assert got == {1: "unsupported_type", 2: "missing_configuration", 3: "session_required",
                   4: "no_local_service", 5: "world_not_found", 6: "service_not_found"}


def test_sessions_and_roots(spark):
    """A session in several rows gives one answer; a root that is set is shown, also ``/``."""
    from treeledger.operators import routing

    services = spark.createDataFrame(
        [("a", "a", "local", "/", None, None, None), ("b", "b", "local", None, None, None, None),
         ("c", "c", "catalog", None, "root", "/c.json", "primary")],
        "service_id string, name string, kind string, root_path string, root_id string, config_path string, world string",
    )
    sessions = spark.createDataFrame(
        [("s", "catalog", "closed"), ("s", "catalog", "open"), ("s", None, None)],
        "session_id string, kind string, state string",
    )
    asked = spark.createDataFrame(
        [(1, "c", None, None, "s")],
        "request_id bigint, service_id string, role string, identifier string, session_id string",
    )
    assert [r.status for r in routing.resolve_requests(asked, services, sessions).collect()] == ["ok"]
    nodes = spark.createDataFrame(
        [], "world string, node_id string, parent_id string, type string, size bigint"
    )
    shown = {r.id: r.metadata.get("rootPath") for r in routing.list_sources(services, nodes).collect()}
    assert shown["a"] == "/" and shown["b"] is None


def test_bucket_count_is_the_stores_own(spark, tmp_path):
    """Another count than the store was written with would leave old rows beside new ones."""
    path = str(tmp_path / "contents")
    rows = [("w", str(i), b"old") for i in range(20)]
    kind = "world string, node_id string, content binary"
    store.write_contents(spark.createDataFrame(rows, kind), path, 8)
    changed = spark.createDataFrame([("w", "3", b"new")], kind)
    with pytest.raises(ValueError, match="8 buckets, not 16"):
        store.replace_contents(spark, changed, path, 16)
    with pytest.raises(ValueError, match="8 buckets, not 16"):
        content.read_stored(changed.select("world", "node_id"), path, 16)
    store.replace_contents(spark, changed, path)
    got = sorted((r.node_id, bytes(r.content)) for r in store.scan_contents(spark, path).collect())
    assert got == sorted((i, b"new" if i == "3" else b"old") for _, i, _ in rows)
    assert content.read_stored(changed.select("world", "node_id"), path).first().status == "ok"


def test_upper_folders_of_wanted_paths_are_not_shuffled(spark, nodes, monkeypatch):
    """What looks for files on the way moves no path along with its upper folders, which all share."""
    before, plans = writing.stored, {}

    def kept(rows, purpose):
        back = before(rows, purpose)
        plans[purpose] = rows._jdf.queryExecution().executedPlan().toString()
        return back

    monkeypatch.setattr(writing, "stored", kept)
    wanted = spark.createDataFrame([("primary", f"/a/b{i % 9}/c{i}") for i in range(500)], "world string, path string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new, status = writing.create_folders(wanted, nodes)
        assert status.count() == 500 and new.count() == new.distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The exploded steps meet the bitmaps before they are shuffled, and existing nodes too.
    for purpose in ("blocked", "steps"):
        assert "BroadcastHashJoin" in plans[purpose] and "LeftSemi" not in plans[purpose]
    at = plans["blocked"].index("Generate explode")
    assert plans["blocked"].rindex("Exchange hashpartitioning(world", 0, at) < plans["blocked"].rindex("BroadcastHashJoin", 0, at)


def test_only_staying_bytes_are_shuffled(spark):
    from treeledger.sources.store import staying

    rows = [("w", f"n{i}", bytes([i])) for i in range(9)] + [("w", None, b"x"), (None, "n1", b"y"), (None, None, b"z")]
    contents = spark.createDataFrame(rows, "world string, node_id string, content binary").repartition(3)
    ids = spark.createDataFrame([("w", "n1"), ("w", "n2"), ("w", "n2"), (None, "n3"), ("w", None)], "world string, node_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = staying(contents, ids)
        got = kept.collect()
        plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    gone = {("w", "n1"), ("w", "n2")}
    assert sorted(map(repr, ((r.world, r.node_id, bytes(r.content)) for r in got))) == sorted(
        repr(r) for r in rows if r[:2] not in gone)
    assert "LeftAnti" not in plan and "BroadcastHashJoin" in plan


def test_bytes_of_lost_writes_are_not_shuffled(spark, nodes):
    from treeledger.streaming import content

    writes = spark.createDataFrame(
        [("w", "f", i, b"%d" % i) for i in range(20)] + [("w", "gone", 0, b"x"), ("w", None, 1, b"y")],
        "world string, node_id string, write_seq bigint, content binary",
    ).repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = content.overwrite_files(writes, nodes)
        assert [(r.node_id, bytes(r.content)) for r in done.contents.collect()] == [("f", b"19")]
        plan = done.contents._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan
    assert {r.status for r in done.status.collect()} == {"superseded", "written", "not_found"}
