"""Chunked, versioned contents; work in equal shares; copies between kinds; scans that tell of errors."""

import os
import random

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from treeledger import content_queries
from treeledger.plans import copying, transfer
from treeledger.schema import NODES
from treeledger.sources import chunkstore, tree


@pytest.mark.parametrize("name", sorted(content_queries.QUERIES))
def test_query(spark, data, name):
    con = compare.database(data)
    assert compare.check(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], data) == ""


def files_of(spark, path):
    out = {}
    for r in sorted(chunkstore.scan_chunks(spark, path).collect(), key=lambda r: r["chunk_no"]):
        out.setdefault((r["world"], r["node_id"]), []).append(bytes(r["content"]))
    return {k: b"".join(v) for k, v in out.items()}


@pytest.fixture
def small(spark, tmp_path):
    rows = [("w", f"f{i}", bytes([i]) * (i * 7)) for i in range(20)] + [("v", "f1", b"other"), ("v", "none", None)]
    frame = spark.createDataFrame(rows, "world string, node_id string, content binary")
    path = str(tmp_path / "store")
    chunkstore.write_chunks(chunkstore.as_chunks(frame, 10), path, 10, buckets=4)
    return path, {(w, n): b or b"" for w, n, b in rows}


def test_versions(spark, small, monkeypatch):
    path, held = small
    assert files_of(spark, path) == held
    new = spark.createDataFrame([("w", "f3", b"x" * 95), ("w", "new", b""), ("u", "far", b"z")], "world string, node_id string, content binary")
    change = chunkstore.as_chunks(new, 10)

    # A change that fails before its manifest is there leaves the old state, and can be made again.
    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(chunkstore, "_publish", broken)
        with pytest.raises(OSError):
            chunkstore.replace_chunks(spark, path, change)
    assert files_of(spark, path) == held
    gone = spark.createDataFrame([("v", "f1")], "world string, node_id string")
    chunkstore.replace_chunks(spark, path, change, gone)
    wanted = {**held, ("w", "f3"): b"x" * 95, ("w", "new"): b"", ("u", "far"): b"z"}
    del wanted["v", "f1"]
    assert files_of(spark, path) == wanted
    # Only the buckets that were touched are of the new version.
    rows, version, buckets, chunk = chunkstore.current(spark, path)
    assert (version, buckets, chunk) == (2, 4, 10)
    ids = spark.createDataFrame([("w", "f3"), ("w", "new"), ("u", "far"), ("v", "f1")], "world string, node_id string")
    touched = {(r["world"], r["bucket"]) for r in chunkstore._with_bucket(ids, 4).collect()}
    assert {(r["world"], r["bucket"]) for r in rows.where("data_version = 2").collect()} <= touched
    # Sizes of the manifest are those of the data, and a bucket that lost its last file is no more.
    assert rows.agg(F.sum("bytes")).first()[0] == sum(map(len, wanted.values()))
    # A second change that was based on the same state is noticed.
    chunkstore._publish(rows.drop("version").withColumn("change", F.lit("other")), path, 2)
    with pytest.raises(RuntimeError, match="two changes"):
        chunkstore.scan_chunks(spark, path)


def test_ranges(spark, small):
    path, held = small
    draw, asked = random.Random(2), []
    for i in range(200):
        world, node = draw.choice([*held, ("w", "missing")])
        asked.append((i, world, node, draw.choice([None, -3, 0, 5, 10, 39, 1000]), draw.choice([None, 0, 1, 10, 25, 10**9])))
    frame = spark.createDataFrame(asked, "request_id bigint, world string, node_id string, offset bigint, limit bigint")
    found = {}
    for r in sorted(chunkstore.read_ranges(frame, spark, path).collect(), key=lambda r: r["start_byte"]):
        found.setdefault(r["request_id"], []).append(r)
    assert len(found) == 200
    for i, world, node, offset, limit in asked:
        rows = found[i]
        if (world, node) not in held:
            assert [r["status"] for r in rows] == ["not_found"]
            continue
        a = max(offset or 0, 0)
        want = held[world, node][a : None if limit is None else a + limit]
        assert b"".join(bytes(r["content"] or b"") for r in rows) == want
        assert {r["status"] for r in rows} == {"ok" if want else "out_of_range"}
        assert len(rows) <= len(want) // 10 + 2 and sum(r["length"] for r in rows) == len(want)


def test_whole_files(spark):
    rows = [("w", "good", 0, 0, 10), ("w", "good", 1, 10, 3), ("w", "gap", 0, 0, 10), ("w", "gap", 2, 20, 1), ("w", "twice", 0, 0, 4),
            ("w", "twice", 0, 0, 4), ("w", "short", 0, 0, 9), ("w", "short", 1, 10, 1), ("w", "off", 0, 1, 4), ("w", "late", 1, 10, 4),
            ("w", "empty", 0, 0, 0), ("w", "swap", 0, 0, 10), ("w", "swap", 0, 10, 10), ("w", "long", 0, 0, 11)]
    states = chunkstore.file_states(spark.createDataFrame(rows, "world string, node_id string, chunk_no bigint, start_byte bigint, length bigint"), 10)
    assert {r["node_id"] for r in states.collect() if r["whole"]} == {"good", "empty"}


def test_shares_of_work(spark):
    # A thousand million small files, and one file of 80 GB: bytes make the tasks, not the number of files.
    files, kb = 10**9, 1024
    weight = copying.task_weight(files * (kb + copying.FILE_BYTES), files, 1000)
    assert files * (kb + copying.FILE_BYTES) / weight <= copying.MOST_TASKS
    assert copying.task_weight(80 << 30, 10_240, 8) == copying.TASK_BYTES
    assert copying.task_weight(0, 0, 8) == 1 and copying.task_weight(100, 2, 8) == 50
    tiny = spark.range(1_000_000).select(F.format_string("f%07d", "id").alias("node_id"), (F.col("id") % 100).alias("size"))
    plan = copying.balanced_pieces(tiny, 0, 1 << 30).groupBy("task").agg(F.count("*").alias("n"), F.min("node_id").alias("a"), F.max("node_id").alias("b"))
    rows = sorted(plan.collect())
    assert len(rows) == -(-sum(64 * kb + i % 100 for i in range(1_000_000)) // (1 << 30)) == 62
    assert max(r["n"] for r in rows) < 1.01 * min(r["n"] for r in rows[:-1]) and all(x["b"] < y["a"] for x, y in zip(rows, rows[1:]))
    one = spark.createDataFrame([("big", 80 << 30), ("a", None), ("z", 0)], "node_id string, size bigint")
    rows = copying.balanced_pieces(one).groupBy("task").agg(F.sum("length").alias("bytes")).collect()
    assert len(rows) == 321 and max(r["bytes"] for r in rows) <= copying.TASK_BYTES + (8 << 20)


def test_files_in_line(spark):
    # Equal and missing ids, missing sizes, and columns that are only carried, over several partitions.
    rows = [(None if i % 50 == 0 else f"f{i * 7919 % 300:03d}", None if i % 4 == 0 else i * i, {"n": str(i)}) for i in range(1000)]
    files = spark.createDataFrame(rows, "node_id string, size bigint, more map<string,string>").repartition(4)
    line = sorted(copying.in_line(files).collect(), key=lambda r: r["file_no"])
    assert [r["file_no"] for r in line] == list(range(1000))
    assert [r["node_id"] or "" for r in line] == sorted(x[0] or "" for x in rows)
    assert sorted(r["more"]["n"] for r in line) == sorted(str(i) for i in range(1000))
    start = 0
    for r in line:
        assert r["line_start"] == start
        start += (r["size"] or 0) + copying.FILE_BYTES
    assert copying.in_line(files.limit(0)).count() == 0
    # Pieces of files in line are the same as of files that are not, and only the former keep their numbers.
    unique = spark.createDataFrame([(f"f{i * 7919 % 1000:03d}", i * i) for i in range(1000)], "node_id string, size bigint")
    plain, numbered = (copying.balanced_pieces(x, 9000, 1 << 20) for x in (unique, copying.in_line(unique)))
    assert plain.columns == ["node_id", "size", "chunk_no", "start_byte", "length", "task"]
    assert sorted(plain.collect()) == sorted(numbered.select(*plain.columns).collect())
    # Beyond 2^53, weights are still divided as whole numbers: the second file begins one byte before the border.
    w = 1 << 55
    large = spark.createDataFrame([("a", w - 1 - copying.FILE_BYTES), ("b", w + 1 - copying.FILE_BYTES)], "node_id string, size bigint")
    assert {(r["node_id"], r["task"]) for r in copying.balanced_pieces(large, 1 << 60, w).collect()} == {("a", 0), ("b", 0)}


def test_pieces_stay_where_they_are_made(spark, data):
    from treeledger.content_queries import balanced_pieces

    def plan(rows):
        return rows._jdf.queryExecution().executedPlan().toString()

    # Files meet the totals of their partition where they are stored; no window brings them together once more.
    files = spark.createDataFrame([("a", 5), ("b", 7)], "node_id string, size bigint")
    pieces = plan(copying.balanced_pieces(files))
    assert "hashpartitioning(_part" not in pieces.split("BroadcastExchange")[0] and "MapInArrow" not in pieces
    # Pieces are counted as they are made. A sort of them would go to disk.
    shares = plan(balanced_pieces(spark, data))
    assert "explode" in shares and "HashAggregate" in shares and "SortAggregate" not in shares


def node(world, path, kind, size=None):
    from treeledger.functions import paths  # noqa: F401
    import hashlib

    key = lambda p: None if p is None else "root" if p == "/" else hashlib.md5(p.encode()).hexdigest()
    parent = None if path == "/" else path.rsplit("/", 1)[0] or "/"
    return (world, key(path), key(parent), parent, path.rsplit("/", 1)[1] or "/", path, None, path.count("/") if path != "/" else 0, size, kind)


def test_transfer_tells_of_every_file(spark, tmp_path):
    root = tmp_path / "from"
    for name, data in {"a/x": b"1" * 25, "a/y": b"", "b": b"same", "c": b"new", "d/e": b"in the way", "gone": b"soon"}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    have = tree.scan_tree(spark, str(root)).cache()
    have.count()
    os.remove(root / "gone")
    path = str(tmp_path / "store")
    old = spark.createDataFrame([("w", node("w", "/b", "file")[1], b"SAME"), ("w", node("w", "/c", "file")[1], b"old one"),
                                 ("w", node("w", "/d", "file")[1], b"file")], "world string, node_id string, content binary")
    chunkstore.write_chunks(chunkstore.as_chunks(old, 10), path, 10)
    there = spark.createDataFrame([node("w", "/", "folder"), node("w", "/b", "file", 4), node("w", "/c", "file", 7),
                                   node("w", "/d", "file", 4), node("w", "/a", "folder"), node("w", "/a/y", "folder")], NODES)
    nodes, outcome = transfer.transfer(transfer.Mount(str(root)), have, transfer.Store(spark, path, there, "w"), there)
    assert {r["location_path"]: r["status"] for r in outcome.collect()} == {
        "/a/x": "copied", "/a/y": "conflict", "/b": "skipped", "/c": "overwritten", "/d/e": "blocked", "/gone": "not_found"}
    held = files_of(spark, path)
    assert held["w", node("w", "/a/x", "file")[1]] == b"1" * 25 and held["w", node("w", "/c", "file")[1]] == b"new"
    assert {r["location_path"]: (r["type"], r["size"]) for r in nodes.collect()} == {"/a/x": ("file", 25), "/c": ("file", 3)}
    # A store that lost a file's chunks tells so, and other files still come.
    source = there.where("type = 'file'").unionByName(spark.createDataFrame([node("w", "/lost", "file", 9)], NODES))
    target = tmp_path / "to"
    _, outcome = transfer.transfer(transfer.Store(spark, path, source, "w"), source.where("location_path <> '/c'"),
                                   transfer.Mount(str(target)), have.where("false"), 4)
    assert {r["location_path"]: r["status"] for r in outcome.collect()} == {"/b": "copied", "/d": "copied", "/lost": "not_found"}
    assert (target / "b").read_bytes() == b"SAME" and not (target / "lost").exists()


def test_lost_writes_and_existing_only(spark, tmp_path, monkeypatch):
    root = tmp_path / "t"
    root.mkdir()
    (root / "old").write_bytes(b"OLD!")
    rows = spark.createDataFrame([("/old", b"new!"), ("/none", b"x")], "location_path string, content binary")
    assert {r["location_path"]: r["status"] for r in tree.write_tree(rows, str(root), create=False).collect()} == {
        "/old": "written", "/none": "not_found"}
    assert (root / "old").read_bytes() == b"new!" and not (root / "none").exists()
    # The manifest of a write whose staged file has vanished: an old file of the same size is no proof.
    manifest = str(tmp_path / "manifest")
    real = tree.commit_tree
    monkeypatch.setattr(tree, "commit_tree", lambda s, m, r, c: (s.read.parquet(m).write.parquet(manifest), real(s, m, r, c))[1])
    done = spark.createDataFrame([("/old", b"NEW!")], "location_path string, content binary")
    tree.write_tree(done, str(root))
    assert [r["status"] for r in real(spark, manifest, str(root)).collect()] == ["written"]  # run again
    (root / "other").write_bytes(b"OLD!")
    os.replace(root / "other", root / "old")
    assert [r["status"] for r in real(spark, manifest, str(root)).collect()] == ["lost"]


def test_new_files_are_linked_to_their_place(tmp_path, monkeypatch):
    place, renamed, rename, link = tree._placer(), [], os.replace, os.link
    monkeypatch.setattr(os, "replace", lambda a, b: (renamed.append(os.path.basename(b)), rename(a, b))[1])
    (tmp_path / "in").mkdir()
    new, old = tmp_path / "in" / "new", tmp_path / "in" / "old"
    old.write_bytes(b"old")

    def stage(name):
        staged = tmp_path / name
        staged.write_bytes(name.encode())
        return staged

    place(str(stage("a")), str(new))
    assert renamed == [] and new.read_bytes() == b"a" and new.stat().st_nlink == 1
    place(str(stage("b")), str(old))
    assert renamed == ["old"] and old.read_bytes() == b"b"
    # A run that ended after the link: the next one clears the staged name and keeps the file.
    link(new, tmp_path / "c")
    place(str(tmp_path / "c"), str(new))
    assert new.read_bytes() == b"a" and not (tmp_path / "c").exists()
    # A folder in the way, nothing staged, and a mount without links.
    with pytest.raises(IsADirectoryError):
        place(str(stage("d")), str(tmp_path / "in"))
    with pytest.raises(FileNotFoundError):
        place(str(tmp_path / "none"), str(tmp_path / "in" / "x"))

    def refuse(*_):
        raise PermissionError(1, "no links")

    monkeypatch.setattr(os, "link", refuse)
    place(str(stage("e")), str(tmp_path / "in" / "e"))
    assert (tmp_path / "in" / "e").read_bytes() == b"e" and sorted(os.listdir(tmp_path)) == ["d", "in"]


def test_commit_again_after_a_link(spark, tmp_path):
    (tmp_path / "t" / "in").mkdir(parents=True)
    staged, final = tmp_path / "staged", tmp_path / "t" / "in" / "f"
    staged.write_bytes(b"data")
    os.link(staged, final)
    manifest = str(tmp_path / "manifest")
    spark.createDataFrame([("/in/f", str(staged), 0, 4, staged.stat().st_ino)],
                          "location_path string, staged string, start_byte bigint, length bigint, inode bigint").write.parquet(manifest)
    for _ in range(2):
        assert [r["status"] for r in tree.commit_tree(spark, manifest, str(tmp_path / "t")).collect()] == ["written"]
        assert final.read_bytes() == b"data" and not staged.exists()


def test_pieces_of_files_that_take_turns(spark, tmp_path):
    data = {"/a/x": b"0123456789", "/a/y": b"abcdefghij", "/z": b""}
    pieces = [(k, v[i:i + 3], i) for i in (0, 6, 3, 9) for k, v in data.items() if i < len(v)] + [("/z", b"", 0)]
    rows = spark.createDataFrame(pieces, "location_path string, content binary, start_byte bigint").coalesce(1)
    assert {(r["location_path"], r["size"], r["status"]) for r in tree.write_tree(rows, str(tmp_path / "t")).collect()} == {
        (k, len(v), "written") for k, v in data.items()}
    files = [(str(tmp_path / "t") + k, k, len(v)) for k, v in data.items()] + [(str(tmp_path / "t/a/xx"), "/a/xx", 5)]
    back = tree.read_chunks(spark.createDataFrame(files, "node_id string, location_path string, size bigint").coalesce(1), 4).collect()
    assert {r["location_path"]: r["status"] for r in back} == {"/a/x": "ok", "/a/xx": "not_found", "/a/y": "ok", "/z": "ok"}
    for k, v in data.items():
        assert b"".join(r["content"] for r in sorted(back, key=lambda r: r["start_byte"]) if r["location_path"] == k) == v


def test_scan_errors(spark, tmp_path):
    (tmp_path / "ok").mkdir()
    (tmp_path / "ok" / "f").write_bytes(b"1")
    bad = os.fsencode(str(tmp_path)) + b"/b\xffd"
    os.mkdir(bad)
    with open(bad + b"/in", "wb"):
        pass
    for budget in (0, 1000):
        nodes, errors = tree.scan_tree_with_errors(spark, str(tmp_path), first_budget=budget, budget=budget)
        assert {r["location_path"] for r in nodes.collect()} == {"/ok", "/ok/f"}
        assert {(bytes(r["raw"]), r["problem"]) for r in errors.collect()} == {(bad, "not_utf8"), (bad + b"/in", "not_utf8")}
    with pytest.raises(OSError, match="not_utf8"):
        tree.scan_tree(spark, str(tmp_path), strict=True)
    # A folder that is removed while the scan runs.
    gone = spark.createDataFrame([(str(tmp_path / "gone").encode(),)], "path binary")
    rows = gone.mapInPandas(tree._lister(10), tree._LISTING).collect()
    assert [(r["path"], r["problem"]) for r in rows] == [(str(tmp_path / "gone"), "ENOENT")]
