"""Mounted trees: odd names, links, pieces, and repeated commits."""

import os

import pytest

from treeledger.plans.bulkcopy import copy_tree
from treeledger.sources import tree


@pytest.fixture()
def mounted(tmp_path):
    root = tmp_path / "root"
    for folder in (".hidden", "empty", "a/b/c", "sp ace%"):
        (root / folder).mkdir(parents=True)
    (root / ".hidden" / ".f").write_bytes(b"h")
    (root / "_name").write_bytes(b"n")
    (root / "zero").write_bytes(b"")
    (root / "a/b/c/deep.bin").write_bytes(bytes(range(256)) * 40)
    (root / "sp ace%" / "é.txt").write_bytes("ü".encode())
    os.symlink(root / "a", root / "link")
    return str(root)


@pytest.mark.parametrize("budget", [1, 10**6])
def test_scan(spark, mounted, budget):
    rows = tree.scan_tree(spark, mounted, first_budget=budget, budget=budget).collect()
    seen = {r.location_path: r for r in rows}
    assert len(rows) == len(seen)
    expected = set()
    for folder, folders, files in os.walk(mounted):
        expected |= {os.path.join(folder, n)[len(mounted):] for n in folders + files}
    assert set(seen) == expected
    assert seen["/link"].type == "file" and seen["/link"].size == os.lstat(mounted + "/link").st_size
    assert seen["/empty"].type == "folder" and seen["/empty"].size is None
    assert seen["/zero"].size == 0
    deep = seen["/a/b/c/deep.bin"]
    assert (deep.depth_level, deep.parent_path, deep.size) == (4, "/a/b/c", 10240)
    assert deep.node_id == mounted + "/a/b/c/deep.bin"
    assert int(deep.last_updated.timestamp()) == int(os.stat(deep.node_id).st_mtime)


def test_scan_of_missing_root(spark, tmp_path):
    with pytest.raises(NotADirectoryError):
        tree.scan_tree(spark, str(tmp_path / "none"))


def test_copy_in_pieces(spark, mounted, tmp_path):
    target = str(tmp_path / "target")
    files = tree.scan_tree(spark, mounted).where("type = 'file' AND name <> 'link'")
    status = copy_tree(files, target, buffer=100).collect()
    assert {r.status for r in status} == {"written"} and len(status) == 5
    for r in status:
        with open(mounted + r.location_path, "rb") as a, open(target + r.location_path, "rb") as b:
            assert a.read() == b.read()
    assert not [n for n in os.listdir(target) if n.startswith(".staging")]


def test_missing_file_is_reported(spark, mounted):
    files = spark.createDataFrame([(mounted + "/nope", 5), (mounted + "/_name", 1)], "node_id string, size bigint")
    got = {r.node_id: (r.status, r.content) for r in tree.read_chunks(files).collect()}
    assert got == {mounted + "/nope": ("not_found", None), mounted + "/_name": ("ok", b"n")}


def test_only_whole_files_are_committed(spark, tmp_path):
    rows = [
        ("/whole", b"abc", 3), ("/whole", b"xyz", 0),
        ("/gap", b"abc", 4), ("/gap", b"xyz", 0),
        ("/overlap", b"abc", 2), ("/overlap", b"xyz", 0),
        # One overlap and one gap of the same length.
        ("/both", b"aaa", 0), ("/both", b"aaa", 0), ("/both", b"bbb", 6),
        ("/twice", b"q", 0), ("/twice", b"q", 0),
        ("../../escape", b"e", 0), ("/void", b"", 0),
    ]
    root = str(tmp_path / "out")
    frame = spark.createDataFrame(rows, "location_path string, content binary, start_byte bigint")
    got = {r.location_path: r.status for r in tree.write_tree(frame, root).collect()}
    assert got == {
        "/whole": "written", "/gap": "incomplete", "/overlap": "incomplete", "/both": "incomplete",
        "/twice": "incomplete", "/escape": "written", "/void": "written",
    }
    assert open(root + "/whole", "rb").read() == b"xyzabc"
    assert sorted(n for n in os.listdir(root) if not n.startswith(".")) == ["escape", "void", "whole"]


def test_commit_can_be_repeated(spark, tmp_path):
    root, staged, manifest = tmp_path / "out", tmp_path / "staged", str(tmp_path / "manifest")
    root.mkdir()
    staged.write_bytes(b"data")
    spark.createDataFrame(
        [("/f", str(staged), 0, 4), ("/lost", str(tmp_path / "no"), 0, 4)],
        "location_path string, staged string, start_byte bigint, length bigint",
    ).write.parquet(manifest)
    for _ in range(2):
        got = {r.location_path: r.status for r in tree.commit_tree(spark, manifest, str(root)).collect()}
        assert got == {"/f": "written", "/lost": "lost"}
    assert (root / "f").read_bytes() == b"data"


def test_copy_reports_every_planned_file(spark, mounted, tmp_path):
    """Files planned longer than they are, and files that are gone, are not committed."""
    target = str(tmp_path / "target")
    rows = [
        (mounted + "/a/b/c/deep.bin", "/long", 20_000), (mounted + "/_name", "/short", 250),
        (mounted + "/gone", "/gone", 500), (mounted + "/zero", "/zero", 0), (mounted + "/_name", "/good", 1),
    ]
    files = spark.createDataFrame(rows, "node_id string, location_path string, size bigint")
    status = {r.location_path: r.status for r in copy_tree(files, target, buffer=100).collect()}
    assert status == {
        "/long": "not_found" if status["/long"] == "not_found" else "short_read",
        "/short": "short_read", "/gone": "not_found", "/zero": "written", "/good": "written",
    }
    assert sorted(os.listdir(target)) == ["good", "zero"]


def test_small_rows_use_many_tasks(spark, tmp_path):
    files = spark.createDataFrame([("/none", 80 * 2**30)], "node_id string, size bigint")
    assert tree.read_chunks(files).rdd.getNumPartitions() == 321
    assert tree._tasks(spark, 5000, 100) == 50 and tree._tasks(spark, 3, 100) == 3
