"""Path rules against a restatement of them in plain Python."""

import posixpath
import random

from pyspark.sql import functions as F

from treeledger.functions import paths as P
from treeledger.operators import pathjobs
from treeledger.operators.nodes import with_depth

SPACES = [" ", "\t", "\xa0", "\u3000", "\x85", " ", "\u200b"]


def clean(path):
    out, rooted = [], path.startswith("/")
    for part in path.split("/"):
        if part in ("", "."):
            continue
        if part != "..":
            out.append(part)
        elif out and out[-1] != "..":
            out.pop()
        elif not rooted:
            out.append(part)
    return "/" + "/".join(out) if rooted else "/".join(out) or "."


def location(path):
    path = path.strip("".join(SPACES[:-1]) + "\n\r\v\f").replace("\\", "/")
    return clean(path if path.startswith("/") else "/" + path) if path else "/"


def physical(path):
    path = clean(path).replace("\\", "/")
    return path[:-1] if path.endswith("/") else path


def random_paths(n, seed):
    rng = random.Random(seed)
    atoms = ["/", "//", "..", ".", "a", "b.c", "\\", "é", "...", "c d", "\n", *SPACES]
    return ["".join(rng.choices(atoms, k=rng.randrange(9))) for _ in range(n)]


def columns(spark, values, **rules):
    rows = spark.createDataFrame([(v,) for v in values], "p string")
    return rows.select("p", *[r(F.col("p")).alias(n) for n, r in rules.items()]).collect()


def test_random_paths(spark):
    got = columns(
        spark, random_paths(6000, 7), clean=P.clean, location=P.normalize_location,
        parent=P.normalize_parent, physical=P.normalize_physical,
    )
    for row in got:
        assert row.clean == clean(row.p), row
        assert row.location == location(row.p), row
        assert row.parent == ("" if location(row.p) == "/" and not row.p.strip(
            "".join(SPACES[:-1]) + "\n\r\v\f") else location(row.p)), row
        assert row.physical == physical(row.p), row


def test_known_physical(spark):
    got = {r.p: r.physical for r in columns(
        spark, ["/", "", "a\\..\\b", "/a/../..", "a/", "../x"], physical=P.normalize_physical)}
    assert got == {"/": "", "": ".", "a\\..\\b": "a/../b", "/a/../..": "", "a/": "a", "../x": "../x"}


def test_children(spark):
    rows = spark.createDataFrame(
        [("/", "a"), ("/x", "a"), ("", "a"), ("", ""), ("/x/", "../y"), ("/x", "b\\c")], "d string, n string")
    got = rows.select(P.child_physical(F.col("d"), F.col("n"))).toPandas().iloc[:, 0].tolist()
    assert got == ["/a", "/x/a", "a", "", "/y", "/x/b/c"]


def test_relocate_outside_and_sibling(spark):
    rows = spark.createDataFrame(
        [("/home/user", "a"), ("/home/user/x", "b"), ("/home/user2/x", "c"), ("/etc", "d")],
        "parent_id string, name string")

    def run(compat):
        out = pathjobs.relocate_nodes(rows, "/home/user", compat).orderBy("name")
        return [(r.parent_path, r.location_path) for r in out.collect()]

    assert run(False) == [("/", "/a"), ("/x", "/x/b"), ("/", "/c"), ("/", "/d")]
    assert run(True)[2] == ("/2/x", "/2/x/c")


def test_guard_on_slash(spark):
    rows = spark.createDataFrame([("/",), ("/a",)], "path string")
    allowed = lambda compat: [r.allowed for r in pathjobs.root_guard(rows, "/", compat=compat).orderBy("path").collect()]
    assert allowed(False) == [True, True]
    assert allowed(True) == [True, False]


def test_depth_compat(spark):
    rows = spark.createDataFrame([("local", "/a/b"), ("primary", "/a/b")], "world string, location_path string")
    assert [r.depth_level for r in with_depth(rows, True).orderBy("world").collect()] == [0, 2]
    assert [r.depth_level for r in with_depth(rows).orderBy("world").collect()] == [2, 2]


def test_very_long_paths(spark):
    long = "/a" * 20_000
    got = columns(spark, [long, long + "/", "a" + long], location=P.normalize_location, depth=P.depth_of)
    assert [r.location for r in got] == [long, long, "/a" + long]
    assert got[0].depth == 20_000


def test_prefixes(spark):
    got = columns(spark, ["/", "/a/b"], steps=P.prefixes)
    assert [r.steps for r in got] == [["/"], ["/", "/a", "/a/b"]]


def test_clean_agrees_with_posix(spark):
    plain = [p for p in random_paths(500, 3) if not p.startswith("//")]
    for row in columns(spark, plain, clean=P.clean):
        assert row.clean == posixpath.normpath(row.p) or row.p.startswith("//")
