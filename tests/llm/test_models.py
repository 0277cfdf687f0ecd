"""Language and quality models by held-out accuracy, search against brute force, rules, URLs, pipeline."""

import math
import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from treeledger.llm import hyperdim, ledger, pulearn, urlfilter, voronoi

SMALL = "/root/testdata/sf0.01"


def test_language(spark, documents, empty):
    rows = entry.queries()["op3_language_id"](spark, SMALL)
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = rows.collect()
    assert len(rows) == len(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.97
    names, table = hyperdim.train(documents)
    found = {r["doc_id"]: r for r in hyperdim.identify(documents, names, table).collect()}
    assert found[2]["lang_pred"] == found[3]["lang_pred"] == found[4]["lang_pred"] == "und"
    assert found[1]["lang_pred"] in names and found[None]["lang_pred"] in names
    names, table = hyperdim.train(empty)
    assert names == [] and {r["lang_pred"] for r in hyperdim.identify(documents, names, table).collect()} == {"und"}
    assert hyperdim.identify(empty, names, table).count() == 0


def test_quality(spark, documents, empty):
    rows = entry.queries()["op9_quality_classifier"](spark, SMALL).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    some = spark.createDataFrame([(1, 1), (5, 0), (6, 1), (99, 1), (7, None), (None, 1)], "doc_id bigint, quality int")
    for docs, given in ((documents, none), (documents, some), (empty, some), (empty, none)):
        model = pulearn.train(docs, given)
        scores = docs.select(pulearn.score(model, F.col("text")).alias("s")).collect()
        assert len(scores) == docs.count() and all(0 <= r["s"] <= 1 for r in scores)


def test_risk_is_minimised():
    draw = np.random.default_rng(1)
    good, bad = draw.normal(1, 1, (400, 2)), draw.normal(-1, 1, (400, 2))
    mixed = np.concatenate([draw.normal(1, 1, (600, 2)), draw.normal(-1, 1, (400, 2))])
    one = lambda x: np.c_[x, np.ones(len(x))]
    w = pulearn.learn(one(good), one(mixed), 0.6)
    assert (one(good) @ w > 0).mean() > 0.85 and (one(bad) @ w < 0).mean() > 0.85


def brute(rows, k):
    clean = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean.setdefault((i, tuple(math.floor(1024 * x) for x in v)))
    out = set()
    for i, q in clean:
        if i % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in clean if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)}
    return out


@pytest.mark.parametrize("pivots, block, rows_of", [(128, 4096, 4096), (5, 2, 7)])
def test_search(spark, pivots, block, rows_of):
    draw = np.random.default_rng(2)
    centres = draw.normal(0, 1, (6, 4))
    rows = [(int(i), [float(x) for x in centres[i % 6] + draw.normal(0, 0.05, 4)]) for i in range(801)]
    rows += [(900, [0.0] * 4), (1000, [1.0]), (1001, None), (1002, [1.0, None, 1.0, 1.0]), (1003, [float("nan")] * 4)]
    rows += [(1004, [float("inf")] * 4), (None, [1.0] * 4), rows[0], (1100, []), (1005, rows[100][1]), (1006, rows[100][1])]
    frame = spark.createDataFrame(
        [(i, v, "x", 1.0) for i, v in rows], "vec_id bigint, embedding array<double>, cell string, score double"
    )
    found = voronoi.top_k(frame, F.col("id") % 100 == 0, 10, pivots=pivots, block=block, slice_rows=rows_of)
    assert {tuple(r) for r in found.collect()} == brute(rows, 10)
    assert voronoi.top_k(frame.where("false"), F.col("id") % 100 == 0).count() == 0
    assert voronoi.top_k(frame.where("vec_id = 0").limit(1), F.col("id") % 100 == 0).count() == 0


def test_search_sends_only_what_is_needed(spark):
    """Far clusters in few dimensions: most vectors are not needed by the only query group."""
    rows = [(i, [float(10 ** (i % 4)), 1.0]) for i in range(4000)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = voronoi.top_k(frame, F.col("id") == 3, 10).collect()
    assert [r["vec_id"] for r in found] == [i for i in range(7, 60, 4)][:10]


def test_search_counts_what_is_sent(spark):
    """Clusters in eight directions: each group of queries is sent its own cluster and few others, and the
    best are those of brute force."""
    rng = np.random.default_rng(3)
    centres = [(np.cos(a), np.sin(a)) for a in np.arange(8) * np.pi / 4]
    vectors = np.array([50 * np.array(centres[i % 8]) + rng.normal(0, 0.5, 2) for i in range(4000)])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked_for = F.col("id") % 50 == 0
    asked, data, _ = voronoi._sent(frame, asked_for, 10, "vec_id", "embedding", 64, 4096, 100, 10)
    groups = asked.select("group").distinct().count()
    assert groups >= 4
    # All groups together are sent less than each row once; without bounds it were each row to each group.
    assert data.count() < len(rows)
    # Slices follow what a group is sent, not the whole table.
    assert asked.agg(F.max("slice")).first()[0] < 10
    exact = np.floor(vectors * 1024).astype(np.int64)
    found = {}
    for r in voronoi.top_k(frame, asked_for, 10, pivots=64, slice_rows=100, group_queries=10).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(found) == list(range(0, 4000, 50))
    for q, best in found.items():
        scores = exact @ exact[q]
        order = [i for i in np.lexsort((np.arange(4000), -scores)) if i != q][:10]
        assert [best[n] for n in range(1, 11)] == [(i, scores[i]) for i in order]


def test_ledger(documents, empty):
    rows = {r["doc_id"]: r for r in ledger.build_ledger(documents).collect()}
    assert rows[2]["n_words"] == rows[3]["n_words"] == rows[4]["n_words"] == 0 and rows[2]["failed"] & 1
    assert rows[1]["n_words"] == 18 and rows[1]["n_repeat_words"] == 18
    assert rows[5]["n_words"] == 30_000 and rows[5]["n_repeat_words"] == 30_000
    assert rows[9]["n_symbols"] == 4
    assert ledger.build_ledger(empty).count() == 0 and ledger.ablate(ledger.build_ledger(empty)).count() == 0
    book = ledger.build_ledger(documents)
    bits = {r.name: 1 << r.bit for r in ledger.RULES}
    failed = [r["failed"] for r in book.collect()]
    for r in ledger.ablate(book).collect():
        policy = ledger.BASE if r["policy"] == "base" else ledger.CURRENT
        whole = ledger.mask(policy)
        bit = bits[r["rule"]]
        assert r["failing"] == sum(bool(f & bit) for f in failed)
        assert r["only_this"] == sum(f & whole == bit for f in failed)
        assert r["kept_without"] == sum(f & whole & ~bit == 0 for f in failed)


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x", "http://example.org/en/12?x",
        "https://a.example.org/en/1", "http://badexample.org/es/", "http://x.com/fr/a", "http://x.com/de/a#f",
        "http://listed.net/a.html?utm_x=1&b=2&a=1#t", "http://listed.net/a/?a=1&b=2", "http://org/x", "ftp://y\n://z/p",
        "http://listed.net/a?a=1&b=2",
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    rules = [
        urlfilter.Rule("allow", "org", "/"), urlfilter.Rule("block", "example.org", "/es/"),
        urlfilter.Rule("block", "example.org", "/en/1"), urlfilter.Rule("allow", "com", "/fr/"),
        urlfilter.Rule("block", "com", "/de/"),
    ]
    listed = spark.createDataFrame([("listed.net/a?a=1&b=2",), (None,), ("other.net/",)], "canonical string")
    rows = {r["page_id"]: r for r in urlfilter.filter_urls(pages, listed, rules).collect()}
    assert len(rows) == len(urls)
    assert [rows[i]["rule"] for i in range(10)] == [
        None, None, None, None, "example.org/es/", "example.org/en/1", "example.org/en/1", "org/", "com/fr/", "com/de/"
    ]
    assert [rows[i]["verdict"] for i in (10, 11, 14)] == ["block"] * 3
    assert [rows[i]["verdict"] for i in (0, 1, 2, 3)] == ["allow"] * 4
    assert rows[4]["host"] == "www.example.org" and rows[4]["path"] == "/es/x" and rows[12]["rule"] == "org/"
    assert rows[0]["host"] == "" and rows[0]["path"] == "" and rows[13]["host"] == "y\n:" or rows[13]["host"] == "y\n:"
    assert urlfilter.filter_urls(pages.where("false"), listed, rules).count() == 0
    nothing = urlfilter.filter_urls(pages, listed.where("false"), rules).collect()
    assert not any(r["listed"] for r in nothing)
    # A filter that is far too small only lets more through to the exact join.
    keys = spark.range(3000).select(F.concat(F.lit("u"), F.col("id")).alias("k"))
    some = keys.where("crc32(k) % 3 = 0")
    assert {r[0] for r in urlfilter.listed_hits(keys, some, "k", 3000).collect()} == {r[0] for r in some.collect()}
    bloom = urlfilter.bloom_filter(some, "k", 32)
    possible = urlfilter.possible_hits(keys, "k", bloom, 32).count()
    assert some.count() <= possible < 1.2 * some.count()


def test_pipeline(spark, data, documents, empty):
    rows = spark.read.parquet(f"{data}/documents.parquet")
    columns = rows.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, data)
        assert rows.columns == columns, name
        rows = rows.cache()
        assert rows.count() > 100, name
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, data)
    words = rows.select(F.sum(F.length("text"))).first()[0]
    assert packed.agg(F.sum("length")).first()[0] > words / 20
    for docs in (documents, empty):
        rows = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, data)
            assert rows.columns == docs.columns, name
            rows = rows.cache()
        corpus_pipeline.STAGES[-1][1](spark, rows, data).count()
    assert entry.queries()["pipeline"](spark, data).count() > 100
