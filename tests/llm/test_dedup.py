"""SimHash groups, components and the suffix array against plain Python."""

import random
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from treeledger.llm import components, simhash, suffixes


def groups_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components(spark):
    draw = random.Random(3)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    found = {r[0]: r[1] for r in components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == groups_of([p for p in pairs if p[0] != p[1]], nodes)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_links_of_fingerprints(spark):
    """Also with cells that are cut into many blocks."""
    draw = random.Random(5)
    values = {0, 2**64 - 1}
    for _ in range(12):
        seed = draw.getrandbits(64)
        for _ in range(30):
            seed ^= 1 << draw.randrange(64)
            if draw.random() < 0.6:
                seed ^= 1 << draw.randrange(64)
            values.add(seed)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    rows = spark.createDataFrame([(s,) for s in signed.values()], "fp bigint")
    for bits in (0, 1, 3, 5):
        wanted = groups_of(
            [(signed[a], signed[b]) for a in values for b in values if a < b and (a ^ b).bit_count() <= bits],
            set(signed.values()),
        )
        for block in (2048, 5):
            edges = simhash.fingerprint_links(rows, bits, block).collect()
            assert groups_of([(r[0], r[1]) for r in edges], set(signed.values())) == wanted


def test_simhash_groups(spark, documents, empty):
    rows = simhash.simhash_groups(documents).select("doc_id", "fp", "component_id").collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert len(rows) == documents.count()
    values = {}
    for r in rows:
        values[r["doc_id"]] = r["fp"] & (2**64 - 1)
        assert values[r["doc_id"]] == plain_fingerprint(texts[r["doc_id"]])
    ids = [i for i in values if i is not None]
    wanted = groups_of([(a, b) for a in ids for b in ids if (values[a] ^ values[b]).bit_count() <= 3], ids)
    assert all(r["component_id"] == wanted[r["doc_id"]] for r in rows if r["doc_id"] is not None)
    assert wanted[8] == 7 and wanted[3] == 2
    assert simhash.simhash_groups(empty).count() == 0
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(i) for i in [*set(wanted.values()), None]
    )
    assert simhash.keep_one(empty).count() == 0


def plain_spans(rows, least):
    """Covered words of each document, kept and to be cut."""
    seen = defaultdict(set)
    for i, words in rows:
        for k in range(len(words) - least + 1):
            seen[tuple(words[k : k + least])].add(i)
    out = defaultdict(set)
    for i, words in rows:
        for k in range(len(words) - least + 1):
            docs = seen[tuple(words[k : k + least])]
            if len(docs) > 1:
                out[i, min(docs) == i].update(range(k, k + least))
    return dict(out)


def found_spans(frame):
    out = defaultdict(set)
    for r in frame.collect():
        out[r["doc"], r["kept"]].update(range(r["start_word"], r["start_word"] + r["n_words"]))
    return dict(out)


def test_spans_against_all_windows(spark):
    draw = random.Random(11)
    letters = ["a", "b", "c"]
    base = [[draw.choice(letters) for _ in range(draw.randrange(0, 60))] for _ in range(12)]
    rows = []
    for i in range(60):
        parts = [draw.choice(base)[draw.randrange(20) :] for _ in range(3)]
        rows.append((i, [w for p in parts for w in p]))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    for least, run in ((8, 3), (12, 5), (20, 4)):
        assert found_spans(suffixes.repeated_spans(docs, least=least, run=run)) == plain_spans(rows, least)


def test_cut_repeats(spark, documents, empty):
    spans = found_spans(suffixes.repeated_spans(documents))
    assert set(spans) == {(6, True), (7, False), (8, False), (7, True)} - {(7, True)} | (
        {(7, True)} if (7, True) in spans else set()
    )
    cut = suffixes.cut_repeats(documents)
    assert cut.columns == documents.columns and cut.dtypes == documents.dtypes
    rows = {r["doc_id"]: r for r in cut.collect()}
    assert "word120" in rows[6]["text"] and "word120" not in rows[7]["text"]
    assert rows[7]["text"].split() == "gamma delta two".split() and rows[7]["n_chars"] == len(rows[7]["text"])
    assert rows[2]["text"] is None and rows[3]["text"] == "" and rows[1]["n_chars"] == 72
    assert suffixes.cut_repeats(empty).count() == 0 and suffixes.repeated_spans(empty).count() == 0
    whole = spark.createDataFrame([(1, "w " * 80), (2, "w " * 80)], "doc_id bigint, text string")
    assert [r["doc_id"] for r in suffixes.cut_repeats(whole).collect()] == [1]
    assert suffixes.cut_repeats(whole.withColumn("spans", F.lit(1))).columns == ["doc_id", "text", "spans"]


def test_rows_without_id_are_documents_of_their_own(spark):
    """Two of them share a passage with each other, and one with a row that has an id."""
    passage = " ".join(f"p{i}" for i in range(60))
    other = " ".join(f"q{i}" for i in range(60))
    rows = [(None, f"one {passage} end"), (None, f"two two {passage} stop {other}"), (7, f"seven {other}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = suffixes.repeated_spans(docs).collect()
    # Each passage stays once, and is cut once; the row with an id comes first.
    assert sorted((r["kept"], r["n_words"]) for r in spans) == [(False, 60), (False, 60), (True, 60), (True, 60)]
    cut = [r["text"].split() for r in suffixes.cut_repeats(docs).collect()]
    words = [w for text in cut for w in text]
    assert words.count("p0") == words.count("q0") == 1 and len(words) == 120 + 6
    assert next(r["text"] for r in suffixes.cut_repeats(docs).collect() if r["doc_id"] == 7) == f"seven {other}"
    twice = docs.where("doc_id is null").unionByName(docs.where("doc_id is null"))
    assert suffixes.repeated_spans(twice).count() == 2


def test_runs_over_the_borders_of_partitions(spark, tmp_path):
    """One passage in all documents, whose suffixes lie in several partitions of the sorted table: each
    run has one number and one first document there, and equal suffixes are compared once."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own{i} " + " ".join(f"x{i}y{k}" for k in range(30)) + f" {passage} end{i}") for i in range(400)]
    docs = spark.createDataFrame([*rows, rows[5], rows[5]], "doc_id bigint, text string")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        keyed = suffixes._keyed(docs, "doc_id", "text")
        kept = suffixes._suffix_rows(keyed, 50, 10)
        matched = suffixes._matched(kept).collect()
        heads = [r[0] for r in kept.where("doc <> 5").unionByName(kept.where("doc = 5").distinct()).groupBy("head")
                 .agg(F.countDistinct("doc").alias("n"), F.count("*").alias("rows")).where("n > 1").select("rows").collect()]
        assert sorted(heads) == sorted(
            sum(r["run_id"] == run for r in matched) for run in {r["run_id"] for r in matched}
        )
        least = defaultdict(set)
        for r in matched:
            least[r["run_id"], r["first_doc"]].add(r["doc"])
        assert len(least) == len(heads) and all(min(docs) == first for (_, first), docs in least.items())
        pieces = suffixes._compared(kept).where("head is not null")
        assert pieces.groupBy("head").count().where("count > 1").count() > 0
        found = found_spans(suffixes.repeated_spans(docs))
        assert found == plain_spans([(i, t.split()) for i, t in rows], 50)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
        for name, value in before.items():
            spark.conf.set(name, value)


def test_neighbours_in_small_batches(spark):
    """Runs that begin, wait and end in any place of a batch, against a count of documents a run."""
    draw = random.Random(2)
    rows = []
    for _ in range(600):
        doc = draw.randrange(40)
        rows.append((f"h{draw.randrange(90)}", 1, doc, doc % 3, draw.randrange(4), 9))
    schema = "head string, whole bigint, doc bigint, digest bigint, first int, last int"
    frame = spark.createDataFrame(rows, schema)
    wanted = defaultdict(set)
    for r in rows:
        wanted[r[0]].add((r[2], r[3], r[4]))
    wanted = {h: v for h, v in wanted.items() if len({x[0] for x in v}) > 1}
    try:
        for size in (1, 3, 500):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
            found = defaultdict(set)
            for r in suffixes._matched(frame).collect():
                found[r["run_id"]].add((r["doc"], r["digest"], r["first"]))
                assert r["first_doc"] <= r["doc"]
            assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted.values()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def test_very_long_words(spark):
    """Words beyond 64 bytes count by all of their letters."""
    long = ["a" * 5000 + str(i) + "b" * 5000 for i in range(60)]
    other = [*long[:30], long[30] + "c", *long[31:]]
    rows = [(1, " ".join(long)), (2, " ".join(long)), (3, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_spans(suffixes.repeated_spans(docs)) == plain_spans([(i, t.split()) for i, t in rows], 50)
