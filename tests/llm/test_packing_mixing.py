"""Packing as an exact round trip, mixing against its targets, token counts against whole texts."""

import zlib
from collections import defaultdict

import numpy as np
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
from treeledger.llm import attribution, mixing, packing


def rounded_trip(docs, pieces):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.tokenizer_path())
    wanted = defaultdict(list)
    for r in docs.collect():
        ids = coder.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        wanted[r["doc_id"]].append(np.array(ids, "<u4").tobytes())
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in pieces.collect():
        assert len(r["ids"]) == 4 * r["length"] and r["length"] > 0
        parts[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["sequence_length"]))
    for key, texts in wanted.items():
        for text in set(texts):
            got = sorted(parts[key, len(text) // 4])
            copies = texts.count(text)
            assert b"".join(p for _, p in got) == text or copies > 1
            assert sum(len(p) for _, p in got) == copies * len(text)
    assert {k for k, _ in parts} == set(wanted)
    for places in sequences.values():
        at = 0
        for offset, length, size in sorted(places):
            assert offset == at
            at += length
        assert at == size and size & (size - 1) == 0 and size <= 4096
    return sequences


def test_packing(documents, empty):
    for tokens in (2_000_000, 500):
        rounded_trip(documents, packing.pack(documents, batch_tokens=tokens))
    assert packing.pack(empty).count() == 0


def test_packing_of_all_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    packed = packing.pack(docs)
    sequences = rounded_trip(docs, packed)
    assert {s for (_, _, s), *_ in sequences.values()} >= {512, 1024, 2048, 4096}
    steps = defaultdict(int)
    for r in packed.select("step_group", "length").collect():
        steps[r["step_group"]] += r["length"]
    assert max(steps.values()) - min(steps.values()) <= 4096
    digests = entry.queries()["op2_packing"](spark, data).select("doc_id", "start", "ids_crc32").collect()
    ids = {(r["doc_id"], r["start"]): zlib.crc32(bytes(r["ids"])) for r in packed.collect()}
    assert {(r[0], r[1]): r[2] for r in digests} == ids


def test_targets():
    # 225, 75 and 150 by weight; the first stops at 200, and 25 are shared out one to two.
    assert np.allclose(mixing.targets([100, 100, 100]), [200, 250 / 3, 500 / 3])
    got = mixing.targets([10, 1000, 0, 1000])
    assert got[0] == 20 and got[2] == 0 and abs(sum(got) - 1.5 * 2010) < 1e-6
    assert all(t <= 2 * s + 1e-9 for t, s in zip(got, [10, 1000, 0, 1000]))
    assert mixing.targets([]) == [] and mixing.targets([0]) == [0]


def test_slots_are_drawn_multinomially(spark):
    """Every slot of every source once, in shards whose counts scatter as independent draws do."""
    shape = [(300, 60_000, 5), (7, 20_000, 0), (9_000, 40_000, 0), (4, 0, 0)]
    sources = [{"blocks": b, "slots": n, "cut": c} for b, n, c in shape]
    rows = mixing._slots(spark, sources, 11).toPandas()
    again = mixing._slots(spark, sources, 11).toPandas()
    order = ["shard", "slot"]
    assert rows.sort_values(order).reset_index(drop=True).equals(again.sort_values(order).reset_index(drop=True))
    assert not rows.duplicated(order).any() and not rows.duplicated(["src", "block", "pass"]).any()
    for src, (blocks, slots, cut) in enumerate(shape):
        mine = rows[rows["src"] == src]
        assert len(mine) == slots and (mine["block"] < blocks).all()
        # Each pass is whole before the next begins.
        passes = mine.groupby("pass").size()
        assert (passes.iloc[:-1] == blocks).all()
        assert mine["words"].notna().sum() == (cut > 0)
    counts = rows.groupby(["shard", "src"]).size().unstack(fill_value=0)
    full = counts[counts.sum(axis=1) == mixing.SHARD_SLOTS]
    assert len(full) > 100 and counts.sum(axis=1).max() == mixing.SHARD_SLOTS
    p = 0.5
    spread = full[0].std() / np.sqrt(mixing.SHARD_SLOTS * p * (1 - p))
    assert abs(full[0].mean() / mixing.SHARD_SLOTS - p) < 0.01 and 0.75 < spread < 1.25


def test_running_sums_in_two_levels(spark, data, monkeypatch):
    """Many small buckets and shelves: the words of a source still lie in one line without gaps."""
    monkeypatch.setattr(mixing, "BUCKET_WORDS", 300)
    monkeypatch.setattr(mixing, "SHELF_BUCKETS", 3)
    docs = spark.read.parquet(f"{data}/documents.parquet").withColumn("row", F.monotonically_increasing_id())
    sized = mixing._sized(docs, "doc_id", "text", "source")
    sources = mixing._source_table(sized, mixing.WEIGHTS, 1.5, 2.0, mixing.BLOCK_WORDS)
    assert max(s["buckets"] for s in sources) > 9
    table = spark.createDataFrame([tuple(s[f.name] for f in mixing._SOURCES) for s in sources], mixing._SOURCES)
    at = defaultdict(list)
    for r in mixing._pieces(sized, table).where("length > 0").collect():
        at[r["src"], r["block"]].append((r["in_block"], r["length"]))
    for s in sources:
        assert sum(k[0] == s["src"] for k in at) == s["blocks"]
    for (src, block), parts in at.items():
        end = 0
        for start, length in sorted(parts):
            assert start == end
            end += length
        assert end == sources[src]["base"] + (block < sources[src]["extra"])


def test_mixing(spark, data):
    query = entry.queries()["op5_mixing"]
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = query(spark, data).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        words = len(docs[r["doc_id"]]["text"].encode().split())
        assert r["size"] == words and 0 <= r["taken"] <= 2 * words
        source = docs[r["doc_id"]]["source"]
        size[source] += words
        taken[source] += r["taken"]
        target[source] = r["target"], r["source_size"]
    names = sorted(size)
    assert [target[n][1] for n in names] == [size[n] for n in names]
    assert np.allclose([target[n][0] for n in names], mixing.targets([size[n] for n in names]))
    assert all(abs(taken[n] - target[n][0]) <= 2 + 0.01 * target[n][0] for n in names)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, query(spark, data).collect()))


def test_mixed_documents(documents, empty):
    mixed = mixing.mix_documents(documents, block_words=16)
    assert mixed.columns == documents.columns and mixed.dtypes == documents.dtypes
    words = defaultdict(int)
    for r in mixed.collect():
        words[r["doc_id"]] += len(r["text"].encode().split())
        assert r["n_chars"] == len(r["text"])
    taken = defaultdict(int)
    for r in mixing.mix_counts(documents, block_words=16).collect():
        taken[r["doc_id"]] += r["taken"]
    assert {k: v for k, v in taken.items() if v} == dict(words)
    assert mixing.mix_counts(empty).count() == 0 and mixing.mix_documents(empty).count() == 0


def test_permutations_use_blocks_evenly(spark):
    docs = spark.createDataFrame([(i, "w " * 37, "s") for i in range(50)], "doc_id bigint, text string, source string")
    rows = mixing.mix_counts(docs, block_words=10).collect()
    assert sum(r["taken"] for r in rows) == round(1.5 * 50 * 37)
    assert all(37 - 1 <= r["taken"] <= 74 for r in rows)


def test_attribution(spark, documents, empty):
    import base64

    with open(attribution.ranks_path(), "rb") as source:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, source)}
    coder = tiktoken.Encoding("t", pat_str=attribution.token_pattern(), mergeable_ranks=ranks, special_tokens={})
    parts = [["Hel", "lo wor", "ld ", "again"], ["漢", "字 te", "", "xt"], [None, "a"], ["one piece"]]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(parts)], "doc_id bigint, parts array<string>")
    for rule in attribution.RULES:
        found = defaultdict(dict)
        for r in attribution.attribute(rows, F.col("parts"), rule=rule).collect():
            found[r["doc_id"]][r["section"]] = r["tokens"]
        for i, p in enumerate(parts):
            texts = [x or "" for x in p]
            ids = coder.encode_ordinary("".join(texts))
            wanted = [0.0] * len(texts)
            owner = [k for k, x in enumerate(texts) for _ in x.encode()]
            at = 0
            for token in ids:
                bytes_of = owner[at : at + len(coder.decode_single_token_bytes(token))]
                at += len(bytes_of)
                counts = {k: bytes_of.count(k) for k in sorted(set(bytes_of))}
                if rule == "share":
                    for k, n in counts.items():
                        wanted[k] += n / len(bytes_of)
                else:
                    most = max(counts, key=lambda k: (counts[k], -k))
                    wanted[{"first": bytes_of[0], "last": bytes_of[-1], "most": most}[rule]] += 1
            assert np.allclose([found[i][k] for k in range(len(texts))], wanted), (rule, i)
    rows = attribution.attribute(documents, attribution.lines(F.col("text"))).collect()
    chars, tokens = defaultdict(int), defaultdict(float)
    for r in rows:
        chars[r["doc_id"]] += r["n_chars"]
        tokens[r["doc_id"]] += r["tokens"]
    for r in documents.collect():
        copies = 2 if r["doc_id"] == 8 else 1
        assert chars[r["doc_id"]] == copies * len(r["text"] or "")
        assert tokens[r["doc_id"]] == copies * len(coder.encode_ordinary(r["text"] or ""))
    assert attribution.attribute(empty, attribution.lines(F.col("text"))).count() == 0


def test_words_are_encoded_as_in_the_tokenizer():
    """Hundreds of thousands of words, real and hostile, against the tokenizer itself."""
    import random

    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    words = {w for t in texts for w in (t or "").encode().split()}
    draw = random.Random(6)
    signs = "abcxyzABZ'''sStTrvmld019.,-_<|>!\"#~`^$\\/×÷ªµº²¼ßÀÖØÞàöøÿéñÉÜ漢ж́İ"
    words |= {"".join(draw.choice(signs) for _ in range(draw.randint(1, 12))).encode() for _ in range(60_000)}
    words |= {b"<|endoftext|>", b"a<|startoftext|>b", b"it's", b"'tis", b"\"'s", b"rock'n'roll", b"x" * 5000, b"ab\x01cd", b"\x01", b"\x1c"}
    known = {}
    packing._word_coder()(packing.tokenizer_path())(words, known)
    coder, words = Tokenizer.from_file(packing.tokenizer_path()), sorted(words)
    wanted = coder.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
    wrong = [w for w, e in zip(words, wanted) if known[w] != np.array(e.ids, "<u4").tobytes()]
    assert len(known) == len(words) and not wrong, wrong[:10]


def test_blocks_that_tokens_cross(spark, documents, data):
    """Blocks make up the text; under every rule they add up to the tokens of the document."""
    parts = documents.select("text", attribution.blocks(F.col("text"), 7).alias("parts")).collect()
    for r in parts:
        assert "".join(r["parts"]) == (r["text"] or "") and all(len(p) == 7 for p in r["parts"][:-1])
    import __spark_entry__ as entry

    rows = entry.queries()["op6_block_tokens"](spark, data)
    sums = rows.groupBy("doc_id").agg(
        F.sum("tokens").alias("sum"), F.max("doc_tokens").alias("all"), F.sum("n_crossing").alias("crossing")
    ).collect()
    assert all(abs(r["sum"] - r["all"]) < 1e-6 for r in sums) and sum(r["crossing"] for r in sums) > 0
