"""Resampling, alignment and the neighbour graph against brute force."""

import hashlib
import math
import os
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from treeledger.llm import alignment, descent, hyperdim, pulearn, radix, resampling, voronoi

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("bits, part_rows, wide", [(20, 1 << 20, 63), (3, 7, 5)])
def test_radix_rank(spark, bits, part_rows, wide):
    draw = random.Random(5)
    rows = [(draw.choice([0, 3, 7]), draw.randrange(-(1 << wide) if wide > 5 else 0, 1 << wide), i) for i in range(500)]
    rows += [(0, 5, 500 + i) for i in range(200)]  # a hot key
    frame = spark.createDataFrame(rows, "a bigint, b bigint, part bigint").repartition(5).cache()
    found = sorted(radix.radix_rank(frame, ["a", "b"], "rank", bits, part_rows).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in found] == list(range(700))
    assert [(r["a"], r["b"]) for r in found] == sorted((a, b) for a, b, _ in rows)
    assert {r["part"] for r in found} == set(range(700))
    assert radix.radix_rank(frame.where("false"), ["a", "b"], "rank").count() == 0
    same = radix.radix_rank(frame.where("a = 0 and b = 5"), ["a", "b"], "rank", bits, part_rows)
    assert sorted(r["rank"] for r in same.collect()) == list(range(same.count()))
    assert radix.digits_of(4, 4) == [] and radix.digits_of(-1, 0)[-1] == (55, 9)
    assert sum(w for _, w in radix.digits_of(0, 1 << 30)) == 31


def brute_resample(docs, targets, percent, runs):
    def features(text):
        low = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
        words, now = [], b""
        for c in [*low, 0]:
            if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128:
                now += bytes([c])
            elif now:
                words.append(now)
                now = b""
        return len(words), [
            zlib.crc32(b" ".join(words[i : i + n])) % 10000 for n in range(1, runs + 1) for i in range(len(words) - n + 1)
        ]

    held = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in held for b in f), Counter(b for x in targets for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
    out = []
    for i, n, f in held:
        weight = sum(map(gain, f)) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, n])
    able = sorted((r for r in out if r[0] is not None and r[5] >= 20), key=lambda r: (-r[3], r[0]))
    for place, row in enumerate(able[: percent * len(able) // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("runs", [1, 2])
def test_resampling(spark, documents, empty, runs):
    more = [(100 + i, f"Wort{i % 7} of WORD {i} ünd " * (1 + i % 9)) for i in range(60)]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    docs = docs.withColumn("key", F.lit("x")).withColumn("score", F.lit(1)).withColumn("rank", F.lit(1))
    aims = ["word3 of word word word5", None, "", "Word of the cat"]
    targets = spark.createDataFrame([(t, 1) for t in aims], "text string, buckets int")
    found = resampling.resample(docs, targets, percent=30, runs=runs)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, found.collect()), key=str) == brute_resample(given, aims, 30, runs)
    assert resampling.resample(documents, targets.where("false"), runs=runs).count() == documents.count()
    assert resampling.resample(empty, targets).count() == 0


HOSTILE = [
    "a  b\n c", "ﬁ é  x", " lead trail ", "<|endoftext|> it's 12,345", "▁x", "漢字\U0001f600", "x" * 3000, "\t\r\n", "\x00",
    "<0x41> <unk> </s>", "​‍️", "é", "한",
]


def brute_alignment(texts):
    import public_tokenizers as P

    a_coder = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    rows, pairs = [], Counter()
    for text in texts:
        if not text:
            rows.append(([], [], []))
            continue
        a, b = a_coder.encode(" " + text, add_special_tokens=False).ids, b_coder.encode(text)
        bytes_a = [bytes(letters[c] for c in a_coder.id_to_token(i)) for i in a]
        bytes_b = []
        for i in b:
            piece = b_coder.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if b_coder.is_byte(i) else piece.replace("▁", " ").encode())
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            rows.append(([], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        place_a, place_b = ({e: n + 1 for n, e in enumerate(ends)} for ends in (ends_a, ends_b))
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = place_a[end], place_b[end]
            groups.append((a[i:x], b[j:y]))
            i, j = x, y
        rows.append((a, b, groups))
        pairs.update((g[0][-1], g[1][-1]) for g in groups)
    most = Counter()
    for (_, y), n in pairs.items():
        most[y] = max(most[y], n)
    out = []
    for a, b, groups in rows:
        counts = [(pairs[g[0][-1], g[1][-1]], most[g[1][-1]]) for g in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(groups), sum(n == m for n, m in counts), sum(n for n, _ in counts), text))
    return out


@pytest.mark.parametrize("block_tokens", [2_000_000, 40])
def test_alignment(spark, documents, empty, block_tokens):
    odd = spark.createDataFrame([(1000 + i, t, 1) for i, t in enumerate(HOSTILE)], "doc_id bigint, text string, block int")
    docs = documents.select("doc_id", "text", F.lit(1).alias("block")).unionByName(odd).repartition(7).cache()
    rows = alignment.with_counts(alignment.align(docs, block_tokens=block_tokens)).collect()
    given = docs.collect()
    wanted = brute_alignment([r["text"] for r in given])
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted(((r["doc_id"], *[r[c] for c in columns]) for r in rows), key=str) == sorted(
        ((r["doc_id"], *w) for r, w in zip(given, wanted)), key=str
    )
    assert sum(r["n_groups"] > 0 for r in rows) > 12  # most of the hostile texts have tokens
    assert alignment.with_counts(alignment.align(empty)).count() == 0


def test_alignment_query(spark, data):
    rows = {r["doc_id"]: r for r in entry.queries()["op12_alignment"](spark, data).collect()}
    given = spark.read.parquet(f"{data}/documents.parquet").collect()
    for r, (a, b, groups, links, best, total, text) in zip(given, brute_alignment([r["text"] for r in given])):
        assert tuple(rows[r["doc_id"]]) == (
            r["doc_id"], a, b, groups, links, best, total, hashlib.sha256(text.encode()).hexdigest() if text else ""
        )


def test_gallop():
    draw, gallop = random.Random(3), alignment._galloper()()
    for _ in range(200):
        long = np.array(sorted(draw.sample(range(1000), draw.randint(1, 200))))
        short = np.array(sorted(draw.sample(range(int(long[-1]) + 1), draw.randint(1, int(long[-1]) + 1) % 50 + 1 if long[-1] > 60 else 1)))
        guess = np.array([draw.randrange(len(long)) for _ in short])
        assert (gallop(short, long, guess) == np.searchsorted(long, short)).all()


def brute_nearest(rows, k, is_query):
    clean = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            clean[i] = min(clean.get(i, v), v)
    out = {}
    for i, q in clean.items():
        if is_query(i):
            scores = []
            for j, v in clean.items():
                if j != i:
                    dot = sum(a * b for a, b in zip(q, v))
                    scores.append((-dot / math.sqrt(sum(a * a for a in q)) / math.sqrt(sum(a * a for a in v)), j))
            out[i] = sorted(scores)[:k]
    return out


def test_nearest(spark):
    draw = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in draw.normal(0, 1, 6)]) for i in range(600)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # a vector that a third of the rows have
    rows += [(2000, None), (2050, [0.0] * 6), (2001, [1.0, None]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6)]
    rows += [(None, [1.0] * 6), rows[0], (50, [-9.0] * 6), (2100, [1.0, 2.0]), (2004, []), (2150, [1e200] * 6)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, node int, unit string")
    frame = frame.repartition(6).cache()
    found = {}
    for r in sorted(descent.nearest(frame, F.col("id") % 50 == 0, 5).collect()):
        found.setdefault(r["query_id"], []).append(r)
    wanted = brute_nearest(rows[:-1] + [(2150, [1.0] * 6)], 5, lambda i: i % 50 == 0)
    assert set(found) == set(wanted)
    hits = total = 0
    for i, best in wanted.items():
        assert [r["rank"] for r in found[i]] == list(range(1, len(found[i]) + 1)) and len(found[i]) == 5
        hits += len({r["vec_id"] for r in found[i]} & {j for _, j in best})
        total += len(best)
        if i not in (2150,) and all(r["vec_id"] != 2150 for r in found[i]):
            for r, (score, j) in zip(found[i], best):
                assert r["vec_id"] != j or abs(r["score"] + score) < 1e-12
    assert hits / total > 0.97
    # Of the copies the smallest ids are found, whoever asks.
    assert [r["vec_id"] for r in found[1050]] == [7, 1000, 1001, 1002, 1003]
    assert [r["vec_id"] for r in found[1000]] == [7, 1001, 1002, 1003, 1004]
    assert descent.nearest(frame.where("false"), F.col("id") % 50 == 0).count() == 0
    few = descent.nearest(frame.where("vec_id in (0, 1, 2)"), F.col("id") == 0, 5)
    assert [r["rank"] for r in few.orderBy("rank").collect()] == [1, 2]


def test_nearest_query(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    wanted = brute_nearest(rows, 5, lambda i: i % 50 == 0)
    found = {}
    for r in entry.queries()["op13_descent"](spark, SMALL).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(found) == set(wanted)
    assert np.mean([len(found[i] & {j for _, j in wanted[i]}) / 5 for i in wanted]) > 0.95


def test_tasks_without_rows(spark):
    """More tasks than rows: no operator hands on a frame without a type."""
    docs = spark.createDataFrame([(i, f"die katze {i} und der hund", "de") for i in range(3)], "doc_id bigint, text string, lang string")
    names, table = hyperdim.train(docs.repartition(12))
    assert names == ["de"] and hyperdim.identify(docs.repartition(12), names, table).count() == 3
    rows = spark.createDataFrame([(100 * i, [float(i), 1.0]) for i in range(3)], "vec_id bigint, embedding array<double>")
    assert voronoi.top_k(rows.repartition(12), F.col("id") == 100).count() == 2
    assert descent.nearest(rows.repartition(12), F.col("id") == 100, 5).count() == 2


def test_tasks_need_no_package():
    """What runs in tasks is pickled by value: a Python that cannot import the package runs it."""
    from pyspark.cloudpickle import dumps

    code = "import sys, pickle; pickle.loads(sys.stdin.buffer.read())(); assert 'treeledger' not in sys.modules"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for made in (voronoi._matrix_code(), descent._matrix(), alignment._galloper(), hyperdim._bundler(8), pulearn._featurizer()):
        done = subprocess.run([sys.executable, "-c", code], input=dumps(made), cwd="/", env=env, capture_output=True)
        assert done.returncode == 0, done.stderr.decode()


def test_many_different_letters():
    """Trigrams in slices add up to what all of them at once do."""
    text = "".join(chr(0x4E00 + i * 7 % 20_000) for i in range(30_000))
    trigrams, vectors = hyperdim._bundler(64)()
    found = trigrams(text)
    codes, counts = found
    draw = lambda code: np.random.Generator(np.random.Philox(key=int(code))).integers(0, 2, 64, dtype=np.int8) * 2 - 1
    want = np.zeros(64)
    for code, n in zip(codes, counts):
        want += n * np.roll(draw(code >> 42), 2) * np.roll(draw((code >> 21) & 0x1FFFFF), 1) * draw(code & 0x1FFFFF)
    assert len(codes) > 2 * hyperdim.SLICE and (vectors([None, found])[1] == want).all()


def test_whole_words_and_text_ids(spark):
    features = pulearn._featurizer()()
    a, b = "a" * 60 + "-1-x-" * 10 + "b" * 60, "a" * 60 + "-X-2-" * 10 + "b" * 60
    assert (features(a) != features(b)).any()
    docs = spark.createDataFrame([(f"d{i}", "Good text. " * 5 if i % 2 else "bad bad " * 9) for i in range(40)], "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{i}", i % 2) for i in range(40)], "doc_id string, quality int")
    model = pulearn.train(docs, labels)
    rows = docs.select("doc_id", pulearn.score(model, F.col("text")).alias("s")).collect()
    assert min(r["s"] for r in rows if int(r["doc_id"][1:]) % 2) > max(r["s"] for r in rows if not int(r["doc_id"][1:]) % 2)
