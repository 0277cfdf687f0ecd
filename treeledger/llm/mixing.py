"""Mixing sources to target weights by sampling blocks of words.

The words of each source, in the order of its documents, are cut into blocks of ``block_words`` at
most (equal but for one word). The mix is a list of output shards, each of so many slots. For a shard
the number of slots of each source is drawn multinomially by the target shares. A task draws the shards
of its part of all slots; a source whose part is used up gives no more (its later draws go to the others), and
the last shard settles what is left, so that the sums are exact. The slots of a source are counted through, and slot ``j`` holds
block ``permutation(j mod blocks)``: a keyed pseudorandom permutation of the block numbers, another
for each pass. So nothing is stored to know what a slot holds, any shard can be made alone, and a
block is used once before any is used twice. The last slot of a source is cut so that its words
meet the target. Blocks and slots meet in a join on the block number.

Positions of documents in their source come from sums over buckets of documents and sums over
buckets, so a source with a third of all rows is no single task. There is one weight per source:
the table of sources comes to the driver, which refuses more than MAX_SOURCES of them.

Defined results: a null or empty text has size 0 and is never taken. A null source is a source, the
last. Sources without words get no share. Repeated rows are documents of their own. No rows give no
rows. Reruns agree: draws and permutations depend on the seed, order on ids and texts. Other columns
are carried by ``mix_documents`` and ignored else.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from treeledger.llm.text import WORD, text_of
from treeledger.sources.store import stored

BLOCK_WORDS = 256
BUCKET_WORDS = 100_000
SHELF_BUCKETS = 4096
SHARD_SLOTS = 1024
SHARDS_PER_TASK = 64
MAX_SOURCES = 100_000
WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def targets(sizes: list[int], weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words for each source: ``share`` times all words by weight, none above ``most`` times its own;
    the excess goes to the others by weight until none is above."""
    cap = [most * s for s in sizes]
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out, open_, left = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s}, share * sum(sizes)
    while open_:
        unit = left / sum(weight[i] for i in open_)
        over = {i for i in open_ if unit * weight[i] > cap[i]}
        for i in over or open_:
            out[i] = cap[i] if over else unit * weight[i]
        left -= sum(cap[i] for i in over)
        open_ = open_ - over if over else set()
    return out


def _source_table(sized: DataFrame, weights, share, most, block_words) -> list[dict]:
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in rows]
    out = []
    for i, (row, target) in enumerate(zip(rows, targets(sizes, weights, share, most))):
        size = row["size"]
        blocks = -(-size // block_words)
        passes, rest = (int(target // size), target - size * int(target // size)) if size else (0, 0.0)
        # Slots of the last pass: whole blocks of the mean length, and one that is cut.
        whole = int(rest * blocks // size) if size else 0
        cut = round(rest - whole * size / blocks) if size else 0
        out.append({
            "source": row["source"], "src": i, "source_size": size, "target": float(target), "blocks": blocks,
            "slots": passes * blocks + whole + (cut > 0), "cut": cut,
            "buckets": max(1, -(-size // BUCKET_WORDS)),
            "base": size // blocks if blocks else 0, "extra": size % blocks if blocks else 0,
        })
    return out


_SOURCES = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("src", T.IntegerType()),
    T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
    T.StructField("blocks", T.LongType()), T.StructField("slots", T.LongType()),
    T.StructField("cut", T.LongType()), T.StructField("buckets", T.LongType()),
    T.StructField("base", T.LongType()), T.StructField("extra", T.LongType()),
])


def _slots(spark, sources: list[dict], seed: int) -> DataFrame:
    """``(shard, slot, src, block, pass, words)``: what each slot of the mix holds; ``words`` is null
    but for a cut slot."""
    counts = [s["slots"] for s in sources]
    blocks, cuts = [s["blocks"] for s in sources], [s["cut"] for s in sources]
    tasks = max(1, math.ceil(sum(counts) / (SHARD_SLOTS * SHARDS_PER_TASK)))
    # A shard has a slot at least, so no task makes more shards than it has slots.
    shard_slots, shard_bits = SHARD_SLOTS, (SHARD_SLOTS * SHARDS_PER_TASK + len(counts)).bit_length()

    def run(batches):
        import numpy as np
        import pandas as pd

        def scramble(x, key):
            x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            return x ^ (x >> np.uint64(32))

        def permuted(j, n, key):
            """A keyed permutation of 0 .. n - 1: four rounds over two halves of the number's bits,
            again while the outcome is not below n."""
            half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
            low = np.uint64((1 << int(half)) - 1)

            def once(x):
                a, b = x >> half, x & low
                for r in range(4):
                    a, b = b, a ^ (scramble(b, key + np.uint64(r)) & low)
                return (a << half) | b

            x = once(j.astype(np.uint64))
            while (far := x >= n).any():
                x[far] = once(x[far])
            return x.astype(np.int64)

        for batch in batches:
            for k in batch["id"].tolist():
                # This task's part of every source's slots, and the shards drawn from it.
                at = np.array([k * c // tasks for c in counts], np.int64)
                left = np.array([(k + 1) * c // tasks for c in counts], np.int64) - at
                share = left.astype(np.float64)
                draw = np.random.default_rng([seed, k])
                shard = 0
                while left.sum():
                    if left.sum() > shard_slots:
                        open_ = np.where(left > 0, share, 0.0)
                        # A shard is shorter where a source has less left than was drawn.
                        taken = np.minimum(draw.multinomial(shard_slots, open_ / open_.sum()), left)
                    else:
                        taken = left.copy()
                    size = int(taken.sum())
                    src = np.repeat(np.arange(len(taken)), taken)
                    j = np.concatenate([np.arange(at[s], at[s] + taken[s]) for s in np.flatnonzero(taken)])
                    order = draw.permutation(size)
                    src, j = src[order], j[order]
                    block, turn = np.empty(size, np.int64), np.empty(size, np.int64)
                    for s in np.flatnonzero(taken).tolist():
                        mine = src == s
                        for p in np.unique(j[mine] // blocks[s]).tolist():
                            some = mine & (j // blocks[s] == p)
                            key = np.uint64((seed * 1_000_003 + s * 8_191 + p * 131) & 0xFFFFFFFFFFFF)
                            block[some] = permuted(j[some] - p * blocks[s], blocks[s], key)
                            turn[some] = p
                    cut = [
                        cuts[s] if cuts[s] > 0 and q == counts[s] - 1 else None
                        for s, q in zip(src.tolist(), j.tolist())
                    ]
                    yield pd.DataFrame({
                        "shard": (k << shard_bits) + shard, "slot": np.arange(size), "src": src.astype(np.int32),
                        "block": block, "pass": turn.astype(np.int32), "words": pd.array(cut, "Int64"),
                    })
                    at, left, shard = at + taken, left - taken, shard + 1

    schema = "shard bigint, slot bigint, src int, block bigint, pass int, words bigint"
    return spark.range(0, tasks, 1, tasks).mapInPandas(run, schema)


def _pieces(sized: DataFrame, table: DataFrame) -> DataFrame:
    """``(row, .., block, in_block, in_doc, length)``: every document as pieces of its source's
    blocks; one piece without a block for a document without words."""
    rows = sized.join(F.broadcast(table), sized["source"].eqNullSafe(table["source"])).drop(table["source"])
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "digest"), F.col("buckets")))
    # Running sums over buckets in two levels: a large source has too many buckets for one task.
    totals = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words")).withColumn(
        "shelf", F.expr(f"bucket div {SHELF_BUCKETS}")
    )
    earlier = Window.unboundedPreceding, -1
    shelves = Window.partitionBy("src").orderBy("shelf").rowsBetween(*earlier)
    shelf_starts = totals.groupBy("src", "shelf").agg(F.sum("words").alias("words")).select(
        "src", "shelf", F.coalesce(F.sum("words").over(shelves), F.lit(0)).alias("shelf_first")
    )
    before = Window.partitionBy("src", "shelf").orderBy("bucket").rowsBetween(*earlier)
    starts = (
        totals.withColumn("in_shelf", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .join(shelf_starts, ["src", "shelf"])
        .select("src", "bucket", (F.col("shelf_first") + F.col("in_shelf")).alias("first"))
    )
    inside = (
        Window.partitionBy("src", "bucket").orderBy("key", "digest", "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("at", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(starts, ["src", "bucket"]).withColumn("at", F.col("at") + F.col("first"))
    # The first `extra` blocks have base + 1 words, the others base.
    border = "extra * (base + 1)"

    def block_of(at):
        return F.expr(
            f"case when {at} < {border} then {at} div (base + 1) else extra + ({at} - {border}) div greatest(base, 1) end"
        )

    span = F.when(
        F.col("size") > 0, F.sequence(block_of("at"), block_of("(at + size - 1)"))
    ).otherwise(F.array(F.lit(-1).cast("bigint")))
    rows = rows.withColumn("block", F.explode(span))
    first = F.expr(f"case when block < extra then block * (base + 1) else {border} + (block - extra) * base end")
    rows = rows.withColumn("_from", first).withColumn(
        "_to", first + F.expr("case when block < extra then base + 1 else base end")
    )
    begin = F.greatest("at", "_from")
    length = F.when(F.col("block") < 0, 0).otherwise(F.least(F.col("at") + F.col("size"), F.col("_to")) - begin)
    return rows.select(
        "row", "key", "size", "src", "source_size", "target", "block", length.cast("bigint").alias("length"),
        (begin - F.col("_from")).alias("in_block"), (begin - F.col("at")).alias("in_doc"),
    )


def taken_pieces(
    sized: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0,
    block_words: int = BLOCK_WORDS, seed: int = 7,
) -> DataFrame:
    """All pieces of all documents ``(row, key, source, size, digest)`` with the slots that hold them:
    ``(row, key, size, source_size, target, shard, slot, pass, in_doc, words)``. A piece that no slot
    holds has nulls for the slot and 0 words."""
    spark = sized.sparkSession
    sources = _source_table(sized, weights, share, most, block_words)
    table = spark.createDataFrame([tuple(s[f.name] for f in _SOURCES) for s in sources], _SOURCES)
    # Stored, so that its size is known where the join is planned: it grows with the words.
    pieces, slots = _pieces(sized, table), stored(_slots(spark, sources, seed), "slots")
    joined = pieces.join(slots, ["src", "block"], "left")
    room = F.greatest(F.col("words") - F.col("in_block"), F.lit(0))
    taken = (
        F.when(F.col("shard").isNull(), 0)
        .when(F.col("words").isNull(), F.col("length")).otherwise(F.least("length", room))
    )
    return joined.select(
        "row", "key", "size", "source_size", "target", "shard", "slot", "pass", "in_doc",
        taken.cast("bigint").alias("words"),
    )


def _sized(rows: DataFrame, key: str, text: str, source: str) -> DataFrame:
    return rows.select(
        "row", F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
        word_count(text_of(text)).alias("size"), F.xxhash64(text_of(text)).alias("digest"),
    )


def mix_counts(docs: DataFrame, key="doc_id", text="text", source="source", **plan) -> DataFrame:
    """``(key, size, source_size, target, taken)`` for every document."""
    rows = docs.select(key, text, source, F.monotonically_increasing_id().alias("row"))
    sized = stored(_sized(rows, key, text, source), "sized")
    return (
        taken_pieces(sized, **plan).groupBy("row", "key", "size", "source_size", "target")
        .agg(F.sum("words").alias("taken"))
        .select(F.col("key").alias(key), "size", "source_size", "target", "taken")
    )


def _cut(text: Column, spans: Column) -> Column:
    """The words of the spans ``(first word, words)``, in order; a whole text stays as it is."""

    import pandas as pd

    def run(texts: pd.Series, spans: pd.Series) -> pd.Series:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")

        def one(text, spans):
            merged = []
            for first, n in sorted((int(s["in_doc"]), int(s["words"])) for s in spans):
                if merged and merged[-1][1] == first:
                    merged[-1][1] += n
                else:
                    merged.append([first, first + n])
            places = [m.span() for m in word.finditer(text)]
            if merged == [[0, len(places)]]:
                return text
            return "\n".join(text[places[a][0] : places[b - 1][1]] for a, b in merged)

        return pd.Series([one(t, s) for t, s in zip(texts, spans)], dtype=object)

    return F.pandas_udf(run, "string")(text, spans)


def mix_documents(docs: DataFrame, key="doc_id", text="text", source="source", chars="n_chars", **plan) -> DataFrame:
    """``docs`` mixed: a document comes once for each pass that takes words of it, with just these words
    in ``text`` and their length in ``chars``, if there is such a column."""
    columns = docs.columns
    marked = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "marked",
    )
    sized = stored(
        _sized(marked.select("row", f"doc.`{key}`", f"doc.`{text}`", f"doc.`{source}`"), key, text, source), "sized"
    )
    spans = (
        taken_pieces(sized, **plan).where("words > 0").groupBy("row", "pass")
        .agg(F.collect_list(F.struct("in_doc", "words")).alias("spans"))
    )
    mixed = marked.join(spans, "row").withColumn("_text", _cut(F.col(f"doc.`{text}`").cast("string"), F.col("spans")))
    out = {text: F.col("_text"), chars: F.length("_text").cast(dict(docs.dtypes).get(chars, "bigint"))}
    return mixed.select(*[out.get(c, F.col(f"doc.`{c}`")).alias(c) for c in columns])
