"""SimHash near-duplicates: fingerprints, and a join on counts of set bits.

Every fingerprint is mapped to a vector of the number of set bits in each 2-bit segment. One changed
bit changes one entry by one, so the Manhattan distance of two vectors is at most the number of bits
in which the fingerprints differ. The vector is cut into ``max_bits // 2 + 1`` parts. If the whole
distance is at most ``max_bits``, some part has a distance of 0 or 1, so it is enough to meet in a grid
whose cells are the values of one part: every fingerprint stands in its own cell of each part and
calls at the neighbour cells that are one higher in one segment. What meets there is verified on all
64 bits.

Equal fingerprints are one row from the start, so a group of copies costs nothing. A cell with many
different fingerprints is cut into blocks, and pairs of blocks are tasks of their own. Of the verified
links of a batch only a star per connected set goes on, not all pairs; components of the stars are
components of the links.

Defined results: a null or empty text has no words and fingerprint zero, linked like any other. A
repeated row has the group of its copies. A null doc_id takes part in links, but names no component
unless its whole component has no id. Other columns, whatever their names, are carried or ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.llm.components import components
from treeledger.sources.store import stored

SEED = 42
# Fingerprints of one grid cell that a block holds.
BLOCK_ROWS = 2048


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """64 bits, as a signed long: a bit is set if over half of the shingles' hashes have it."""

    def run(texts):
        import numpy as np
        import pandas as pd
        from xxhash import xxh64_intdigest as digest

        def one(text):
            found = (text or "").encode("utf-8", "replace").lower().split()
            if not found:
                return 0
            line = b" ".join(found)
            ends = np.cumsum([len(w) + 1 for w in found]) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            width = min(shingle, len(found))
            spans = zip(starts[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist())
            hashes = np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)
            counts = np.zeros(64, np.int64)
            for at in range(0, len(hashes), 65_536):  # a long text is counted piece by piece
                bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts += bits.sum(axis=0, dtype=np.int64)
            out = np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0]
            return int(out.astype(np.int64))

        return pd.Series([one(t) for t in texts], dtype="int64")

    return F.pandas_udf(run, "bigint")(text.cast("string"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


_CELL = "part int, cell bigint, fp bigint, home boolean"


def _grid(parts: int):
    """Rows of a fingerprint: its own cell in each part, and the cells one higher in one segment."""

    def run(batches):
        import numpy as np
        import pandas as pd

        low = np.uint64(0x5555555555555555)
        bounds = [32 * p // parts for p in range(parts + 1)]
        for batch in batches:
            fp = batch["fp"].to_numpy(np.int64)
            bits = fp.view(np.uint64)
            high, bottom = (bits >> np.uint64(1)) & low, bits & low
            counts = ((high & bottom) << np.uint64(1)) | (high ^ bottom)  # 0 to 2 in each 2 bits
            out = []
            for part in range(parts):
                first, last = bounds[part], bounds[part + 1]
                mask = np.uint64(((1 << 2 * last) - 1) ^ ((1 << 2 * first) - 1))
                cell = counts & mask
                out.append((part, cell, fp, True))
                for segment in range(first, last):
                    at = np.uint64(2 * segment)
                    room = ((cell >> at) & np.uint64(3)) < 2
                    out.append((part, cell[room] + (np.uint64(1) << at), fp[room], False))
            yield pd.DataFrame({
                "part": np.concatenate([np.full(len(c), p, np.int32) for p, c, _, _ in out]),
                "cell": np.concatenate([c.view(np.int64) for _, c, _, _ in out]),
                "fp": np.concatenate([f for _, _, f, _ in out]),
                "home": np.concatenate([np.full(len(c), h) for _, c, _, h in out]),
            })

    return run


def _verify(max_bits: int):
    """Links inside the groups of a partition that is sorted by group, own cells first, as stars."""

    def run(batches):
        import numpy as np
        import pandas as pd

        limit = 2_000_000  # pairs that are held at once

        def stars(a, b):
            """Every node with the smallest index of its connected set."""
            nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
            a, b, label = where[: len(a)], where[len(a) :], np.arange(len(nodes))
            while True:
                before = label.copy()
                least = np.minimum(label[a], label[b])
                np.minimum.at(label, a, least)
                np.minimum.at(label, b, least)
                label = label[label]
                if np.array_equal(before, label):
                    break
            other = label != np.arange(len(nodes))
            return nodes[other], nodes[label[other]]

        def links(fp, first, count):
            """Row i is set against ``count[i]`` rows from ``first[i]``."""
            ends, at = np.cumsum(count), 0
            while at < len(count):
                base = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
                n = count[at:to]
                right = np.repeat(np.arange(at, to), n)
                left = np.repeat(first[at:to] - (ends[at:to] - n - base), n) + np.arange(n.sum())
                near = np.bitwise_count(fp[left] ^ fp[right]) <= max_bits
                left, right = left[near], right[near]
                apart = fp[left] != fp[right]
                if apart.any():
                    yield stars(fp[left[apart]].view(np.int64), fp[right[apart]].view(np.int64))
                at = to

        def work(frame):
            fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
            home = frame["home"].to_numpy(bool)
            group = frame["group"].to_numpy()
            new = np.concatenate(([True], group[1:] != group[:-1]))
            start = np.flatnonzero(new)
            own = np.add.reduceat(home.astype(np.int64), start)
            which = np.cumsum(new) - 1
            first = start[which]
            count = np.minimum(np.arange(len(fp)) - first, own[which])
            for a, b in links(fp, first, count):
                yield pd.DataFrame({"a": a, "b": b})

        held = None
        for batch in batches:
            if not len(batch):
                continue
            # As integers throughout: a cell does not fit a double.
            key = np.stack([batch[c].to_numpy(np.int64) for c in ("part", "cell", "p", "q")], axis=1)
            new = np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))
            batch = batch.assign(group=np.cumsum(new))
            if held is not None:
                same = all(int(held[c].iloc[-1]) == int(v) for c, v in zip(("part", "cell", "p", "q"), key[0]))
                batch["group"] += held["group"].iloc[-1] - (1 if same else 0)
                batch = pd.concat([held, batch], ignore_index=True)
            last = int(np.searchsorted(batch["group"].to_numpy(), batch["group"].iloc[-1]))
            if last:
                yield from work(batch.iloc[:last].reset_index(drop=True))
            held = batch.iloc[last:].reset_index(drop=True)
        if held is not None and len(held):
            yield from work(held)

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges ``(a, b)`` between the different fingerprints in ``fps`` (column ``fp``, without repeats)
    that connect whatever differs in at most ``max_bits`` bits."""
    parts = max_bits // 2 + 1
    cells = fps.select("fp").mapInPandas(_grid(parts), _CELL)
    hot = (
        cells.groupBy("part", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows)
        .select("part", "cell", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    )
    blocks = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pair = F.explode(F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda k: F.struct(F.least(mine, k).alias("p"), F.greatest(mine, k).alias("q")),
    ))
    key = ["part", "cell", "p", "q"]
    spread = (
        cells.join(hot, ["part", "cell"], "left").withColumn("_pair", pair)
        .select("part", "cell", "_pair.p", "_pair.q", "fp", "home")
    )
    return (
        spread.repartition(*key).sortWithinPartitions(*key, F.desc("home"), "fp")
        .mapInPandas(_verify(max_bits), "a bigint, b bigint")
    )


def component_of_fingerprint(rows: DataFrame, key: str, max_bits: int = 3) -> DataFrame:
    """``(fp, least)``: for each fingerprint in ``rows`` the smallest ``key`` of all rows that can be
    reached from it."""
    fps = stored(rows.groupBy("fp").agg(F.min(key).alias("least")), "fingerprints")
    groups = components(fingerprint_links(fps, max_bits))
    joined = stored(fps.join(groups, fps["fp"] == groups["node"], "left").select(
        fps["fp"], "least", F.coalesce("component", "fp").alias("component")
    ), "members")
    least = stored(joined.groupBy("component").agg(F.min("least").alias("least")), "least")
    return joined.select("fp", "component").join(least, "component").select("fp", "least")


def simhash_groups(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, fp, component_id)`` for every row of ``docs``."""
    rows = stored(docs.select(key, fingerprint(F.col(text), shingle).alias("fp")), "simhash")
    found = component_of_fingerprint(rows, key, max_bits)
    return rows.join(found, "fp").select(key, "fp", F.col("least").alias("component_id"))


def keep_one(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id, and of its copies the first
    stored. The rows are stored with their fingerprint first, so that texts are hashed once."""
    columns = docs.columns
    marked = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
            F.col(key).cast("bigint").alias("key"), F.monotonically_increasing_id().alias("n"),
            fingerprint(F.col(text), shingle).alias("fp"),
        ),
        "marked",
    )
    # Ids first, rows without one last.
    order = F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key"), F.col("n").alias("n"))
    narrow = marked.select("fp", order.alias("at"))
    kept = component_of_fingerprint(narrow, "at", max_bits).select(F.col("least.n").alias("n")).distinct()
    return marked.join(kept, "n", "left_semi").select("row.*")
