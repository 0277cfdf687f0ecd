"""Alignment of two tokenizers' tokens by the bytes that they cover.

Every text is encoded twice: with a space before it by a byte-level BPE (A), and by a piece model (B)
that puts the space itself. Each token covers a range of the same bytes, so the ends of the tokens are
two ascending lists. Where both have an end, the text is cut into groups of tokens that cover the same
bytes. Common ends are found by galloping: every end of a document's shorter list starts at its
proportional place in the longer one, doubles its step until the end lies between two places, and
bisects between them. The indices found cut both lists into slices, and the differences of their ranks
are the tokens that overlap. The two tokens that close a group are linked.

How often a pair of ids is linked is counted over the corpus. Documents are taken in blocks of a bounded
number of links, and a block lists its different pairs once. Blocks' pairs are summed to corpus counts,
counts are joined back to the blocks' pairs, and each block's documents meet its counts in one group,
so that what moves is a row per block and pair, not one per document and link, and no group is larger
than a block. No pair is frequent enough to be a hot key: a block has it once.

Defined results: null and empty texts, and those whose tokens do not spell the space and the text, byte
by byte, have no tokens, zeros and an empty list of groups. Special tokens' strings are plain text.
Repeated rows are aligned, and counted, each for itself. Null keys are carried, no rows give no rows.
Other columns are not looked at, whatever their names. A text and its tokens have to fit a task.
"""

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from treeledger.sources.store import stored

# Tokens of A that a block holds, and one document more.
BLOCK_TOKENS = 1_000_000


def byte_tokens(path: str | None = None) -> dict[bytes, int]:
    """Ids of a byte-level BPE file by the bytes they stand for. Its letters for bytes are those of the
    public byte-level scheme: printable Latin-1 as it is, the other bytes from U+0100 on in order."""
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as source:
        file = json.load(source)
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in file["added_tokens"]}
    return {bytes(letter[c] for c in text): n for text, n in file["model"]["vocab"].items() if text not in special}


def byte_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def piece_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _galloper():
    """``gallop(short, long, guess)``: for each of ``short`` the first index of ``long`` whose value is
    not below it. Both ascend, and the last of ``long`` is not below any of ``short``."""

    def made():
        import numpy as np

        def gallop(short, long, guess):
            low, high = guess.copy(), guess.copy()  # low: below the value, or -1; high: not below it
            right = long[guess] < short
            step, on = 1, np.flatnonzero(right)
            while len(on):
                high[on] = np.minimum(low[on] + step, len(long) - 1)
                on = on[long[high[on]] < short[on]]
                low[on] = high[on]
                step *= 2
            step, on = 1, np.flatnonzero(~right)
            while len(on):
                low[on] = np.maximum(high[on] - step, -1)
                on = on[(low[on] >= 0) & (long[low[on]] >= short[on])]
                high[on] = low[on]
                step *= 2
            on = np.flatnonzero(high - low > 1)
            while len(on):
                middle = (low[on] + high[on]) // 2
                below = long[middle] < short[on]
                low[on[below]] = middle[below]
                high[on[~below]] = middle[~below]
                on = on[high[on] - low[on] > 1]
            return high

        return gallop

    return made


def align(
    docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: dict[bytes, int] | None = None,
    pattern: str | None = None, pieces: str | None = None, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """``(key, n_a, n_b, n_groups, n_links, groups, block, links, pairs, times)`` for every row.

    ``groups`` is text: groups parted by ``;``, in each the ids of A, ``|`` and the ids of B, parted by
    ``,``. ``links`` are the document's links as numbers into its block's ``pairs``, coded for
    ``with_counts``; ``pairs`` (id of A times 2 to the 32nd, plus id of B) and ``times`` stand at the
    first document of a block. The piece model's file must be at the same path on every executor; it and
    the pattern must part texts before a single space, as the given ones do (no piece has a space behind
    another character)."""
    ranks, pattern, pieces = ranks or byte_tokens(), pattern or byte_pattern(), pieces or piece_path()
    kind = dict(docs.dtypes)[key]
    make = _galloper()
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "groups", "block", "links", "pairs", "times"]

    def run(batches):
        import zlib

        import numpy as np
        import pandas as pd
        import sentencepiece
        import tiktoken
        from pyspark import TaskContext

        gallop = make()
        coder = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        other = sentencepiece.SentencePieceProcessor(model_file=pieces)
        spelt_a = dict(zip(ranks.values(), ranks))
        spelt_b = []
        for i in range(other.vocab_size()):
            piece = other.id_to_piece(i)
            spelt_b.append(bytes([int(piece[3:5], 16)]) if other.is_byte(i) else piece.replace("▁", " ").encode())
        size_a = np.zeros(max(spelt_a) + 1, np.int64)
        size_a[list(spelt_a)] = [len(x) for x in spelt_a.values()]
        size_b = np.array([len(x) for x in spelt_b], np.int64)
        top_a, top_b = len(size_a), len(size_b)
        # What is written for an id and what stands behind it.
        written = [f"{i}{sign}" for sign in ",|" for i in range(top_a)]
        written += [f"{i}{sign}" for sign in (",", ";", "") for i in range(top_b)]
        block = TaskContext.get().partitionId() << 32

        def both(texts):
            """Ids of both for each text; None where they do not spell it."""
            for text, b in zip(texts, other.encode(texts, num_threads=1)):
                a, whole = coder.encode_ordinary(" " + text), (" " + text).encode("utf-8", "replace")
                same = b"".join(map(spelt_a.__getitem__, a)) == whole == b"".join(map(spelt_b.__getitem__, b))
                yield (np.array(a, np.int64), np.array(b, np.int64)) if same else None

        class Parts(dict):
            """Numbers of what stands between single spaces, and its ids: those of A and of B one part
            after another, with the place behind each part's last."""

            def __init__(self):
                self.new, self.odd = [], np.zeros(0, bool)
                self.ids = [np.zeros(0, np.int32)] * 2
                self.ends = [np.zeros(1, np.int64)] * 2

            def __missing__(self, part):
                self.new.append(part)
                found = self[part] = len(self)
                return found

            def learn(self):
                """New parts are encoded some at a time, in one text, and cut where each part ends. Odd
                are parts at other white space than one space, and those that are not spelt."""
                odd = np.array([not p or p[0].isspace() or "▁" in p for p in self.new])
                width = np.array([len(p.encode("utf-8", "replace")) + 1 for p in self.new])
                sides = [[(self.ids[s], self.ends[s][1:])] for s in (0, 1)]
                past = [len(self.ids[0]), len(self.ids[1])]
                groups = [range(at, min(at + 400, len(odd))) for at in range(0, len(odd), 400)]
                plain = [[i for i in g if not odd[i]] for g in groups]
                for group, some, pair in zip(groups, plain, both([" ".join([self.new[i] for i in g]) for g in plain])):
                    if pair is None or not some:
                        odd[group.start : group.stop] = True
                    for s, size in ((0, size_a), (1, size_b)):
                        wide = np.zeros(len(group), np.int64)
                        if pair is not None and some:
                            close = np.searchsorted(np.cumsum(size[pair[s]]), np.cumsum(width[some])) + 1
                            wide[np.array(some) - group.start] = np.diff(close, prepend=0)
                            sides[s].append((pair[s].astype(np.int32), past[s] + np.cumsum(wide)))
                        else:
                            sides[s].append((np.zeros(0, np.int32), past[s] + wide))
                        past[s] += int(wide.sum())
                for s in (0, 1):
                    self.ids[s] = np.concatenate([ids for ids, _ in sides[s]])
                    self.ends[s] = np.concatenate([[0], *(ends for _, ends in sides[s])])
                self.odd = np.concatenate([self.odd, odd])
                self.new = []

            def ids_of(self, numbers, side):
                ends = self.ends[side]
                wide = ends[numbers + 1] - ends[numbers]
                skip = np.repeat(ends[numbers] - np.cumsum(wide) + wide, wide)
                return self.ids[side][skip + np.arange(len(skip))].astype(np.int64)

        known = Parts()

        def encode(texts):
            """Ids of both for each text. No token of either goes on behind a space, so what stands
            between single spaces is encoded once, and texts with odd parts are encoded whole."""
            nonlocal known
            if len(known) > 300_000:
                known = Parts()
            none = np.zeros(0, np.int64)
            out, numbers, number = [(none, none)] * len(texts), {}, known.__getitem__
            for i, text in enumerate(texts):
                if text:
                    parts = text.split(" ")
                    numbers[i] = np.fromiter(map(number, parts), np.int64, len(parts))
            if known.new:
                known.learn()
            odd = [i for i, some in numbers.items() if known.odd[some].any()]
            for i, some in numbers.items():
                out[i] = known.ids_of(some, 0), known.ids_of(some, 1)
            for i, pair in zip(odd, both([texts[i] for i in odd])):
                out[i] = pair or (none, none)
            return out

        def spread(counts):
            """Document of every token, and where each document begins."""
            return np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts

        def work(keys, ids):
            n_a, n_b = (np.array([len(x[side]) for x in ids], np.int64) for side in (0, 1))
            a, b = (np.concatenate([np.empty(0, np.int64), *(x[side] for x in ids)]).astype(np.int64) for side in (0, 1))
            # Ends over the whole block: both sides spell the same bytes, document by document.
            end_a, end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
            (doc_a, from_a), (doc_b, from_b) = spread(n_a), spread(n_b)
            by_a = n_a <= n_b
            at_a, at_b = np.flatnonzero(by_a[doc_a]), np.flatnonzero(~by_a[doc_b])

            def common(short, long, at, doc, from_short, from_long, n_short, n_long):
                d = doc[at]
                guess = from_long[d] + (at - from_short[d]) * n_long[d] // np.maximum(n_short[d], 1)
                found = gallop(short[at], long, guess)
                same = long[found] == short[at]
                return at[same], found[same]

            i1, j1 = common(end_a, end_b, at_a, doc_a, from_a, from_b, n_a, n_b)
            j2, i2 = common(end_b, end_a, at_b, doc_b, from_b, from_a, n_b, n_a)
            last_a, last_b = np.sort(np.concatenate([i1, i2])), np.sort(np.concatenate([j1, j2]))
            groups = np.bincount(doc_a[last_a], minlength=len(keys))
            # Ids in the order in which they are written: a group's ids of A, then those of B.
            wide_a, wide_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
            place_a = np.arange(len(a)) + np.repeat(last_b + 1 - wide_b, wide_a)
            place_b = np.arange(len(b)) + np.repeat(last_a + 1, wide_b)
            line = np.empty(len(a) + len(b), np.int64)
            line[place_a] = a
            line[place_a[last_a]] += top_a
            line[place_b] = b + 2 * top_a
            line[place_b[last_b]] += top_b
            line[place_b[(from_b + n_b - 1)[n_b > 0]]] += top_b
            # Links of each document, as numbers of the block's different pairs.
            pairs, which, times = np.unique((a[last_a] << 32) | b[last_b], return_inverse=True, return_counts=True)
            rank = np.empty(len(pairs), np.int64)
            order = np.argsort(-times, kind="stable")  # frequent pairs get small numbers
            rank[order] = np.arange(len(pairs))
            own, often = np.unique((doc_a[last_a] << 32) | rank[which], return_counts=True)
            cuts = np.searchsorted(own, np.arange(len(keys) + 1) << 32)
            own &= 0xFFFFFFFF
            begin = from_a + from_b
            out, held = [], 0
            for d, name in enumerate(keys):
                low, high = cuts[d], cuts[d + 1]
                coded = np.concatenate([np.diff(own[low:high], prepend=0), often[low:high]]).astype("<u4").tobytes()
                many = n_a[d] + n_b[d]
                text = "".join(map(written.__getitem__, line[begin[d] : begin[d] + many].tolist()))
                out.append((
                    name, n_a[d], n_b[d], groups[d], groups[d], text, block, zlib.compress(coded, 1),
                    None if d else pairs[order], None if d else times[order],
                ))
                held += many
                if held > 500_000 or len(out) >= 5_000:
                    yield pd.DataFrame(out, columns=names)
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=names)

        keys, ids, held = [], [], 0
        for batch in batches:
            given, texts = batch["key"].tolist(), batch["text"].tolist()
            for at in range(0, len(texts), 256):
                for name, found in zip(given[at : at + 256], encode(texts[at : at + 256])):
                    keys.append(name)
                    ids.append(found)
                    held += len(found[0])
                if held >= block_tokens:
                    yield from work(keys, ids)
                    keys, ids, held = [], [], 0
                    block += 1
        if keys:
            yield from work(keys, ids)

    # Keys go as text, so that pandas does not turn integers to floats beside a null.
    given = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    found = given.mapInPandas(
        run, "key string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, block bigint, "
        "links binary, pairs array<bigint>, times array<bigint>",
    )
    return found.select(F.col("key").cast(kind).alias(key), *names[1:])


def with_counts(rows: DataFrame) -> DataFrame:
    """Rows of ``align``, with any columns added to them and ``groups`` left out if it is not needed,
    now with ``n_best`` (links whose pair is, corpus-wide, linked as often as any pair with its id of B)
    and ``count_sum`` (their pairs' counts, added up over links)."""
    rows = stored(rows, "aligned")
    listed = rows.where(F.col("pairs").isNotNull()).select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("at", "p"))
    listed = listed.select("block", "at", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = listed.groupBy("pair").agg(F.sum("times").alias("count"))
    # An id of B has at most as many pairs as A has ids.
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    counts = stored(counts.withColumn("best", F.col("count") == F.max("count").over(same_b)), "counts")
    back = listed.select("block", "at", "pair").join(counts, "pair").select(F.col("block").alias("of"), "at", "count", "best")
    kept = [f for f in rows.schema.fields if f.name not in ("block", "links", "pairs", "times")]
    names = [f.name for f in kept]

    def run(docs, found):
        import zlib

        import numpy as np

        size = int(found["at"].max()) + 1 if len(found) else 0
        count, best = np.zeros(size, np.int64), np.zeros(size, bool)
        at = found["at"].to_numpy()
        count[at], best[at] = found["count"].to_numpy(), found["best"].to_numpy(bool)
        n_best, total = [], []
        for raw in docs["links"]:
            coded = np.frombuffer(zlib.decompress(raw), "<u4").astype(np.int64).reshape(2, -1)
            own = np.cumsum(coded[0])
            n_best.append(int(coded[1][best[own]].sum()))
            total.append(int((coded[1] * count[own]).sum()))
        return docs[names].assign(n_best=np.array(n_best, np.int64), count_sum=np.array(total, np.int64))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    # The key goes as text here too.
    key = names[0]
    kind = kept[0].dataType.simpleString()
    schema = schema.replace(f"`{key}` {kind}", f"`{key}` string", 1)
    docs = rows.select(F.col(key).cast("string").alias(key), *names[1:], "block", "links")
    joined = docs.groupBy("block").cogroup(back.groupBy("of")).applyInPandas(
        run, f"{schema}, n_best bigint, count_sum bigint"
    )
    return joined.withColumn(key, F.col(key).cast(kind))
