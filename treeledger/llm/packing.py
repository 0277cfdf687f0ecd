"""Hierarchical multi-length packing of tokenized documents.

Documents are encoded, ended by an end token, and cut into windows of several context sizes (tiers).
What is longer than the longest window first gives whole windows. The rest of each document is routed
to the smallest tier that holds it. Tiers are packed from the longest down: a window opens with the
longest document of its tier, and its gap is filled from the shorter tiers, by whole documents where
one fits and at last by a cut one. Windows are then dealt to step groups of equal token counts, the
largest first to the emptiest group.

Packing needs no shuffle: every task packs the rows it reads, a bounded number of tokens at a time,
and hands unfinished windows on to its next batch. Its last tokens are cut into windows whose sizes
are descending powers of two, so no window needs padding. Equal input partitions give equal output,
so a task that is run again gives the same sequences.

Defined results: a null or empty text is one end token. Repeated rows are packed each for itself, so
their pieces differ only in their place. A null key is carried. No rows give no sequences. Other columns of the
documents are not looked at. A text has to fit a row, and its tokens the memory of a task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (512, 1024, 2048, 4096)
# Tokens that a task packs at a time, 4 bytes each.
BATCH_TOKENS = 2_000_000
# Tokens in a step group.
STEP_TOKENS = 65_536
END = 2


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _word_coder():
    """``make(file)`` gives ``learn(words, known)``, which puts the ids of words, as bytes, into ``known``."""

    def make(where):
        import json
        import os
        import re

        import numpy as np
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(where)
        with open(where, encoding="utf-8") as source:
            file = json.load(source)
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"] for t in file["added_tokens"]}
        # A part ends with the byte 1, which stands for the vocabulary's word end.
        ranks = {}
        for text, number in file["model"]["vocab"].items():
            if text not in special:
                ranks[bytes(letter[c] for c in text.removesuffix("</w>")) + b"\x01" * text.endswith("</w>")] = number
        coder = tiktoken.Encoding("parts", pat_str="[^\\x01]+\\x01", mergeable_ranks=ranks, special_tokens={})
        simple = re.compile(rb"(?:[\x21-\x7e]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
        split = re.compile(
            rb"'s|'t|'re|'ve|'m|'ll|'d|(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[\x21-\x2f\x3a-\x60\x7b-\x7e]+|\n"
        ).findall

        # A line end between words becomes a token of its own, which no word holds.
        between = ranks[b"\n\x01"]

        def learn(words, known):
            some = [w for w in filter(simple, words) if b"<|" not in w]
            odd = list(set(words).difference(some))
            for at in range(0, len(some), 20_000):
                now = some[at : at + 20_000]
                parts = split(b"\n".join(now).decode().lower().encode())
                ids = np.array(coder.encode_ordinary((b"\x01".join(parts) + b"\x01").decode()), np.int64)
                cuts = np.flatnonzero(ids == between)
                ids, cuts = np.delete(ids, cuts), cuts - np.arange(len(cuts))
                cuts = [0, *(4 * cuts).tolist(), 4 * len(ids)]
                known.update(zip(now, map(ids.astype("<u4").tobytes().__getitem__, map(slice, cuts, cuts[1:]))))
            for at in range(0, len(odd), 20_000):
                now = odd[at : at + 20_000]
                coded = encoder.encode_batch_fast([w.decode() for w in now], add_special_tokens=False)
                for word, code in zip(now, coded):
                    known[word] = np.array(code.ids, "<u4").tobytes()

        return learn

    return make


def pack(
    docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text",
    tiers: tuple[int, ...] = TIERS, end: int = END, batch_tokens: int = BATCH_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: ``(key, start, length, ids, doc_tokens, sequence_id, offset,
    sequence_length, step_group)``; ``ids`` are little-endian unsigned 32-bit numbers.

    The tokenizer's file must be at the same path on every executor. It must part texts at white space
    and lower-cased words into runs of letters, single digits and runs of other signs, as
    ``word_bpe_49k.json`` does: each different word is then encoded once, not each word of each text.
    Words of ASCII and Latin-1 letters, digits and signs go through the same vocabulary and merges as
    ranks, their parts ended by a sign of their own; all other words through the tokenizer as it is.
    """
    where = tokenizer or tokenizer_path()
    make, sizes = _word_coder(), sorted(tiers)
    longest = sizes[-1]

    def run(batches):
        import heapq
        import sys
        from bisect import bisect_right, insort
        from types import ModuleType

        import numpy as np
        import pandas as pd
        from pyspark import TaskContext

        # Tokenizer and known words stay with the Python worker, for the tasks it gets later.
        kept = sys.modules.setdefault("kept_for_packing", ModuleType("kept_for_packing"))
        if getattr(kept, "where", None) != where:
            kept.tools, kept.known, kept.where = make(where), {}, where
        learn, known = kept.tools, kept.known
        stop = np.array([end], "<u4").tobytes()
        task = TaskContext.get().partitionId() << 32
        serial, steps = 0, 0

        def tokens(texts):
            """Ids of each text with the end token, as bytes."""
            lines = [(t or "").encode("utf-8", "replace").split() for t in texts]
            if len(known) > 500_000:
                known.clear()
            learn(set().union(*lines).difference(known), known)
            return [b"".join(map(known.__getitem__, line)) + stop for line in lines]

        def plan(parts, final):
            """Windows ``(size, pieces)`` of these parts ``(length, doc, start)``, and what is left."""
            windows, rest = [], []
            for n, doc, start in parts:
                while n >= longest:
                    windows.append((longest, [(doc, start, longest)]))
                    start, n = start + longest, n - longest
                if n:
                    rest.append((n, doc, start))
            rest.sort()
            left = []
            for size, below in zip(reversed(sizes), [*reversed(sizes[:-1]), 0]):
                cut = bisect_right(rest, (below, float("inf")))
                short, own = rest[:cut], rest[cut:]
                while own:
                    n, doc, start = own.pop()
                    pieces, gap = [(doc, start, n)], size - n
                    while gap and (short or own):
                        pool = short or own
                        at = bisect_right(pool, (gap, float("inf")))
                        if at:
                            n, doc, start = pool.pop(at - 1)
                            pieces.append((doc, start, n))
                            gap -= n
                        else:
                            n, doc, start = pool.pop(0)
                            pieces.append((doc, start, gap))
                            kept = (n - gap, doc, start + gap)
                            insort(short if kept[0] <= below else own, kept)
                            gap = 0
                    if gap:
                        left = pieces
                    else:
                        windows.append((size, pieces))
                rest = short
            if not final:
                return windows, left
            # At most one unfinished window is left: its tokens go to powers of two.
            total = sum(n for _, _, n in left)
            while total:
                size = 1 << (total.bit_length() - 1)
                pieces, gap = [], size
                while gap:
                    doc, start, n = left.pop(0)
                    take = min(n, gap)
                    pieces.append((doc, start, take))
                    if take < n:
                        left.insert(0, (doc, start + take, n - take))
                    gap -= take
                windows.append((size, pieces))
                total -= size
            return windows, []

        def emit(windows, docs):
            nonlocal serial, steps
            windows.sort(key=lambda w: -w[0])
            total = sum(size for size, _ in windows)
            groups = max(1, round(total / step_tokens))
            fill = [(0, g) for g in range(groups)]
            rows, held = [], 0
            for size, pieces in windows:
                full, group = heapq.heappop(fill)
                heapq.heappush(fill, (full + size, group))
                offset = 0
                for doc, start, n in pieces:
                    name, ids = docs[doc]
                    rows.append((
                        name, start, n, ids[4 * start : 4 * (start + n)], len(ids) // 4,
                        task + serial, offset, size, task + steps + group,
                    ))
                    offset += n
                serial += 1
                held += size
                if held >= 2_000_000:
                    yield frame(rows)
                    rows, held = [], 0
            steps += groups
            if rows:
                yield frame(rows)

        def frame(rows):
            out = pd.DataFrame(rows, columns=columns)
            out[columns[0]] = out[columns[0]].astype(object)
            return out

        docs, parts, held, count = {}, [], 0, 0
        for batch in batches:
            names, texts = batch.iloc[:, 0].tolist(), batch.iloc[:, 1].tolist()
            for at in range(0, len(texts), 256):
                for name, ids in zip(names[at : at + 256], tokens(texts[at : at + 256])):
                    docs[count] = (None if name is None or name != name else name, ids)
                    parts.append((len(ids) // 4, count, 0))
                    held += len(ids) // 4
                    count += 1
                if held >= batch_tokens:
                    windows, left = plan(parts, False)
                    yield from emit(windows, docs)
                    parts = [(n, doc, start) for doc, start, n in left]
                    docs = {doc: docs[doc] for _, doc, _ in parts}
                    held = sum(n for n, _, _ in parts)
        if parts:
            windows, _ = plan(parts, True)
            yield from emit(windows, docs)

    kind = dict(docs.dtypes)[key]
    columns = [
        "key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group",
    ]
    schema = (
        f"key {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, sequence_length bigint, step_group bigint"
    )
    # Integer keys come as text, so that pandas does not turn them to floats beside a null.
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    packed = rows.mapInPandas(run, schema.replace(f"key {kind}", "key string"))
    return packed.select(F.col("key").cast(kind).alias(key), *columns[1:])
