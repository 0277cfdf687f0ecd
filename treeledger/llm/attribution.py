"""Token counts of sections, by attribution from tokens of the whole document.

A tokenizer merges across section borders, so the tokens of a document are not the sum of those of its
sections. Here every document is encoded once and whole. The bytes of its tokens, one after another,
are intervals of the text, and so are its sections; both are in order, and a search of the tokens'
ends among the sections' joins them. A token inside one section is its own. One that crosses borders
goes by an explicit rule:

* ``first``, ``last``: to the section in which it begins, or ends;
* ``most``: to the section with most of its bytes, the first of equals;
* ``share``: to each section by its part of the bytes.

Under each rule the sections of a document add up to its tokens.

Defined results: null sections, and a null list of them, are empty ones. An empty section has no
tokens and is reported. A document without sections has no rows. Repeated rows are reported as often as
they come. Other columns are not looked at, whatever their names. A document has to fit a row.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = ("first", "last", "most", "share")


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def lines(text: Column) -> Column:
    """A text as its lines, each with the line end that closes it; no last empty line."""
    parts = F.split(F.coalesce(text, F.lit("")), r"(?<=\n)")
    return F.filter(parts, lambda p, i: (p != "") | (i == 0))


def blocks(text: Column, size: int) -> Column:
    """A text as blocks of ``size`` characters, the last one shorter; an empty text is one empty block."""
    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?s).{{1,{int(size)}}}"), F.lit(0))
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("")))


def attribute(
    rows: DataFrame, sections: Column, key: str = "doc_id", rule: str = "most", ranks: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """``(key, section, n_chars, tokens, n_crossing, doc_tokens)`` for each of ``sections``, an array of
    strings that make up the document. ``n_crossing`` are the crossing tokens that touch it. ``ranks``,
    a file of byte-level ranks, must be at the same path on every executor."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    ranks, pattern = ranks or ranks_path(), pattern or token_pattern()
    kind = dict(rows.dtypes)[key]

    def run(batches):
        import base64

        import numpy as np
        import pandas as pd
        import tiktoken

        with open(ranks, "rb") as source:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, source)}
        sizes = np.zeros(max(table.values()) + 1, np.int64)
        for piece, number in table.items():
            sizes[number] = len(piece)
        coder = tiktoken.Encoding("attribution", pat_str=pattern, mergeable_ranks=table, special_tokens={})

        def one(parts):
            ends = np.cumsum([len(p.encode("utf-8")) for p in parts])
            ids = np.array(coder.encode_ordinary("".join(parts)), np.int64)
            count, crossing = np.zeros(len(parts)), np.zeros(len(parts), np.int64)
            stop = np.cumsum(sizes[ids])
            start = stop - sizes[ids]
            a = np.searchsorted(ends, start, "right")
            b = np.searchsorted(ends, stop, "left")
            plain = a == b
            count += np.bincount(a[plain], minlength=len(parts))
            for i in np.flatnonzero(~plain):
                at = np.arange(a[i], b[i] + 1)
                low = np.concatenate(([0], ends))[at]
                part = np.minimum(ends[at], stop[i]) - np.maximum(low, start[i])
                crossing[at[part > 0]] += 1
                if rule == "share":
                    count[at] += part / sizes[ids[i]]
                else:
                    count[{"first": at[0], "last": at[-1], "most": at[part.argmax()]}[rule]] += 1
            return count, crossing, len(ids)

        names = ["key", "section", "n_chars", "tokens", "n_crossing", "doc_tokens"]
        for batch in batches:
            out, held = [], 0
            for name, parts in zip(batch["key"], batch["parts"]):
                parts = ["" if p is None else p for p in parts]
                count, crossing, total = one(parts)
                n = len(parts)
                out.append((
                    np.full(n, name, object), np.arange(n), np.array([len(p) for p in parts]), count, crossing,
                    np.full(n, total),
                ))
                held += n
                if held > 100_000:
                    yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)))))
                    out, held = [], 0
            if out:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)))))

    # Keys go as text, so that pandas does not turn integers to floats beside a null.
    asked = rows.select(F.col(key).cast("string").alias("key"), sections.cast("array<string>").alias("parts"))
    schema = "key string, section bigint, n_chars bigint, tokens double, n_crossing bigint, doc_tokens bigint"
    found = asked.where(F.size("parts") > 0).mapInPandas(run, schema)
    return found.select(F.col("key").cast(kind).alias(key), "section", "n_chars", "tokens", "n_crossing", "doc_tokens")
