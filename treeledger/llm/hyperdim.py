"""Language identification by hyperdimensional profiles.

Every letter (code point) has a fixed random vector of +1 and -1. A trigram binds the vectors of its
letters: each is rotated by its place in the trigram, and they are multiplied. A text bundles its
trigrams: their vectors are added. The profile (prototype) of a language is the bundle of its training
texts, each scaled to one length, and a text has the language whose prototype has the largest cosine.

Words are what letters make of the lower-cased text; all else is one space between them. Training texts
are chosen by a hash of their id, about PER_LANGUAGE of each language (all, if fewer). A task adds the
vectors of its texts before anything is shuffled, so training moves one vector a task and language; the
prototypes, DIM numbers for each language, come to the driver, which refuses more than MAX_LANGUAGES.
Sums are of integers, so reruns agree.

Defined results: ``und`` and score 0 for a null text, for one without a letter, and for all when there
is nothing to learn from. A null id is never held out and never learnt from. Equal cosines go to the
smaller language name. Repeated rows are judged alike. Other columns are not looked at, whatever their names.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.llm.text import crc_fold

DIM = 1024
PER_LANGUAGE = 3_000
MAX_LANGUAGES = 10_000
FOLDS = 4
HELD_OUT = 2
UNKNOWN = "und"
# Different trigrams whose vectors are made at a time, 5 * DIM bytes each.
SLICE = 8_192


def _bundler(dim: int):
    def made():
        import numpy as np

        letters, is_letter = {}, np.array([chr(i).isalpha() for i in range(0x32400)])

        def letter(code):
            if code not in letters:
                if len(letters) > 20_000:
                    letters.clear()
                draw = np.random.Generator(np.random.Philox(key=code))
                letters[code] = (draw.integers(0, 2, dim, dtype=np.int8) * 2 - 1).astype(np.int8)
            return letters[code]

        def trigrams(text):
            """Distinct trigrams as numbers, and how often each is there; None without a letter."""
            codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
            known = np.zeros(len(codes), bool)
            known[codes < len(is_letter)] = is_letter[codes[codes < len(is_letter)]]
            if not known.any():
                return None
            codes = np.concatenate(([32], np.where(known, codes, 32), [32]))
            codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
            return np.unique((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:], return_counts=True)

        def vectors(found):
            """A row for each text: the sum of its trigrams' vectors."""
            out = np.zeros((len(found), dim), np.float32)
            some = [f for f in found if f is not None]
            if not some:
                return out
            all_codes = np.unique(np.concatenate([codes for codes, _ in some]))
            for at in range(0, len(all_codes), SLICE):  # what is held does not grow with a text
                part = all_codes[at : at + SLICE]
                bound = np.ones((len(part), dim), np.int8)
                for turn, codes in zip((2, 1, 0), (part >> 42, (part >> 21) & 0x1FFFFF, part & 0x1FFFFF)):
                    kinds, which = np.unique(codes, return_inverse=True)
                    table = np.stack([np.roll(letter(int(k)), turn) for k in kinds])
                    bound *= table[which]
                bound = bound.astype(np.float32)
                for i, f in enumerate(found):
                    if f is not None:
                        low, high = np.searchsorted(f[0], (part[0], part[-1] + 1))
                        if low < high:
                            out[i] += f[1][low:high].astype(np.float32) @ bound[np.searchsorted(part, f[0][low:high])]
            return out

        return trigrams, vectors

    return made


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", dim: int = DIM,
    per_language: int = PER_LANGUAGE,
) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes, rows of length one."""
    rows = docs.where((crc_fold(key, FOLDS) != HELD_OUT) & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.pmod(F.xxhash64(key), F.lit(1_000_000)).alias("place"),
    )
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return [], np.zeros((0, dim))
    part = [F.lit(x) for name, n in counts.items() for x in (name, min(1.0, per_language / n) * 1_000_000)]
    rows = rows.where(F.col("place") < F.element_at(F.create_map(*part), F.col("lang")))
    make = _bundler(dim)

    def run(batches):
        import numpy as np
        import pandas as pd

        trigrams, vectors = make()
        sums = {}
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.iloc[at : at + 256]
                found = vectors([trigrams(t) for t in some["text"]])
                length = np.linalg.norm(found, axis=1, keepdims=True)
                found = np.rint(1024 * found / np.maximum(length, 1e-9)).astype(np.int64)
                for name, vector in zip(some["lang"], found):
                    if name in sums:
                        sums[name] += vector
                    else:
                        sums[name] = vector
        if sums:  # a task may have no rows, and an empty column of lists has no type
            yield pd.DataFrame({"lang": list(sums), "sums": list(sums.values())})

    sums = (
        rows.select("lang", "text").mapInPandas(run, "lang string, sums array<bigint>")
        .select("lang", F.posexplode("sums").alias("at", "value"))
        .groupBy("lang", "at").agg(F.sum("value").alias("value")).collect()
    )
    names = sorted({r["lang"] for r in sums})
    out = np.zeros((len(names), dim))
    for r in sums:
        out[names.index(r["lang"]), r["at"]] = r["value"]
    kept = np.linalg.norm(out, axis=1) > 0  # a language may have texts without a letter only
    names, out = [n for n, k in zip(names, kept) if k], out[kept]
    return names, out / np.linalg.norm(out, axis=1, keepdims=True)


def identify(
    docs: DataFrame, names: list[str], prototypes: np.ndarray, key: str = "doc_id", text: str = "text",
    dim: int = DIM,
) -> DataFrame:
    """``(key, lang_pred, score)`` for every row; the score is the cosine, not below 0."""
    make, unknown = _bundler(dim), UNKNOWN
    table = prototypes.T.astype(np.float32)

    import pandas as pd

    def run(texts: pd.Series) -> pd.DataFrame:
        import numpy as np

        trigrams, vectors = make()
        langs, scores = [], []
        for at in range(0, len(texts), 256):
            found = [trigrams(t) for t in texts.iloc[at : at + 256]]
            bundle = vectors(found)
            length = np.linalg.norm(bundle, axis=1, keepdims=True)
            cosines = (bundle / np.maximum(length, 1e-9)) @ table
            for f, row in zip(found, cosines):
                if f is None or not names:
                    langs.append(unknown)
                    scores.append(0.0)
                else:
                    best = int(row.argmax())
                    langs.append(names[best])
                    scores.append(float(min(1.0, max(0.0, row[best]))))
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    judged = F.pandas_udf(run, "lang_pred string, score double")(F.col(text).cast("string"))
    return docs.select(F.col(key), judged.alias("_judged")).select(key, "_judged.lang_pred", "_judged.score")
