"""Importance resampling towards a target distribution.

Texts are bags of hashed features: runs of 1 to ``runs`` consecutive words, each counted in one of
``buckets`` buckets. A bucket's gain is the logarithm of how much likelier it is in the target texts than
in the documents, smoothed by one and in whole thousandths. The gains are one array; a document's weight
is the mean of the array's entries over its features. To the weight comes Gumbel noise from a hash of
the id, so that the highest scores are a draw without replacement in proportion to the weights' powers
of e, and reruns agree. Of the documents with ``least_words`` words or more, ``percent`` in a hundred
are drawn, by rank in a radix sort of (score, id).

Texts are read once: their bucket numbers are stored, 2 or 4 bytes a feature, and counted and weighed
from there. A task adds up its counts before they are shuffled. ``buckets`` numbers of each side come to
the driver, and one array goes to the tasks.

Defined results: a null or empty text has no features and weight 0. A row without an id has no score, is
not drawn and not one of the N, but its words count. Repeated rows are drawn each for itself, in the
order in which they were stored. Without documents or targets the counts are zero. Other columns are not
looked at, whatever their names. A text has to fit a row.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.llm.radix import radix_rank
from treeledger.sources.store import stored

BUCKETS = 10_000
SEED = 2024


def hashed_features(rows: DataFrame, key: str, text: str = "text", buckets: int = BUCKETS, runs: int = 1) -> DataFrame:
    """``(key, n_words, n_features, buckets)``: the bucket of every feature, as unsigned numbers of 2
    bytes, or 4 where there are more buckets than 65,536."""
    kind = dict(rows.dtypes)[key]
    width = "<u2" if buckets <= 65_536 else "<u4"

    def run(batches):
        import re
        import zlib

        import numpy as np
        import pandas as pd

        words_of = re.compile(rb"[0-9a-z\x80-\xff]+").findall

        class Known(dict):
            def __missing__(self, feature):
                if len(self) > 500_000:
                    self.clear()
                found = self[feature] = zlib.crc32(feature) % buckets
                return found

        place = Known().__getitem__
        for batch in batches:
            for at in range(0, len(batch), 512):
                out = []
                for name, text in zip(batch["key"].iloc[at : at + 512], batch["text"].iloc[at : at + 512]):
                    words = words_of(text.lower()) if text else []
                    found = [np.fromiter(map(place, words), width, len(words))]
                    for n in range(2, runs + 1):
                        run_of = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
                        found.append(np.fromiter(map(place, run_of), width, len(run_of)))
                    found = np.concatenate(found)
                    out.append((name, len(words), len(found), found.tobytes()))
                if out:
                    yield pd.DataFrame(out, columns=["key", "n_words", "n_features", "buckets"])

    # Keys go as text, so that pandas does not turn integers to floats beside a null.
    given = rows.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    found = given.mapInPandas(run, "key string, n_words bigint, n_features bigint, buckets binary")
    return found.withColumn("key", F.col("key").cast(kind))


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features each bucket holds."""
    width = "<u2" if buckets <= 65_536 else "<u4"

    def run(batches):
        import numpy as np
        import pandas as pd

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in batch["buckets"]:
                total += np.bincount(np.frombuffer(held, width), minlength=buckets)
        full = np.flatnonzero(total)
        if len(full):
            yield pd.DataFrame({"bucket": full, "n": total[full]})

    out = np.zeros(buckets, np.int64)
    counts = features.select("buckets").mapInPandas(run, "bucket bigint, n bigint")
    for bucket, n in counts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of (target share / source share), smoothed by one, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    n = len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def resample(
    docs: DataFrame, targets: DataFrame, percent: int = 10, least_words: int = 20, key: str = "doc_id",
    text: str = "text", target_text: str = "text", buckets: int = BUCKETS, runs: int = 1, seed: int = SEED,
) -> DataFrame:
    """``(key, n_features, weight, score, rank)`` for every row of ``docs``; ``rank`` counts from 1 in
    the order of the draw and is null for what is not drawn. Ties go to the smaller key, an integer."""
    features = stored(hashed_features(docs, key, text, buckets, runs), "features")
    wanted = targets.select(F.lit(None).cast("string").alias("key"), F.col(target_text).alias("text"))
    gain = gains(
        bucket_counts(features, buckets), bucket_counts(hashed_features(wanted, "key", "text", buckets, runs), buckets)
    )
    width = "<u2" if buckets <= 65_536 else "<u4"

    import pandas as pd

    def weigh(held: pd.Series) -> pd.Series:
        import numpy as np

        out = np.zeros(len(held), np.int64)
        for i, raw in enumerate(held):
            if raw:
                found = gain[np.frombuffer(raw, width)]
                out[i] = int(found.sum()) // len(found)
        return pd.Series(out)

    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = (
        features.select("key", "n_words", "n_features", F.pandas_udf(weigh, "bigint")("buckets").alias("weight"))
        .withColumn("score", F.col("weight") + noise)
    )
    scored = stored(scored, "scores")
    able = F.col("key").isNotNull() & (F.col("n_words") >= least_words)
    n, best = scored.where(able).agg(F.count(F.lit(1)), F.coalesce(F.max("score"), F.lit(0))).first()
    # Highest scores first: the way down from the best one is what ascends.
    sortable = scored.where(able).withColumn("down", F.lit(best) - F.col("score")).withColumn("id", F.col("key").cast("bigint"))
    ranked = radix_rank(sortable, ["down", "id"], "place")
    most = n * percent // 100
    columns = [F.col("key").alias(key), "n_features", "weight", "score"]
    drawn = F.when(F.col("place") < most, F.col("place") + 1)
    return ranked.select(*columns, drawn.alias("rank")).unionByName(
        scored.where(~able).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    )
