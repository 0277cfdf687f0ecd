"""A quality classifier learnt from trusted positives and unlabelled text.

Positives are documents labelled 1; the unlabelled set is a sample of all documents, good and bad.
With the share of positives among all documents (the class prior, here the share of 1 among the
labels that may be learnt from), the risk on negatives is the risk of calling unlabelled text negative
less the prior's part of it. The model minimises this unbiased risk with a floor at zero (non-negative
risk): where a flexible model would push the negative part below zero, the step goes back up. What may
be learnt from labels 0 is used for the prior and, at the end, for the scale: two numbers turn the
model's output to a probability, fitted to labels 1 and 0 at their shares.

Learning is on bounded samples, in the driver: MOST_POSITIVE, MOST_UNLABELLED and MOST_SCALE documents
with the smallest hash of their id. Their feature vectors come to the driver, 50 MB at most. Scoring is a pass
over all texts without a shuffle, with the weights (one vector) in the task.

Features are about form, not vocabulary: shares of word shapes (letter case, digits and signs, as in
``Aa.``) and of pairs of shapes, hashed, and a few measures of length and repetition.

Defined results: a null text is an empty one; it gets a score like any other. Labels whose document is missing and
documents without labels are fine; null labels are ignored. Of several texts with one id the largest
is learnt from. Without positives or without unlabelled text there is nothing to learn and every score
is the prior, or 0.5 without labels. Other columns are not looked at, whatever their names.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.llm.text import crc_fold

MOST_POSITIVE = 4_000
MOST_UNLABELLED = 8_000
MOST_SCALE = 4_000
SHAPES, PAIRS, MEASURES = 256, 512, 10
FOLDS = 5
ROUNDS = 400


@dataclass(frozen=True)
class Model:
    weights: np.ndarray | None
    prior: float


def _featurizer(shapes: int = SHAPES, pairs: int = PAIRS, measures: int = MEASURES):
    def made():
        import re
        import zlib

        import numpy as np

        upper, lower = re.compile(r"[^\W\d_a-zà-öø-ÿß]+"), re.compile(r"[a-zà-öø-ÿß]+")
        digits, twice = re.compile(r"\d+"), re.compile(r"(.)\1+")
        known = {}

        def shape(word):
            found = known.get(word)
            if found is None:
                if len(known) > 500_000:
                    known.clear()
                form = twice.sub(r"\1\1", digits.sub("0", lower.sub("a", upper.sub("A", word))))
                found = known[word] = zlib.crc32(form.encode("utf-8", "replace")) % shapes
            return found

        def features(text):
            out = np.zeros(shapes + pairs + measures, np.float32)
            text = text or ""
            words = re.split(r"[\x20\x09-\x0D]+", text)
            words = [w for w in words if w]
            n = len(words)
            out[-1] = 1
            if not n:
                return out
            kinds = np.fromiter(map(shape, words), np.int64, n)
            out[:shapes] = np.sqrt(np.bincount(kinds, minlength=shapes) / n)
            if n > 1:
                both = (kinds[:-1] * 31 + kinds[1:] * 17) % pairs
                out[shapes : shapes + pairs] = np.sqrt(np.bincount(both, minlength=pairs) / (n - 1))
            lines = [x for x in text.split("\n") if x.strip()]
            at = shapes + pairs
            out[at] = np.log1p(n) / 10
            out[at + 1] = len(set(words)) / n
            out[at + 2] = sum(map(str.__eq__, words[1:], words[:-1])) / n
            out[at + 3] = len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2)
            out[at + 4] = min(3.0, sum(map(len, words)) / n / 10)
            out[at + 5] = len(set(lines)) / max(1, len(lines))
            out[at + 6] = min(3.0, n / max(1, len(lines)) / 50)
            out[at + 7] = sum(map(str.isupper, words)) / n
            out[at + 8] = sum(map(str.isalpha, words)) / n
            return out

        return features

    return made


def learn(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = ROUNDS,
          rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights of the logistic model with the least non-negative risk; Adam on all rows at once."""

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    w = np.zeros(positive.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        fp, fu = positive @ w, unlabelled @ w
        sp, su = sigmoid(fp), sigmoid(fu)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        slope = unlabelled.T @ su / len(fu) - prior * (positive.T @ sp) / len(fp)
        if negative >= 0:
            g = prior * (positive.T @ (sp - 1)) / len(fp) + slope
        else:
            g = -slope
        g = g + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def scale(positive: np.ndarray, negative: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset of the outputs of both classes, by logistic regression at their shares. Targets
    are one row short of certain, so that classes which do not overlap have an answer too."""
    x = np.concatenate([positive, negative])
    y = np.concatenate([
        np.full(len(positive), (len(positive) + 1) / (len(positive) + 2)),
        np.full(len(negative), 1 / (len(negative) + 2)),
    ])
    weight = np.concatenate([
        np.full(len(positive), prior / len(positive)), np.full(len(negative), (1 - prior) / len(negative))
    ])
    mean, spread = x.mean(), x.std() or 1.0
    rows = np.stack([(x - mean) / spread, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (weight * (p - y)) + 1e-6 * w
        bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
    if w[0] <= 0:  # no order to be kept
        return 1.0, 0.0
    return w[0] / spread, w[1] - w[0] * mean / spread


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED, most_scale: int = MOST_SCALE,
    held_out_fold: int = 0,
) -> Model:
    """Learn from labels and texts whose fold (crc32 of the id, mod 5) is not the held-out one."""
    free = crc_fold(key, FOLDS) != held_out_fold
    marked = labels.where(free & F.col(label).isNotNull()).select(F.col(key).alias("id"), F.col(label).alias("label"))
    prior = marked.agg(F.avg(F.when(F.col("label") == 1, 1.0).otherwise(0.0))).first()[0]

    def sample(ids, most):
        return ids.orderBy(F.xxhash64("id"), "id").limit(most)

    positive = sample(marked.where("label = 1").select("id").distinct(), most_positive)
    unlabelled = sample(docs.where(free).select(F.col(key).alias("id")).distinct(), most_unlabelled)
    negative = sample(marked.where("label = 0").select("id").distinct(), most_scale)
    # The numbers of ids are bounded, whatever the tables hold.
    ids = (
        positive.withColumn("positive", F.lit(1)).unionByName(unlabelled.withColumn("positive", F.lit(0)))
        .unionByName(negative.withColumn("positive", F.lit(-1)))
    )
    texts = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    chosen = texts.join(F.broadcast(ids), "id").groupBy("id", "positive").agg(F.max("text").alias("text"))
    make = _featurizer()

    def run(batches):
        import pandas as pd

        features = make()
        for batch in batches:
            yield pd.DataFrame({
                "id": batch["id"], "positive": batch["positive"],
                "features": [features(t).tobytes() for t in batch["text"]],
            })

    kind = dict(docs.dtypes)[key]
    rows = chosen.mapInPandas(run, f"id {kind}, positive int, features binary").toPandas()
    rows = rows.sort_values(["positive", "id"])
    sets = [
        np.frombuffer(b"".join(rows.loc[rows["positive"] == p, "features"]), np.float32)
        .reshape(-1, SHAPES + PAIRS + MEASURES).astype(np.float64)
        for p in (1, 0, -1)
    ]
    if prior is None or not len(sets[0]) or not len(sets[1]):
        return Model(None, 0.5 if prior is None else prior)
    weights = learn(sets[0], sets[1], prior)
    if len(sets[2]):
        slope, offset = scale(sets[0] @ weights, sets[2] @ weights, prior)
        weights = weights * slope
        weights[-1] += offset  # the last feature is always 1
    return Model(weights, prior)


def score(model: Model, text: Column) -> Column:
    """Between 0 and 1; higher where label 1 is likelier."""
    if model.weights is None:
        return F.lit(float(model.prior))
    import pandas as pd

    weights, make, made = model.weights, _featurizer(), []

    def run(texts: pd.Series) -> pd.Series:
        import numpy as np

        if not made:
            made.append(make())
        found = np.array([made[0](t) @ weights for t in texts], np.float64)
        return pd.Series(1 / (1 + np.exp(-np.clip(found, -30, 30))))

    return F.pandas_udf(run, "double")(text.cast("string"))
