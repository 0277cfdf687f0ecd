"""The training-data pipeline: documents in, packed sequences out.

Each stage takes the rows its predecessor kept, written as a table and read again. All but the last
return the columns of the documents.
"""

from pyspark.sql import functions as F

from treeledger.llm import mixing, packing, pulearn, simhash, suffixes
from treeledger.session import configure
from treeledger.sources.store import stored

LEAST_SCORE = 0.3


def quality(spark, docs, sf_dir):
    """Documents that the classifier accepts. Labels are learnt from as in its query."""
    model = pulearn.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(pulearn.score(model, F.col("text")) >= LEAST_SCORE)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def repeated_passages(spark, docs, sf_dir):
    """Passages of 50 words and more stay in one document only."""
    return suffixes.cut_repeats(docs, least=50)


def mix(spark, docs, sf_dir):
    """Sources at their target weights; a document comes once for each pass that takes of it."""
    return mixing.mix_documents(docs)


def pack(spark, docs, sf_dir):
    """Pieces of documents in sequences of at most 4096 tokens, with their ids."""
    packed = packing.pack(docs)
    return packed.withColumn("ids_crc32", F.crc32("ids"))


def _configured(stage):
    return lambda spark, docs, sf_dir: stage(configure(spark), docs, sf_dir)


STAGES = [
    ("quality_classifier", _configured(quality)),
    ("simhash_near_dedup", _configured(near_duplicates)),
    ("suffix_array_dedup", _configured(repeated_passages)),
    ("source_mixing", _configured(mix)),
    ("packing", _configured(pack)),
]

# Scores, permutations and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
