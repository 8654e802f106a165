"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that its predecessor
kept, which is written as Parquet in between. The first four keep the columns of ``documents``; the last
returns one row per token piece with its place in a sequence.

1. toxicity: documents predicted toxic go (learned from the training fold of ``labels``).
2. exact dedup: of equal texts the row with the largest doc_id stays.
3. MinHash near-dedup: the smallest doc_id of each class stays.
4. suffix-array dedup: passages of ``PASSAGE_BYTES`` bytes or more that stand elsewhere too are cut out of the
   texts; ``n_chars`` follows. A text may end up empty; its row stays. The length is a parameter of this
   stage (the query op10 has its own, 400): a passage of 51 words takes about 300 bytes of this prose, and 200 is
   under nearly all of them.
5. best-fit packing: sequences of at most 1024 tokens.

Rows with null or empty text pass the first stage, are copies of each other in the second (one stays) and
are packed as a lone end token. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import exact, minhash, packing, suffix, toxicity
from quarry.llm.common import stored
from quarry.llm.queries import gpt_model

PASSAGE_BYTES = 200


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.keep_clean(docs, labels)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    del spark, sf_dir
    return exact.keep_unique(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    del spark, sf_dir
    return minhash.keep_one_of_each(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str,
                  length: int = PASSAGE_BYTES) -> DataFrame:
    del spark, sf_dir
    cut = suffix.remove_repeats(docs, length=length)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    del spark, sf_dir
    return packing.pack_documents(docs, *gpt_model()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("best_fit_packing", pack),
]

#: Trained scores and token ids are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
