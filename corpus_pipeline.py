"""The corpus pipeline: toxicity, near-duplicates, personal data, mixing, packing.

Every stage takes (spark, docs, folder of tables) and returns a DataFrame, which is
written to the shared folder and read again as the next stage's `docs`. All but the
last return the columns of `documents`.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetwright.llm import mixing, packing, pii, simhash, toxicity
from fleetwright.llm.common import documents, materialise
from fleetwright.sources.tables import parquet_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by the nearest labelled examples stay."""
    labels = parquet_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.learn(docs, toxicity.learning_rows(labels, 5, 0))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by SimHash."""
    return simhash.one_of_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is replaced by its kind; `n_chars` follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled within their shard."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and offset."""
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Models, fingerprints and token ids are beyond SQL: tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from `documents` on."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
