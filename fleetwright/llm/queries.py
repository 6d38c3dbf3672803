"""The registered corpus queries: each applies one operator to its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetwright.llm import alignment, ann, language, language_model, lexical, line_quality, mixing, packing, pii, quality_rules, simhash, token_files, toxicity
from fleetwright.llm.common import documents, held_out
from fleetwright.llm.sql import ORACLE
from fleetwright.session import ship_package
from fleetwright.sources.tables import parquet_table

__all__ = ["ORACLE", "QUERIES"]


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = language.learn(docs.select("doc_id", "text", "lang").filter(~held_out("doc_id", 4, 2)))
    found = language.predict(docs, model)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "ambiguous")


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).select(
        "doc_id", "size", "source_size", "target", "taken",
        F.transform("copies", lambda c: c["shard"]).alias("shards"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_spans(documents(spark, folder))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = parquet_table(spark, folder, "labels").select("doc_id", "toxic")
    model = toxicity.learn(docs, toxicity.learning_rows(labels, 5, 0))
    scored = toxicity.scores(docs, model)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         toxicity.predicted(F.col("score")).alias("predicted"), "nearest")


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(documents(spark, folder))


def op6_ann(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    vectors = parquet_table(spark, folder, "embeddings", "vec_id bigint, embedding array<float>")
    return ann.search(vectors, F.col("vec_id") % 100 == 0, k=10)


def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    held = held_out("doc_id", 7, 2)
    scored = language_model.score_documents(documents(spark, folder), ~held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.cascade(documents(spark, folder))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(documents(spark, folder))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(documents(spark, folder))


def op12_lexical(spark: SparkSession, folder: str) -> DataFrame:
    items = parquet_table(spark, folder, "benchmark", "item_id bigint, text string")
    return lexical.search(documents(spark, folder), items, k=20)


def op13_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = parquet_table(spark, folder, "labels").select("doc_id", "quality")
    model = line_quality.learn(docs, line_quality.learning_rows(labels, 5, 0))
    return line_quality.scores(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
        line_quality.predicted(F.col("score")).alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_mixing": op2_mixing,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_token_files": op5_token_files,
    "op6_ann": op6_ann,
    "op7_language_model": op7_language_model,
    "op8_quality_rules": op8_quality_rules,
    "op9_packing": op9_packing,
    "op10_simhash": op10_simhash,
    "op11_alignment": op11_alignment,
    "op12_lexical": op12_lexical,
    "op13_line_quality": op13_line_quality,
}
