"""Corpus pipeline: toxicity, quality, near-duplicates, repeated passages, packing. Each stage is written and read again."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundline.llm import near_duplicates, packing, quality, suffix_dedup, toxicity
from soundline.llm.common import store

ORACLE_SQL = None


def _rows(docs: DataFrame) -> DataFrame:
    """row (all columns but text) and text: what a stage adds beside them meets no name of docs."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("row"), "text")


def _columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7, trained on the labels of the documents that there are.

    Null and empty texts stay; very long ones are scored whole. Repeated rows stay or go alike. Columns stay as they
    are, whatever their names. An empty table stays empty.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _columns(toxicity.score(_rows(docs), model, "score").filter("score < 0.7"), docs)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the quality model; null texts and those without words go.

    Very long texts are counted whole. Repeated rows stay or go alike. Columns stay as they are, whatever their names.
    An empty table stays empty.
    """
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _columns(quality.judge(_rows(docs), model).filter("kept"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document that names its group; of rows that repeat its id, one. Rows without an id stay.

    A group is linked by a similarity of 0.8 or more of five-word shingles. Columns stay as they are, whatever their
    names; very long texts are compared whole; null and empty texts count as one text without shingles. An empty
    table stays empty.
    """
    found = near_duplicates.near_duplicates(docs)
    keep = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n"))
    rows = _rows(docs).withColumn("doc_id", F.col("row.doc_id")).join(keep, "doc_id")
    once, more = rows.filter("n = 1"), rows.filter("n > 1").dropDuplicates(["doc_id"])
    return _columns(once, docs).unionByName(_columns(more, docs)).unionByName(docs.filter("doc_id is null"))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 400 bytes or more, or of over 50 words, that occur anywhere else.

    Bytes of cut characters go as well. Words are compared whatever white space separates them.

    A null text becomes empty. n_chars follows the text, where there is such a column; the others stay as they are,
    whatever their names. Repeated rows all stay, each without what they share. An empty table stays empty.
    """
    @F.pandas_udf("string")
    def text_of(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    found = _columns(suffix_dedup.remove_repeats(_rows(docs), words=51).withColumn("text", text_of("kept")), docs)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, in the columns of the packing operator.

    Null and empty texts are a piece of the end id alone, very long ones many pieces; repeated rows and rows without an
    id have pieces of their own. Other columns are not read. An empty table gives no pieces.
    """
    import public_tokenizers as P

    return packing.pack_texts(docs, P.path("word_bpe_49k.json")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
