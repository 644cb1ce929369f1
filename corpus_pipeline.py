"""The corpus pipeline: stages that turn ``documents`` into packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.llm import decontaminate, line_dedup, near_dedup, packing, quality_classifier
from lotwise.llm.common import quoted, stored, table


def _bare(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all other columns as one, so that no name can clash with one that an operator adds."""
    others = [F.col(quoted(c)) for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("row"), "doc_id", "text")


def _whole(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col(f"row.{quoted(c)}").alias(c) for c in columns])


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; null texts are judged as empty ones, repeated rows alike."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines are cut; a document of which nothing visible is left goes.

    Null texts, null ids and texts without visible lines stay as they are. ``n_chars`` follows the text.
    """
    cut = line_dedup.dedup_lines(_bare(docs))
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    kept = _whole(cut.where(~emptied), docs.columns)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays, once.

    Rows are judged by their own text, also those that repeat a doc_id. Without words or id a row is no copy and stays.
    """
    return near_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated by the benchmark go; a null text has no words and stays, repeated rows are judged alike."""
    found = decontaminate.decontaminate(_bare(docs), table(spark, sf_dir, "benchmark"))
    return _whole(found.where("NOT contaminated"), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences; null texts are empty documents, repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("best_fit_packing", pack),
]
# the classifier is trained and the packing evolved, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages after each other, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
