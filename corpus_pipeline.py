"""The corpus pipeline: stages that each take and return documents.

Every stage is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, grouping_ga, jaccard_join, line_dedup, quality
from plumbline.llm.common import stored, table
from plumbline.llm.queries import tokenizer_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay that the classifier, learnt from these documents and the labels, doesn't reject."""
    scored = quality.quality_scores(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where(F.col("__score") >= quality.THRESHOLD).select(*COLUMNS)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more documents go. A document stays even when no line is left; n_chars follows its text."""
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by sets of five-word shingles at 0.8 or more, the one with the smallest id stays.

    Rows are compared whatever their ids: texts that differ stay under one id, and a row without an id goes if it copies
    another; it stays only where no row of its group has an id. Of rows with one id and one text without words one stays
    as well. Which of equal ids stays does not matter, as their texts are linked.
    """
    rows = stored(docs.select(*COLUMNS).withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows")
    groups = stored(jaccard_join.similar_documents(rows, id_col="__row", width=5, share=(4, 5))
                    .select(F.col("doc_id").alias("__row"), "component_id", "n_links"), "pipeline-groups")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__row")
    linked = groups.where("n_links > 0").join(rows.select("__row", "doc_id"), "__row")
    # Known by their text alone: no join that moves the other texts.
    wordless = rows.where(F.col("doc_id").isNotNull() & ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")).select("__row", "doc_id", "text")
    stay = (linked.groupBy("component_id").agg(F.min(order).alias("first"))
            .unionByName(wordless.groupBy("doc_id", "text").agg(F.min(order).alias("first")), allowMissingColumns=True)
            .select(F.col("first.__row").alias("__row")))
    gone = linked.select("__row").unionByName(wordless.select("__row")).join(stay, "__row", "left_anti")
    return rows.join(gone, "__row", "left_anti").select(*COLUMNS)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, and their places in sequences of at most 2048 tokens."""
    pieces = grouping_ga.token_pieces(docs, tokenizer_file("word_bpe_49k.json"))
    return grouping_ga.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", no_benchmark),
    ("best-fit packing", packed),
]

# The classifier learns and the packing searches, so SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
