"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``docs``, whatever they are. Where rows must be
told apart, their place in the files does it, so repeated rows, repeated ids
and null ids are handled like any others. An empty table passes through.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import decontam, exact_dedup, jaccard, packing, toxicity
from cairn.llm.ship import ship_package
from cairn.session import cut_lineage
from cairn.sources.tables import read_table

ROW = "__cairn_row"  # not among the columns of documents


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row that all scans agree on: its file and
    its place in it. (A number by partition would not do: how files are split
    depends on the cores at hand, which change when executors are lost.) Rows
    that do not come from Parquet files are written with a number first."""
    try:
        meta = docs.metadataColumn("_metadata")
        return docs.withColumn(ROW, F.struct(F.unhex(F.md5(meta["file_path"])).alias("file"), meta["row_index"].alias("at")))
    except AnalysisException:
        return cut_lineage(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline_rows")


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labelled ones
    among them, scores 0.5 or more go. Null and empty texts stay."""
    ship_package(spark)
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    rows = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic")
    model = toxicity.fit(rows, "__id", "__text", "__label")
    scored = toxicity.score(docs, "text", model, "__cairn_toxicity")
    return scored.where("__cairn_toxicity < 0.5").select(*_columns(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty) the largest doc_id stays."""
    rows = _numbered(docs)
    kept = exact_dedup.mark_duplicates(rows, row_col=ROW).where("kept").select(F.col("row").alias(ROW))
    return rows.join(kept, ROW, "left_semi").select(*_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each component of documents whose 5-word
    shingles have a Jaccard similarity of 0.8 or more. Texts without words
    are in no group and stay."""
    ship_package(spark)
    rows = _numbered(docs)
    found = jaccard.find_components(rows, id_col=ROW, text_col="text", size=5, num=80, den=100)
    kept = found.where("component_id = id").select(F.col("id").alias(ROW))
    return rows.join(kept, ROW, "left_semi").select(*_columns(docs))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    ship_package(spark)
    return decontam.without_leaks(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    ship_package(spark)
    out = packing.pack_documents(docs, "doc_id", "text", added_tokens=True)
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

# hashing with learnt weights, alignment and the genetic packing have no SQL
# form; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
