"""Corpus pipeline: five stages over ``documents``, each an operator of stationcast.llm.

Every stage takes (spark, docs, sf_dir), works on all rows the stage before kept
and returns a DataFrame that is written as Parquet and read again as the next
stage's input.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm.common import n_words, named, others, staged, table
from stationcast.llm.decontamination import decontaminate
from stationcast.llm.language_id import fit, identify
from stationcast.llm.line_dedup import dedup_lines
from stationcast.llm.mixing import mix, with_quality
from stationcast.llm.near_dedup import deduplicate



def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model recognises; those it rejects go."""
    found = identify(docs, fit(docs), pred="__lang", score="__score", rejected="__rejected")
    return found.where(~F.col("__rejected")).select(*named(*docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of lines that stand at an earlier place already;
    n_chars is the length of what is left."""
    done = dedup_lines(docs, counts=("__before", "__removed", "__runs"))
    return (done.withColumn("n_chars", F.when(F.col("__removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*named(*docs.columns)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of every group of near copies (five-word shingles, 0.8)."""
    return deduplicate(docs).select(*named(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*named(*docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: documents with the words taken (repeats counted) and
    how often, towards the source's target."""
    sized = docs.withColumn("__words", n_words(F.col("text")))  # before the join, so that the sums need no text from it
    mixed = mix(with_quality(sized, table(spark, sf_dir, "labels")), F.col("__quality"), size=F.col("__words"))
    return (mixed.where(F.col("taken") > 0).withColumn("times", (F.col("taken") / F.col("size")).cast("int"))
            .select(*named(*others(docs, "size", "source_size", "target", "taken", "times")), "size", "source_size", "target", "taken", "times"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("mixing", mixing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None
