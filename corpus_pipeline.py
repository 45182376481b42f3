"""The training-data pipeline: quality rules, line dedup, near-duplicate removal, decontamination, packing.

Every stage takes all that the one before it kept, written as Parquet and read again. The first four return the
columns of ``documents``:

1. quality: documents that the rules or the likelihood ratio reject go;
2. lines: lines that are equal or similar to an earlier one go (``n_chars`` is counted anew); a document that is
   left without a word by that, all of it being said before, goes too;
3. near_duplicates: of each group of linked documents the one with the smallest doc_id stays. Rows with both
   doc_id and text equal are one document, which stays once;
4. decontamination: documents with a window of a benchmark item go;
5. packing: the pieces of the packed sequences.

``ORACLE_SQL`` is None: groups of similar lines, the likelihood ratio and the tokenizer have no SQL form. The pipeline is
tested against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import common
from adlens.llm.op01_pack import digest, pack
from adlens.llm.op03_lines import dedup_lines
from adlens.llm.op04_decontaminate import decontaminate
from adlens.llm.op06_jaccard import duplicates, jaccard_components
from adlens.llm.op10_quality import judge


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = judge(docs, common.read(spark, sf_dir, "labels"))
    return common.without(docs, judged.where("not kept").select("doc_id", "content"))


#: A character of a word, as line dedup reads words.
WORD = r"[0-9A-Za-z]|[^\x00-\x7F]"


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs).where(F.expr("size(removed_lines) = 0") | F.col("text").rlike(WORD))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("removed_lines") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = common.stash(jaccard_components(docs))
    kept = common.without(docs, duplicates(found))
    twice = common.stash(found.where("component is not null").groupBy("doc_id", "content").count().where("count > 1")
                         .select("doc_id", "content"))
    if twice.isEmpty():
        return kept
    names = docs.columns
    key = [F.col("doc_id").eqNullSafe(F.col("_id")), F.col("_content") == F.col("_of")]
    once = (kept.withColumn("_content", common.content())
            .join(twice.select(F.col("doc_id").alias("_id"), F.col("content").alias("_of")), key, "left_semi"))
    return common.without(kept, twice).unionByName(once.dropDuplicates(["doc_id", "_content"]).select(names))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate(docs, common.read(spark, sf_dir, "benchmark"))
    return common.without(docs, found.where("contaminated").select("doc_id", "content"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest(pack(docs))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = common.read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
