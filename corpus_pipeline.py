"""A training corpus from raw documents: language, near duplicates, benchmark passages, mixture, token files.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. What a stage writes for itself to the
shared folder is needed until its result is written, and goes when the next stage starts. Rows are dealt with by a place that
is written once with them, so null and repeated ids do no harm, and further columns of the documents pass through. A
table of decisions is broadcast only if its counted rows are few; otherwise both sides are shuffled by place.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.llm import contamination, language, mixing, near_duplicates, token_files
from pricefold.llm.common import freed, gathered, numbered, shared_folder, stored
from pricefold.llm.queries import END_ID, TOKENIZER, table

_PLACE = "place"
_FEW = 1_000_000
# Pieces of texts that a worker remembers while it encodes; the stages before it have left their mark on its memory.
_REMEMBERED = 200_000


_Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Folders of stages whose results may not be written yet.
_scratch: list[str] = []


def _tidy(stage: _Stage) -> _Stage:
    """A stage that first frees what the stages before it have left; ``docs`` must be read from a written table.

    A folder that ``docs`` itself still reads from, as where a result was passed on without writing it, stays.
    """

    @wraps(stage)
    def tidy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        freed(spark, _scratch, docs)
        with gathered(_scratch):
            return stage(spark, docs, sf_dir)

    return tidy


def _decided(docs: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    """Numbered documents joined with decisions by their place."""
    decisions = stored(decisions, "decisions")
    if decisions.count() <= _FEW:
        decisions = F.broadcast(decisions)
    return docs.join(decisions, _PLACE, how)


@_tidy
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language, and write the one found into ``lang``."""
    into = "identified"
    while into in docs.columns:
        into += "_"
    found = language.identified(docs, into=into).where(f"{into}.kept")
    return found.withColumn("lang", F.col(f"{into}.language")).select(*docs.columns)


@_tidy
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: that with the smallest id, or of equal and missing ids the first one."""
    docs = numbered(docs)
    texts = docs.select(_PLACE, "doc.doc_id", "doc.text")
    grouped = near_duplicates.near_duplicates(texts, seen_column=_PLACE).select("seen", "doc_id", "group")
    grouped = stored(grouped, "near-duplicate-groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "seen")
    kept = grouped.groupBy("group").agg(F.min_by("seen", order).alias("kept"), F.count("*").alias("n")).where("n > 1")
    gone = grouped.join(kept.select("group", "kept"), "group").where("seen != kept")
    return _decided(docs, gone.select(F.col("seen").alias(_PLACE)), "left_anti").select("doc.*")


@_tidy
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without an occurrence of a benchmark window."""
    docs = numbered(docs)
    texts, benchmark = docs.select(_PLACE, "doc.doc_id", "doc.text"), table(spark, sf_dir, "benchmark")
    found = contamination.contaminated(texts, benchmark, seen_column=_PLACE).where("contaminated")
    return _decided(docs, found.select(F.col("seen").alias(_PLACE)), "left_anti").select("doc.*")


@_tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, rounded; documents without words stay once."""
    docs = numbered(docs)
    taken = mixing.mixed(docs.select(_PLACE, "doc.doc_id", "doc.source", "doc.text"), seen_column=_PLACE)
    copies = F.when(F.col("size") == 0, 1).otherwise(F.round(F.col("taken") / F.col("size"))).cast("int")
    decided = _decided(docs, taken.select(F.col("seen").alias(_PLACE), copies.alias("copies")), "inner")
    return decided.select(F.explode(F.array_repeat("doc", F.col("copies"))).alias("doc")).select("doc.*")


@_tidy
def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, one row per document as read back from them."""
    return token_files.token_files(docs, public_tokenizers.path(TOKENIZER), END_ID, remembered=_REMEMBERED)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# SQL has no trigram models, signatures or tokenizers; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    freed(spark, _scratch, docs)
    return docs
