"""A corpus pipeline over ``documents``: language, near copies, repeated passages, source mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes every result as Parquet to the
shared folder and reads it again as the next stage's documents.  All stages but the last return the columns of
``documents``.  No stage looks at its predecessors' decisions, only at the documents they kept.

A stage's intermediate tables are needed until its result is written; they are deleted when the next stage, whose
documents are then files, begins.

Rows: null and empty texts have no language and go in the first stage; of repeated rows and near copies, with or
without ids, the second stage keeps one; an empty table stays empty throughout; further columns are not carried along.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import encode_digests
from tidemark.llm.common import held_out, prepare_texts, rows_apart, rows_of
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.langid import identify, learn
from tidemark.llm.mixing import WORD, mix
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.plans.staging import Scratch, staged
from tidemark.session import prepare

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text whose best language still needs a phrase for less than every second symbol is in none of them.
MOST_PHRASES = 0.5
# Words of the shortest passage that may not repeat.
LEAST_PASSAGE = 51

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_scratch, _results = Scratch(), Scratch()


def stage(fn: Stage) -> Stage:
    """A stage that first deletes what its predecessors staged, but for what its documents still read."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _scratch.release(spark, reading=docs)
        with _scratch.collecting():
            return fn(spark, docs, sf_dir)

    return run_stage


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without letters or in no language go."""
    prepare_texts(spark)
    docs = docs.select(*COLUMNS)
    model = learn(docs.select("doc_id", "text", "lang"), ~held_out(), sample_docs=400, slice_chars=400, sample_chars=48_000)
    return identify(docs, model).filter(
        (F.col("lang_pred") != "und") & (F.col("phrase_rate") <= MOST_PHRASES)).select(*COLUMNS)


@stage
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every component of the similarity join (five-word shingles, 0.8): the least document, null ids last.

    Rows are told apart by a hash of all columns, so ids may be null or repeated; rows that are equal are one row.
    """
    prepare_texts(spark)
    rows = docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("_row"))
    linked = jaccard_components(rows.select(F.col("_row").alias("doc_id"), "text"), width=5, percent=80)
    linked = staged(linked.groupBy(F.col("doc_id").alias("_row")).agg(
        F.min("component_id").alias("component"), F.count(F.lit(1)).alias("copies")), "pipeline-linked")
    least = linked.join(rows.select("_row", "doc_id").distinct(), "_row").groupBy("component").agg(
        F.min_by("_row", F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("_row"))
    others = linked.join(least, "_row", "left_anti").select("_row")
    repeated = staged(linked.filter("copies > 1").join(least, "_row", "left_semi").select("_row"), "pipeline-repeated")
    gone = staged(others.unionByName(repeated), "pipeline-gone")
    hit, once = rows_apart(rows, gone, "_row")  # most texts are not shuffled
    kept = hit.join(gone.withColumn("_gone", F.lit(True)), "_row", "left").filter("_gone is null").drop("_gone")
    once = once.unionByName(kept)
    return once.unionByName(rows_of(rows, repeated, "_row").dropDuplicates(["_row"])).select(*COLUMNS)


@stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of over 50 words and the strings of 400 bytes that start elsewhere too; what is
    left blank goes."""
    prepare_texts(spark)
    cleaned = remove_repeats(docs, width=400, keep=("lang", "source"), kept_text=True, words=LEAST_PASSAGE)
    return cleaned.filter((F.col("n_removed") == 0) | F.col("kept").rlike(WORD)).select(
        "doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


@stage
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one cut document of a source keeps its first words."""
    taken = mix(docs, weights=[1, 2, 3], most_epochs=3, share=1.0, seed=42, keep=("text", "lang", "source"))
    copies = taken.filter("taken > 0").withColumn("part", F.explode(F.expr(
        "transform(sequence(1L, cast(ceil(taken / size) as bigint)), k -> least(size, taken - (k - 1) * size))")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return copies.withColumn(
        "text", F.when(F.col("part") < F.col("size"), F.array_join(F.slice(words, 1, F.col("part").cast("int")), " "))
        .otherwise(F.col("text"))).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix, encoded and decoded again."""
    prepare_texts(spark)
    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_near_copies),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed_sources),
    ("BPE encoding and decoding", tokens),
]

# Suffix automata, suffix arrays and BPE are beyond SQL: the pipeline is tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        with _results.collecting():
            docs = staged(apply(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
        _results.release(spark, reading=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
