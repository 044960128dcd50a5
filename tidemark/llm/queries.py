"""The registered queries of this package: thin uses of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.jobs.registry import Query
from tidemark.llm.alignment import alignment
from tidemark.llm.ann import nearest
from tidemark.llm.bpe import encode_digests, encode_lengths
from tidemark.llm.common import held_out, load
from tidemark.llm.decontaminate import LEAKS_SQL, contamination
from tidemark.llm.embedding_dedup import near_duplicates
from tidemark.llm.html_text import extract
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.langid import identify as identify_languages
from tidemark.llm.langid import learn as learn_languages
from tidemark.llm.mixing import MIX_SQL, mix
from tidemark.llm.prefix_trie import TRIE_SQL, crossed, prefix_trie, turn_lists
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.token_counts import length_histogram
from tidemark.llm.toxicity import toxicity
from tidemark.session import prepare

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_jaccard_join")
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets reach a Jaccard coefficient of 0.9."""
    return jaccard_components(load(spark, sf_dir, "documents"), width=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn_languages(docs, ~held_out(), sample_docs=400, slice_chars=400, sample_chars=48_000)
    return identify_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op6_mixing", MIX_SQL)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of weights 1, 2, 3 with at most three epochs takes of every document."""
    return mix(load(spark, sf_dir, "documents"), weights=[1, 2, 3], most_epochs=3, share=1.0, seed=42)


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them, as digests."""
    return encode_digests(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_ann")
def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors of every vector whose id is divisible by 20."""
    return nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op10_embedding_dedup")
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of one label with a cosine of 0.98 or more."""
    return near_duplicates(load(spark, sf_dir, "embeddings"), least=0.98)


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that remain of every document without strings of 400 bytes that start elsewhere too."""
    return remove_repeats(load(spark, sf_dir, "documents"), width=400)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, load(spark, sf_dir, "labels"), ~held_out(), most_labelled=20_000)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(load(spark, sf_dir, "pages"))


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of all documents' token counts, with what each length answers as a context limit."""
    lengths = encode_lengths(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return length_histogram(lengths)


@query("op13_decontamination", LEAKS_SQL)
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of ten words of a benchmark item."""
    return contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), width=10)


@query("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, each begun by its group's first one."""
    return prefix_trie(crossed(turn_lists(load(spark, sf_dir, "conversations"))))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's tokens under two tokenizers, and how common the linked pairs are."""
    return alignment(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                     public_tokenizers.path("piece_bpe_32k.model"))
