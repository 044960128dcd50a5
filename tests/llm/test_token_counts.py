from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import token_counts
from tidemark.llm.queries import QUERIES


def check(got, lengths):
    rows = {r["n_tokens"]: r for r in got}
    assert {n: r["documents"] for n, r in rows.items()} == Counter(lengths)
    for n, r in rows.items():
        assert r["documents_longer"] == sum(x > n for x in lengths)
        assert r["tokens_longer"] == sum(x for x in lengths if x > n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths)
        assert abs(r["quantile"] - sum(x <= n for x in lengths) / len(lengths)) < 1e-12
        assert r["total_tokens"] == sum(lengths) and r["tokens"] == n * r["documents"]


def test_whole_table(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = [len(library.encode(r["text"] or "", add_special_tokens=False).ids)
               for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op3_token_counts"](spark, sf_dir).collect(), lengths)


def test_buckets_limits_and_empty(spark, rng, monkeypatch):
    monkeypatch.setattr(token_counts, "BUCKET_LENGTHS", 7)
    lengths = [rng.randint(3, 60) for _ in range(200)] + [500]
    df = spark.createDataFrame([(n, "x") for n in lengths], "n_tokens long, tokens string").select("n_tokens")
    histogram = token_counts.length_histogram(df)
    check(histogram.collect(), lengths)
    limits = [0, 1, 3, 10, 61, 499, 500, 9999]
    for r in token_counts.at_limits(histogram, limits).collect():
        assert r["truncated_tokens"] == sum(min(x, r["limit"]) for x in lengths)
        assert r["documents_longer"] == sum(x > r["limit"] for x in lengths)
    assert token_counts.length_histogram(df.limit(0)).collect() == []
