from collections import Counter

import corpus_pipeline as pipeline
from tests.llm.test_jaccard_join import shingles
from tidemark.llm.substring_dedup import remove_repeats


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "src0", 0), (9002, "12 34 !", "en", "src0", 7)], docs.schema)
    first = pipeline.known_language(spark, docs.unionByName(odd), sf_dir).cache()
    assert first.columns == docs.columns and first.filter("doc_id > 9000").isEmpty()
    assert first.count() >= 0.99 * docs.count()
    kept = pipeline.one_of_near_copies(spark, first, sf_dir).cache()
    sets = [shingles(r["text"], 5) for r in kept.collect()]
    for i, a in enumerate(sets):
        for b in sets[i + 1:]:
            inter = len(a & b)
            assert not inter or 100 * inter < 80 * (len(a) + len(b) - inter)
    clean = pipeline.without_repeats(spark, kept, sf_dir).cache()
    assert clean.columns == docs.columns and clean.filter("length(text) <> n_chars").isEmpty()
    mixed = pipeline.mixed_sources(spark, clean, sf_dir)
    assert mixed.columns == docs.columns and mixed.join(clean, "doc_id", "left_anti").isEmpty()


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []
        if docs.columns != list(pipeline.COLUMNS):
            break


def test_run_returns_the_last_stage(spark, sf_dir):
    assert pipeline.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def _sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(n))


def test_repeated_rows_and_null_ids_stay_once(spark, sf_dir, rng):
    twice, unnamed, near, alone, shared = (_sentence(rng, 150) for _ in range(5))
    changed = near + " one more"
    rows = [(1, twice), (1, twice), (None, unnamed), (None, unnamed), (None, near), (None, changed), (7, changed),
            (8, alone), (9, shared), (9, _sentence(rng, 150)), (10, shared)]
    docs = spark.createDataFrame([(k, t, "en", "src0", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.one_of_near_copies(spark, docs, sf_dir).cache()
    want = sorted([(1, twice), (None, unnamed), (7, changed), (8, alone), rows[8], rows[9]], key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == want
    clean = pipeline.without_repeats(spark, kept, sf_dir).cache()
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == want
    mixed = pipeline.mixed_sources(spark, clean, sf_dir).cache()
    assert {r["doc_id"] for r in mixed.collect()} == {1, None, 7, 8, 9}
    assert {r["doc_id"] for r in pipeline.tokens(spark, mixed, sf_dir).collect()} == {1, None, 7, 8, 9}


def test_passages_of_over_50_words_go(spark, sf_dir, rng):
    def short(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 3))) for _ in range(n))

    passage, under, long = short(51), short(50), _sentence(rng, 20).replace(" ", "") * 4
    own = [_sentence(rng, 60) for _ in range(12)]
    texts = [f"{own[0]} {passage} {own[1]}", f"{own[2]}\n{passage.replace(' ', '  ')}\n{own[3]}",
             f"{own[4]} {under} {own[5]}", f"{own[6]} {under} {own[7]}", passage, f"\n{passage}\n",
             f"{own[8]} {long} {own[9]}", f"{own[10]} {long} {own[11]}"]
    assert len(passage) < 250 and len(long) > 400
    docs = spark.createDataFrame([(k, t, "en", "src0", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"].split() for r in pipeline.without_repeats(spark, docs, sf_dir).collect()}
    for k in (6, 7):  # bytes, with the spaces around them
        assert long[:40] not in (kept := " ".join(got.pop(k))) and kept.startswith(texts[k][:300]) and kept.endswith(texts[k][-300:])
    want = {k: " ".join(t.split()).replace(passage, "").split() for k, t in enumerate(texts[:6])}
    assert got == {k: w for k, w in want.items() if w}


def test_repeated_words_match_brute_force(spark, rng):
    parts = [[rng.choice("abc") for _ in range(n)] for n in (3, 4, 5, 6, 9, 15)]
    texts = [sum((rng.choice([*parts, [rng.choice("defghijk") for _ in range(3)]]) for _ in range(rng.randint(0, 5))), [])
             for _ in range(40)] + [["a"] * 30, ["a", "b"] * 9]
    seen = Counter(tuple(t[k:k + 6]) for t in texts for k in range(len(t) - 5))
    want = {}
    for doc, t in enumerate(texts):
        gone = {j for k in range(len(t) - 5) if seen[tuple(t[k:k + 6])] > 1 for j in range(k, k + 6)}
        want[doc] = [w for j, w in enumerate(t) if j not in gone]
    df = spark.createDataFrame([(k, rng.choice([" ", "\n "]).join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = remove_repeats(df, width=400, kept_text=True, words=6).collect()
    assert {r["doc_id"]: r["kept"].split() for r in got} == want
