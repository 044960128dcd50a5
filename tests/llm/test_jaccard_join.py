import re

import pytest

from tidemark.llm import jaccard_join as J
from tidemark.llm.queries import QUERIES


def shingles(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(rows, percent=90):
    sets = {}
    for doc, text in rows:
        sets[doc] = shingles(text)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, note string")
    got = J.jaccard_components(df, **options).collect()
    assert len(got) == len(rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


def test_whole_table_matches_all_pairs(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in QUERIES["op1_jaccard_join"](spark, sf_dir).collect()}
    assert got == brute(rows)


def test_near_copies_chains_and_borderline_pairs(spark, rng, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 7)  # long posting lists are cut into tiles
    vocabulary = [f"w{k}" for k in range(300)]
    rows, doc = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 14)):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((doc, " \t".join(words) + rng.choice(["", " ", "\n"]), "x"))
            doc += 1
    assert run(spark, rows) == brute([r[:2] for r in rows])


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (4, "One", None), (5, "one", "d"), (6, "one two", "e"),
            (7, "ONE  two\v", "f"), (8, "a b c", "g"), (9, "a b c a b c", "h"), (10, "É b c", "i"), (11, "é b c", "j")]
    assert run(spark, rows) == brute([r[:2] for r in rows])


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e", "x")] * 3 + [(2, "a b c d e", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string")
    got = J.jaccard_components(df).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1)] * 3 + [(2, 1)]
    assert J.jaccard_components(df.limit(0)).collect() == []


@pytest.mark.parametrize("size", [1, 2, 9, 10, 11, 40])
def test_prefix_covers_the_needed_matches(size, rng):
    import numpy as np
    tokens = np.sort(np.array([rng.getrandbits(64) for _ in range(size)], np.uint64))
    prefix, matches = J.choose_prefix(tokens, np.ones(2 * J.SKETCH, np.float32), 90)
    assert matches >= 1 and len(prefix) == size - J.need(size, 90) + matches
