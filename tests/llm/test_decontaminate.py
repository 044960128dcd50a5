"""Decontamination against a plain search for every window."""

import hashlib
import re

from pyspark.sql import functions as F

from tidemark.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, source string", "item_id long, text string, text2 string"


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, width):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(width, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[k:k + size]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                held = windows.get(tuple(words[k:k + size]))
                if held:
                    hit.update(range(k, k + size))
                    found |= held
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def rows(spark, docs, items, width, **kwargs):
    result = d.contamination(spark.createDataFrame([(*x, "s") for x in docs], DOCS),
                             spark.createDataFrame([(*x, "t") for x in items], ITEMS), width, **kwargs)
    return sorted((tuple(r) for r in result.collect()), key=str)


def random_case(rng, alphabet):
    items = [(rng.choice([k, k, 3, None]), " ".join(rng.choices(alphabet, k=rng.randint(0, 30)))) for k in range(25)]
    items += [(100, None), (101, ""), (102, " ,; "), (103, items[0][1])]
    docs = [(k, " ".join(rng.choices(alphabet, k=rng.randint(0, 60)))) for k in range(80)]
    for k in range(40):
        words = words_of(items[k % len(items)][1])
        a = rng.randint(0, max(len(words) - 3, 0))
        docs.append((200 + k, "Ünder. " + "; ".join(words[a:a + rng.randint(1, 25)]).upper() + "!x9 z"))
    return docs + [(500, None), (501, ""), (None, items[1][1]), (1, docs[1][1]), (1, docs[1][1])], items


def test_equals_plain_search(spark, rng):
    for alphabet in (["a", "b"], ["a", "bé", "c1", "d", "漢字"], [f"w{k}" for k in range(40)]):
        docs, items = random_case(rng, alphabet)
        assert rows(spark, docs, items, 4) == plain(docs, items, 4)


def test_several_shards_and_passes(spark, rng, monkeypatch):
    docs, items = random_case(rng, ["a", "b", "c", "d"])
    monkeypatch.setattr(d, "SHARDS_AT_ONCE", 2)
    assert rows(spark, docs, items, 5, shard_words=60) == plain(docs, items, 5)


def test_long_text_is_streamed_in_stretches(spark, rng, monkeypatch):
    monkeypatch.setattr(d, "PIECE_BYTES", 97)
    items = [(k, " ".join(rng.choices("abcdef", k=rng.randint(3, 20)))) for k in range(9)]
    docs = [(1, " ".join(rng.choices("abcdefgh", k=5000))), (2, "x" * 1000 + " " + items[0][1] + " " + "y" * 500)]
    assert rows(spark, docs, items, 10) == plain(docs, items, 10)


def test_empty_tables(spark):
    assert rows(spark, [], [(1, "a b")], 10) == []
    assert rows(spark, [(1, "a b c")], [], 10) == plain([(1, "a b c")], [], 10)


def test_automaton_accepts_exactly_the_substrings(rng):
    for _ in range(30):
        texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 12))] for _ in range(4)]
        scanner = d.Scanner(d.Automaton([(str(k), t) for k, t in enumerate(texts)], 3))
        inside = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        for _ in range(100):
            probe = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 8))]
            state = 0
            for w in probe:
                state = scanner.step(state, scanner.a.known.get(w, 99)) if state >= 0 else -1
            assert (state >= 0) == (tuple(probe) in inside)


def test_long_spans_are_cut_and_covered_documents_left_out(spark):
    leak = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = [(1, f"Before, {leak}. After " + "and more words here " * 5), (2, leak), (3, "a clean one"), (4, None)]
    out = d.remove_spans(spark.createDataFrame([(*x, "s") for x in docs], DOCS),
                         spark.createDataFrame([(7, leak, "")], ITEMS), 10, keep=("source",))
    found = {r.doc_id: r for r in out.collect()}
    assert set(found) == {1, 3, 4}
    assert found[1].text == "Before, . After " + "and more words here " * 5
    assert (found[1].longest, found[3].text, found[4].text, found[1].source) == (14, "a clean one", None, "s")


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b c", 5, ["x"])], "doc_id long, text string, n_words int, items array<string>")
    items = spark.createDataFrame([(1, "a b", "w")], "item_id long, text string, words string")
    assert d.contamination(frame, items).filter(F.col("contaminated")).count() == 1
