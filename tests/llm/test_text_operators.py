import hashlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, html_text, langid, mixing, substring_dedup, suffixes, toxicity
from tidemark.llm.common import held_out
from tidemark.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, duck

PATH = public_tokenizers.path("byte_bpe_50k.json")


# Suffix arrays and repeated strings

@pytest.mark.parametrize("letters", [1, 2, 3, 26])
def test_suffix_array_and_common_prefixes(letters, rng):
    for _ in range(120):
        text = bytes(97 + rng.randrange(letters) for _ in range(rng.randint(0, 60)))
        text += text[:rng.randint(0, 30)]
        order = suffixes.suffix_array(np.frombuffer(text, np.uint8))
        wanted = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == wanted
        common = suffixes.permuted_common_prefixes(np.frombuffer(text, np.uint8), order)
        for a, b in zip(wanted, wanted[1:]):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert common[b] == n


def removed(rows, width):
    seen = Counter(t[k:k + width] for _, t in rows for k in range(len(t) - width + 1))
    out = []
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for k in range(len(text) - width + 1):
            if seen[text[k:k + width]] > 1:
                gone[k:k + width] = True
        edges = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc, len(text), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeats_match_brute_force(spark, rng, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    shared = ["".join(rng.choice("abcdefgh é") for _ in range(n)) for n in (39, 40, 41, 70, 150)]
    texts = ["".join(rng.choice([*shared, *("".join(rng.choice("ijklmnop ") for _ in range(25)) for _ in range(6))])
                     for _ in range(rng.randint(0, 6))) for _ in range(60)]
    texts += ["z" * 300, "xy" * 90, "", "z" * 39, texts[0], "z" * 41]
    rows = [(k, t.encode()) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(900, None, "x")], "doc_id long, text string, spans string")
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(df, width=40).collect())
    assert got == removed([*rows, (900, b"")], 40)


def test_repeats_of_the_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op9_suffix_dedup"](spark, sf_dir).collect()) == removed(rows, 400)


def test_repeats_of_an_empty_table(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# BPE

def test_tokens_match_the_library(spark, sf_dir):
    library = Tokenizer.from_file(PATH)
    wanted = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        wanted[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                               hashlib.sha256(text.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op7_bpe"](spark, sf_dir).collect()}
    assert got == wanted


def test_long_unsplit_texts_are_joined_exactly(spark, rng):
    library = Tokenizer.from_file(PATH)
    kinds = ["abcdefghij", "étüß日本", "0123456789", "!?'.", " \n\t", "<|endoftext|>", "'s 'll"]
    texts = ["".join("".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(1, 9))) * rng.choice([1, 1, 40])
                     if rng.random() < .8 else rng.choice(kinds) for _ in range(rng.randint(1, 14))) for _ in range(60)]
    texts += ["a" * 5000, "ab" * 900, " " * 700, "", "x" + " " * 300 + "y", texts[0]]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(99, None), (0, texts[0])], "doc_id long, text string")
    got = bpe.encode(df, PATH, long_chars=20, part_chars=9).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = texts[r["doc_id"]] if r["doc_id"] != 99 else ""
        assert r["ids"] == library.encode(text, add_special_tokens=False).ids


# Language ID

@pytest.mark.parametrize("dense", [langid.DENSE, 0])
def test_automaton_accepts_exactly_the_substrings(rng, dense):
    text = [rng.randrange(2, 5) for _ in range(60)]
    automaton = langid.suffix_automaton(text, 5, dense)
    known = {tuple(text[a:b]) for a in range(60) for b in range(a + 1, 61)}
    for _ in range(500):
        word = [rng.randrange(2, 5) for _ in range(rng.randint(1, 7))]
        state = 0
        for s in word:
            state = int(automaton.after(np.array([state]), np.array([s]))[0]) if state >= 0 else -1
        assert (state >= 0) == (tuple(word) in known)


@pytest.mark.parametrize("dense", [langid.DENSE, 0])
def test_phrases_are_longest_matches(rng, dense):
    text = [rng.randrange(2, 6) for _ in range(50)]
    joined, table = "".join(map(str, text)), langid.suffix_automaton(text, 6, dense)
    words = [np.array([rng.randrange(2, 6) for _ in range(rng.randint(0, 700))], np.uint8) for _ in range(20)]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    counts = langid.phrase_counts(np.concatenate(words), offsets, [table])[:, 0]
    for word, count in zip(words, counts):
        wanted = 0
        for a in range(0, len(word), langid.SPAN):
            rest = "".join(map(str, word[a:a + langid.SPAN].tolist()))
            while rest:
                n = max([k for k in range(1, len(rest) + 1) if rest[:k] in joined], default=1)
                rest, wanted = rest[n:], wanted + 1
        assert count == wanted


def test_language_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op4_language_id"](spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.95 * got.count()


def test_language_of_odd_rows(spark):
    rows = [(k, t, g) for k in range(40) for t, g in (("the house and the garden " * 3, "en"), ("das haus und der garten " * 3, "de"))]
    odd = [(500, None, "en"), (501, "", None), (502, "12 !?", "en"), (503, "日本", None), (504, "Das Haus", None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.language_id(df, ~held_out()).filter("doc_id >= 500").collect()}
    assert [got[k]["lang_pred"] for k in (500, 501, 502)] == ["und"] * 3
    assert got[504]["lang_pred"] == "de" and all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.language_id(df.limit(0), ~held_out()).collect() == []


def test_languages_of_thousands_of_letters(spark, rng):
    scripts = {"zh": range(0x4e00, 0x4e00 + 2500), "ko": range(0xac00, 0xac00 + 2500), "en": range(97, 123)}

    def text(letters, size):
        return "".join(chr(rng.choice(letters)) if rng.random() < 0.8 else " " for _ in range(size))

    pool = {g: [text(letters, 12) for _ in range(150)] for g, letters in scripts.items()}
    rows = [(k, " ".join(rng.choice(pool[g]) for _ in range(40)), g) for k in range(60) for g in scripts]
    longest = "".join(rng.choice(pool["zh"]) + " " for _ in range(20_000))
    odd = [(500, "привет как дела " * 9, None), (501, longest, None), (None, rng.choice(pool["ko"]), None), (503, pool["en"][0], None)]
    df = spark.createDataFrame([(*r, 1.5) for r in rows + odd + odd[-1:]], "doc_id long, text string, lang string, score double")
    got = [r for r in langid.language_id(df, ~held_out()).collect() if r["doc_id"] is None or r["doc_id"] >= 500]
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 5 and by[500]["phrase_rate"] > 0.8
    assert (by[501]["lang_pred"], by[None]["lang_pred"], by[503]["lang_pred"]) == ("zh", "ko", "en")
    # Every script has its own symbols, so a text of one is no run of phrases of another.
    assert all(r["phrase_rate"] < 0.5 for r in got if r["doc_id"] != 500)


# Toxicity

def test_viterbi_restores_disguised_words():
    words = Counter({"idiot": 50, "stupid": 50, "the": 400, "and": 300, "toad": 20, "letter": 40})
    counts = np.full((toxicity._WIDTH,) * 3, 0.01)
    for word, n in words.items():
        symbols = [1, 1, *[toxicity._NUMBER[c] for c in word], 1]
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            counts[a, b, c] += n
    restorer = toxicity.Restorer(-np.log(counts / counts.sum(axis=2, keepdims=True)))
    for written, meant in [("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiiiiooot", "idiot"), ("$tup!d", "stupid"),
                           ("id*ot", "idiot"), ("i-d-1-0-t", "idiot"), ("letter", "letter")]:
        assert meant in restorer.words(written), written
    assert any(t == "idiot" for t in toxicity._tokens("you i d i o t"))


def test_toxicity_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = QUERIES["op2_toxicity"](spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").cache()
    toxic, clean = got.filter("toxic = 1"), got.filter("toxic = 0")
    assert toxic.filter("predicted = 1").count() >= 0.9 * toxic.count()
    assert clean.filter("predicted = 1").count() <= 0.02 * clean.count()


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, none, ~held_out()).collect()
    assert [r["score"] for r in got] == [0.5] * 3
    assert toxicity.toxicity(docs.limit(0), none, ~held_out()).collect() == []


# Mixing

def test_mix_matches_sql(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    assert compare(QUERIES["op6_mixing"](spark, sf_dir), duck(sf_dir), ORACLES["op6_mixing"]) is None


def test_mix_of_odd_rows(spark):
    rows = [(1, "a b", "s", 1), (1, "a b", "s", 1), (2, None, "s", 1), (3, "a " * 50, None, 1), (4, "", "t", 1),
            (5, "x " * 500, "u", 1), (None, "q w", "v", 1)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, target int")).collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert abs(sum(r["taken"] for r in got) - sum(r["size"] for r in got)) <= 4
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []


# HTML

ARTICLE = "<h1>Title</h1><p>First, a <b>long</b>er paragraph with words; and more of them.<p>Second&nbsp;one &amp; last, it is.</p>"
TEXT = "Title First, a longer paragraph with words; and more of them. Second one & last, it is."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p></p>", ""), ("<script>var a='<p>x</p>'</script>", ""),
    (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href='/'>Home</a></nav><div class=\"ad\">Buy, now.</div>"
     f"<article>{ARTICLE}</article><footer>&copy; us</footer></body></html>", TEXT),
    (f"<div class='menu'>a, b</div><div id=main>{ARTICLE}<div class='comments'><p>I say, no.</p></div></div><form>Name</form>", TEXT),
    ("<p>unclosed <b>bold<br>next", "unclosed bold next"), ("<p>a<!-- x --> b</i></p>", "a b")])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("long", ["<p>{}</p>", "<p><b>{}</b></p>", "<ul><li>{}</li></ul>", "<h2>{}</h2>", "<blockquote><p>{}</p></blockquote>"])
def test_one_long_block_is_not_the_article(long):
    words = "many words, and more. " * 60
    page = f"<body><div class=ad>Buy.</div><article><h1>Title</h1><p>Short, one.</p>{long.format(words)}<p>Last.</p></article></body>"
    assert html_text.main_text(page) == " ".join(f"Title Short, one. {words} Last.".split())


class _Article(HTMLParser):
    """All text between the article tags, blocks and line breaks set apart."""

    def __init__(self):
        super().__init__()
        self.inside, self.parts = False, []

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        self.parts.append("" if tag in html_text.INLINE else " ")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        self.parts.append("" if tag in html_text.INLINE else " ")

    def handle_data(self, data):
        self.parts.append(data if self.inside else "")


def test_the_whole_article_of_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in pages:
        reader = _Article()
        reader.feed(r["html"])
        reader.close()
        assert html_text.main_text(r["html"]) == " ".join("".join(reader.parts).split()), r["page_id"]


def test_extract_keeps_every_page(spark, sf_dir):
    got = QUERIES["op8_html_extraction"](spark, sf_dir)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert got.count() == pages.count() and got.filter(F.length("text") != F.col("n_chars")).isEmpty()


def test_mix_deals_words_out_among_equal_documents(spark):
    rows = [(None, "w " * 7, "a", "x")] * 40 + [(None, "v " * 7, "a", "y")] * 3 + [(5, "u " * 11, "b", "z")] + [(6, None, "b", "z")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, taken string")
    for weights in ([1, 2, 3], [1, 9], [5, 1]):
        for keep in ((), ("text", "source")):
            got = mixing.mix(docs, weights=weights, keep=keep).collect()
            assert len(got) == len(rows)
            by_source = {}
            for r in got:
                assert 0 <= r["taken"] <= 3 * r["size"]
                by_source.setdefault(r["source_size"], [r["target"], 0])[1] += r["taken"]
            assert all(abs(target - taken) <= 0.5 for target, taken in by_source.values())
            if keep:
                assert sorted((r["text"] or "") for r in got) == sorted((t or "") for _, t, _, _ in rows)
