"""Alignment against the two libraries and a plain walk over byte offsets."""

import hashlib
import tracemalloc
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a string, links long"
NO_TOKENS = (0, 0, 0, 0, 0, 0, "")


def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), al._pair(A, B)


def plain(texts):
    a, b, pair = libraries()
    docs, counts = [], Counter()
    for doc, text in texts:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        if not text or any(b"".join(t[i] for i in ids) != whole for t, ids in ((pair.bytes_a, ids_a), (pair.bytes_b, ids_b))):
            docs.append((doc, None))
            continue
        ends = []
        for t, ids in ((pair.bytes_a, ids_a), (pair.bytes_b, ids_b)):
            at, own = 0, {}
            for k, i in enumerate(ids):
                at += len(t[i])
                own[at] = k
            ends.append(own)
        groups, links, x, y = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            i, j = ends[0][end], ends[1][end]
            groups.append(",".join(map(str, ids_a[x:i + 1])) + "|" + ",".join(map(str, ids_b[y:j + 1])))
            links.append((ids_a[i], ids_b[j]))
            x, y = i + 1, j + 1
        counts.update(links)
        docs.append((doc, (len(ids_a), len(ids_b), ";".join(groups), links)))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return sorted(((doc, *((d[0], d[1], len(d[3]), len(d[3]), sum(counts[p] == best[p[1]] for p in d[3]),
                            sum(counts[p] for p in d[3]), hashlib.sha256(d[2].encode()).hexdigest()) if d else NO_TOKENS))
                   for doc, d in docs), key=str)


def rows(spark, texts, **kwargs):
    frame = spark.createDataFrame([(*t, "x", 3) for t in texts], SCHEMA)
    return sorted((tuple(r) for r in al.alignment(frame, A, B, **kwargs).collect()), key=str)


def odd_texts(rng):
    alphabet = ["a", " ", "  ", "\n", "\t", "the", " cat", "é", "漢字", "🙂", "'s", "1", "23", "!", "<0x0A>", "<|endoftext|>",
                "<s>", " ", "\x1c", "\x85", "　", "ﬁ", "Ünder", "\x00", "é"]
    out = [(k, "".join(rng.choices(alphabet, k=rng.randint(1, 120)))) for k in range(60)]
    return out + [(70, None), (71, ""), (72, " "), (73, "a▁b"), (74, "\n"), (None, "no id"), (1, out[1][1]), (1, out[1][1]),
                  (75, "x" * 700), (76, "the " * 300), (77, " " * 90 + "a" + " " * 90), (78, "漢字仮名" * 80)]


def test_equals_the_libraries(spark, rng):
    texts = odd_texts(rng)
    assert rows(spark, texts) == plain(texts)


def test_parts_and_trees_change_nothing(spark, rng):
    texts = odd_texts(rng)
    for part in (5, 37):
        assert rows(spark, texts, part_chars=part) == plain(texts)


def test_composition_is_associative(rng):
    _, _, pair = libraries()
    for text in ["The quick brown fox; 12 cats' whiskers\n\nare naïve, 漢字! " * 3, "aaaa bbbb  cc" * 9]:
        (a, _), (b, _) = pair.a_tokens(" " + text, 0), pair.b_tokens(" " + text, 0)
        size = len((" " + text).encode())
        for _ in range(20):
            # Ranges of A and B need not be cut at the same bytes.
            cuts = [sorted(rng.sample(range(size), 4)) for _ in range(2)]
            parts = []
            for x, y in zip(zip([0, *cuts[0]], [*cuts[0], size]), zip([0, *cuts[1]], [*cuts[1], size])):
                parts.append(al.fragment(pair, *(tuple(v[(t[1] > r[0]) & (t[1] <= r[1])] for v in t) for t, r in ((a, x), (b, y)))))
            left = parts[0]
            for p in parts[1:]:
                left = al.compose(pair, left, p)
            right = parts[-1]
            for p in parts[-2::-1]:
                right = al.compose(pair, p, right)
            whole = al.fragment(pair, a, b)
            for f in (left, right):
                assert (f.text, f.n, f.links.tolist()) == (whole.text, whole.n, whole.links.tolist())
                assert [t.tolist() for t in (*f.pre_a, *f.pre_b, *f.suf_a, *f.suf_b)] == [
                    t.tolist() for t in (*whole.pre_a, *whole.pre_b, *whole.suf_a, *whole.suf_b)]


def test_groups_spell_the_text(spark):
    text = "Tokenizers disagree, 3.14 times a day.\nQuite naïvely."
    frame = spark.createDataFrame([(1, text, "", 0)], SCHEMA)
    got = al.align(frame, A, B, groups=True).first()
    _, _, pair = libraries()
    sides = [g.split("|") for g in got.groups.split(";")]
    for k, names in ((0, pair.bytes_a), (1, pair.bytes_b)):
        assert b"".join(names[int(i)] for s in sides for i in s[k].split(",")) == (" " + text).encode()
    assert all(b"".join(pair.bytes_a[int(i)] for i in x.split(",")) == b"".join(pair.bytes_b[int(i)] for i in y.split(","))
               for x, y in sides)


def test_packed_links(rng):
    for n, top in product((0, 1, 50), (5, 70_000, 324_000)):
        links = np.array([rng.randint(0, top) for _ in range(n)], np.int32)
        assert al.unpack(al.pack(links), n).tolist() == sorted(links.tolist())


def test_empty_table(spark):
    assert rows(spark, []) == []


def test_no_object_per_token():
    # Lists of ids, names and bytes took more time than the encoder of A, and 58, 74 and 96 bytes a token.
    _, _, pair = libraries()
    text = " The quick brown fox; 12 cats' whiskers\n\nare naïve, 漢字!" * 4000
    (a, same_a), (b, same_b) = pair.a_tokens(text, 0), pair.b_tokens(text, 0)
    assert same_a and same_b
    for step, most in ((lambda: pair.a_tokens(text, 0), 30), (lambda: pair.b_tokens(text, 0), 30),
                       (lambda: al.fragment(pair, a, b), 75)):
        tracemalloc.start()
        step()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * (len(a[0]) + len(b[0]))


def test_spelling_is_compared_in_every_block(monkeypatch):
    monkeypatch.setattr(al, "SPELT_TOKENS", 3)
    spelling = al._Spelling([b"a", b"", b"bc", "é".encode(), b"x"])
    ids = np.array([0, 2, 3, 1, 0, 0, 2, 4], np.int32)
    (got, ends), same = spelling.placed(ids, "abcéaabcx", 10)
    assert same and got.tolist() == ids.tolist() and ends.tolist() == [11, 13, 15, 15, 16, 17, 19, 20]
    for text in ("abcéaabcy", "xbcéaabcx", "abcèaabcx", "abcéaabc", "abcéaabcxx", ""):
        assert not spelling.placed(ids, text, 10)[1]
    assert spelling.placed(ids[:0], "", 0)[1] and not spelling.placed(ids[:0], "a", 0)[1]


def test_numbers_of_pairs(rng):
    _, _, pair = libraries()
    order = np.array(rng.sample(range(len(pair.keys)), 5000))
    assert pair.numbers(pair.keys).tolist() == list(range(len(pair.keys)))
    assert pair.numbers(pair.keys[order]).tolist() == order.tolist()
    other = pair.keys[order] ^ 1
    for key in other[~np.isin(other, pair.keys)][:50]:
        with pytest.raises(ValueError):
            pair.numbers(np.array([pair.keys[0], key, pair.keys[1]]))


def test_shared_ends(rng):
    for n, top, base in product((0, 1, 9), (12, 60), (0, 10**12)):
        for _ in range(20):
            x, y = (np.array(sorted(rng.sample(range(top), n)), np.int64) + base for _ in range(2))
            y += rng.choice((0, 0, 5, 200))
            expected = np.intersect1d(x, y, assume_unique=True, return_indices=True)[1:]
            assert [v.tolist() for v in al._shared(x, y)] == [v.tolist() for v in expected]
