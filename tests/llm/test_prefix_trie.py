"""Prefix trie against a plain dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np

from tidemark.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string, depth int, n_convs string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(lists):
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in lists.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))

    below = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len((node[-1][1] if node else "").encode())
        below[node] = (max(1, sum(below[c][0] for c in children[node])), own + sum(below[c][1] for c in children[node]))
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(lists[c]) == len(node)))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]),
                    *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def ordered(rows):
    lists = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            lists[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for conv, turns in lists.items()}


def rebuilt(lists):
    out = {}
    for conv, turns in lists.items():
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = lists.get(conv - conv % 5, [])[:h] + turns[h:]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)


def nodes(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def conversations(rng, count, texts, most=7):
    rows = []
    for conv in rng.sample(range(count * 3), count):
        for turn in range(rng.randint(1, most)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(texts)))
    return rows


def test_equals_a_dictionary_of_prefixes_whatever_the_shards(spark, rng):
    for texts in (["a"], ["a", "bé", ""], [f"text {k}" for k in range(60)]):
        rows = conversations(rng, 60, texts)
        lists = ordered(rows)
        for size in (1, 5, 40, 10_000):
            assert nodes(p.prefix_trie(p.turn_lists(frame(spark, rows)), size)) == plain(lists)


def test_crossed_conversations(spark, rng):
    rows = conversations(rng, 150, ["a", "b", "c"], 12)
    assert nodes(p.prefix_trie(p.crossed(p.turn_lists(frame(spark, rows))), 30)) == plain(rebuilt(ordered(rows)))


def test_many_copies_end_in_one_node(spark, monkeypatch):
    monkeypatch.setattr(p, "CHUNK_IDS", 7)
    rows = [(c, t, "user", f"t{t}") for c in range(3, 203) for t in range(3)] + [(1000, t, "user", f"t{t}") for t in range(2)]
    got = nodes(p.prefix_trie(p.turn_lists(frame(spark, rows)), 2))
    assert got == plain(ordered(rows)) and len(got) == 4


def test_nulls_repeats_and_turnless(spark):
    # A null turn number is first; conversation 5's copy of missing turns leaves some without turns.
    rows = [(1, 2, None, "x"), (1, None, "user", None), (1, None, "user", None), (2, 1, "user", "y"), (2, 1, "user", "y"),
            (None, 1, "user", "lost"), (7, 0, "user", "z"), (-3, 1, "user", "é" * 50)]
    assert nodes(p.prefix_trie(p.turn_lists(frame(spark, rows)))) == plain(ordered(rows))
    lists = rebuilt(ordered(rows) | {})
    fixed = {c: t for c, t in lists.items() if c >= 0}
    kept = [r for r in rows if r[0] is None or r[0] >= 0]
    assert nodes(p.prefix_trie(p.crossed(p.turn_lists(frame(spark, kept))))) == plain(fixed)
    assert any(not t for t in fixed.values())


def test_empty_table(spark):
    assert nodes(p.prefix_trie(p.crossed(p.turn_lists(frame(spark, []))))) == []


def test_one_very_long_conversation(spark):
    rows = [(1, t, "user", str(t % 3)) for t in range(3000)] + [(2, t, "user", str(t % 3)) for t in range(2990)]
    got = nodes(p.prefix_trie(p.turn_lists(frame(spark, rows)), 100))
    assert len(got) == 3001 and got == plain(ordered(rows))


def test_double_array_holds_exactly_the_paths(rng):
    for _ in range(20):
        paths = sorted({tuple(rng.randint(0, 9) for _ in range(rng.randint(0, 5))) for _ in range(80)})
        codes = np.array([c for path in paths for c in path], np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in paths])])
        trie = p.DoubleArray(codes, offsets)
        prefixes = {path[:d] for path in paths for d in range(len(path) + 1)}
        seen = {}
        for _ in range(300):
            probe = tuple(rng.randint(0, 9) for _ in range(rng.randint(0, 5)))
            state = 0
            for code in probe:
                state = int(trie.child(np.array([state]), np.array([code]))[0]) if state >= 0 else -1
            assert (state >= 0) == (probe in prefixes)
            if state >= 0:
                assert seen.setdefault(state, probe) == probe
