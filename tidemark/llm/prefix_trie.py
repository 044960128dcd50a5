"""Prefix trie of conversations: double-array tries per prefix shard, shared upper nodes merged globally.

A turn is known by a digest of its role and text; a conversation is the packed sequence of its turns' digests and
sizes, so texts are never shuffled.  Equal conversations are one path with a count, brought together in ranges of
(path, conv_id), so that a group of copies of any size is summed up by many tasks.  The distinct paths are then cut into
ranges of their order; a shard is a stretch of at most ``SHARD_TURNS`` turns in such a range.  Cutting between distinct
paths, wherever that is, keeps shards even: no first turn is too frequent.

In a shard, turns get dense numbers and the paths are packed into BASE and CHECK arrays level by level: a child of
state ``s`` by turn ``t`` is the cell ``BASE[s] + t`` with ``CHECK`` equal to ``s``.  Walking all paths through the
arrays gives the nodes and their sums.  Only nodes on a shard's first and last path can reach into another shard;
they leave it as partial sums by the digest of their prefix, two paths per shard.  Merged, each of these paths adds
the total of the nodes that it alone brings to the nodes it shares, which is linear in the length of the paths.

A node's text is turn number ``depth`` of conversation ``conv_id``.

Rows: a null role or text is empty; null turn numbers come first; turns of one number are ordered by their digests;
repeated turns are turns of their own; rows with a null conv_id are in no conversation and are left out; further
columns are not looked at; an empty table has no nodes.  One conversation's digests (24 bytes a turn) are held in a task, as
is one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.staging import staged

SHARD_TURNS = 200_000
CHUNK_IDS = 4096
TURN = np.dtype([("a", ">u8"), ("b", ">u8"), ("size", ">u8")])
NODE = ("kind int, shard binary, path binary, key binary, parent_key binary, conv_id long, depth long, "
        "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ends_sha256 string")
INTERIOR, TOP, SHARED = 0, 1, 2
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_lists(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` of every conversation: one string per turn in order, 32 hex digits of digest and 16 of size."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32)
    size = F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")
    return turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"),
                 F.concat(digest, size).alias("code")).alias("t")
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("t"))["code"].alias("turns"))


def crossed(lists: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Conversations whose first turns are those of their group's first one.

    Of conversation ``c`` the first ``h`` turns, h = crc32(c) modulo ``most``, are replaced by the first ``h`` turns of
    conversation ``c - c % group``, if there is one; at most ``group`` conversations read the same one (twice as many
    around zero).
    """
    lists = staged(lists, "trie-turns")
    heads = lists.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("_head"), F.slice("turns", 1, most - 1).alias("_turns"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    return lists.withColumn("_head", F.col("conv_id") - F.col("conv_id") % group).join(heads, "_head", "left").select(
        "conv_id", F.concat(
            F.when(h > 0, F.slice(F.coalesce("_turns", F.array().cast("array<string>")), F.lit(1), h)).otherwise(
                F.array().cast("array<string>")),
            F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


class DoubleArray:
    """BASE and CHECK over dense turn numbers, built from sorted distinct paths."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray) -> None:
        self.base, self.check = [0], [-2]
        self.low = 1
        sizes = np.diff(offsets)
        state = np.zeros(len(sizes), np.int64)
        for depth in range(int(sizes.max(initial=0))):
            rows = np.flatnonzero(sizes > depth)
            parent, code = state[rows], codes[offsets[rows] + depth]
            fresh = np.ones(len(rows), bool)  # rows of one prefix are neighbours
            fresh[1:] = (parent[1:] != parent[:-1]) | (code[1:] != code[:-1])
            starts = np.flatnonzero(fresh)
            cells = self._place(parent[starts].tolist(), code[starts].tolist())
            state[rows] = np.array(cells, np.int64)[np.cumsum(fresh) - 1]
        self.base, self.check = np.array(self.base, np.int64), np.array(self.check, np.int64)

    def _place(self, parents: list[int], codes: list[int]) -> list[int]:
        """Cells of the children of one level; children of one parent stand together."""
        out: list[int] = []
        k = 0
        while k < len(parents):
            stop = k
            while stop < len(parents) and parents[stop] == parents[k]:
                stop += 1
            own = codes[k:stop]
            base = self._free_base(own)
            self.base[parents[k]] = base
            for code in own:
                self.check[base + code] = parents[k]
                out.append(base + code)
            k = stop
        return out

    def _free_base(self, codes: list[int], tries: int = 64) -> int:
        least, spread = min(codes), max(codes) - min(codes)
        while self.low < len(self.check) and self.check[self.low] != -1:
            self.low += 1
        cell = self.low
        for _ in range(tries):
            self._grow(cell + spread + 1)
            if all(self.check[cell + c - least] == -1 for c in codes):
                return cell - least
            cell += 1
        cell = len(self.check)
        self._grow(cell + spread + 1)
        return cell - least

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.check.extend([-1] * more)
            self.base.extend([0] * more)

    def child(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """State after one turn; -1 where the trie has none."""
        cell = self.base[state] + code
        inside = (cell >= 0) & (cell < len(self.check))
        cell = np.where(inside, cell, 0)
        return np.where(inside & (self.check[cell] == state) & (state >= 0), cell, -1)


def dense_turns(turns: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of the turns from 0 on, in order of depth and path, so that siblings mostly get neighbouring numbers."""
    if not len(turns):
        return np.zeros(0, np.int64)
    names = np.stack([turns["a"].astype(np.uint64), turns["b"].astype(np.uint64)], 1)
    _, first, code = np.unique(names, axis=0, return_index=True, return_inverse=True)
    depth = np.arange(len(turns)) - np.repeat(offsets[:-1], np.diff(offsets))
    place = np.empty(len(turns), np.int64)
    place[np.argsort(depth, kind="stable")] = np.arange(len(turns))
    earliest = np.full(len(first), len(turns), np.int64)
    np.minimum.at(earliest, code.ravel(), place)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(earliest)] = np.arange(len(first))
    return rank[code.ravel()]


def prefix_keys(path: bytes) -> list[bytes]:
    """Digest of every prefix of a packed path, the empty one first."""
    digest = hashlib.sha256()
    out = [digest.digest()]
    for k in range(0, len(path), TURN.itemsize):
        digest.update(path[k:k + TURN.itemsize])
        out.append(digest.copy().digest())
    return out


def shard_nodes(paths: list[bytes], counts: list[int], firsts: list[int], ends: list[str]) -> pa.RecordBatch:
    """Nodes of one shard; ``paths`` are sorted and distinct."""
    turns = np.frombuffer(b"".join(paths), TURN)
    offsets = np.concatenate([[0], np.cumsum([len(p) // TURN.itemsize for p in paths])]).astype(np.int64)
    codes = dense_turns(turns, offsets)
    trie = DoubleArray(codes, offsets)
    lengths = np.diff(offsets)
    cells = len(trie.check)
    n, first = np.zeros(cells, np.int64), np.full(cells, np.iinfo(np.int64).max)
    depths, sizes = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    weight, least = np.array(counts, np.int64), np.array(firsts, np.int64)
    n[0], first[0] = weight.sum(), least.min()
    state = np.zeros(len(paths), np.int64)
    levels = []
    for depth in range(int(lengths.max(initial=0))):
        rows = np.flatnonzero(lengths > depth)
        at = offsets[rows] + depth
        state[rows] = trie.child(state[rows], codes[at])
        np.add.at(n, state[rows], weight[rows])
        np.minimum.at(first, state[rows], least[rows])
        depths[state[rows]], sizes[state[rows]] = depth + 1, turns["size"][at].astype(np.int64)
        levels.append(np.unique(state[rows]))
    ways = [[0, *walk(trie, codes[offsets[edge]:offsets[edge + 1]])] for edge in (0, len(paths) - 1)]
    is_shared = np.zeros(cells, bool)
    is_shared[ways[0] + ways[1]] = True
    own = (trie.check >= 0) & ~is_shared
    children = np.bincount(trie.check[own], minlength=cells)
    leaves = np.where(own & (children == 0), 1, 0)
    saved = np.where(own, (n - 1) * sizes, 0)
    for level in reversed(levels):
        level = level[own[level]]
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])
    ended = dict(zip(state.tolist(), ends))

    keys = [prefix_keys(paths[0]), prefix_keys(paths[-1])]
    name = keys[0][-1]
    key_of = {s: key for way, own_keys in zip(ways, keys) for s, key in zip(way, own_keys)}
    inner = np.flatnonzero(own)
    up = trie.check[inner]
    top = is_shared[up]
    out = {
        "kind": np.where(top, TOP, INTERIOR).tolist(), "shard": [name] * len(inner), "path": [None] * len(inner),
        "key": [None] * len(inner), "parent_key": [key_of[p] if t else None for p, t in zip(up.tolist(), top.tolist())],
        "conv_id": first[inner].tolist(), "depth": depths[inner].tolist(),
        "parent_conv_id": [None if t else p for p, t in zip(first[up].tolist(), top.tolist())],
        "n_convs": n[inner].tolist(), "n_children": children[inner].tolist(), "n_leaves": leaves[inner].tolist(),
        "saved_tokens": saved[inner].tolist(), "size": sizes[inner].tolist(),
        "ends_sha256": [ended.get(s, NO_ENDS) for s in inner.tolist()]}
    given: set[int] = set()
    for side, way in enumerate(ways[:1 if len(paths) == 1 else 2]):
        for depth, s in enumerate(way):
            mine = s not in given  # sums of a node on both paths are given once
            given.add(s)
            row = {"kind": SHARED, "shard": name, "path": name + bytes([side]), "key": keys[side][depth],
                   "parent_key": keys[side][depth - 1] if depth else None, "conv_id": int(first[s]) if mine else None,
                   "depth": depth, "parent_conv_id": None, "n_convs": int(n[s]) if mine else 0,
                   "n_children": int(children[s]) if mine else 0, "n_leaves": int(leaves[s]) if mine else 0,
                   "saved_tokens": int(saved[s]) if mine else 0, "size": int(sizes[s]),
                   "ends_sha256": ended.get(s) if mine else None}
            for column, value in row.items():
                out[column].append(value)
    kinds = {"kind": pa.int32(), "ends_sha256": pa.string()} | dict.fromkeys(("shard", "path", "key", "parent_key"), pa.binary())
    return pa.record_batch([pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()], names=list(out))


def walk(trie: DoubleArray, codes: np.ndarray) -> Iterator[int]:
    """States of one path after its first, second, ... turn."""
    state = np.zeros(1, np.int64)
    for k in range(len(codes)):
        state = trie.child(state, codes[k:k + 1])
        yield int(state[0])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``path, conv_id`` in order become ``path, conv_id, n, ids``: up to ``CHUNK_IDS`` ids of one path each."""
    path, held = None, []

    def given() -> tuple:
        return path, held[0], len(held), ",".join(map(str, held))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.record_batch([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()),
                                pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                               names=["path", "conv_id", "n", "ids"])

    for batch in batches:
        out = []
        for now, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (now != path or len(held) == CHUNK_IDS):
                out.append(given())
                held = []
            path = now
            held.append(conv)
        if out:
            yield batch_of(out)
    if held:
        yield batch_of([given()])


def _shards(shard_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        path, first, n, digest = None, 0, 0, None

        for batch in batches:
            for now, conv, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if now == path:
                    digest.update(b"," + ids.encode())
                    n += count
                    continue
                if path is not None:
                    rows.append((path, n, first, digest.hexdigest()))
                    size += 1 + len(path) // TURN.itemsize
                if size >= shard_turns:
                    yield shard_nodes(*map(list, zip(*rows)))
                    rows, size = [], 0
                path, first, n, digest = now, conv, count, hashlib.sha256(ids.encode())
        if path is not None:
            rows.append((path, n, first, digest.hexdigest()))
            yield shard_nodes(*map(list, zip(*rows)))

    return run


def prefix_trie(lists: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of ``lists(conv_id, turns)``, ``conv_id`` distinct and not null.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (over the subtree, (members - 1) times bytes of the last text), ``ends_sha256`` (of the members
    without a further turn).
    """
    paths = staged(lists.select(F.unhex(F.array_join("turns", "")).alias("path"), "conv_id"), "trie-paths")
    chunks = staged(paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(
        _chunks, "path binary, conv_id long, n long, ids string"), "trie-chunks")
    nodes = staged(chunks.repartitionByRange("path").sortWithinPartitions("path", "conv_id").mapInArrow(
        _shards(shard_turns), NODE), "trie-nodes")

    edges = nodes.filter(F.col("kind") == SHARED)
    merged = staged(edges.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("path").alias("rep"), F.first("depth").alias("depth"),
        F.first("size").alias("size"), F.min("conv_id").alias("conv_id"), F.max("ends_sha256").alias("ends_sha256"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]), "trie-merged")
    below = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("_children"))
    own = staged(
        merged.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("_children", F.lit(0)))
        .withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).drop("_children"), "trie-own")
    # A path brings the nodes below those it shares with earlier paths; their sums go up the whole path.
    brought = own.groupBy(F.col("rep").alias("path")).agg(F.sum("n_leaves").alias("_l"), F.sum("saved_tokens").alias("_s"))
    handed = edges.select("path", "key").join(own.select("key", "rep"), "key").filter("path <> rep").join(
        brought, "path").groupBy("key").agg(F.sum("_l").alias("_more_l"), F.sum("_s").alias("_more_s"))
    upward = Window.partitionBy("rep").orderBy(F.desc("depth"))
    summed = staged(
        own.withColumn("n_leaves", F.sum("n_leaves").over(upward)).withColumn("saved_tokens", F.sum("saved_tokens").over(upward))
        .join(handed, "key", "left").select(
            "key", "parent_key", "conv_id", "depth", "n_convs", "n_children",
            (F.col("n_leaves") + F.coalesce("_more_l", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_more_s", F.lit(0))).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")), "trie-summed")
    names = summed.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    upper = summed.join(names, "parent_key", "left").withColumn("parent_conv_id", F.col("_parent"))
    # The parents of a shard's topmost inner nodes, once per shard, so that no parent is a hot key.
    tops = nodes.filter(F.col("kind") == TOP).drop("parent_conv_id")
    parents = edges.select("shard", F.col("key").alias("parent_key")).distinct().join(names, "parent_key")
    lower = tops.join(parents, ["shard", "parent_key"]).withColumn("parent_conv_id", F.col("_parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return upper.select(columns).unionByName(lower.select(columns)).unionByName(
        nodes.filter(F.col("kind") == INTERIOR).select(columns))


# The same with every prefix written out as a string, for groups of five and nine remainders.
TRIE_SQL = r"""
WITH own AS (
  SELECT conv_id, list(sha256(coalesce(role, '') || chr(31) || coalesce(text, '')) || ':' || strlen(coalesce(text, ''))
                       ORDER BY turn NULLS FIRST) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
bits AS (
  SELECT conv_id, t, conv_id - conv_id % 5 AS head, CAST(conv_id AS VARCHAR) AS s FROM own),
hashed AS (
  SELECT conv_id, t, head, CAST(xor(list_reduce(
           list_transform(range(1, len(s) + 1), lambda i: CAST(ord(s[i]) AS BIGINT)),
           lambda a, c: list_reduce(range(0, 8), lambda x, y:
             CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(a, c)),
           4294967295::BIGINT), 4294967295) % 9 AS INTEGER) AS h
  FROM bits),
rebuilt AS (
  SELECT a.conv_id, coalesce(b.t[1:a.h], []) || a.t[a.h + 1:] AS t
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.head),
members AS (
  SELECT conv_id, d AS depth, array_to_string(t[1:d], '/') AS key, array_to_string(t[1:d - 1], '/') AS parent_key,
         d = len(t) AS ends, CASE WHEN d = 0 THEN 0 ELSE CAST(split_part(t[d], ':', 2) AS BIGINT) END AS size
  FROM (SELECT conv_id, t, unnest(generate_series(0, len(t))) AS d FROM rebuilt)),
nodes AS (
  SELECT key, depth, any_value(parent_key) AS parent_key, min(conv_id) AS conv_id, count(*) AS n_convs,
         max(size) * (count(*) - 1) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY key, depth),
children AS (SELECT parent_key, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (
  SELECT nodes.*, coalesce(c.n, 0) AS n_children
  FROM nodes LEFT JOIN children c ON c.parent_key = nodes.key AND c.depth = nodes.depth),
sums AS (
  SELECT m.key, m.depth, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM full_nodes f JOIN members m ON m.conv_id = f.conv_id AND m.depth <= f.depth GROUP BY m.key, m.depth)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums s USING (key, depth)
LEFT JOIN nodes p ON f.depth > 0 AND p.key = f.parent_key AND p.depth = f.depth - 1
"""
