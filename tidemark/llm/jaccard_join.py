"""Similarity join of texts by the Jaccard coefficient of their word shingles, with adaptive multi-match prefixes.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their shingle sets A and B.

1. A fixed-size frequency sketch over all documents orders the shingles from rare to common.
2. Equal sets are one class, represented by its least document.
3. A class indexes a prefix of its ordered shingles.  The first ``|A| - need + l`` of them share at least ``l`` with
   any partner that chose the same ``l``; ``l`` is chosen per document so that the estimated cost of reading postings
   and of verifying candidates, which falls with ``l``, is least.  Two documents need ``min(l, l')`` common prefix
   shingles, since the longer prefix contains the shorter choice.
4. Parity bitmaps, whose Hamming distance never exceeds the sets' difference, rule out most pairs of a posting list.
   Classes without any remaining partner are done; the others get finer bitmaps.  Each one's nearest partner, then its
   nearest one in another component, is verified on the whole texts for a few rounds, which joins groups of copies;
   then every pair that shares enough prefix shingles and is still in two components is verified.  Only pairs inside
   one component stay unexpanded: they cannot change a component.

Rows: a null or word-less text has an empty set and links with nothing.  Rows that share a doc_id count as one
document; a null doc_id links with nothing.  Only ``doc_id`` and ``text`` are read, so further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, long_array, pieces, rows_of
from tidemark.llm.components import components
from tidemark.llm.wordhash import mix, set_digest, shingle_sets
from tidemark.plans.staging import staged, unstage

PIECE = 1 << 18          # bytes of text hashed at a time
SKETCH = 1 << 16         # counters of each sketch row: its size does not grow with the data
MOST_MATCHES = 6         # largest l a document may choose
VERIFY_COST = 40.0       # cost of verifying one candidate, in postings read
SCAN_ROWS = 20_000       # postings compared at a time
SCAN_BYTES = 1 << 25     # and their bytes, unless one tile holds more
ROUNDS = 4               # of nearest partners before all remaining pairs are listed; changes no result
BLOCK = 2048             # members of one posting list that one task compares with one another


def need(size: int, percent: int) -> int:
    """Least overlap that a set of this size has with any partner."""
    return -(-size * percent // 100)


def _slots(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    other = mix(tokens ^ np.uint64(0x51ED270B7A3C9D11))
    return (tokens >> np.uint64(48)).astype(np.int64), (other >> np.uint64(48)).astype(np.int64) + SKETCH


def frequency_sketch(texts: DataFrame, width: int) -> np.ndarray:
    """Document frequency of shingles in two rows of counters, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(2 * SKETCH, np.int64)
        for batch in batches:
            data, offsets = bytes_of(batch.column(0))
            for a, b in pieces(offsets, PIECE):
                sets = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
                for slots in _slots(np.concatenate(sets)):
                    seen += np.bincount(slots, minlength=2 * SKETCH)
        used = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(used), pa.array(seen[used])], names=["slot", "n"])

    rows = (
        texts.select("text").mapInArrow(count, "slot long, n long")
        .groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most 2 * SKETCH rows, whatever the input
    )
    sketch = np.zeros(2 * SKETCH, np.float64)
    sketch[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    for row in (sketch[:SKETCH], sketch[SKETCH:]):
        row -= row.mean()  # what unrelated shingles add to a counter on average
    return np.maximum(sketch, 1.0).astype(np.float32)


def choose_prefix(tokens: np.ndarray, sketch: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The prefix to index, rare shingles first, and the number of matches it stands for."""
    size = len(tokens)
    if size == 0:
        return tokens, 0
    first, second = _slots(tokens)
    often = np.minimum(sketch[first], sketch[second])
    level = np.log2(often).astype(np.int16)
    order = np.argsort(level, kind="stable")  # tokens come sorted, so ties keep the order of their hashes
    base = size - need(size, percent)
    longest = min(base + MOST_MATCHES, size)
    read = np.cumsum(often[order[:longest]], dtype=np.float64)
    matches = np.arange(1, longest - base + 1)
    cost = read[base:longest] * (1.0 + VERIFY_COST / matches) + matches
    best = int(np.argmin(cost))
    return tokens[order[:base + best + 1]], best + 1


def parity_bitmap(tokens: np.ndarray, density: float = 0.5) -> bytes:
    """Parity of the tokens per bit, with about ``density`` bits a token, 256 at least."""
    bits = min(max(256, 1 << max(int(len(tokens) * density) - 1, 0).bit_length()), 1 << 16)
    counts = np.bincount((mix(tokens + np.uint64(99)) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


class Bitmaps:
    """Hamming distances between bitmaps of several sizes; the larger of two is folded to the smaller's size.

    A bit's place is the hash modulo the size, so the halves of a bitmap fold onto one another.
    """

    def __init__(self, column: pa.Array) -> None:
        data, offsets = bytes_of(column)
        self.sizes = np.diff(offsets)
        self.rows: dict[int, np.ndarray] = {}
        self.place: dict[int, np.ndarray] = {}
        for size in np.unique(self.sizes).tolist():
            folded, owners = [], []
            for own in np.unique(self.sizes[self.sizes >= size]).tolist():
                at = np.flatnonzero(self.sizes == own)
                bits = data[offsets[at][:, None] + np.arange(own)].view(np.uint64).reshape(len(at), -1, size // 8)
                folded.append(np.bitwise_xor.reduce(bits, axis=1))
                owners.append(at)
            self.rows[size] = np.concatenate(folded)
            self.place[size] = np.zeros(len(self.sizes), np.int64)
            self.place[size][np.concatenate(owners)] = np.arange(len(self.rows[size]))

    def distance(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        size = np.minimum(self.sizes[one], self.sizes[other])
        out = np.zeros(len(one), np.int64)
        for width in np.unique(size).tolist():
            at = np.flatnonzero(size == width)
            rows, place = self.rows[width], self.place[width]
            out[at] = np.bitwise_count(rows[place[one[at]]] ^ rows[place[other[at]]]).sum(axis=1)
        return out


def described(texts: DataFrame, width: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """Size, digest, prefix and bitmap of every document's set."""
    shared = texts.sparkSession.sparkContext.broadcast(sketch)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            for a, b in pieces(offsets, PIECE):
                sets = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
                chosen = [choose_prefix(s, shared.value, percent) for s in sets]
                digests = [set_digest(s) for s in sets]
                yield pa.record_batch(
                    [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                     pa.array([c[1] for c in chosen], pa.int32()), long_array([c[0] for c in chosen]),
                     pa.array([parity_bitmap(s) for s in sets], pa.binary())],
                    names=["doc_id", "n", "h1", "h2", "l", "prefix", "bitmap"])

    return texts.select("doc_id", "text").mapInArrow(
        describe, "doc_id long, n long, h1 long, h2 long, l int, prefix array<long>, bitmap binary")


def fine_bitmaps(texts: DataFrame, width: int) -> DataFrame:
    """``(id, bitmap)`` with four bits a shingle, so that few pairs pass whose texts do not."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            for a, b in pieces(offsets, PIECE):
                sets = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
                yield pa.record_batch([batch.column(0).slice(a, b - a),
                                       pa.array([parity_bitmap(s, 4.0) for s in sets], pa.binary())],
                                      names=["id", "bitmap"])

    return texts.select("doc_id", "text").mapInArrow(describe, "id long, bitmap binary")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole texts reach the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (one, at), (two, to) = bytes_of(batch.column(2)), bytes_of(batch.column(3))
            keep = np.zeros(batch.num_rows, bool)
            for a, b in pieces(at + to, PIECE):
                left = shingle_sets(one[at[a]:at[b]], at[a:b + 1] - at[a], width)
                right = shingle_sets(two[to[a]:to[b]], to[a:b + 1] - to[a], width)
                for k, (x, y) in enumerate(zip(left, right)):
                    # Both are sorted and distinct, so equal neighbours after the merge are the intersection.
                    both = np.sort(np.concatenate([x, y]))
                    common = int((both[1:] == both[:-1]).sum()) if len(both) else 0
                    keep[a + k] = common > 0 and 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select([0, 1]).filter(pa.array(keep))

    texts = texts.select("doc_id", "text")
    whole = (
        pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
        .join(texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b")
    )
    return whole.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def posting_lists(classes: DataFrame, percent: int) -> DataFrame:
    """Postings of the prefix shingles under which a class meets another of a size close enough to link.

    ``members`` is the length of the whole list.
    """
    listed = classes.select("id", F.col("n").cast("int").alias("n"), "l", F.explode("prefix").alias("token")).selectExpr(
        "token", "id", "n", "l", "count(1) over (partition by token) as members",
        "lag(n) over (partition by token order by n, id) as smaller",
        "lead(n) over (partition by token order by n, id) as larger")
    return listed.filter(
        f"smaller * 100L >= n * {percent}L or n * 100L >= larger * {percent}L").drop("smaller", "larger")


def _tiles(rows: DataFrame) -> DataFrame:
    """Spread long posting lists over tiles of two blocks each, so that no task meets more than two blocks.

    A list within one block keeps its single tile (0, 0).
    """
    return (
        rows.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("tile_a", F.least("block", "other")).withColumn("tile_b", F.greatest("block", "other"))
        .repartition("token", "tile_a", "tile_b").sortWithinPartitions("token", "tile_a", "tile_b", "id")
    )


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of complete tiles from sorted rows whose first three columns name the tile."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows >= SCAN_ROWS or size >= SCAN_BYTES:
            table = pa.Table.from_batches(held).combine_chunks()
            key = np.stack([table.column(k).to_numpy().astype(np.int64) for k in range(3)])
            changes = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if len(changes):
                cut = int(changes[-1])
                yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
                rows, size = table.num_rows - cut, sum(part.nbytes for part in held)
    if rows:
        yield pa.Table.from_batches(held)


def close_pairs(tiles: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row pairs of the same tile, of different parts, with close sizes and bitmaps near enough.

    Rows are compared with those one further, two further and so on, each step for all tiles at once.
    """
    tiles = tiles.combine_chunks()
    token, tile_a, tile_b, _, size, part, block = (tiles.column(k).to_numpy() for k in range(7))
    starts = np.ones(len(token), bool)
    starts[1:] = (token[1:] != token[:-1]) | (tile_a[1:] != tile_a[:-1]) | (tile_b[1:] != tile_b[:-1])
    bounds = np.append(np.flatnonzero(starts), len(token))
    stop = np.repeat(bounds[1:], np.diff(bounds))
    bitmaps = Bitmaps(tiles.column(7).chunk(0)) if len(token) else None
    rows, step = np.arange(len(token)), 0
    while True:
        step += 1
        rows = rows[rows + step < stop[rows]]
        if not len(rows):
            return
        other = rows + step
        small, large = np.minimum(size[rows], size[other]), np.maximum(size[rows], size[other])
        fits = (part[rows] != part[other]) & (small * 100 >= large * percent)
        fits &= (tile_a[rows] == tile_b[rows]) | (block[rows] != block[other])
        one, two = rows[fits], other[fits]
        if len(one):
            distance = bitmaps.distance(one, two)
            near = distance * (100 + percent) <= (size[one] + size[two]) * (100 - percent)
            if near.any():
                yield one[near], two[near], distance[near]


def met(postings: DataFrame, bitmaps: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Sorted tiles of the postings whose classes can meet one of another component under the same shingle.

    Without ``parts(id, part)`` every class is a component of its own.
    """
    if parts is None:
        placed = postings.withColumn("part", F.col("id"))
    else:
        placed = postings.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))
        mixed = placed.groupBy("token").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi")
        placed = placed.join(mixed.select("token"), "token", "left_semi")
    return _tiles(placed.join(bitmaps.select("id", "bitmap"), "id")).select(
        "token", "tile_a", "tile_b", "id", "n", "part", "block", "bitmap", "l")


def nearest_partners(tiles: DataFrame, percent: int) -> DataFrame:
    """``(id, a, b)``: every class with a possible partner, with the pair of it and its nearest one."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_tiles(batches):
            ids = rows.column(3).to_numpy()
            best = np.full(len(ids), np.iinfo(np.int64).max)
            other = np.zeros(len(ids), np.int64)
            for one, two, distance in close_pairs(rows, percent):
                for x, y in ((one, two), (two, one)):  # a row stands once on either side of a step
                    nearer = distance < best[x]
                    best[x[nearer]], other[x[nearer]] = distance[nearer], ids[y[nearer]]
            found = np.flatnonzero(best < np.iinfo(np.int64).max)
            yield pa.record_batch([pa.array(ids[found]), pa.array(best[found]), pa.array(other[found])],
                                  names=["id", "distance", "other"])

    best = tiles.mapInArrow(nearest, "id long, distance long, other long")
    return best.groupBy("id").agg(F.min(F.struct("distance", "other")).alias("best")).select(
        "id", F.least("id", "best.other").alias("a"), F.greatest("id", "best.other").alias("b"))


def split_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """``(a, b)`` of the pairs in two components that share enough prefix shingles and pass their bitmaps."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_tiles(batches):
            ids, matches = rows.column(3).to_numpy(), rows.column(8).to_numpy()
            for one, two, _ in close_pairs(rows, percent):
                yield pa.record_batch(
                    [pa.array(np.minimum(ids[one], ids[two])), pa.array(np.maximum(ids[one], ids[two])),
                     pa.array(np.minimum(matches[one], matches[two]))], names=["a", "b", "least"])

    # A pair meets once under every shingle that both prefixes hold.
    return tiles.mapInArrow(compare, "a long, b long, least int").groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("common"), F.first("least").alias("least")).filter("common >= least").select("a", "b")


def _joined(parts: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Components ``(id, part)`` after further links between documents."""
    for end in ("a", "b"):
        links = links.join(parts.select(F.col("id").alias(end), F.col("part").alias(f"part_{end}")), end, "left")
    edges = links.select(F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b"))
    joined = components(edges, name).select(F.col("id").alias("part"), F.col("component").alias("whole"))
    return parts.join(joined, "part", "full_outer").select(
        F.coalesce("id", "part").alias("id"), F.coalesce("whole", "part").alias("part"))


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` of every row of ``docs(doc_id, text)``.

    ``class_id`` is the least document with the same set, ``component_id`` the least that links reach.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = frequency_sketch(texts, width)
    sets = staged(described(texts, width, percent, sketch), "jaccard-sets")
    classes = staged(
        sets.filter("n > 0 and doc_id is not null").groupBy("h1", "h2").agg(
            F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("l").alias("l"),
            F.first("prefix").alias("prefix"), F.first("bitmap").alias("bitmap")), "jaccard-classes")
    members = staged(sets.select("doc_id", "h1", "h2", "n"), "jaccard-members")
    unstage(sets)
    postings = staged(posting_lists(classes, percent), "jaccard-postings")
    best = staged(nearest_partners(met(postings, classes), percent), "jaccard-partners")
    named = staged(classes.select("h1", "h2", F.col("id").alias("class_id")), "jaccard-named")
    unstage(classes)
    # From here on only classes with a possible partner matter: their texts are kept.
    texts = staged(rows_of(texts, best.select(F.col("id").alias("doc_id")), "doc_id"), "jaccard-texts")
    listed = staged(rows_of(postings, best.select("id"), "id"), "jaccard-listed")
    unstage(postings)
    bitmaps = staged(fine_bitmaps(texts, width), "jaccard-bitmaps")
    links = verified(best.select("a", "b").distinct(), texts, width, percent)
    parts = staged(components(links, "jaccard-parts").withColumnRenamed("component", "part"), "jaccard-parts")
    near = links = None
    open_listed, open_texts = listed, texts
    for _ in range(ROUNDS):
        near = staged(nearest_partners(met(open_listed, bitmaps, parts), percent), "jaccard-near")
        # Components only grow: a class without a possible partner in another one now never has one later.
        open_listed = rows_of(listed, near.select("id"), "id")
        open_texts = rows_of(texts, near.select(F.col("id").alias("doc_id")), "doc_id")
        links = staged(verified(near.select("a", "b").distinct(), open_texts, width, percent), "jaccard-links")
        if links.isEmpty():
            break
        parts = staged(_joined(parts, links, "jaccard-parts"), "jaccard-parts")
    if not near.isEmpty():  # some pairs of two components still pass their bitmaps
        pairs = split_pairs(met(open_listed, bitmaps, parts), percent)
        parts = _joined(parts, staged(verified(pairs, open_texts, width, percent), "jaccard-rest"), "jaccard-rest")
    unstage(texts, listed, bitmaps)
    final = parts.select(F.col("id").alias("class_id"), F.col("part").alias("linked"))
    named = named.join(final, "class_id", "left")
    return members.join(named, ["h1", "h2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("linked", "class_id", "doc_id").alias("component_id"))
