"""Alignment of two tokenizers' tokens by byte offsets, composed from fragments of byte ranges.

Tokenizer A is a byte-level BPE (``bpe.Codec``), B a sentencepiece model with byte fallback.  Byte offsets at which a
token of both ends cut a text into groups; the two tokens that end there are linked.

A fragment is what a byte range knows: an open prefix (its tokens up to the first shared end, whose group may begin
before the range), closed groups, and an open suffix (its tokens after the last shared end).  Without a shared end all
its tokens are open.  Composing two fragments looks for shared ends among the left one's suffix and the right one's
prefix; this is associative, and the two tokenizers' cuts need not fall together.  Texts over ``PART_CHARS`` are cut
into parts that are encoded in different tasks, and their fragments are composed ``FAN`` at a time in a tree of
shuffles.  Other texts are one fragment.

Parts are cut where the whole text's tokens end in any case: A before white space that follows a letter, number or
punctuation mark, B between two characters that stand together in no piece of the model.  A stretch without such a
place stays in one part.

Linked tokens end together, so the bytes of one are a suffix of the other's: the pairs that can be linked follow
from the two vocabularies alone (some 324,000 for 50,257 and 32,000 tokens).  Links are kept as numbers of such pairs,
and the table of their counts over all texts has that size at most, whatever the input; it is handed to the tasks that
look the counts up.

Rows: a null or empty text has no tokens, nor has one whose tokens do not spell it (with U+2581 in it); repeated rows are
counted each; null ids are kept; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import codec
from tidemark.llm.common import prepare_texts
from tidemark.plans.staging import staged

PART_CHARS = 32_768
FAN = 8
SPELT_TOKENS = 16_384    # tokens whose bytes are laid out at once
SPACE = "▁"  # fixed value: how sentencepiece writes a space

_A_BORDER = regex.compile(r"(?<=[\p{L}\p{N}\p{P}])(?=[ \t\n\r])")
_INTS, _LONGS = np.dtype("<i4"), np.dtype("<i8")
_NONE = (np.zeros(0, _INTS), np.zeros(0, _LONGS))
Tokens = tuple[np.ndarray, np.ndarray]  # ids and the byte offsets at which they end


class _Spelling:
    """The bytes of a vocabulary's tokens, joined."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(x) for x in tokens], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def placed(self, ids: np.ndarray, text: str, start: int) -> tuple[Tokens, bool]:
        """The tokens of a text that begins at byte ``start``; whether they spell it."""
        ids = ids.astype(_INTS, copy=False)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes).astype(_LONGS, copy=False)
        raw = np.frombuffer(text.encode(), np.uint8)
        same = len(raw) == (ends[-1] if len(ends) else 0)
        for k in range(0, len(ids) if same else 0, SPELT_TOKENS):
            size, end = sizes[k:k + SPELT_TOKENS], ends[k:k + SPELT_TOKENS]
            places = np.arange(end[0] - size[0], end[-1])
            same = same and np.array_equal(
                self.data[np.repeat(self.begins[ids[k:k + SPELT_TOKENS]] - end + size, size) + places], raw[places[0]:end[-1]])
        return (ids, ends + start), same


class Pair:
    """The two tokenizers, and the pairs of their tokens that can end together."""

    def __init__(self, a_path: str, b_path: str) -> None:
        coder = codec(a_path)
        self.encoding = coder.encoding
        self.bytes_a = coder.bytes
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.bytes_b: list[bytes] = []
        self.together: set[str] = set()
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.bytes_b.append(b"")
            else:
                self.bytes_b.append(piece.replace(SPACE, " ").encode())
                self.together.update(x + y for x, y in zip(piece, piece[1:]))
        self.space = np.array([self.model.piece_to_id(SPACE)], _INTS)
        self.spelt_a, self.spelt_b = _Spelling(self.bytes_a), _Spelling(self.bytes_b)
        self.keys = self._pairs()
        self.slots = self._slots()
        # Names as numbers of eight bytes, padded with zeros: ids have seven digits at most.
        self.named = np.array([name for ids, end in ((len(self.bytes_a), "|"), (len(self.bytes_b), ";"))
                               for i in range(ids) for name in (f"{i},", f"{i}{end}")], "S8").view("<u8")

    def _pairs(self) -> np.ndarray:
        by_a, by_b = defaultdict(list), defaultdict(list)
        for by, tokens in ((by_a, self.bytes_a), (by_b, self.bytes_b)):
            for i, raw in enumerate(tokens):
                if raw:
                    by[raw].append(i)
        found = [(a << 32) | b for raw, ids in by_a.items() for a in ids
                 for k in range(len(raw)) for b in by_b.get(raw[k:], ())]
        found += [(a << 32) | b for raw, ids in by_b.items() for b in ids
                  for k in range(1, len(raw)) for a in by_a.get(raw[k:], ())]
        return np.unique(np.array(found, np.int64))

    def _slots(self) -> np.ndarray:
        """Hash table with open addressing of the pairs' numbers; -1 where a slot is empty."""
        self.bits = (2 * len(self.keys)).bit_length()
        slots = np.full(1 << self.bits, -1, _INTS)
        left, at = np.arange(len(self.keys)), self._slot(self.keys)
        while len(left):
            free = slots[at] < 0
            slots[at[free]] = left[free]
            lost = slots[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(slots) - 1)
        return slots

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of pairs, each given as one number of both ids."""
        at = self._slot(keys)
        found = self.slots[at]
        wrong = np.flatnonzero(self.keys[found] != keys)
        while len(wrong):
            if (found[wrong] < 0).any():
                raise ValueError("linked tokens of which neither ends in the other")
            at[wrong] = (at[wrong] + 1) & (len(self.slots) - 1)
            found[wrong] = self.slots[at[wrong]]
            wrong = wrong[self.keys[found[wrong]] != keys[wrong]]
        return found

    def a_tokens(self, text: str, start: int) -> tuple[Tokens, bool]:
        """Tokens of a part that begins at byte ``start``; whether they spell it."""
        # Nothing is allowed and nothing disallowed: the strings of special tokens are plain text.
        return self.spelt_a.placed(self.encoding.encode_to_numpy(text, disallowed_special=()), text, start)

    def b_ids(self, text: str, first: bool) -> np.ndarray:
        """Ids of a part of the text with its leading space; ``first`` for the part at the text's start."""
        if not text:
            return _NONE[0]
        if text[0] == " ":
            ids = self.model.encode_as_numpy(text[1:])
            return ids if len(text) > 1 or first else self.space
        return self.model.encode_as_numpy(text)[1:]

    def b_tokens(self, text: str, start: int) -> tuple[Tokens, bool]:
        """Tokens of a part of the text with its leading space that begins at byte ``start``; whether they spell it."""
        return self.spelt_b.placed(self.b_ids(text, start == 0), text, start)

    def a_cut(self, text: str, at: int) -> int:
        found = _A_BORDER.search(text, at)
        return found.start() if found else len(text)

    def b_cut(self, text: str, at: int) -> int:
        for k in range(at, len(text)):
            x, y = (SPACE if c == " " else c for c in (text[k - 1], text[k]))
            if x + y not in self.together and (y == SPACE or SPACE + y not in self.together):
                return k
        return len(text)

    def groups(self, a: Tokens, b: Tokens, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[str, np.ndarray]:
        """Groups as text, each closed by a semicolon, and the pair numbers of their links.

        ``stop_a`` and ``stop_b`` are the last tokens of the groups; no token may follow them.
        """
        if not len(stop_a):
            return "", np.zeros(0, _INTS)
        n_a, n_b = len(a[0]), len(b[0])
        # A token of A comes after the tokens of B in the groups before it, one of B after those of A in its group too.
        place_a = np.arange(n_a) + np.repeat(np.concatenate([[0], stop_b[:-1] + 1]), np.diff(stop_a, prepend=-1))
        place_b = np.arange(n_b) + np.repeat(stop_a + 1, np.diff(stop_b, prepend=-1))
        out = np.empty(n_a + n_b, np.int64)
        code_a, code_b = 2 * a[0].astype(np.int64), 2 * b[0].astype(np.int64) + 2 * len(self.bytes_a)
        code_a[stop_a] += 1
        code_b[stop_b] += 1
        out[place_a], out[place_b] = code_a, code_b
        text = self.named[out].tobytes().translate(None, b"\0").decode()
        return text, self.numbers((a[0][stop_a].astype(np.int64) << 32) | b[0][stop_b])


class Fragment(NamedTuple):
    """Tokens of a byte range: open prefix, closed groups (text, number, links), open suffix.

    ``cut`` tells whether the range has a shared end; without one, all tokens are in the prefix.
    """

    cut: bool
    pre_a: Tokens
    pre_b: Tokens
    text: str
    n: int
    links: np.ndarray
    suf_a: Tokens
    suf_b: Tokens


def _joined(x: Tokens, y: Tokens) -> Tokens:
    return np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])


def _sliced(x: Tokens, start: int, stop: int) -> Tokens:
    return x[0][start:stop], x[1][start:stop]


def _shared(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``x`` and in ``y`` of the numbers that both hold; each is sorted and holds a number once."""
    if not len(x) or not len(y):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = max(x[0], y[0]), min(x[-1], y[-1])
    (i, x), (j, y) = [(begin, v[begin:stop] - low) for v in (x, y) for begin, stop in [np.searchsorted(v, [low, high + 1])]]
    in_x, in_y = np.zeros((2, max(high - low + 1, 0)), bool)
    in_x[x] = in_y[y] = True
    return i + np.flatnonzero(in_y[x]), j + np.flatnonzero(in_x[y])


def fragment(pair: Pair, a: Tokens, b: Tokens, anchored: bool = False) -> Fragment:
    """Fragment of one range's tokens.  ``anchored``: the range begins at a shared end, so no group is open before it;
    its prefix is then empty."""
    stop_a, stop_b = _shared(a[1], b[1])
    nothing = np.zeros(0, _INTS)
    if not len(stop_a):
        return Fragment(True, _NONE, _NONE, "", 0, nothing, a, b) if anchored else Fragment(
            False, a, b, "", 0, nothing, _NONE, _NONE)
    first_a, first_b = (0, 0) if anchored else (int(stop_a[0]) + 1, int(stop_b[0]) + 1)
    last_a, last_b = int(stop_a[-1]) + 1, int(stop_b[-1]) + 1
    skip = 0 if anchored else 1
    text, links = pair.groups(_sliced(a, first_a, last_a), _sliced(b, first_b, last_b),
                              stop_a[skip:] - first_a, stop_b[skip:] - first_b)
    return Fragment(True, _sliced(a, 0, first_a), _sliced(b, 0, first_b), text, len(stop_a) - skip, links,
                    _sliced(a, last_a, len(a[0])), _sliced(b, last_b, len(b[0])))


def compose(pair: Pair, x: Fragment, y: Fragment) -> Fragment:
    """Fragment of two neighbouring ranges."""
    left_a, left_b = (x.suf_a, x.suf_b) if x.cut else (x.pre_a, x.pre_b)
    middle = fragment(pair, _joined(left_a, y.pre_a), _joined(left_b, y.pre_b), anchored=x.cut)
    text, n, links = x.text + middle.text, x.n + middle.n, np.concatenate([x.links, middle.links])
    pre_a, pre_b = (x.pre_a, x.pre_b) if x.cut else (middle.pre_a, middle.pre_b)
    if not y.cut:
        return Fragment(middle.cut, pre_a, pre_b, text, n, links, middle.suf_a, middle.suf_b)
    return Fragment(True, pre_a, pre_b, text + y.text, n + y.n, np.concatenate([links, y.links]), y.suf_a, y.suf_b)


START = Fragment(True, _NONE, _NONE, "", 0, np.zeros(0, _INTS), _NONE, _NONE)


@lru_cache(maxsize=2)
def _pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def pack(links: np.ndarray) -> bytes:
    """Pair numbers in any order as sorted gaps of two bytes; a gap that needs more is given again in four."""
    gaps = np.diff(np.sort(links).astype(np.int64), prepend=0)
    large = gaps >= 0xFFFF
    return np.minimum(gaps, 0xFFFF).astype("<u2").tobytes() + gaps[large].astype("<u4").tobytes()


def unpack(packed: bytes, n: int) -> np.ndarray:
    gaps = np.frombuffer(packed, "<u2", n).astype(np.int64)
    gaps[gaps == 0xFFFF] = np.frombuffer(packed, "<u4", offset=2 * n)
    return np.cumsum(gaps)


_PART = ("doc_id long, name binary, part long, copies long, same boolean, n_a long, n_b long, cut boolean, "
         "pre_a binary, pre_a_ends binary, pre_b binary, pre_b_ends binary, text string, n long, links binary, "
         "suf_a binary, suf_a_ends binary, suf_b binary, suf_b_ends binary")
_PART_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(),
               *[pa.binary()] * 4, pa.string(), pa.int64(), *[pa.binary()] * 5]
_DOC = "doc_id long, n_a long, n_b long, n_groups long, groups string, links binary"


def _part_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _PART.split(", ")]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _PART_TYPES)], names=names)


def _stored(f: Fragment) -> tuple:
    flat = [part.tobytes() for tokens in (f.pre_a, f.pre_b, f.suf_a, f.suf_b) for part in tokens]
    return (f.cut, *flat[:4], f.text, f.n, f.links.tobytes(), *flat[4:])


def _read(cut, a1, a2, b1, b2, text, n, links, a3, a4, b3, b4) -> Fragment:
    tokens = [(np.frombuffer(x, _INTS), np.frombuffer(y, _LONGS)) for x, y in ((a1, a2), (b1, b2), (a3, a4), (b3, b4))]
    return Fragment(cut, tokens[0], tokens[1], text, n, np.frombuffer(links, _INTS), tokens[2], tokens[3])


def _finished(pair: Pair, doc_id, copies: int, same: bool, n_a: int, n_b: int, f: Fragment, groups: bool) -> list[tuple]:
    if not same or not n_a:
        return [(doc_id, 0, 0, 0, "", b"")] * copies
    f = compose(pair, START, f)
    text = f.text[:-1]
    return [(doc_id, n_a, n_b, f.n, text if groups else hashlib.sha256(text.encode()).hexdigest(), pack(f.links))] * copies


def _doc_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                           names=["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])


def align(docs: DataFrame, a_path: str, b_path: str, groups: bool = False, part_chars: int = PART_CHARS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, groups, links`` of every document.

    ``groups`` is the text ``a1,a2|b1;a3|b2,b3`` of the groups' ids, or without ``groups`` its SHA-256; it is empty where
    there are no tokens.  ``links`` holds the numbers of the linked pairs (``pack``).
    """
    prepare_texts(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        for batch in batches:
            for start in range(0, batch.num_rows, 32):
                part = batch.slice(start, 32)
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                rows = []
                for doc_id, text in zip(ids, texts):
                    if not text:
                        rows.append((doc_id, 0, 0, 0, "", b""))
                        continue
                    a, same_a = pair.a_tokens(" " + text, 0)
                    b, same_b = pair.b_tokens(" " + text, 0)
                    rows += _finished(pair, doc_id, 1, same_a and same_b, len(a[0]), len(b[0]), fragment(pair, a, b)
                                      if same_a and same_b else START, groups)
                yield _doc_batch(rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = " " + text
                name = hashlib.sha256(text.encode()).digest()
                cuts = [(0, 0)] + [(pair.a_cut(text, k), pair.b_cut(text, k)) for k in range(part_chars, len(text), part_chars)]
                cuts.append((len(text), len(text)))
                at_a = at_b = 0
                for part, ((a, b), (next_a, next_b)) in enumerate(zip(cuts, cuts[1:])):
                    piece_a, piece_b = text[a:next_a], text[b:next_b]
                    yield pa.record_batch(
                        [pa.array([doc_id], pa.int64()), pa.array([name], pa.binary()), pa.array([part], pa.int64()),
                         pa.array([at_a], pa.int64()), pa.array([piece_a]), pa.array([at_b], pa.int64()), pa.array([piece_b])],
                        names=["doc_id", "name", "part", "a_start", "a_text", "b_start", "b_text"])
                    at_a, at_b = at_a + len(piece_a.encode()), at_b + len(piece_b.encode())

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        for batch in batches:
            for doc_id, name, part, copies, a_start, a_text, b_start, b_text in zip(*(c.to_pylist() for c in batch.columns)):
                a, same_a = pair.a_tokens(a_text, a_start)
                b, same_b = pair.b_tokens(b_text, b_start)
                same = same_a and same_b
                f = fragment(pair, a, b) if same else START
                yield _part_batch([(doc_id, name, part, copies, same, len(a[0]), len(b[0]), *_stored(f))])

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        key, held = None, None
        for batch in batches:
            for doc_id, name, part, copies, same, n_a, n_b, *stored in zip(*(c.to_pylist() for c in batch.columns)):
                f = _read(*stored)
                if key == (doc_id, name, part // FAN):
                    held = (copies, held[1] and same, held[2] + n_a, held[3] + n_b,
                            compose(pair, held[4], f) if held[1] and same else START)
                    continue
                if key is not None:
                    yield _part_batch([(*key, *held[:4], *_stored(held[4]))])
                key, held = (doc_id, name, part // FAN), (copies, same, n_a, n_b, f)
        if key is not None:
            yield _part_batch([(*key, *held[:4], *_stored(held[4]))])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        for batch in batches:
            for doc_id, _, _, copies, same, n_a, n_b, *stored in zip(*(c.to_pylist() for c in batch.columns)):
                yield _doc_batch(_finished(pair, doc_id, copies, same, n_a, n_b, _read(*stored), groups))

    short = docs.filter(F.length("text") <= part_chars).mapInArrow(whole, _DOC)
    parts = docs.filter(F.length("text") > part_chars).mapInArrow(
        cut, "doc_id long, name binary, part long, a_start long, a_text string, b_start long, b_text string")
    once = parts.groupBy("doc_id", "name", "part").agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("a_start", "a_text", "b_start", "b_text")])
    pieces = staged(once.mapInArrow(fragments, _PART), "align-fragments")
    last = pieces.agg(F.max("part")).first()[0] or 0
    while last:
        pieces = pieces.withColumn("_up", F.floor(F.col("part") / FAN)).repartition("doc_id", "name", "_up").sortWithinPartitions(
            "doc_id", "name", "part").drop("_up").mapInArrow(composed, _PART)
        last //= FAN
    return short.unionByName(pieces.mapInArrow(finish, _DOC))


def pair_counts(aligned: DataFrame, pairs: int) -> DataFrame:
    """``pair, n``: how many links of all documents hold each pair; at most ``pairs`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(pairs, np.int64)
        for batch in batches:
            for packed, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                np.add.at(counts, unpack(packed, n), 1)
        found = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(found), pa.array(counts[found])], names=["pair", "n"])

    return aligned.select("links", "n_groups").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def alignment(docs: DataFrame, a_path: str, b_path: str, part_chars: int = PART_CHARS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    aligned = staged(align(docs, a_path, b_path, part_chars=part_chars), "align-docs")
    keys = _pair(a_path, b_path).keys
    table = pair_counts(aligned, len(keys)).toArrow()
    counts = np.zeros(len(keys), np.int64)
    counts[table.column("pair").to_numpy()] = table.column("n").to_numpy()
    b_of = keys & 0xFFFFFFFF
    highest = np.zeros(int(b_of.max()) + 1, np.int64)
    np.maximum.at(highest, b_of, counts)
    shared = docs.sparkSession.sparkContext.broadcast((counts, counts == highest[b_of]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            found = [unpack(packed, n) for packed, n in zip(batch.column(5).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], batch.column(3), pa.array([int(best[f].sum()) for f in found], pa.int64()),
                 pa.array([int(counts[f].sum()) for f in found], pa.int64()), batch.column(4)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return aligned.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                   "count_sum long, groups_sha256 string")
