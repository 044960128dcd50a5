"""Byte-level BPE encoding and decoding of whole texts, with tree concatenation for long unsplit text.

The vocabulary comes from a tokenizer file.  A text is cut where no pretoken can reach across: where white space
follows other text, and around special tokens.  A stretch that cannot be cut there (one giant pretoken, such as a
hundred thousand letters) is halved into leaves; the leaves are encoded in parallel and joined pairwise in a tree.

A join re-encodes a window of tokens around the border, doubling it until both of its ends agree with the tokens
outside: a sequence of BPE tokens is the encoding of its bytes exactly if each two neighbours encode to themselves, so
a window whose outer neighbours are compatible makes the whole sequence the right one.

Rows: a null or empty text has no tokens and decodes to the empty text.  Repeated rows are encoded each.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the published pretoken pattern of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_CHARS = 65_536      # texts above this are cut into parts that are encoded in different tasks
PART_CHARS = 16_384      # size of such a part, and of a leaf of an unsplit stretch

_BORDER = regex.compile(r"(?<=\S)(?=\s)")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable bytes themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        letters[chr(256 + k)] = b
    return letters


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocabulary[a + b] for a, b in merges]
        if made != sorted(made):
            raise ValueError("the vocabulary's ids do not follow the order of its merges")
        self.special = special
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        size = max([*ranks.values(), *special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in ranks.items():
            self.bytes[i] = token
        for token, i in special.items():
            self.bytes[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self._pretoken = regex.compile(PATTERN)

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special="all")

    def encode_piece(self, piece: bytes) -> list[int]:
        """Merges within one pretoken."""
        return self.encoding._core_bpe.encode_single_piece(piece)

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of one pretoken from the tokens of its two halves."""
        if not left or not right:
            return left + right
        width = 1
        while True:
            i, j = max(len(left) - width, 0), min(width, len(right))
            window = self.encode_piece(self.decode_bytes(left[i:] + right[:j]))
            agrees_left = i == 0 or self.compatible(left[i - 1], window[0])
            agrees_right = j == len(right) or self.compatible(window[-1], right[j])
            if agrees_left and agrees_right:
                return left[:i] + window + right[j:]
            width *= 2

    def compatible(self, one: int, other: int) -> bool:
        return self.encode_piece(self.bytes[one] + self.bytes[other]) == [one, other]

    def join_tree(self, leaves: list[list[int]]) -> list[int]:
        while len(leaves) > 1:
            leaves = [self.join(leaves[k], leaves[k + 1]) if k + 1 < len(leaves) else leaves[k]
                      for k in range(0, len(leaves), 2)]
        return leaves[0] if leaves else []

    def parts(self, text: str, most: int) -> Iterator[tuple[int, bytes]]:
        """Parts of a long text in order: ``(-1, text part)`` or ``(stretch number, leaf)``."""
        if self.special:
            mark = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
            blocks = mark.split(text)
        else:
            blocks = [text]
        stretch = 0
        for block in blocks:
            if block in self.special:
                yield -1, block.encode()
                continue
            start = 0
            while start < len(block):
                if len(block) - start <= most:
                    yield -1, block[start:].encode("utf-8", "surrogatepass")
                    break
                last = None
                for found in _BORDER.finditer(block, start + 1, start + most):
                    last = found.start()
                if last is None:  # no border near: one pretoken may be longer than a part
                    after = _BORDER.search(block, start + most)
                    last = after.start() if after else len(block)
                    for token in self._pretoken.findall(block[start:last]):
                        raw = token.encode("utf-8", "surrogatepass")
                        if len(raw) <= most:
                            yield stretch, raw
                        else:
                            leaves = 1 << (-(-len(raw) // most) - 1).bit_length()
                            cuts = [len(raw) * k // leaves for k in range(leaves + 1)]
                            for a, b in zip(cuts, cuts[1:]):
                                yield stretch, raw[a:b]
                        stretch += 1
                else:
                    yield -1, block[start:last].encode("utf-8", "surrogatepass")
                start = last

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        named = ",".join([self.decimal[i] for i in ids])
        text = self.decode_bytes(ids).decode("utf-8", "replace")
        return (len(ids), hashlib.sha256(named.encode()).hexdigest(),
                hashlib.sha256(text.encode("utf-8")).hexdigest())


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, long_chars: int = LONG_CHARS, part_chars: int = PART_CHARS) -> DataFrame:
    """``doc_id, ids`` (array of int) of every row of ``docs(doc_id, text)``; ``path`` names the vocabulary file."""
    return _encoded(docs, path, long_chars, part_chars, "ids")


def encode_digests(docs: DataFrame, path: str, long_chars: int = LONG_CHARS, part_chars: int = PART_CHARS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: encoded, decoded again and hashed."""
    return _encoded(docs, path, long_chars, part_chars, "digests")


def encode_lengths(docs: DataFrame, path: str, long_chars: int = LONG_CHARS, part_chars: int = PART_CHARS) -> DataFrame:
    """``doc_id, n_tokens`` of every row."""
    return _encoded(docs, path, long_chars, part_chars, "lengths")


def _result(doc_ids: list, encoded: list[list[int]], coder: Codec, kind: str) -> pa.RecordBatch:
    if kind == "lengths":
        return pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array([len(ids) for ids in encoded], pa.int64())],
                               names=["doc_id", "n_tokens"])
    if kind == "digests":
        rows = [coder.digests(ids) for ids in encoded]
        return pa.record_batch(
            [pa.array(doc_ids, pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
             pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(encoded, pa.list_(pa.int32()))],
                           names=["doc_id", "ids"])


def _encoded(docs: DataFrame, path: str, long_chars: int, part_chars: int, kind: str) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = {"digests": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
              "ids": "doc_id long, ids array<int>", "lengths": "doc_id long, n_tokens long"}[kind]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a in range(0, len(texts), 32):  # token lists are large: few rows at a time
                yield _result(batch.column(0).slice(a, 32).to_pylist(), [coder.encode(t) for t in texts[a:a + 32]],
                              coder, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()
                parts = list(coder.parts(text, part_chars))
                yield pa.record_batch(
                    [pa.array([doc_id] * len(parts), pa.int64()), pa.array([name] * len(parts), pa.binary()),
                     pa.array(range(len(parts)), pa.int32()), pa.array([p[0] for p in parts], pa.int32()),
                     pa.array([p[1] for p in parts], pa.binary())],
                    names=["doc_id", "name", "part", "stretch", "payload"])

    def encode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            stretches, payloads = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            ids = [np.array(coder.encode(p.decode("utf-8", "surrogatepass")) if s < 0 else coder.encode_piece(p),
                            np.int32).tobytes() for s, p in zip(stretches, payloads)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(ids, pa.binary())], names=batch.schema.names)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        key, held = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            if key is None:
                return
            copies = sum(1 for part, _, _ in held if part == 0)
            once = [h for k, h in enumerate(held) if k == 0 or held[k - 1][0] != h[0]]
            ids: list[int] = []
            k = 0
            while k < len(once):
                leaves, stretch = [], once[k][1]
                while k < len(once) and (not leaves or (stretch >= 0 and once[k][1] == stretch)):
                    leaves.append(np.frombuffer(once[k][2], np.int32).tolist())
                    k += 1
                ids += coder.join_tree(leaves)
            yield _result([key[0]] * copies, [ids] * copies, coder, kind)

        for batch in batches:
            for doc_id, name, part, stretch, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if (doc_id, name) != key:
                    yield from finish()
                    key, held = (doc_id, name), []
                held.append((part, stretch, payload))
        yield from finish()

    short = docs.filter(F.length("text") <= long_chars).mapInArrow(whole, schema)
    part_schema = "doc_id long, name binary, part int, stretch int, payload binary"
    long = (
        docs.filter(F.length("text") > long_chars).mapInArrow(cut, part_schema)
        .repartition("doc_id", "name", "part").mapInArrow(encode_parts, part_schema)
        .repartition("doc_id", "name").sortWithinPartitions("doc_id", "name", "part").mapInArrow(assemble, schema)
    )
    return short.unionByName(long)
