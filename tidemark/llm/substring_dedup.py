"""Exact removal of repeated byte strings across all documents, with suffix arrays over shards of candidate text.

A byte is removed if a ``width``-byte string that covers it also starts anywhere else; on demand also the words of
every passage of so many words that starts anywhere else, with whatever white space between them.

1. Every window of ``width`` bytes has a key, the least hash of its ``GRAM``-byte substrings.  Equal windows have equal
   keys, and neighbouring windows mostly share one, so a text falls into segments of windows with one key.
2. Segments whose key occurs once are done, unless their least substring comes twice within them, as in periodic text.
   Equal segments of one key become one, with a weight.
3. The others' texts go to shards by key.  Each shard builds its suffix array by induced sorting and the permuted
   common prefixes; a window is repeated if a neighbour in the array shares ``width`` bytes or its segment has weight
   two or more.
4. A key with more than ``HOT`` different segments is split first: its windows are taken in short stretches, aligned
   to the least substring and keyed by the bytes that all windows of the stretch share, and where that is still hot,
   window by window.  So a passage that very many documents hold does not end up in one shard.

5. Passages of words go the same way, over texts in which each word is a code of ``CODE`` bytes.  Windows of bytes that
   hold that many whole words are then left to them.

Rows: a null text is empty; a text shorter than ``width`` keeps all bytes; repeated rows repeat each other's strings.
Rows are told apart by a hash of doc_id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, pieces, rows_apart, rows_of
from tidemark.llm.suffixes import repeated_starts
from tidemark.llm.wordhash import BYTE_BITS, SPACE, mix, running, window_hash, word_bounds
from tidemark.llm.wordhash import words as word_hashes
from tidemark.plans.staging import staged, unstage

GRAM = 16
PIECE = 1 << 18        # bytes of text hashed at a time
SPAN = 2048            # most windows of one segment
SHARD = 1 << 19        # bytes of text in one suffix array; a single key may exceed it
HOT = 4096             # different segments of one key that may meet in a shard
STRETCH = 24           # windows per stretch where a hot key is split first

_OTHER_BITS = mix(BYTE_BITS + np.uint64(12345))
CODE = 8               # bytes that stand for a word
_SEPARATOR = b"\xff"   # no UTF-8 text and no word code holds this byte


def _digest(first: np.ndarray, second: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = (stop - start).astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix(window_hash(first, start, stop) + size), mix(window_hash(second, start, stop) ^ (size << np.uint64(32)))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def _grams(sums: np.ndarray) -> np.ndarray:
    """Hashes of all ``GRAM``-byte substrings."""
    at = np.arange(len(sums) - GRAM)
    return mix(window_hash(sums, at, at + GRAM))


def segments(data: np.ndarray, offsets: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """Segments of all texts of a buffer: text number, first window, number of windows, key, digest, and whether the
    least substring may come twice."""
    windows = len(data) - width + 1
    owner = np.flatnonzero(np.diff(offsets) >= width)
    if windows < 1 or not len(owner):
        return {}
    first = running(BYTE_BITS[data])
    second = running(_OTHER_BITS[data])
    grams = _grams(first)
    reach = width - GRAM + 1
    key = _sliding_min(grams, reach)
    # A gram is the least of some window if the largest key among its windows is its own hash.
    edge = np.zeros(reach - 1, np.uint64)
    chosen = np.flatnonzero(~_sliding_min(~np.concatenate([edge, key, edge]), reach) == grams)
    again = np.zeros(len(grams) + 1, np.int64)
    again[chosen[:-1][grams[chosen[:-1]] == grams[chosen[1:]]] + 1] = 1
    again = np.cumsum(again)
    begin = np.ones(windows, bool)
    begin[1:] = key[1:] != key[:-1]
    valid = np.zeros(windows + 1, np.int8)
    np.add.at(valid, offsets[owner], 1)
    np.add.at(valid, np.minimum(offsets[owner + 1] - width + 1, windows), -1)
    valid = np.cumsum(valid[:-1]) > 0
    begin[offsets[owner]] = True
    begin[offsets[owner + 1][offsets[owner + 1] - width + 1 < windows] - width + 1] = True
    starts = np.flatnonzero(begin)
    stops = np.append(starts[1:], windows)
    keep = valid[starts]
    starts, stops = starts[keep], stops[keep]
    cuts = -(-(stops - starts) // SPAN)
    starts = np.repeat(starts, cuts) + SPAN * (np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts))
    counts = np.minimum(np.repeat(stops, cuts) - starts, SPAN)
    h1, h2 = _digest(first, second, starts, starts + counts + width - 1)
    text = np.searchsorted(offsets, starts, side="right") - 1
    inner = again[starts + counts + reach - 1] > again[starts]
    return {"text": text, "start": starts - offsets[text], "windows": counts, "key": key[starts], "h1": h1, "h2": h2,
            "inner": inner}


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a buffer with ``CODE`` bytes of hash for every word and nothing between."""
    hashed, bounds = word_hashes(data, offsets, BYTE_BITS)
    return (hashed & np.uint64(0x7F7F7F7F7F7F7F7F)).view(np.uint8), bounds * CODE


def _short_of_words(data: np.ndarray, starts: np.ndarray, counts: np.ndarray, width: int, words: int) -> np.ndarray:
    """Whether some window of each segment holds fewer than ``words`` words with white space at both ends."""
    space = SPACE[data]
    ends = np.zeros(len(data) + 1, np.int64)
    ends[2:] = np.cumsum(space[1:] & ~space[:-1])   # words that end before a byte
    short = np.concatenate([[0], np.cumsum(ends[width:] - ends[1:len(ends) - width + 1] - 1 < words)])
    return short[starts + counts] > short[starts]


def segment_rows(texts: DataFrame, width: int, coded: bool = False, words: int = 0) -> DataFrame:
    """Segments of all texts, or of their word codes; with ``words`` only those with windows of fewer words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = bytes_of(batch.column(1))
            for a, b in pieces(offsets, PIECE):
                part, local = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                if coded:
                    part, local = word_codes(part, local)
                found = segments(part, local, width)
                if found and words:
                    short = _short_of_words(part, local[found["text"]] + found["start"], found["windows"], width, words)
                    found = {name: column[short] for name, column in found.items()}
                if found:
                    yield pa.record_batch(
                        [pa.array(rows[a + found["text"]]), pa.array(found["start"].astype(np.int32)),
                         pa.array(found["windows"].astype(np.int32)), *[pa.array(found[c].view(np.int64)) for c in ("key", "h1", "h2")],
                         pa.array(found["inner"])],
                        names=["row", "start", "windows", "key", "h1", "h2", "inner"])

    return texts.select("row", "text").mapInArrow(
        run, "row long, start int, windows int, key long, h1 long, h2 long, inner boolean")


def _with_text(wanted: DataFrame, texts: DataFrame, width: int, coded: bool) -> DataFrame:
    """``key, h1, h2, windows, weight, body`` with the bytes of each wanted segment, cut from its document."""
    per_row = wanted.groupBy("row").agg(F.collect_list(F.struct(
        "start", "windows", "key", "h1", "h2", "weight")).alias("parts"))  # at most one document's segments

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(0))
            for k in range(batch.num_rows):
                parts = batch.column(1)[k].values
                columns = {f.name: parts.field(f.name).to_numpy(zero_copy_only=False) for f in parts.type}
                text = data[offsets[k]:offsets[k + 1]]
                text = (word_codes(text, np.array([0, len(text)]))[0] if coded else text).tobytes()
                bodies = [text[s:s + n + width - 1] for s, n in zip(columns["start"].tolist(), columns["windows"].tolist())]
                yield pa.record_batch([*[pa.array(columns[c]) for c in ("key", "h1", "h2", "windows", "weight")],
                                       pa.array(bodies, pa.binary())],
                                      names=["key", "h1", "h2", "windows", "weight", "body"])

    # Copies of a row differ in nothing, so one of them will do.
    once = rows_of(texts, wanted.select("row"), "row").dropDuplicates(["row"])
    return once.join(per_row, "row").select("text", "parts").mapInArrow(
        run, "key long, h1 long, h2 long, windows int, weight long, body binary")


def _split(hot: DataFrame, stretch: int, width: int) -> DataFrame:
    """Shorter stretches of hot segments, keyed by the bytes all windows of a stretch share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h1, h2, count, weight, body in zip(*(batch.column(c).to_pylist() for c in ("h1", "h2", "windows", "weight", "body"))):
                data = np.frombuffer(body, np.uint8)
                first, second = running(BYTE_BITS[data]), running(_OTHER_BITS[data])
                grams = _grams(first)
                least = np.flatnonzero(grams == grams.min())
                window = np.arange(count)
                anchor = least[np.searchsorted(least, window)]  # the first least gram of each window
                level = (anchor - window) // stretch
                edges = (anchor[1:] != anchor[:-1]) | (level[1:] != level[:-1])
                begin = np.concatenate([[0], np.flatnonzero(edges) + 1])
                size = np.diff(np.append(begin, count))
                # What every window at these distances from its anchor holds.
                from_byte = anchor[begin] - level[begin] * stretch
                shared = _digest(first, second, from_byte, from_byte - stretch + 1 + width)[0]
                with np.errstate(over="ignore"):
                    shared = mix(shared + level[begin].astype(np.uint64))
                g1, g2 = _digest(first, second, begin, begin + size + width - 1)
                bodies = [body[b:b + s + width - 1] for b, s in zip(begin.tolist(), size.tolist())]
                n = len(begin)
                yield pa.record_batch(
                    [pa.array(shared.view(np.int64)), pa.array(g1.view(np.int64)), pa.array(g2.view(np.int64)),
                     pa.array(size.astype(np.int32)), pa.array(np.full(n, weight)), pa.array(bodies, pa.binary()),
                     pa.array(np.full(n, h1)), pa.array(np.full(n, h2)), pa.array(begin.astype(np.int32))],
                    names=["key", "h1", "h2", "windows", "weight", "body", "p1", "p2", "shift"])

    return hot.mapInArrow(run, "key long, h1 long, h2 long, windows int, weight long, body binary, "
                               "p1 long, p2 long, shift int")


def _repeated(distinct: DataFrame, width: int) -> DataFrame:
    """``h1, h2, begin, stop``: stretches of repeated windows of every segment, from the suffix arrays of the shards."""

    def scan(rows: list) -> Iterator[tuple]:
        text = np.frombuffer(b"".join(body + _SEPARATOR for *_, body in rows), np.uint8)
        found = repeated_starts(text, width)
        at = 0
        for h1, h2, windows, weight, body in rows:
            own = np.ones(windows, bool) if weight > 1 else found[at:at + windows]
            at += len(body) + 1
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
            for begin, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
                yield h1, h2, begin, stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size, last = 0, None

        def report() -> Iterator[pa.RecordBatch]:
            out = list(scan(held))
            if out:
                columns = list(zip(*out))
                yield pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                       pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())],
                                      names=["h1", "h2", "begin", "stop"])

        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD and key != last:
                    yield from report()
                    held, size = [], 0
                held.append(row)
                size += len(row[-1]) + 1
                last = key
        if held:
            yield from report()

    return distinct.select("key", "h1", "h2", "windows", "weight", "body").repartition("key").sortWithinPartitions(
        "key").mapInArrow(run, "h1 long, h2 long, begin int, stop int")


def _hot_keys(distinct: DataFrame) -> DataFrame:
    return distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("key")


def _shard_runs(distinct: DataFrame, width: int, stretches: tuple[int, ...]) -> DataFrame:
    """Repeated stretches of all segments; hot keys are split by the first of ``stretches`` and go on with the rest."""
    hot = staged(_hot_keys(distinct), "repeats-hot") if stretches else None
    if hot is None or hot.isEmpty():
        return _repeated(distinct, width)
    cold = _repeated(distinct.join(hot, "key", "left_anti"), width)
    parts = staged(_split(distinct.join(hot, "key"), stretches[0], width), "repeats-split")
    counted = parts.groupBy("key", "h1", "h2").agg(
        F.first("windows").alias("windows"), F.sum("weight").alias("weight"), F.first("body").alias("body"))
    met = counted.groupBy("key").agg(F.sum("weight").alias("n")).filter("n > 1").select("key")
    shared = staged(counted.join(met, "key", "left_semi"), "repeats-parts")
    runs = _shard_runs(shared, width, stretches[1:])
    moved = parts.join(runs, ["h1", "h2"]).select(
        F.col("p1").alias("h1"), F.col("p2").alias("h2"), (F.col("begin") + F.col("shift")).alias("begin"),
        (F.col("stop") + F.col("shift")).alias("stop"))
    return cold.unionByName(moved.distinct())


def repeated_spans(texts: DataFrame, width: int, coded: bool = False, words: int = 0) -> DataFrame:
    """``row, spans``: for each row of ``texts(row, text)`` the stretches of windows that occur elsewhere too.

    ``coded`` looks in the texts' word codes; ``words`` leaves out segments whose windows all hold that many words.
    """
    all_segments = staged(segment_rows(texts, width, coded, words), "repeats-segments")
    met = all_segments.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("inner").alias("inner")).filter(
        "n > 1 or inner").select("key")
    candidates = staged(all_segments.join(met, "key", "left_semi"), "repeats-candidates")
    unstage(all_segments)
    wanted = staged(candidates.groupBy("key", "h1", "h2").agg(
        F.first("windows").alias("windows"), F.count(F.lit(1)).alias("weight"),
        F.min(F.struct("row", "start")).alias("at")).select(
        "key", "h1", "h2", "windows", "weight", "at.row", "at.start"), "repeats-wanted")
    distinct = staged(_with_text(wanted, texts, width, coded), "repeats-distinct")
    unstage(wanted)
    runs = staged(_shard_runs(distinct, width, (STRETCH, 1)), "repeats-runs")
    unstage(distinct)
    spans = staged(candidates.join(runs, ["h1", "h2"]).groupBy("row").agg(F.collect_list(F.struct(
        (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("stop") + (width - 1)).alias("stop")
    )).alias("spans")), "repeats-spans")
    unstage(candidates, runs)
    return spans


def remove_repeats(docs: DataFrame, width: int = 400, keep: tuple[str, ...] = (), kept_text: bool = False,
                   words: int = 0) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document, and the columns named by ``keep``.

    With ``kept_text`` also ``kept``, the remaining bytes as text; a character that lost some of its bytes is left out.
    With ``words`` passages of that many words go too, up to the word after them; white space does not tell them apart.
    Strings of ``width`` bytes with so many words in them then lose the repeated words, not parts of words.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        *keep, F.xxhash64("doc_id", "text").alias("_row"))
    rows = texts.select(F.col("_row").alias("row"), "text")
    spans = repeated_spans(rows, width, words=words).withColumnsRenamed({"row": "_row", "spans": "_spans"})
    if words:
        passages = repeated_spans(rows, words * CODE, coded=True).withColumnsRenamed({"row": "_row", "spans": "_words"})
        spans = staged(spans.join(passages, "_row", "full"), "repeats-both")
    else:
        spans = spans.withColumn("_words", F.lit(None).cast(spans.schema["_spans"].dataType))

    def ends_of(spans: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        if not spans.is_valid:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(spans.values.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("begin", "stop"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            out = []
            for k in range(batch.num_rows):
                text = data[offsets[k]:offsets[k + 1]]
                begin, stop = ends_of(batch.column(2)[k])
                first, last = ends_of(batch.column(3)[k])
                first, last = -(-first // CODE), last // CODE
                whole = last - first >= words
                if whole.any():
                    starts = np.append(word_bounds(text, np.array([0, len(text)]))[0], len(text))
                    begin = np.append(begin, starts[first[whole]])
                    stop = np.append(stop, starts[last[whole]])
                if not len(begin):
                    kept, count = text.tobytes(), 0
                else:
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, stop, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    count = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = text[~gone].tobytes()
                out.append((len(text), len(text) - len(kept), count, hashlib.sha256(kept).hexdigest(),
                            kept.decode("utf-8", "ignore") if kept_text else None))
            columns = list(zip(*out)) if out else [()] * 5
            arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                      pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())]
            if kept_text:
                arrays.append(pa.array(columns[4], pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[4:], *arrays], names=schema.names)

    # Texts without spans are not shuffled.
    hit, others = rows_apart(texts, spans.select("_row"), "_row")
    none = [F.lit(None).cast(spans.schema[name].dataType).alias(name) for name in ("_spans", "_words")]
    joined = hit.join(spans, "_row", "left").select("doc_id", "text", "_spans", "_words", *keep).unionByName(
        others.select("doc_id", "text", *none, *keep))
    schema = joined.drop("text", "_spans", "_words").schema
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    schema = schema.add("kept_sha256", "string")
    if kept_text:
        schema = schema.add("kept", "string")
    return joined.mapInArrow(run, schema)
