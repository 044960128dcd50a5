"""Benchmark decontamination with a generalised suffix automaton of the test items' words.

Words are runs of ASCII letters and digits and of all other characters from U+0080 on, with A-Z in lower case.  A window
is ``width`` consecutive words of an item; an item of fewer words is one window as a whole.  The automaton accepts
every word sequence inside an item.  A document's words are streamed through it; the state and the length of the
longest match tell at each word which windows end there, and all words of such a window are hit.

Items are cut into pieces that overlap by ``width - 1`` words and dealt to shards of at most ``SHARD_WORDS`` words;
each shard's automaton is built in a task and written to the shared folder.  The driver hands them on one by one as
broadcasts of a bounded size, ``SHARDS_AT_ONCE`` to a pass over the documents; a benchmark of up to
``SHARD_WORDS * SHARDS_AT_ONCE`` words needs one pass, without any shuffle.

Only stretches of known words that are long enough for a window are streamed: a word that no item holds sends the
automaton back to its root.  Which words may be known is read from hashes computed for many texts at once; the streamed
words themselves are compared as bytes.

Rows: a null or empty text has no words and no hits; repeated documents are judged each; null or empty items have no
window; repeated items count once by their id, a null id counts as the empty one; empty tables give an empty result or
no hits.  Other columns are not looked at.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, pieces, prepare_texts
from tidemark.llm.wordhash import LOWER_BITS, mix, running, window_hash, word_bounds
from tidemark.plans.staging import staged

_U = np.uint64
SHARD_WORDS = 250_000    # words of one automaton
SHARDS_AT_ONCE = 4       # automata a task holds at a time
PIECE_BYTES = 1 << 20    # texts hashed together, and the stretch of a long text

BLANK = np.ones(256, bool)
BLANK[0x30:0x3A] = False
BLANK[0x41:0x5B] = False
BLANK[0x61:0x7B] = False
BLANK[0x80:] = False


class Automaton:
    """Generalised suffix automaton of word sequences, with what ends in each state.

    ``known`` numbers the words.  ``length`` and ``link`` are the states' longest strings and suffix links; the
    transitions are three parallel arrays sorted by state and word.  ``window[s]`` is the state of the last ``width``
    words of any longer match in ``s`` (0 if none is that long), ``short[s]`` the nearest suffix state that is a whole
    short item.  ``items`` maps such states to item numbers.
    """

    def __init__(self, sequences: list[tuple[str, list[bytes]]], width: int) -> None:
        self.width = width
        self.known: dict[bytes, int] = {}
        coded = [(item, [self.known.setdefault(w, len(self.known)) for w in words]) for item, words in sequences if words]
        steps, length, link = self._build([words for _, words in coded])
        self.words = list(self.known)
        keys, targets = [], []
        for state, after in enumerate(steps):
            for word in sorted(after):
                keys.append((state << 32) | word)
                targets.append(after[word])
        self.keys, self.targets = np.array(keys, np.int64), np.array(targets, np.int32)
        self.length, self.link = np.array(length, np.int32), np.array(link, np.int32)
        order = np.argsort(self.length, kind="stable")
        window = [0] * len(length)
        for s in order.tolist():
            if length[s] >= width:
                up = link[s]
                window[s] = window[up] if length[up] >= width else s
        self.window = np.array(window, np.int32)
        names: dict[str, int] = {}
        holds: dict[int, set[int]] = {}
        whole: dict[int, int] = {}
        for item, words in coded:
            number = names.setdefault(item, len(names))
            state = matched = 0
            for word in words:
                state = steps[state][word]
                matched += 1
                if matched >= width:
                    holds.setdefault(window[state], set()).add(number)
            if matched < width:
                holds.setdefault(-state, set()).add(number)
                whole[state] = matched
        short = [0] * len(length)
        for s in order.tolist()[1:]:
            short[s] = s if s in whole else short[link[s]]
        self.short = np.array(short, np.int32)
        self.whole = whole
        self.items = {s: sorted(numbers) for s, numbers in holds.items()}
        self.names = list(names)
        self.least = min([width, *whole.values()])

    @staticmethod
    def _build(sequences: list[list[int]]) -> tuple[list[dict[int, int]], list[int], list[int]]:
        steps: list[dict[int, int]] = [{}]
        length, link = [0], [-1]

        def split(p: int, q: int, word: int) -> int:
            """A copy of state ``q`` that holds only its strings up to the one that ``p`` reaches."""
            copy = len(steps)
            steps.append(dict(steps[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            link[q] = copy
            while p >= 0 and steps[p].get(word) == q:
                steps[p][word] = copy
                p = link[p]
            return copy

        for sequence in sequences:
            last = 0
            for word in sequence:
                p = last
                q = steps[p].get(word)
                if q is not None:
                    last = q if length[q] == length[p] + 1 else split(p, q, word)
                    continue
                now = len(steps)
                steps.append({})
                length.append(length[p] + 1)
                link.append(0)
                while p >= 0 and word not in steps[p]:
                    steps[p][word] = now
                    p = link[p]
                if p >= 0:
                    q = steps[p][word]
                    link[now] = q if length[q] == length[p] + 1 else split(p, q, word)
                last = now
        return steps, length, link


class Scanner:
    """Streams documents through one automaton."""

    def __init__(self, automaton: Automaton) -> None:
        self.a = automaton
        self.keys, self.targets = automaton.keys.tolist(), automaton.targets.tolist()
        self.length, self.link = automaton.length.tolist(), automaton.link.tolist()
        self.window, self.short = automaton.window.tolist(), automaton.short.tolist()
        data = np.frombuffer(b"".join(automaton.words), np.uint8)
        ends = np.cumsum([len(w) for w in automaton.words], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.hashes = np.sort(word_hashes(data, starts, ends)) if len(data) else np.zeros(0, _U)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.hashes & _U((1 << 20) - 1)] = True

    def known(self, hashed: np.ndarray) -> np.ndarray:
        """Whether a word of this hash may be one of the items'."""
        found = self.maybe[hashed & _U((1 << 20) - 1)]
        at = np.flatnonzero(found)
        if len(at):
            place = np.searchsorted(self.hashes, hashed[at])
            found[at] = self.hashes[np.minimum(place, len(self.hashes) - 1)] == hashed[at]
        return found

    def step(self, state: int, word: int) -> int:
        key = (state << 32) | word
        at = bisect_left(self.keys, key)
        return self.targets[at] if at < len(self.keys) and self.keys[at] == key else -1

    def stream(self, words: list[bytes], first: int, spans: list[tuple[int, int]], states: set[int]) -> None:
        """Matches in a stretch of words, the first of which has the number ``first``."""
        width, whole = self.a.width, self.a.whole
        state = matched = 0
        for at, raw in enumerate(words, first):
            word = self.a.known.get(raw, -1)
            if word < 0:
                state = matched = 0
                continue
            after = self.step(state, word)
            while after < 0 and state:
                state = self.link[state]
                matched = self.length[state]
                after = self.step(state, word)
            if after < 0:
                state = matched = 0
                continue
            state, matched = after, matched + 1
            if matched >= width:
                states.add(self.window[state])
                spans.append((at - width + 1, at + 1))
            ends = self.short[state]
            while ends:
                if whole[ends] <= matched:
                    states.add(-ends)
                    spans.append((at - whole[ends] + 1, at + 1))
                ends = self.short[self.link[ends]]


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(window_hash(running(LOWER_BITS[data]), start, stop) + (stop - start).astype(_U))


def long_runs(known: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of at least ``least`` known words."""
    edge = np.diff(np.concatenate([[False], known, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep = end - begin >= least
    return begin[keep], end[keep]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _windows_of_text(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word bounds of one text in stretches cut between words, so a long text needs no more memory than its words."""
    start, size = 0, len(data)
    while start < size:
        stop = min(start + PIECE_BYTES, size)
        while stop < size and not BLANK[data[stop]]:
            gap = np.flatnonzero(BLANK[data[stop:stop + PIECE_BYTES]])
            stop = stop + int(gap[0]) if len(gap) else min(stop + PIECE_BYTES, size)
        begin, end = word_bounds(data[start:stop], np.array([0, stop - start]), BLANK)
        yield begin + start, end + start
        start = stop


def item_pieces(items: DataFrame, width: int, most: int) -> DataFrame:
    """``item, words``: pieces of at most ``most`` words of every item, overlapping by ``width - 1``."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            names = batch.column(0).to_pylist()
            for k, name in enumerate(names):
                text = data[offsets[k]:offsets[k + 1]]
                begin, end = word_bounds(text, np.array([0, len(text)]), BLANK)
                raw = text.tobytes().lower()
                for first in range(0, max(len(begin) - width + 1, min(len(begin), 1)), most - width + 1):
                    last = min(first + most, len(begin))
                    words = b" ".join([raw[a:b] for a, b in zip(begin[first:last].tolist(), end[first:last].tolist())])
                    yield pa.record_batch([pa.array([name]), pa.array([words], pa.binary()),
                                           pa.array([last - first], pa.int64())], names=["item", "words", "n"])

    return rows.mapInArrow(run, "item string, words binary, n long")


def automata(items: DataFrame, width: int, shard_words: int) -> DataFrame:
    """``automaton`` (pickled) of every shard of the items, written to the shared folder."""
    cut = staged(item_pieces(items, width, shard_words), "leaks-items")
    total = cut.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def built(held: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array([pickle.dumps(Automaton(held, width), 5)], pa.binary())], names=["automaton"])

        held, size = [], 0
        for batch in batches:
            for item, words, n in zip(*(c.to_pylist() for c in batch.columns)):
                if held and size + n > shard_words:
                    yield built(held)
                    held, size = [], 0
                held.append((item, words.split(b" ")))
                size += n
        if held:
            yield built(held)

    dealt = cut.withColumn("_shard", F.pmod(F.xxhash64("item", "words"), F.lit(shards))).repartition(
        shards, "_shard").sortWithinPartitions("item", "words").drop("_shard")
    return staged(dealt.mapInArrow(run, "automaton binary"), "leaks-automata")


def scan(docs: DataFrame, items: DataFrame, width: int = 10, keep: tuple[str, ...] = (),
         shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, text, n_words, spans, items`` of every document, and the columns named by ``keep``.

    ``spans`` are its maximal hit stretches (first word, word after the last, and their bytes), ``items`` the sorted
    ids of the items with occurring windows.
    """
    spark = prepare_texts(docs.sparkSession)
    span = "array<struct<first: long, stop: long, begin: long, end: long>>"
    found = docs.select("doc_id", F.col("text").cast("string").alias("text"), *keep, F.lit(0).cast("long").alias("n_words"),
                        F.lit(None).cast(span).alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    blobs = automata(items, width, shard_words)
    group: list = []
    for row in blobs.toLocalIterator():  # one automaton at a time
        if len(group) == SHARDS_AT_ONCE:
            found = staged(_pass(found, group, keep), "leaks-pass")
            group = []
        group.append(spark.sparkContext.broadcast(bytes(row.automaton)))
    return _pass(found, group, keep)


def _pass(docs: DataFrame, group: list, keep: tuple[str, ...]) -> DataFrame:
    """One pass over the documents: adds what the automata of ``group`` find to the spans and items so far."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanners = [Scanner(pickle.loads(shared.value)) for shared in group]
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            base = 2 + len(keep)
            counts = np.zeros(batch.num_rows, np.int64)
            spans: list = batch.column(base + 1).to_pylist()
            items: list = batch.column(base + 2).to_pylist()
            for a, b in pieces(offsets, PIECE_BYTES):
                text, inner = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                if b - a == 1 and len(text) > PIECE_BYTES:
                    bounds = list(_windows_of_text(text))
                    begin = np.concatenate([x for x, _ in bounds]) if bounds else np.zeros(0, np.int64)
                    end = np.concatenate([x for _, x in bounds]) if bounds else np.zeros(0, np.int64)
                    hashed = np.concatenate([word_hashes(text[x[0]:y[-1]], x - x[0], y - x[0]) for x, y in bounds if len(x)]
                                            or [np.zeros(0, _U)])
                else:
                    begin, end = word_bounds(text, inner, BLANK)
                    hashed = word_hashes(text, begin, end) if len(begin) else np.zeros(0, _U)
                edges = np.searchsorted(begin, inner)
                counts[a:b] = np.diff(edges)
                for scanner in scanners:
                    known = scanner.known(hashed)
                    if not known.any():
                        continue
                    found: dict[int, tuple[list, set]] = {}
                    for first, stop in zip(*(x.tolist() for x in long_runs(known, scanner.a.least))):
                        # A stretch may cross from one text to the next; it is cut there.
                        row = int(np.searchsorted(edges, first, side="right")) - 1
                        while first < stop:
                            last = min(stop, int(edges[row + 1]))
                            if last - first >= scanner.a.least:
                                raw = [text[x:y].tobytes().lower()
                                       for x, y in zip(begin[first:last].tolist(), end[first:last].tolist())]
                                own = found.setdefault(row, ([], set()))
                                scanner.stream(raw, first - int(edges[row]), *own)
                            first, row = last, row + 1
                    for row, (hits, states) in found.items():
                        if not hits:
                            continue
                        at = int(edges[row])
                        old = [(s["first"], s["stop"]) for s in spans[a + row] or ()]
                        spans[a + row] = [
                            {"first": x, "stop": y, "begin": int(begin[at + x] - inner[row]),
                             "end": int(end[at + y - 1] - inner[row])} for x, y in merge_spans(old + hits)]
                        names = {scanner.a.names[n] for s in states for n in scanner.a.items[s]}
                        items[a + row] = sorted(names.union(items[a + row] or ()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:base], pa.array(counts), pa.array(spans, batch.schema.field(base + 1).type),
                 pa.array(items, batch.schema.field(base + 2).type)], names=schema.names)

    return docs.mapInArrow(run, schema)


def measures(scanned: DataFrame) -> DataFrame:
    """``scanned`` with ``n_hit`` (words in spans), ``coverage`` (their part of all words) and ``longest`` (span)."""
    sizes = F.transform(F.coalesce("spans", F.array().cast(scanned.schema["spans"].dataType)), lambda s: s["stop"] - s["first"])
    n_hit = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b)
    return scanned.withColumn("n_hit", n_hit).withColumn(
        "coverage", F.when(F.col("n_words") > 0, n_hit / F.col("n_words")).otherwise(0.0)).withColumn(
        "longest", F.coalesce(F.array_max(sizes), F.lit(0).cast("long")))


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    found = measures(scan(docs, items, width, shard_words=shard_words))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", "n_hit",
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def remove_spans(docs: DataFrame, items: DataFrame, width: int = 10, least_words: int = 13, most_coverage: float = 0.5,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text``, ``keep`` and the measures of the documents that stay, without long spans of test items.

    Spans of at least ``least_words`` words are cut out of the text; a document whose hit words are more than
    ``most_coverage`` of all is left out.
    """
    found = measures(scan(docs, items, width, keep)).filter(F.col("coverage") <= most_coverage)
    schema = found.drop("items").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1).to_pylist(), batch.column(batch.schema.get_field_index("spans")).to_pylist()
            for k, own in enumerate(spans):
                cut = [s for s in own or () if s["stop"] - s["first"] >= least_words]
                if cut:
                    raw, out, at = texts[k].encode(), [], 0
                    for s in cut:
                        out.append(raw[at:s["begin"]])
                        at = s["end"]
                    texts[k] = b"".join([*out, raw[at:]]).decode()
            columns = dict(zip(batch.schema.names, batch.columns)) | {"text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in schema.names], names=schema.names)

    return found.mapInArrow(run, schema)


# The same by joining windows as strings; items of fewer than ten words are windows of their own length.
LEAKS_SQL = r"""
WITH item_words AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS body
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS k FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS row, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT row, k, n, array_to_string(w[k:k + n - 1], ' ') AS body
  FROM (SELECT row, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM doc_words, sizes WHERE len(w) >= n)),
hits AS (SELECT g.row, g.k, g.n, x.item FROM grams g JOIN windows x ON x.n = g.n AND x.body = g.body),
covered AS (
  SELECT row, count(DISTINCT p) AS n_hit
  FROM (SELECT row, unnest(generate_series(k, k + n - 1)) AS p FROM (SELECT DISTINCT row, k, n FROM hits)) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
"""
