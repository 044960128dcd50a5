"""Language identification by cross-parsing entropy.

For every language a suffix automaton of labelled text accepts exactly the substrings of that text.  A document is
cut greedily into longest matches (phrases) against each automaton; the language that needs the fewest phrases per
symbol wins.  The automaton is used as a table of transitions: a walk follows a phrase until no transition is left,
so one step per symbol finds every longest match.  The table is dense where letters are few and else a sorted list of
the transitions there are, so that scripts of thousands of letters fit; both give the same phrases.

Learning reads a bounded sample: ``sample_docs`` documents per language, chosen by a hash of their id, of which
``slice_chars`` characters each are taken at a hashed place, until ``sample_chars`` characters are reached.  All letters
of the sample have symbols of their own; a letter outside of it is in no automaton and a phrase by itself.

Rows: a text that is null or holds no letter gets ``und`` with score 0; so does every text when nothing could be
learned.  Equal phrase counts go to the first language in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.plans.staging import staged

SPAN = 256           # symbols walked as one column; phrases end at its borders
PIECE = 1 << 21      # characters decoded at a time
DENSE = 1 << 22      # entries of a dense table of transitions (16 MB)


def _symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the lower-cased texts and each text's offset; runs of non-letters become one symbol 1.

    Letters that the sample does not hold are symbol 0, which no automaton accepts.
    """
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = table[points]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 1) | (symbols[:-1] != 1)
    kept = np.concatenate([[0], np.cumsum(keep)])
    return symbols[keep], np.concatenate([[0], kept[ends]])


@lru_cache(maxsize=2)
def letters_table(alphabet: str) -> np.ndarray:
    """Symbol of every code point: 0 for unknown letters, 1 for non-letters, then the alphabet."""
    table = np.zeros(0x110000, np.int32)
    blank = np.fromiter((not chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    table[blank] = 1
    for k, letter in enumerate(alphabet):
        table[ord(letter)] = k + 2
    return table


class Transitions:
    """Transitions between states, each named by its number times ``width``; 0 is the root, -1 is no transition."""

    def __init__(self, steps: list[dict[int, int]], width: int, dense: int = DENSE):
        held = [(state * width + s, onto * width) for state, row in enumerate(steps) for s, onto in sorted(row.items())]
        self.keys, onto = np.array(held, np.int64).reshape(-1, 2).T
        self.onto = np.append(onto, -1)
        self.table = None
        if len(steps) * width <= dense:
            self.table = np.full(len(steps) * width, -1, np.int32)
            self.table[self.keys] = onto
            self.keys = self.onto = None

    def after(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The states that follow."""
        if self.table is not None:
            return self.table[state + symbol]
        wanted = state + symbol
        place = np.searchsorted(self.keys, wanted)
        found = np.zeros(len(wanted), bool)
        inside = place < len(self.keys)
        found[inside] = self.keys[place[inside]] == wanted[inside]
        return np.where(found, self.onto[place], -1)


def suffix_automaton(symbols: list[int], width: int, dense: int = DENSE) -> Transitions:
    """Transitions of the substrings of one text, whose symbols are below ``width``."""
    steps: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols:
        state = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        back = last
        while back != -1 and s not in steps[back]:
            steps[back][s] = state
            back = link[back]
        if back != -1:
            onto = steps[back][s]
            if length[onto] == length[back] + 1:
                link[state] = onto
            else:
                copy = len(steps)
                steps.append(dict(steps[onto]))
                link.append(link[onto])
                length.append(length[back] + 1)
                while back != -1 and steps[back].get(s) == onto:
                    steps[back][s] = copy
                    back = link[back]
                link[onto] = link[state] = copy
        last = state
    return Transitions(steps, width, dense)


def phrase_counts(symbols: np.ndarray, offsets: np.ndarray, automata: list[Transitions]) -> np.ndarray:
    """Phrases of each text against each automaton, ``[text, language]``."""
    texts = len(offsets) - 1
    size = np.diff(offsets)
    spans = -(-size // SPAN)
    owner = np.repeat(np.arange(texts), spans)
    start = offsets[owner] + SPAN * (np.arange(len(owner)) - np.repeat(np.cumsum(spans) - spans, spans))
    stop = np.minimum(start + SPAN, offsets[owner + 1])
    order = np.argsort(start - stop, kind="stable")  # longest first: the walk keeps a prefix of the spans
    owner, start, length = owner[order], start[order], (stop - start)[order]
    counts = np.zeros((texts, len(automata)), np.int64)
    active = np.searchsorted(-length, -np.arange(1, SPAN + 1), side="right")
    columns = [symbols[start[:n] + k] for k, n in enumerate(active.tolist()) if n]
    root = np.zeros(len(start), np.int64)
    for lang, automaton in enumerate(automata):
        state = np.zeros(len(start), np.int64)
        phrases = np.ones(len(start), np.int64)
        for column in columns:
            n = len(column)
            onto = automaton.after(state[:n], column)
            stuck = onto < 0
            restart = np.maximum(automaton.after(root[:n], column), 0)  # a symbol the text lacks is a phrase of its own
            phrases[:n] += stuck
            state[:n] = np.where(stuck, restart, onto)
        counts[:, lang] = np.bincount(owner, phrases, minlength=texts)
    return counts


def learn(docs: DataFrame, known: Column, sample_docs: int, slice_chars: int, sample_chars: int) -> dict:
    """Automata per language from a bounded sample of the labelled rows, the same in every run."""
    labelled = docs.filter(known & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    labelled = labelled.select("lang", F.xxhash64(F.col("doc_id").cast("string")).alias("h"),
                               "text").filter(F.length("text") > 0)
    # One row per language; as a table its size is known, so the join need not shuffle the texts.
    counts = staged(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    # Thin out by hash first, so that the ranking meets a few times the wanted rows of each language at most.
    thinned = labelled.join(counts, "lang").filter(
        (F.pmod("h", F.lit(1 << 20)) * F.col("rows") <= F.lit(4 * sample_docs) * F.lit(1 << 20)))
    cut = thinned.select("lang", "h", F.expr(
        f"substring(text, 1 + cast(pmod(h div 1048576, greatest(length(text) - {slice_chars}, 0) + 1) as int), {slice_chars})"
    ).alias("part"))
    ranked = cut.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "part")))
    parts: dict[str, str] = {}
    for row in ranked.filter(F.col("k") <= sample_docs).orderBy("lang", "k").toLocalIterator():  # bounded by sample_docs
        text = parts.setdefault(row["lang"], "")
        if len(text) < sample_chars:
            parts[row["lang"]] = text + row["part"].lower() + "\n"
    langs = sorted(parts)
    alphabet = "".join(sorted({letter for text in parts.values() for letter in text if letter.isalpha()}))
    table = letters_table(alphabet)
    automata = [suffix_automaton(_symbols([parts[g]], table)[0].tolist(), len(alphabet) + 2) for g in langs]
    return {"langs": langs, "alphabet": alphabet, "automata": automata}


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (share of the runner-up's phrases in the two best, doubled, less 1) and
    ``phrase_rate``, the winner's phrases per symbol."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by sample_chars per language
    passed = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "phrase_rate")]
    names = [f.name for f in passed]
    schema = docs.select(*names).schema.add("lang_pred", "string").add("score", "double").add("phrase_rate", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, automata = shared.value["langs"], shared.value["automata"]
        table = letters_table(shared.value["alphabet"])
        for batch in batches:
            texts = [(t or "").lower() for t in batch.column(names.index("text")).to_pylist()]
            pred, score, rate = [], [], []
            begin = 0
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and (end == begin or chars + len(texts[end]) <= PIECE):
                    chars += len(texts[end])
                    end += 1
                symbols, offsets = _symbols(texts[begin:end], table)
                letters = np.concatenate([[0], np.cumsum(symbols != 1)])
                letters = letters[offsets[1:]] - letters[offsets[:-1]]
                counts = phrase_counts(symbols, offsets, automata) if langs else np.zeros((end - begin, 1))
                for k in range(end - begin):
                    if not letters[k] or not langs:
                        pred.append("und")
                        score.append(0.0)
                        rate.append(None)
                        continue
                    best = int(np.argmin(counts[k]))
                    fewest = float(counts[k][best])
                    next_best = float(np.min(np.delete(counts[k], best))) if len(langs) > 1 else 2 * fewest
                    pred.append(langs[best])
                    score.append(min(1.0, 2 * next_best / (fewest + next_best) - 1))
                    rate.append(fewest / float(offsets[k + 1] - offsets[k]))
                begin = end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())],
                names=[*names, "lang_pred", "score", "phrase_rate"])

    return docs.select(*names).mapInArrow(run, schema)


def language_id(docs: DataFrame, known: Column, sample_docs: int = 400, slice_chars: int = 400,
                sample_chars: int = 48_000) -> DataFrame:
    """Learn from the rows where ``known`` holds and identify every row."""
    return identify(docs, learn(docs, known, sample_docs, slice_chars, sample_chars))
