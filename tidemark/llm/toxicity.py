"""Toxicity of texts behind a noisy channel: leetspeak, spacing and repetition are decoded before scoring.

1. A trigram model of characters is counted over all texts; its size depends on the alphabet alone.
2. A written token becomes a lattice: each character stands for itself, for the letters it resembles, or for nothing
   (separators and repeats), each at a cost.  The Viterbi path under the character model is the restored word.
   Letters written apart (``i d i o t``) are taken together first.
3. Words and word beginnings of restored training texts get the log-odds of their document frequencies in toxic and
   clean ones; those with strong evidence form the lexicon.  A logistic curve over a document's evidence, fitted on
   the same rows, gives the score.

Learning reads a sample of at most about ``most_labelled`` labelled rows, chosen by a hash of doc_id.

Rows: null and empty texts are scored without evidence.  Without toxic or without clean training rows every score is
the share of toxic ones (0.5 if there are none).  Labels other than 0 and 1 are not learned from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import rows_of
from tidemark.plans.staging import staged

# The letters of the character model, and which letters a written character may stand for.
ALPHABET = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
RESEMBLES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
             "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l",
             "¡": "i", "¢": "c", "§": "s"}
HIDES = "aeiou"           # what an asterisk or a hash may stand for

RESEMBLE_COST, DROP_COST, REPEAT_COST, HIDDEN_COST, STRAY_COST = 0.3, 0.2, 0.5, 1.5, 4.0
PREFIXES = (4, 5, 6)      # word beginnings that are features of their own
MEMO = 300_000            # remembered tokens per worker
_WIDTH = len(ALPHABET) + 2
_NUMBER = {c: k + 2 for k, c in enumerate(ALPHABET)}   # 0: another letter, 1: the end of a word

_APART = re.compile(r"(?<!\S)\S(?:[ \t.\-_*]{1,3}\S){2,}(?!\S)")
_EDGE = re.compile(r"^(?:([^\w\s])\1+)+|(?:([^\w\s])\2+)+$")
_LETTERS = re.compile(r"[^\W\d_]+")
_THRICE = re.compile(r"(.)\1\1")
_TRAILING = ".,;:?\"')]}"


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    table = np.ones(0x110000, np.uint8)
    table[np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)] = 0
    for letter, number in _NUMBER.items():
        table[ord(letter)] = number
    return table


def character_model(texts: DataFrame) -> np.ndarray:
    """Costs ``[before last, last, next]`` of characters, counted over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(_WIDTH ** 3, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
                symbol = _table()[points].astype(np.int64)
                keep = np.ones(len(symbol), bool)
                keep[1:] = (symbol[1:] != 1) | (symbol[:-1] != 1)
                symbol = np.concatenate([[1], symbol[keep]])
                triples = (symbol[:-2] * _WIDTH + symbol[1:-1]) * _WIDTH + symbol[2:]
                if len(triples) > 1000:
                    seen += np.bincount(triples, minlength=_WIDTH ** 3)
                else:
                    np.add.at(seen, triples, 1)
        used = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(used), pa.array(seen[used])], names=["triple", "n"])

    rows = texts.select("text").mapInArrow(count, "triple long, n long").groupBy("triple").agg(
        F.sum("n").alias("n")).toArrow()  # at most the cube of the alphabet
    counts = np.full(_WIDTH ** 3, 0.01)
    counts[rows["triple"].to_numpy()] += rows["n"].to_numpy()
    counts = counts.reshape(_WIDTH, _WIDTH, _WIDTH)
    return -np.log(counts / counts.sum(axis=2, keepdims=True))


class Restorer:
    """Viterbi decoding of written tokens under a character model."""

    def __init__(self, cost: np.ndarray) -> None:
        self.cost = cost.tolist()

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """For each written character the letters it may be, '' for nothing, with their costs."""
        out = []
        for k, c in enumerate(token):
            if c.isalpha():
                options = [(c, 0.0)]
                if k and token[k - 1] == c:
                    thrice = (k > 1 and token[k - 2] == c) or (k + 1 < len(token) and token[k + 1] == c)
                    options.append(("", 0.1 if thrice else REPEAT_COST * 4))
            elif c in RESEMBLES:
                options = [(letter, RESEMBLE_COST) for letter in RESEMBLES[c]]
                options.append(("", REPEAT_COST if k and token[k - 1] == c else STRAY_COST))
            elif c in "*#":
                options = [("", DROP_COST * 3), *[(letter, HIDDEN_COST) for letter in HIDES]]
            else:
                options = [("", DROP_COST)]
            out.append(options)
        return out

    def restore(self, token: str) -> str:
        cost = self.cost
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(1, 1): (0.0, None)}
        for options in self.lattice(token):
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (total, path) in states.items():
                row = cost[a][b]
                for letter, price in options:
                    if letter:
                        number = _NUMBER.get(letter, 0)
                        state, spent, way = (b, number), total + price + row[number], (path, letter)
                    else:
                        state, spent, way = (a, b), total + price, path
                    known = following.get(state)
                    if known is None or spent < known[0]:
                        following[state] = (spent, way)
            states = following
        _, path = min(((total + cost[a][b][1], path) for (a, b), (total, path) in states.items()), key=lambda s: s[0])
        letters = []
        while path is not None:
            path, letter = path
            letters.append(letter)
        return "".join(reversed(letters))

    def words(self, token: str) -> list[str]:
        """Restored words of one written token: what it spells, and its plain parts."""
        if token.isalpha() and not _THRICE.search(token):
            return [token]
        core = _EDGE.sub("", token).rstrip(_TRAILING).lstrip("\"'([{")
        if core.isalpha() and not _THRICE.search(core):
            return [core]
        found = _LETTERS.findall(core)
        if any(c.isalpha() or c in RESEMBLES for c in core):
            found.append(self.restore(core))
        return found


def features(word: str) -> list[str]:
    return ["=" + word, *["^" + word[:n] for n in PREFIXES if len(word) >= n]]


def _tokens(text: str) -> set[str]:
    """Distinct written tokens of a lower-cased text, and the runs of letters written apart as one token each."""
    found = set(text.split())
    for run in _APART.findall(text):
        for part in re.split(r"\s{2,}", run):
            found.add(re.sub(r"[ \t]", "", part))
    return found


class Memo:
    """A function of tokens whose results are remembered, up to a fixed number."""

    def __init__(self, function) -> None:
        self.function, self.known = function, {}

    def __call__(self, token: str):
        value = self.known.get(token)
        if value is None:
            if len(self.known) >= MEMO:
                self.known.clear()
            value = self.known[token] = self.function(token)
        return value


def _evidence(text: str, weigh) -> tuple[float, float]:
    """Summed and counted log-odds of a text's distinct tokens, both damped."""
    weights = [w for w in map(weigh, _tokens(text.lower())) if w]
    return min(sum(weights), 40.0) / 10, float(np.log1p(len(weights)))


def _weigher(cost: np.ndarray, lexicon: dict[str, float]):
    restorer = Restorer(cost)

    def weigh(token: str) -> float:
        return max((lexicon.get(f, 0.0) for word in restorer.words(token) for f in features(word)), default=0.0)

    return Memo(weigh)


def learn(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000) -> dict:
    """The model from all texts of ``docs(doc_id, text)`` and the given rows of ``labels(doc_id, toxic)``."""
    cost = character_model(docs)
    labelled = labels.select("doc_id", "toxic").filter("toxic in (0, 1) and doc_id is not null")
    totals = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    share = totals.get(1, 0) / max(sum(totals.values()), 1) if totals else 0.5
    model = {"cost": cost, "lexicon": {}, "curve": None, "share": share}
    if len(totals) < 2:
        return model
    portion = min(1.0, most_labelled / sum(totals.values()))
    # All 62 bits of the hash, so that the share of a very large table is no rounded nothing.
    chosen = labelled.filter(
        F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 62)) < int(portion * (1 << 62)))
    sample = staged(rows_of(docs.select("doc_id", "text"), chosen.select("doc_id"), "doc_id").join(chosen, "doc_id").select(
        "text", F.col("toxic").cast("int").alias("toxic")), "labelled-texts")
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(cost)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Memo(Restorer(shared.value).words)
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            rows = [0, 0]
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows[toxic] += 1
                seen[toxic].update({f for token in _tokens((text or "").lower()) for w in words(token) for f in features(w)})
            names = list({*seen[0], *seen[1]})
            yield pa.record_batch([pa.array([*names, ""]), pa.array([*[seen[0][f] for f in names], rows[0]], pa.int64()),
                                   pa.array([*[seen[1][f] for f in names], rows[1]], pa.int64())],
                                  names=["feature", "clean", "toxic"])

    counted = sample.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter("toxic >= 4 or feature = ''")
    rows = {r["feature"]: (r["clean"], r["toxic"]) for r in counted.filter(  # bounded by the sample
        "feature = '' or toxic > 2 * clean").collect()}
    clean, toxic = rows.pop("", (0, 0))
    for feature, (c, t) in rows.items():
        odds = float(np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1)))
        spread = float(np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)))
        if odds > 2.5 and odds > 2.5 * spread:
            model["lexicon"][feature] = odds
    learned = context.broadcast((cost, model["lexicon"]))

    def weigh_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = _weigher(*learned.value)
        for batch in batches:
            pairs = [_evidence(t or "", weigh) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([p[0] for p in pairs], pa.float64()), pa.array([p[1] for p in pairs], pa.float64()),
                                   batch.column(1)], names=["total", "many", "toxic"])

    fitted = sample.mapInArrow(weigh_rows, "total double, many double, toxic int").groupBy(
        F.round("total", 2).alias("total"), F.round("many", 2).alias("many"), "toxic").agg(
        F.count(F.lit(1)).alias("n")).toPandas()  # bounded by the sample
    model["curve"] = _logistic(fitted[["total", "many"]].to_numpy(float), fitted["toxic"].to_numpy(float),
                               fitted["n"].to_numpy(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05, steps: int = 40) -> list[float]:
    """Weights of a logistic curve, the intercept first, by Newton steps with a ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        curvature = (x.T * (weight * p * (1 - p))) @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, score, evidence`` of every row; ``evidence`` counts the tokens the lexicon weighs (damped)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        weigh = _weigher(known["cost"], known["lexicon"])
        for batch in batches:
            pairs = np.array([_evidence(t or "", weigh) for t in batch.column(1).to_pylist()]).reshape(-1, 2)
            if known["curve"] is None:
                result = np.full(len(pairs), known["share"])
            else:
                b = known["curve"]
                result = 1 / (1 + np.exp(-np.clip(b[0] + pairs @ np.array(b[1:]), -30, 30)))
            yield pa.record_batch([batch.column(0), pa.array(result), pa.array(pairs[:, 1].copy())],
                                  names=["doc_id", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, evidence double")


def toxicity(docs: DataFrame, labels: DataFrame, known: Column, most_labelled: int = 20_000) -> DataFrame:
    """Learn from the rows of ``labels`` where ``known`` holds, and score every document."""
    return score(docs, learn(docs, labels.filter(known), most_labelled))
