"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lowers case, maps look-alike letters to Latin and digits or signs that stand for
letters to those letters. Lexicon entries are word beginnings (or whole words, with a
space at their end) and carry log-odds weights learnt from labelled rows. Hits inside an
exception phrase do not count. The sum of the weights, divided by the number of words,
and whether anything was hit at all go through a logistic curve fitted to the same rows.

Training takes a bounded sample (``max_train`` labelled rows per class, chosen by a hash
of doc_id); everything else is one map over the documents, without a shuffle. What the
lexicon may hold is set by :class:`Limits`, each of which can be lifted.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import discard, sparing, written

#: Letters that look like Latin ones, and what stands for a letter.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k",
    "м": "m", "т": "t", "н": "h", "в": "b", "г": "r", "п": "n", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ι": "i", "κ": "k", "ν": "v", "η": "n",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
IGNORED = "​‌‍⁠­﻿"

#: Entries that a task tallies before it hands them on.
TALLIED = 150_000

_FULLWIDTH = {0xFF41 + i: chr(97 + i) for i in range(26)}
_LETTERS = {ord(k): v for k, v in HOMOGLYPHS.items()} | _FULLWIDTH | {ord(c): None for c in IGNORED}
_ALL = _LETTERS | {ord(k): v for k, v in SUBSTITUTES.items()}

#: Phrases in which a listed word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "clownfish", "idiot proof", "trash bag")

_SUBSTITUTED = re.compile(r"(?:[^\W_]|[@$!])+")
_WORD = re.compile(r"[^\W\d_]+")
_HAS_MIX = re.compile(r"[013457 8@$!]".replace(" ", ""))


@dataclass(frozen=True)
class Limits:
    """What the lexicon is made of; None lifts a limit.

    ``most_entries`` entries at most, the most telling ones; entries of ``shortest`` to
    ``longest`` letters (whole words may be longer); a word counts ``repeats`` times per
    text at most; no weight above ``top_weight``; an entry occurs in at least
    ``least_docs`` and the share ``least_share`` of the toxic texts, is ``odds`` (a
    logarithm) likelier among toxic words, and has a likelihood-ratio statistic of ``gain``.
    """

    most_entries: int | None = 400
    shortest: int = 4
    longest: int | None = 10
    repeats: int | None = 4
    top_weight: float | None = 8.0
    least_docs: int = 3
    least_share: float = 0.01
    odds: float = 1.6
    gain: float = 40.0


def fold(text: str) -> str:
    """Lower case, look-alikes mapped, and substitutes mapped inside words that also hold letters."""
    low = text.lower()
    if not low.isascii():
        low = low.translate(_LETTERS)
    if _HAS_MIX.search(low):
        low = _SUBSTITUTED.sub(_unmasked, low)
    return low


def _unmasked(found: re.Match) -> str:
    word = found[0]
    if not _HAS_MIX.search(word) or not _WORD.search(word):
        return word
    body = word.rstrip("!$@")  # signs at a word's end are punctuation
    return body.translate(_ALL) + word[len(body) :]


@dataclass
class Model:
    """Lexicon weights, exception phrases and the logistic curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    intercept: float = -4.0
    amount: float = 1.0
    density: float = 1.0

    def automaton(self) -> ahocorasick.Automaton | None:
        """The matcher over entries and exceptions; None for an empty lexicon."""
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None, False))
        for entry, weight in self.weights.items():
            plain = entry.rstrip(" ")
            found.add_word(plain, (len(plain), weight, plain != entry))
        found.make_automaton()
        return found

    def features(self, text: str | None, matcher: ahocorasick.Automaton | None) -> tuple[float, float]:
        """Logs of the weighted hits and of the weighted hits per hundred words."""
        if not text or matcher is None:
            return 0.0, 0.0
        folded = fold(text)
        hits, quiet, last = [], [], len(folded)
        for end, (length, weight, whole) in matcher.iter(folded):
            start = end + 1 - length
            if start and folded[start - 1].isalnum():
                continue
            if weight is None:
                quiet.append((start, end))
            elif not whole or end + 1 == last or not folded[end + 1].isalnum():
                hits.append((start, end, weight))
        total = sum(w for s, e, w in _outside(hits, quiet))
        if not total:
            return 0.0, 0.0
        return math.log1p(total), math.log1p(100.0 * total / (len(folded.split()) or 1))

    def score(self, features: tuple[float, float]) -> float:
        """0 to 1."""
        at = self.intercept + self.amount * features[0] + self.density * features[1]
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, at))))


def _outside(hits: list[tuple[int, int, float]], quiet: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
    """The hits (start, end, weight) that lie in no quiet span, by one sorted sweep."""
    if not quiet:
        return hits
    quiet = sorted(quiet)
    starts, furthest, most = [a for a, _ in quiet], [], -1
    for _, b in quiet:
        most = max(most, b)
        furthest.append(most)
    return [h for h in hits if not (n := bisect.bisect_right(starts, h[0])) or furthest[n - 1] < h[1]]


def candidates(text: str, limits: Limits = Limits()) -> tuple[Counter, int]:
    """Occurrences of word beginnings and whole words that could become entries, and the number of words.

    A word that a text repeats counts ``limits.repeats`` times at most: junk that says one
    word a thousand times tells no more than other texts do.
    """
    out: Counter = Counter()
    words = {w: min(n, limits.repeats or n) for w, n in Counter(_WORD.findall(fold(text))).items()}
    for word, n in words.items():
        for k in range(limits.shortest, min(len(word), limits.longest or len(word)) + 1):
            out[word[:k]] += n
        if len(word) >= limits.shortest:
            out[word + " "] += n
    return out, sum(words.values())


def choose_entries(ranked: Iterable[tuple[str, float]], limits: Limits = Limits()) -> dict[str, float]:
    """Entries of a ranking (entry, weight), the most telling first, until there are enough.

    No entry begins like a chosen one or the other way round.
    """
    chosen: dict[str, float] = {}
    taken: set[str] = set()
    for entry, value in ranked:
        if limits.most_entries is not None and len(chosen) >= limits.most_entries:
            break
        plain = entry.rstrip(" ")
        begins = [plain[:k] for k in range(1, len(plain) + 1)]
        if plain not in taken and not any(x in chosen or x + " " in chosen for x in begins):
            chosen[entry] = value if limits.top_weight is None else min(value, limits.top_weight)
            taken.update(begins)
    return chosen


def ranking(tallied: DataFrame, toxic_words: int, clean_words: int, least: int, limits: Limits) -> DataFrame:
    """(entry, weight) of all tallied entries that tell enough, ranked by how much (likelihood ratio), of equal ones the longer first."""
    toxic, clean = F.col("toxic").cast("double"), F.col("clean").cast("double")
    share = toxic_words / max(1, toxic_words + clean_words)
    weight = F.ln((toxic + 0.5) / float(toxic_words + 1)) - F.ln((clean + 0.5) / float(clean_words + 1))
    part = lambda n, of: F.when(n > 0, n * F.ln(n / ((toxic + clean) * of))).otherwise(0.0)
    told = F.when(toxic > 0, 2 * (part(toxic, share) + part(clean, 1 - share))).otherwise(0.0)
    rows = tallied.where(F.col("entry") != "").where(F.col("docs") >= least)
    rows = rows.select("entry", weight.alias("weight"), F.round(told, 6).alias("told"))
    rows = rows.where((F.col("weight") >= limits.odds) & (F.col("told") >= limits.gain))
    return rows.orderBy(F.desc("told"), F.desc(F.length("entry")), F.desc("entry")).select("entry", "weight")


def fit_curve(features: np.ndarray, labels: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton steps: intercept, amount, density."""
    x = np.column_stack([np.ones(len(features)), features])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (labels - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Whether a row is never learnt from."""
    return (F.crc32(doc_id.cast("string")) % 5) == 0


def train(docs: DataFrame, labels: DataFrame, max_train: int = 6000, limits: Limits = Limits()) -> Model:
    """Learn a model from at most about ``max_train`` labelled rows of each class.

    Labels that are null, rows without a doc_id, and held-out rows are not used; of labels
    that differ for one doc_id the toxic one holds, texts that repeat count once. With no
    toxic or no clean row to learn from, the model scores every text alike.
    """
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model()
    share = F.when(F.col("toxic") == 1, max_train / sizes[1]).otherwise(max_train / sizes[0])
    spot = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    sample = usable.where(spot < share)  # about 2 * max_train rows, whatever the input: a bounded broadcast
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy(F.xxhash64("text").alias("key"))
        .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic")
    )

    texts = written(texts, "toxicity-sample")

    def packed(*counters: Counter) -> pa.RecordBatch:
        names = list(counters[0].keys() | counters[1].keys())
        columns = [pa.array([c[x] for x in names], pa.int64()) for c in counters]
        for c in counters:
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], ["entry", "toxic", "clean", "docs"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean, docs_with = Counter(), Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, words = candidates(text or "", limits)
                docs_with.update(found.keys() if label else ())
                (toxic if label else clean).update(found)
                (toxic if label else clean)[""] += words
                if len(toxic) + len(clean) > TALLIED:  # partial tallies are summed further on
                    yield packed(toxic, clean, docs_with)
        yield packed(toxic, clean, docs_with)

    seen = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not seen.get(0) or not seen.get(1):  # labels of documents that are not there
        discard(texts)
        return Model()
    least = max(limits.least_docs, math.ceil(limits.least_share * seen.get(1, 0)))
    tallied = (
        texts.mapInArrow(sparing(tally), "entry string, toxic long, clean long, docs long")
        .groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("docs").alias("docs"))
    )
    tallied = written(tallied, "toxicity-tally")
    words = tallied.where("entry = ''").first()
    ranked = ranking(tallied, words["toxic"], words["clean"], least, limits)
    # Rows come from the ranking as they are needed, so no more than a partition of it is held here.
    model = Model(weights=choose_entries(((r["entry"], r["weight"]) for r in ranked.toLocalIterator()), limits))
    discard(tallied)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.automaton()
        for batch in batches:
            found = [model.features(t, matcher) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()), batch.column(1)],
                ["amount", "density", "toxic"],
            )

    rows = texts.mapInArrow(measure, "amount double, density double, toxic int").collect()  # the bounded sample
    discard(texts)
    fitted = fit_curve(
        np.array([[r["amount"], r["density"]] for r in rows]), np.array([float(r["toxic"]) for r in rows])
    )
    model.intercept, model.amount, model.density = map(float, fitted)
    return model


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text).

    Null and empty texts get the score of a text without hits; repeated rows are scored
    alike; a null doc_id counts as not held out. Other columns are ignored.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.automaton()
        for batch in batches:
            scores = [model.score(model.features(t, matcher)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is not rejected.

    Null and empty texts hold nothing to reject and get the score of a text without hits;
    rows that repeat are judged alike, whatever their doc_id.
    """
    kinds = docs.schema

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.automaton()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([model.score(model.features(t, matcher)) < 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(sparing(kept), kinds)
