"""Toxicity: a weighted lexicon, matched by Aho-Corasick after folding homoglyphs and digit substitutions, normalised by length.

1. Texts are folded: compatibility forms, marks, case, letters of other scripts that look like Latin ones, digits and signs next to letters.
2. Lexicon entries are words and beginnings of words that are more frequent in documents labelled toxic. Words that begin like an entry
   but are as frequent in the others are exception phrases, besides those that are given; a hit within one doesn't count.
3. Weights are fitted by a logistic regression that allows no negative ones and makes most of them zero, on counts normalised by length;
   then the score is calibrated on labelled rows that were not fitted.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyspark.llm.shared import Scratch, small_batches, table

#: Labelled rows that the lexicon is fitted on, at most, by a hash of the id.
LABELLED = 8000
#: Entries that are tried, at most, and exceptions that are learned.
TRIED, EXCEPTED = 2000, 5000
#: Lengths of word beginnings.
BEGINNINGS = range(3, 8)
#: By how many standard errors an entry's log odds must lie above zero.
CLEARLY = 3.0
#: Words of a text from which on its hits count for less.
SPAN = 256
#: Strengths of the penalty that are tried.
PENALTIES = (0.0003, 0.001, 0.003)
#: Phrases whose words are not meant as insults.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "sore loser")

#: Letters that look like Latin ones, once case and marks are gone.
_ALIKE = str.maketrans("аеорсухіјѕԁһԛԝкмтнвьαορνικτυχεηωγβıłøđ", "aeopcyxijsdhqwkmthbbaopviktuxenwybilod")
_DIGITS = str.maketrans("0134578@$!", "oieastbasi")
_BESIDE_LETTERS = re.compile(r"(?<=[^\W\d_])[0-9@$]+|[0-9@$]+(?=[^\W\d_])|(?<=[^\W\d_])!(?=[^\W\d_])")


class _Letters(dict):
    """For str.translate: look-alikes to Latin letters, marks to nothing, all that is no letter or digit to a space."""

    def __missing__(self, code: int) -> int | None:
        char = chr(code)
        self[code] = out = None if unicodedata.category(char) in ("Mn", "Cf") else code if char.isalnum() else 32
        return out


_LETTERS = _Letters(_ALIKE)


def folded(text: str | None) -> str:
    """The words of a text as they are compared, with one space before, between and behind them."""
    text = text or ""
    text = (text if text.isascii() else unicodedata.normalize("NFKD", text)).lower()
    text = _BESIDE_LETTERS.sub(lambda m: m.group().translate(_DIGITS), text)
    return f" {' '.join(text.translate(_LETTERS).split())} "


def entries_of(word: str) -> list[str]:
    """The entries that a word has: itself, and its beginnings."""
    return [f" {word} ", *(f" {word[:k]}" for k in BEGINNINGS if k < len(word))]


@dataclass(frozen=True)
class Lexicon:
    """Entries with a space before them, and behind them if they are whole words; a weight for each; exception phrases; and what makes a
    score of them: 1 / (1 + exp(-(offset + scale * sum of weights * ln(1 + hits) / sqrt(1 + words / SPAN))))."""

    entries: tuple[str, ...]
    weights: np.ndarray
    exceptions: tuple[str, ...]
    offset: float
    scale: float = 1.0

    def scores(self, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
        """hits: a row for each text, a column for each entry."""
        return _sigmoid(self.offset + self.scale * (normalised(hits, words) @ self.weights))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def normalised(hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.log1p(hits) / np.sqrt(1 + np.asarray(words) / SPAN)[:, None]


class Matcher:
    """Counts the entries of a folded text in one pass of an Aho-Corasick automaton, but for those within an exception phrase."""

    def __init__(self, entries: tuple[str, ...], exceptions: tuple[str, ...]):
        self.automaton = ahocorasick.Automaton()
        for phrase in exceptions:
            if (own := folded(phrase)).strip():
                self.automaton.add_word(own, (-1, len(own)))
        for k, entry in enumerate(entries):
            if entry not in self.automaton:
                self.automaton.add_word(entry, (k, len(entry)))
        self.filled = len(self.automaton) > 0
        if self.filled:
            self.automaton.make_automaton()

    def hits(self, text: str) -> Counter:
        found, excepted = [], []
        for end, (k, size) in self.automaton.iter(text) if self.filled else ():
            (excepted if k < 0 else found).append((end - size + 1, end, k))
        if excepted:
            # an entry without its last space is within a phrase that ends with it
            found = [(a, z, k) for a, z, k in found if not any(b <= a and z <= y for b, y, _ in excepted)]
        return Counter(k for _, _, k in found)


def _hit_rows(docs: DataFrame, entries: tuple[str, ...], exceptions: tuple[str, ...]) -> DataFrame:
    """doc_id, n_words, entry and hits (arrays) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(entries, exceptions)
        for batch in batches:
            words, found = [], []
            for value in batch.column(1):
                text = folded(value.as_py())
                words.append(text.count(" ") - 1 if len(text) > 2 else 0)
                found.append(matcher.hits(text))
            lists = [pa.array([list(part(f)) for f in found], pa.list_(kind)) for part, kind in ((Counter.keys, pa.int32()), (Counter.values, pa.int64()))]
            yield pa.record_batch([batch.column(0), pa.array(words, pa.int64()), *lists], ["doc_id", "n_words", "entry", "hits"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, entry array<int>, hits array<long>")


def _dense(rows: list, entries: int) -> tuple[np.ndarray, np.ndarray]:
    hits = np.zeros((len(rows), entries), np.float32)
    for k, row in enumerate(rows):
        hits[k, row["entry"]] = row["hits"]
    return hits, np.array([row["n_words"] for row in rows], np.int64)


def entry_counts(docs: DataFrame, held: int = 400_000) -> DataFrame:
    """entry, toxic and clean: how many documents (text, toxic) of either label have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()

        def flushed() -> pa.RecordBatch:
            every = list(counts[0].keys() | counts[1].keys())
            out = pa.record_batch([pa.array(every, pa.string()), *(pa.array([counts[label][e] for e in every], pa.int64()) for label in (1, 0))], ["entry", "toxic", "clean"])
            for c in counts:
                c.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[toxic].update({e for word in set(folded(text.as_py()).split()) for e in entries_of(word)})
            if len(counts[0]) + len(counts[1]) > held:
                yield flushed()
        yield flushed()

    parts = docs.select("text", "toxic").mapInArrow(run, "entry string, toxic long, clean long")
    return parts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _longest(rows: list) -> tuple[str, ...]:
    """The entries of rows, without those that begin another one that as many documents of either label have."""
    count = {row["entry"]: (row["toxic"], row["clean"]) for row in rows}
    idle = {word[:k] for word, own in count.items() for k in range(2, len(word)) if count.get(word[:k]) == own}
    return tuple(entry for entry in count if entry not in idle)


def _penalised(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights, none negative, and the offset of a logistic regression with the penalty on their sum, by accelerated gradient steps."""
    x = np.ascontiguousarray(x, np.float32)
    rate = 4 / (1 + float((x**2).sum(axis=1).mean()))
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    weights, offset, ahead, before, speed = np.zeros(x.shape[1]), np.log(share / (1 - share)), np.zeros(x.shape[1]), np.log(share / (1 - share)), 1.0
    for _ in range(steps):
        error = _sigmoid(before + x @ ahead.astype(np.float32)) - y
        new, moved = np.maximum(ahead - rate * (error.astype(np.float32) @ x / len(y) + penalty), 0), before - rate * error.mean()
        faster = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        ahead, before = new + (speed - 1) / faster * (new - weights), moved + (speed - 1) / faster * (moved - offset)
        weights, offset, speed = new, moved, faster
    return weights, float(offset)


def _loss(p: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def fitted(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights, offset and scale: the penalty is the one with the least loss on every fourth row, and offset and scale are calibrated there;
    the weights are then fitted to all rows."""
    held = np.arange(len(y)) % 4 == 3
    if min(y[held].sum(), (~held & (y > 0)).sum(), (1 - y[held]).sum()) < 3:
        weights, offset = _penalised(x, y, PENALTIES[-1])
        return weights, offset, 1.0
    tried = [_penalised(x[~held], y[~held], penalty) for penalty in PENALTIES]
    best = min(range(len(tried)), key=lambda k: _loss(_sigmoid(tried[k][1] + x[held] @ tried[k][0]), y[held]))
    weights, offset = tried[best]
    line, own = (x[held] @ weights)[:, None], y[held]
    scale, start = 1.0, offset
    for _ in range(50):
        p = _sigmoid(start + scale * line[:, 0])
        curve = np.maximum(p * (1 - p), 1e-9)
        design = np.concatenate([line, np.ones_like(line)], axis=1)
        # a prior as of one row holds the calibration where the held rows are told apart without error
        hessian = (design * curve[:, None]).T @ design + np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (own - p) - np.array([scale - 1, start - offset]))
        scale, start = scale + step[0], start + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return _penalised(x, y, PENALTIES[best])[0], float(start), float(max(scale, 0.1))


def lexicon_of(docs: DataFrame, labels: DataFrame, sample_rows: int = LABELLED, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """The lexicon fitted on at most sample_rows labelled documents (labels: doc_id, toxic), by a hash of the id.

    Labels with a null doc_id or label are left out; of a repeated one, and of repeated documents or texts, any is taken. Without labels of both
    kinds the lexicon is empty, and every score is the share of toxic labels (without any label: 0). To the driver come the sample's
    counts of at most TRIED entries, and at most EXCEPTED exceptions."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "toxicity")
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic").cast("double") >= 0.5).cast("int").alias("toxic")).dropna().dropDuplicates(["doc_id"])
    chosen = F.broadcast(named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    sample = scratch.written(sample.dropDuplicates(["doc_id"]).dropDuplicates(["text"]), "sample")
    size = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        scratch.drop()
        return Lexicon((), np.zeros(0), tuple(exceptions), 40.0 if toxic else -40.0)
    counts = scratch.written(entry_counts(sample), "entries")
    odds = F.expr(f"ln((toxic + 0.5D) / ({toxic} - toxic + 0.5D)) - ln((clean + 0.5D) / ({clean} - clean + 0.5D))")
    error = F.expr(f"sqrt(1 / (toxic + 0.5D) + 1 / ({toxic} - toxic + 0.5D) + 1 / (clean + 0.5D) + 1 / ({clean} - clean + 0.5D))")
    tried = counts.where("toxic > 1").withColumn("clear", odds / error).where(F.col("clear") >= CLEARLY).orderBy(F.desc("clear"), "entry").limit(TRIED)
    entries = _longest(tried.collect())
    begin = F.broadcast(docs.sparkSession.createDataFrame([(e,) for e in entries if not e.endswith(" ")], "begin string"))
    whole = counts.where(F.col("entry").endswith(" ") & (F.col("clean") > 1) & (odds <= 0))
    within = whole.select("entry", "clean", F.explode(F.array(*(F.substring("entry", 1, k + 1) for k in BEGINNINGS))).alias("begin"))
    within = within.where("length(begin) + 1 < length(entry)").join(begin, "begin", "left_semi").groupBy("entry").agg(F.max("clean").alias("clean"))
    learned = [row["entry"].strip() for row in within.orderBy(F.desc("clean"), "entry").limit(EXCEPTED).collect()]
    exceptions = (*exceptions, *learned)
    rows = _hit_rows(sample, entries, exceptions).join(sample.select("doc_id", "toxic"), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    scratch.drop()
    hits, words = _dense(rows, len(entries))
    weights, offset, scale = fitted(normalised(hits, words), np.array([row["toxic"] for row in rows], float))
    used = np.flatnonzero(weights > 1e-6)
    held = tuple(entries[k] for k in used)
    needed = tuple(e for e in exceptions if " " in e or any(f" {e}".startswith(h) for h in held))
    return Lexicon(held, weights[used], needed, offset, scale)


def toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, n_words, hits (entry and count of each, as they were found) and score (0 to 1) for every row of docs (doc_id, text; other
    columns are ignored).

    Null and empty texts have no hits and the score of a text without any; a null doc_id stays null; repeated rows are scored one by one;
    an empty table gives an empty result."""
    small_batches(docs.sparkSession)
    hit = pa.struct([("entry", pa.string()), ("count", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon.entries, lexicon.exceptions)
        for batch in batches:
            words, listed, total = [], [], []
            for value in batch.column(1):
                text = folded(value.as_py())
                found = matcher.hits(text)
                words.append(text.count(" ") - 1 if len(text) > 2 else 0)
                listed.append([{"entry": lexicon.entries[k].strip() + ("" if lexicon.entries[k].endswith(" ") else "*"), "count": n} for k, n in found.items()])
                total.append(sum(lexicon.weights[k] * np.log1p(n) for k, n in found.items()))
            length = np.sqrt(1 + np.array(words) / SPAN)
            score = _sigmoid(lexicon.offset + lexicon.scale * np.array(total, float) / length)
            yield pa.record_batch([batch.column(0), pa.array(words, pa.int64()), pa.array(listed, pa.list_(hit)), pa.array(score, pa.float64())], ["doc_id", "n_words", "hits", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, hits array<struct<entry:string,count:bigint>>, score double")


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    """All of documents; the labels of a fifth of the ids are not learned from."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lexicon = lexicon_of(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity(docs, lexicon).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")
