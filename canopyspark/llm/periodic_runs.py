"""Periodic runs: stretches of words that repeat with a period at least four times, found by probing a harmonic grid.

For each period p, the words at jp and (j+1)p are compared for all j, so all periods of n words take n ln n tests. A run of four periods
holds four grid points in a row, that is three tests in a row that succeed. Survivors are compared in chunks of growing length, all of a
period at once, and then extended to both sides. Periods come in rising order: grid points within a run that was found, which has a smaller
period, are skipped, as nothing in there has p for its smallest period.

Texts of a batch are probed together, one behind the other, with a word of its own between any two. Time grows as n ln n in the words, but
for what survivors share with runs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyspark.llm.shared import small_batches, table

#: A run has as many periods, and words, at least.
PERIODS, WORDS = 4, 6
#: Words probed together, about; a longer text is probed by itself.
TOGETHER = 1 << 17
#: Words of the first chunk of a comparison; a chunk is up to so many.
FIRST, LARGEST = 8, 1 << 16

#: Makes other words of a row's words; it gets the doc_id as well.
Edit = Callable[[int | None, list[bytes]], list[bytes]]


def _reach(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How many places from `at` on, backwards if step is -1, hold the same word as one period further."""
    total, size = 0, FIRST
    end = len(words) - period - at if step > 0 else at + 1
    while total < end:
        size = min(size, end - total)
        low = at + total if step > 0 else at - total - size + 1
        same = words[low : low + size] == words[low + period : low + period + size]
        if not same.all():
            return total + int(np.argmin(same if step > 0 else same[::-1]))
        total, size = total + size, min(2 * size, LARGEST)
    return total


def _survivors(words: np.ndarray, period: int, covered: np.ndarray) -> np.ndarray:
    """Grid points from which three tests in a row succeed, not within a run, and so do the chunks from there over two periods."""
    grid = words[::period]
    same = grid[1:] == grid[:-1]
    point = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * period
    point = point[covered[point] <= point + 3 * period] if len(point) else point
    done, size = 1, FIRST
    while len(point) and done < 2 * period:
        size = min(size, 2 * period - done)
        for part in np.array_split(np.arange(len(point)), len(point) * size // (1 << 20) + 1):
            at = point[part, None] + np.arange(done, done + size)
            point[part] = np.where((words[at] == words[at + period]).all(axis=1), point[part], -1)
        point = point[point >= 0]
        done, size = done + size, min(2 * size, LARGEST)
    return point


def runs_of(words: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Start, end and smallest period of every run of the words (numbers), by start, then period. longest: the most words that one text of
    those has; no run is longer."""
    covered = np.zeros(len(words), np.int64)
    found = []
    for period in range(1, (len(words) if longest is None else longest) // PERIODS + 1):
        last = -1
        for at in _survivors(words, period, covered).tolist():
            if at + 3 * period < last or covered[at] > at + 3 * period:
                continue
            start = at - _reach(words, at - 1, period, -1) if at else 0
            end = at + _reach(words, at, period, 1) + period
            last = end
            if end - start >= max(WORDS, PERIODS * period):
                found.append((start, end, period))
                np.maximum(covered[start:end], end, out=covered[start:end])
    return np.array(sorted(found, key=lambda run: (run[0], run[2])), np.int64).reshape(-1, 3)


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, with a number of its own behind each text, and where texts begin."""
    number = defaultdict(count().__next__)
    sizes = np.array([len(t) + 1 for t in texts])
    out = np.empty(int(sizes.sum()), np.int64)
    begins = np.cumsum(sizes) - sizes
    for k, (text, begin) in enumerate(zip(texts, begins.tolist(), strict=True)):
        out[begin : begin + len(text)] = np.fromiter(map(number.__getitem__, text), np.int64, len(text))
        out[begin + len(text)] = -1 - k
    return out, begins


def text_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text, as runs_of gives them."""
    words, begins = _numbered(texts)
    found = runs_of(words, max(map(len, texts), default=0))
    cuts = np.searchsorted(found[:, 0], begins)
    parts = np.split(found, cuts[1:]) if len(texts) else []
    return [part - np.array([begin, begin, 0]) for part, begin in zip(parts, begins, strict=True)]


def collapsed(text: list[bytes], runs: np.ndarray) -> bytes:
    """The words, without those that a run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(text)
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    return b" ".join([text[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """Start, length and period of the run with the most periods; of equal ones the first, then that of the smallest period."""
    best = None
    for start, end, period in runs.tolist():
        if best is None or (end - start) * best[2] > best[1] * period:
            best = (start, end - start, period)
    return best


def periodic_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """doc_id, runs (start, length, period of each, by start, then period), strongest (one of them, or null) and collapsed (the text without
    repetitions) for every row of docs (doc_id, text; other columns are ignored).

    Words are runs of characters other than space and \\x09-\\x0D, numbered from 0. A run is a stretch of at least PERIODS times its
    smallest period, and WORDS words, that no neighbouring word extends. Null and blank texts have no runs and collapse to an empty text;
    a null doc_id stays null; repeated rows are judged one by one; an empty table gives an empty result. edit: changes a row's words first.
    """
    small_batches(docs.sparkSession)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def judged(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = text_runs(texts)
        every = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        fields = [pa.array(x) for x in (every[:, 0], every[:, 1] - every[:, 0], every[:, 2])]
        listed = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.StructArray.from_arrays(fields, fields=list(run_type)))
        best = pa.array([dict(zip(("start", "length", "period"), b, strict=True)) if (b := strongest(f)) else None for f in found], run_type)
        text = pa.array([collapsed(t, f) for t, f in zip(texts, found, strict=True)], pa.binary()).cast(pa.string())
        return pa.record_batch([pa.array(ids, pa.int64()), listed, best, text], ["doc_id", "runs", "strongest", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or "").encode().split()
                words = edit(doc_id, words) if edit else words
                if held + len(words) > TOGETHER and texts:
                    yield judged(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
            if texts:
                yield judged(ids, texts)

    kind = "struct<start:bigint,length:bigint,period:bigint>"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, runs array<{kind}>, strongest {kind}, collapsed string")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of one document in ten, by a hash of its id, the words from one place on become repetitions of the first ones there."""
    n, h = len(words), crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op13_periodic_run_detection(spark, sf_dir: str) -> DataFrame:
    """All of documents, with repetitions planted in a tenth of them."""
    found = periodic_runs(table(spark, sf_dir, "documents"), planted)
    best = F.col("strongest")
    shown = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    exponent = F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli")
    digests = F.sha2(shown, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"), exponent, *digests)


OP13_SQL = r"""
WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
hashed AS (
    SELECT row_number() OVER () AS doc, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w,
        xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM documents, steps),
sized AS (SELECT *, len(w) AS n, h // 10 AS g FROM hashed),
placed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized),
texts AS (SELECT doc, doc_id, n, list_transform(range(n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END]) AS w FROM placed),
words AS (SELECT doc, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
same AS (SELECT x.doc, y.i - x.i AS p, x.i FROM words x JOIN words y ON x.doc = y.doc AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc, p, i, i - row_number() OVER (PARTITION BY doc, p ORDER BY i) AS island FROM same),
stretches AS (SELECT doc, p, min(i) AS start, count(*) + p AS length FROM islands GROUP BY doc, p, island HAVING count(*) + p >= greatest(6, 4 * p)),
runs AS (
    SELECT * FROM stretches s
    WHERE NOT EXISTS (SELECT 1 FROM stretches q WHERE q.doc = s.doc AND q.p < s.p AND q.start <= s.start AND q.start + q.length >= s.start + s.length)),
of_doc AS (
    SELECT doc, count(*) AS n_runs, list({'start': start, 'length': length, 'period': p} ORDER BY start, p) AS runs,
        list({'start': start, 'length': length, 'period': p} ORDER BY length::DOUBLE / p DESC, start, p)[1] AS best
    FROM runs GROUP BY doc)
SELECT t.doc_id, coalesce(r.n_runs, 0) AS n_runs, r.best.start AS start, r.best.length AS length, r.best.period AS period, 1000 * r.best.length // r.best.period AS exponent_milli,
    sha256(coalesce(array_to_string(list_transform(r.runs, lambda x: x.start || ',' || x.length || ',' || x.period || chr(10)), ''), '')) AS runs_sha256,
    sha256(coalesce(array_to_string(CASE WHEN r.runs IS NULL THEN t.w ELSE list_transform(list_filter(range(t.n), lambda i: len(list_filter(r.runs, lambda x: i >= x.start + x.period AND i < x.start + x.length)) = 0), lambda i: t.w[i + 1]) END, ' '), '')) AS collapsed_sha256
FROM texts t LEFT JOIN of_doc r ON r.doc = t.doc
"""
