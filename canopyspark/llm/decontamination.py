"""Benchmark decontamination: CGK random-walk embedding, bit-sampling LSH over item-sized windows, exact edit verification.

CGK: a walk reads a string's symbol at its pointer at each step and then moves on or stays, as a random function of step and symbol says.
Two strings at a small edit distance fall into step again and again, so that their outputs differ in few places (Hamming distance). A table
samples a few steps; two strings meet in it if the sampled outputs are equal. Symbols are pairs of neighbouring words (runs of letters and
digits, A-Z lower-cased). Every word of a document starts a window; a window has the length of the item it is held against. Items are put
in length classes, and samples lie in the first steps, where the pointer can't yet be past the end of the shortest window of the class.

Where many items share a key, as items with one prompt in front do, that key's items are walked from their ends instead, and then sampled
at more steps, until few share one. Tables are added until random edits of a class's items meet with the target's frequency; for a class that MAX_TABLES don't bring there, exact
candidates are added: of an item with k edits, one of k + 1 segments stands in the text as it is.

Walks over long strings with many edits drift apart for good, so an item of more than LONGEST words is searched for in pieces of at most
PIECE words. If the item has at most its allowed edits in a text, one of its pieces has at most its own; a piece that is found so is
verified, and then the whole item around it.

A window's output at a sampled step depends only on where its pointer is then, and the windows whose pointers are at one place at one step
have neighbouring starts. So a table is evaluated from the first sampled step: places whose symbol is one of the items' outputs there are
walked on to the later samples, and only from those that keep an item's key the walk is undone to the interval of starts. This gives what
walking every window through the table gives, without the work for the windows that end nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyspark.llm import textarrays as ta
from canopyspark.llm.shared import small_batches, table

#: Contaminated: a span of the text is at most this share of the item's words away from it, in word edits.
MAX_EDIT_PERCENT = 20
#: Share of items with so many edits that their windows are to meet in some table.
TARGET_RECALL = 0.95
#: Steps sampled by a table; items that may share a key before it is made of more steps; tables of a length class after which exact
#: candidates are added if the target isn't met.
SAMPLED, SHARED, MAX_TABLES = 2, 8, 64
#: Words of an item that is searched for whole; words of a piece of a longer one.
LONGEST, PIECE = 127, 63
#: Cells of the rows that are verified at once.
CELLS = 1 << 20
#: Words of the benchmark that one pass over the documents looks for; further items take further passes.
BLOCK_WORDS = 4_000_000
_MARKS = 1 << 16


def item_words(texts: list[str]) -> list[np.ndarray]:
    """Word hashes of each text."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    low = ta.lowered(np.frombuffer(b"".join(data), np.uint8))
    start, end, per = ta.words(low, offsets, ta.NOT_ALNUM)
    return np.split(ta.span_hashes(low, start, end), np.cumsum(per)[:-1]) if len(per) else []


def symbols(words: np.ndarray, gram: int) -> np.ndarray:
    """The words, or each with the next one (the last with nothing)."""
    return words if gram == 1 else ta.mixed(words * np.uint64(0x9E3779B97F4A7C15) + np.append(words[1:], np.uint64(0)))


def moves(symbol: np.ndarray, walk: int, step: int) -> np.ndarray:
    """Whether the walk moves on from each symbol at this step: a random bit of step and symbol."""
    bits = ta.mixed(symbol + np.uint64((0x9E3779B97F4A7C15 * (2 * walk + 1) + 0xD1B54A32D192ED03 * (step // 64)) % (1 << 64)))
    return ((bits >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)


def embedded(strings: list[np.ndarray], walk: int, steps: int) -> np.ndarray:
    """The embedding of each string of symbols, as rows; beyond a string's end, zeros."""
    padded = np.zeros((len(strings), max(map(len, strings), default=0) + 1), np.uint64)
    for row, x in zip(padded, strings, strict=True):
        row[: len(x)] = x
    size, every = np.array([len(x) for x in strings], np.int64), np.arange(len(strings))
    out, at = np.zeros((len(strings), steps), np.uint64), np.zeros(len(strings), np.int64)
    for j in range(steps):
        out[:, j] = padded[every, at]
        at = np.minimum(at + moves(out[:, j], walk, j), size)
    return out


def _mark(key: np.ndarray) -> np.ndarray:
    return (key & np.uint64(_MARKS - 1)).astype(np.int64)


@dataclass
class Table:
    """Sampled steps of one walk for one length class; marks[i]: which prefixes of i + 1 outputs items have; keys in order, with their
    items; back: whether strings are walked from their ends."""

    walk: int
    gram: int
    back: bool
    steps: list[int]
    marks: list[np.ndarray] = field(default_factory=list)
    keys: np.ndarray | None = None
    items: np.ndarray | None = None


@dataclass
class Index:
    """words, allowed: of the strings searched for, items or pieces of them; item, offset: the item of each, and where in it it starts;
    whole, whole_allowed: of the items; segments: by length in words, hashes in order with the string and the place in it of each."""

    ids: np.ndarray
    words: list[np.ndarray]
    allowed: np.ndarray
    tables: list[Table]
    item: np.ndarray
    offset: np.ndarray
    whole: list[np.ndarray]
    whole_allowed: np.ndarray
    segments: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)


def _edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    out = list(words)
    for kind, place in zip(rng.integers(0, 3, edits), rng.random(edits), strict=True):
        at = int(place * len(out))
        if kind == 0:
            out[at] = rng.integers(1, 1 << 62)
        elif kind == 1:
            out.insert(at, rng.integers(1, 1 << 62))
        elif len(out) > 1:
            out.pop(at)
    return np.array(out, np.uint64)


def build(ids: list, texts: list[str], percent: int = MAX_EDIT_PERCENT, target: float = TARGET_RECALL) -> Index:
    """Tables for items with a word. Each length class gets as many tables as random edits of its own strings (items, or pieces of long
    ones; about 200, evenly picked, with as many edits as are allowed) need in order to meet in some table with the target's frequency, or
    MAX_TABLES and exact candidates."""
    rng = np.random.default_rng(20)
    words = item_words(texts)
    keep = [k for k, w in enumerate(words) if len(w)]
    whole = [words[k] for k in keep]
    parts = [np.array_split(w, -(-len(w) // PIECE) if len(w) > LONGEST else 1) for w in whole]
    words = [x for part in parts for x in part]
    item = np.repeat(np.arange(len(parts)), [len(part) for part in parts])
    offset = np.array([at for part in parts for at in np.cumsum([0, *map(len, part[:-1])])], np.int64)
    allowed, whole_allowed = (np.array([len(w) * percent // 100 for w in own], np.int64) for own in (words, whole))
    classes: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        classes.setdefault(int(len(w)).bit_length(), []).append(k)
    tables: list[Table] = []
    exact: list[int] = []
    for members in classes.values():
        least = min(len(words[k]) for k in members)
        gram = 2 if least >= 4 else 1
        steps = least + 1 - gram
        some = np.arange(0, len(members), max(1, len(members) // 200))
        own = [[symbols(words[k][::way], gram) for k in members] for way in (1, -1)]
        changed = [_edited(words[members[k]], int(allowed[members[k]]), rng) for k in some]
        edited = [[symbols(x[::way], gram) for x in changed] for way in (1, -1)]
        missed = np.ones(len(some), bool)
        for walk in range(MAX_TABLES):
            outputs = [embedded(x, walk, steps) for x in own]
            same = [x[some] == embedded(y, walk, steps) for x, y in zip(outputs, edited, strict=True)]
            for t, cold in _tables(outputs, walk, gram, np.array(members), rng.permutation(steps)):
                tables.append(t)
                missed &= ~(cold[some] & same[t.back][:, t.steps].all(axis=1))
            if missed.mean() <= 1 - target:
                break
        else:
            exact += members
    index = Index(np.array([ids[k] for k in keep], np.int64), words, allowed, tables, item, offset, whole, whole_allowed)
    index.segments = _segments(exact, words, allowed)
    return index


def _tables(outputs: list[np.ndarray], walk: int, gram: int, members: np.ndarray, order: np.ndarray) -> Iterator[tuple[Table, np.ndarray]]:
    """Tables of one walk, and which members each has: all whose key few others share, then the others from their ends, then with twice
    the steps, and so on. outputs: of strings, and of strings from their ends."""
    left, count, back = np.ones(len(members), bool), min(SAMPLED, len(order)), False
    while left.any():
        rows = np.flatnonzero(left)
        t = Table(walk, gram, back, sorted(order[:count].tolist()))
        prefixes = [outputs[back][rows, t.steps[0]]]
        for step in t.steps[1:]:
            prefixes.append(ta.mixed(prefixes[-1] + outputs[back][rows, step]))
        _, of, sharing = np.unique(prefixes[-1], return_inverse=True, return_counts=True)
        few = (sharing[of] <= SHARED) | back & (count == len(order))
        t.marks = [np.zeros(_MARKS, bool) for _ in prefixes]
        for mark, prefix in zip(t.marks, prefixes, strict=True):
            mark[_mark(prefix[few])] = True
        place = np.argsort(prefixes[-1][few], kind="stable")
        t.keys, t.items = prefixes[-1][few][place], members[rows[few]][place]
        cold = np.zeros(len(members), bool)
        cold[rows[few]] = True
        if few.any():
            yield t, cold
        left &= ~cold
        count, back = (min(len(order), 2 * count), False) if back else (count, True)


def _windows(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of so many words."""
    total = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(total)]
    return ta.mixed(total)


def _segments(members: list[int], words: list[np.ndarray], allowed: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    found: dict[int, list[tuple]] = {}
    for k in members:
        at = 0
        for part in np.array_split(words[k], min(len(words[k]), int(allowed[k]) + 1)):
            found.setdefault(len(part), []).append((_windows(part, len(part))[0], k, at))
            at += len(part)
    out = {}
    for size, rows in found.items():
        key, string, place = (np.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (np.uint64, np.int64, np.int64), strict=True))
        order = np.argsort(key, kind="stable")
        out[size] = key[order], string[order], place[order]
    return out


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def candidates(words: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Window starts and items that meet in a table; words may hold many texts in a row, as exact verification follows."""
    found = [np.zeros(0, np.int64)]
    kinds = {}
    for gram, back in {(t.gram, t.back) for t in index.tables}:
        symbol = np.append(symbols(words[::-1] if back else words, gram), np.uint64(0))
        kinds[gram, back] = symbol, _mark(symbol[:-1]).astype(np.uint16)
    last = len(words)
    length = np.fromiter(map(len, index.words), np.int64, len(index.words))
    for t in index.tables:
        symbol, mark = kinds[t.gram, t.back]
        place = np.flatnonzero(t.marks[0][mark])
        at, key = place, symbol[place]
        for i in range(1, len(t.steps)):
            for j in range(t.steps[i - 1], t.steps[i]):
                at = np.minimum(at + moves(symbol[at], t.walk, j), last)
            key = ta.mixed(key + symbol[at])
            stay = np.flatnonzero(t.marks[i][_mark(key)])
            place, at, key = place[stay], at[stay], key[stay]
        first = np.searchsorted(t.keys, key, "left")
        size = np.searchsorted(t.keys, key, "right") - first
        item, place = t.items[_ranges(first, size)], np.repeat(place, size)
        low = high = place
        for j in range(t.steps[0] - 1, -1, -1):  # the starts whose pointer comes to this place are an interval
            before = np.maximum(low - 1, 0)
            low = np.where((low > 0) & (moves(symbol[before], t.walk, j) == 1), before, low)
            high = high - moves(symbol[high], t.walk, j)
            some = low <= high
            low, high, item = low[some], high[some], item[some]
        if t.back:  # windows end here; edits move their starts
            low, high = last - high - length[item] - index.allowed[item], last - low - length[item] + index.allowed[item]
            low, high = np.clip(low, 0, last - 1), np.clip(high, 0, last - 1)
        found.append(_ranges(low, high - low + 1) * len(index.words) + np.repeat(item, high - low + 1))
    for size, (keys, string, offset) in index.segments.items():
        key = _windows(words, size)
        first = np.searchsorted(keys, key, "left")
        count = np.searchsorted(keys, key, "right") - first
        row = _ranges(first, count)
        start, far = np.repeat(np.arange(len(key)), count) - offset[row], index.allowed[string[row]]
        low = np.clip(start - far, 0, last - 1)
        wide = np.clip(start + far, low, last - 1) - low + 1
        found.append(_ranges(low, wide) * len(index.words) + np.repeat(string[row], wide))
    pairs = np.unique(np.concatenate(found))
    return pairs // max(1, len(index.words)), pairs % max(1, len(index.words))


def _parts(cells: np.ndarray) -> Iterator[slice]:
    """Neighbours that are held at once: 4096, or as many as CELLS has room for, each as large as the largest."""
    at = 0
    while at < len(cells):
        size = 4096
        while size > 1 and size * cells[at : at + size].max() > CELLS:
            size //= 2
        yield slice(at, at + size)
        at += size


def verified(words: np.ndarray, ends: np.ndarray, start: np.ndarray, width: np.ndarray, item: np.ndarray, strings: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Least word edit distance of each item to a span of the text that starts in the width words from start on; a number over the allowed
    one stands for more. Banded: a cell off the diagonals by more than the allowed edits can't matter, and a candidate all of whose cells
    are over the allowed edits is given up. ends[i]: the end of the text that word i is in; strings, most: words and allowed edits of the
    items."""
    length = np.fromiter(map(len, strings), np.int64, len(strings))
    far = 1 << 30
    out = np.full(len(item), far, np.int64)
    padded = np.append(words, np.uint64(0))
    order = np.argsort(length[item], kind="stable")
    for own in _parts((length[item] + 2 * most[item] + width)[order]):
        part = order[own]
        size, allowed = length[item[part]], most[item[part]]
        theirs = np.zeros((len(part), size.max()), np.uint64)
        for i in np.unique(item[part]):
            theirs[item[part] == i, : length[i]] = strings[i]
        shift = np.arange(-int(allowed.max()), int(allowed.max() + width[part].max()))
        s, room, wide = start[part][:, None], (ends[start[part]] - start[part])[:, None], width[part][:, None]
        # row r, cell d: the item's first r words against the text's words up to start + r + d
        row = np.where((shift >= 0) & (shift <= room), np.maximum(shift - (wide - 1), 0), far)
        for r in range(1, int(size.max()) + 1):
            used = r + shift[None, :]
            inside = (used >= 0) & (used <= room)
            same = (padded[np.clip(s + used - 1, 0, len(words))] == theirs[:, r - 1 : r]) & (used >= 1)
            new = np.where(used >= 1, row + ~same, far)
            new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
            new = np.where(inside, new, far)
            row = np.where(inside, np.minimum(new, np.minimum.accumulate(new - shift, axis=1) + shift), far)
            done = size == r
            if done.any():
                out[part[done]] = row[done].min(axis=1)
            if done.any() or r % 4 == 0:
                stay = ~done & (row.min(axis=1) <= allowed)
                part, size, allowed, theirs, s, room, row = (x[stay] for x in (part, size, allowed, theirs, s, room, row))
                if not len(part):
                    break
    return out


def _runs(start: np.ndarray, item: np.ndarray, text: np.ndarray, longest: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring starts of one item in one text as one candidate: first start, number of starts, item."""
    order = np.lexsort((start, item))
    start, item = start[order], item[order]
    new = np.ones(len(start), bool)
    new[1:] = (item[1:] != item[:-1]) | (start[1:] != start[:-1] + 1) | (text[start[1:]] != text[start[:-1]])
    begin = np.flatnonzero(new)
    place = np.arange(len(start)) - np.repeat(begin, np.diff(np.append(begin, len(start))))
    first = np.flatnonzero(place % longest == 0)
    return start[first], np.diff(np.append(first, len(start))), item[first]


def matches(data: np.ndarray, offsets: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, item, edits and first word of each match in the texts with these bytes and offsets."""
    low = ta.lowered(data)
    start, end, per_text = ta.words(low, offsets, ta.NOT_ALNUM)
    words = ta.span_hashes(low, start, end)
    text = np.repeat(np.arange(len(per_text)), per_text)
    at, width, part = _runs(*candidates(words, index), text)
    ends, begins = np.cumsum(per_text)[text], (np.cumsum(per_text) - per_text)[text]
    edits = verified(words, ends, at, width, part, index.words, index.allowed)
    good = edits <= index.allowed[part]
    at, width, part, edits = at[good], width[good], part[good], edits[good]
    item = index.item[part]
    cut = np.fromiter(map(len, index.words), np.int64, len(index.words))[part] < np.fromiter(map(len, index.whole), np.int64, len(index.whole))[item]
    long_at, long_item, long_edits = _around(words, ends, begins, at[cut], width[cut], part[cut], index)
    at, item, edits = np.concatenate([at[~cut], long_at]), np.concatenate([item[~cut], long_item]), np.concatenate([edits[~cut], long_edits])
    return text[at], item, edits, at - begins[at]


def _around(words: np.ndarray, ends: np.ndarray, begins: np.ndarray, at: np.ndarray, width: np.ndarray, part: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, item and edits of the items that stand around these verified pieces. Pieces of one item in one text that put its start at
    nearly the same place are one candidate; all starts that its edits and theirs can move it to are tried."""
    item, begin, end = index.item[part], begins[at], ends[at]
    start = at - index.offset[part]
    order = np.lexsort((start, begin, item))
    item, begin, end, start, stop, slack = (x[order] for x in (item, begin, end, start, start + width, 2 * index.allowed[part]))
    first, k = [], 0
    while k < len(start):
        first.append(k)
        most = index.whole_allowed[item[k]]
        same = np.searchsorted(item, item[k], "right")
        same = k + np.searchsorted(begin[k:same], begin[k], "right")
        k += max(1, int(np.searchsorted(start[k:same], start[k] + most, "right")))
    first = np.array(first, np.int64)
    if not len(first):
        return first, first, first
    item, begin, end, start = item[first], begin[first], end[first], start[first]
    room = index.whole_allowed[item] + np.maximum.reduceat(slack, first)
    low = np.clip(start - room, begin, end - 1)
    high = np.clip(np.maximum.reduceat(stop, first) + room, low + 1, end)
    edits = verified(words, ends, low, high - low, item, index.whole, index.whole_allowed)
    good = edits <= index.whole_allowed[item]
    return np.clip(start, begin, end - 1)[good], item[good], edits[good]


def indexes(benchmark: DataFrame, percent: int, target: float) -> Iterator[Index]:
    """One index for each block of items; items come to the driver one block at a time, about 64 bytes a word."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    ids, texts, held = [], [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        size = len(row["text"]) // 5 + 1
        if held and held + size > BLOCK_WORDS:
            yield build(ids, texts, percent, target)
            ids, texts, held = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        held += size
    yield build(ids, texts, percent, target)


def _search(docs: DataFrame, index: Index) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in ta.pieces(batch):
                text, item, edits, word = matches(data, offsets, index)
                yield pa.record_batch([part.column(0).take(pa.array(text)), pa.array(index.ids[item]), pa.array(edits), pa.array(word)], ["doc_id", "item_id", "edits", "word"])

    return docs.mapInArrow(run, "doc_id long, item_id long, edits long, word long")


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = MAX_EDIT_PERCENT, target: float = TARGET_RECALL) -> DataFrame:
    """doc_id, item_id, edits, word: each document with each benchmark item of which a span of its text is at most percent % of the item's
    words away in edits, with the fewest edits found and the first word (from 0) of the windows near it.

    Null and blank texts and items match nothing. A null doc_id stays null; rows that share a doc_id are one document; rows that share an
    item_id are one item, rows without one are left out. Empty tables give an empty result; other columns are ignored. The benchmark is
    searched for in blocks of BLOCK_WORDS words; each is a pass over the documents.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = reduce(DataFrame.unionByName, (_search(docs, index) for index in indexes(benchmark, percent, target)))
    best = F.min(F.struct("edits", "word"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.edits", "best.word")


def decontaminated(docs: DataFrame, benchmark: DataFrame, percent: int = MAX_EDIT_PERCENT, target: float = TARGET_RECALL) -> DataFrame:
    """The rows of docs, all columns, whose text holds no benchmark item, as contaminated has it; each row is judged where it is read."""
    small_batches(docs.sparkSession)
    for index in indexes(benchmark, percent, target):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, offsets in ta.pieces(batch):
                    clean = np.ones(part.num_rows, bool)
                    clean[matches(data, offsets, index)[0]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """All of documents against all of benchmark."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
