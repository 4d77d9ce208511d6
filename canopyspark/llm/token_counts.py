"""Edit-aware token counts: a segment tree of pre-tokens for each document, of which an edit re-encodes only what it touches.

A leaf is a run of pre-tokens: its text, their lengths and token counts, and the sums of both; the inner nodes hold subtree sums. Trees can
be kept as a table of texts, lengths and counts, so that later edits of the same corpus encode nothing else either. The
pre-token pattern reads a text from left to right, looks at most one character past what ends a match, and never back. So an edit changes
no pre-token that ends two characters before it, and once a new boundary falls on an old one behind the edit, the rest stays as it was.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopyspark.llm.shared import small_batches, table

#: Pre-tokens of a leaf; one that an edit makes CROWDED times as large is split when the tree is built anew.
LEAF, CROWDED = 128, 8
#: Characters beyond the end of a match that it depends on.
AHEAD = 2
#: Pre-tokens whose token counts a Python worker remembers; longer ones than REMEMBERED_CHARS are counted each time.
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 64


class Counter:
    """Tokens of single pre-tokens under a byte-level BPE vocabulary, from a file of ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def __call__(self, piece: str) -> int:
        found = self.known.get(piece)
        if found is None:
            found = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= REMEMBERED_CHARS:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[piece] = found
        return found

    def each(self, pieces: list[str]) -> list[int]:
        try:
            return list(map(self.known.__getitem__, pieces))
        except KeyError:
            return list(map(self, pieces))


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


class TokenTree:
    """Token count of a text under edits."""

    def __init__(self, text: str, count: Counter):
        pieces = count.pattern.findall(text)
        self._start(text, list(map(len, pieces)), count.each(pieces), count)
        self.encoded = len(pieces)

    @classmethod
    def stored(cls, text: str, lengths: list[int], counts: list[int], count: Counter) -> TokenTree:
        """The tree that parts gave; nothing is encoded."""
        tree = cls.__new__(cls)
        tree._start(text, lengths, counts, count)
        tree.encoded = 0
        return tree

    def parts(self) -> tuple[str, list[int], list[int]]:
        """What a tree is kept as: its text, and the lengths and token counts of its pre-tokens."""
        return self.text, [n for x in self.lengths for n in x], [n for x in self.counts for n in x]

    def _start(self, text: str, lengths: list[int], counts: list[int], count: Counter) -> None:
        self.count, self.encoded_by_edits = count, 0
        self._build(text, lengths, counts)

    def _build(self, text: str, lengths: list[int], counts: list[int]) -> None:
        self.lengths = [lengths[k : k + LEAF] for k in range(0, len(lengths), LEAF)] or [[]]
        self.counts = [counts[k : k + LEAF] for k in range(0, len(counts), LEAF)] or [[]]
        self.size = 1 << (len(self.lengths) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        self.texts, at = [], 0
        for k, own in enumerate(self.lengths):
            self.chars[self.size + k], self.tokens[self.size + k] = sum(own), sum(self.counts[k])
            self.texts.append(text[at : at + self.chars[self.size + k]])
            at += self.chars[self.size + k]
        for k in range(self.size - 1, 0, -1):
            self.chars[k], self.tokens[k] = self.chars[2 * k] + self.chars[2 * k + 1], self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one with text for the end), and the character's place in it."""
        place = min(place, max(0, self.chars[1] - 1))
        node = 1
        while node < self.size:
            node *= 2
            if place >= self.chars[node]:
                place -= self.chars[node]
                node += 1
        return node - self.size, place

    def _set(self, leaf: int, text: str, lengths: list[int], counts: list[int]) -> None:
        self.texts[leaf], self.lengths[leaf], self.counts[leaf] = text, lengths, counts
        node = self.size + leaf
        self.chars[node], self.tokens[node] = len(text), sum(counts)
        while node := node // 2:
            self.chars[node], self.tokens[node] = self.chars[2 * node] + self.chars[2 * node + 1], self.tokens[2 * node] + self.tokens[2 * node + 1]

    def replace(self, start: int, end: int, new: str) -> None:
        """Characters start to end (exclusive; both clipped to the text) become new."""
        start = min(max(0, start), self.n_chars)
        end = min(max(start, end), self.n_chars)
        first, at = self._leaf_at(max(0, start - AHEAD))
        leaf_start = max(0, start - AHEAD) - at
        kept, offset = 0, 0
        while kept < len(self.lengths[first]) and leaf_start + offset + self.lengths[first][kept] <= start - AHEAD:
            offset += self.lengths[first][kept]
            kept += 1
        last, at = self._leaf_at(end)
        last_start = min(end, max(0, self.n_chars - 1)) - at
        head = "".join(self.texts[first:last])[offset:] if last > first else ""
        before = (head + self.texts[last][: end - last_start])[: start - leaf_start - offset] if last > first else self.texts[first][offset : start - leaf_start]
        region = before + new + self.texts[last][end - last_start :]
        shift = len(region) - (last_start + len(self.texts[last]) - leaf_start - offset)
        # old boundaries, as places in the region
        old, place, behind = set(), last_start - leaf_start - offset + shift, list(zip(self.lengths[last], self.counts[last], strict=True))
        edit_end = len(before) + len(new)
        for size in [0, *self.lengths[last]]:
            place += size
            if place >= edit_end:
                old.add(place)
        pieces: list[str] = []
        done = 0
        while True:
            whole = last + 1 >= len(self.texts)
            for m in self.count.pattern.finditer(region, done):
                if not whole and m.end() + AHEAD > len(region):
                    break
                pieces.append(m.group())
                done = m.end()
                if done in old:
                    break
            if done in old or whole:
                break
            last += 1
            place = len(region)
            behind += zip(self.lengths[last], self.counts[last], strict=True)
            region += self.texts[last]
            for size in self.lengths[last]:
                place += size
                old.add(place)
        # from the last boundary on, the pre-tokens are as they were
        cut, left = len(region), len(behind)
        while cut > done:
            left -= 1
            cut -= behind[left][0]
        rest = behind[left:]
        self.encoded_by_edits += len(pieces)
        lengths = self.lengths[first][:kept] + list(map(len, pieces)) + [n for n, _ in rest]
        counts = self.counts[first][:kept] + self.count.each(pieces) + [n for _, n in rest]
        text = self.texts[first][:offset] + region
        for leaf in range(first + 1, last + 1):
            self._set(leaf, "", [], [])
        self._set(first, text, lengths, counts)
        if len(lengths) > CROWDED * LEAF:
            self._build(*self.parts())


_TREE = "text string, lengths array<int>, counts array<int>"
_EDITS = "array<struct<start:bigint,stop:bigint,text:string>>"


def _edit(tree: TokenTree, edits: pa.Scalar) -> None:
    for e in edits.as_py() or []:
        if e is not None:
            tree.replace(e["start"] or 0, e["stop"] or 0, e["text"] or "")


def token_trees(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the tree of every row's text (text, lengths, counts), to be kept for edits to come; what edited_counts says of nulls
    and repeats holds."""
    small_batches(docs.sparkSession)

    def run(batches):
        count = counter(path, pattern)
        for batch in batches:
            rows = [TokenTree(text.as_py() or "", count).parts() for text in batch.column(1)]
            yield _tree_batch([batch.column(0)], rows, ["doc_id"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {_TREE}")


def _tree_batch(columns: list, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    parts = list(zip(*rows, strict=True)) or [()] * 3
    return pa.record_batch([*columns, *(pa.array(c, t) for c, t in zip(parts, kinds, strict=True))], [*names, "text", "lengths", "counts"])


def edited_trees(trees: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, n_reencoded and the tree of every row of trees (doc_id, text, lengths, counts, edits) after its edits. Only what
    the edits touch is encoded."""
    small_batches(trees.sparkSession)

    def run(batches):
        count = counter(path, pattern)
        for batch in batches:
            rows, figures = [], []
            for text, lengths, counts, edits in zip(*(batch.column(k) for k in range(1, 5)), strict=True):
                tree = TokenTree.stored(text.as_py() or "", lengths.as_py() or [], counts.as_py() or [], count)
                _edit(tree, edits)
                rows.append(tree.parts())
                figures.append((tree.n_tokens, tree.encoded_by_edits))
            n_tokens, n_reencoded = list(zip(*figures, strict=True)) or [()] * 2
            yield _tree_batch([batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(n_reencoded, pa.int64())], rows, ["doc_id", "n_tokens", "n_reencoded"])

    rows = trees.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lengths", "counts", F.col("edits").cast(_EDITS).alias("edits"))
    return rows.mapInArrow(run, f"doc_id long, n_tokens long, n_reencoded long, {_TREE}")


def edited_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, n_pretokens, n_tokens_edited, n_reencoded (pre-tokens encoded for the edits) and n_chars_edited of every row.

    docs has doc_id, text and edits, an array of (start, stop, text) that are applied in order, in code points of the text as the edits
    before have left it. A null text is an empty one; null edits are none, a null start or stop counts as 0, a null replacement as
    empty, and places beyond the text as its end. A null doc_id stays null; repeated rows are counted one by one; an empty table gives an
    empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        count = counter(path, pattern)
        for batch in batches:
            rows = []
            for text, edits in zip(batch.column(1), batch.column(2), strict=True):
                tree = TokenTree(text.as_py() or "", count)
                before = tree.n_tokens
                _edit(tree, edits)
                rows.append((before, tree.encoded, tree.n_tokens, tree.encoded_by_edits, tree.n_chars))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.record_batch([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_tokens", "n_pretokens", "n_tokens_edited", "n_reencoded", "n_chars_edited"])

    edits = F.col("edits").cast(_EDITS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), edits.alias("edits"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_pretokens long, n_tokens_edited long, n_reencoded long, n_chars_edited long")


def review_edits(text: Column) -> Column:
    """The edits of the query: a note in front, a replaced stretch in the middle, a deletion at a third, and a closing line."""
    size = F.coalesce(F.char_length(text), F.lit(0)).cast("long")
    edit = lambda start, stop, new: F.struct(start.alias("start"), stop.alias("stop"), F.lit(new).alias("text"))
    zero = F.lit(0).cast("long")
    half, third = F.floor(size / 2), F.floor(size / 3)
    end = size + F.lit(1000)
    return F.array(edit(zero, zero, "Note: "), edit(half, half + 7, "[redacted 42]"), edit(third, third + 11, ""), edit(end, end, "\nEnd."))


def op8_token_counts(spark, sf_dir: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """All of documents, before and after the same four review edits of each."""
    if path is None:
        import public_tokenizers

        path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents")
    return edited_counts(docs.select("doc_id", "text", review_edits(F.col("text")).alias("edits")), path, pattern)
