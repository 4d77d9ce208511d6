"""BPE encoding and decoding by speculation: greedy longest matches, checked pair by pair, merged exactly only where a check fails.

A row of tokens is what merging gives if and only if each token is what merging makes of its own string and each adjacent pair stays
apart when merged alone. The second test undoes merges at the border of two tokens, latest first, and asks each time whether the two
pieces that meet would have been merged earlier; it runs on all new words' pairs at once, as numpy arrays.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyspark.llm.shared import small_batches, table

#: Texts between white space, and words, whose tokens a Python worker remembers; about 200 bytes each.
CACHE_CHUNKS, CACHE_WORDS = 350_000, 100_000
#: Longer ones go at the next clearing.
CACHE_LETTERS = 64
#: Characters that str.split() takes for white space and the vocabulary does not.
OTHER_SPACE = re.compile("[\x1c-\x1f]")
SPACES = regex.compile(r"\p{White_Space}+")
NONE = np.iinfo(np.int64).max
#: Symbols of a word that is merged by going over all its pairs.
SHORT_WORD = 48


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Recent:
    """A dict that holds at least what the last batch asked for, and about as many entries more as its limit."""

    def __init__(self, limit: int):
        self.limit = limit
        self.held: dict = {}
        self.used: set = set()

    def missing(self, keys: set) -> set:
        """Keys not held yet. When there are too many, those stay that this batch or, again, an earlier one since the last clearing asked for."""
        if len(self.held) > self.limit:
            stay = (self.used if len(self.used) < self.limit // 2 else set()) | keys
            self.held = {k: v for k, v in self.held.items() if k in stay}
            self.used = set()
        old = keys & self.held.keys()
        self.used |= {k for k in old if len(k) <= CACHE_LETTERS}
        return keys - old

    def add(self, new: dict) -> None:
        self.held.update(new)


class WordBpe:
    """A lower-casing BPE vocabulary with word ends, from its JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"] and not t["normalized"]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.tokens = [""] * size
        for token, i in chain(self.ids.items(), self.special.items()):
            self.tokens[i] = token
        self.letters = byte_letters()
        #: Rank of each pair that merges, and what a merge of this rank gives.
        self.merges: dict[tuple[int, int], int] = {}
        self.given: list[int] = []
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            one, two, both = self.ids[a], self.ids[b], self.ids[a + b]
            self.merges[one, two] = rank
            self.given.append(both)
            if self.rank[both] < 0:
                self.rank[both], self.left[both], self.right[both] = rank, one, two
        pairs = sorted((a * size + b, rank) for (a, b), rank in self.merges.items())
        self.pair_keys, self.pair_ranks = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.longest = max(map(len, self.ids))
        #: Length of the longest token without a word's end that starts with these two letters.
        self.reach: dict[str, int] = {}
        for token in self.ids:
            if not token.endswith(self.end):
                self.reach[token[:2]] = max(len(token), self.reach.get(token[:2], 1))
        self.whole: dict[int, bool] = {}
        self.known, self.chunks = Recent(CACHE_WORDS), Recent(CACHE_CHUNKS)

    def normalized(self, text: str) -> str:
        """NFC, then each character's lower case (a capital sigma at a word's end is like any other)."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def symbols(self, word: str) -> list[str]:
        out = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        out[-1] += self.end
        return out

    def merged(self, symbols: list[str]) -> list[int]:
        """Exact merging: always the lowest rank, the leftmost first."""
        ids = [self.ids[s] for s in symbols]
        return self._merged_short(ids) if len(ids) <= SHORT_WORD else self._merged_long(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        rank_of = self.merges.get
        ranks = [rank_of(pair, NONE) for pair in pairwise(ids)]
        while ranks and (low := min(ranks)) != NONE:
            at = ranks.index(low)
            ids[at : at + 2] = [self.given[low]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), NONE)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), NONE)
        return ids

    def _merged_long(self, start: list[int]) -> list[int]:
        """A heap over a linked list, for words on which going over all pairs for each merge would take too long."""
        ids: list[int | None] = [*start]
        before, after = [*range(-1, len(ids) - 1)], [*range(1, len(ids) + 1)]
        heap = [(rank, k, *pair) for k, pair in enumerate(pairwise(start)) if (rank := self.merges.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k, one, two = heapq.heappop(heap)
            n = after[k]
            if ids[k] != one or n >= len(ids) or ids[n] != two:
                continue
            ids[k], ids[n], after[k] = self.given[rank], None, after[n]
            if after[n] < len(ids):
                before[after[n]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < len(ids) and (rank := self.merges.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (rank, a, ids[a], ids[b]))
        return [i for i in ids if i is not None]

    def proposed(self, symbols: list[str]) -> list[int]:
        """Greedy longest matches; only the last token has the word's end."""
        text = "".join(symbols)[: -len(self.end)]
        out, at, size = [], 0, len(text)
        ids = self.ids
        while at < size:
            if size - at <= self.longest and (last := ids.get(text[at:] + self.end)) is not None:
                out.append(last)
                break
            for to in range(min(size - 1, at + self.reach.get(text[at : at + 2], 1)), at, -1):
                if (i := ids.get(text[at:to])) is not None:
                    out.append(i)
                    at = to
                    break
            else:
                raise KeyError(text[at])
        return out

    def is_whole(self, token: int) -> bool:
        """Whether merging a token's own letters gives the token."""
        if token not in self.whole:
            text = self.tokens[token]
            ended = text.endswith(self.end)
            letters = list(text.removesuffix(self.end))
            if ended:
                letters[-1] += self.end
            self.whole[token] = self.merged(letters) == [token]
        return self.whole[token]

    def apart(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether merging both strings together leaves them apart."""
        one, two = one.copy(), two.copy()
        good = np.ones(len(one), bool)
        limit = np.full(len(one), NONE)
        live = np.arange(len(one))
        while len(live):
            a, b = one[live], two[live]
            key = a * len(self.tokens) + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)
            fused = rank < limit[live]
            good[live[fused]] = False
            ra, rb = self.rank[a], self.rank[b]
            # the later of the two merges is undone; merging goes left to right, so of one rank the left piece is the earlier
            undo_left = ra > rb
            limit[live] = np.where(undo_left, ra, rb + 1)
            one[live] = np.where(undo_left, self.right[a], a)
            two[live] = np.where(undo_left, b, self.left[b])
            live = live[~fused & ((ra >= 0) | (rb >= 0))]
        return good

    def learn(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Tokens of new words."""
        symbols = [self.symbols(w) for w in words]
        guesses = [self.proposed(s) for s in symbols]
        sizes = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter(chain.from_iterable(guesses), np.int64)
        of = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(of[:-1] == of[1:])
        bad = np.zeros(len(words), bool)
        bad[of[inner[~self.apart(flat[inner], flat[inner + 1])]]] = True
        distinct, place = np.unique(flat, return_inverse=True)
        partial = ~np.fromiter(map(self.is_whole, distinct.tolist()), bool, len(distinct))
        bad[of[partial[place]]] = True
        return {w: tuple(self.merged(s) if b else g) for w, s, g, b in zip(words, symbols, guesses, bad, strict=True)}

    def chunk(self, text: str) -> list[str | int]:
        """Words, and ids of special tokens, of a text without white space."""
        out: list[str | int] = []
        for piece in self.specials.split(text) if self.specials else [text]:
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                out += self.words.findall(self.normalized(piece))
        return out

    def encoded(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null text has none. No token, word or special token has white space in it, so a text is its chunks."""
        chunks = [(SPACES.split(t) if OTHER_SPACE.search(t) else t.split()) if t else [] for t in texts]
        every = set(chain.from_iterable(chunks))
        if new := self.chunks.missing(every):
            parts = {c: self.chunk(c) for c in new}
            words = {w for p in parts.values() for w in p if isinstance(w, str)}
            if fresh := self.known.missing(words):
                self.known.add(self.learn(list(fresh)))
            of = self.known.held
            self.chunks.add({c: array("i", chain.from_iterable(of[w] if isinstance(w, str) else (w,) for w in p)).tobytes() for c, p in parts.items()})
        tokens = self.chunks.held
        return [np.frombuffer(b"".join(map(tokens.__getitem__, c)), np.int32) for c in chunks]


@lru_cache(maxsize=2)
def loaded(path: str) -> WordBpe:
    return WordBpe(path)


@lru_cache(maxsize=2)
def token_strings(path: str) -> pa.Array:
    return pa.array(loaded(path).tokens, pa.large_string())


def _encoded(bpe: WordBpe, texts: pa.Array) -> pa.Array:
    ids = bpe.encoded(texts.to_pylist())
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def _decoded(strings: pa.Array, ids: pa.Array) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), strings.take(ids.flatten()))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())


def _rows(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array<int>) of every row of docs, as the vocabulary file at path encodes its text.

    Strings of special tokens in a text become those tokens. A null or empty text has no ids; a null doc_id stays null; repeated rows
    are encoded one by one; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            yield pa.record_batch([batch.column(0), _encoded(bpe, batch.column(1))], ["doc_id", "ids"])

    return _rows(docs).mapInArrow(run, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded: the ids' tokens, special ones too, with a space between; null ids decode to an empty text."""
    small_batches(encoded.sparkSession)

    def run(batches):
        strings = token_strings(path)
        for batch in batches:
            yield pa.record_batch([batch.column(0), batch.column(1), _decoded(strings, batch.column(1))], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """What bpe_decode gives of what bpe_encode gives, in one pass and one Python worker for each task."""

    def run(batches):
        bpe, strings = loaded(path), token_strings(path)
        for batch in batches:
            ids = _encoded(bpe, batch.column(1))
            yield pa.record_batch([batch.column(0), ids, _decoded(strings, ids)], ["doc_id", "ids", "decoded"])

    return _rows(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_columns(docs: DataFrame, path: str) -> DataFrame:
    """Encoded, decoded again, and both as digests."""
    return digests(bpe_round_trip(docs, path))


def default_path() -> str:
    """The public word-end vocabulary of 49k tokens."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_bpe(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """All of documents, encoded and decoded with the vocabulary at path, or else the public one."""
    return op9_columns(table(spark, sf_dir, "documents"), path or default_path())
