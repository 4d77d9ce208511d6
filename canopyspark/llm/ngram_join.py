"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

1. Each text becomes a sorted array of 64-bit shingle hashes; copies of one set are one class, named by its 64-bit fingerprint and kept
   apart by a second one and the size.
2. Size bands: any two sets that can be linked share a band. A band cuts the hash space into segments, more of them than the elements by
   which two linked sets of these sizes can differ, so at least one segment holds the same elements in both. Segments are join keys; of a
   set, only as many as it needs for its own size. A key's sets form a star with the smallest, and stars with one centre are one group.
3. Groups are compared in tiles of bounded size by parity bitmaps: a bit that differs needs an element that only one set has, so bit
   counts bound the overlap from above. Pairs that pass connect sets to families.
4. Families are compared in the same way with the whole arrays: bitmaps first, then exact intersection.
5. Connected components over the links.

A text is read twice at most: once for its bitmap and keys, which are written, and once more, compressed for the shuffle and found by its
doc_id and a hash of it, for its array if it is in a family. Nothing is
approximate but for 64-bit hash collisions, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyspark.llm import textarrays as ta
from canopyspark.llm.components import connected_components
from canopyspark.llm.shared import Scratch, small_batches, table
from canopyspark.llm.tiles import connecting_edges, joined, runs, tiled

#: Sets, and elements, in one block of a tile.
ROWS, UNITS = 512, 2_000_000
#: Cells of one step of the bitmap comparison.
CELLS = 1 << 21
#: By how much the sizes that a band begins with grow from one band to the next.
GROWTH = 1.6


@dataclass(frozen=True)
class Bands:
    """Of each band: the sizes that are its own (low to next, exclusive), the largest size that one of them can be linked with, the most
    elements by which one of its own sets differs from a larger linked one, its segments, and how many of a set's may be empty without
    further keys."""

    low: np.ndarray
    high: np.ndarray
    differ: np.ndarray
    segments: np.ndarray
    spare: np.ndarray


@dataclass(frozen=True)
class Threshold:
    """Linked: den * intersection >= num * union, over shingles of n words."""

    n: int = 5
    num: int = 80
    den: int = 100

    def differ(self, size: np.ndarray) -> np.ndarray:
        """The most elements by which a set of this size and a linked one that is at least as large differ: both together have less than
        size * (1 + den / num) elements, and (den - num) / (den + num) of them at most are not shared."""
        return size * (self.den - self.num) // self.num

    def bands(self, largest: int) -> Bands:
        low = [1]
        while low[-1] <= largest:
            low.append(max(low[-1] + 1, int(low[-1] * GROWTH)))
        low, top = np.array(low[:-1]), np.array(low[1:]) - 1
        differ, least = self.differ(top), self.differ(low)
        spare = np.zeros(len(low), np.int64)
        for _ in range(6):
            empty = (least + 1 + spare) * np.exp(-low / (differ + 1 + spare))
            spare = np.where(differ > 0, np.maximum(1, np.ceil(empty + 2 * np.sqrt(empty))), 0).astype(np.int64)
        return Bands(low, top * self.den // self.num, differ, differ + 1 + spare, spare)

    def passes(self, a: np.ndarray, b: np.ndarray, shared: np.ndarray) -> np.ndarray:
        return self.den * shared >= self.num * (a + b - shared)


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices with their sorted distinct shingle hashes, the text of each, and the count per text."""
    for part, data, offsets in ta.pieces(batch):
        low = ta.lowered(data)
        start, end, per_text = ta.words(low, offsets)
        value, text = ta.distinct(*ta.shingles(ta.span_hashes(low, start, end), per_text, n))
        yield part, value, text, np.bincount(text, minlength=part.num_rows)


def _sums(value: np.ndarray, begins: np.ndarray) -> np.ndarray:
    running = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(value, out=running[1:])
    return running[begins[1:]] - running[begins[:-1]]


def _prints(value: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins = np.concatenate([[0], np.cumsum(count)])
    size = count.astype(np.uint64)
    one = ta.mixed(_sums(ta.mixed(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begins) + size)
    two = ta.mixed(_sums(ta.mixed(value + np.uint64(0x51ED270B7F4A7C15)), begins) ^ size)
    return one.view(np.int64), two.view(np.int64)


def bitmap(value: np.ndarray, words: int) -> np.ndarray:
    """Parity bitmap of `words` 64-bit words (a power of two); the low words of a wider one, folded, are a narrower one."""
    hashed = ta.mixed(value ^ np.uint64(0x3C6EF372FE94F82B))
    bits = np.bincount((hashed & np.uint64(words * 64 - 1)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64)


def _words_for(n: int) -> int:
    return 1 << max(0, int(n - 1).bit_length() - 6)


def _keys(value: np.ndarray, text: np.ndarray, count: np.ndarray, t: Threshold, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Segment keys and the text of each, by text.

    A set of the size s emits its first differ(s) + 1 + spare segments, so a linked pair has at least 1 + spare like ones among those that
    both emit. Empty segments have no key unless a set has more than spare of them: if at most one of the two has, a like one that isn't
    empty is left. A set that can differ from a larger one by nothing is linked with its copies alone.
    """
    running = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(ta.mixed(value ^ np.uint64(0x7FB5D329728EA185)), out=running[1:])
    home = np.searchsorted(bands.low, count, "right") - 1
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for back in range(len(bands.low)):
        band = np.maximum(home - back, 0)
        fits = (count > 0) & (home >= back) & (count <= bands.high[band])
        if not fits.any():
            break
        differ = np.minimum(t.differ(count), bands.differ[band])
        used = fits & (differ > 0)
        emitted = np.where(used, differ + 1 + bands.spare[band], 0)
        # hashes are sorted within a text, so segments of the hash space are runs
        segment = ((value >> np.uint64(32)) * bands.segments[band][text].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        new = np.ones(len(value), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(value))
        keep = segment[begin] < emitted[text[begin]]
        begin, end = begin[keep], end[keep]
        owner = text[begin]
        tag = ta.mixed((band[owner].astype(np.uint64) << np.uint64(32)) + segment[begin].astype(np.uint64))
        keys.append(ta.mixed(running[end] - running[begin] + tag))
        owners.append(owner)
        full = np.bincount(owner, minlength=len(count))
        for i in np.flatnonzero(emitted - full > bands.spare[band]):
            empty = np.setdiff1d(np.arange(emitted[i]), segment[begin[owner == i]])
            keys.append(ta.mixed(ta.mixed((np.uint64(band[i]) << np.uint64(32)) + empty.astype(np.uint64)) + np.uint64(1)))
            owners.append(np.full(len(empty), i))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return key[order], owner[order]


def profile(docs: DataFrame, t: Threshold) -> DataFrame:
    """doc_id, text_key, n, f1, f2 (fingerprint of the set), bitmap and segment keys of every row; of a set that a task meets again, the
    last two are null."""

    def run(batches):
        bands, seen = t.bands(1 << 16), set()
        for batch in batches:
            for part, value, text, count in _sets(batch, t.n):
                if count.max(initial=0) >= bands.low[-1]:
                    bands = t.bands(int(count.max()))
                f1, f2 = _prints(value, count)
                fresh = np.zeros(len(count), bool)
                for row, name in enumerate(zip(f1.tolist(), f2.tolist(), count.tolist(), strict=True)):
                    fresh[row] = name not in seen
                    seen.add(name)
                inside = fresh[text]
                value, text, kept = value[inside], text[inside], np.where(fresh, count, 0)
                maps = [bitmap(v, _words_for(len(v))).tobytes() if new else None for v, new in zip(np.split(value, np.cumsum(kept)[:-1]), fresh & (count > 0), strict=True)]
                key, owner = _keys(value, text, kept, t, bands)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(count)))]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(key.view(np.int64)))
                columns = [part.column(0), part.column(2), pa.array(count, pa.int64()), pa.array(f1), pa.array(f2), pa.array(maps, pa.binary()), keys]
                yield pa.record_batch(columns, ["doc_id", "text_key", "n", "f1", "f2", "bits", "keys"])

    return docs.select("doc_id", "text", "text_key").mapInArrow(run, "doc_id long, text_key long, n long, f1 long, f2 long, bits binary, keys array<long>")


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the text compressed, as it is shuffled; of rows that a task meets again, the first."""

    def run(batches):
        packer, seen = zstandard.ZstdCompressor(3), set()
        for batch in batches:
            rows = []
            for row, name in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if name not in seen:
                    seen.add(name)
                    rows.append(row)
            texts = batch.column(1).take(pa.array(rows, pa.int64()))
            packed = pa.array([packer.compress((x.as_py() or "").encode()) for x in texts], pa.binary())
            yield pa.record_batch([batch.column(0).take(pa.array(rows, pa.int64())), packed, batch.column(2).take(pa.array(rows, pa.int64()))], ["doc_id", "packed", "text_key"])

    return docs.select("doc_id", "text", "text_key").mapInArrow(run, "doc_id long, packed binary, text_key long")


def stars(keyed: DataFrame, scratch: Scratch) -> DataFrame:
    """tile, f1: each set with the smallest set of each key that it shares; the smallest ones themselves are left out.

    Rows are dealt by ranges of (key, f1), so a key that very many sets share is spread over as many partitions as it fills. A partition
    takes its first set of a key for the smallest; that is wrong only for its first key, if the key began in an earlier partition, and is
    set right from a table with two rows for each partition.
    """

    def run(batches):
        last_key = last_tile = first_key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, f1 = (np.asarray(batch.column(k)) for k in (0, 1))
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            new[0] = key[0] != last_key
            tile = np.concatenate([[0 if last_tile is None else last_tile], f1[new]])[np.cumsum(new)]
            start = first_key is None
            first_key = key[0] if start else first_key
            keep = (f1 != tile) | (key == first_key)
            if start:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in ([key[0]], [tile[0]], [tile[0]])] + [pa.array([2], pa.int8())], ["key", "tile", "f1", "kind"])
            yield pa.record_batch([pa.array(key[keep]), pa.array(tile[keep]), pa.array(f1[keep]), pa.array((key[keep] == first_key).astype(np.int8))], ["key", "tile", "f1", "kind"])
            last_key, last_tile = key[-1], tile[-1]
        if last_key is not None:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in ([last_key], [last_tile], [last_tile])] + [pa.array([2], pa.int8())], ["key", "tile", "f1", "kind"])

    dealt = keyed.repartitionByRange("key", "f1").sortWithinPartitions("key", "f1")
    found = scratch.written(dealt.mapInArrow(run, "key long, tile long, f1 long, kind byte"), "runs")
    begins = found.where("kind = 2").groupBy("key").agg(F.min("tile").alias("begin"))
    right = found.where("kind = 1").join(F.broadcast(begins), "key").select(F.col("begin").alias("tile"), "f1")
    return found.where("kind = 0").select("tile", "f1").union(right).where("f1 <> tile").distinct()


class Bitmaps:
    """Bitmaps of a tile's rows, folded to every width that one of them has, so that two rows are compared at the narrower one's."""

    def __init__(self, n: np.ndarray, maps: list[np.ndarray], t: Threshold):
        self.n, self.t = n, t
        self.width = np.array([len(m) for m in maps])
        self.at: dict[int, np.ndarray] = {}
        for width in np.unique(self.width):
            self.at[int(width)] = held = np.zeros((len(maps), width), np.uint64)
            for row in np.flatnonzero(self.width >= width):
                held[row] = np.bitwise_xor.reduce(maps[row].reshape(-1, width), axis=0)

    def near(self, row: int, others: np.ndarray) -> np.ndarray:
        """Whether bit counts leave it open that the row is linked with others."""
        out = np.zeros(len(others), bool)
        narrower = np.minimum(self.width[others], self.width[row])
        for width, maps in self.at.items():
            own = np.flatnonzero(narrower == width)
            for part in np.array_split(own, len(own) * width // CELLS + 1):
                apart = np.bitwise_count(maps[others[part]] ^ maps[row]).sum(axis=1, dtype=np.int64)
                a, b = self.n[row], self.n[others[part]]
                out[part] = self.t.passes(a, b, np.minimum((a + b - apart) // 2, np.minimum(a, b)))
        return out


def by_bitmaps(t: Threshold) -> Callable[[pa.Table], Callable[[int, np.ndarray], np.ndarray]]:
    return lambda tile: Bitmaps(np.asarray(tile.column("n")), [np.frombuffer(b, np.uint64) for b in tile.column("bits").to_pylist()], t).near


def by_arrays(t: Threshold) -> Callable[[pa.Table], Callable[[int, np.ndarray], np.ndarray]]:
    """Exact links of those that the bitmaps leave open."""

    def of(tile: pa.Table) -> Callable[[int, np.ndarray], np.ndarray]:
        n, sets = np.asarray(tile.column("n")), [np.frombuffer(b, np.uint64) for b in tile.column("hashes").to_pylist()]
        bound = Bitmaps(n, [bitmap(v, _words_for(len(v))) for v in sets], t)

        def near(row: int, others: np.ndarray) -> np.ndarray:
            out = bound.near(row, others)
            open_rows = np.flatnonzero(out)
            at = 0
            while at < len(open_rows):
                sizes = n[others[open_rows[at:]]]
                to = at + max(1, int(np.searchsorted(np.cumsum(sizes), CELLS, "right")))
                part, sizes = open_rows[at:to], sizes[: to - at]
                theirs, own = np.concatenate([sets[r] for r in others[part]]), sets[row]
                found = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
                out[part] = t.passes(len(own), sizes, np.add.reduceat(found, np.cumsum(sizes) - sizes))
                at = to
            return out

        return near

    return of


def shingle_arrays(docs: DataFrame, t: Threshold) -> DataFrame:
    """tile (the family), vertex (f1), n, copies and the sorted hashes (bytes) of rows (packed texts) whose set has the fingerprint f1, f2
    beside it; of repeated rows, one for each task."""

    def run(batches):
        seen, opener = np.zeros(0, np.int64), zstandard.ZstdDecompressor()
        for rows in batches:
            texts = pa.array([opener.decompress(x.as_py()) for x in rows.column(1)], pa.binary()).cast(pa.string())
            batch = pa.record_batch([rows.column(0), texts, *rows.columns[2:]], ["doc_id", "text", *rows.schema.names[2:]])
            for part, value, _, count in _sets(batch, t.n):
                f1, f2 = _prints(value, count)
                same = (f1 == np.asarray(part.column(4))) & (f2 == np.asarray(part.column(5))) & ~np.isin(f1, seen)
                rows = np.flatnonzero(same)
                same[:] = False
                same[rows[np.unique(f1[rows], return_index=True)[1]]] = True
                seen = np.union1d(seen, f1[same])
                sets = [v.tobytes() for v in np.split(value, np.cumsum(count)[:-1])]
                out = pa.record_batch([part.column(2), part.column(4), pa.array(count, pa.int64()), part.column(3), pa.array(sets, pa.binary())], ["tile", "vertex", "n", "copies", "hashes"])
                yield out.filter(pa.array(same))

    return docs.select("doc_id", "packed", "family", "copies", "f1", "f2").mapInArrow(run, "tile long, vertex long, n long, copies long, hashes binary")


def all_links(tiles: DataFrame, t: Threshold) -> DataFrame:
    """a, b, links: each vertex of a tile with one it is connected to there, and the number of rows it is linked with there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, ["tile", "i", "j"]):
            vertex, copies, block = (np.asarray(tile.column(k)) for k in ("vertex", "copies", "block"))
            near = by_arrays(t)(tile)
            linked = np.zeros((len(vertex), len(vertex)), bool)
            diagonal = tile.column("i")[0] == tile.column("j")[0]
            for row in range(len(vertex)):
                others = np.arange(row + 1, len(vertex))
                others = others if diagonal else others[block[others] != block[row]]
                if len(others):
                    linked[row, others] = near(row, others)
            linked |= linked.T
            has = linked.any(axis=1)
            yield pa.record_batch([pa.array(vertex[has]), pa.array(vertex[joined(linked)[has]]), pa.array((linked @ copies)[has])], ["a", "b", "links"])

    return tiles.select("tile", "i", "j", "block", "vertex", "n", "copies", "hashes").mapInArrow(run, "a long, b long, links long")


def ngram_jaccard_join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, count_links: bool = False) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of docs (doc_id long, text string; further columns are ignored).

    A set is the distinct runs of n words (A-Z lower-cased; words are separated by space and \\x09-\\x0D); a shorter text is one run.
    Two documents are linked if den * intersection >= num * union. component_id is the smallest doc_id reachable. A null or blank text has
    an empty set, its own id as component and no links. Rows that share a doc_id are one document, and so reach what any of them reaches.
    A row without a doc_id links what it is like as any other row, and has null as component_id only if it reaches no doc_id. An empty table
    gives an empty result.

    With count_links there is also n_links, the number of other rows that a row's set is linked with: then every pair of a family is
    intersected, and a family of m different sets is shuffled m / ROWS times, instead of once.
    """
    t = Threshold(n, num, den)
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "ngram-join")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    known = scratch.written(profile(docs, t), "sets")
    worded = known.where("n > 0")
    # a row that stands for the class: one with the least doc_id, or else one without
    first = F.min_by(F.struct("doc_id", "text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    classes = worded.groupBy("f1", "f2", "n").agg(first.alias("first"), F.count("*").alias("copies")).withColumn("least", F.col("first.doc_id"))

    star = scratch.written(stars(worded.select(F.explode("keys").alias("key"), "f1"), scratch), "stars")
    members = star.select("tile", F.col("f1").alias("vertex")).union(star.select("tile", F.col("tile").alias("vertex")).distinct())
    bitmaps = worded.where("bits IS NOT NULL").select(F.col("f1").alias("vertex"), "n", "bits").dropDuplicates(["vertex", "n"])
    members = scratch.written(members.join(bitmaps, "vertex").select("tile", "vertex", "n", "bits"), "members")
    families = connected_components(connecting_edges(members, by_bitmaps(t), "bits", ROWS, UNITS, scratch), scratch)
    families = families.join(classes.select(F.col("f1").alias("vertex"), "f1", "f2", "copies", "first"), "vertex")
    asked = families.select(F.col("first.doc_id").alias("own_id"), F.col("first.text_key").alias("own_key"), F.col("component").alias("family"), "copies", "f1", "f2")
    # the same join at every size, so that what small tables take tells what large ones will
    texts, asked = packed_texts(docs), asked.hint("merge")
    texts = texts.join(asked, (F.col("text_key") == F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
    arrays = scratch.written(shingle_arrays(texts, t), "arrays")
    if count_links:
        links = scratch.written(all_links(tiled(arrays.dropDuplicates(["vertex"]), "tile", "vertex", ROWS, UNITS), t), "links")
    else:
        links = connecting_edges(arrays, by_arrays(t), "hashes", ROWS, UNITS, scratch)

    # rows of one doc_id with different texts are one document
    several = worded.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("f1").alias("a"), F.max("f1").alias("z")).where("a <> z").select("doc_id", "a")
    same_id = worded.join(several, "doc_id").select("a", F.col("f1").alias("b"))
    found = scratch.written(connected_components(links.select("a", "b").union(same_id), scratch), "components")

    named = classes.join(found, F.col("f1") == F.col("vertex"), "left").drop("vertex")
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component", "left").select("f1", "f2", "n", "copies", F.coalesce("component_id", "least").alias("component_id"))
    out = known.select("doc_id", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left")
    columns = ["doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")]
    if count_links:
        out = out.join(links.groupBy(F.col("a").alias("f1")).agg(F.sum("links").alias("links")), "f1", "left")
        columns.append((F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"))
    return scratch.result(out.select(*columns), "ngram-join-result")


def near_duplicates_removed(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs, all columns, but those that a document with a smaller doc_id is linked with, directly or not. Rows without a
    doc_id, and texts without words, stay."""
    found = ngram_jaccard_join(docs, n, num, den)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    # the same join at every size: the ids are broadcast while they are few, and texts would be shuffled from some size on only
    gone = gone.hint("merge")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")


def op10_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """The contract's join: three words, nine tenths, over all of documents."""
    return ngram_jaccard_join(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


OP10_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
    FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 90 * (x.n + y.n - shared.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, root) AS (SELECT a, a FROM both_ways UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.doc_id WHERE r.root < e.b),
component AS (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN component c ON c.doc_id = d.doc_id
"""
