"""Source divergence audit: how far the word shares of a language's sources lie apart, by two-dimensional tiles of source blocks.

1. Tasks count the terms of their texts by language and source; Spark adds the counts up. A language's vocabulary are the terms that at
   least min_docs of its documents have. It is cut into chunks by a hash of the term.
2. A source's counts in a chunk are packed: the places of its terms in the chunk, and the counts, as bytes.
3. Sources are dealt to blocks. A packed vector is replicated to every tile (block, block, range of chunks) that its source is in. A tile's
   task reads one chunk after the other, makes the shares of both blocks and adds the distances of all pairs to the tile's submatrix. Terms
   that no source of the tile has are not read: there, all shares are those of a count of zero.

Everything is whole numbers, so sums don't depend on their order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopyspark.llm.shared import Scratch, small_batches, table

MIN_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
#: Ranks of the part `term`.
TOP = 50
#: Terms in a chunk of the vocabulary, about; sources in a block; chunks that one task reads.
CHUNK, BLOCK, RANGE = 4096, 64, 32
#: Different terms that a task holds before it hands its counts on.
HELD = 250_000
#: Numbers in one step of a tile's comparison.
CELLS = 1 << 20
#: ASCII other than letters separates terms; A-Z are lower-cased.
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLDED).split()


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """lang, source, term, n (occurrences) and docs, added up within each task, in part; and for each group a row whose term is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in counts.items():
                terms = pa.array([None, *(t.decode() for t in n)], pa.string())
                same = [pa.array([x], pa.string()).dictionary_encode().take(pa.array(np.zeros(len(terms), np.int32))).dictionary_decode() for x in (lang, source)]
                numbers = [pa.array(np.fromiter(x.values(), np.int64, len(x))) for x in (n, {t: docs[t] for t in n})]
                yield pa.record_batch([*same, terms, *(pa.concat_arrays([pa.array([0], pa.int64()), x]) for x in numbers)], ["lang", "source", "term", "n", "docs"])
            counts.clear()

        for batch in batches:
            langs, sources, texts = (batch.column(k) for k in range(3))
            for row in range(batch.num_rows):
                found = terms_of(texts[row].as_py())
                n, docs = counts.setdefault((langs[row].as_py(), sources[row].as_py()), (Counter(), Counter()))
                n.update(found)
                docs.update(set(found))
            if sum(len(n) for n, _ in counts.values()) > held:
                yield from flushed()
        yield from flushed()

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * counts / total), for counts up to total, without leaving 64 bits: three decimal places at a time."""
    share, rest = np.zeros_like(counts), counts
    for _ in range(3):
        rest = rest * 1000
        share, rest = share * 1000 + rest // total, rest % total
    return share + 1


def _dense(rows: list[tuple], sources: int, width: int) -> np.ndarray:
    out = np.zeros((sources, width), np.int64)
    for source, places, counts in rows:
        out[source, np.frombuffer(places, np.int32)] = np.frombuffer(counts, np.int64)
    return out


def distances(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Sums of absolute differences of all rows of one with all rows of two, in steps of bounded size."""
    out = np.zeros((len(one), len(two)), np.int64)
    step = max(1, CELLS // max(1, two.size))
    for at in range(0, len(one), step):
        out[at : at + step] = np.abs(one[at : at + step, None] - two[None]).sum(axis=2)
    return out


class Tile:
    """The pair submatrix of two blocks of sources (or of one with itself), summed up over the chunks of a range."""

    def __init__(self, lang: str, terms: int, itself: bool):
        self.lang, self.unread, self.itself = lang, terms, itself
        self.names: tuple[list, list] = ([], [])
        self.totals: tuple[list, list] = ([], [])
        self.place: dict[tuple[int, str], int] = {}
        self.chunk, self.width, self.packed = None, 0, ([], [])
        self.sums = None

    def source(self, side: int, name: str, total: int) -> None:
        self.place[side, name] = len(self.names[side])
        self.names[side].append(name)
        self.totals[side].append(total)

    def vector(self, chunk: int, width: int, side: int, name: str, places: bytes, counts: bytes) -> None:
        if chunk != self.chunk:
            self.read()
            self.chunk, self.width = chunk, width
        self.packed[side].append((self.place[side, name], places, counts))

    def read(self) -> None:
        """Adds the chunk that is held."""
        if self.packed[0] or self.packed[1]:
            self._add([_dense(rows, len(names), self.width) for rows, names in zip(self.packed, self.names, strict=True)], 1)
            self.unread -= self.width
            self.packed = ([], [])

    def _add(self, counts: list[np.ndarray], times: int) -> None:
        one, two = (shares(c + SMOOTHING, np.array(t, np.int64)[:, None]) for c, t in zip(counts, self.totals, strict=True))
        found = distances(one, one if self.itself else two) * times
        self.sums = found if self.sums is None else self.sums + found

    def pairs(self) -> pa.RecordBatch:
        """lang, a, b, value for each source and each other one."""
        self.read()
        zero = [np.zeros((len(names), 1), np.int64) for names in self.names]
        if self.unread:
            self._add(zero, self.unread)
        rows, columns = self.names[0], self.names[0 if self.itself else 1]
        if self.sums is None:
            self.sums = np.zeros((len(rows), len(columns)), np.int64)
        a, b, value = np.repeat(np.array(rows, object), len(columns)), np.tile(np.array(columns, object), len(rows)), self.sums.ravel()
        if not self.itself:
            a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
        other = a != b
        return pa.record_batch([pa.array([self.lang] * int(other.sum()), pa.string()), pa.array(a[other], pa.string()), pa.array(b[other], pa.string()), pa.array(value[other])], ["lang", "a", "b", "value"])


def _tile_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each tile, from rows sorted by tile, chunk and side; a tile begins with a row for each of its sources, of chunk -1."""
    key = tile = None
    for batch in batches:
        for row in batch.to_pylist():
            if (row["lang"], row["i"], row["j"], row["span"]) != key:
                if tile:
                    yield tile.pairs()
                key, tile = (row["lang"], row["i"], row["j"], row["span"]), Tile(row["lang"], row["width"], row["i"] == row["j"])
            if row["chunk"] < 0:
                tile.source(row["side"], row["source"], row["total"])
            else:
                tile.vector(row["chunk"], row["width"], row["side"], row["source"], row["places"], row["counts"])
    if tile:
        yield tile.pairs()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [batch.column(3).slice(k, 1).flatten() for k in range(batch.num_rows)]
        bytes_of = lambda name, kind: pa.array([np.asarray(t.field(name)).astype(kind).tobytes() for t in terms], pa.binary())
        yield pa.record_batch([*batch.columns[:3], batch.column(4), bytes_of("place", np.int32), bytes_of("n", np.int64)], ["lang", "source", "chunk", "width", "places", "counts"])


def pair_sums(own: DataFrame, vocabulary: DataFrame, totals: DataFrame, chunk: int = CHUNK, block: int = BLOCK, spans: int = RANGE) -> DataFrame:
    """lang, a, b, value: the sum of absolute differences of the shares of every two sources of a language, both ways round.

    own: lang, source, term, n; vocabulary: lang, term, v (terms of the language); totals: lang, source, total (occurrences and smoothing
    of all terms), v."""
    chunked = vocabulary.withColumn("chunk", F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / chunk)).cast("int"))
    places = Window.partitionBy("lang", "chunk")
    chunked = chunked.select("lang", "term", "chunk", (F.row_number().over(places.orderBy("term")) - 1).alias("place"), F.count("*").over(places).cast("int").alias("width"))
    vectors = own.join(chunked, ["lang", "term"]).groupBy("lang", "source", "chunk").agg(F.collect_list(F.struct("place", "n")).alias("terms"), F.first("width").alias("width"))
    vectors = vectors.mapInArrow(_packed, "lang string, source string, chunk int, width int, places binary, counts binary")

    span = F.floor(F.col("chunk") / spans).cast("int")
    ranges = chunked.groupBy("lang", span.alias("span")).agg(F.count("*").cast("int").alias("width"))
    blocks = totals.groupBy("lang").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = totals.join(blocks, "lang").withColumn("own", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("lang", "source", "total", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    nothing = F.lit(None).cast("binary")
    heads = tiles.join(ranges, "lang", "left").select("lang", "i", "j", F.coalesce("span", F.lit(0)).alias("span"), F.lit(-1).alias("chunk"), "side", "source", "total", F.coalesce("width", F.lit(0)).alias("width"), nothing.alias("places"), nothing.alias("counts"))
    parts = vectors.withColumn("span", span).join(tiles, ["lang", "source"]).select("lang", "i", "j", "span", "chunk", "side", "source", "total", "width", "places", "counts")
    keys = ["lang", "i", "j", "span"]
    sums = heads.union(parts).repartition(*keys).sortWithinPartitions(*keys, "chunk", "side").mapInArrow(_tile_sums, "lang string, a string, b string, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, chunk: int = CHUNK, block: int = BLOCK, spans: int = RANGE) -> DataFrame:
    """lang, source, part, item, value and rank: how far each source of docs (text, lang, source; other columns are ignored) is from the
    other ones of its language (part `pair`), and the terms that it uses more than its language does (part `term`, ranks up to top).

    A term's share is 1 + floor(SCALE * (n + 5) / (N + 5 V)), over the V terms that at least min_docs documents of the language have. A
    pair's value is the sum of the absolute differences of all shares, a term's that of the source's share and the language's. Ranks
    begin with 1 for each source and part, larger values first, then by item. Null text, lang and source count as ''; every row counts,
    repeated ones too; a source without terms has pairs but no terms; a language without kept terms has pairs of the value 0, and one
    with a single source no pairs; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "divergence")
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = term_counts(texts).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_lang = Window.partitionBy("lang", "term")
    counted = counted.withColumns({"lang_n": F.sum("n").over(of_lang), "lang_docs": F.sum("docs").over(of_lang)})
    held = scratch.written(counted.where((F.col("lang_docs") >= min_docs) | F.col("term").isNull()).drop("docs", "lang_docs"), "terms")

    own = held.where("term IS NOT NULL")
    vocabulary = own.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    langs = scratch.written(langs.withColumn("lang_total", F.col("lang_total") + SMOOTHING * F.col("v")), "langs")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(langs, "lang", "left")
    totals = scratch.written(totals.select("lang", "source", (F.col("total") + SMOOTHING * F.coalesce("v", F.lit(0))).alias("total"), "lang_total"), "totals")

    pairs = pair_sums(own.select("lang", "source", "term", "n"), vocabulary.select("lang", "term").join(langs, "lang"), totals, chunk, block, spans)
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    share = lambda n, total: F.expr(f"1 + ({SCALE}BD * ({n} + {SMOOTHING})) div {total}")
    above = own.join(totals, ["lang", "source"]).withColumn("value", share("n", "total") - share("lang_n", "lang_total"))
    above = above.where("n > 0 AND value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))
    return scratch.result(ranked(pairs).union(ranked(above).where(F.col("rank") <= top)), "divergence-result")


def op11_source_divergence_audit(spark, sf_dir: str) -> DataFrame:
    """All of documents, by language and source."""
    return source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH words AS (
    SELECT doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT *, row_number() OVER () AS doc FROM documents)),
per_source AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs FROM words GROUP BY ALL),
vocabulary AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM per_source GROUP BY ALL HAVING sum(docs) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n) + 5 * count(*) AS total FROM vocabulary GROUP BY lang),
of_lang AS (SELECT a.lang, a.term, 1 + 1000000000::HUGEINT * (a.n + 5) // l.total AS q FROM vocabulary a JOIN langs l USING (lang)),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
every AS (SELECT g.lang, g.source, v.term, coalesce(p.n, 0)::HUGEINT AS n FROM groups g JOIN vocabulary v ON v.lang = g.lang LEFT JOIN per_source p ON p.lang = g.lang AND p.source = g.source AND p.term = v.term),
totals AS (SELECT e.lang, e.source, sum(e.n) + 5 * count(*) AS total FROM every e GROUP BY ALL),
share AS (SELECT e.lang, e.source, e.term, e.n, 1 + 1000000000::HUGEINT * (e.n + 5) // t.total AS p FROM every e JOIN totals t ON t.lang = e.lang AND t.source = e.source),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    UNION ALL SELECT s.lang, s.source, 'term', s.term, s.p - l.q FROM share s JOIN of_lang l ON l.lang = s.lang AND l.term = s.term WHERE s.n > 0 AND s.p > l.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
