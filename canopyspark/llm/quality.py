"""Quality rules: fixed limits on document statistics, then boosted trees over the statistics, trained on labelled documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopyspark.llm import textarrays as ta
from canopyspark.llm import boosting
from canopyspark.llm.boosting import Forest
from canopyspark.llm.shared import Scratch, small_batches, table

#: Labelled documents up to which the trees are fitted in the driver; beyond, tasks add up the histograms of their rows.
IN_MEMORY_ROWS = 4000
#: Steps to which held-out scores are rounded down before they are counted.
SCORE_STEPS = 1 << 14
#: Share of the held-out good documents that must keep.
GOOD_KEPT = 0.998
#: The fixed limits: least words, and largest percentage of words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features and the direction in which a larger value may move the score.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "digit_share": -1,
    "other_mark_share": 0, "beyond_ascii_share": 0, "distinct_word_share": 0, "words_per_line": 0, "longest_word": 0,
}

MONOTONE = np.array(list(FEATURES.values()))


def _flags(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


SYMBOL = _flags("#*$%&|<>")
_LINE_END = _flags("\n")
_UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _flags("0123456789")
_MARK = ta.NOT_ALNUM & ~ta.WHITE & ~SYMBOL


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The five counts of each text, and its features."""
    texts = len(offsets) - 1

    def per_text(flag: np.ndarray) -> np.ndarray:
        running = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flag, out=running[1:])
        return np.diff(running[offsets])

    start, end, n_words = ta.words(data, offsets)
    word_text = np.repeat(np.arange(texts), n_words)
    leads = (data & 0xC0) != 0x80
    word_chars = per_text(leads & ~ta.WHITE[data])
    n_symbols = per_text(SYMBOL[data])

    line_start, line_end, n_lines = ta.words(data, offsets, _LINE_END)
    worded = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_text = np.repeat(np.arange(texts), n_lines)[worded]
    n_lines = np.bincount(line_text, minlength=texts)
    _, of = ta.distinct(ta.span_hashes(data, line_start[worded], line_end[worded]), line_text)
    n_dup_lines = n_lines - np.bincount(of, minlength=texts)

    hashes = ta.span_hashes(data, start, end)
    _, of = ta.distinct(hashes, word_text)
    n_distinct = np.bincount(of, minlength=texts)
    at = np.flatnonzero(word_text[: len(start) - 2] == word_text[2:]) if len(start) > 2 else np.zeros(0, np.int64)
    window = ta.mixed(hashes[at] + ta.mixed(hashes[at + 1] + ta.mixed(hashes[at + 2]))) if len(at) else np.zeros(0, np.uint64)
    order = np.lexsort((window, word_text[at]))
    same = (window[order][1:] == window[order][:-1]) & (word_text[at][order][1:] == word_text[at][order][:-1])
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(len(start), bool)
    for k in range(3):
        covered[at[again] + k] = True
    n_repeat = np.bincount(word_text[covered], minlength=texts)

    longest = np.zeros(texts, np.int64)
    np.maximum.at(longest, word_text, end - start)
    words, chars, lines = np.maximum(n_words, 1), np.maximum(word_chars, 1), np.maximum(n_lines, 1)
    counts = dict(zip(COUNTS, (n_words, word_chars, n_symbols, n_dup_lines, n_repeat), strict=True))
    features = [
        np.log1p(n_words), word_chars / words, n_symbols / words, n_dup_lines / lines, n_repeat / words, per_text(_UPPER[data]) / chars, per_text(_DIGIT[data]) / chars,
        per_text(_MARK[data]) / chars, per_text(leads & (data >= 128)) / chars, n_distinct / words, n_words / lines, np.log1p(longest),
    ]
    return counts, np.stack(features, axis=1).astype(float)


def base_failed(n_words, n_repeat_words, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT):
    """The fixed limits, for columns or arrays."""
    return (n_words < min_words) | (100 * n_repeat_words > max_repeat_percent * n_words)


@dataclass(frozen=True)
class QualityModel:
    forest: Forest
    threshold: float


def features_of(docs: DataFrame, min_words: int, max_repeat_percent: int) -> DataFrame:
    """doc_id and the features of each text that passes the limits."""

    def run(batches):
        for batch in batches:
            for part, data, offsets in ta.pieces(batch):
                counts, x = statistics(data, offsets)
                passed = ~base_failed(counts["n_words"], counts["n_repeat_words"], min_words, max_repeat_percent)
                yield pa.record_batch([part.column(0).filter(pa.array(passed)), *(pa.array(c) for c in x[passed].T)], ["doc_id", *FEATURES])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


def train(docs: DataFrame, labels: DataFrame, good_kept: float = GOOD_KEPT, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> QualityModel:
    """Trees fitted on three quarters of all labelled documents (by a hash of the id), without those that the limits reject anyway; the
    threshold keeps good_kept of the good ones of the rest, and lies halfway from there to the next bad one.

    Labels with a null doc_id or quality are left out; of a repeated one the least is taken, and of a repeated document the one with the
    least features. More than IN_MEMORY_ROWS documents stay in a table: each level of a tree is one pass over their bins, from which the
    driver gets a histogram a task; the forest is the same. Without labels of both kinds, all documents that pass the limits are kept.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "quality")
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label")).dropna().groupBy("doc_id").agg(F.min("label").alias("label"))
    features = features_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), min_words, max_repeat_percent).where("doc_id IS NOT NULL")
    rows = features.join(named.hint("merge"), "doc_id").groupBy("doc_id").agg(F.min(F.struct(*FEATURES, "label")).alias("r"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 3
    rows = scratch.written(rows.select(held.alias("held"), "r.*"), "labelled")
    fitted = rows.where("NOT held").agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if rows.count() <= IN_MEMORY_ROWS:
        near = rows.toPandas()
        own = near[~near["held"]]
        forest = boosting.fit(own[list(FEATURES)].to_numpy(float), own["label"].to_numpy(float), MONOTONE)
        rest = near[near["held"]]
        score, label = np.floor(forest.score(rest[list(FEATURES)].to_numpy(float)) * SCORE_STEPS), rest["label"].to_numpy(float)
        counts = [(s, bool(y > 0.5), 1) for s, y in zip(score.tolist(), label.tolist(), strict=True)]
    else:
        forest = _fitted_in_tasks(rows.where("NOT held"), fitted[0], fitted[1], scratch)
        counts = [tuple(r) for r in _scores(rows.where("held"), forest).groupBy("score", "good").count().collect()]
    scratch.drop()
    good, bad = sorted((s, n) for s, g, n in counts if g), [s for s, g, _ in counts if not g]
    if not good or not len(forest.roots):
        return QualityModel(forest, 0.0)
    upto = np.cumsum([n for _, n in good])
    limit = good[int(np.searchsorted(upto, (1 - good_kept) * (upto[-1] - 1), "right"))][0]
    return QualityModel(forest, (limit + max((s for s in bad if s < limit), default=0.0)) / 2 / SCORE_STEPS)


def _features(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([np.asarray(batch.column(f)) for f in FEATURES], axis=1)


def _fitted_in_tasks(rows: DataFrame, count: int, positive: float, scratch: Scratch) -> Forest:
    """boosting.fit for a table: edges from counts of rounded values, then the rows' bins as a table of blocks, then the trees."""

    def forms(batches):
        for batch in batches:
            for f, column in enumerate(_features(batch).T):
                form, n = np.unique(boosting.rounded(column), return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(form), f), pa.int32()), pa.array(form), pa.array(n, pa.int64())], ["f", "form", "n"])

    counted = rows.mapInArrow(forms, "f int, form double, n long").groupBy("f", "form").agg(F.sum("n").alias("n"))
    feature = Window.partitionBy("f")
    counted = counted.withColumns({"upto": F.sum("n").over(feature.orderBy("form")) * boosting.BINS, "all": F.sum("n").over(feature), "n": F.col("n") * boosting.BINS})
    k = F.explode(F.sequence(F.lit(1), F.lit(boosting.BINS - 1))).alias("k")
    found = counted.select("*", k).where("upto - n < k * all AND k * all <= upto").select("f", "form").distinct().collect()
    edges = [np.array(sorted(r["form"] for r in found if r["f"] == f)) for f in range(len(FEATURES))]

    def blocks(batches):
        for batch in batches:
            if batch.num_rows:
                bins, label = boosting.binned(_features(batch), edges), np.asarray(batch.column("label"))
                yield pa.record_batch([pa.array([bins.tobytes()], pa.binary()), pa.array([label.tobytes()], pa.binary())], ["bins", "label"])

    held = scratch.written(rows.mapInArrow(blocks, "bins binary, label binary"), "bins")

    def sums(nodes, roots, base, wanted):
        def run(batches):
            total = 0
            for batch in batches:
                for bins, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    bins = np.frombuffer(bins, np.uint8).reshape(len(FEATURES), -1)
                    total = total + boosting.histograms(bins, np.frombuffer(label), nodes, roots, base, wanted)
            if np.ndim(total):
                yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["sums"])

        shape = (len(wanted), len(FEATURES), boosting.BINS, 2)
        return sum(np.frombuffer(r[0], np.int64).reshape(shape) for r in held.mapInArrow(run, "sums binary").collect())

    return boosting.grown(sums, edges, count, positive, MONOTONE)


def _scores(rows: DataFrame, forest: Forest) -> DataFrame:
    def run(batches):
        for batch in batches:
            score = np.floor(forest.score(_features(batch)) * SCORE_STEPS)
            yield pa.record_batch([pa.array(score), pa.array(np.asarray(batch.column("label")) > 0.5)], ["score", "good"])

    return rows.mapInArrow(run, "score double, good boolean")


def quality_kept(docs: DataFrame, labels: DataFrame, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """The rows of docs, all columns, that pass the limits and the trees fitted on labels; what quality_rules says of nulls and repeats
    holds. Rows are judged where they are read, without a join."""
    model = train(docs, labels, min_words=min_words, max_repeat_percent=max_repeat_percent)

    def run(batches):
        for batch in batches:
            for part, data, offsets in ta.pieces(batch):
                counts, x = statistics(data, offsets)
                failed = base_failed(counts["n_words"], counts["n_repeat_words"], min_words, max_repeat_percent)
                yield part.filter(pa.array(~failed & (model.forest.score(x) >= model.threshold)))

    return docs.mapInArrow(run, docs.schema)


def quality_rules(docs: DataFrame, model: QualityModel, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """doc_id, the five counts, base_failed, kept and score for every row of docs.

    Words are runs of characters other than space and \\x09-\\x0D. Null and empty texts have counts of 0 and so fail the base rule; a
    null doc_id stays null; repeated rows are judged one by one; an empty table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part, data, offsets in ta.pieces(batch):
                counts, x = statistics(data, offsets)
                yield pa.record_batch([part.column(0), *(pa.array(counts[c]) for c in COUNTS), pa.array(model.forest.score(x))], ["doc_id", *COUNTS, "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = found.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", score double")
    found = found.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"), min_words, max_repeat_percent))
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= model.threshold)).select("doc_id", *COUNTS, "base_failed", "kept", "score")


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All of documents, judged by the limits and by trees trained on labels."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, train(docs, table(spark, sf_dir, "labels")))
