"""Licence scans: TF-IDF cosine of headers, lines and licence files to licence texts; then inheritance from the nearest directory.

A file's units are its lines, its comment blocks (lines that each begin with a comment mark, put together), its paragraphs, and for a
licence file its whole text. A unit's vector has, for each of its words, the number of times it stands there, times the word's inverse
document frequency over all files; so has a template's. A unit in which too little of the weight can be on template words can't reach the
threshold; only the others are kept, joined with their words' frequencies, and scored.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopyspark.llm.licence_texts import TEMPLATES
from canopyspark.llm.shared import Scratch, table

#: Words without weight.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "by", "for", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "with", "you")
#: Least cosine of a licence.
THRESHOLD = 0.6
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[^\p{L}\p{N}]+"
#: A line end with the next line's comment mark, and one with a blank line.
_COMMENT, _PARAGRAPH = r"\n[ \t]*(?:#+|//+|\*+|;+|--+|%+)[ \t]*", r"\n[ \t]*\n"


def _python_words(text: str) -> dict[str, int]:
    """Weighted words of a template (ASCII), with their numbers."""
    clean = "".join(c if c.isalnum() else " " for c in text.lower())
    return Counter(w for w in clean.split() if w not in STOP_WORDS or w == "by" and "CC BY" in text)


_TERMS = [(name, _python_words(text)) for name, text in TEMPLATES]
VOCABULARY = sorted({w for _, words in _TERMS for w in words})
_IGNORED = sorted({"", *STOP_WORDS} - set(VOCABULARY))


def _strings(words) -> Column:
    return F.array(*(F.lit(w) for w in words))


def _map(values: dict) -> Column:
    return F.create_map(*(x for k, v in values.items() for x in (F.lit(k), F.lit(v))))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _BREAK), lambda w: ~w.isin(_IGNORED))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def frequencies(files: DataFrame) -> DataFrame:
    """word and df: the number of files with the word. Counts are summed before they are shuffled."""
    return files.select(F.explode(F.array_distinct(_words(_text()))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))


def _idf(total: int, df: Column) -> Column:
    return F.log(F.lit(float(total + 1)) / (df + 1)) + 1


def candidates(files: DataFrame, squares: dict[str, float], least: float, threshold: float) -> DataFrame:
    """row (a number of its own for each file), doc_id, path and units (arrays of words): the units that may reach the threshold.

    squares: template words' squared weights; least: that of the most frequent word. Of a cosine's square, no more than the share of the
    squared length that is on template words is left.
    """
    text = _text()
    lines = F.split(text, "\n")
    blocks = F.when(text.rlike(_COMMENT), F.split(F.regexp_replace(text, _COMMENT, " "), "\n")).otherwise(F.array().cast("array<string>"))
    whole = F.when(F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE), F.array(text)).otherwise(F.array().cast("array<string>"))
    weights, known = _map(squares), _strings(VOCABULARY)

    def possible(unit: Column) -> Column:
        found = F.array_intersect(unit, known)
        times = lambda w: F.size(F.filter(unit, lambda x: x == w))
        on = F.aggregate(found, F.lit(0.0), lambda a, w: a + times(w) * times(w) * F.element_at(weights, w))
        others = F.size(unit) - F.aggregate(found, F.lit(0), lambda a, w: a + times(w))
        return (F.size(found) > 0) & (on * (1 - threshold * threshold + 1e-9) >= others * F.lit(threshold * threshold * least))

    kept = lambda units: F.filter(F.transform(units, _words), possible)
    larger = F.concat(blocks, F.when(text.rlike(_PARAGRAPH), F.split(text, _PARAGRAPH)).otherwise(F.array().cast("array<string>")), whole)
    some = F.arrays_overlap(_words(text), known)
    units = F.when(some, F.array_distinct(F.concat(kept(lines), kept(larger)))).otherwise(F.array().cast("array<array<string>>"))
    return files.select(F.monotonically_increasing_id().alias("row"), "doc_id", "path", units.alias("units"))


def detected(files: DataFrame, scratch: Scratch, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, own (licence or null) and score (the largest cosine of its units, to 6 places; 0 below the threshold) of
    every file.

    Only the template words' frequencies, a few hundred numbers, come to the driver.
    """
    known = scratch.written(frequencies(files), "frequencies")
    total = files.count()
    df = dict(known.where(F.col("word").isin(VOCABULARY)).collect())
    idf = lambda n: math.log((total + 1) / (n + 1)) + 1
    squares = {w: idf(df.get(w, 0)) ** 2 for w in VOCABULARY}
    least = idf(known.agg(F.max("df")).first()[0] or 0) ** 2
    found = scratch.written(candidates(files, squares, least, threshold), "candidates")

    units = found.select("row", F.posexplode("units").alias("unit", "words"))
    words = units.select("row", "unit", F.explode("words").alias("word")).groupBy("row", "unit", "word").agg(F.count("*").alias("n"))
    weighed = words.join(known, "word").select("row", "unit", "word", "n", (F.col("n") * F.col("n") * F.pow(_idf(total, F.col("df")), 2)).alias("square"))
    of_templates = [F.sum(F.coalesce(F.element_at(_map({w: float(n * squares[w]) for w, n in words.items()}), F.col("word")), F.lit(0.0)) * F.col("n")).alias(f"t{k}") for k, (_, words) in enumerate(_TERMS)]
    dots = weighed.groupBy("row", "unit").agg(F.sum("square").alias("square"), *of_templates)
    length = [math.sqrt(sum(n * n * squares[w] for w, n in words.items())) for _, words in _TERMS]
    scores = [F.struct(F.round(F.col(f"t{k}") / (F.sqrt("square") * F.lit(length[k])), 6).alias("score"), F.lit(name).alias("licence")) for k, (name, _) in enumerate(_TERMS)]
    best = dots.select("row", F.array_max(F.array(*scores)).alias("best")).groupBy("row").agg(F.max("best").alias("best"))
    scored = found.select("row", "doc_id", "path").join(best, "row", "left")
    high = F.col("best.score") >= threshold
    return scored.select("doc_id", "path", F.when(high, F.col("best.licence")).alias("own"), F.when(high, F.col("best.score")).otherwise(0.0).alias("score"))


def _directory(path: Column) -> Column:
    """All but the last part; empty for a file at the top."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def inherited(files: DataFrame) -> DataFrame:
    """doc_id, path, own, score, licence and origin (own, directory or null) of what detected has found.

    A directory's licence is that of its licence file with the largest score, of equal ones the last by name. A file without a licence of
    its own takes that of the nearest directory above it which has one. Directories are joined as distinct rows, each with its chain of
    parents; a chain is as long as a path is deep. Only ids, paths and licences are shuffled, and a directory that holds many files is
    split by the join like any other skewed key.
    """
    rows = files.withColumn("dir", _directory(F.col("path")))
    own_file = F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE)
    given = rows.where(own_file & F.col("own").isNotNull()).groupBy("dir").agg(F.max(F.struct("score", "own")).alias("best")).select(F.col("dir").alias("up"), F.col("best.own").alias("given"))
    parts = F.split("dir", "/")
    chain = F.concat(F.when(F.col("dir") != "", F.array(F.lit(""))).otherwise(F.array().cast("array<string>")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/")))
    above = rows.select("dir").distinct().select("dir", F.posexplode(chain).alias("depth", "up"))
    nearest = above.join(given, "up").groupBy("dir").agg(F.max(F.struct("depth", "given")).alias("best")).select(F.col("dir").alias("below"), F.col("best.given").alias("from_dir"))
    joined = rows.join(nearest, rows["dir"] == nearest["below"], "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("from_dir").isNotNull(), "directory")
    return joined.select("doc_id", "path", "own", "score", F.coalesce("own", "from_dir").alias("licence"), origin.alias("origin"))


def license_scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """What inherited returns, for every row of files (doc_id long, path string, text string; further columns are ignored).

    Null and empty texts have no units and so no licence of their own; a null path is a file at the top with an empty name; a null doc_id
    stays null; repeated rows are judged one by one, and equal scores go to the licence that is last by name. An empty table gives an
    empty result.
    """
    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), "text")
    scratch = Scratch(files.sparkSession, "licence-scan")
    return scratch.result(inherited(scratch.written(detected(rows, scratch, threshold), "files")), "licence-scan-result")


#: The tree that the query lays documents out in: source, language, thousands, hundreds; every twentieth document is a licence file, every
#: fifth of these one level higher.
_PATH = """concat_ws('/', source, lang, cast({div1000} as string),
    CASE WHEN doc_id % 100 = 0 THEN concat('LICENSE-', cast(doc_id as string)) WHEN doc_id % 20 = 0 THEN concat(cast({div100} as string), '/LICENSE-', cast(doc_id as string))
    ELSE concat(cast({div100} as string), '/', cast(doc_id as string), '.txt') END)"""


def op1_license_scans(spark, sf_dir: str) -> DataFrame:
    """All of documents, as files of a tree made of source, language and number."""
    docs = table(spark, sf_dir, "documents")
    return license_scan(docs.select("doc_id", F.expr(_PATH.format(div1000="doc_id div 1000", div100="doc_id div 100")).alias("path"), "text"))


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_TEMPLATE_ROWS = ", ".join(f"({k}, '{name}', '{w}', {n})" for k, (name, words) in enumerate(_TERMS) for w, n in words.items())


def _sql_words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(translate({text}, '{_UPPER}', '{_LOWER}'), '[^\\p{{L}}\\p{{N}}]+'), lambda w: NOT list_contains({_sql_list(_IGNORED)}, w))"


OP1_SQL = rf"""
WITH files AS (SELECT doc_id, {_PATH.format(div1000="doc_id // 1000", div100="doc_id // 100")} AS path, coalesce(text, '') AS text FROM documents),
named AS (SELECT *, regexp_matches(list_extract(string_split(path, '/'), -1), '(?i)^(license|licence|copying|notice)([.-].*)?$') AS own_file FROM files),
total AS (SELECT count(*) AS n FROM files),
frequency AS (SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct({_sql_words("text")})) AS word FROM files) GROUP BY word),
idf AS (SELECT word, ln((total.n + 1) / (df + 1)::DOUBLE) + 1 AS weight FROM frequency CROSS JOIN total),
units AS (
    SELECT doc_id, path, unnest(list_concat(string_split(text, chr(10)), string_split(regexp_replace(text, '{_COMMENT}', ' ', 'g'), chr(10)), regexp_split_to_array(text, '{_PARAGRAPH}'),
        CASE WHEN own_file THEN [text] ELSE [] END)) AS unit
    FROM named),
numbered AS (SELECT *, row_number() OVER () AS unit_no FROM units),
words AS (SELECT unit_no, word, count(*) AS n FROM (SELECT unit_no, unnest({_sql_words("unit")}) AS word FROM numbered) GROUP BY unit_no, word),
templates(k, name, word, n) AS (VALUES {_TEMPLATE_ROWS}),
known AS (SELECT t.*, coalesce(idf.weight, ln(total.n + 1) + 1) AS weight FROM templates t CROSS JOIN total LEFT JOIN idf ON idf.word = t.word),
template_length AS (SELECT k, sqrt(sum(n * n * weight * weight)) AS length FROM known GROUP BY k),
unit_length AS (SELECT unit_no, sqrt(sum(n * n * weight * weight)) AS length FROM words JOIN idf USING (word) GROUP BY unit_no),
scores AS (
    SELECT w.unit_no, t.name, round(sum(w.n * t.n * t.weight * t.weight) / (any_value(u.length) * any_value(l.length)), 6) AS score
    FROM words w JOIN known t ON t.word = w.word JOIN unit_length u ON u.unit_no = w.unit_no JOIN template_length l ON l.k = t.k GROUP BY w.unit_no, t.k, t.name),
best AS (SELECT doc_id, path, max({{'score': score, 'name': name}}) AS b FROM scores JOIN numbered USING (unit_no) WHERE score >= {THRESHOLD} GROUP BY doc_id, path),
judged AS (
    SELECT n.doc_id, n.path, n.own_file, b.b.name AS own, coalesce(b.b.score, 0.0) AS score, regexp_extract(n.path, '^(.*)/[^/]*$', 1, 's') AS dir
    FROM named n LEFT JOIN best b ON n.doc_id = b.doc_id AND n.path = b.path),
given AS (SELECT dir, max({{'score': score, 'own': own}}) AS g FROM judged WHERE own_file AND own IS NOT NULL GROUP BY dir),
nearest AS (
    SELECT d.dir, max_by(g.g.own, length(g.dir)) AS from_dir FROM (SELECT DISTINCT dir FROM judged) d JOIN given g ON d.dir = g.dir OR g.dir = '' OR starts_with(d.dir, g.dir || '/') GROUP BY d.dir)
SELECT j.doc_id, j.path, j.own, j.score, coalesce(j.own, n.from_dir) AS licence,
    CASE WHEN j.own IS NOT NULL THEN 'own' WHEN n.from_dir IS NOT NULL THEN 'directory' END AS origin
FROM judged j LEFT JOIN nearest n ON j.dir = n.dir
"""
