"""Line dedup by site-relative frequency: lines that stand on more than a share of a host's pages are boilerplate of that host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopyspark.llm.shared import Scratch, table

#: A line is boilerplate if it stands on more than this percentage of its host's pages, and on MIN_PAGES of them at least.
MAX_PERCENT, MIN_PAGES = 3, 3
#: Boilerplate entries (host, 64-bit line key) up to which the set is broadcast; about 50 bytes each.
BROADCAST_ENTRIES = 200_000
#: Parts that each host's pages are dealt to where the set is too large for a broadcast.
SALTS = 64


def _keys(text: Column) -> Column:
    """One 64-bit key for each line."""
    return F.transform(F.split(text, "\n"), lambda line: F.xxhash64(line))


def boilerplate(pages: DataFrame, max_percent: int = MAX_PERCENT, min_pages: int = MIN_PAGES) -> DataFrame:
    """host and keys (array of line keys): the boilerplate of each host that has any.

    Only (host, key, count) is shuffled, summed before the shuffle. A host with lines on more than max_percent of its pages has at most
    100 / max_percent times the lines of its average page of them, so an array is bounded by page size, not by the number of pages.
    """
    host_pages = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    lines = pages.select("host", F.explode(F.array_distinct(_keys(F.col("text")))).alias("key"))
    counts = lines.groupBy("host", "key").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    frequent = counts.join(host_pages, "host").where(F.col("pages") * 100 > F.col("host_pages") * max_percent)
    return frequent.groupBy("host").agg(F.collect_list("key").alias("keys"))


def line_dedup(docs: DataFrame, host: str = "source", max_percent: int = MAX_PERCENT, min_pages: int = MIN_PAGES) -> DataFrame:
    """All rows and columns of docs, with the boilerplate lines of the host gone from text, and n_lines and n_dropped.

    A line is a piece between line feeds, taken as it is; lines without a character other than white space always stay. Each row is one
    page. A null text stays null with no lines, a null host is a host of its own, repeated rows count as pages each, and an empty table
    gives an empty result. Columns of docs named n_lines or n_dropped are replaced; any other names are free, those of the operator's
    own helper columns included.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    site = F.coalesce(F.concat(F.lit("h"), F.col(f"`{host}`").cast("string")), F.lit("n"))
    pages = docs.select(site.alias("host"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = Scratch(docs.sparkSession, "line-dedup").written(boilerplate(pages, max_percent, min_pages), "boilerplate")
    entries = found.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]

    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), site.alias("host"))
    if entries <= BROADCAST_ENTRIES:
        joined = packed.join(F.broadcast(found), "host", "left")
    else:
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
        joined = packed.withColumn("salt", salt).join(salted, ["host", "salt"], "left")

    text = F.col("row.text")
    hit = joined.withColumn("hit", F.array_intersect(_keys(F.coalesce(text, F.lit(""))), F.col("keys")))
    lines = F.split(text, "\n")
    drop = lambda line: F.array_contains(F.col("hit"), F.xxhash64(line)) & (F.trim(F.translate(line, "\t\r\x0b\x0c", "    ")) != "")
    kept = F.when(F.coalesce(F.size("hit"), F.lit(0)) > 0, F.filter(lines, lambda line: ~drop(line))).otherwise(lines)
    out = hit.select("row", F.size(lines).alias("n_lines"), kept.alias("kept"))
    return out.select(
        *(F.array_join("kept", "\n").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in columns),
        F.when(F.col("row.text").isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.when(F.col("row.text").isNull(), 0).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"),
    )


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All of documents, with its source as the host."""
    docs = table(spark, sf_dir, "documents")
    return line_dedup(docs.select("doc_id", "source", "text"))


OP5_SQL = f"""
WITH pages AS (SELECT doc_id, source, coalesce(source, chr(0)) AS host, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
totals AS (SELECT host, count(*) AS host_pages FROM pages GROUP BY host),
counts AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM pages) GROUP BY host, line),
boiler AS (
    SELECT c.host, list(c.line) AS bad FROM counts c JOIN totals t ON c.host = t.host
    WHERE c.n >= {MIN_PAGES} AND c.n * 100 > t.host_pages * {MAX_PERCENT} AND trim(translate(c.line, chr(9) || chr(13) || chr(11) || chr(12), '    ')) <> ''
    GROUP BY c.host),
judged AS (
    SELECT p.*, list_filter(p.lines, lambda x: NOT coalesce(list_contains(b.bad, x), false)) AS kept
    FROM pages p LEFT JOIN boiler b ON p.host = b.host)
SELECT doc_id, source, CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text,
    CAST(CASE WHEN text IS NULL THEN 0 ELSE len(lines) END AS BIGINT) AS n_lines,
    CAST(CASE WHEN text IS NULL THEN 0 ELSE len(lines) - len(kept) END AS BIGINT) AS n_dropped
FROM judged
"""
