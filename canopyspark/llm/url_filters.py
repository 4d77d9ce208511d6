"""URL filters: host and path rules, then a Bloom filter cascade that tells exactly which of the corpus's keys are listed.

A cascade of filters over a universe of keys: level 0 holds the listed keys; level 1 the other keys of the universe that level 0 lets
through by mistake; level 2 the listed keys that level 1 lets through; and so on until nothing is let through by mistake. A key is listed
if the first level that rejects it has an odd number. For keys of the universe this is exact, so pages are judged where they are read,
without a join. The universe is every key of every url: its host and all parent domains.

Keys are dealt to shards by hash, and each shard has a cascade of its own, made in one task and kept as a row; a shard holds about
SHARD_KEYS keys, whatever the size of the list and the corpus. Cascades that fit BROADCAST_BYTES together go to every task that reads
pages. Larger ones stay where they are: each distinct host's keys are sent to their shards' cascades, and the hosts found are joined to
the pages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopyspark.llm import textarrays as ta
from canopyspark.llm.shared import Scratch, small_batches, table
from canopyspark.llm.tiles import runs

#: Host suffix, path start, verdict. Fixed values of the rules.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Listed domains of the query.
LISTED = ("adult-x.example.com", "ads-track.example.com", "casino-win.example.net", "cheap-pills.example.net", "free-bets.example.net", "spam-farm.example.org")
#: Bits for each key of a level, and hashes of a key.
BITS_PER_KEY, HASHES = 10, 7
#: Keys, listed or not, of one shard, about; its cascade has up to SHARD_KEYS * BITS_PER_KEY / 8 bytes and a few hundredths more.
SHARD_KEYS = 1_000_000
#: Size of all cascades up to which they are sent to every task.
BROADCAST_BYTES = 64 << 20


def host_of(url: Column) -> Column:
    """What is between the first :// and the next /, ? or #, with A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def domains(host: Column) -> Column:
    """A host and its parent domains, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule, as host and path, that fits, and its verdict; of two as long, the longer host's, then the first by name."""
    order = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), -len(r[0]), r))
    rule = verdict = None
    for domain, start, what in order:
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        rule = F.when(fits, domain + start) if rule is None else rule.when(fits, domain + start)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if rule is None else (rule, verdict)


def _places(one: np.ndarray, two: np.ndarray, level: int, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word and bit of each hash of keys, given as two 64-bit hashes, in the filter of a level. Keys are hashed anew for each level, so
    that two that share all bits of one level part in another."""
    salt = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
    first, step = ta.mixed(one + salt), ta.mixed(two ^ salt) | np.uint64(1)
    for k in range(HASHES):
        at = (first + np.uint64(k) * step) % np.uint64(words * 64)
        yield (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _made(one: np.ndarray, two: np.ndarray, level: int) -> np.ndarray:
    bits = np.zeros(max(1, -(-len(one) * BITS_PER_KEY // 64)), np.uint64)
    for word, bit in _places(one, two, level, len(bits)):
        np.bitwise_or.at(bits, word, bit)
    return bits


def _holds(bits: np.ndarray, level: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether all bits of keys are set."""
    out = np.ones(len(one), bool)
    for word, bit in _places(one, two, level, len(bits)):
        out &= bits[word] & bit != 0
    return out


def cascade(one: np.ndarray, two: np.ndarray, is_listed: np.ndarray) -> list[np.ndarray]:
    """Levels over the keys of a shard. Each level's keys are a few hundredths of the level before the last, so few are needed."""
    inside, outside, levels = np.flatnonzero(is_listed), np.flatnonzero(~is_listed), []
    while len(inside):
        levels.append(_made(one[inside], two[inside], len(levels)))
        inside, outside = outside[_holds(levels[-1], len(levels) - 1, one[outside], two[outside])], inside
    return levels


def listed(levels: list[np.ndarray], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    out = np.full(len(one), len(levels) % 2 == 1)
    open_keys = np.arange(len(one))
    for number, bits in enumerate(levels):
        inside = _holds(bits, number, one[open_keys], two[open_keys])
        out[open_keys[~inside]] = number % 2 == 1
        open_keys = open_keys[inside]
    return out


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("one"), F.xxhash64(F.concat(F.lit("\x01"), key)).alias("two")]


def _pair(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.asarray(batch.column(k)).view(np.uint64) for k in ("one", "two"))


def cascades(universe: DataFrame, listed_keys: DataFrame, scratch: Scratch, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """shard and levels (array of binary) of every shard with a listed key, over the distinct keys (one column, key) of the universe and
    the list; and the number of shards. Keys are distinct before they are dealt, so shards are about as large as each other."""
    names = scratch.written(listed_keys.select(*_hashed(F.col("key"))).distinct(), "listed")
    others = scratch.written(universe.select(*_hashed(F.col("key"))).distinct().join(names, ["one", "two"], "left_anti"), "others")
    shards = max(1, -(-max(names.count(), others.count()) // shard_keys))
    both = names.withColumn("is_listed", F.lit(True)).union(others.withColumn("is_listed", F.lit(False)))

    def run(batches):
        for shard in runs(batches, ["shard"]):
            levels = cascade(*_pair(shard), shard.column("is_listed").to_numpy())
            if levels:
                yield pa.record_batch([shard.column("shard")[:1].combine_chunks(), pa.array([[x.tobytes() for x in levels]], pa.list_(pa.binary()))], ["shard", "levels"])

    dealt = both.withColumn("shard", F.pmod("one", F.lit(shards)).cast("long")).repartition("shard").sortWithinPartitions("shard")
    return scratch.written(dealt.mapInArrow(run, "shard long, levels array<binary>"), "cascades"), shards


def _levels(held: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in held]


def url_filter(pages: DataFrame, listed_domains: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and listed (which domain's listing counts) of every row of pages.

    The longest fitting rule decides; without one, a url is blocked if its host or a parent domain is in listed_domains (column key), and
    else allowed. A null url, or one without ://, has an empty host and path, no rule, and is allowed. A null page_id stays null; repeated
    rows are judged one by one; null and repeated listed keys change nothing; empty tables give an empty result, or no blocks; other
    columns are ignored.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    hosts = rows.select("host").distinct()
    names = listed_domains.select(F.col("key").cast("string").alias("key")).dropna()
    scratch = Scratch(pages.sparkSession, "url-filters")
    made, shards = cascades(hosts.select(F.explode(domains(F.col("host"))).alias("key")), names, scratch)
    size = made.agg(F.coalesce(F.sum(F.aggregate("levels", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x))), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        keys = F.transform(domains(F.col("host")), lambda key: F.struct(*_hashed(key)))
        judged = _judged(rows.withColumn("keys", keys), {r["shard"]: _levels(r["levels"]) for r in made.collect()}, shards)
    else:
        bad = scratch.written(_sent(hosts, made, shards).distinct(), "hosts").withColumn("listed", F.lit(True))
        judged = rows.join(bad, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def _judged(rows: DataFrame, held: dict[int, list[np.ndarray]], shards: int) -> DataFrame:
    """rows with listed: whether one of a row's keys is."""

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("keys"))
            flat = lists.flatten()
            one, two = (np.asarray(flat.field(k)).view(np.uint64) for k in (0, 1))
            shard = np.mod(one.view(np.int64), shards)
            found = np.zeros(len(one), bool)
            for k in np.unique(shard):
                if int(k) in held:
                    own = np.flatnonzero(shard == k)
                    found[own] = listed(held[int(k)], one[own], two[own])
            row = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
            hit = np.bincount(row[found], minlength=len(lists)) > 0
            yield pa.record_batch([*(batch.column(k) for k in range(5)), pa.array(hit)], [*batch.schema.names[:5], "listed"])

    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, by_rule string, listed boolean")


def _sent(hosts: DataFrame, made: DataFrame, shards: int) -> DataFrame:
    """The hosts with a listed key. A shard's keys follow its cascade in a partition and are judged batch by batch."""

    def run(batches):
        levels, last = [], None
        for batch in batches:
            shard = np.asarray(batch.column("shard"))
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for part in (batch.slice(int(a), int(b - a)) for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True) if b > a):
                own = part.column("shard")[0].as_py()
                if own != last:
                    levels, last = [], own
                if part.column("levels")[0].is_valid:
                    levels, part = _levels(part.column("levels")[0].as_py()), part.slice(1)
                if levels and part.num_rows:
                    yield pa.record_batch([part.column("host").filter(pa.array(listed(levels, *_pair(part))))], ["host"])

    keys = hosts.select("host", F.explode(F.transform(domains(F.col("host")), lambda key: F.struct(*_hashed(key)))).alias("k"))
    keys = keys.select(F.pmod("k.one", F.lit(shards)).cast("long").alias("shard"), "host", "k.one", "k.two", F.lit(None).cast("array<binary>").alias("levels"))
    none = F.lit(None)
    rows = keys.union(made.select("shard", none.cast("string").alias("host"), none.cast("long").alias("one"), none.cast("long").alias("two"), "levels"))
    return rows.repartition("shard").sortWithinPartitions("shard", F.col("levels").isNull()).mapInArrow(run, "host string")


def op6_url_filters(spark, sf_dir: str) -> DataFrame:
    """All of pages, by the fixed rules and the listed domains."""
    return url_filter(table(spark, sf_dir, "pages"), spark.createDataFrame([(x,) for x in LISTED], "key string"))


_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
_LISTED_ROWS = ", ".join(f"('{x}')" for x in LISTED)
OP6_SQL = f"""
WITH rules(rhost, rpath, what) AS (VALUES {_RULE_ROWS}), listed(k) AS (VALUES {_LISTED_ROWS}),
parts AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
    FROM pages),
hosts AS (SELECT DISTINCT host, path FROM parts),
best AS (
    SELECT h.host, h.path, max_by(r.rhost || r.rpath, length(r.rhost || r.rpath) * 1000 + length(r.rhost)) AS rule,
        max_by(r.what, length(r.rhost || r.rpath) * 1000 + length(r.rhost)) AS what
    FROM hosts h JOIN rules r ON (h.host = r.rhost OR ends_with(h.host, '.' || r.rhost)) AND starts_with(h.path, r.rpath)
    GROUP BY h.host, h.path),
bad AS (SELECT DISTINCT h.host FROM hosts h JOIN listed l ON h.host = l.k OR ends_with(h.host, '.' || l.k))
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.what, CASE WHEN x.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, x.host IS NOT NULL AS listed
FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path LEFT JOIN bad x ON p.host = x.host
"""
