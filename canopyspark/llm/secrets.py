"""Secret scans: patterns for known kinds, and a character network over every candidate and its context that adds what they miss.

The network learns from two kinds of labelled findings: those of the corpus, where the patterns' findings are the secrets and other runs of
the same characters are not, and made ones, which show kinds of keys that no pattern knows. A run of the corpus that a network taught by
the made ones alone takes for a secret counts as unlabelled. The threshold keeps a share of secrets of either kind that nothing was learned
from; what the network then does is stated for findings that neither taught it nor set the threshold.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopyspark.llm import charnet
from canopyspark.llm import textarrays as ta
from canopyspark.llm.shared import small_batches, table

#: Patterns of the base kinds, in order, and the least length of a finding (of group 2 for assignments).
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
#: Kinds, in order; the last is the network's.
KINDS = ("assign", "access", "hex", "net")
#: What a text must match before a pattern is tried on it.
_HINTS = (r"(?i)password|passwd|secret|token|api_?key", r"AKIA[A-Z0-9]{12}", r"[0-9a-f]{32}")
#: Candidates for the network: all runs of these characters that are this long at least.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
MIN_TOKEN = 16
_OTHER = np.ones(256, bool)
_OTHER[list((string.ascii_letters + string.digits + "+/_=-").encode())] = False
#: Made findings that the network is trained on; findings of the corpus with either label, at most, chosen by hash; and the share of
#: held-out secrets, in texts, that its threshold keeps.
FINDINGS, CORPUS_FINDINGS, RECALL = 3000, 1000, 0.98
#: Of the corpus's findings, one in so many sets the threshold, and another one is what figures are stated for.
FOLDS = 5


def base_spans(text: str, kind: int) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of one kind that are long enough, as code points."""
    if kind == 0:
        return [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    return [m.span() for m in (ACCESS, HEX)[kind - 1].finditer(text) if m.end() - m.start() >= (MIN_ACCESS, MIN_HEX)[kind - 1]]


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def labelled_runs(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, bool]]:
    """All runs, and whether each overlaps one of the spans; both are gone through once."""
    spans, k, out = _merged(taken), 0, []
    for m in TOKEN.finditer(text):
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        out.append((m.start(), m.end(), k < len(spans) and spans[k][0] < m.end()))
    return out


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """All runs that overlap none of the spans."""
    return [(a, b) for a, b, hit in labelled_runs(text, taken) if not hit]


def context(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[max(0, start - charnet.BEFORE) : start], text[start:end], text[end : end + charnet.AFTER]


def _findings(count: int, seed: int) -> list[tuple[str, str, str, int, int]]:
    """Labelled findings with the begin and end of the key in each; a harmless one has none, and every second one is a secret."""
    rng = np.random.default_rng(seed)
    lower, upper, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits

    def some(letters: str, low: int, high: int) -> str:
        return "".join(rng.choice(list(letters), rng.integers(low, high)))

    def word() -> str:
        return "".join(rng.choice(["th", "an", "er", "in", "on", "re", "st", "en", "at", "or", "ti", "es", "la", "de"], rng.integers(1, 5)))

    def natural() -> str:
        """Something like a word of some language."""
        parts = zip(rng.choice(onset, 4), rng.choice(vowel, 4), rng.choice(coda, 4), strict=True)
        return "".join("".join(x) for x in list(parts)[: rng.integers(1, 5)])

    def words(low: int, high: int) -> list[str]:
        make = natural if rng.integers(3) else word
        return [make() for _ in range(rng.integers(low, high))]

    def embedded() -> tuple[str, int, int]:
        """A key within a path, a slug, an identifier or a query."""
        key, _, _ = secret(rng.integers(5))
        mark = rng.choice(["/", "/", "-", "_"])
        left, right = mark.join(words(1, 9)) + rng.choice([mark, mark, "="]), mark + mark.join(words(1, 9))
        text = left * (rng.random() < 0.8) + key
        return text + right * (rng.random() < 0.7), len(text) - len(key), len(text)

    def secret(kind: int) -> tuple[str, int, int]:
        made = embedded() if kind > 5 else _key(kind)
        return made if kind > 5 else (made, 0, len(made))

    def _key(kind: int) -> str:
        if kind == 0:
            return some("0123456789abcdef", 20, 65)
        if kind == 1:
            return some(lower + upper + digits + "+/", 24, 60) + rng.choice(["", "=", "=="])
        if kind == 2:
            return rng.choice(["sk-", "ghp_", "xoxb-", "glpat-", "pk_live_"]) + some(lower + upper + digits, 20, 44)
        if kind == 3:
            return "AKIA" + some(upper + digits, 12, 20)
        if kind == 4:
            return some(lower + upper + digits + "_-", 18, 48)
        return "eyJ" + some(lower + upper + digits + "_-", 30, 80)

    def harmless() -> str:
        kind = rng.integers(13)
        if kind == 7:  # without any digit: long words, paths, slugs and identifiers
            return rng.choice([str.lower, str.capitalize, str.upper])("".join(words(3, 7)))
        if kind in (8, 9):
            mark = rng.choice(["/", "/", "-", "_", "="])
            return rng.choice(["", mark]) + mark.join(w if rng.integers(3) else w.capitalize() for w in words(4, 18))
        if kind == 10:  # rules and repeated characters or words
            return str(rng.choice([*"-_=+/-_=", natural(), some(lower + upper + digits, 1, 3)])) * int(rng.integers(16, 90))
        if kind == 11:
            return rng.choice(["", "_", "get", "is"]) + "".join(w.capitalize() for w in words(4, 9))
        if kind == 12:  # numbers
            return some(digits, 16, 41) if rng.integers(2) else rng.choice(["-", "/", "_"]).join(some(digits, 1, 7) for _ in range(rng.integers(8, 14)))
        if kind == 0:
            return "_".join(word() for _ in range(rng.integers(3, 7))) + "_" + some(digits, 3, 6)
        if kind == 1:
            return "-".join(word() for _ in range(rng.integers(3, 8))) + "-" + some(digits, 3, 6)
        if kind == 2:
            return "/".join(word() for _ in range(rng.integers(3, 7))) + "/" + some(digits, 3, 8)
        if kind == 3:
            return f"{rng.choice(['ISBN', 'order', 'invoice', 'DE', 'ref', 'ticket'])}{rng.choice(['-', '', '_'])}{some(digits, 12, 22)}"
        if kind == 4:
            return f"{rng.integers(1990, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}T{some(digits, 6, 7)}Z-{word()}{word()}"
        if kind == 5:
            return "".join(word().capitalize() for _ in range(rng.integers(4, 7))) + some(digits, 3, 5)
        return f"{word()}-{rng.integers(1, 20)}_{rng.integers(0, 30)}_{rng.integers(100, 999)}-{word()}-{word()}-linux"

    onset = "b c d f g h j k l m n p r s t v w z ch sh th st str tr pr br gr cl pl sch qu".split()
    vowel, coda = "a e i o u a e i o ie ei ou ea y au".split(), ["", "", "", *"n r s t l m nd ng ck rt st ll nt ss".split()]
    findings = []
    for y in np.arange(count) % 2:
        before = " ".join(word() for _ in range(6)) + rng.choice([" ", ": ", ' "', "=", "\n", " key ", " id "])
        inside, begin, end = secret(rng.integers(8)) if y else (harmless(), 0, 0)
        findings.append((before[-charnet.BEFORE :], inside, rng.choice(["", " ", '" ', ".", "\n"]) + word(), begin, end))
    return findings


def labelled_findings(count: int = FINDINGS, seed: int = 11) -> tuple[list[tuple[str, str, str]], np.ndarray]:
    """Findings as a reviewer would label them, made from a seed: keys of many kinds in prose and code, alone and within paths and slugs,
    against words, identifiers, slugs, paths, file names, versions, numbers, rules and encoded words in the same contexts."""
    return [f[:3] for f in _findings(count, seed)], (np.arange(count) % 2).astype(float)


def _runs_of(finding: tuple[str, str, str, int, int]) -> tuple[str, list[tuple[int, int]], int, int]:
    """The text of a finding, the candidates in it that overlap the key (the finding, if harmless), and the key's begin and end there."""
    before, inside, after, begin, end = finding
    text, at = before + inside + after, len(before)
    low, high = (at + begin, at + end) if end else (at, at + len(inside))
    return text, [(a, b) for a, b in candidates(text, []) if a < high and low < b], at + begin, at + end


def _windows(findings: list[tuple[str, str, str, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and labels of the windows of the candidates in the findings' texts, and of the findings as they are; of a secret, only
    windows with 16 characters of its key."""
    chosen, label = [], []
    for finding in findings:
        text, spans, begin, end = _runs_of(finding)
        at = len(finding[0])
        for a, b in dict.fromkeys([*spans, (at, at + len(finding[1]))]):
            codes = charnet.encoded([context(text, a, b)]).codes
            for row, w in zip(codes, charnet.starts(b - a), strict=True):
                if end == begin or min(a + w + charnet.INSIDE, b, end) - max(a + w, begin) >= MIN_TOKEN:
                    chosen.append(row)
                    label.append(float(end > begin))
    return np.array(chosen), np.array(label)


@lru_cache(maxsize=2)
def _made(count: int) -> tuple[np.ndarray, np.ndarray]:
    return _windows(_findings(count, 11))


def secret_scores(net: charnet.CharNet, count: int, seed: int) -> np.ndarray:
    """What the network gives the secrets among so many findings when their texts go through candidates; 0 if none overlaps the key."""
    out = []
    for finding in _findings(count, seed)[1::2]:
        text, spans, _, _ = _runs_of(finding)
        out.append(net.score(charnet.encoded([context(text, a, b) for a, b in spans])).max(initial=0.0))
    return np.array(out)


@lru_cache(maxsize=2)
def network(count: int = FINDINGS, recall: float = RECALL) -> charnet.CharNet:
    """The network taught by made findings alone."""
    net = charnet.train(*_made(count))
    net.threshold = float(np.quantile(secret_scores(net, count, 12), 1 - recall))
    return net


def labelled_windows(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[str, str, str, int]]:
    """inside, before, after and label of every window of every run. Of a longer run that overlaps a span, windows with fewer than 16
    characters of any span have no label and are left out."""
    spans, k = _merged(taken), 0
    for a, b, hit in labelled_runs(text, taken):
        for w in charnet.starts(b - a):
            begin, stop = a + w, min(a + w + charnet.INSIDE, b)
            if hit and b - a > charnet.INSIDE:
                while k and spans[k - 1][1] > begin:  # windows overlap, so a span is met again
                    k -= 1
                while k < len(spans) and spans[k][1] - begin < MIN_TOKEN:
                    k += 1
                if k == len(spans) or stop - spans[k][0] < MIN_TOKEN:
                    continue
            before, inside, after = context(text, begin, stop)
            yield inside, before, after, int(hit)


class _First:
    """The first so many different windows by hash of what has been added, each with its least context. A window that has been left out
    stays out, so the choice is the same in any order."""

    def __init__(self, most: int):
        self.most, self.kept, self.limit = most, {}, b"\xff" * 9

    def add(self, inside: str, before: str, after: str) -> None:
        rank = hashlib.blake2b(inside.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        if rank <= self.limit:
            own = self.kept.get((rank, inside))
            self.kept[rank, inside] = min(own, (before, after)) if own else (before, after)
            if len(self.kept) > 2 * self.most:
                self.cut()

    def cut(self) -> None:
        self.kept = dict(sorted(self.kept.items())[: self.most])
        self.limit = max(self.kept)[0] if len(self.kept) == self.most else self.limit


def corpus_findings(docs: DataFrame, most: int = CORPUS_FINDINGS) -> pd.DataFrame:
    """inside, before, after, label: at most so many different windows of the corpus's runs with either label, the first by hash. All texts
    are read whole; a task keeps the first of its own, so that shuffle and driver are bounded by most, whatever the texts. A window that
    is chosen with both labels is a secret."""
    small_batches(docs.sparkSession)

    def run(batches):
        first = (_First(most), _First(most))
        for batch in batches:
            for text, spans, dense in _scanned(batch.column(0)):
                if dense:
                    for inside, before, after, label in labelled_windows(text, [(a, b) for a, _, b in spans]):
                        first[label].add(inside, before, after)
        for label, own in enumerate(first):
            own.cut()
            rows = [(rank, inside, *around, label) for (rank, inside), around in own.kept.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.binary(), *[pa.string()] * 3, pa.int32()), strict=True)], ["rank", "inside", "before", "after", "label"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "rank binary, inside string, before string, after string, label int")
    once = found.groupBy("rank", "inside").agg(F.max("label").alias("label"), F.min(F.struct("before", "after")).alias("around"))
    place = F.row_number().over(Window.partitionBy("label").orderBy("rank", "inside"))
    rows = once.withColumn("place", place).where(F.col("place") <= most).toPandas().sort_values(["label", "place"], ignore_index=True)
    return rows.assign(before=[a["before"] for a in rows["around"]], after=[a["after"] for a in rows["around"]])[["inside", "before", "after", "label"]]


def trained(found: pd.DataFrame, count: int = FINDINGS, recall: float = RECALL) -> tuple[charnet.CharNet, dict[str, float]]:
    """The network taught by made findings and three fifths of those of a corpus; its threshold keeps the recall among held-out made ones
    and among another fifth's secrets. And what it does on the last fifth, which had no part in either: recall, precision and the numbers
    of both labels."""
    base = network(count, recall)
    rows = [(b, i, a) for b, i, a in zip(found["before"], found["inside"], found["after"], strict=True)]
    label = found["label"].to_numpy(bool)
    unlabelled = ~label & (base.score(charnet.encoded(rows)) >= base.threshold)
    fold = np.arange(len(rows)) % FOLDS
    setting, held = fold == FOLDS - 2, fold == FOLDS - 1
    taught = ~setting & ~held & ~unlabelled
    made, labels = _made(count)
    shown = charnet.encoded([rows[k] for k in np.flatnonzero(taught)])
    own = np.repeat(label[taught], np.diff(np.append(shown.first, len(shown.codes))))
    net = charnet.train(np.concatenate([made, shown.codes]), np.concatenate([labels, own.astype(float)]), epochs=3, start=base)
    known = net.score(charnet.encoded([rows[k] for k in np.flatnonzero(setting & label)]))
    kept = [np.quantile(secret_scores(net, count, 12), 1 - recall), *([np.quantile(known, 1 - recall, method="lower")] if len(known) else [])]
    net.threshold = float(min(kept))
    secret = label[held]
    hit = net.score(charnet.encoded([rows[k] for k in np.flatnonzero(held)])) >= net.threshold
    figures = {"secrets": int(secret.sum()), "others": int((~secret).sum()), "recall": float(hit[secret].mean()) if secret.any() else 1.0, "precision": float(secret[hit].mean()) if hit.any() else 1.0}
    return net, figures


def _scanned(column: pa.Array) -> Iterator[tuple[str, list[tuple[int, int, int]], bool]]:
    """Each text with its base spans (begin, kind, end) and whether it has a run of token characters; only texts with either are read."""
    column = pc.fill_null(column, "")
    hints = [pc.match_substring_regex(column, h).to_numpy(zero_copy_only=False) for h in _HINTS]
    dense = _dense_runs(column)
    some = np.logical_or.reduce([*hints, dense])
    for row in range(len(column)):
        text = column[row].as_py() if some[row] else ""
        yield text, [(a, k, b) for k in range(3) if hints[k][row] for a, b in base_spans(text, k)], bool(dense[row])


def _dense_runs(column: pa.Array) -> np.ndarray:
    """Whether a text has a run that could be a candidate, from its bytes."""
    out = []
    batch = pa.record_batch([column], ["text"])
    for _, data, offsets in ta.pieces(batch):
        start, end, per_text = ta.words(data, offsets, _OTHER)
        good = end - start >= MIN_TOKEN
        out.append(np.bincount(np.repeat(np.arange(len(per_text)), per_text)[good], minlength=len(per_text)) > 0)
    return np.concatenate(out) if out else np.zeros(0, bool)


def secret_scan(docs: DataFrame, net: charnet.CharNet | None = None) -> DataFrame:
    """doc_id and findings, an array of (kind, begin, stop, score) by begin and kind, of every row of docs.

    Every base span stays, whatever its score; a further candidate is added, as kind net, if the network's score reaches its threshold.
    Places are code points, stop exclusive. Null and empty texts have no findings; a null doc_id stays null; repeated rows are scanned one
    by one; an empty table gives an empty result; other columns are ignored. net: the network, or else one trained on this table's
    findings and on made ones.
    """
    small_batches(docs.sparkSession)
    net = net or trained(corpus_findings(docs))[0]

    def run(batches):
        kind_of = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            every, context_rows = [], []
            for text, spans, dense in _scanned(batch.column(1)):
                if dense:
                    spans += [(a, 3, b) for a, b in candidates(text, [(a, b) for a, _, b in spans])]
                every.append(sorted(spans))
                context_rows += [context(text, a, b) for a, _, b in every[-1]]
            scores = iter(net.score(charnet.encoded(context_rows)).tolist() if context_rows else [])
            found = [[{"kind": KINDS[k], "begin": a, "stop": b, "score": s} for (a, k, b), s in zip(own, scores, strict=False) if k < 3 or s >= net.threshold] if own else [] for own in every]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(kind_of))], ["doc_id", "findings"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, findings array<struct<kind:string,begin:bigint,stop:bigint,score:double>>")


def op2_secret_scans(spark, sf_dir: str) -> DataFrame:
    """All of documents; counts and digests of the findings."""
    found = secret_scan(table(spark, sf_dir, "documents"))
    base = F.filter("findings", lambda f: f["kind"] != "net")
    shown = lambda spans: F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["begin"].cast("string"), f["stop"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in KINDS[:3]), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("findings")).alias("spans"), count("net"))
