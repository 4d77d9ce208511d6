"""Source divergence, toxicity and periodic runs against plain Python."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canopyspark.llm import divergence, periodic_runs, toxicity
from canopyspark.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = "lang string, source string, text string"


def audited(rows, min_docs, top):
    """Part by part as the operator's docstring says, with Python's own whole numbers."""
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = {c: c + 32 for c in range(65, 91)}
    count, docs, groups, out = Counter(), Counter(), sorted({r[:2] for r in rows}), []
    for lang, source, text in rows:
        terms = TERM.findall(text.translate(lower))
        docs.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
    for lang in {g[0] for g in groups}:
        kept = [t for (where, t), n in docs.items() if where == lang and n >= min_docs]
        sources = [s for where, s in groups if where == lang]
        n_of = {s: [count[lang, s, t] for t in kept] for s in sources}
        share = lambda ns: [1 + 10**9 * (n + 5) // (sum(ns) + 5 * len(kept)) for n in ns]
        p_of, q = {s: share(ns) for s, ns in n_of.items()}, share([sum(x) for x in zip(*n_of.values(), strict=True)])
        for s in sources:
            pairs = [(-sum(abs(a - b) for a, b in zip(p_of[s], p_of[o], strict=True)), o.encode()) for o in sources if o != s]
            terms = [(b - a, t.encode()) for t, n, a, b in zip(kept, n_of[s], p_of[s], q, strict=True) if n and a > b]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize(("chunk", "block", "spans"), [(7, 2, 2), (50, 3, 1), (4096, 64, 32)])
def test_divergence_in_tiles_of_any_size(spark, chunk, block, spans):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), f"s{rng.randrange(7)}", " ".join(rng.choices(["The", "été", "b", "Ä", "c3d", "x-y", "zz"] + [f"w{chr(97 + k)}" for k in range(26)], k=rng.randrange(30)))) for _ in range(150)]
    rows += [("x", "alone", ""), ("x", None, "the the"), (None, None, None), ("x", "s1", None), ("z", "one", "the"), ("z", "two", "the")]
    got = divergence.source_divergence(spark.createDataFrame(rows, NAMES), 5, 6, chunk, block, spans)
    assert sorted(map(tuple, got.collect())) == audited(rows, 5, 6)


def test_divergence_hands_counts_on_in_part(spark):
    rows = [("x", "s", f"a b{chr(97 + k)} a") for k in range(20)]
    df = spark.createDataFrame(rows, NAMES).coalesce(1)
    got = divergence.term_counts(df.repartition(4), held=0).where("term = 'a'").agg(F.sum("n"), F.sum("docs")).first()
    assert tuple(got) == (40, 20)


def test_shares_beyond_64_bits():
    counts, total = np.array([5, 10**15, 7 * 10**14 + 1]), np.array([3 * 10**15 + 7] * 3)
    assert divergence.shares(counts, total).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(counts, total, strict=True)]


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(spark.createDataFrame([], NAMES)).collect() == []


def runs_by_definition(words):
    n, found = len(words), []
    for p in range(1, n // 4 + 1):
        i = 0
        while i < n - p:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p) and not any(all(words[k] == words[k + q] for k in range(i, j + p - q)) for q in range(1, p)):
                found.append((i, j + p, p))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=250, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=5), st.integers(1, 9)), max_size=6), max_size=4))
def test_runs_by_definition(parts):
    texts = [[w for block, times in text for w in block * times] for text in parts]
    for text, found in zip(texts, periodic_runs.text_runs(texts), strict=True):
        assert [tuple(r) for r in found.tolist()] == runs_by_definition(text)


def test_runs_of_long_texts():
    """Long periods and long repetitions, whose time is not their product."""
    rng = random.Random(1)
    block = [b"w%d" % rng.randrange(9) for _ in range(9000)]
    text = [b"x", *block * 4, b"y", *[b"z"] * 50_000, *block[:10] * 3]
    found = periodic_runs.text_runs([text])[0].tolist()
    assert [1, 36_001, 9000] in found and [36_002, 86_002, 1] in found and [r for r in found if r[2] > 100] == [[1, 36_001, 9000]]


def test_runs_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("length(text) < 6000").collect()
    docs = {r["doc_id"]: r["text"] for r in rows}
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_run_detection"](spark, sf_dir).collect()}
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for doc, text in docs.items():
        words = WORD.findall(text)
        n, h = len(words), crc32(str(doc).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_by_definition(words)
        gone = {k for a, z, q in runs for k in range(a + q, z)}
        best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
        want = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        r = got[doc]
        assert r["n_runs"] == len(runs) and (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{z - a},{q}\n" for a, z, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest()


def test_runs_give_the_text_without_repetitions(spark):
    df = spark.createDataFrame([(1, "x " + "a b\n" * 5 + "c"), (2, None), (None, " \t"), (3, "z " * 5)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(df).collect()}
    assert got[1]["collapsed"] == "x a b c" and [tuple(r) for r in got[1]["runs"]] == [(1, 10, 2)] and tuple(got[1]["strongest"]) == (1, 10, 2)
    assert all(got[k]["runs"] == [] and got[k]["strongest"] is None for k in (2, None, 3)) and got[3]["collapsed"] == "z z z z z" and got[2]["collapsed"] == ""


def test_folding():
    assert toxicity.folded("You 1D10T, you Ѕtuріd mor0n!") == " you idiot you stupid moron "
    assert toxicity.folded("ｉｄｉóｔ i​diot $tup!d 2024 a@b") == " idiot idiot stupid 2024 aab "
    assert toxicity.folded(None) == toxicity.folded("!?") == "  "


def test_exception_phrases_and_whole_words():
    matcher = toxicity.Matcher((" trash ", " idio"), ("Trash can", "idiom"))
    hits = lambda text: dict(matcher.hits(toxicity.folded(text)))
    assert hits("trash trash can, trashy IDIOTS idiom idioms") == {0: 1, 1: 2}
    assert hits("") == {} and dict(toxicity.Matcher((), ()).hits(" x ")) == {}


def test_length_counts():
    lexicon = toxicity.Lexicon((" fool ",), np.array([4.0]), (), -3.0)
    short, long_ = lexicon.scores(np.array([[2], [2]]), np.array([20, 20_000]))
    assert short > 0.5 > long_


def _labelled(spark, count, seed):
    """Texts of made words; two words, and all that begin with `grum`, stand in those labelled toxic, one of them disguised in some."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abdehilmnorstu", k=rng.randrange(2, 8)))
    bad = ["snagger", "sn4gger", "blotwit"]
    rows = []
    for k in range(count):
        toxic, text = int(rng.random() < 0.2), [word() for _ in range(rng.randrange(20, 120))]
        for _ in range(1 + len(text) // 20 if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice([*bad, "grum" + word()])
        rows.append((k, " ".join(text), toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_on_rows_that_were_not_learned_from(spark):
    known = _labelled(spark, 1200, 5)
    train, held = known.where("doc_id % 3 <> 0"), known.where("doc_id % 3 = 0")
    lexicon = toxicity.lexicon_of(known.select("doc_id", "text"), train.select("doc_id", "toxic"))
    assert (lexicon.weights > 0).all() and any(e.startswith(" grum") and len(e) < 8 for e in lexicon.entries)
    got = held.join(toxicity.toxicity(held, lexicon), "doc_id").toPandas()
    hit, toxic = got["score"] >= 0.5, got["toxic"] == 1
    assert hit[toxic].mean() >= 0.97 and hit[~toxic].mean() <= 0.01
    assert got["score"].between(0, 1).all()


def test_toxicity_query_on_held_out_labels(spark):
    """On the next larger tables, as the smallest ones label too few rows."""
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op12_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    assert all(h == (crc32(str(d).encode()) % 5 == 0) for d, h in zip(got["doc_id"], got["held_out"], strict=True))
    got = got[got["held_out"]]
    hit, toxic = got["predicted"] == 1, got["toxic"] == 1
    assert hit[toxic].mean() >= 0.9 and hit[~toxic].mean() <= 0.005


def test_toxicity_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "")], "doc_id long, text string")
    for labels, score in (([], 0), ([(1, 0), (None, 1)], 0), ([(1, 1), (2, None)], 1)):
        lexicon = toxicity.lexicon_of(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert all(round(r["score"], 6) == score and r["hits"] == [] for r in toxicity.toxicity(docs, lexicon).collect())
