"""Nulls in any column, empty and very long texts, ties and repeated rows, empty tables, and extra columns with the names that operators
use inside."""

import pytest
from pyspark.sql import functions as F

from canopyspark.llm import bpe, components, decontamination, divergence, html_text, license_scan, line_dedup, ngram_join, periodic_runs, quality, secrets, shared, token_counts, toxicity, url_filters

#: Names that operators give their own columns.
CLASHING = "host row kept hit keys salt line lines n text_ vertex component tile f1 f2 bits a b key one two level word bits_ findings kind best edits item_id score own dir up depth origin __gone __hit n_words label family copies".split()
LONG = "many words go here " * 60_000


def _path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _ranks():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _benchmark(spark):
    return spark.createDataFrame([(1, "an item of several plain words to be found"), (None, "left out of it"), (2, None), (3, "")], "item_id long, text string")


def _labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 1)], "doc_id long, quality int")


OPERATORS = {
    "secrets": lambda spark, d: secrets.secret_scan(d),
    "quality": lambda spark, d: quality.quality_rules(d, quality.train(d, _labels(spark))),
    "quality_kept": lambda spark, d: quality.quality_kept(d, _labels(spark)),
    "contaminated": lambda spark, d: decontamination.contaminated(d, _benchmark(spark)),
    "decontaminated": lambda spark, d: decontamination.decontaminated(d, _benchmark(spark)),
    "line_dedup": lambda spark, d: line_dedup.line_dedup(d),
    "urls": lambda spark, d: url_filters.url_filter(d.withColumnsRenamed({"doc_id": "page_id", "source": "url"}), spark.createDataFrame([("x.com",), (None,)], "key string")),
    "html": lambda spark, d: html_text.html_text(d.withColumnRenamed("doc_id", "page_id").withColumn("html", F.col("text"))),
    "token_counts": lambda spark, d: token_counts.edited_counts(d.drop("edits").withColumn("edits", token_counts.review_edits(F.col("text"))), *_ranks()),
    "bpe": lambda spark, d: bpe.op9_columns(d, _path()),
    "ngram_join": lambda spark, d: ngram_join.ngram_jaccard_join(d),
    "near_duplicates": lambda spark, d: ngram_join.near_duplicates_removed(d),
    "divergence": lambda spark, d: divergence.source_divergence(d),
    "toxicity": lambda spark, d: toxicity.toxicity(d, toxicity.lexicon_of(d, _labels(spark).withColumnRenamed("quality", "toxic"))),
    "periodic_runs": lambda spark, d: periodic_runs.periodic_runs(d),
    "licences": lambda spark, d: license_scan.license_scan(d.withColumn("path", F.col("source"))),
}
#: Operators that return a part of the rows.
PARTIAL = {"divergence", "quality_kept", "contaminated", "decontaminated", "near_duplicates"}


def _docs(spark, rows):
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return plain.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, spark):
    assert OPERATORS[name](spark, _docs(spark, [])).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_nulls_long_texts_and_repeats(name, spark):
    rows = [(1, "a plain text\nof two lines", "en", "s", 3), (1, "a plain text\nof two lines", "en", "s", 3), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "no id here", "en", None, 1), (None, None, None, None, None), (4, LONG, "en", "t", 9), (5, " \n\t\n ", "", "", 0), (6, "\x00 é 😀   x", "en", "http://x.com/de/", 1)]
    got = OPERATORS[name](spark, _docs(spark, rows)).collect()
    assert len(got) <= len(rows) if name in PARTIAL else len(got) == len(rows)


def test_defined_results(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "one two", "en", "s", 7), (3, "one two", "en", "s", 7), (4, "ONE\ttwo", "en", "s", 7), (4, "ONE\ttwo", "en", "s", 7)]
    docs = _docs(spark, rows)
    joined = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_jaccard_join(docs).collect())
    assert joined == [(0, 1, 3), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (4, 1, 3)]
    assert sorted(r["doc_id"] or 0 for r in ngram_join.near_duplicates_removed(docs).collect()) == [0, 1, 2, 3]
    lines = {r["doc_id"]: (r["text"], r["n_lines"]) for r in line_dedup.line_dedup(docs).collect()}
    assert lines[1] == (None, 0) and lines[2] == ("", 1)
    assert {r["doc_id"]: r["n_tokens"] for r in bpe.op9_columns(docs, _path()).collect()}[1] == 0
    assert all(r["base_failed"] and not r["kept"] for r in quality.quality_rules(docs, quality.train(docs, _labels(spark))).collect())
    assert {r["doc_id"]: list(r["findings"]) for r in secrets.secret_scan(docs).collect()}[1] == []


def test_boilerplate_ties_and_blank_lines(spark):
    """A line on exactly the allowed share stays; blank lines stay; a repeated line of one page counts once."""
    rows = [(k, f"head\n\nown {k}\nown {k}\n" + ("edge" if k < 3 else "none" + str(k)), "en", "h", 1) for k in range(100)]
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(_docs(spark, rows), max_percent=3).collect()}
    assert got[0]["text"] == "\nown 0\nown 0\nedge" and got[0]["n_dropped"] == 1
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(_docs(spark, rows), max_percent=2).collect()}
    assert got[0]["text"] == "\nown 0\nown 0"


def test_decontamination_without_items(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    docs = _docs(spark, [(1, "some text", "en", "s", 1)])
    assert decontamination.contaminated(docs, empty).collect() == []
    assert decontamination.decontaminated(docs, empty).count() == 1


def test_decontamination_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 5)
    items = spark.createDataFrame([(k, f"item number {k} with these {k} words in a row {k * k}") for k in range(4)], "item_id long, text string")
    docs = _docs(spark, [(9, "before item number 2 with these 2 words in a row 4 after", "en", "s", 1)])
    assert [(r["item_id"], r["edits"]) for r in decontamination.contaminated(docs, items).collect() if r["edits"] == 0] == [(2, 0)]
    assert decontamination.decontaminated(docs, items).count() == 0


def test_short_items(spark):
    items = spark.createDataFrame([(1, "unicorn"), (2, "blue moon"), (3, "one, two three")], "item_id long, text string")
    docs = _docs(spark, [(1, "a Unicorn!", "en", "s", 1), (2, "the blue\nmoon", "en", "s", 1), (3, "One two. Three", "en", "s", 1), (4, "blue sky moon", "en", "s", 1)])
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, items).collect()} == {(1, 1), (2, 2), (3, 3)}


def test_large_group_makes_bounded_tiles(spark, monkeypatch):
    """A group larger than a block is cut, and no link is lost."""
    monkeypatch.setattr(ngram_join, "ROWS", 16)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join([*base[:59], f"x{k}"]), "en", "s", 1) for k in range(120)]
    got = ngram_join.ngram_jaccard_join(_docs(spark, rows), count_links=True).collect()
    assert {r["component_id"] for r in got} == {0} and all(r["n_links"] == 119 for r in got)
    assert {r["component_id"] for r in ngram_join.ngram_jaccard_join(_docs(spark, rows)).collect()} == {0}


def test_rows_of_one_id_are_one_document(spark):
    one, two = ([f"{c}{k}" for k in range(60)] for c in "ab")
    rows = [(5, " ".join(one), "en", "s", 1), (5, " ".join(two), "en", "s", 1), (6, " ".join([*one, "x"]), "en", "s", 1), (7, " ".join([*two, "y"]), "en", "s", 1), (8, " ".join(two[:30]), "en", "s", 1)]
    got = sorted((r["doc_id"], r["component_id"], r["n_links"]) for r in ngram_join.ngram_jaccard_join(_docs(spark, rows), 3, 90, 100, count_links=True).collect())
    assert got == [(5, 5, 1), (5, 5, 1), (6, 5, 1), (7, 5, 1), (8, 8, 0)]


def test_links_through_rows_without_an_id(spark):
    """A row without an id between two others, one with copies, and two that reach no id."""
    a = [f"w{k}" for k in range(60)]
    text = lambda n: " ".join([*a, *(f"v{k}" for k in range(n))])
    b = " ".join(f"u{k}" for k in range(60))
    rows = [(1, text(0)), (None, text(4)), (None, text(4)), (2, text(8)), (None, "x " + b), (None, "y " + b), (3, "nothing like it " + " ".join(reversed(a)))]
    got = [(r["doc_id"], r["component_id"]) for r in ngram_join.ngram_jaccard_join(_docs(spark, [(i, t, "en", "s", 1) for i, t in rows]), 3, 90, 100).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (None, 1), (None, 1), (2, 1), (None, None), (None, None), (3, 3)], key=str)


def test_many_texts_of_one_id_are_joined_one_by_one(spark):
    rows = [(7, " ".join([f"a{i}x{k}" for k in range(40)]), "en", "s", 1) for i in range(60)] + [(8, " ".join([f"a3x{k}" for k in range(40)]) + " more", "en", "s", 1)]
    docs = _docs(spark, rows)
    assert {r["component_id"] for r in ngram_join.ngram_jaccard_join(docs, 3, 90, 100).collect()} == {7}
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    assert ngram_join.packed_texts(keyed.union(keyed).coalesce(1)).count() == len(rows)


def test_components_of_a_long_path(spark):
    """Ids that rise along a chain, as of revisions of a page, take few rounds."""
    scratch = shared.Scratch(spark, "components-test")
    edges = spark.range(1000).selectExpr("id AS a", "id + 1 AS b").union(spark.sql("SELECT 5000L, 5000L UNION ALL SELECT null, 3L UNION ALL SELECT 7000L, 6000L"))
    got = {}
    for r in components.connected_components(edges, scratch).collect():
        got.setdefault(r["component"], set()).add(r["vertex"])
    assert sorted(got.values(), key=len) == [{5000}, {6000, 7000}, set(range(1001))] and scratch.held <= 1 + 2 * 12
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), scratch).collect() == []
    scratch.drop()


def test_smaller_limit_of_batches_stays(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key)
    for given, want in (("64k", "64k"), ("100m", str(shared.BATCH_BYTES)), ("1000", "1000")):
        spark.conf.set(key, given)
        shared.small_batches(spark)
        assert spark.conf.get(key) == want
    spark.conf.set(key, held)


def test_a_local_folder_is_refused_on_a_cluster():
    from types import SimpleNamespace

    def session(master, **conf):
        held = {k.replace("_", "."): v for k, v in conf.items()}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, *other: held.get(k.replace(".sql.warehouse.", ".warehouse."), *other)), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))

    assert shared.shared_root(session("local[4]", spark_warehouse_dir="file:/w/")) == "file:/w/canopyspark-scratch"
    assert shared.shared_root(session("yarn", spark_warehouse_dir="hdfs://n/w")) == "hdfs://n/w/canopyspark-scratch"
    assert shared.shared_root(session("yarn", spark_warehouse_dir="file:/w", spark_checkpoint_dir="file:/shared")) == "file:/shared"
    for where in ("file:/w", "/w"):
        with pytest.raises(ValueError):
            shared.shared_root(session("spark://host:7077", spark_warehouse_dir=where))
