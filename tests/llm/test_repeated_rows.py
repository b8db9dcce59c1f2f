"""Rows that repeat, ids that repeat, ids of other types, ties and bounds."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import common, decontaminate, encoding, exact_dedup, jaccard_join, packing, quality, token_counts, toxicity, url_filter

WORDS = [f"word{i}" for i in range(400)]
NEAR = " ".join(WORDS[:100])
NEAR_TOO = " ".join(WORDS[:99] + ["other"])
FAR = " ".join(WORDS[200:300])


def test_linked_documents_listed_many_times(spark, docs_of, monkeypatch):
    """Two linked documents, 1,000 rows each: one set per class, one link."""
    sizes = {}
    kept = jaccard_join.written

    def written(df, name):
        out = kept(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "written", written)
    rows = [(1, NEAR)] * 1000 + [(2, NEAR_TOO)] * 1000 + [(3, FAR)] * 5
    got = jaccard_join.join_components(docs_of(rows).repartition(6)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1)] * 1000 + [(2, 1)] * 1000 + [(3, 3)] * 5
    assert sizes["jaccard-sets"] == 2 and sizes["jaccard-links"] == 1


def test_one_id_with_two_texts(spark, docs_of):
    rows = [(1, NEAR), (2, NEAR_TOO), (2, FAR), (3, NEAR), (4, None), (4, ""), (None, NEAR)]
    stay = jaccard_join.representatives(docs_of(rows), shingle=5, percent=80).collect()
    assert sorted(((r.doc_id, r.text) for r in stay), key=str) == sorted([(1, NEAR), (2, FAR), (4, None), (4, ""), (None, NEAR)], key=str)
    twice = jaccard_join.representatives(docs_of([(7, NEAR), (7, NEAR_TOO), (7, NEAR)]), shingle=5, percent=80).collect()
    assert len({r.text for r in twice}) == 1  # near copies under one id: one text stays


def test_string_ids(spark):
    df = spark.createDataFrame([("b", NEAR), ("a", NEAR_TOO), ("c", NEAR), (None, NEAR)], "doc_id string, text string")
    assert {(r.doc_id, r.component_id) for r in jaccard_join.join_components(df).collect()} == {("b", "a"), ("a", "a"), ("c", "a"), (None, None)}
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.decisions(df).collect()} == {("b", "c", False), ("c", "c", True), ("a", "a", True), (None, "c", False)}
    assert {r.doc_id for r in packing.pack(df, encoding.public("byte_bpe_50k.json")).collect()} == {"a", "b", "c", None}


def test_two_runs_on_one_empty_cache(spark, docs_of, tmp_path):
    """Both runs look the cache up before either appends."""
    docs, vocabulary = docs_of([(1, "some text here"), (2, "some text here"), (3, None)]), encoding.public("byte_bpe_50k.json")
    cache = f"file://{tmp_path}/cache"
    first = token_counts.count_tokens(docs, vocabulary, cache=cache)
    spark.read.parquet(f"{cache}/version={vocabulary.version}").coalesce(1).write.mode("append").parquet(f"{cache}/version={vocabulary.version}-again")
    spark.read.parquet(f"{cache}/version={vocabulary.version}-again").write.mode("append").parquet(f"{cache}/version={vocabulary.version}")
    assert first.count() == 3
    assert sorted((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs, vocabulary, cache=cache).collect()) == sorted((r.doc_id, r.n_tokens) for r in first.collect())


def test_sample_never_exceeds_its_bound(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("k"), F.col("id").cast("string").alias("text"))
    for total in (5000, 10**11):
        got = common.sampled(df, "k", total, 100).collect()
        assert len(got) <= 100 and len({r.k for r in got}) == len(got)
    assert len(common.sampled(df, "k", 5000, 100).collect()) == 100
    assert len(common.sampled(df, "k", 20_000, 100_000).collect()) == 5000


def test_classifiers_take_a_repeated_id_once(spark, docs_of):
    rows = [(i, f"plain words number {i} about nothing much at all") for i in range(60)] + [(60, "nasty awful words")] * 300
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, int(i != 60), int(i == 60)) for i in range(61)], "doc_id long, quality int, toxic int")
    seen = []
    fit = toxicity.fit_chain
    try:
        toxicity.fit_chain = lambda rows, *a, **k: seen.append(len(rows)) or fit(rows, *a, **k)
        toxicity.train(docs, labels, {"toxic": F.col("toxic") == 1})
    finally:
        toxicity.fit_chain = fit
    assert seen == [61]
    quality.train(docs, sample=20)


def test_labellers_that_do_not_settle_are_reported():
    rng = np.random.default_rng(0)
    pattern = rng.integers(0, 3, (50, 7))
    with pytest.warns(RuntimeWarning):
        quality.expectation_maximisation(pattern, np.ones(50), rounds=1)


def test_hot_text_late_in_its_split(spark, docs_of):
    """A text that first comes when the map-side table is full is folded all the same."""
    rows = [(i, f"{i} " * 300) for i in range(200)] + [(1000 + i, "hot " * 200) for i in range(3000)]
    df = docs_of(rows).coalesce(1).sortWithinPartitions("doc_id")
    row = F.struct(F.lit(1).alias("none"))
    src = df.select(F.col("doc_id").alias("id"), "text", row.alias("row"))
    import pyarrow as pa
    one = pa.struct([pa.field("none", pa.int32())])
    kind = "deal long, settled boolean, digest binary, text string, id long, rows long, row struct<none:int>"
    out = src.mapInArrow(exact_dedup._fold(0, 40_000, False, one, pa.int64()), kind)
    assert out.where("text like 'hot%'").count() < 10
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.decisions(df, table_bytes=160_000).collect()}
    assert got[1500] == (3999, 3000) and got[7] == (7, 1)


def test_repeated_benchmark_rows(spark, docs_of):
    items = [(1, " ".join(f"b{i}" for i in range(30)))] * 400 + [(2, "x" * 50_000 + " tail"), (3, "short item")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of([(1, "before " + items[0][1] + " after"), (2, "has a short item inside"), (3, "clean"), (4, None)])
    blocks = decontaminate._blocks(bench, "item_id", "text", 10, 100)
    sizes = [b.agg(F.sum(F.size("words"))).first()[0] or 0 for b in blocks]
    assert sum(sizes) == 30 + 2 + 2 and max(sizes) <= 130
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.report(docs, bench, block_words=100).collect()}
    assert got == {1: (30, ["1"]), 2: (2, ["3"]), 3: (0, []), 4: (0, [])}


def test_rules_that_tie(spark):
    pages = spark.createDataFrame([(1, "http://a.b.org/xx")], "page_id long, url string")
    for rules in ([("allow", "b.org/xx"), ("block", "org/xx"), ("block", "b.org/xx")], [("block", "b.org/xx"), ("allow", "b.org/xx")]):
        best = max(rules, key=lambda r: len(r[1]))  # the first of the longest
        assert [r.verdict for r in url_filter.judge(pages, rules).collect()] == [best[0]]


def test_url_statistics_of_every_key(spark):
    """A long tail of suffixes: each keeps its own counts, frequent or not."""
    rows = [(i, f"http://h{i}.{'com' if i % 3 else f's{i % 700}'}/p", float(i % 2) if i % 5 else None) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, url string, label double").withColumn("suffix", F.substring_index(F.regexp_extract("url", r"//([^/]*)", 1), ".", -1))
    got = url_filter._with_statistics(df, "suffix", 6000).collect()
    by = {}
    for i, u, y in rows:
        n = by.setdefault(u.split("/")[2].split(".")[-1], [0, 0, 0.0])
        n[0] += 1
        n[1] += y is not None
        n[2] += y or 0
    prior = (sum(n[2] for n in by.values()) + 1) / (sum(n[1] for n in by.values()) + 2)
    assert len(got) == 6000
    for r in got:
        n = by[r.suffix]
        assert r.suffix_share == pytest.approx(n[0] / 6000) and r.suffix_blocked == pytest.approx((n[2] + 10 * prior) / (n[1] + 10))
