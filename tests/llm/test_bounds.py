"""What bounds samples, plans and what reaches the driver, with keys and lists far larger than usual."""

import random

import xxhash
from pyspark.sql import functions as F

from tailframe.llm import ann, common, langid, license_scan, mixing, quality, simhash, url_filter


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sample_is_bounded_with_a_hot_key(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 5).alias("v"))
    keys = set()
    for _ in range(2):
        got = common.bounded_sample(rows.repartition(5), "k", 2_000).collect()
        assert 1_000 < len(got) <= 2_000 and len({r.k for r in got}) == len(got)
        keys.add(tuple(sorted(map(tuple, got))))
    assert len(keys) == 1 and common.bounded_sample(rows, "k", 30_000).count() == 30_000
    alone = common.bounded_sample(rows.select("k"), "k", 100)
    assert alone.columns == ["k"] and alone.count() <= 100


def test_vectors_of_one_repeated_id(spark):
    rng = random.Random(2)
    rows = [(7 if k % 3 == 0 else k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") % 100 == 0, sample_rows=100).collect()
    per = {}
    for r in got:
        per.setdefault(r.query_id, []).append(r["rank"])
    assert set(per) == {k for k in range(600) if k % 100 == 0 and k % 3} and all(v == list(range(1, 21)) for v in (sorted(x) for x in per.values()))


def test_labels_and_documents_of_one_repeated_id(spark):
    docs = spark.createDataFrame([(1 if k % 3 == 0 else k, f"word{k} " * (10 if k % 2 else 80)) for k in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(1 if k % 3 == 0 else k, int(k % 2 == 0)) for k in range(600)], "doc_id long, quality int")
    rules = quality.learn_decision_list(docs, labels, max_labelled=100)
    assert rules == quality.learn_decision_list(docs.repartition(7), labels.repartition(5), max_labelled=100)


def test_two_thousand_templates(spark, sf_dir):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = ["".join(rng.choices(letters, k=7)) for _ in range(5_000)]
    many = tuple(license_scan.Template(f"l{k % 50}", " ".join(rng.sample(vocabulary, 20))) for k in range(2_000))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    planted = spark.createDataFrame([(10**6 + k, f"before {many[k].text} after") for k in range(0, 2_000, 400)], "doc_id long, text string")
    both = docs.unionByName(planted)
    words = license_scan.template_words(both, many)
    found = license_scan.candidates(both, words)
    assert 5 <= found.count() < 100 * 5  # of some hundred documents times two thousand templates
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(both, many, ()).where("labels <> ''").collect()}
    assert got == {10**6 + k: f"l{k % 50}" for k in range(0, 2_000, 400)}
    few = license_scan.candidates(both, license_scan.template_words(both, many[:20]))
    assert len(plan(found)) < 1.2 * len(plan(few))


def test_bitmap_of_many_stretches_reaches_the_driver_in_few_rows(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "STRETCH", 16)
    keys = spark.range(3_000).select(F.concat(F.lit("k"), "id").alias("key"))
    level = url_filter._level(keys, 3_000, 0.01, 0)
    assert keys.where(level.has(F.col("key"), 0)).count() == 3_000
    others = spark.range(3_000).select(F.concat(F.lit("x"), "id").alias("key"))
    assert others.where(level.has(F.col("key"), 0)).count() < 150
    cascade = url_filter.build_cascade(keys.union(others), keys)
    assert keys.union(others).where(cascade.contains(F.col("key"))).count() == 3_000


def test_repeated_rows_and_very_long_urls(spark):
    long = "http://a.ads.com/" + "x" * 200_000 + "?q"
    pages = spark.createDataFrame([(1, long), (1, long), (2, "http://b.com/de/" + "y" * 100_000), (3, None)], "page_id long, url string")
    got = url_filter.judge_urls(pages, [url_filter.UrlRule("block", "com", "/de/")], spark.createDataFrame([("ads.com",)], "key string")).collect()
    assert sorted((r.page_id, len(r.path), r.verdict) for r in got) == [(1, 200_001, "block"), (1, 200_001, "block"), (2, 100_004, "block"), (3, 0, "allow")]


# -- very long texts, and different texts under one id ----------------------------------------------------------


def long_text(n, salt):
    rng = random.Random(salt)
    return " ".join(f"w{rng.randrange(2_000)}" for _ in range(n))


def brute_fingerprint(text):
    w = text.lower().split()
    ones = [0] * 64
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)]
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def test_fingerprints_of_long_texts(spark):
    texts = [long_text(n, n) for n in (32_767, 32_770, 40_000)]
    got = {r.doc_id: r.fp & ((1 << 64) - 1) for r in simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {k: brute_fingerprint(t) for k, t in enumerate(texts)}


def test_one_of_each_with_long_texts_and_texts_that_share_an_id(spark):
    base = long_text(60_000, 1)
    near = base.replace(" w7 ", " changed ")
    rows = [(1, base), (2, near), (2, base), (3, long_text(300, 2)), (3, long_text(300, 3)), (3, long_text(300, 3)), (None, base), (4, None), (5, "")]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id != 4) == sorted([(1, base), (3, long_text(300, 2)), (3, long_text(300, 3))]) and [r.text for r in got if r.doc_id == 4] == [None]


def test_long_texts_are_mixed_and_identified_whole(spark):
    rows = [(k, t, "xx" if k % 2 else "en", "src0") for k, t in enumerate(["the cat and the dog " * 20, "zxq vwk qqz xkw " * 20] * 6)]
    long = [(100, "zxq vwk qqz xkw " * 100 + "the cat and the dog " * 30_000, "en", "src0")]
    docs = spark.createDataFrame(rows + long, "doc_id long, text string, lang string, source string")
    model = langid.train(docs.where("doc_id < 100"))
    assert {r.doc_id: r.lang_pred for r in langid.identify(docs.select("doc_id", "text"), model, keep_text=False).collect()}[100] == "en"  # its beginning alone would say otherwise
    n = mixing.token_count(F.col("text"))
    assert {r.doc_id: r.n for r in docs.select("doc_id", n.alias("n")).collect()}[100] == 150_400
    mixed = mixing.select_mixture(docs, {"lang": F.col("lang")}, {"lang": {"en": 1}}, budget_percent=100, max_epochs=1)
    assert sorted(r.doc_id for r in mixed.collect()) == [*range(12), 100]
