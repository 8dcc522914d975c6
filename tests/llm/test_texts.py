import hashlib
import math
import random
import re
import textwrap
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tailframe.llm import langid, license_scan, mixing, quality, queries, simhash

ODD = ["", None, " \n\t", "a", "one two", "a b c " * 30_000, "x\n\nx\nx\x0b", "é É\u00a0word", "#$ & | <b>"]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    own = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**9 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    return own.union(odd).union(odd.limit(2)).cache()


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# -- quality -------------------------------------------------------------------------------------------------------


def stats(text):
    w = space_words(text)
    grams = list(zip(w, w[1:], w[2:]))
    n = Counter(grams)
    lines = [x for x in (text or "").split("\n") if space_words(x)]
    again = {k + d for k, g in enumerate(grams) if n[g] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def test_quality_statistics(docs):
    for r in quality.with_quality_stats(docs.withColumn("n_words", F.lit("clash"))).collect():
        assert tuple(r[c] for c in quality.STATS) == stats(r.text), (r.text or "")[:80]


def test_quality_verdicts(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality.learn_decision_list(docs, labels)
    judged = quality.judge_quality(docs, rules).collect()
    for r in judged:
        n, _, _, _, again = stats(r.text)
        assert r.base_failed == (n < 50 or 100 * again > 50 * n) and not (r.base_failed and r.kept)
    kept = docs.where(quality.keeps(F.col("text"), rules)).count()
    assert kept == sum(r.kept for r in judged)
    quality_of = {r.doc_id: r.quality for r in labels.collect()}
    good = [r.kept for r in judged if quality_of.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in judged if quality_of.get(r.doc_id) == 0 and not r.base_failed]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_decision_list_finds_a_conjunction():
    rng = np.random.default_rng(0)
    x = {"a": rng.uniform(size=3000), "b": rng.uniform(size=3000), "c": rng.uniform(size=3000)}
    bad = ((x["a"] > 0.7) & (x["b"] < 0.4)) | (x["c"] > 0.9)
    rules = quality.learn_rules(x, bad)
    hit = np.zeros(3000, bool)
    for r in rules:
        hit |= quality._covers(r, x, 3000)
    assert (hit == bad).mean() > 0.99 and len(rules) <= 6
    assert quality.learn_rules(x, np.zeros(3000, bool)) == [] and quality.learn_rules({"a": []}, []) == []
    assert quality.learn_rules({"a": np.ones(30)}, np.arange(30) % 2 == 0) == []


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.learn_decision_list(docs, none) == [] and quality.learn_decision_list(docs.limit(0), none) == []
    odd = spark.createDataFrame([(0, None), (None, 0), (1, 7)], "doc_id long, quality int")
    assert quality.learn_decision_list(docs, odd) == []


# -- SimHash -------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """{doc_id: smallest id reachable} of (doc_id, fingerprint)."""
    fps = sorted({fp for _, fp in rows})
    parent = {fp: fp for fp in fps}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, fp in rows:
        if i is not None:
            least[root(fp)] = min(i, least.get(root(fp), i))
    return [least.get(root(fp)) for _, fp in rows]


def test_fingerprints_and_components(spark, docs):
    texts = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 5000]
    got = simhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    want = sorted((i, brute_fingerprint(t)) for i, t in texts)
    rows = sorted((r.doc_id, r.fp % 2**64) for r in got)
    assert rows == want
    names = dict(zip([i for i, _ in want], brute_components(want)))
    assert all(r.component_id == names[r.doc_id] for r in got)


@pytest.mark.parametrize("bucket", [1, 32, 10**6])
def test_links_do_not_depend_on_the_bucket_bound(spark, bucket):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 12)
    fps = {int(c) for c in centres}
    for c in centres[:6]:
        at = int(c)
        for _ in range(60):  # chains and balls around some of them
            at ^= 1 << int(rng.integers(0, 64)) ^ (1 << int(rng.integers(0, 64)) if rng.random() < 0.5 else 0)
            fps.add(at)
            fps.add(int(c) ^ 1 << int(rng.integers(0, 64)))
    rows = [(k, fp) for k, fp in enumerate(sorted(fps))]
    signed = [(fp - 2**64 if fp >= 2**63 else fp,) for _, fp in rows]
    labels = {r.node % 2**64: r.label % 2**64 for r in simhash.components(simhash.link_fingerprints(spark.createDataFrame(signed, "fp long"), bucket)).collect()}
    group = {}
    for (_, fp), name in zip(rows, brute_components(rows)):
        group.setdefault(name, set()).add(labels.get(fp, fp))
    assert all(len(g) == 1 for g in group.values()) and len({next(iter(g)) for g in group.values()}) == len(group)


def test_long_chains_settle(spark):
    assert {r.label for r in simhash.components(spark.range(1, 400).selectExpr("id as src", "id - 1 as dst")).collect()} == {0}


def test_one_of_each(spark):
    text = "one two three four five six seven eight nine ten " * 3
    rows = [(5, text, "x"), (3, text, "x"), (3, text, "x"), (9, "quite another text with words of its own in it", "x"), (None, text, "x"), (None, "a third text that only rows without an id hold", "x"), (None, "a third text that only rows without an id hold", "x")]
    left = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, fp string"))
    assert left.columns == ["doc_id", "text", "fp"]
    assert sorted((r.doc_id or 0, r.fp) for r in left.collect()) == [(0, "x"), (3, "x"), (9, "x")]
    assert simhash.one_of_each(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# -- licenses ------------------------------------------------------------------------------------------------------


def brute_scan(text, threshold=0.9):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    w = find(lower)
    places = [(k, label) for p, label in license_scan.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    base = {label for _, label in places}
    found, best = set(), 0.0
    for t in license_scan.TEMPLATES:
        own, span = set(t.words()), t.span()
        for k in range(len(w) if len(own & set(w)) >= math.ceil(round(threshold * len(own), 9)) else 0):
            overlap = len(own & set(w[k : k + span]))
            if w[k] in own and overlap >= math.ceil(round(threshold * len(own), 9)):
                found.add(t.label)
                best = max(best, overlap / len(own))
    at = [k for k, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if base else best


def test_license_scan(spark, docs):
    texts = [(r.doc_id, r.text) for r in docs.where("length(text) < 20000 or text is null").collect()]
    extra = ["UNDER the-MIT\nlicense! under the mit license", "Apache License, Version 2.0 cc by-nc cc by nc", "İ under the mıt license K", "this work licensed under the gnu general public license version 3 extra words is", "permission granted free of charge to any person obtaining a copy of this software and associated documentation files"]
    texts += [(2 * 10**9 + k, t) for k, t in enumerate(extra)] * 2
    texts += [(None, extra[0]), (7 * 10**9, extra[0]), (7 * 10**9, extra[3])]
    whole = {t.label: t.text for t in license_scan.TEMPLATES}
    texts += [(3 * 10**9 + k, "# " + "\n# ".join(textwrap.wrap(" ".join(t.split()), 40))) for k, t in enumerate(whole.values())]
    scattered = " ".join(f"x{k}" for k in range(300)).split()
    for k, x in enumerate("released mit under of a license".split()):
        scattered.insert(50 * k, x)
    texts += [(4 * 10**9, " ".join(scattered)), (4 * 10**9 + 1, " ".join(["the software of this license is"] * 900 + [whole["isc"]]))]
    got = license_scan.scan_licenses(spark.createDataFrame([(*t, "clash") for t in texts], "doc_id long, text string, labels string")).collect()
    rows = sorted((str(r[0]), *map(str, r[1:])) for r in got)
    want = sorted((str(i), *map(str, brute_scan(t))) for i, t in texts)
    assert rows == want
    labels = {r.doc_id: r.labels for r in got}
    assert all(label in labels[3 * 10**9 + k].split(",") for k, label in enumerate(whole)) and labels[4 * 10**9] == "" and labels[4 * 10**9 + 1] == "isc"
    assert license_scan.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# -- language ------------------------------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark, sf_dir):
    found = queries.op10_language_id(spark, sf_dir.replace("sf0.001", "sf0.01"))
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 200 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "la casa", None), (5, "", "en")]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(train)
    assert model.langs == ("de", "en")
    asked = spark.createDataFrame([(1, "the dog", 9), (2, "und der Hund", 9), (3, None, 9), (4, "123 !?", 9), (5, "", 9), (1, "the dog", 9)], "doc_id long, text string, score int")
    got = sorted((r.doc_id, r.lang_pred) for r in langid.identify(asked, model).collect())
    assert got == [(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und")]
    one = langid.train(train.where("lang = 'en'"))
    assert {r.lang_pred for r in langid.identify(asked.where("doc_id < 3"), one).collect()} == {"en"}
    none = langid.train(train.limit(0))
    assert {r.lang_pred for r in langid.identify(asked, none).collect()} == {"und"}
    with pytest.raises(ValueError, match="languages"):
        langid.train(train, max_langs=1)


def brute_grams(text):
    """Counts of hashed grams, one gram at a time."""
    data = re.sub(r"[\W\d_]+", " ", f" {text.lower()} ").encode()
    found = Counter()
    for n in range(1, 5):
        for k in range(len(data) - n + 1):
            code = int.from_bytes(data[k : k + n], "big")
            found[((code ^ (n * 0x51ED2705 & 0xFFFFFFFF)) * 0x9E3779B1 & 0xFFFFFFFF) >> 17] += 1
    return found


def brute_language(train, texts, margin=0.2):
    """Weights and decoding in plain Python, from the definition."""
    counts = {}
    for text, lang in train:
        if any(c.isalpha() for c in text):
            counts.setdefault(lang, Counter()).update(brute_grams(text))
    langs = sorted(counts)
    codes, folds = langid.codewords(len(langs))
    share = {x: {p: (counts[x][p] + 0.05) / (sum(counts[x].values()) + 0.05 * langid.DIM) for p in range(langid.DIM)} for x in langs}

    def weight(bit, p):
        sides = [[share[x][p] for k, x in enumerate(langs) if codes[k, bit] == side] for side in (1, -1)]
        return math.log(sum(sides[0]) / len(sides[0])) - math.log(sum(sides[1]) / len(sides[1])) if p % folds[bit][1] == folds[bit][0] else 0.0

    found = []
    for text in texts:
        grams = brute_grams(text)
        lean = [sum(n * weight(b, p) for p, n in grams.items()) / math.sqrt(sum(grams.values())) for b in range(codes.shape[1])]
        sure = [abs(x) / sum(map(abs, lean)) for x in lean]
        loss = [sum(math.log1p(math.exp(-codes[k, b] * lean[b])) * sure[b] for b in range(len(lean))) for k in range(len(langs))]
        odds = [math.exp(min(loss) - x) for x in loss]
        odds = [x / sum(odds) for x in odds]
        order = sorted(range(len(langs)), key=lambda k: -odds[k])
        found.append((langs[order[0]], odds[order[0]], odds[order[0]] - odds[order[1]] < margin))
    return found


@pytest.mark.parametrize("n_langs", [2, 3, 4])
def test_language_is_that_of_a_brute_force_version(spark, n_langs):
    words = {"en": "the and of with that", "de": "der und von mit dass", "fr": "le et de avec que", "sv": "och att det som för"}
    rng = random.Random(n_langs)
    own = [(" ".join(rng.choices(words[x].split(), k=12)), x) for x in list(words)[:n_langs] for _ in range(4)]
    asked = [" ".join(rng.choices(" ".join(words.values()).split(), k=rng.randint(1, 9))) for _ in range(12)] + ["Ünd 1 the-AND"]
    model = langid.train(spark.createDataFrame(own, "text string, lang string"))
    got = langid.identify(spark.createDataFrame(list(enumerate(asked)), "k int, text string"), model).orderBy("k").collect()
    for r, (lang, score, ambiguous) in zip(got, brute_language(own, asked)):
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-4) and r.ambiguous == ambiguous


@pytest.mark.parametrize("n", range(2, 12))
def test_codewords_are_three_bits_apart(n):
    codes, folds = langid.codewords(n)
    assert min((a != b).sum() for k, a in enumerate(codes) for b in codes[:k]) >= 3 and len(folds) == codes.shape[1]


def test_gram_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Wörter, words & more; " * 50
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "_CHUNK", 97)
    assert (langid.gram_counts(text) == whole).all()


@pytest.mark.parametrize("n", [2, 4, 7, 12, 60])
def test_codewords_are_apart(n):
    codes, _ = langid.codewords(n)
    distance = [(codes[i] != codes[j]).sum() for i in range(n) for j in range(i)]
    assert min(distance) >= (1 if n == 2 else 3)


# -- mixing --------------------------------------------------------------------------------------------------------


def brute_fill(budget, nodes):
    """{name: share} of {name: (capacity, weight)}: fill by weight until none overflows."""
    share, open_, left = {}, dict(nodes), budget
    while open_:
        total = sum(w for _, w in open_.values())
        full = {n: c for n, (c, w) in open_.items() if c * total <= left * w}
        if not full:
            return share | {n: left * w // total for n, (_, w) in open_.items()}
        share |= full
        left -= sum(full.values())
        open_ = {n: v for n, v in open_.items() if n not in full}
    return share


def brute_mixture(rows, levels, weights, budget_percent, max_epochs, seed):
    """Ids taken, once for each epoch, of rows (id, path, tokens): budgets level by level, then one row at a time."""
    taken = []

    def share(budget, rows, depth):
        if depth == len(levels):
            total = sum(n for *_, n in rows)
            full, rest = divmod(budget, max(total, 1))
            taken.extend(i for i, *_ in rows for _ in range(full))
            so_far = 0
            for i, _, n in sorted(rows, key=lambda r: (hashlib.md5(f"{seed}|{full}|{r[0]}".encode()).hexdigest(), r[0])):
                if so_far < rest:
                    taken.append(i)
                so_far += n
            return
        groups = {}
        for r in rows:
            groups.setdefault(r[1][depth], []).append(r)
        own = weights.get(levels[depth], {})
        shares = brute_fill(budget, {g: (max_epochs * sum(n for *_, n in rs), own.get(g, 1)) for g, rs in groups.items()})
        for g, rs in groups.items():
            share(shares[g], rs, depth + 1)

    share(sum(n for *_, n in rows) * budget_percent // 100, rows, 0)
    return taken


def test_mixture_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, (f"d{int(r.source[3:]) % 4}", r.lang, r.source), len(space_words(r.text))) for r in docs.collect()]
    assert sorted(r.doc_id for r in queries.op6_mixing(spark, sf_dir).collect()) == sorted(brute_mixture(rows, ["domain", "lang", "source"], queries.MIX_WEIGHTS, 80, 2, 42))


def test_water_filling(spark):
    rng = np.random.default_rng(5)
    for _ in range(6):
        nodes = {f"n{k}": (int(rng.integers(0, 1000)), int(rng.integers(1, 9))) for k in range(rng.integers(1, 9))}
        budget = int(rng.integers(0, 3000))
        rows = spark.createDataFrame([("p", n, c, w, budget) for n, (c, w) in nodes.items()], "p string, n string, capacity long, weight long, budget long")
        got = {r.n: r.share for r in mixing.fill(rows, ["p"], "n").collect()}
        assert got == brute_fill(min(budget, 10**9), nodes)


def test_shortages_go_to_siblings_first(spark):
    rows = [("a", "x", 10)] + [("a", "y", 1000)] + [("b", "x", 1000)]
    light = spark.createDataFrame(rows, "domain string, lang string, n_tokens long")
    got = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(light, ["domain", "lang"], {}, 50, 1).collect()}
    # 1005 tokens: 502 to each domain; language x of domain a is short, and its sibling takes the rest.
    assert got == {("a", "x"): 10, ("a", "y"): 492, ("b", "x"): 502}


def test_mixture_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b", None, "e"), (2, None, "en", "e"), (None, "c d e", "en", "e"), (3, "x", "en", "e"), (3, "x", "en", "e")], "doc_id long, text string, lang string, epoch string")
    got = mixing.select_mixture(docs, {"lang": F.col("lang")}, {}, budget_percent=200, max_epochs=2)
    assert got.columns == ["doc_id", "text", "lang", "epoch"]
    assert sorted((r.doc_id or 0, r.lang, r.epoch) for r in got.collect()) == sorted((i, lang, e) for e in (0, 1) for i, lang in ((1, "unknown"), (2, "en"), (0, "en"), (3, "en"), (3, "en")))
    assert mixing.select_mixture(docs.limit(0), {"lang": F.col("lang")}, {}).count() == 0
    with pytest.raises(ValueError, match="positive"):
        mixing.select_mixture(docs, {"lang": F.col("lang")}, {"lang": {"en": 0}})


def test_budget_is_met_within_a_document(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source", "id % 11 as n")
    got = mixing.select_mixture(docs, {"source": F.col("source")}, {"source": {"hot": 3}}, budget_percent=40, max_epochs=1, n_tokens=F.col("n"))
    total, taken = docs.agg(F.sum("n")).head()[0], got.agg(F.sum("n")).head()[0]
    assert abs(taken - 0.4 * total) <= 11 * 8 and got.select("doc_id").distinct().count() == got.count()
