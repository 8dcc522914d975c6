"""Links by shingle similarity against all pairs."""

import itertools
import random

import corpus_pipeline as pipeline
from tailframe.llm import simhash


def brute_kept(rows, width=5, percent=80):
    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()

    sets = {i: shingles(t) for i, t in rows}
    name = {i: i for i in sets}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        both, all_ = len(sets[i] & sets[j]), len(sets[i] | sets[j])
        if 100 * both >= percent * all_:
            a, b = sorted((root(i), root(j)))
            name[b] = a
    return sorted({root(i) for i in sets})


def near_copies():
    """A large group with changed words, some close to few others only, pairs, a passage in all of a third, short texts."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(3000)]
    base, passage = rng.choices(words, k=150), rng.choices(words, k=30)
    texts = []
    for k in range(150):
        t = list(base)
        for at in rng.sample(range(150), rng.choice([0, 1, 2, 4, 8])):
            t[at] = rng.choice(words)
        texts.append(t)
    for k in range(60):
        t = rng.choices(words, k=rng.randint(40, 300)) + passage
        texts.append(t)
        near = list(t)
        near[rng.randrange(len(near))] = "changed"
        texts.append(near)
    texts += [[], ["a"], ["a"], ["a", "b"], list("abcde"), list("abcdef"), list("abcdefg"), base[:5]]
    rng.shuffle(texts)
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


def test_stage_drops_near_copies_of_four_fifths(spark, sf_dir):
    rows = near_copies()
    got = pipeline.keep_one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir)
    assert sorted(r.doc_id for r in got.collect()) == brute_kept(rows)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute_kept([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in simhash.one_of_each(docs, percent=80).select("doc_id").collect()) == want


def test_rows_without_ids(spark):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(None, text), (None, text + " more"), (None, "another text without an id"), (None, None), (7, "x"), (7, "x")]
    left = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), percent=80)
    assert sorted((r.doc_id or 0, (r.text or "")[:3]) for r in left.collect()) == [(0, ""), (0, "ano"), (0, "w0 "), (7, "x")]


def test_texts_under_one_id_stay_and_rows_that_repeat_leave_once(spark):
    rows = [(7, "one text of its own", "a"), (7, "quite another text", "b"), (7, "quite another text", "b"), (9, "quite another text", "c")]
    left = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, hash string"))
    assert sorted(tuple(r) for r in left.collect()) == [(7, "one text of its own", "a"), (7, "quite another text", "b")]


def test_copies_that_only_their_origin_links(spark):
    """Each copy is four fifths like the origin, and less like any other copy."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(400)]
    rows = [(0, " ".join(base))]
    for k in range(1, 120):
        t = list(base)
        for at in rng.sample(range(0, 400, 10), 8):
            t[at] = f"new{k}x{at}"
        rows.append((k, " ".join(t)))
    assert brute_kept(rows) == [0]
    assert [r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [0]
    assert sorted(r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows[1:], "doc_id long, text string")).collect()) == brute_kept(rows[1:])


def test_fingerprints_link_a_group_before_its_keys_meet(spark):
    """A pair a set at most comes from fingerprints, whatever the group's size, and equal sets make none."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(400)]
    rows = [(k, " ".join([*base[:at], f"new{k}", *base[at:]])) for k, at in enumerate(rng.choices(range(400), k=120))]
    made = simhash.with_prefixes(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    pairs = simhash.link_by_fingerprint(made).select("x.fp", "y.fp").collect()
    assert 60 < len(pairs) < 120 and all(a != b for a, b in pairs) and len({a for a, _ in pairs}) == len(pairs)


def test_links_of_a_large_group_of_fingerprints_grow_with_its_members(spark):
    """Fingerprints with up to three changed bits of 20, in large keys and small ones: few edges a member, and the components of all pairs."""
    rng = random.Random(6)
    fps = {0x5A5A << 40}
    while len(fps) < 700:
        fps.add((0x5A5A << 40) ^ sum(1 << k for k in rng.sample(range(6, 26), rng.randint(1, 3))))
    fps = sorted(fps | {rng.getrandbits(63) - 2**62 for _ in range(50)})
    name = {x: x for x in fps}
    for x, y in itertools.combinations(fps, 2):
        if ((x ^ y) & (2**64 - 1)).bit_count() <= 2 and name[x] != name[y]:
            name = {k: name[x] if v == name[y] else v for k, v in name.items()}
    for bucket in (4, simhash.BUCKET, 1000):
        edges = simhash.link_fingerprints(spark.createDataFrame([(x,) for x in fps], "fp long"), bucket)
        found = {r.node: r.label for r in simhash.components(edges).collect()}
        assert {x: found.get(x, x) for x in fps} == name
        assert edges.count() <= 6 * len(fps)


def test_components_of_paths_stars_and_random_graphs(spark):
    rng = random.Random(7)
    ids = rng.sample(range(10**6), 700)
    edges = [*zip(ids[:300], ids[1:301]), *((ids[310], x) for x in ids[311:400]), *(tuple(rng.sample(ids[400:], 2)) for _ in range(200)), (ids[0], ids[0])]
    name = {x: x for x in ids}
    for x, y in edges:
        low, high = sorted((name[x], name[y]))
        name = {k: low if v == high else v for k, v in name.items()}
    found = {r.node: r.label for r in simhash.components(spark.createDataFrame(edges, "src long, dst long"), 20).collect()}
    assert {x: found.get(x, x) for x in ids} == name and set(found) == {x for e in edges for x in e}
    assert not simhash.components(spark.createDataFrame([], "src long, dst long")).collect()
