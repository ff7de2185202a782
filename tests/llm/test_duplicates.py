"""Near duplicates, components and decontamination against brute force."""

import itertools
import random

import numpy as np
import pytest

from linkweave.llm import common
from linkweave.llm import decontaminate as dc
from linkweave.llm import near_dedup as nd
from linkweave.llm.components import connected_components

DOCS = "doc_id long, text string, rep string, kept string"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        for x, y in itertools.product(sets[a], sets[b]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a2, b2 = find(a), find(b)
                parent[max(a2, b2)] = min(a2, b2)
    return {i: find(i) for i in sets}


def near(spark, rows):
    return nd.near_duplicates(spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], DOCS)).collect()


def corpus(seed, groups, size, words, edits):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(500)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocab) for _ in range(words)]
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(words)] = rng.choice(vocab)
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed, 30, 8, 60, 5)
    got = near(spark, rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingles(t)) for i, t in rows}


def test_large_group_goes_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(nd, "SMALL_BUCKET", 8)
    monkeypatch.setattr(nd, "BLOCK", 4)
    rows = corpus(5, 1, 1, 80, 0)
    base = rows[0][1].split()
    rng = random.Random(6)
    for i in range(70):
        own = list(base)
        for k in rng.sample(range(80), rng.randint(1, 5)):
            own[k] = f"x{rng.randrange(30)}"
        rows.append((100 + i, " ".join(own)))
    assert {r["doc_id"]: r["component_id"] for r in near(spark, rows)} == brute(rows)


def test_bits_keep_all_wanted_rows(spark):
    rows = spark.range(-500, 2000).selectExpr("id", "id AS text").unionByName(spark.createDataFrame([(None, None)], "id long, text long"))
    wanted = [*range(-500, 1500, 17), 7, 7]
    got = {r["id"] for r in common.maybe_in(rows, "id", spark.createDataFrame([(i,) for i in wanted], "x long")).collect()}
    assert set(wanted) <= got and len(got) < len(set(wanted)) + 5
    assert common.maybe_in(rows, "id", rows.select("id").where("false")).count() == 0


def test_texts_that_bits_let_through_change_nothing(spark, monkeypatch):
    rows = corpus(3, 12, 6, 60, 4)
    monkeypatch.setattr(common, "FILTER_BITS", 64)
    got = near(spark, rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(rows)


def test_texts_are_not_shuffled(spark, monkeypatch):
    plans, write = [], nd.materialize
    monkeypatch.setattr(nd, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near(spark, corpus(4, 6, 4, 40, 3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert any("shingles" in p for p in plans)
    assert not any("hashpartitioning(doc_id" in p for p in plans)


def test_edges(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(9, "one two"), (4, "ONE\ttwo\n"), (7, "one two three"), (1, None), (2, ""), (3, " \n "), (None, "one two"), (20, long), (21, long + " more"), (30, "É a b c d e"), (31, "é a b c d e"), (40, "same again"), (40, "same again"), (41, "SAME again")]
    got = near(spark, rows)
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert len(got) == len(rows)
    assert by == {9: (1, 4), 4: (1, 4), 7: (1, 7), 1: (0, 1), 2: (0, 2), 3: (0, 3), None: (1, None), 20: (29996, 20), 21: (29997, 20), 30: (2, 30), 31: (2, 31), 40: (1, 40), 41: (1, 40)}
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True]
    assert near(spark, []) == []


def test_threshold_is_exact(spark):
    a = [f"a{i}" for i in range(11)]  # 7 shingles
    rows = [(1, " ".join(a)), (2, " ".join(a[:10])), (3, " ".join([*a, "x", "y"])), (4, " ".join([*a, "x", "y", "z"]))]
    assert {r["doc_id"]: r["component_id"] for r in near(spark, rows)} == brute(rows)


def test_texts_of_one_doc_id_are_bounded_apart(spark):
    sets = spark.createDataFrame([(1, list(range(100, 1100))), (1, list(range(20))), (2, list(range(1, 21))), (3, list(range(50, 70)))], "rep long, shingles array<long>")
    members = spark.createDataFrame([(7, i, 3, i) for i in (1, 2, 3)], "key long, rep long, members long, component long")
    pairs = nd.pairs_of_small(members, sets)
    assert [(r["u"], r["v"]) for r in nd.confirm(pairs, sets).collect()] == [(1, 2)]


def test_pair_places_are_all_pairs_of_groups(monkeypatch):
    monkeypatch.setattr(nd, "PAIRS_AT_ONCE", 20)
    sizes = np.array([3, 0, 1, 5, 2, 4, 4], np.int64)
    got = sorted((int(x), int(y)) for a, b in nd.pair_places(sizes) for x, y in zip(a, b, strict=True))
    ends = np.cumsum(sizes)
    assert got == sorted((x, y) for e, s in zip(ends, sizes, strict=True) for x in range(e - s, e) for y in range(e - s, e))
    assert list(nd.pair_places(np.zeros(0, np.int64))) == []


def test_blocks_of_long_texts_are_counted_in_slices(monkeypatch):
    monkeypatch.setattr(nd, "VALUES_AT_ONCE", 7)
    rng = np.random.default_rng(3)
    base = np.arange(40)
    left, right = ([np.unique(np.r_[base[rng.random(40) < 0.88], rng.integers(100, 130, 2)]) for _ in range(n)] for n in (6, 9))
    got = nd.block_links(np.arange(6), np.arange(6), np.array([*map(len, left)]), np.concatenate(left), np.arange(6, 15), np.arange(6, 15), np.array([*map(len, right)]), np.concatenate(right))
    want = {(i, 6 + j) for i, x in enumerate(left) for j, y in enumerate(right) if 100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y))}
    assert set(got) == want
    assert 0 < len(want) < 54


def test_a_bucket_of_near_misses(spark):
    """Many documents that share keys, but reach the threshold only in pairs."""
    rng = random.Random(4)
    common = [f"c{i}" for i in range(70)]
    rows = []
    for i in range(150):
        own = [f"d{i}_{k}" for k in range(20)]
        rows.append((2 * i, " ".join(common + own)))
        rows.append((2 * i + 1, " ".join([*common, *own[:18], f"e{rng.randrange(9)}", "f"])))
    assert {r["doc_id"]: r["component_id"] for r in near(spark, rows)} == brute(rows)


def test_pigeonhole():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**16, (300, nd.POSITIONS), dtype=np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(nd.POSITIONS, 19, replace=False)] += 1
    x, y = nd.bucket_keys(a), nd.bucket_keys(b)
    assert ((x == y).any(1)).all()
    assert x.shape[1] == 50
    assert len(np.unique(x)) == x.size


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)], [(1, 2), (2, 1), (3, 3), (5, 9), (9, 7), (None, 4)], []])
def test_connected_components(spark, links):
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    parent = {x: x for e in links if None not in e and e[0] != e[1] for x in e}
    for _ in parent:
        for a, b in links:
            if a in parent and b in parent and a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent


ITEM = "the seven grey herons waited under a wooden bridge until rain began to fall on every roof of town"
PAD = " ".join(f"filler{i}" for i in range(40))


def leaks(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
    return {(r["doc_id"], r["item_id"]): (r["doc_word"], r["matched"]) for r in dc.find_leaks(d, b, **options).collect()}


def test_leaks(spark):
    words = ITEM.split()
    swapped = lambda step: " ".join("zzz" if i % step == step - 1 else w for i, w in enumerate(words))
    docs = [(1, f"{PAD} {ITEM} {PAD}"), (2, f"{PAD} {ITEM.upper()}!"), (3, f"{swapped(4)} {PAD}"), (4, f"{PAD} {swapped(5)}"), (5, PAD), (6, " ".join(words[:7])), (7, " ".join(reversed(words))), (8, None), (9, ""), (None, ITEM), (1, "other text"), (10, " ".join(words[4:16]))]
    got = leaks(spark, docs, [(100, ITEM), (101, None), (102, "")])
    assert {k[0] for k in got} == {1, 2, 3, 4, None, 10}
    assert got[(1, 100)] == (40, 19)
    assert got[(3, 100)][1] == 15


def test_short_items_and_blocks(spark):
    items = [(1, "red green blue"), (2, ITEM), (3, ITEM), (4, "solo")]
    docs = [(1, f"{PAD} red green blue {PAD}"), (2, f"a solo b {ITEM}"), (3, "red green")]
    want = {(1, 1), (2, 2), (2, 3), (2, 4)}
    assert set(leaks(spark, docs, items)) == want
    assert set(leaks(spark, docs, items, block_chars=30)) == want
    assert leaks(spark, docs, []) == {}
    assert leaks(spark, [], items) == {}


def best_stretch(equal):
    """(equal words, length) of the stretch with the largest surplus of equal over other words, the first such one."""
    surplus, found, start = 0, (0, 0, 0), 0
    for k, e in enumerate(equal):
        if surplus < 0:
            surplus, start = 0, k
        surplus += 1 if e else -1
        if surplus > found[0]:
            found = (surplus, start, k + 1)
    return sum(equal[found[1] : found[2]]), found[2] - found[1]


def best_leak(doc, item):
    """Most equal words of an accepted stretch on any diagonal."""
    d, t, found = dc.words_of(doc), dc.words_of(item), 0
    for diagonal in range(-len(t), len(d)):
        a, b = max(diagonal, 0), min(diagonal + len(t), len(d))
        if b > a:
            matched, size = best_stretch([d[k] == t[k - diagonal] for k in range(a, b)])
            if matched >= min(10, -(-4 * len(t) // 5)) and matched >= 0.7 * size:
                found = max(found, matched)
    return found


@pytest.mark.parametrize("changed", [3, 10])
def test_leaks_equal_brute_force(spark, changed):
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(12, 30)))) for i in range(20)]
    docs = []
    for i in range(80):
        own = [rng.choice(vocab) for _ in range(rng.randint(5, 60))]
        if i % 2:
            words = items[rng.randrange(20)][1].split()
            for k in range(rng.randint(0, changed)):
                words[rng.randrange(len(words))] = "other"
            own[10:10] = words
        docs.append((i, " ".join(own)))

    want = {(i, j): best_leak(d, t) for i, d in docs for j, t in items if best_leak(d, t)}
    assert {k: v[1] for k, v in leaks(spark, docs, items).items()} == want


def test_masks_seed_every_accepted_stretch():
    """A hit for each pattern of up to 30 % changed inner words with at least ten equal ones, and of short items."""
    patterns = [(n, k) for n in range(11, 22) for k in [min(n - 10, 3 * n // 10)] if k]
    whole = [(n, n - -(-4 * n // 5)) for n in range(5, 13)]
    for (n, k), inner in [*((p, True) for p in patterns), *((p, False) for p in whole)]:
        for gone in itertools.combinations(range(1, n - 1) if inner else range(n), k):
            equal = sum(1 << i for i in range(n)) & ~sum(1 << i for i in gone)
            picked = [sum(1 << (p + s) for p in m) for m in dc.MASKS for s in range(n - m[-1])]
            assert any(equal & m == m for m in picked), (n, gone)


def test_repeated_words_and_batches(monkeypatch):
    rng = random.Random(3)
    items = [(1, "ha " * 40), (2, "na na na batman " * 5), (3, ITEM), (4, "la la la la"), (None, ITEM), (5, "x y")]
    texts = ["ha " * n + "ho " + "ha " * 12 for n in (0, 5, 11, 60)] + [" ".join(rng.choice(["ha", "na", "batman"]) for _ in range(90)) for _ in range(12)]
    # a piece of an item between other texts, whose places the item's diagonal overlaps
    texts += ["na na batman na " * 6, " ".join(ITEM.split()[4:16]), "", None, "la la la la la", "x", "y x y"]
    want = {(i, k): best_leak(t, u) for i, t in enumerate(texts) for k, (_, u) in enumerate(items) if best_leak(t, u)}
    place = {}
    for hits, values in ((10**6, 10**6), (7, 100)):
        monkeypatch.setattr(dc, "HITS_AT_ONCE", hits)
        monkeypatch.setattr(dc, "VALUES_AT_ONCE", values)
        index = dc.SeedIndex(items)
        got = index.find(texts)
        assert {(r[0], index.ids.index(r[1])): r[6] for r in got} == want
        place[hits] = got
        assert [r[1:] for r in got if r[0] == 17] == [r[1:] for r in index.find([texts[17]])]
    assert place[7] == place[10**6]


def test_a_long_text_of_one_word():
    index = dc.SeedIndex([(k, "ha " * 400) for k in range(3)])
    flat = np.r_[0, np.ones(20_000, np.int64), 0]
    assert sum(len(w) for w, _, _ in index.hits(flat)) < 3 * len(dc.MASKS) * 20_400
    assert index.find(["ha " * 20_000]) == [(0, k, 400, 0, 0, 400, 400) for k in range(3)]


def test_decontaminated_rows_stay_whole(spark):
    docs = spark.createDataFrame([(1, ITEM, "x"), (2, PAD, "y"), (2, PAD, "y"), (3, None, "z")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(100, ITEM)], "item_id long, text string")
    several = items.unionAll(spark.createDataFrame([(101, "items that no text holds " * 4)], items.schema))
    for kept in (dc.decontaminate(docs, items), dc.decontaminate(docs, several, block_chars=60)):
        assert kept.columns == docs.columns
        assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("doc_id > 1").collect()))
