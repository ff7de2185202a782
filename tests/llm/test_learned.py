"""Quality rules and language-model scores."""

import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from linkweave.llm import attention, lm, quality
from linkweave.llm.queries import piece_model

DOCS = "doc_id long, text string, score string, quality string"
PROSE = ["the quiet river ran over stones and the old mill stood there", "a letter came in the morning with news of the harbour", "children walked along the road to see the ships come in"]


def prose(i):
    rng = np.random.default_rng(i)
    return ". ".join(PROSE[k] + f" {rng.integers(100)}" for k in rng.integers(0, 3, 6))


def junk(i):
    rng = np.random.default_rng(i)
    kind = i % 3
    if kind == 0:
        return " | ".join(rng.choice(["BUY", "NOW", "###", "$$$"], 40))
    if kind == 1:
        return "click " * int(rng.integers(20, 60))
    return "".join(rng.choice(list("!!##%%ABC "), 200))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, junk(i) if i % 4 == 0 else prose(i), "clash", "clash") for i in range(600)]
    docs = spark.createDataFrame([*rows, (601, None, None, None), (602, "", None, None), (None, prose(1), None, None), (1, prose(1), None, None)], DOCS).persist()
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1, 0) for i in range(600)] + [(1, None, 0), (None, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").persist()
    return docs, labels


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 600]
    assert {r["doc_id"] for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([(r["predicted"] == 1) == (r["doc_id"] % 4 != 0) for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    empty = [r["score"] for r in rows if r["doc_id"] in (601, 602)]
    assert empty[0] == empty[1]
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]


def test_columns_equal_the_model(labelled):
    docs, labels = labelled
    model = quality.learn_quality(docs, labels)
    assert model.rules
    rows = quality.with_statistics(docs).withColumn("got", model.score()).collect()
    x = np.array([[r[f"s_{n}"] for n in quality.NAMES] for r in rows])
    assert np.allclose(model.predict(x), [r["got"] for r in rows])


def test_labels_of_held_out_rows_do_not_matter(labelled):
    from pyspark.sql import functions as F

    docs, labels = labelled
    flipped = labels.withColumn("quality", F.when(quality.crc_mod(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.learn_quality(docs, labels) == quality.learn_quality(docs, flipped)


def test_filter_keeps_what_is_predicted(labelled):
    docs, labels = labelled
    kept = quality.keep_quality(docs, labels)
    assert kept.columns == docs.columns
    want = quality.score_quality(docs, labels).where("predicted = 1").select("doc_id", "text")
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, want.collect()))


def test_without_labels_or_rows(labelled):
    docs, labels = labelled
    assert {r["score"] for r in quality.score_quality(docs.limit(20), labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), labels).collect() == []


def test_gradient():
    rng = np.random.default_rng(0)
    p = {n: x.astype(np.float64) for n, x in attention.initial(20, np.full(5, 0.2)).items()}
    ids, real = rng.integers(0, 20, (3, attention.WINDOW)), rng.random((3, attention.WINDOW)) < 0.9
    real[:, attention.CONTEXT] = True
    goal = rng.integers(-1, 5, (3, attention.SCORED))
    _, d, at = attention.gradient(p, ids, real, goal)
    whole = {n: g for n, g in d.items() if n != "table"} | {"table": np.zeros_like(p["table"])}
    whole["table"][at] = d["table"]
    for n, x in p.items():
        for k in rng.choice(x.size, min(x.size, 30), replace=False):
            told = []
            for move in (1e-4, -1e-4):
                q = {m: y.copy() for m, y in p.items()}
                q[n].ravel()[k] += move
                told.append(attention.gradient(q, ids, real, goal)[0])
            assert whole[n].ravel()[k] == pytest.approx((told[0] - told[1]) / 2e-4, abs=2e-4)


def test_large_weights_stay_finite():
    p = {n: 30 * x for n, x in attention.initial(20, np.full(5, 0.2)).items()}
    rng = np.random.default_rng(0)
    loss, d, _ = attention.gradient(p, rng.integers(0, 20, (3, attention.WINDOW)), rng.random((3, attention.WINDOW)) < 0.5, rng.integers(-1, 5, (3, attention.SCORED)))
    assert np.isfinite(loss)
    assert all(np.isfinite(g).all() for g in d.values())
    own, begins = attention.score(p, rng.integers(0, 20, 50), rng.integers(0, 5, 50), np.array([20, 30]), np.arange(5) > 2)
    assert np.isfinite(own).all()
    assert np.isfinite(begins).all()


def test_windows_score_each_position_once():
    sizes = np.array([1, 5, attention.SCORED, attention.SCORED + 1, 100])
    index, scored = attention.windows(sizes)
    assert sorted(index[:, attention.CONTEXT :][scored].tolist()) == list(range(sizes.sum()))
    assert len(index) == 1 + 1 + 1 + 2 + 5


def test_attention_looks_back_only():
    p = attention.initial(30, np.full(4, 0.25), 1)
    rng = np.random.default_rng(1)
    ids, real = rng.integers(0, 30, (1, attention.WINDOW)), np.ones((1, attention.WINDOW), bool)
    a = attention.forward(p, ids, real)[0]
    ids[0, -1] = (ids[0, -1] + 1) % 30
    b = attention.forward(p, ids, real)[0]
    assert np.allclose(a[:-1], b[:-1])
    assert not np.allclose(a[-1], b[-1])


def test_logits_are_made_in_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    p = attention.initial(300, np.full(2048, 1 / 2048), 2)
    ids, real = rng.integers(0, 300, (512, attention.WINDOW)), rng.random((512, attention.WINDOW)) < 0.9
    real[:, attention.CONTEXT] = True
    goal = rng.integers(-1, 2048, (512, attention.SCORED))
    tracemalloc.start()
    loss, d, at = attention.gradient(p, ids, real, goal)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < goal.size * 2048 * 4 / 2
    monkeypatch.setattr(attention, "STEP", 10**6)
    loss2, d2, at2 = attention.gradient(p, ids, real, goal)
    assert loss == pytest.approx(loss2, rel=1e-6) and (at == at2).all()
    assert all(np.allclose(d[n], d2[n], atol=1e-6) for n in d)


def test_logits_are_held_only_where_one_is_too_large(monkeypatch):
    rng, held, minimum = np.random.default_rng(7), [], np.minimum
    p = {"w": np.r_[rng.normal(0, 0.1, (attention.WIDTH, 40)), np.full((1, 40), -60.0)].astype(np.float32)}
    p["w"][-1, 3] = 0
    hidden = np.c_[rng.normal(size=(300, attention.WIDTH)), np.ones(300)].astype(np.float32)
    goal, sides = rng.integers(0, 40, 300), np.c_[np.ones(40), np.arange(40) > 20]
    monkeypatch.setattr(attention, "STEP", 100)
    monkeypatch.setattr(np, "minimum", lambda a, *rest, **named: held.append(np.shape(a)) or minimum(a, *rest, **named))

    def check(blocks):
        held.clear()
        for own, told, powers, at, sums in attention.weighed(p, hidden, goal, sides):
            want = minimum(hidden[own].astype(float) @ p["w"].astype(float), 50)
            assert np.allclose(told, want[np.arange(100), goal[own]], rtol=1e-5) and np.allclose(powers, np.exp(want), rtol=1e-4)
            assert np.allclose(sums, np.exp(want) @ sides, rtol=1e-4) and (powers.ravel()[at] == powers[np.arange(100), goal[own]]).all()
        assert held == [(100, 40)] * blocks

    check(0)  # whatever the norms
    hidden[150, :-1] = 120 * p["w"][:-1, 3] / (p["w"][:-1, 3] ** 2).sum()  # its power overflows, in one block of three
    check(1)


def test_sums_of_rows():
    rng = np.random.default_rng(6)
    at, rows = rng.integers(0, 40, 500), rng.normal(size=(500, 8))
    for kind in (np.float32, np.float64):
        got, sums = attention.summed(at, rows.astype(kind))
        assert sums.dtype == kind and got.tolist() == sorted(set(at.tolist()))
        assert np.allclose(sums, [rows[at == i].sum(0) for i in got], atol=1e-5)


TEXTS = [(i, prose(i) if i % 9 else f"Rare{i} wörd\tx", "clash", "clash") for i in range(300)] + [(301, None, None, None), (302, "", None, None), (None, "the OLD mill", None, None), (5, prose(5), None, None)]


@pytest.fixture(scope="module")
def scored(spark):
    return lm.score_texts(spark.createDataFrame(TEXTS, DOCS), piece_model()).collect()


def test_base_scores_by_brute_force(scored):
    words = [(i, (t or "").encode().lower().split()) for i, t, *_ in TEXTS]
    train = [w for i, w in words if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(x for w in train for x in w)
    counts["the end"] = len(train)
    n, v = sum(counts.values()), len(counts)
    want = {}
    for i, w in words:
        want.setdefault(i, []).append((len(w) + 1, sum(counts[x] > 0 for x in w) + 1, sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in [*w, "the end"])))
    assert len(scored) == len(TEXTS)
    for r in scored:
        told, known, base = want[r["doc_id"]][0]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (told, known, n)
        assert r["base_score"] == pytest.approx(base, abs=1e-8)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)


def test_scores_are_probabilities_and_better_than_the_base(scored):
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in scored)
    held = [r for r in scored if r["held_out"] and r["doc_id"] < 300 and r["doc_id"] % 9]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.fixture(scope="module")
def learnt(spark):
    docs = spark.createDataFrame([(prose(i), i % 2) for i in range(60)], "text string, turn int")
    model, _ = lm.learn_words(docs, lm.PieceVocab.load(piece_model()))
    return model, lm.train_attention(docs, model)


def test_the_model_sums_to_one(learnt):
    model, _ = learnt
    ids = np.arange(model.chain.width)
    end = model.chain.width - 1
    for a, b in ((end, end), (end, int(ids[5000])), (300, 400)):
        assert (10 ** model.chain.log10(np.full(len(ids), a), np.full(len(ids), b), ids)).sum() == pytest.approx(1, abs=1e-6)
    assert model.class_share.sum() == pytest.approx(1)
    assert np.allclose(np.bincount(model.class_of, 10**model.within, lm.CLASSES)[np.unique(model.class_of)], 1)
    begins = np.array([p.startswith("▁") for p in model.vocab.pieces] + [True])
    assert (model.leads[model.class_of] == begins).all()


def test_scores_by_brute_force(learnt):
    model, p = learnt
    pieces = lm.Pieces(model.vocab)
    common = sum(model.frequent.values())
    texts = [prose(3), "", "the the zebra quiet mill mill", None, "x " * 60]
    reader = lm.Reader(model, told=True)
    codes, sizes = reader.read(texts)
    firsts = np.cumsum(sizes) - sizes
    got = lm.mixed(*lm.token_scores(reader, p, codes, sizes), lm.copied(codes, sizes), firsts)
    want = []
    for text in texts:
        words = lm.split_words(text)
        cut = [pieces.encode([w])[0].tolist() for w in words] + [[pieces.end]]
        flat = [pieces.end, *(x for c in cut for x in c)]

        def predicted(t, flat=flat):
            """The classes' probabilities for flat[t + 1]."""
            seen = flat[max(0, t // attention.SCORED * attention.SCORED - attention.CONTEXT) : t + 1]
            rows = p["table"][seen].astype(float)
            scores = np.array([rows[-1, attention.QUERY] @ r[attention.KEY] / 4 + p["near"][len(seen) - 1 - i] for i, r in enumerate(rows)])
            a = np.exp(scores - scores.max())
            h = a / a.sum() @ rows[:, attention.VALUE] + rows[-1, attention.REST]
            out = np.exp(np.append(h, 1) @ p["w"].astype(float))
            return out / out.sum()

        t = 0
        for i, own in enumerate(cut):
            by_ids = whole = 1.0
            for k, x in enumerate(own):
                c = predicted(t)
                if k == 0:
                    c = c * model.leads / (c * model.leads).sum()
                    whole = c[model.class_of[x]]
                by_ids *= c[model.class_of[x]] * 10 ** model.within[x]
                t += 1
            if i < len(words):
                by_ids *= (predicted(t) * model.leads).sum()
                n = model.frequent.get(words[i], 0)
                steps = [pieces.end, pieces.end, *own, pieces.end]
                share = (1 - model.chain_share) * n / common + model.chain_share * 10 ** sum(model.chain.log10(*(np.array([x]) for x in steps[j : j + 3]))[0] for j in range(len(steps) - 2))
                whole *= share / 10 ** model.begun[model.class_of[own[0]]]
            told = (1 - lm.WHOLE_SHARE) * by_ids + lm.WHOLE_SHARE * whole
            last = words[max(0, i - lm.COPY_WORDS) : i] if i < len(words) else []
            if i:
                told = (1 - lm.COPY_SHARE) * told + lm.COPY_SHARE * (last.count(words[i]) / len(last) if last else 0)
            want.append(np.log10(told))
    assert np.allclose(got, want, atol=1e-3)


def test_attention_is_trained_on_all_tokens_whatever_the_number_of_documents(spark):
    # each word tells the next; a window a document would be few steps
    texts = [" ".join(PROSE[0].split()[(i + k) % 12] for k in range(3000)) for i in range(32)]
    docs = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "text string, turn int").coalesce(1)
    model, _ = lm.learn_words(docs, lm.PieceVocab.load(piece_model()))
    reader = lm.Reader(model, told=True)
    weights = lm.train_attention(docs, model)
    by_ids, whole = lm.token_scores(reader, weights, *reader.read(texts))
    assert min(by_ids.mean(), whole.mean()) > np.log10(0.8)


def test_every_training_document_is_in_one_turn(spark, monkeypatch):
    told = {}
    monkeypatch.setattr(lm, "learn_words", lambda docs, _: told.update(all=docs.collect()) or (_ for _ in ()).throw(KeyError))
    with pytest.raises(KeyError):
        lm.score_texts(spark.createDataFrame(TEXTS, DOCS), piece_model())
    assert sorted(str(r["text"]) for r in told["all"]) == sorted(str(t) for i, t, *_ in TEXTS if i is None or zlib.crc32(str(i).encode()) % 7 != 2)
    assert {r["turn"] for r in told["all"]} == set(range(lm.TURNS))


def test_windows_have_each_position_once(learnt):
    model, _ = learnt
    reader = lm.Reader(model)
    texts = [prose(1) * 40, "", None, "the old mill"]
    _, _, goal = reader.windows(texts)
    pieces = lm.Pieces(model.vocab)
    want = [x for t in texts for x in [*(pieces.encode(lm.split_words(t))[0].tolist()), pieces.end]]
    assert goal[goal >= 0].tolist() == model.class_of[want].tolist()


def test_rows_and_back():
    p = attention.initial(50, np.full(7, 1 / 7))
    q = {n: x + 1 for n, x in p.items()}
    seen = np.arange(50) % 3 == 0
    at, rows = lm.as_rows(q, seen)
    order = np.random.default_rng(0).permutation(len(at))
    back = lm.with_rows(p, at[order], rows[order])
    assert all((back[n] == q[n]).all() for n in p if n != "table")
    assert (back["table"] == np.where(seen[:, None], q["table"], p["table"])).all()


def test_cache_is_bounded(learnt, monkeypatch):
    model, p = learnt
    texts = [prose(i) + f" new{i} other{i}" for i in range(10)]
    whole = lm.Reader(model, told=True)
    want = [lm.token_scores(whole, p, *whole.read([t])) for t in texts]
    monkeypatch.setattr(lm, "CACHED_WORDS", 2)
    small = lm.Reader(model, told=True)
    for t, told in zip(texts, want, strict=True):
        assert np.allclose(lm.token_scores(small, p, *small.read([t])), told)


def test_a_very_long_text(learnt):
    model, p = learnt
    reader = lm.Reader(model, told=True)
    long = prose(1) * 300
    codes, sizes = reader.read([long, "the old mill"])
    both = lm.token_scores(reader, p, codes, sizes)
    assert len(both[0]) == len(lm.split_words(long)) + 1 + 4
    assert np.isfinite(both).all()


def test_no_training_documents(spark):
    rows = lm.score_texts(spark.createDataFrame([(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string"), piece_model()).collect()
    assert rows
    assert all((r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0) and np.isfinite(r["score"]) for r in rows)
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string"), piece_model()).collect() == []


def test_copies_by_brute_force():
    rng = np.random.default_rng(3)
    texts = [rng.integers(1, 7, n).astype(np.int32) for n in (0, 1, 2, 50, 200)]
    want = []
    for c in texts:
        for i in range(len(c) + 1):
            last = c[max(0, i - lm.COPY_WORDS) : i]
            want.append((last == c[i]).sum() / max(1, len(last)) if i < len(c) else 0)
    assert np.allclose(lm.copied(np.concatenate([np.append(c, 0) for c in texts]), np.array([len(c) + 1 for c in texts])), want)
    a, b, first = np.array([-1.0, -2.0, -3.0]), np.array([-2.0, -2.0, -1.0]), np.array([0])
    s, t = lm.COPY_SHARE, lm.WHOLE_SHARE
    own = (1 - t) * 10**a + t * 10**b
    assert np.allclose(10 ** lm.mixed(a, b, np.array([0.0, 0.5, 0.0]), first), [own[0], (1 - s) * own[1] + s * 0.5, (1 - s) * own[2]])
