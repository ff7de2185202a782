import pytest

from linkweave import cli
from linkweave.operators import learn, validate
from linkweave.operators.features import FEATURES, pair_features
from linkweave.sources import tables
from linkweave.streaming.incremental import resolve_stream


def put(path, text):
    path.write_text(text)
    return str(path)


RECORDS = "entity_id\tbusiness_name\tbusiness_address\tcountry\textra\n"


def test_records(spark, tmp_path):
    path = put(tmp_path / "s.tsv", RECORDS + 'S1-1\tA "quoted" Co\t\tUS\tx\nS1-2\tshort\n')
    rows = tables.read_records(spark, path).collect()
    assert [tuple(r) for r in rows] == [("S1-1", 'A "quoted" Co', "", "US")]
    with pytest.raises(ValueError, match="country"):
        tables.read_records(spark, put(tmp_path / "bad.tsv", "entity_id\tbusiness_name\tbusiness_address\nx\ty\tz\n"))


def test_truth_and_ids(spark, tmp_path):
    path = put(tmp_path / "t.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-1,\nS1-2\t\nS1-3\tS2-9\n")
    wanted = tables.read_ids(spark, put(tmp_path / "ids", "entity_id\nS1-1\n\nS1-2\n"))
    assert sorted(tuple(r) for r in tables.read_truth(spark, path, wanted).collect()) == [("S1-1", "S2-1"), ("S1-1", "S3-1")]
    assert ("S1-2", None) in [tuple(r) for r in tables.read_truth(spark, path, wanted, every=True).collect()]


def test_candidate_round_trip(spark, tmp_path):
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    found = spark.createDataFrame([("S1-1", "S2-2", 1), ("S1-1", "S3-1", 2), ("S1-1", "S2-2", 3)], "s1_id string, cand_id string, rank int")
    tables.write_tsv(tables.candidate_lists(found, s1), str(tmp_path / "out"), one_file=True)
    rows = tables.read_candidates(spark, str(tmp_path / "out")).collect()
    assert {r["s1_id"]: r["cand_ids"] for r in rows} == {"S1-1": ["S2-2", "S3-1"], "S1-2": []}


def test_validator(spark, tmp_path):
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "entity_id string")
    good = put(tmp_path / "good.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\t\nS1-3\t\n")
    errors, warnings = validate.validate(spark, good, s1)
    assert errors == []
    assert len(warnings) == 2
    bad = put(tmp_path / "bad.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-1\tS1-1\nS1-2\tX9\nS1-9\t\n")
    kinds = " ".join(validate.validate(spark, bad, s1)[0])
    for kind in ("duplicate_rows", "duplicate_ids", "self_matches", "wrong_prefix", "missing_rows", "extra_rows"):
        assert kind in kinds
    assert "commas" in validate.validate(spark, put(tmp_path / "c.tsv", "source1_entity_id,matched_entity_ids\nS1-1,\n"), s1)[0][0]
    assert "tab" in validate.validate(spark, put(tmp_path / "n.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\n"), s1)[0][0]
    cands = put(tmp_path / "cand.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\tS3-1\nS1-2\t\nS1-3\t\n")
    assert "1 matches aren't candidates" in validate.validate(spark, good, s1, cands)[1]


def test_split_sizes(spark):
    meta = spark.createDataFrame([(f"S1-{i}", "US" if i % 3 else "India", i % 4, "abcd"[i % 4], "xy"[i % 2]) for i in range(300)], "entity_id string, country string, match_count int, match_category string, source_coverage string")
    test = spark.createDataFrame([(f"t{i}", c) for i, c in enumerate(["US"] * 30 + ["India"] * 10 + ["France"] * 20)], "entity_id string, country string")
    rows = learn.validation_split(meta, test, 0.2).collect()
    assert len(rows) == 300
    by = {c: sum(r["split"] == "validation" and r["country"] == c for r in rows) for c in ("US", "India")}
    assert by == {"US": 45, "India": 15}


def test_features_and_model(spark, tmp_path):
    s1 = spark.createDataFrame([(f"S1-{i}", f"alpha beta {i}", f"{i} main road", "US") for i in range(30)], "entity_id string, name string, address string, country string")
    pool = spark.createDataFrame([(f"S2-{i}", f"alpha beta {i}", f"{i} main rd", "US") for i in range(30)], "entity_id string, name string, address string, country string")
    pairs = spark.createDataFrame([(f"S1-{i}", f"S2-{(i + d) % 30}", d + 1, 1) for i in range(30) for d in (0, 1, 2)], "s1_id string, cand_id string, rank int, mask int")
    rows = learn.label_pairs(pair_features(pairs, s1, pool), pairs.where("rank = 1").select("s1_id", "cand_id")).persist()
    assert [c for c in rows.columns if c in FEATURES] == list(FEATURES)
    assert pair_features(pairs, s1, pool, sources=False).agg({"blocker_p1_hit": "max"}).first()[0] == 0
    model = learn.train(rows, rounds=3, least=2)
    learn.save_model(model, str(tmp_path / "m"), {"threshold": 0.39})
    again, told = learn.load_model(str(tmp_path / "m"))
    assert told["threshold"] == 0.39
    scored = learn.predict(again, rows).collect()
    assert min(r["score"] for r in scored if r["label"]) > max(r["score"] for r in scored if not r["label"])


def test_negatives(spark):
    ranked = spark.createDataFrame([("q", f"c{i}", i) for i in range(1, 11)], "s1_id string, cand_id string, rank int")
    truth = spark.createDataFrame([("q", "c9")], "s1_id string, cand_id string")
    rows = learn.hard_negatives(ranked, truth, scan=3, tail=2).collect()
    assert {r["cand_id"] for r in rows} >= {"c1", "c2", "c3", "c9"}
    assert len(rows) == 6
    assert len(learn.random_negatives(ranked, truth, most=4).collect()) in (4, 5)
    with pytest.raises(ValueError, match="rows of"):
        learn.dev_sample(ranked.withColumnRenamed("cand_id", "entity_id"), 11)
    assert learn.dev_sample(ranked.withColumnRenamed("cand_id", "entity_id"), 4).count() == 4


def test_stream_equals_batch(spark, tmp_path):
    from linkweave.operators.token_block import Limits, hybrid_block

    schema = "entity_id string, name string, address string, country string"
    pool = spark.createDataFrame([("S2-1", "alpha beta", "", "A"), ("S2-2", "gamma", "", "A")], schema)
    limits = Limits(token_share=1.0, fallback=0)
    for i, rows in enumerate(([("S1-1", "alpha", "", "A")], [("S1-2", "gamma beta", "", "A")])):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        resolve_stream(spark, str(tmp_path / "in"), schema, pool, str(tmp_path / "out"), str(tmp_path / "check"), lambda s, p: hybrid_block(s, p, limits)).awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "out")).select("batch").distinct().count() == i + 1
    every = spark.read.schema(schema).parquet(str(tmp_path / "in"))
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert sorted(got.collect()) == sorted(hybrid_block(every, pool, limits).collect())


def test_stored_index(spark, tmp_path, monkeypatch):
    from linkweave.operators.token_block import Limits, hybrid_block
    from linkweave.sources import token_store

    schema = "entity_id string, name string, address string, country string"
    names = ["alpha beta", "alpha", "gamma", "beta gamma delta", "alpha gamma", ""]
    pool = spark.createDataFrame([(f"S2-{i}", names[i % 6], "", c) for i, c in enumerate(["A", "01", "", None] * 9)], schema)
    s1 = spark.createDataFrame([(f"S1-{i}", n, "", c) for i, (n, c) in enumerate((n, c) for n in [*names, "nothing"] for c in ("A", "01", "1", "", None))], schema)
    path, limits = str(tmp_path / "index"), Limits(token_share=0.5, fallback=3)
    token_store.save_index(pool, path, limits)
    index = token_store.load_index(spark, path, limits)
    want = sorted(hybrid_block(s1, pool, limits).collect())
    assert sorted(hybrid_block(s1, index, limits).collect()) == want
    assert len({r["cand_id"] for r in want}) > 10
    with pytest.raises(ValueError, match="other limits"):
        token_store.load_index(spark, path, Limits(token_share=0.4))
    token_store.load_index(spark, path, Limits(token_share=0.5, fallback=9))
    # an interrupted build: finished kinds stay, the others are written
    token_store.remove(spark, f"{path}/pair")
    with pytest.raises(ValueError, match="pair missing"):
        token_store.load_index(spark, path)
    with pytest.raises(ValueError, match="other limits"):
        token_store.save_index(pool, path, Limits(), resume=True)
    wrote, write = [], token_store.write_postings
    monkeypatch.setattr(token_store, "write_postings", lambda rows, p: (wrote.append(p), write(rows, p)))
    token_store.save_index(pool, path, limits, resume=True)
    assert wrote == [f"{path}/pair"]
    assert sorted(hybrid_block(s1, token_store.load_index(spark, path), limits).collect()) == want
    monkeypatch.setattr(token_store, "VERSION", 2)
    with pytest.raises(ValueError, match="version"):
        token_store.load_index(spark, path)
    monkeypatch.undo()
    token_store.save_index(pool.limit(0), path, limits)
    assert hybrid_block(s1, token_store.load_index(spark, path), limits).collect() == []


def test_stream_looks_up_a_stored_index(spark, tmp_path):
    from linkweave.operators.token_block import Limits, hybrid_block
    from linkweave.sources.token_store import load_index, save_index

    schema = "entity_id string, name string, address string, country string"
    pool = spark.createDataFrame([("S2-1", "alpha beta", "", "A"), ("S2-2", "gamma", "", "A")], schema)
    s1 = spark.createDataFrame([("S1-1", "alpha", "", "A"), ("S1-2", "gamma beta", "", "A")], schema)
    s1.write.parquet(str(tmp_path / "in"))
    save_index(pool, str(tmp_path / "index"), Limits(token_share=1.0))
    resolve_stream(spark, str(tmp_path / "in"), schema, load_index(spark, str(tmp_path / "index")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).drop("batch").collect()) == sorted(hybrid_block(s1, pool, Limits(token_share=1.0)).collect())


def test_command_line(spark, tmp_path):
    s1 = put(tmp_path / "s1.tsv", RECORDS + "S1-1\tApple Tech\tx road 1\tUS\t\nS1-2\tNobody\ty\tUS\t\n")
    s2 = put(tmp_path / "s2.tsv", RECORDS + "S2-1\tApple Tech\tx road 1\tUS\t\n")
    s3 = put(tmp_path / "s3.tsv", RECORDS + "S3-1\tOther\tz\tUS\t\n")
    out = str(tmp_path / "cands")
    assert cli.main(["block", "--s1", s1, "--s2", s2, "--s3", s3, "--output", out, "--blocker", "token", "--max-doc-freq", "1"], spark) == 0
    assert {r["s1_id"]: r["cand_ids"] for r in tables.read_candidates(spark, out).collect()} == {"S1-1": ["S2-1"], "S1-2": []}
    index, looked_up = str(tmp_path / "index"), str(tmp_path / "looked_up")
    assert cli.main(["index", "--s2", s2, "--s3", s3, "--output", index, "--max-doc-freq", "1"], spark) == 0
    assert cli.main(["block", "--s1", s1, "--index", index, "--output", looked_up, "--blocker", "token"], spark) == 0
    assert sorted(tables.read_candidates(spark, looked_up).collect()) == sorted(tables.read_candidates(spark, out).collect())
    with pytest.raises(SystemExit):
        cli.main(["block", "--s1", s1, "--index", index, "--output", looked_up], spark)
    fused = str(tmp_path / "fused")
    assert cli.main(["block", "--s1", s1, "--s2", s2, "--s3", s3, "--output", fused, "--max-doc-freq", "1"], spark) == 0
    assert {r["s1_id"]: r["cand_ids"][:1] for r in tables.read_candidates(spark, fused).collect()}["S1-1"] == ["S2-1"]
    truth = put(tmp_path / "truth.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\t\n")
    assert cli.main(["recall", "--candidates", out, "--ground-truth", truth, "--s1", s1], spark) == 0
    assert cli.main(["validate", "--matching", truth, "--s1", s1, "--pool", s2, s3], spark) == 0


def test_train_tune_and_match(spark, tmp_path):
    rng = __import__("random").Random(1)
    words = [f"{a}{b}" for a in "bcdfgklm" for b in ("ara", "ino", "upe", "oli")]
    names = [" ".join(rng.sample(words, 3)) for _ in range(40)]
    s1 = put(tmp_path / "s1.tsv", RECORDS + "".join(f"S1-{i}\t{n}\t{i} main road\tUS\t\n" for i, n in enumerate(names)))
    s2 = put(tmp_path / "s2.tsv", RECORDS + "".join(f"S2-{i}\t{n} ltd\t{i} main road\tUS\t\n" for i, n in enumerate(names)))
    s3 = put(tmp_path / "s3.tsv", RECORDS + "".join(f"S3-{i}\t{' '.join(rng.sample(words, 3))}\t{i + 500} side street\tUS\t\n" for i in range(40)))
    truth = put(tmp_path / "truth.tsv", "source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i}\n" for i in range(40)))
    common = ["--s1", s1, "--s2", s2, "--s3", s3, "--model", str(tmp_path / "model"), "--max-doc-freq", "1"]
    assert cli.main(["train", *common, "--ground-truth", truth, "--max-iter", "3", "--min-samples-leaf", "2"], spark) == 0
    matches, cands = str(tmp_path / "m"), str(tmp_path / "c")
    assert cli.main(["match", *common, "--output-matches", matches, "--output-candidates", cands], spark) == 0
    got = {tuple(r) for r in tables.read_truth(spark, matches).collect()}
    want = {(f"S1-{i}", f"S2-{i}") for i in range(40)}
    assert len(got & want) >= 38
    assert len(got - want) <= 4
    assert tables.read_candidates(spark, cands).count() == 40


def test_tuning(spark, monkeypatch):
    from linkweave.plans import resolution

    s1 = spark.createDataFrame([(f"S1-{i}", "US") for i in range(4)], "entity_id string, country string")
    scored = spark.createDataFrame([(f"S1-{i}", f"S2-{i}", 1, 0.8 if i < 3 else 0.3) for i in range(4)], "s1_id string, cand_id string, rank int, score double").persist()
    truth = scored.where("score > 0.5").select("s1_id", "cand_id")
    monkeypatch.setattr(resolution, "pair_features", lambda pairs, a, b: pairs)
    monkeypatch.setattr(resolution, "predict", lambda model, rows: rows)
    best = resolution.tune(s1, None, scored, truth, None, coarse={"thresholds": [0.1, 0.5], "caps": [1, 2], "ranks": [1]})
    assert (best["threshold"], best["macro_f05"]) == (0.5, 1.0)


def test_lists_must_have_the_same_queries(spark):
    from linkweave.operators.metrics import union_of_lists

    a = spark.createDataFrame([("q", ["x", "y"])], "s1_id string, cand_ids array<string>")
    b = spark.createDataFrame([("q", ["y", "z"])], "s1_id string, cand_ids array<string>")
    assert union_of_lists(a, b).first()["cand_ids"] == ["x", "y", "z"]
    with pytest.raises(ValueError, match="every list"):
        union_of_lists(a, b.limit(0))


def test_encoder_probe():
    from linkweave.operators.knn import encoder_throughput, hashed_encoder

    told = encoder_throughput(hashed_encoder(32), ["some text"] * 10)
    assert (told["texts"], told["dimensions"]) == (10, 32)
