"""The opN queries and the pipeline over the smallest tables."""

import hashlib
import math
import os
import zlib
from collections import Counter

import duckdb
import pytest
import sentencepiece

import corpus_pipeline
from linkweave.llm import common, queries
from linkweave.llm import decontaminate as dc
from linkweave.llm.decontaminate import SeedIndex
from linkweave.llm.queries import QUERIES, piece_model
from linkweave.llm.sql import ORACLE_SQL

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


def plain(rows):
    return sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert plain(tuple(r) for r in got.select(*columns).collect()) == plain(want)


def test_ten_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    stage, kept = docs, []
    for _, f in corpus_pipeline.STAGES[:3]:
        stage = f(spark, stage, DATA)
        assert stage.columns == docs.columns
        kept.append({r["doc_id"] for r in stage.collect()})
    good, unique, clean = kept
    assert set(texts) >= good >= unique >= clean
    assert sum(labels[i] == 0 for i in good & set(labels)) <= 1
    assert sum(labels[i] == 1 for i in set(labels) - good) <= 1
    # brute force over the stages' own inputs
    shingled = {i: {tuple(w[k : k + 5]) for w in [texts[i].encode().lower().split()] for k in range(max(1, len(w) - 4))} for i in good}
    for i in good - unique:
        assert any(j < i and 100 * len(shingled[i] & shingled[j]) >= 75 * len(shingled[i] | shingled[j]) for j in good)
    for i in unique:
        assert not any(j < i and 100 * len(shingled[i] & shingled[j]) >= 75 * len(shingled[i] | shingled[j]) for j in good)
    items = [(r["item_id"], " ".join(r["text"].lower().split())) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    holds = {i for i in unique if any(t in " ".join(texts[i].lower().split()) for _, t in items)}
    assert holds <= unique - clean
    assert {i for i in unique if SeedIndex(items).find([texts[i]])} == unique - clean
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    rows = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, DATA).collect()}
    assert rows == {i: library.encode(texts[i]) for i in clean}


def test_registered_sentencepiece_equals_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    texts = dict(common.table(spark, DATA, "documents").select("doc_id", "text").collect())
    got = queries.op1_sentencepiece(spark, DATA).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        ids = sp.encode(texts[r["doc_id"]] or "")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), sp.decode(ids))]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), *digests)


def test_registered_quality(spark):
    labels = dict(common.table(spark, DATA, "labels").where("quality IS NOT NULL").select("doc_id", "quality").collect())
    got = queries.op5_quality(spark, DATA).collect()
    assert len(got) == common.table(spark, DATA, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    own = [r["predicted"] == labels[r["doc_id"]] for r in got if not r["held_out"] and r["doc_id"] in labels]
    assert sum(own) > 0.85 * len(own)


def test_registered_lm_score_by_brute_force(spark):
    rows = [(i, (t or "").encode().lower().split()) for i, t in common.table(spark, DATA, "documents").select("doc_id", "text").collect()]
    train = [w for i, w in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(x for w in train for x in w)
    total, distinct, ends = sum(counts.values()) + len(train), len(counts) + 1, len(train)
    share = lambda c: math.log10((c + 1) / (total + distinct + 1))
    want = {i: (len(w) + 1, sum(x in counts for x in w) + 1, sum(share(counts[x]) for x in w) + share(ends)) for i, w in rows}
    got = queries.op10_lm_score(spark, DATA).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(want)
    for r in got:
        assert (r["n_tokens"], r["n_known"]) == want[r["doc_id"]][:2]
        assert r["train_tokens"] == total
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][2], rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert r["score"] < 0


def test_registered_leaks_are_whole_items(spark):
    """Each item that a document holds word for word is found."""
    plain = lambda t: " " + " ".join(dc.words_of(t)) + " "
    items = {r["item_id"]: plain(r["text"]) for r in common.table(spark, DATA, "benchmark").collect()}
    docs = {r["doc_id"]: plain(r["text"]) for r in common.table(spark, DATA, "documents").collect()}
    got = queries.op4_decontaminate(spark, DATA)
    assert got.count() > 0
    found = {tuple(r) for r in got.select("doc_id", "item_id").collect()}
    assert found >= {(d, i) for d, text in docs.items() for i, item in items.items() if len(item.split()) >= 10 and item in text}
