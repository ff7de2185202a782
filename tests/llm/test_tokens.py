"""SentencePiece coding against the library, and unigram counts against the tokenizers library."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkweave.llm.queries import piece_model
from linkweave.llm.sentencepieces import Decoder, Encoder, encode_documents, mend
from linkweave.llm.token_counts import Counter, count_tokens
from linkweave.llm.vocab import NORMAL, PieceVocab, text_slices

sentencepiece = pytest.importorskip("sentencepiece")
ALPHABET = "aab  bct▁\n\t<s>é中文字😀🏽ôﬁ１x0the"


@pytest.fixture(scope="module")
def vocab():
    return PieceVocab.load(piece_model())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


@pytest.fixture(scope="module")
def encoder(vocab):
    return Encoder(vocab)


def lists(ids, offsets):
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


EDGES = ["", " ", "  ", *(" " * k for k in (3, 15, 16, 17, 33, 70)), "the" * 50, " a" * 300, "x" * 3000, "ab" * 2000, "\x00a\x00", "▁▁x▁", "<s> </s> <0x41>", "日本語" * 200, "e" + "́" * 40]


def test_encoding_equals_the_library(encoder, library):
    rng = random.Random(1)
    texts = EDGES + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + ["".join(rng.choice("thenrioas ") for _ in range(5000))]
    assert lists(*encoder.encode(texts)) == library.encode(texts)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text(encoder, library, vocab, text):
    ids, offsets = encoder.encode([text])
    assert ids.tolist() == library.encode(text)
    assert Decoder(vocab).decode(ids, offsets).to_pylist() == [library.decode(ids.tolist())]


def test_decoding_equals_the_library(vocab, library):
    rng = random.Random(2)
    made = [[rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(3, 258), rng.randint(259, 31999)]) for _ in range(rng.randint(0, 12))] for _ in range(2000)]
    offsets = np.cumsum([0, *map(len, made)])
    ids = np.array([i for x in made for i in x], np.int32)
    assert Decoder(vocab).decode(ids, offsets).to_pylist() == [library.decode(x) for x in made]
    assert mend(b"a\xffb\xe4\xb8") == "a�b��"


def test_one_merge_at_a_time_agrees(encoder):
    rng = random.Random(3)
    words = ["▁" + "".join(rng.choice("thenrioasdl") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    flat, sizes = encoder.merger.encode(words)
    ends = np.cumsum(sizes)
    assert [flat[e - n : e].tolist() for e, n in zip(ends, sizes)] == [encoder.merger.one_by_one(w) for w in words]


def test_cache_is_bounded(vocab, monkeypatch, library):
    monkeypatch.setattr("linkweave.llm.sentencepieces.CACHED_WORDS", 3)
    own = Encoder(vocab)
    for text in ("one two three four", "one two", "five six seven eight nine", "one"):
        assert own.encode([text])[0].tolist() == library.encode(text)


def test_operator(spark, library):
    rows = [(1, "a text\nof two lines", "x"), (1, "a text\nof two lines", "x"), (2, None, "x"), (3, "", "x"), (None, "no id", "x"), (4, "long " * 100_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_documents(df, piece_model()).collect()
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, len(r[1]))
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert encode_documents(df.limit(0), piece_model()).count() == 0


def test_slices():
    import pyarrow as pa

    assert text_slices(pa.array(["aa", None, "bbb", "c" * 9, "d"]), 5) == [(0, 3), (3, 4), (4, 5)]
    assert text_slices(pa.array([], pa.string()), 5) == []


@pytest.fixture(scope="module")
def unigram(vocab):
    tokenizers = pytest.importorskip("tokenizers")
    model = tokenizers.models.Unigram([(p, s) for p, s in zip(vocab.pieces, vocab.scores)], 0, True)
    return tokenizers.Tokenizer(model)


def test_counts_equal_the_tokenizer(vocab, unigram):
    rng = random.Random(4)
    texts = [t for t in EDGES if t] + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 60))) for _ in range(800)]
    texts = [t for t in texts if "\x00" not in t]
    want = [len(unigram.encode(vocab.normalize(t)).ids) for t in texts]
    assert Counter(vocab).count(texts)[0].tolist() == want


def test_counts_of_a_small_vocabulary_by_brute_force():
    pieces = ["<unk>", "a", "b", "ab", "ba", "aba", "▁", "▁a"] + [f"<0x{i:02X}>" for i in range(256)]
    scores = [0.0, -1.0, -1.0, -2.0, -2.0, -3.0, -1.0, -2.0] + [0.0] * 256
    small = PieceVocab(pieces, scores, [2] + [NORMAL] * 7 + [3] * 256)
    counter = Counter(small)

    def best(s):
        # every segmentation has the same score here, so the tie rule decides: the longest piece that ends last
        score, count = [0.0] + [-1e9] * len(s), [0] * (len(s) + 1)
        for e in range(1, len(s) + 1):
            for b in range(e):
                if s[b:e] in small.normal and score[b] + scores[pieces.index(s[b:e])] > score[e]:
                    score[e], count[e] = score[b] + scores[pieces.index(s[b:e])], count[b] + 1
        return count[-1]

    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 12)))
        assert counter.best(small.normalize(text))[0] == best(small.normalize(text))
    assert counter.count(["é"])[0].tolist() == [3]


def test_count_operator(spark):
    df = spark.createDataFrame([(1, "some text", 5), (1, "some text", 5), (2, None, 5), (3, "", 5), (None, "x", 5), (4, "y" * 200_000, 5)], "doc_id long, text string, n_tokens int")
    got = {(r["doc_id"], r["n_tokens"]) for r in count_tokens(df, piece_model()).collect()}
    assert {(2, 0), (3, 0)} <= got
    assert count_tokens(df, piece_model()).count() == 6
    assert count_tokens(df.limit(0), piece_model()).count() == 0


def test_key_index():
    from linkweave.llm.vocab import KeyIndex

    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 5000):
        keys = np.unique(rng.integers(0, 10**13, n))
        asked = np.r_[keys, rng.integers(0, 10**13, 2000)]
        at, hit = KeyIndex(keys).find(asked)
        assert (hit == np.isin(asked, keys)).all()
        assert (keys[at[hit]] == asked[hit]).all() if n else not hit.any()
