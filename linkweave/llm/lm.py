"""Language-model scoring of whole texts.

Tokens are words (runs of anything but ASCII white space, A-Z in lower case) and one end. A text is
the sequence of the subword ids of its words, then the end. The model gives it the probability

    product over tokens of  (1 - s) * ((1 - t) * A(word | all before) + t * B(word | all before))  +  s * (its share of the last words)

where t is WHOLE_SHARE and s is COPY_SHARE, or 0 for the first token. Both A and B are read off the
causal self-attention model (linkweave.llm.attention), which reads every subword id of the text and
predicts every next one in two levels: the class by attention, the id by its share of the class. A
class holds ids that begin a word, or ids within words.

* A is the product over the word's ids, and the probability that another word, or the end, begins then.
* B takes only the class of the word's first id from the attention, and the whole word by its share of
  that class. These shares mix those of frequent words among all training words with a trigram chain
  over the subword ids of all distinct training words, each counted once.

Word counts, subword counts and classes come from all training documents. The attention model is
trained on all tokens of every training document: in each of TURNS rounds the partitions train copies
on all windows of that round's documents, and the copies are averaged, row by row.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain as joined

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import attention
from linkweave.llm.common import materialize
from linkweave.llm.quality import crc_mod
from linkweave.llm.sentencepieces import Merger
from linkweave.llm.vocab import SPACE, KeyIndex, PieceVocab, WordCodes, text_slices

#: A frequent word has this share of all tokens at least, so that there are at most 1 / share; likewise for pairs and triples of subwords.
WORD_SHARE, PAIR_SHARE = 1e-6, 1e-6
#: Classes of subword ids: the most frequent ids have one each; the rest share two, by whether they begin a word; the last is the end's.
CLASSES = 256
#: Each training document is in one of so many rounds. Windows in a step of training, and its rate in the first round.
TURNS, STEP_WINDOWS, RATE = 2, 128, 0.04
#: The share of words that are predicted as wholes.
WHOLE_SHARE = 0.6
#: A word repeats one of so many words before it with this probability, each of them alike.
COPY_WORDS, COPY_SHARE = 32, 0.06
BATCH_CHARS, CACHED_WORDS, CACHED_CHARS, FLUSH_WORDS = 4_000_000, 500_000, 16_000_000, 1_000_000
PULL, LOG10 = 5.0, np.log(10)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """word, n over all documents (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        show = lambda: pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        for batch in batches:
            for a, b in text_slices(batch.column(0), BATCH_CHARS):
                for text in batch.column(0).slice(a, b - a).to_pylist():
                    counts.update(split_words(text))
                if len(counts) > FLUSH_WORDS:
                    yield show()
                    counts.clear()
        if counts:
            yield show()

    return docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Pieces:
    """Subword ids of words."""

    def __init__(self, vocab: PieceVocab) -> None:
        self.merger, self.end = Merger(vocab), len(vocab.pieces)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.merger.encode([SPACE + w.decode("utf-8").replace(" ", SPACE) for w in words]) if words else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def steps(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id before that, id before, id) with the end id in front of and behind each word, in order."""
        ends = np.cumsum(sizes)
        before = np.insert(flat, ends - sizes, self.end).astype(np.int64)
        after = np.insert(flat, ends, self.end).astype(np.int64)
        earlier = np.r_[self.end, before[:-1]] if len(before) else before
        earlier[(ends - sizes + np.arange(len(sizes)))] = self.end
        return earlier, before, after


def count_steps(counts: DataFrame, vocab: PieceVocab) -> DataFrame:
    """a, b, c, n, tokens: how often subword id c follows a and b in distinct words, and in all words (word, n)."""
    src, width = counts.select("word", "n"), len(vocab.pieces) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(vocab)
        total, tokens = Counter(), Counter()

        def show() -> pa.RecordBatch:
            keys = np.fromiter(total, np.int64, len(total))
            ids = (keys // width // width, keys // width % width, keys % width)
            return pa.RecordBatch.from_arrays([*(pa.array(i.astype(np.int32)) for i in ids), pa.array(list(total.values()), pa.int64()), pa.array([tokens[k] for k in total], pa.int64())], ["a", "b", "c", "n", "tokens"])

        for batch in batches:
            flat, sizes = pieces.encode([w.encode() for w in batch.column(0).to_pylist()])
            a, b, c = pieces.steps(flat, sizes)
            n = np.repeat(batch.column(1).to_numpy(), sizes + 1)
            keys, at = np.unique((a * width + b) * width + c, return_inverse=True)
            total.update(dict(zip(keys.tolist(), np.bincount(at).tolist(), strict=True)))
            tokens.update(dict(zip(keys.tolist(), np.bincount(at, n).astype(np.int64).tolist(), strict=True)))
            if len(total) > FLUSH_WORDS:
                yield show()
                total.clear()
                tokens.clear()
        if total:
            yield show()

    return src.mapInArrow(run, "a int, b int, c int, n bigint, tokens bigint").groupBy("a", "b", "c").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"))


class Table:
    """Numbers by key; 0 for other keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order].astype(np.int64), values[order].astype(np.float64)
        if not len(keys):
            self.keys, self.values = np.array([-1]), np.zeros(1)
        self.index = KeyIndex(self.keys)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at, hit = self.index.find(keys)
        return np.where(hit, self.values[at], 0.0)


@dataclass
class Chain:
    """P(c | a, b) over subword ids: kept triples, the rest by kept pairs, the rest of these by P(c); sums to one."""

    width: int
    triples: Table
    contexts: Table  # of kept triples: how often a, b occurs
    kept_triples: np.ndarray  # how much of that the kept triples have
    pairs: Table
    totals: np.ndarray
    rest: np.ndarray
    single: np.ndarray

    @classmethod
    def learn(cls, steps: DataFrame, width: int) -> Chain:
        single, totals, kept = np.full(width, 0.1), np.zeros(width), np.zeros(width)
        for c, n in steps.groupBy("c").agg(F.sum("n")).collect():  # at most one row for each id
            single[c] += n
        for b, n in steps.groupBy("b").agg(F.sum("n")).collect():
            totals[b] = n
        least = max(1.0, PAIR_SHARE * totals.sum())
        # at most 1 / PAIR_SHARE rows each
        own = steps.groupBy("b", "c").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas()
        np.add.at(kept, own["b"].to_numpy(np.int64), own["n"].to_numpy(float))
        pairs = Table(own["b"].to_numpy(np.int64) * width + own["c"].to_numpy(np.int64), own["n"].to_numpy(float))
        three = steps.where(F.col("n") >= least).toPandas()
        before = three["a"].to_numpy(np.int64) * width + three["b"].to_numpy(np.int64)
        triples = Table(before * width + three["c"].to_numpy(np.int64), three["n"].to_numpy(float))
        seen = steps.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("n").alias("most")).where(F.col("most") >= least).toPandas()
        contexts = Table(seen["a"].to_numpy(np.int64) * width + seen["b"].to_numpy(np.int64), seen["n"].to_numpy(float))
        kept_triples = np.bincount(np.searchsorted(contexts.keys, before), three["n"].to_numpy(float), len(contexts.keys))
        return cls(width, triples, contexts, kept_triples, pairs, totals, (totals - kept + PULL) / (totals + PULL), single / single.sum())

    def log10(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        two = self.pairs.get(b * self.width + c) / (self.totals[b] + PULL) + self.rest[b] * self.single[c]
        before = a * self.width + b
        at, hit = self.contexts.index.find(before)
        seen, kept = np.where(hit, self.contexts.values[at], 0.0), np.where(hit, self.kept_triples[at], 0.0)
        three = np.zeros(len(before))
        three[hit] = self.triples.get(before[hit] * self.width + c[hit])
        return np.log10((three + (seen - kept + PULL) * two) / (seen + PULL))


@dataclass
class WordModel:
    """What stays the same whatever the context; bounded by the shares above."""

    vocab: PieceVocab
    chain: Chain
    frequent: dict[bytes, int]
    tokens: int  # with the ends
    distinct: int
    ends: int
    chain_share: float
    class_of: np.ndarray  # by subword id, with the end
    leads: np.ndarray  # which classes begin a word
    class_share: np.ndarray
    within: np.ndarray  # log10 of an id's share of its class
    begun: np.ndarray  # log10 of the share of words that begin with an id of the class


def classes_of(share: np.ndarray, leading: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each id, which classes begin a word) by the shares of ids; the last id is the end."""
    class_of = np.where(leading, CLASSES - 2, CLASSES - 3)
    class_of[np.argsort(-share[:-1], kind="stable")[: CLASSES - 3]] = np.arange(min(CLASSES - 3, len(share) - 1))
    class_of[-1] = CLASSES - 1
    leads = np.zeros(CLASSES, bool)
    leads[class_of[leading]] = True
    leads[CLASSES - 2 :] = True
    return class_of, leads


def learn_words(docs: DataFrame, vocab: PieceVocab) -> tuple[WordModel, DataFrame]:
    """(the word model, the table of word, n) of training documents."""
    counts = materialize(count_words(docs))
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = docs.count()
    least = max(2.0, WORD_SHARE * words)
    frequent = {r[0].encode(): r[1] for r in counts.where(F.col("n") >= least).collect()}  # at most 1 / WORD_SHARE rows
    width = len(vocab.pieces) + 1
    steps = materialize(count_steps(counts, vocab))
    chain = Chain.learn(steps, width)
    chain_share = (words - sum(frequent.values()) + 1.0) / (words + 1.0)
    share = np.full(width, 0.1)
    for c, n in steps.groupBy("c").agg(F.sum("tokens")).collect():  # at most one row for each id
        share[c] += n
    share[-1] = max(1, ends)
    class_of, leads = classes_of(share, np.array([p.startswith(SPACE) for p in vocab.pieces] + [True]))
    class_share = np.bincount(class_of, share, CLASSES)
    within = np.log10(share) - np.log10(class_share[class_of])
    flat, sizes = Pieces(vocab).encode(list(frequent))
    first = flat[np.cumsum(sizes) - sizes] if len(sizes) else flat
    begun = np.bincount(first, np.array(list(frequent.values()), float), width) * (1 - chain_share) / max(1, sum(frequent.values()))
    begun += chain_share * 10 ** chain.log10(*(np.full(width, width - 1),) * 2, np.arange(width))
    begun = np.log10(np.maximum(np.bincount(class_of, begun, CLASSES), 1e-300))
    return WordModel(vocab, chain, frequent, words + ends, distinct + (ends > 0), ends, chain_share, class_of, leads, class_share / class_share.sum(), within, begun), counts


class Reader:
    """Words of texts as codes, and what is known of each code; words are kept up to a bound.

    Code 0 is the end. With `told`, words get their share of their first id's class and their training counts.
    """

    def __init__(self, model: WordModel, told: bool = False) -> None:
        self.model, self.told, self.pieces, self.common = model, told, Pieces(model.vocab), max(1, sum(model.frequent.values()))
        self.clear()

    def clear(self) -> None:
        self.codes, self.names, self.chars = WordCodes({b"": 0}), [b""], 0
        self.ids, self.sizes = np.array([self.pieces.end], np.int32), np.ones(1, np.int64)
        self.alone, self.counts = np.zeros(1), np.zeros(1, np.int64)

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(the codes of all texts' tokens, how many each text has)."""
        if len(self.codes) > CACHED_WORDS or self.chars > CACHED_CHARS:
            self.clear()
        listed = [split_words(t) for t in texts]
        sizes = np.array([len(words) + 1 for words in listed], np.int64)
        codes = np.zeros(sizes.sum(), np.int32)
        own = np.ones(len(codes), bool)
        own[np.cumsum(sizes) - 1] = False
        codes[own] = np.fromiter(map(self.codes.__getitem__, joined.from_iterable(listed)), np.int32, int(own.sum()))
        if fresh := self.codes.fresh:
            self.chars += sum(map(len, fresh))
            self.names += fresh
            ids, many = self.pieces.encode(fresh)
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, many])
            if self.told:
                alone, counts = self.describe(fresh, ids, many)
                self.alone, self.counts = np.concatenate([self.alone, alone]), np.concatenate([self.counts, counts])
            self.codes.fresh = []
        return codes, sizes

    def describe(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 of their share of the words that begin with an id of the same class, training counts of frequent words)."""
        m = self.model
        steps = np.add.reduceat(m.chain.log10(*self.pieces.steps(ids, sizes)), np.cumsum(sizes) - sizes + np.arange(len(sizes)))
        n = np.fromiter((m.frequent.get(w, 0) for w in words), np.int64, len(words))
        share = (1 - m.chain_share) * n / self.common + m.chain_share * 10**steps
        first = m.class_of[ids[np.cumsum(sizes) - sizes]]
        return np.where(share > 1e-290, np.log10(np.maximum(share, 1e-300)), np.log10(m.chain_share) + steps) - m.begun[first], n

    def sequences(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(the id before each position, the id there, positions of each text, where tokens start) of all texts; the end stands before a text too."""
        many = self.sizes[codes]
        starts = np.cumsum(many) - many
        goal = self.ids[np.repeat((np.cumsum(self.sizes) - self.sizes)[codes] - starts, many) + np.arange(many.sum())]
        before = np.r_[self.pieces.end, goal[:-1]].astype(np.int32) if len(goal) else goal
        return before, goal, np.add.reduceat(many, np.cumsum(sizes) - sizes) if len(sizes) else sizes, starts

    def windows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(input ids, which are real, target classes or -1) of windows that have each position of the texts as a target once."""
        before, goal, sizes, _ = self.sequences(*self.read(texts))
        index, scored = attention.windows(sizes)
        return before[index], index >= 0, np.where(scored, self.model.class_of[goal][index[:, attention.CONTEXT :]], -1)


def copied(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each token of each text, the share of the COPY_WORDS words before it that are the same word; an end is no word."""
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    same = np.zeros(len(codes), np.int32)
    for k in range(1, min(COPY_WORDS, int(sizes.max(initial=1)) - 1) + 1):
        same[k:] += (codes[k:] == codes[:-k]) & (place[k:] >= k)
    same[codes == 0] = 0
    return same / np.clip(place, 1, COPY_WORDS)


def mixed(by_ids: np.ndarray, whole: np.ndarray, share: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log10 of the mixture of A, B (both as log10) and copying; first: places of first tokens, which copy nothing."""
    own = np.logaddexp(by_ids * LOG10 + np.log1p(-WHOLE_SHARE), whole * LOG10 + np.log(WHOLE_SHARE))
    out = own + np.log1p(-COPY_SHARE)
    again = share > 0
    out[again] = np.logaddexp(out[again], np.log(COPY_SHARE * share[again]))
    out[first] = own[first]
    return out / LOG10


def token_scores(reader: Reader, weights: dict[str, np.ndarray], codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of A and of B for each token."""
    m = reader.model
    before, goal, many, starts = reader.sequences(codes, sizes)
    own, begins = attention.score(weights, before, m.class_of[goal], many, m.leads)
    begins[np.cumsum(many) - many] = 0  # a text begins with a token for certain
    return np.add.reduceat(own + m.within[goal] + np.r_[begins[1:], 0.0], starts), own[starts] + reader.alone[codes]


ROW = 4 * attention.WIDTH


def as_rows(p: dict[str, np.ndarray], seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, rows) of the table's seen rows, and of all other weights in rows from -1 down."""
    rest = np.concatenate([x.ravel() for n, x in p.items() if n != "table"])
    rest = np.pad(rest, (0, -len(rest) % ROW)).reshape(-1, ROW)
    at = np.flatnonzero(seen)
    return np.r_[at, -1 - np.arange(len(rest))], np.concatenate([p["table"][at], rest])


def with_rows(p: dict[str, np.ndarray], at: np.ndarray, rows: np.ndarray) -> dict[str, np.ndarray]:
    """p with these rows, the inverse of as_rows."""
    out = {n: x.copy() for n, x in p.items()}
    out["table"][at[at >= 0]] = rows[at >= 0]
    rest, start = rows[at < 0][np.argsort(-at[at < 0])].ravel(), 0
    for n, x in out.items():
        if n != "table" and len(rest):
            x[...] = rest[start : start + x.size].reshape(x.shape)
            start += x.size
    return out


def train_attention(docs: DataFrame, model: WordModel, turns: int = TURNS) -> dict[str, np.ndarray]:
    """Weights trained on all tokens of every document (text, turn); an average over partitions in each turn."""
    spark, weights = docs.sparkSession, attention.initial(len(model.class_of), model.class_share)
    sent = spark.sparkContext.broadcast(model)
    for turn in range(turns):
        start = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], turn: int = turn, start=start) -> Iterator[pa.RecordBatch]:
            reader, adam, seen = Reader(sent.value), attention.Adam(start.value, RATE / (1 + 2 * turn)), 0
            for batch in batches:
                for a, b in text_slices(batch.column(0), BATCH_CHARS):
                    ids, real, goal = reader.windows(batch.column(0).slice(a, b - a).to_pylist())
                    order = np.random.default_rng(turn).permutation(len(ids))
                    for k in range(0, len(ids), STEP_WINDOWS):
                        own = order[k : k + STEP_WINDOWS]
                        adam.step(*attention.gradient(adam.p, ids[own], real[own], goal[own])[1:])
                    seen += len(ids)
            if seen:
                at, rows = as_rows(adam.p, adam.seen)
                flat = pa.array(rows.ravel().astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.FixedSizeListArray.from_arrays(flat, ROW).cast(pa.list_(pa.float64())), pa.array(np.full(len(at), seen), pa.int64())], ["at", "row", "seen"])

        parts = docs.where(F.col("turn") == turn).select("text").mapInArrow(run, "at int, row array<double>, seen bigint")
        means = [(F.sum(F.col("row")[k] * F.col("seen")) / F.sum("seen")).alias(f"w{k}") for k in range(ROW)]
        got = parts.groupBy("at").agg(*means).toPandas()  # at most a row for each subword id
        if len(got):
            weights = with_rows(weights, got["at"].to_numpy(), got.drop(columns="at").to_numpy(np.float32))
    return weights


def score_texts(docs: DataFrame, model_path: str, held_out: tuple[int, int] = (7, 2)) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row.

    Learns from documents whose crc32(doc_id) modulo held_out[0] isn't held_out[1]; a row without
    doc_id is learnt from. Null and empty texts have the end as their only token. Repeated rows count
    and are scored one by one; other columns are ignored. Without training documents every token is
    unknown.
    """
    spark: SparkSession = docs.sparkSession
    modulus, rest = held_out
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(crc_mod(F.col("doc_id"), modulus) == rest, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    train = src.where("NOT held_out").select("text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(TURNS)).alias("turn"))
    model, counts = learn_words(train, PieceVocab.load(model_path))
    weights = train_attention(train, model)
    sent = spark.sparkContext.broadcast((model, weights))
    spread = np.log10(model.tokens + model.distinct + 1) if model.tokens else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, p = sent.value
        reader = Reader(words, told=True)
        for batch in batches:
            for a, b in text_slices(batch.column(2), BATCH_CHARS):
                codes, sizes = reader.read(batch.column(2).slice(a, b - a).to_pylist())
                ends = np.cumsum(sizes)
                firsts = ends - sizes
                tokens = mixed(*token_scores(reader, p, codes, sizes), copied(codes, sizes), firsts)
                score = np.add.reduceat(tokens, firsts)
                n = reader.counts[codes]
                known = np.add.reduceat((n > 0).astype(np.int64), firsts)
                base = np.add.reduceat(np.where(n > 0, np.log10(n + 1.0) - spread, 0.0), firsts)
                rare = np.flatnonzero((n == 0) & (codes > 0))
                owner = np.repeat(np.arange(len(sizes)), sizes)[rare]
                keys, times = np.unique(owner * np.int64(len(reader.names)) + codes[rare], return_counts=True)
                owner, code = np.divmod(keys, len(reader.names))
                tail = pa.StructArray.from_arrays([pa.array([reader.names[i].decode("utf-8") for i in code.tolist()], pa.string()), pa.array(times, pa.int64())], ["word", "times"])
                uid = pa.array([os.urandom(16) for _ in range(b - a)], pa.binary())  # written before it is used, so it stays
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), uid, pa.array(sizes), pa.array(known), pa.array(base), pa.array(score),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(b - a + 1)), pa.int32()), tail),
                ], ["doc_id", "held_out", "uid", "n_tokens", "known", "base", "score", "tail"])

    schema = "doc_id bigint, held_out boolean, uid binary, n_tokens bigint, known bigint, base double, score double, tail array<struct<word:string,times:bigint>>"
    scored = materialize(src.mapInArrow(run, schema))
    # rarer words meet their counts by a join; none of them has more than WORD_SHARE of the training words
    tail = scored.select("uid", F.explode("tail").alias("t")).select("uid", "t.word", "t.times").join(counts, "word", "left")
    n = F.coalesce("n", F.lit(0))
    tail = tail.groupBy("uid").agg(F.sum(F.col("times") * (F.log10(n + F.lit(1.0)) - F.lit(float(spread)))).alias("tail_base"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("tail_known"))
    end = float(np.log10(model.ends + 1.0) - spread)
    return scored.drop("tail").join(tail, "uid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0)) + int(model.ends > 0)).alias("n_known"),
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0)) + end).alias("base_score"),
        "score",
    )
