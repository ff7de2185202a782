"""Token counts of a unigram vocabulary: Viterbi that carries the best score and the piece count only.

An Aho-Corasick automaton enumerates the pieces that end at each character, the longest first, so
that of equal scores the earliest start stays, as in the tokenizer: a later candidate must be better,
not equal. A character that is no piece costs the lowest score less 10 and counts its UTF-8 bytes
(byte fallback). Scores are summed in float64.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.vocab import PieceVocab, WordCodes, text_slices

BATCH_CHARS, CACHED_WORDS, CACHED_CHARS, UNKNOWN_PENALTY = 4_000_000, 300_000, 16_000_000, 10.0


class Counter:
    def __init__(self, vocab: PieceVocab) -> None:
        self.vocab = vocab
        self.automaton = ahocorasick.Automaton()
        for p, i in vocab.normal.items():
            self.automaton.add_word(p, (len(p), vocab.scores[i]))
        self.automaton.make_automaton()
        self.singles = {p for p in vocab.normal if len(p) == 1}
        self.unknown = min(vocab.scores[i] for i in vocab.normal.values()) - UNKNOWN_PENALTY
        self.clear()

    def clear(self) -> None:
        self.codes, self.chars = WordCodes(), 0
        self.counts, self.scores = np.zeros(0, np.int64), np.zeros(0)

    def best(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation."""
        n, low = len(word), float("-inf")
        score, count = [0.0] + [low] * n, [0] * (n + 1)
        other = {i: len(c.encode()) for i, c in enumerate(word) if c not in self.singles}
        done = 0
        for end, (size, own) in self.automaton.iter(word):
            if other:
                while done <= end:  # ends before this one are settled
                    if done < end and done in other and score[done] + self.unknown > score[done + 1]:
                        score[done + 1], count[done + 1] = score[done] + self.unknown, count[done] + other[done]
                    if done == end:
                        break
                    done += 1
            start = end + 1 - size
            if score[start] + own > score[end + 1]:
                score[end + 1], count[end + 1] = score[start] + own, count[start] + 1
        if other:
            for i in range(done, n):
                if i in other and score[i] + self.unknown > score[i + 1]:
                    score[i + 1], count[i + 1] = score[i] + self.unknown, count[i] + other[i]
        return count[n], score[n]

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.codes) > CACHED_WORDS or self.chars > CACHED_CHARS:
            self.clear()
        code_of, sizes, parts = self.codes.__getitem__, [], []
        for t in texts:
            words = self.vocab.words(t)
            sizes.append(len(words))
            parts.append(np.fromiter(map(code_of, words), np.int32, len(words)))
        if fresh := self.codes.fresh:
            found = [self.best(w) for w in fresh]
            self.counts = np.r_[self.counts, [c for c, _ in found]].astype(np.int64)
            self.scores = np.r_[self.scores, [s for _, s in found]]
            self.chars += sum(map(len, fresh))
            self.codes.fresh = []
        return np.array([self.counts[p].sum() for p in parts], np.int64), np.array([self.scores[p].sum() for p in parts])


def count_tokens(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, n_tokens long and best_score double for each row, over whole texts.

    Null and empty texts have 0 tokens and score 0. Repeated rows each give a row; other columns are
    ignored. Scores are summed over words in float64, which is exact for whole-numbered scores.
    """
    vocab = PieceVocab.load(model)
    src = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join([*(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep), "n_tokens bigint", "best_score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocab)
        for batch in batches:
            for a, b in text_slices(batch.column(len(keep)), BATCH_CHARS):
                texts = batch.column(len(keep)).slice(a, b - a).to_pylist()
                counts, scores = counter.count(texts)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(len(keep))), pa.array(counts), pa.array(scores)], [*keep, "n_tokens", "best_score"])

    return src.mapInArrow(run, schema)
