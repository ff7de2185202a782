"""Benchmark decontamination by spaced seeds.

A mask picks some of the word positions of a window and ignores the others; windows of a document and
of a test item that agree on the picked words get the same hash. Each hash join hit names a diagonal
(document position less item position); along it all words are compared, and the best stretch of
matches and substitutions decides. The test set is a stated query set: it is broadcast in blocks of
bounded size, and all documents are read against each block.

The masks find every window of five words of which four are equal. So they miss no leak: a stretch of
n words without such a window has at most 3 equal words in each 5, and 3 in what is left, which is
under MIN_MATCHED up to 15 words and under MIN_SHARE of any longer stretch (and under SHORT_SHARE of
an item of 5 to 12 words). Items of under five words are looked up whole.

Where one word repeats, a hit follows from the hit one word before on the same diagonal. Such hits are
left out before they are listed, so that a run of n words on a run of m gives n + m hits, not n * m.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import materialize
from linkweave.llm.vocab import text_slices

#: Picked positions of each mask: five words of which an inner one may differ, or four in a row.
MASKS = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))
#: A leak has so many equal words (or four fifths of a shorter item), and this share of its stretch is equal.
MIN_MATCHED, MIN_SHARE, SHORT_SHARE = 10, 0.7, 0.8
#: Characters of test items in a block, and of documents that are looked through at once.
BLOCK_CHARS, BATCH_CHARS = 8_000_000, 1_000_000
#: Hits that are verified at once, and words that are compared at once: bounds of a task's memory.
HITS_AT_ONCE, VALUES_AT_ONCE = 1_000_000, 1_000_000
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def mixed(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of the words at the picked positions, in order."""
    h = np.full(len(columns[0]), 0x9E3779B97F4A7C15, np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


class SeedIndex:
    """Hashes of a block of test items: for each mask, and for whole items too short for the masks."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = [i for i, _ in items]
        self.vocab: dict[str, int] = {}
        own = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(t)], np.int64) for _, t in items]
        self.sizes = np.array([*map(len, own)], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate([*own, np.zeros(1, np.int64)])
        span = max(m[-1] for m in MASKS) + 1
        short = sorted({len(x) for x in own if 0 < len(x) < span})
        self.tables = []
        for mask, only in [*((m, None) for m in MASKS), *((tuple(range(n)), n) for n in short)]:
            hashes, owner, place, first = [], [], [], []
            for k, x in enumerate(own):
                n = len(x) - mask[-1]
                if n > 0 and only in (None, len(x)):
                    h = mixed([x[p : p + n] for p in mask])
                    hashes.append(h)
                    owner.append(np.full(n, k))
                    place.append(np.arange(n))
                    first.append(np.r_[True, h[1:] != h[:-1]])
            if hashes:
                h, owner, place, first = map(np.concatenate, (hashes, owner, place, first))
                order = np.argsort(h, kind="stable")
                every = (h[order], owner[order], place[order])
                self.tables.append((mask, every, tuple(c[first[order]] for c in every)))

    def hits(self, flat: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(word in flat, item, diagonal) of seed hits, about HITS_AT_ONCE at a time: each diagonal of a text that has one."""
        known = flat != 0
        for mask, every, firsts in self.tables:
            n = len(flat) - mask[-1]
            if n <= 0:
                continue
            ok = known[:n].copy()
            for p in mask[1:]:
                ok &= known[p : p + n]
            idx = np.flatnonzero(ok)
            h = mixed([flat[idx + p] for p in mask])
            again = np.zeros(len(idx), bool)
            again[1:] = (idx[1:] == idx[:-1] + 1) & (h[1:] == h[:-1])
            # where both the text's and the item's window equal the ones before, these are a hit on the same diagonal
            for part, (hashes, owner, place) in ((~again, every), (again, firsts)):
                at, own = idx[part], h[part]
                lo = np.searchsorted(hashes, own)
                times = np.searchsorted(hashes, own, "right") - lo
                hit = times > 0
                at, lo, times = at[hit], lo[hit], times[hit]
                total = np.cumsum(times)
                a = 0
                while a < len(at):
                    b = max(a + 1, int(np.searchsorted(total, total[a] - times[a] + HITS_AT_ONCE, "right")))
                    t = times[a:b]
                    entry = np.repeat(lo[a:b] - (np.cumsum(t) - t), t) + np.arange(t.sum())
                    word = np.repeat(at[a:b], t)
                    yield word, owner[entry], word - place[entry]
                    a = b

    def verified(self, flat: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word in item, stretch, equal words) of the best stretch along each diagonal, inside its text [begin, end)."""
        left, stretch, matched = (np.zeros(len(item), np.int64) for _ in range(3))
        order = np.argsort(self.sizes[item], kind="stable")
        a = 0
        while a < len(order):
            # rows by size: up to b rows of the size of the last are at most VALUES_AT_ONCE words
            sizes = self.sizes[item[order[a : a + VALUES_AT_ONCE]]]
            b = a + max(1, int(np.searchsorted(sizes * np.arange(1, len(sizes) + 1), VALUES_AT_ONCE, "right")))
            rows = order[a:b]
            a = b
            own, start = item[rows, None], diagonal[rows, None]
            col = np.arange(self.sizes[item[rows[-1]]])
            pos = start + col
            inside = (col < self.sizes[own]) & (pos >= begin[rows, None]) & (pos < end[rows, None])
            equal = flat[np.where(inside, pos, 0)] == self.words[np.where(inside, self.offsets[own] + col, 0)]
            total = np.zeros((len(rows), len(col) + 1), np.int32)
            np.cumsum(np.where(inside, np.where(equal, 1, -1), 0), axis=1, out=total[:, 1:])
            low = np.minimum.accumulate(total, axis=1)
            at, stop = np.arange(len(rows)), np.argmax(total - low, axis=1)
            first = np.maximum(np.argmax(total == low[at, stop][:, None], axis=1), begin[rows] - diagonal[rows])
            left[rows], stretch[rows] = first, stop - first
            matched[rows] = (stop - first + total[at, stop] - low[at, stop]) // 2
        return left, stretch, matched

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int, int, int]]:
        """(text, item id, item words, first word in text, first word in item, stretch, equal words), the best for each text and item."""
        get, parts, sizes = self.vocab.get, [np.zeros(1, np.int64)], []
        for t in texts:
            found = words_of(t)
            parts += [np.fromiter(map(get, found, repeat(0)), np.int64, len(found)), np.zeros(1, np.int64)]
            sizes.append(len(found))
        flat, sizes = np.concatenate(parts), np.array(sizes, np.int64)
        begins = 1 + np.cumsum(sizes + 1) - (sizes + 1)
        items, longest = len(self.ids), int(self.sizes.max(initial=0))
        wide = len(flat) + longest
        best = np.zeros((7, 0), np.int64)

        def better(codes: list[np.ndarray]) -> np.ndarray:
            """`best` with what the diagonals of these codes hold."""
            pair, diagonal = np.divmod(np.unique(np.concatenate(codes)), wide)
            text, item = np.divmod(pair, items)
            diagonal -= longest
            left, stretch, matched = self.verified(flat, begins[text], begins[text] + sizes[text], item, diagonal)
            # the share is compared as floats, as it is defined
            need = np.minimum(MIN_MATCHED, np.ceil(SHORT_SHARE * self.sizes[item]))
            ok = (matched >= need) & (matched >= MIN_SHARE * stretch)
            new = np.stack([text, item, -matched, diagonal + left - begins[text], diagonal, left, stretch])[:, ok]
            rows = np.concatenate([best, new], axis=1)
            rows = rows[:, np.lexsort(rows[4::-1])]
            return rows[:, np.r_[True, (rows[:2, 1:] != rows[:2, :-1]).any(0)][: rows.shape[1]]]

        waiting, n = [], 0
        for word, item, diagonal in self.hits(flat):
            waiting.append(((np.searchsorted(begins, word, "right") - 1) * items + item) * wide + diagonal + longest)
            n += len(word)
            if n >= HITS_AT_ONCE:
                best, waiting, n = better(waiting), [], 0
        if waiting:
            best = better(waiting)
        return [(t, self.ids[k], int(self.sizes[k]), place, left, stretch, -less) for t, k, less, place, _, left, stretch in best.T.tolist()]


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[tuple[SeedIndex, bool]]:
    """(an index of test items of about block_chars characters, whether there are several).

    What is broadcast at once is bounded. Of several, each block's results are to be written before the
    next is asked for, so that the driver and the plan hold one index at a time.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = math.ceil(total / block_chars)
    for b in range(n):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield SeedIndex(sorted((tuple(r) for r in own.collect()), key=lambda r: (r[0] is not None, r))), n > 1


LEAK = "item_id bigint, item_words int, doc_word int, item_word int, stretch int, matched int"


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document and test item that it holds: doc_id, item_id, the words' places, matched.

    Null and empty texts and items hold and leak nothing. Of several places the one with most equal
    words counts, of equal ones the first. Rows that repeat a doc_id are looked at one by one; other
    columns are ignored. No items or no documents: no rows.
    """
    src = docs.select("doc_id", F.col("text").cast("string").alias("__text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {LEAK}"
    out = None
    for index, several in blocks(benchmark, block_chars):
        def run(batches: Iterator[pa.RecordBatch], index: SeedIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b in text_slices(batch.column(1), BATCH_CHARS):
                    texts = batch.column(1).slice(a, b - a).to_pylist()
                    if rows := index.find(texts):
                        text, *rest = zip(*rows, strict=True)
                        types = [pa.int64(), *[pa.int32()] * 5]
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([a + t for t in text])), *(pa.array(c, t) for c, t in zip(rest, types, strict=True))], ["doc_id", "item_id", "item_words", "doc_word", "item_word", "stretch", "matched"])

        found = src.mapInArrow(run, schema)
        found = materialize(found) if several else found
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs, whole rows, without those that hold a test item (see find_leaks)."""
    out, at = docs, docs.columns.index("text")
    for index, several in blocks(benchmark, block_chars):
        def run(batches: Iterator[pa.RecordBatch], index: SeedIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b in text_slices(batch.column(at), BATCH_CHARS):
                    texts = batch.column(at).slice(a, b - a).to_pylist()
                    leaky = {r[0] for r in index.find(texts)}
                    yield batch.take(pa.array([i for i in range(a, b) if i - a not in leaky], pa.int64()))

        out = out.mapInArrow(run, docs.schema)
        out = materialize(out) if several else out
    return out
