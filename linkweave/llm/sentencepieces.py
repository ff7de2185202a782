"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

All words of a batch lie in one flat numpy array of symbols. In each round every word finds its best
pair rank (a segmented minimum), merges all its pairs of that rank at once, leftmost first, and the
array is compacted; words without a pair left leave it. This equals merging one pair at a time
unless a merge makes a pair that is as good as the round's rank or better while the word has other
merges in the same round. Such words (runs of spaces, mainly) are seen in the round itself and are
done one merge at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.vocab import BYTE, CONTROL, NORMAL, SPACE, UNKNOWN, KeyIndex, PieceVocab, WordCodes, text_slices

#: Characters encoded at once, and words whose pieces are kept at most (bounded memory of a worker).
BATCH_CHARS, CACHED_WORDS, CACHED_CHARS = 1_000_000, 200_000, 8_000_000
NONE = np.iinfo(np.int32).max


class Merger:
    """Symbols are piece ids, or len(pieces) + code point for characters that are no piece."""

    def __init__(self, vocab: PieceVocab) -> None:
        self.vocab, self.n = vocab, len(vocab.pieces)
        self.width = self.n + 0x110000
        self.symbol_of = np.arange(self.n, self.width, dtype=np.int32)
        for p, i in vocab.normal.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        levels = {s: k for k, s in enumerate(sorted({vocab.scores[i] for i in vocab.normal.values()}, reverse=True))}
        pairs = {}
        for p, i in vocab.normal.items():
            for cut in range(1, len(p)):
                left, right = self._symbol(p[:cut]), self._symbol(p[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (levels[vocab.scores[i]], i)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.index = KeyIndex(keys[order])
        self.ranks = np.array([v[0] for v in pairs.values()], np.int32)[order]
        self.merged = np.array([v[1] for v in pairs.values()], np.int32)[order]
        self.table = pairs

    def _symbol(self, part: str) -> int | None:
        return int(self.symbol_of[ord(part)]) if len(part) == 1 else self.vocab.normal.get(part)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of each pair; rank NONE where the pair is no piece."""
        if not len(self.ranks):
            return np.full(len(left), NONE, np.int32), np.zeros(len(left), np.int32)
        at, hit = self.index.find(left.astype(np.int64) * self.width + right)
        return np.where(hit, self.ranks[at], NONE), self.merged[at]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat symbols, symbols of each word)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.symbol_of[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        alone = np.zeros(len(words), bool)
        last = np.ones(len(sym), bool)
        last[:-1] = word[1:] != word[:-1]
        rank, merged = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int32)
        inner = np.flatnonzero(~last)
        rank[inner], merged[inner] = self.lookup(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[starts, len(word)])
            best = np.repeat(np.minimum.reduceat(rank, starts), counts)
            over = best == NONE
            if over.any():
                done.append((word[over], sym[over]))
                sym, word, rank, merged, best = (x[~over] for x in (sym, word, rank, merged, best))
                if not len(sym):
                    break
            # pairs of the best rank; of overlapping ones every other, from the left
            sel = rank == best
            at = np.flatnonzero(sel)
            run = np.r_[True, np.diff(at) > 1]
            first = at[run]
            at = at[((at - np.repeat(first, np.diff(np.r_[np.flatnonzero(run), len(at)]))) & 1) == 0]
            level = best[at]
            sym[at] = merged[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            sym, word, rank, merged = sym[keep], word[keep], rank[keep], merged[keep]
            new = place[at]
            # only pairs beside a merged symbol change
            for k in (new, new - 1):
                ok = k >= 0
                i, lv = k[ok], level[ok]
                inside = (i + 1 < len(sym)) & (word[np.minimum(i + 1, len(sym) - 1)] == word[i])
                rank[i[~inside]] = NONE
                i, lv = i[inside], lv[inside]
                rank[i], merged[i] = self.lookup(sym[i], sym[i + 1])
                if (early := rank[i] <= lv).any():
                    hit = np.unique(word[i[early]])
                    own, times = np.unique(word[new], return_counts=True)
                    alone[hit[times[np.searchsorted(own, hit)] > 1]] = True
        word, sym = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (word, sym)
        if alone.any():
            ok = ~alone[word]
            slow = [(w, self.one_by_one(words[w])) for w in np.flatnonzero(alone)]
            word = np.concatenate([word[ok], *(np.full(len(s), w, np.int32) for w, s in slow)])
            sym = np.concatenate([sym[ok], *(np.array(s, np.int32) for _, s in slow)])
        order = np.argsort(word, kind="stable")
        return self.to_bytes(sym[order], word[order], len(words))

    def one_by_one(self, text: str) -> list[int]:
        """The best pair first, of equal ones the leftmost, one merge at a time."""
        sym: list[int | None] = [int(self.symbol_of[ord(c)]) for c in text]
        after, before = [*range(1, len(sym)), -1], [*range(-1, len(sym) - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.table.get(sym[i] * self.width + sym[j])):
                heapq.heappush(heap, (found[0], i, sym[i], sym[j], found[1]))

        for i in range(len(sym) - 1):
            offer(i, i + 1)
        while heap:
            _, i, left, right, to = heapq.heappop(heap)
            j = after[i]
            if sym[i] != left or j < 0 or sym[j] != right:
                continue
            sym[i], sym[j], after[i] = to, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s in sym if s is not None]

    def to_bytes(self, sym: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become byte pieces."""
        out = sym >= self.n
        if not out.any():
            return sym.astype(np.int32), np.bincount(word, minlength=n_words)
        points = (sym[out] - self.n).astype(np.uint32)
        each = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        times = np.ones(len(sym), np.int64)
        times[out] = each
        flat, owner = np.repeat(sym, times), np.repeat(word, times)
        raw = points.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
        flat[np.repeat(out, times)] = self.vocab.byte_ids[np.frombuffer(raw, np.uint8)]
        return flat.astype(np.int32), np.bincount(owner, minlength=n_words)


class Encoder:
    """Encodes texts; the pieces of words are kept, up to a bound."""

    def __init__(self, vocab: PieceVocab) -> None:
        self.vocab, self.merger = vocab, Merger(vocab)
        self.clear()

    def clear(self) -> None:
        self.codes, self.chars = WordCodes(), 0
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets of the texts)."""
        if len(self.codes) > CACHED_WORDS or self.chars > CACHED_CHARS:
            self.clear()
        code_of, counts, parts = self.codes.__getitem__, [], []
        for t in texts:
            words = self.vocab.words(t)
            counts.append(len(words))
            parts.append(np.fromiter(map(code_of, words), np.int32, len(words)))
        if self.codes.fresh:
            flat, sizes = self.merger.encode(self.codes.fresh)
            ends = np.cumsum(sizes)
            self.starts = np.r_[self.starts, len(self.flat) + ends - sizes]
            self.sizes, self.flat = np.r_[self.sizes, sizes], np.r_[self.flat, flat]
            self.chars += sum(map(len, self.codes.fresh))
            self.codes.fresh = []
        codes = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[codes] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.flat[at], np.r_[0, np.r_[0, ends][np.cumsum(counts, dtype=np.int64)]] if counts else np.zeros(1, np.int64)


class Decoder:
    """Decodes ids as the library's decode(ids) does."""

    def __init__(self, vocab: PieceVocab) -> None:
        self.kinds = np.array(vocab.kinds, np.int8)
        bytes_of = [b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else bytes([int(p[3:-1], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() for p, k in zip(vocab.pieces, vocab.kinds, strict=True)]
        self.sizes = np.array([len(b) for b in bytes_of], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.leads = np.array([k == NORMAL and p.startswith(SPACE) for p, k in zip(vocab.pieces, vocab.kinds, strict=True)])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        kinds = self.kinds[ids]
        sizes, starts = self.sizes[ids], self.starts[ids]
        # the dummy space: one mark in front of the first piece that is no control piece
        shown = np.flatnonzero(kinds != CONTROL)
        first = np.searchsorted(shown, offsets[:-1])
        ok = first < len(shown)
        at = shown[first[ok]]
        at = at[(at < offsets[1:][ok]) & self.leads[ids[at]]]
        starts[at] += 1
        sizes[at] -= 1
        ends = np.cumsum(sizes)
        data = self.data[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        bounds = np.r_[0, ends][offsets]
        has_bytes = np.zeros(len(offsets) - 1, bool)
        has_bytes[np.searchsorted(offsets, np.flatnonzero(kinds == BYTE), "right") - 1] = True
        bad = {}
        controls = np.flatnonzero(kinds == CONTROL)
        for i in np.flatnonzero(has_bytes):
            a, b = np.searchsorted(controls, offsets[i : i + 2])
            cuts = [bounds[i], *ends[controls[a:b]], bounds[i + 1]]  # byte pieces don't join across a control piece
            parts = [data[x:y].tobytes() for x, y in zip(cuts, cuts[1:], strict=False)]
            try:
                for p in parts:
                    p.decode("utf-8")
            except UnicodeDecodeError:
                bad[i] = "".join(map(mend, parts))
        if bad:
            return pa.array([bad[i] if i in bad else data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8") for i in range(len(offsets) - 1)], pa.large_string())
        return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def mend(raw: bytes) -> str:
    """U+FFFD for each byte that begins no whole character."""
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + n].decode("utf-8"))
                i += n
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            i += 1
    return "".join(out)


def encode_documents(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, ids (array<int>) and decoded for each row; without begin or end ids.

    Null and empty texts have no ids and decode to the empty text. Every row gives one row, repeated
    ones too; other columns are ignored. Texts are whole; memory is bounded by a batch of texts.
    """
    vocab = PieceVocab.load(model)
    src = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join([*(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep), "ids array<int>", "decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocab), Decoder(vocab)
        for batch in batches:
            for a, b in text_slices(batch.column(len(keep)), BATCH_CHARS):
                texts = batch.column(len(keep)).slice(a, b - a).to_pylist()
                ids, offsets = encoder.encode(texts)
                columns = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*columns, listed, decoder.decode(ids, offsets).cast(pa.string())], [*keep, "ids", "decoded"])

    return src.mapInArrow(run, schema)
