"""A piece vocabulary read from a SentencePiece model file: what encoding, decoding and counting share."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = "▁"
NORMAL, CONTROL, UNKNOWN, BYTE = 0, 1, 2, 3


@dataclass(frozen=True)
class PieceVocab:
    """Pieces with scores and kinds, by id. Small and the same whatever the data; it travels with the task."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    source: str = ""

    @classmethod
    def load(cls, path: str) -> PieceVocab:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        kinds = [CONTROL if sp.is_control(i) else UNKNOWN if sp.is_unknown(i) else BYTE if sp.is_byte(i) else NORMAL for i in ids]
        return cls([sp.id_to_piece(i) for i in ids], [sp.get_score(i) for i in ids], kinds, path)

    @cached_property
    def normal(self) -> dict[str, int]:
        return {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}

    @cached_property
    def byte_ids(self) -> np.ndarray:
        out = np.zeros(256, np.int32)
        for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)):
            if k == BYTE:
                out[int(p[3:-1], 16)] = i
        return out

    @cached_property
    def splitter(self) -> re.Pattern:
        """Cuts a normalized text where no piece can reach across.

        A piece has space marks only at its front, and only the characters of pieces of two or more
        characters can join others. Checked here; otherwise the text stays in one part.
        """
        many = [p for p in self.normal if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in many):
            return re.compile(r"(?s).+")
        inside = re.escape("".join(sorted({c for p in many for c in p} - {SPACE})))
        return re.compile(f"{SPACE}*[{inside}]+|{SPACE}+|[^{SPACE}{inside}]+")

    def normalize(self, text: str | None) -> str:
        """The model's identity rule: a dummy space in front, spaces as marks; an empty text stays empty."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def words(self, text: str | None) -> list[str]:
        return self.splitter.findall(self.normalize(text))


class WordCodes(dict):
    """word -> code; a word not seen before gets the next code and is put in `fresh`."""

    def __init__(self, known: dict | None = None) -> None:
        super().__init__(known or {})
        self.fresh: list = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.fresh.append(word)
        return code


def text_slices(texts: pa.Array, most: int) -> list[tuple[int, int]]:
    """Ranges of rows of at most `most` characters together, or one row."""
    out, start, total = [], 0, 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
        if total + n > most and i > start:
            out.append((start, i))
            start, total = i, 0
        total += n
    return [*out, (start, len(texts))] if start < len(texts) else out


class KeyIndex:
    """The places of int64 keys in a sorted array, by hashing; keys that share a slot are searched for."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys if len(keys) else np.array([-1], np.int64)
        bits = max(4, int(4 * len(self.keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        slot, place = self._slot(self.keys), np.arange(len(self.keys), dtype=np.int32)
        self.table = np.full(1 << bits, -1, np.int32)
        self.table[slot[::-1]] = place[::-1]
        lost = self.table[slot] != place
        self.late, self.late_at = self.keys[lost], place[lost]
        self.shared = np.zeros(1 << bits, bool)
        self.shared[slot[lost]] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a place for each key, whether the key is there)."""
        slot = self._slot(keys)
        at = np.maximum(self.table[slot], 0)
        hit = self.keys[at] == keys
        if len(self.late):
            rest = np.flatnonzero(self.shared[slot] & ~hit)
            place = np.minimum(np.searchsorted(self.late, keys[rest]), len(self.late) - 1)
            ok = self.late[place] == keys[rest]
            at[rest[ok]], hit[rest[ok]] = self.late_at[place[ok]], True
        return at, hit
