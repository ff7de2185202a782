"""MinHash-LSH blocking over character n-grams, with AND-OR banding."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.functions.text import PRIME, char_ngrams, portable_hash, record_text
from linkweave.operators.blocks import count_met, listed


def _portable(text: str) -> int:
    import hashlib

    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


@lru_cache
def coefficients(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    """a and b of (a * h + b) mod PRIME for each permutation; a replayable draw."""
    a = [1 + _portable(f"a{k}") % (PRIME - 1) for k in range(permutations)]
    b = [_portable(f"b{k}") % PRIME for k in range(permutations)]
    return np.array(a, np.int64), np.array(b, np.int64)


@lru_cache
def best_bands(threshold: float, permutations: int = 64) -> tuple[int, int]:
    """(bands, rows) with the least mean of false positive and false negative area."""
    s = np.linspace(0.0, 1.0, 4001)
    below, above = s <= threshold, s >= threshold
    best, found = np.inf, (1, 1)
    area = lambda y, part: float(((y[part][1:] + y[part][:-1]) / 2 * np.diff(s[part])).sum())
    for b in range(1, permutations + 1):
        for r in range(1, permutations // b + 1):
            p = 1 - (1 - s**r) ** b
            cost = 0.5 * area(p, below) + 0.5 * area(1 - p, above)
            if cost < best:
                best, found = cost, (b, r)
    return found


def hit_probability(similarity: float, bands: int, rows: int, hits: int = 1) -> float:
    from math import comb

    p = similarity**rows
    return 1 - sum(comb(bands, k) * p**k * (1 - p) ** (bands - k) for k in range(hits))


def shingle_hashes(records: DataFrame, n: int = 3) -> DataFrame:
    """entity_id, country, hashes for records with text; the others have no signature."""
    text = record_text(F.col("name"), F.col("address"))
    return records.where(text != "").select("entity_id", "country", F.transform(char_ngrams(text, n), lambda g: portable_hash(g) % PRIME).alias("hashes"))


def signatures(records: DataFrame, permutations: int = 64, n: int = 3) -> DataFrame:
    """entity_id, country, signature: the minimum of each permutation, in numpy over Arrow batches."""
    a, b = coefficients(permutations)

    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(2)
            sizes = listed.value_lengths().to_numpy()
            if not len(sizes):
                continue
            flat, starts = listed.flatten().to_numpy(), np.cumsum(sizes) - sizes
            signed = np.stack([np.minimum.reduceat((flat * x + y) % PRIME, starts) for x, y in zip(a, b, strict=True)], 1)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, signed.size + 1, permutations, dtype=np.int32)), pa.array(signed.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows], ["entity_id", "country", "signature"])

    return shingle_hashes(records, n).mapInArrow(minima, f"entity_id {records.schema['entity_id'].dataType.simpleString()}, country string, signature array<bigint>")


def band_keys(signed: DataFrame, bands: int, rows: int) -> DataFrame:
    """entity_id, country, band, key."""
    key = lambda b: F.array_join(F.slice("signature", b * rows + 1, rows), "-")
    listed = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(b.alias("band"), key(b).alias("key")))
    return signed.select("entity_id", "country", F.explode(listed).alias("k")).select("entity_id", "country", "k.band", "k.key")


def lsh_block(s1: DataFrame, pool: DataFrame, threshold: float = 0.3, permutations: int = 64, n: int = 3, min_hits: int = 1, most: int = 0) -> DataFrame:
    """s1_id, cand_id, hits: bands shared within a country, at least min_hits; most > 0: the top by (hits, id)."""
    return lsh_in_blocks(s1, pool, threshold, permutations, n, min_hits, most).drop("block")


def lsh_in_blocks(s1: DataFrame, pool: DataFrame, threshold: float = 0.3, permutations: int = 64, n: int = 3, min_hits: int = 1, most: int = 0) -> DataFrame:
    """lsh_block with the column block, by which the rows lie."""
    bands, rows = best_bands(threshold, permutations)
    on = ["country", "band", "key"]
    q = band_keys(signatures(s1, permutations, n), bands, rows).withColumnRenamed("entity_id", "s1_id")
    c = listed(band_keys(signatures(pool, permutations, n), bands, rows), on)
    found = count_met(q, c, on, "hits").withColumnRenamed("found", "cand_id").where(F.col("hits") >= min_hits)
    if most <= 0:
        return found
    return found.withColumn("rank", F.expr("row_number() OVER (PARTITION BY block, s1_id ORDER BY hits DESC, cand_id)")).where(F.col("rank") <= most).drop("rank")
