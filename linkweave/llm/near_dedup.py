"""Near-duplicate documents: MinHash signatures and a multi-index Hamming join.

A signature has 50 positions of 16 bits. It is split into 10 chunks of 5 positions. If two signatures
differ in at most 19 positions, some chunk differs in at most one (pigeonhole), so that the allowed
error of a chunk is enumerated by leaving out each of its positions in turn: 50 keys a document, and
every pair within that distance shares one. At a similarity of 0.75 a pair shares no key with a
probability of under 1 in 20,000; nearer pairs practically always share one.

Candidates are confirmed on full sets, and no pair is confirmed twice over where it can't matter:

1. Documents with equal sets are one class; only its smallest doc_id goes on.
2. Each member of a bucket (the documents of one key) is confirmed against the bucket's smallest
   member. These links already join most copies.
3. Only buckets whose members are still in several components are left. There every pair across
   components is confirmed: in small buckets pair by pair, less those that a bound on the
   intersection rules out; in large ones block against block, so that rows grow with the blocks.
   Afterwards no pair that shares a key is unlinked, unless it is confirmed to be below the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import materialize, maybe_in
from linkweave.llm.components import connected_components
from linkweave.llm.shingles import Shingler, mix, signatures
from linkweave.llm.vocab import text_slices

POSITIONS, CHUNK, PERCENT = 50, 5, 75
#: Members up to which a bucket's pairs are joined; members of a block in larger buckets.
SMALL_BUCKET, BLOCK = 64, 64
BATCH_CHARS = 1_000_000
#: Pairs, and shingles of two blocks, that are looked at together.
PAIRS_AT_ONCE, VALUES_AT_ONCE = 1_000_000, 8192
#: Classes whose keys one task makes, about.
REPS_A_TASK = 20_000


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fingerprint (of the set) and signature; the last two null for empty sets."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for a, b in text_slices(batch.column(1), BATCH_CHARS):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                sets = [shingler.set(t) for t in texts]
                full = [s for s in sets if len(s)]
                signed = iter(signatures(full, POSITIONS) if full else ())
                rows = [(xxhash.xxh3_128_digest(s.tobytes()), next(signed).tobytes()) if len(s) else (None, None) for s in sets]
                prints, signs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())], ["doc_id", "n_shingles", "fingerprint", "signature"])

    return src.mapInArrow(run, "doc_id bigint, n_shingles bigint, fingerprint binary, signature binary")


def bucket_keys(signed: np.ndarray) -> np.ndarray:
    """The keys of signatures: one for each chunk and left-out position."""
    chunks = signed.reshape(len(signed), -1, CHUNK).astype(np.uint64)
    keys = np.empty((len(signed), chunks.shape[1] * CHUNK), np.uint64)
    for c in range(chunks.shape[1]):
        for out in range(CHUNK):
            h = np.full(len(signed), c * CHUNK + out + 1, np.uint64)
            for p in range(CHUNK):
                if p != out:
                    h = mix(h * np.uint64(65537) + chunks[:, c, p])
            keys[:, c * CHUNK + out] = h
    return keys


def buckets(reps: DataFrame) -> DataFrame:
    """key, rep for each key of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, POSITIONS)
            keys = bucket_keys(signed)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))], ["key", "rep"])

    return reps.select("rep", "signature").mapInArrow(run, "key bigint, rep bigint")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """rep, shingles (sorted, distinct) of documents (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for a, b in text_slices(batch.column(1), BATCH_CHARS):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                sets = [shingler.set(t) for t in texts]
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["rep", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, "rep bigint, shingles array<bigint>")


def similar(both: Column, a: Column, b: Column) -> Column:
    return both * 100 >= (a + b - both) * PERCENT


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("rep").alias("v"), F.col("shingles").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    return pairs.join(right, "v").join(left, "u").where(similar(both, F.size("su"), F.size("sv"))).select("u", "v").distinct()


def pairs_of_small(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) across components in one bucket that may be similar.

    Shingles that no other open text has can't be in an intersection, which bounds it. Texts that
    share a doc_id have a bound each. A text too many among the open ones only loosens the bound.
    """
    own = maybe_in(sets, "rep", members.select("rep")).withColumn("print", F.xxhash64("shingles"))
    alone = own.select("rep", "print", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n"), F.min("rep").alias("rep"), F.min("print").alias("print")).where("n = 1").groupBy("rep", "print").agg(F.count("*").alias("alone"))
    sizes = own.select("rep", "print", F.size("shingles").alias("n")).join(alone, ["rep", "print"], "left").select("rep", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))
    docs = members.join(sizes, "rep").groupBy("key").agg(F.collect_list(F.struct("rep", "component", "n", "shared")).alias("docs")).select("docs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy().astype(np.int64)
            rep, component, n, shared = (x.to_numpy() for x in batch.column(0).flatten().flatten())
            for a, b in pair_places(sizes):
                bound = np.minimum(shared[a], shared[b])
                ok = (component[a] < component[b]) & (bound * 100 >= (n[a] + n[b] - bound) * PERCENT)
                u, v = rep[a[ok]], rep[b[ok]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

    return docs.mapInArrow(run, "u bigint, v bigint").distinct()


def pair_places(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of first, places of second) of all ordered pairs within groups of the given sizes, joined end to end; a bounded number at once."""
    if not len(sizes):
        return
    ends = np.cumsum(sizes)
    step = np.cumsum(sizes * sizes) // PAIRS_AT_ONCE
    for own in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(step)) + 1):
        size, first = sizes[own], ends[own] - sizes[own]
        a = np.repeat(np.arange(first[0], first[0] + size.sum()), np.repeat(size, size))
        start = np.repeat(first, size * size)
        nth = np.arange(len(a)) - np.repeat(np.cumsum(size * size) - size * size, size * size)
        yield a, start + nth % np.repeat(size, size * size)


def links_of_large(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) across components in buckets of many members, confirmed block against block.

    Each pair of blocks is a join key of its own, so that one bucket's work is spread.
    """
    n = F.ceil(F.col("members") / BLOCK)
    rows = members.withColumn("blocks", n).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks")).join(maybe_in(sets, "rep", members.select("rep")), "rep")
    blocks = materialize(rows.groupBy("key", "blocks", "block").agg(F.collect_list(F.struct("rep", "component", "shingles")).alias("docs")))
    first = blocks.withColumn("other", F.explode(F.sequence("block", F.col("blocks") - 1)))
    second = blocks.select("key", F.col("block").alias("other"), F.col("docs").alias("others"))
    pairs = first.join(second, ["key", "other"]).select("docs", "others")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for left, right in zip(batch.column(0), batch.column(1), strict=True):
                found += block_links(*_arrays(left.values), *_arrays(right.values))
            if found:
                u, v = zip(*set(found), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return pairs.mapInArrow(run, "u bigint, v bigint").distinct()


def _arrays(docs: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    listed = docs.field("shingles")
    return docs.field("rep").to_numpy(), docs.field("component").to_numpy(), listed.value_lengths().to_numpy(), listed.flatten().to_numpy()


def block_links(reps: np.ndarray, comps: np.ndarray, sizes: np.ndarray, flat: np.ndarray, reps2: np.ndarray, comps2: np.ndarray, sizes2: np.ndarray, flat2: np.ndarray) -> list[tuple[int, int]]:
    """The similar pairs across components between two blocks, by their shared shingles."""
    if comps.min() == comps.max() == comps2.min() == comps2.max():
        return []
    values, code = np.unique(np.r_[flat, flat2], return_inverse=True)
    row = np.r_[np.repeat(np.arange(len(reps)), sizes), len(reps) + np.repeat(np.arange(len(reps2)), sizes2)]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    both = np.zeros((len(reps), len(reps2)), np.int64)
    for k in range(0, len(values), VALUES_AT_ONCE):  # so many shingles at once, so that long texts need no more memory
        lo, hi = np.searchsorted(code, (k, k + VALUES_AT_ONCE))
        has = np.zeros((len(reps) + len(reps2), VALUES_AT_ONCE), np.float32)
        has[row[lo:hi], code[lo:hi] - k] = 1
        both += np.rint(has[: len(reps)] @ has[len(reps) :].T).astype(np.int64)
    ok = (both * 100 >= (sizes[:, None] + sizes2[None] - both) * PERCENT) & (comps[:, None] != comps2[None])
    return [(int(min(reps[i], reps2[j])), int(max(reps[i], reps2[j]))) for i, j in np.argwhere(ok)]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of documents (doc_id, text).

    component_id is the smallest doc_id reachable over links of similarity 0.75 or more. Null, empty
    and blank texts have no shingles and link with nothing. Rows that share a doc_id are one node of
    all their texts' links. A row without doc_id links with nothing, has no component and is kept.
    Other columns are ignored; no rows give no rows.
    """
    signed = materialize(sign(docs))
    classes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("rep"), F.min("signature").alias("signature"))
    classes = materialize(classes)
    # a row makes many keys: small parts keep what a task gathers small
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), classes.count() // REPS_A_TASK)
    rows = buckets(classes.select("rep", "signature").repartition(parts))
    # most keys are of one class only: their rows stay out of the joins, and texts and sets that aren't needed out of shuffles
    rows = materialize(maybe_in(rows, "key", rows.groupBy("key").count().where("count > 1").select("key")))
    hubs = rows.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("members")).where("members > 1")
    open_rows = materialize(rows.join(hubs, "key"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    sets = materialize(shingle_sets(maybe_in(texts, "doc_id", open_rows.select("rep"))))
    stars = open_rows.where("hub <> rep").select(F.col("hub").alias("u"), F.col("rep").alias("v")).distinct()
    found = connected_components(confirm(stars, sets))
    # buckets whose members are in several components
    members = open_rows.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "members", F.coalesce("component", "rep").alias("component"))
    several = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    members = materialize(members.join(several, "key", "left_semi"))
    pairs = materialize(pairs_of_small(members.where(F.col("members") <= SMALL_BUCKET), sets))
    small = confirm(pairs, maybe_in(sets, "rep", pairs.select(F.explode(F.array("u", "v")))))
    large = links_of_large(members.where(F.col("members") > SMALL_BUCKET), sets)
    more = materialize(small.unionByName(large))
    if not more.isEmpty():
        found = connected_components(more.unionByName(found.select(F.col("node").alias("u"), F.col("component").alias("v"))))
    of_class = classes.select("fingerprint", "rep").join(found, F.col("rep") == F.col("node"), "left").select("fingerprint", F.coalesce("component", "rep").alias("component_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return signed.select("doc_id", "n_shingles", "fingerprint").join(of_class, "fingerprint", "left").select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
