"""Document fingerprints (I-Match) with DataFrame functions only.

The lexicon is the terms within a band of document frequency. A term of the lexicon is in at least
MIN_SHARE of all documents, so that the lexicon has at most (distinct terms of a mean document) /
MIN_SHARE terms, whatever the corpus holds; it is put into the plan as a constant set. A document's
distinct lexicon terms are sorted and hashed once for each of several random lexicon subsets, from
the whole lexicon to small ones. The likeness of two fingerprints is the share of equal slots among
the slots that either has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import WORD_BREAK, materialize

#: A term's share of all documents, in thousandths: at least, at most. And documents at least.
MIN_SHARE, MAX_SHARE, MIN_DOCS = 2, 50, 2
#: Of 128 equal parts of the lexicon, how many each subset keeps (each subset draws its own).
SUBSETS = (128, 32, 16, 8, 8, 4, 4, 4, 2, 2, 2, 2, 1, 1, 1, 1)
SLOT = 8


def terms(text: Column) -> Column:
    """Distinct words in lower case."""
    return F.array_distinct(F.filter(F.split(F.lower(text), WORD_BREAK), lambda t: t != ""))


def lexicon(texts: DataFrame) -> list[str]:
    """The terms of the band, from the distinct terms of all texts (a column text)."""
    counts = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    total = texts.count()
    band = counts.where((F.col("n") >= MIN_DOCS) & (F.col("n") * 1000 >= MIN_SHARE * total) & (F.col("n") * 1000 <= MAX_SHARE * total))
    return [r[0] for r in band.select("term").collect()]  # bounded, see above


def _literal(term: str) -> str:
    return "'" + term.replace("\\", "\\\\").replace("'", "\\'") + "'"


def slots(words: str, lexicon_sql: str) -> tuple[Column, list[Column]]:
    """(the sorted lexicon terms with their draws, from a column of terms; the hash of each subset, from column `picked`)."""
    known = F.array_sort(F.expr(f"filter({words}, t -> t IN ({lexicon_sql}))")) if lexicon_sql else F.array().cast("array<string>")
    draw = lambda t, at: F.conv(F.substring(F.md5(t.cast("binary")), at, 14), 16, 10).cast("long")
    picked = F.transform(known, lambda t: F.struct(t.alias("term"), draw(t, 1).alias("low"), draw(t, 17).alias("high")))

    def of(k: int, part: int) -> Column:
        mine = F.col("picked")
        if part < 128:
            field = lambda x: F.shiftright(x["low"] if k < 8 else x["high"], 7 * (k % 8)).bitwiseAND(127)
            mine = F.filter(mine, lambda x: field(x) < part)
        joined = F.array_join(F.transform(mine, lambda x: x["term"]), " ")
        return F.when(joined == "", F.lit("")).otherwise(F.substring(F.md5(joined.cast("binary")), 1, SLOT))

    return picked, [of(k, part) for k, part in enumerate(SUBSETS)]


def fingerprints(texts: DataFrame, text: str, words: list[str], to: str) -> DataFrame:
    """texts with a column `to`: the slots joined by '-', or a digest of the text where it has no lexicon term."""
    picked, hashes = slots("__terms", ", ".join(map(_literal, words)))
    wide = texts.withColumn("__terms", terms(F.col(text))).withColumn("picked", picked).drop("__terms")
    joined = F.array_join(F.array(*hashes), "-")
    return wide.withColumn(to, F.when(F.size("picked") > 0, joined).otherwise(F.concat(F.lit("text:"), F.md5(F.col(text).cast("binary"))))).drop("picked")


def likeness(a: Column, b: Column) -> Column:
    """Equal slots over slots that either has; texts without lexicon terms are alike if equal."""
    x, y = F.split(a, "-"), F.split(b, "-")
    both = F.arrays_zip(x.alias("x"), y.alias("y"))
    whole = a.startswith("text:") | b.startswith("text:")
    used = F.size(F.filter(both, lambda s: (s["x"] != "") | (s["y"] != "")))
    same = F.size(F.filter(both, lambda s: (s["x"] != "") & (s["x"] == s["y"])))
    return F.when(whole, (a == b).cast("double")).otherwise(same.cast("double") / used)


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text and digest with next_id and next_text: the document of the next doc_id, after the last the first.

    Documents are dealt into ranges of doc_id by quantiles, so that no task needs all rows in order;
    the first document of each range is also given to the range before it. Rows that share a doc_id
    follow each other by their digests. A row without doc_id has no next document.
    """
    known = docs.where("doc_id IS NOT NULL")
    cuts = known.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], 20 * parts)).first()[0] or []
    cuts = sorted(set(cuts))
    # two short searches in place of one long one
    step = max(1, int(len(cuts) ** 0.5))
    rows = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    under = lambda listed: F.size(F.filter(listed, lambda c: c <= F.col("doc_id")))
    longs = lambda values: F.array(*map(F.lit, values)).cast("array<bigint>")
    if rows:
        row = under(longs([r[0] for r in rows])) - 1
        place = F.when(row < 0, F.lit(0)).otherwise(row * step + under(F.get(F.array(*map(longs, rows)), row)))
    else:
        place = F.lit(0)
    dealt = docs.withColumn("part", F.when(F.col("doc_id").isNull(), -1 - F.pmod(F.crc32("digest"), F.lit(parts)).cast("int")).otherwise(place).cast("int"))
    firsts = dict(dealt.where("part >= 0").groupBy("part").agg(F.min("doc_id")).collect())  # a row for each range
    order = sorted(firsts)
    before = {firsts[p]: order[k - 1] for k, p in enumerate(order)}
    dealt = dealt.withColumn("head", F.lit(False))
    if before:
        at = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
        again = F.when(F.col("doc_id").isin(list(before)), F.array(F.struct("part", F.lit(False).alias("head")), F.struct(F.element_at(at, F.col("doc_id")).cast("int").alias("part"), F.lit(True).alias("head"))))
        dealt = dealt.select("doc_id", "text", "digest", F.explode(F.coalesce(again, F.array(F.struct("part", "head")))).alias("p")).select("doc_id", "text", "digest", "p.part", "p.head")
    nxt = lambda c: F.expr(f"IF(part < 0, NULL, lead({c}) OVER (PARTITION BY part ORDER BY head, doc_id, digest))")
    return dealt.withColumns({"next_id": nxt("doc_id"), "next_text": nxt("text")}).where("NOT head").drop("head", "part")


def fingerprint_documents(docs: DataFrame, edited_part: int = 4, parts: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last 1/edited_part replaced by the front of the next document. Null texts
    count as empty. Repeated rows each give a row. Without a next document (no doc_id) nothing is put
    in and near_next is null. Other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = lexicon(texts)
    rows = with_next(texts.withColumn("digest", F.md5(F.col("text").cast("binary"))), parts)
    n, cut = F.length("text"), F.floor(F.length("text") / edited_part).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - cut), F.coalesce(F.col("next_text"), F.lit("")).substr(F.lit(1), cut))
    rows = rows.select("doc_id", "text", "digest", "next_id", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = fingerprints(fingerprints(rows, "text", words, "fingerprint"), "edited", words, "edited_fingerprint")
    done = materialize(rows.select("doc_id", "digest", "next_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint"))
    # of rows that share a doc_id, the first in order stands for the next document
    first = done.groupBy(F.col("doc_id").alias("next_id")).agg(F.min_by("fingerprint", "digest").alias("next_print"))
    joined = done.join(first, "next_id", "left")
    return joined.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"))
