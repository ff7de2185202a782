"""The registry of queries over the driver's tables, with their oracle SQL.

Records come from documents (linkweave.sources.derived). The caps of keys are the operators' own; the share of
a key, the fallback and the number of candidates fit those small tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.functions import text as T
from linkweave.oracle import ORACLE_SQL
from linkweave.operators import decide, features, fused, fusion, knn, learn, lsh, metrics, token_block, validate
from linkweave.sources.derived import records, sides, truth
from linkweave.sources.shared import shared_dir
from linkweave.sources.tables import candidate_lists as to_lists
from linkweave.sources.tables import read_candidates, read_ids, read_records, read_truth, record_stats, select_records, union_sources, write_split, write_tsv
from linkweave.sources.token_store import load_index, save_index
from linkweave.streaming.incremental import resolve_stream

LIMITS = token_block.Limits(0.05, 5000, 1.0, 5000, 1.0, 5000, fallback=5)
CAP, QUOTA, NEIGHBOURS = 5, 0.3, 10
THRESHOLDS, CAPS, RANKS = [0.2, 0.4, 0.6, 0.8], [1, 2, 4], [2, 5]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable) -> Callable:
    QUERIES[f.__name__] = f
    return f


def over_sides(f: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(*sides(spark, sf_dir))

    QUERIES[f.__name__] = run
    return f


def over_records(f: Callable[[DataFrame], DataFrame]) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(records(spark, sf_dir))

    QUERIES[f.__name__] = run
    return f


# text


@over_records
def normalize_names(r):
    return r.select("entity_id", "text")


@over_records
def token_sets(r):
    return r.select("entity_id", F.array_join(T.token_set(F.col("text")), " ").alias("tokens"))


@over_records
def token_pairs(r):
    pairs = T.token_pairs(T.token_set(F.col("text")))
    return r.select("entity_id", F.size(pairs).alias("n_pairs"), F.array_join(pairs, "|").alias("pairs"))


@over_records
def char_shingles(r):
    grams = T.char_ngrams(F.col("text"))
    return r.select("entity_id", F.size(grams).alias("n_shingles"), F.md5(F.array_join(F.array_sort(grams), "|").cast("binary")).alias("shingles_md5"))


@query
def digit_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", F.array_join(T.digit_runs(T.normalize(F.col("text"))), " ").alias("runs"))


@over_records
def country_keys(r):
    return r.groupBy("country").agg(F.count("*").alias("n")).select("country", T.country_key(F.col("country")).alias("country_key"), T.country_digest(F.col("country")).alias("digest"), "n")


@over_records
def portable_hashes(r):
    return r.select("entity_id", T.portable_hash(F.col("entity_id")).alias("hash"))


# sources and set operations


@over_records
def record_statistics(r):
    return record_stats(r)


@over_records
def country_totals(r):
    return token_block.country_totals(r.where("src > 1"))


@over_records
def country_shares(r):
    return learn.shares(r, "country")


@over_records
def source_union(r):
    both = union_sources(r.where("src = 2"), r.where("src = 3"))
    return both.groupBy("src", "country").agg(F.count("*").alias("n"))


def _source_tokens(r, src):
    return r.where(F.col("src") == src).select("country", F.explode(T.token_set(F.col("text"))).alias("token"))


@over_records
def token_union(r):
    return _source_tokens(r, 2).union(_source_tokens(r, 3)).distinct()


@over_records
def token_intersection(r):
    return _source_tokens(r, 1).intersect(_source_tokens(r, 2))


@over_records
def token_difference(r):
    return _source_tokens(r, 1).subtract(_source_tokens(r, 2))


@over_sides
def missing_ids_anti(s1, pool):
    met = token_hits(s1, pool).select(F.col("s1_id").alias("entity_id")).distinct()
    return s1.select("entity_id").join(met, "entity_id", "left_anti")


# token blocking


@over_sides
def token_doc_freq(s1, pool):
    return token_block.document_frequency(token_block.key_table(pool, "token"), token_block.key_table(s1, "token"))


@over_sides
def token_kept(s1, pool):
    return token_block.kept_keys(token_doc_freq(s1, pool), token_block.country_totals(pool), LIMITS.token_share, LIMITS.token_cap)


@over_sides
def exact_block(s1, pool):
    index = token_block.TokenIndex.build(s1, pool, LIMITS)
    return token_block.meet(token_block.key_table(s1, "exact"), index.exact, "hits").select("s1_id", "cand_id")


@over_sides
def pair_block(s1, pool):
    index = token_block.TokenIndex.build(s1, pool, LIMITS)
    return token_block.meet(token_block.key_table(s1, "pair", LIMITS), index.pairs, "pair_hits")


def _token_hits(s1, pool):
    index = token_block.TokenIndex.build(s1, pool, LIMITS)
    return token_block.meet_in_blocks(token_block.key_table(s1, "token"), token_block.lists_of(index.tokens), "token_hits")


def token_hits(s1, pool):
    return _token_hits(s1, pool).drop("block")


QUERIES["token_block"] = lambda spark, sf_dir: token_hits(*sides(spark, sf_dir))


@over_sides
def hybrid_block_scored(s1, pool):
    return token_block.hybrid_block(s1, pool, LIMITS)


@over_sides
def stored_token_index(s1, pool):
    """hybrid_block_scored through an index that is written and read back."""
    path = shared_dir(s1.sparkSession)
    save_index(pool, path, LIMITS)
    return token_block.hybrid_block(s1, load_index(s1.sparkSession, path, LIMITS), LIMITS)


@over_sides
def candidate_lists(s1, pool):
    found = token_block.hybrid_in_blocks(s1, pool, LIMITS).withColumn("place", F.struct(-F.col("score"), "cand_id"))
    return to_lists(found, s1, "place")


# LSH


def _whole(r):
    """Records whose only field is the whole text."""
    return r.select("entity_id", "country", F.col("text").alias("name"), F.lit("").alias("address"))


@over_records
def minhash_signature(r):
    return lsh.signatures(_whole(r)).select("entity_id", F.array_join("signature", "-").alias("signature"))


@query
def lsh_parameters(spark, sf_dir):
    rows = ", ".join(f"({t}D, {lsh.best_bands(t)[0]}, {lsh.best_bands(t)[1]})" for t in (0.3, 0.4, 0.5))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(threshold, bands, band_rows)")


@over_records
def lsh_bands(r):
    return lsh.band_keys(lsh.signatures(_whole(r)), *lsh.best_bands(0.3)).select("entity_id", "band", "key")


@over_sides
def lsh_candidates(s1, pool):
    return lsh.lsh_block(s1, pool)


@over_sides
def lsh_min_hits_topk(s1, pool):
    return lsh.lsh_block(s1, pool, min_hits=2, most=5)


# vectors


def _vectors(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    base = rows.select(F.col("vec_id").alias("cand_id"), F.col("embedding").alias("vector"), F.col("label").alias("part"))
    return base.where("cand_id % 20 = 0").withColumnRenamed("cand_id", "s1_id"), base


@query
def knn_topk(spark, sf_dir):
    return knn.flat_knn(*_vectors(spark, sf_dir), 10).select("s1_id", "cand_id", "rank", F.round("score", 6).alias("score"))


@query
def ivf_knn(spark, sf_dir):
    return knn.ivf_knn(*_vectors(spark, sf_dir), 10)


def _sparse_parts(s1, pool):
    keys = lambda df: token_block.key_table(df.drop("name").withColumnRenamed("address", "name"), "token")
    q, c = keys(s1), keys(pool)
    kept = token_block.kept_keys(token_block.document_frequency(c, q), token_block.country_totals(pool), LIMITS.token_share, LIMITS.token_cap)
    sizes = lambda df: df.groupBy("entity_id").agg(F.count("*").alias("n"))
    return q, c.join(kept.select("country", "key"), ["country", "key"]), sizes(q), sizes(c)


def _sparse(s1, pool):
    return knn.sparse_in_blocks(*_sparse_parts(s1, pool), NEIGHBOURS)


@over_sides
def sparse_knn(s1, pool):
    return _sparse(s1, pool).drop("block")


# fusion


def _blocked(s1, pool):
    """Of the three blockers, in blocks."""
    return token_block.hybrid_in_blocks(s1, pool, LIMITS), lsh.lsh_in_blocks(s1, pool).withColumnRenamed("hits", "score"), _sparse(s1, pool)


def _ranked(s1, pool):
    return fusion.stack(*_blocked(s1, pool))


@over_sides
def source_rank(s1, pool):
    return _ranked(s1, pool).drop("block")


@over_sides
def rrf_fusion(s1, pool):
    return fusion.fold(_ranked(s1, pool)).withColumn("rrf", fusion.rrf()).select("s1_id", "cand_id", "mask", "r1", "r2", "r3", "rrf")


def _pruned(policy, s1, pool):
    """By a policy, over all candidates of the three blockers; the one without LSH doesn't look them up."""
    ids, rows = fused.placed(pool)
    kinds = [*fused.hybrid_kinds(s1, rows, LIMITS), fused.sparse_kind(*_sparse_parts(s1, rows))]
    return fused.pruned(policy, kinds if policy == "without_lsh" else [*kinds, fused.lsh_kind(s1, rows)], ids, CAP, QUOTA, NEIGHBOURS)


@over_sides
def prune_opt(s1, pool):
    return _pruned("core_safe", s1, pool)


@over_sides
def prune_ranked(s1, pool):
    return _pruned("ranked", s1, pool)


@over_sides
def prune_p1p3(s1, pool):
    return _pruned("without_lsh", s1, pool)


@over_sides
def prune_agreement(s1, pool):
    return _pruned("agreement", s1, pool)


@over_sides
def prune_by_hits(s1, pool):
    return _pruned("by_hits", s1, pool)


@over_sides
def prune_core_first(s1, pool):
    return _pruned("core_first", s1, pool)


# features and decisions


@over_sides
def pair_features_sql(s1, pool):
    return features.sql_features(prune_ranked(s1, pool), s1, pool)


@over_sides
def fuzzy_features(s1, pool):
    return features.pair_features(prune_ranked(s1, pool), s1, pool)


@over_sides
def exact_match_shortcut(s1, pool):
    return decide.exact_shortcut(prune_ranked(s1, pool), s1, pool).select("s1_id", "cand_id", "rank")


def _scored(s1, pool):
    """Candidates with a plain stand-in for the model's score."""
    rows = features.paired(prune_ranked(s1, pool), s1, pool)
    f = features.plain_features()
    return rows.select("s1_id", "cand_id", "rank", (F.lit(0.6) * f["name_jaccard"] + F.lit(0.4) * f["address_jaccard"]).alias("score"))


@over_sides
def truth_label_join(s1, pool):
    return learn.label_pairs(prune_ranked(s1, pool), truth(s1, pool)).select("s1_id", "cand_id", "rank", "label")


@over_sides
def decide_matches(s1, pool):
    return decide.decide(_scored(s1, pool), 0.3, 2, 0.9)


@over_sides
def threshold_grid(s1, pool):
    return decide.threshold_grid(s1, _scored(s1, pool), truth(s1, pool), THRESHOLDS, CAPS, RANKS)


@over_sides
def macro_f05(s1, pool):
    return metrics.macro_f_half(s1, decide.decide(_scored(s1, pool), 0.3, 2), truth(s1, pool))


@over_sides
def gbt_scores(s1, pool):
    ranked = prune_ranked(s1, pool)
    rows = learn.label_pairs(features.pair_features(ranked, s1, pool), truth(s1, pool)).persist()
    model = learn.train(rows, rounds=5, least=2)
    return learn.predict(model, rows).select("s1_id", "cand_id", "label", "score")


# truth, splits and samples


def _lists(s1, pool):
    ids = truth(s1, pool).groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_list("cand_id")), ",").alias("matched_entity_ids"))
    return s1.select(F.col("entity_id").alias("s1_id"), "country").join(ids, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"), "country")


def _meta(s1, pool):
    return learn.metadata(_lists(s1, pool).withColumnRenamed("source1_entity_id", "entity_id"))


@over_sides
def match_category(s1, pool):
    return _meta(s1, pool).select("entity_id", "match_count", "match_category")


@over_sides
def source_coverage(s1, pool):
    return _meta(s1, pool).groupBy("country", "source_coverage").agg(F.count("*").alias("n"))


@over_sides
def category_shares(s1, pool):
    return learn.shares(_meta(s1, pool), "match_category")


@over_sides
def validation_split(s1, pool):
    return learn.validation_split(_meta(s1, pool), pool.where("src = 2"))


@over_sides
def dev_sample(s1, pool):
    return learn.dev_sample(s1, 50).select("entity_id", "name", "country")


@over_records
def first_by_country(r):
    return learn.first_by_country(r, 20).select("entity_id", "country")


@over_sides
def hard_negatives(s1, pool):
    return learn.hard_negatives(prune_ranked(s1, pool), truth(s1, pool), scan=2, tail=1).select("s1_id", "cand_id", "rank", "label")


@over_sides
def random_negatives(s1, pool):
    return learn.random_negatives(prune_ranked(s1, pool), truth(s1, pool), most=2).select("s1_id", "cand_id", "label")


# reports


def _queries(s1, pool):
    return metrics.per_query(s1, _token_hits(s1, pool), truth(s1, pool))


@over_sides
def recall_report(s1, pool):
    return metrics.recall_report(_queries(s1, pool), pool.count())


@over_sides
def recall_by_country(s1, pool):
    return metrics.recall_by_country(_queries(s1, pool))


@over_sides
def recall_at_k(s1, pool):
    return metrics.recall_at(prune_ranked(s1, pool), truth(s1, pool), (1, 2, 3, 5, 8))


@over_sides
def percentile_variants(s1, pool):
    return metrics.percentiles(_queries(s1, pool), "n_cand")


@over_sides
def run_statistics(s1, pool):
    return metrics.run_statistics(_queries(s1, pool))


@over_sides
def union_recall(s1, pool):
    both = _token_hits(s1, pool).select("block", "s1_id", "cand_id").union(lsh.lsh_in_blocks(s1, pool).select("block", "s1_id", "cand_id"))
    return metrics.recall_report(metrics.per_query(s1, both, truth(s1, pool)))


@over_sides
def missed_matches(s1, pool):
    return truth(s1, pool).select("s1_id", "cand_id").exceptAll(token_hits(s1, pool).select("s1_id", "cand_id"))


@over_sides
def validate_lists(s1, pool):
    lists = _lists(s1, pool).drop("country").where(F.right("source1_entity_id", F.lit(1)) != "7")
    planted = s1.sparkSession.sql("SELECT * FROM VALUES ('S1-none', 'S2-1,S2-1,X9'), ('S1-other', 'S1-5,S3-none'), ('S1-none', '') AS t(source1_entity_id, matched_entity_ids)")
    return validate.list_problems(lists.unionByName(planted), s1, pool)


@over_sides
def unlisted_matches(s1, pool):
    cells = to_lists(token_hits(s1, pool), s1, "cand_id")
    return validate.not_candidates(_lists(s1, pool).drop("country"), cells)


# files, written to the shared folder and read back


@over_sides
def record_files(s1, pool):
    """Two source files with a column too many."""
    spark, paths = s1.sparkSession, []
    for n in (2, 3):
        paths.append(shared_dir(spark))
        write_tsv(pool.where(F.col("src") == n).select("entity_id", F.lit("x").alias("extra"), F.col("name").alias("business_name"), F.col("address").alias("business_address"), "country"), paths[-1])
    return read_records(spark, paths)


@over_sides
def truth_files(s1, pool):
    """All matches of all S1 records, and a row for each record without one."""
    path = shared_dir(s1.sparkSession)
    write_tsv(_lists(s1, pool).select("source1_entity_id", "matched_entity_ids"), path)
    return read_truth(s1.sparkSession, path, s1, every=True)


@over_sides
def candidate_files(s1, pool):
    """One ordered file of candidate lists."""
    path = shared_dir(s1.sparkSession)
    write_tsv(candidate_lists(s1, pool), path, one_file=True)
    return read_candidates(s1.sparkSession, path).select("s1_id", F.size("cand_ids").alias("n"), F.array_join("cand_ids", ",").alias("ids"))


@over_sides
def id_files(s1, pool):
    """The records that a file of ids names, all of which must be there."""
    path = shared_dir(s1.sparkSession)
    write_tsv(truth(s1, pool).select(F.col("s1_id").alias("entity_id")), path)
    return select_records(s1, read_ids(s1.sparkSession, path), strict=True).select("entity_id", "name", "address", "country")


@over_sides
def split_files(s1, pool):
    """The ids of each side of the split."""
    spark, path = s1.sparkSession, shared_dir(s1.sparkSession)
    write_split(validation_split(s1, pool), path)
    sides = [read_ids(spark, f"{path}/{side}").withColumn("split", F.lit(side)) for side in ("train", "validation")]
    return sides[0].unionByName(sides[1])


@over_sides
def truth_metadata(s1, pool):
    return learn.with_truth(s1, _lists(s1, pool).drop("country"))


@over_sides
def list_union(s1, pool):
    """The candidates of token blocking and the true matches, list by list."""
    ids = lambda lists, c: lists.select(F.col("source1_entity_id").alias("s1_id"), T.id_list(F.col(c)).alias("cand_ids"))
    both = metrics.union_of_lists(ids(candidate_lists(s1, pool), "candidate_entity_ids"), ids(_lists(s1, pool), "matched_entity_ids"))
    return both.select("s1_id", F.array_join(F.array_sort("cand_ids"), ",").alias("ids"))


@over_sides
def stream_block(s1, pool):
    """hybrid_block_scored, the S1 records as a stream of files that look up a stored index."""
    spark, (source, index, out, checkpoint) = s1.sparkSession, (shared_dir(s1.sparkSession) for _ in range(4))
    rows = s1.select("entity_id", "name", "address", "country")
    rows.repartition(3).write.parquet(source)
    save_index(pool, index, LIMITS)
    stored = load_index(spark, index)
    resolve_stream(spark, source, rows.schema, stored, out, checkpoint, lambda s, p: token_block.hybrid_block(s, p, LIMITS), files_a_batch=2).awaitTermination()
    return spark.read.parquet(out).drop("batch")
