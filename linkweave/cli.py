"""python -m linkweave.cli COMMAND ...: blocking, sampling, splitting, evaluation and validation over files."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from linkweave.operators import learn, metrics, validate
from linkweave.operators.fusion import POLICIES
from linkweave.operators.lsh import lsh_block
from linkweave.operators.token_block import Limits, hybrid_block
from linkweave.plans import resolution
from linkweave.plans.resolution import Settings, candidates, normalized
from linkweave.sources import token_store
from linkweave.sources.tables import candidate_lists, read_candidates, read_ids, read_records, read_truth, select_records, union_sources, write_split, write_tsv


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="linkweave")
    sub = top.add_subparsers(dest="command", required=True)
    block = sub.add_parser("block", help="candidate lists of S1 records")
    build = sub.add_parser("index", help="a stored token index of S2 and S3")
    build.add_argument("--resume", action="store_true", help="go on with a build that was interrupted")
    for name in ("s2", "s3", "output"):
        build.add_argument(f"--{name}", required=True)
    for name in ("s1", "output"):
        block.add_argument(f"--{name}", required=True)
    for name in ("s2", "s3"):
        block.add_argument(f"--{name}", help="not needed by the token blocker with an index")
    block.add_argument("--index", help="a stored token index, whose limits then count")
    block.add_argument("--blocker", choices=["token", "lsh", "fused"], default="fused")
    block.add_argument("--policy", choices=[*POLICIES], default="ranked")
    block.add_argument("--ids-file")
    block.add_argument("--limit", type=int)
    block.add_argument("--max-rows-per-source", type=int)
    block.add_argument("--fallback-threshold", type=int, default=50)
    block.add_argument("--n-gram", type=int, default=3)
    block.add_argument("--threshold", type=float, default=0.3)
    block.add_argument("--num-perm", type=int, default=64)
    block.add_argument("--min-band-hits", type=int, help="1 for lsh, 2 for fused")
    block.add_argument("--max-candidates", type=int, default=1500)
    block.add_argument("--p3-top-k", type=int, default=500)
    block.add_argument("--p3-slack-quota", type=float, default=0.10)
    for own in (block, build):
        own.add_argument("--max-doc-freq", type=float, default=0.001)
        own.add_argument("--max-postings-per-token", type=int, default=5000)
        own.add_argument("--exact-max-postings", type=int, default=5000)
        own.add_argument("--pair-max-postings", type=int, default=5000)
        own.add_argument("--max-pair-tokens", type=int, default=12)
    recall = sub.add_parser("recall", help="recall of a candidate file")
    recall.add_argument("--candidates", required=True, nargs="+", help="several files are united")
    recall.add_argument("--ground-truth", required=True)
    recall.add_argument("--s1", required=True)
    recall.add_argument("--pool-size", type=int)
    sample = sub.add_parser("sample", help="a fixed sample of S1 records")
    sample.add_argument("--s1", required=True)
    sample.add_argument("--output", required=True)
    sample.add_argument("--size", type=int, default=10000)
    sample.add_argument("--seed", type=int, default=42)
    split = sub.add_parser("split", help="a stratified validation split")
    split.add_argument("--train-s1", required=True)
    split.add_argument("--ground-truth", required=True)
    split.add_argument("--test-s1", required=True)
    split.add_argument("--output-dir", required=True)
    split.add_argument("--validation-fraction", type=float, default=0.2)
    split.add_argument("--seed", type=int, default=42)
    for name, told in (("train", "a matcher on blocked candidates"), ("tune", "the best decision settings of a matcher"), ("match", "matches and candidates of S1 records")):
        own = sub.add_parser(name, help=told)
        for x in ("s1", "s2", "s3", "model"):
            own.add_argument(f"--{x}", required=True)
        own.add_argument("--ids-file")
        own.add_argument("--max-doc-freq", type=float, default=0.001)
        own.add_argument("--max-candidates", type=int, default=1500)
        if name != "match":
            own.add_argument("--ground-truth", required=True)
            own.add_argument("--queries", type=int, default=20000 if name == "train" else 10000)
            own.add_argument("--seed", type=int, default=42)
        if name == "train":
            own.add_argument("--hard-negatives-scan", type=int, default=160)
            own.add_argument("--tail-negatives", type=int, default=32)
            own.add_argument("--negative-weight", type=float, default=8.0)
            own.add_argument("--learning-rate", type=float, default=0.06)
            own.add_argument("--max-iter", type=int, default=40)
            own.add_argument("--max-depth", type=int, default=5)
            own.add_argument("--min-samples-leaf", type=int, default=40)
        if name == "tune":
            own.add_argument("--max-rank", type=int, default=256)
        if name == "match":
            own.add_argument("--output-matches", required=True)
            own.add_argument("--output-candidates", required=True)
            for x, kind in (("rank-k", int), ("model-k", int), ("max-matches", int), ("relative-gate", float), ("threshold", float)):
                own.add_argument(f"--{x}", type=kind, help="in place of the model's setting")
    check = sub.add_parser("validate", help="the output contract")
    check.add_argument("--matching", required=True)
    check.add_argument("--candidate")
    check.add_argument("--s1", required=True)
    check.add_argument("--pool", nargs="*", help="pool files; ids are checked against them")
    return top


def matcher(o: argparse.Namespace, spark: SparkSession) -> None:
    s1 = read_records(spark, o.s1)
    if o.ids_file:
        s1 = select_records(s1, read_ids(spark, o.ids_file))
    if o.command != "match" and s1.count() > o.queries:
        s1 = learn.dev_sample(s1, o.queries, o.seed)
    s1, pool = normalized(s1).persist(), normalized(union_sources(*(read_records(spark, p) for p in (o.s2, o.s3))))
    settings = Settings(Limits(o.max_doc_freq), cap=o.max_candidates)
    ranked = candidates(s1, pool, settings).persist()
    if o.command == "train":
        model = resolution.train_matcher(s1, pool, ranked, read_truth(spark, o.ground_truth, s1), o.hard_negatives_scan, o.tail_negatives, o.seed, negative_weight=o.negative_weight, rate=o.learning_rate, rounds=o.max_iter, depth=o.max_depth, least=o.min_samples_leaf)
        learn.save_model(model, o.model, {})
        return
    model, told = learn.load_model(o.model)
    if o.command == "tune":
        best = resolution.tune(s1, pool, ranked, read_truth(spark, o.ground_truth, s1), model, o.max_rank)
        learn.save_settings(o.model, best)
        print(best)
        return
    pick = lambda given, name, default: given if given is not None else told.get(name, default)
    rank_k = pick(o.rank_k, "rank_k", 64)
    settings = replace(settings, rank_k=rank_k, model_k=min(pick(o.model_k, "model_k", rank_k), rank_k), most=pick(o.max_matches, "max_matches", 12), gate=pick(o.relative_gate, "gate", 0.0), threshold=pick(o.threshold, "threshold", 0.39))
    within = ranked.where(F.col("rank") <= settings.rank_k)
    write_tsv(candidate_lists(within, s1), o.output_candidates)
    found = candidate_lists(resolution.matches(s1, pool, ranked, model, settings), s1, "place")
    write_tsv(found.withColumnRenamed("candidate_entity_ids", "matched_entity_ids"), o.output_matches)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    top = parser()
    o = top.parse_args(args)
    spark = spark or SparkSession.builder.appName("linkweave").getOrCreate()
    if o.command in ("block", "index"):
        limits = Limits(o.max_doc_freq, o.max_postings_per_token, exact_cap=o.exact_max_postings, pair_cap=o.pair_max_postings, pair_tokens=o.max_pair_tokens)
    if o.command == "index":
        token_store.save_index(normalized(union_sources(*(read_records(spark, p) for p in (o.s2, o.s3)))), o.output, limits, o.resume)
    elif o.command == "block":
        alone = o.index and o.blocker == "token"
        if not alone and not (o.s2 and o.s3):
            top.error("--s2 and --s3 are needed")
        s1 = read_records(spark, o.s1)
        if o.ids_file or o.limit:
            s1 = select_records(s1, read_ids(spark, o.ids_file) if o.ids_file else s1, o.limit)
        s1, limits = normalized(s1), replace(limits, fallback=o.fallback_threshold)
        index = token_store.load_index(spark, o.index) if o.index else None
        pool = None if alone else normalized(union_sources(*(read_records(spark, p, o.max_rows_per_source) for p in (o.s2, o.s3))))
        if o.blocker == "token":
            found, order = hybrid_block(s1, index or pool, limits), "cand_id"
        elif o.blocker == "lsh":
            found, order = lsh_block(s1, pool, o.threshold, o.num_perm, o.n_gram, o.min_band_hits or 1, o.max_candidates), "cand_id"
        else:
            found, order = candidates(s1, pool, Settings(limits, o.threshold, o.min_band_hits or 2, o.num_perm, o.n_gram, o.p3_top_k, o.max_candidates, o.p3_slack_quota, o.policy), index=index), "rank"
        write_tsv(candidate_lists(found, s1, order), o.output)
    elif o.command == "recall":
        s1 = read_records(spark, o.s1)
        pairs = metrics.union_of_lists(*(read_candidates(spark, p) for p in o.candidates))
        own = select_records(s1, pairs.select(F.col("s1_id").alias("entity_id")))
        queries = metrics.per_query(own, pairs.select("s1_id", F.explode("cand_ids").alias("cand_id")), read_truth(spark, o.ground_truth, own)).persist()
        metrics.recall_report(queries, o.pool_size).show(truncate=False)
        metrics.recall_by_country(queries).show(truncate=False)
    elif o.command in ("train", "tune", "match"):
        matcher(o, spark)
    elif o.command == "sample":
        write_tsv(learn.dev_sample(read_records(spark, o.s1), o.size, o.seed), o.output, one_file=True)
    elif o.command == "split":
        from linkweave.sources.tables import TRUTH, read_tsv

        meta = learn.with_truth(read_records(spark, o.train_s1), read_tsv(spark, o.ground_truth, TRUTH))
        write_split(learn.validation_split(meta, read_records(spark, o.test_s1), o.validation_fraction, o.seed), o.output_dir)
    else:
        errors, warnings = validate.validate(spark, o.matching, read_records(spark, o.s1), o.candidate, union_sources(*(read_records(spark, p) for p in o.pool)) if o.pool else None)
        for x in warnings:
            print("warning:", x)
        for x in errors:
            print("error:", x)
        return int(bool(errors))
    return 0


if __name__ == "__main__":
    sys.exit(main())
