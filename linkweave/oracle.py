"""DuckDB SQL for the queries of the catalog, written apart from the operators."""

from __future__ import annotations

from linkweave.operators.lsh import coefficients
from linkweave.sources.derived import RECORDS_SQL

PRIME = 2147483647
_TOKENS = "list_filter(string_split({}, ' '), lambda x: x <> '')"
_SET = f"list_sort(list_distinct({_TOKENS}))"
_GRAMS = "list_distinct(CASE WHEN length(x) < 3 THEN [x] ELSE list_transform(range(1, length(x) - 1), lambda i: substr(x, i, 3)) END)"
_PAIRS = "flatten(list_transform(range(1, len(t) + 1), lambda i: list_transform(range(i + 1, len(t) + 1), lambda j: t[i] || ' ' || t[j])))"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join((RECORDS_SQL.strip(), *parts)) + "\n" + select


_KEYS = f"""
k1 AS (SELECT country, entity_id, unnest({_SET.format("name")}) AS key FROM s1),
kp AS (SELECT country, entity_id, unnest({_SET.format("name")}) AS key FROM pool),
tot AS (SELECT country, count(*) AS n_records FROM pool GROUP BY 1),
freq AS (SELECT country, key, count(*) AS df FROM kp WHERE (country, key) IN (SELECT country, key FROM k1) GROUP BY ALL),
kept AS (SELECT country, key, df FROM freq JOIN tot USING (country) WHERE df <= least(n_records * 0.05::DOUBLE, 5000)),
hits AS (SELECT k1.entity_id AS s1_id, kp.entity_id AS cand_id, count(*) AS token_hits FROM k1 JOIN kept USING (country, key) JOIN kp USING (country, key) GROUP BY ALL)"""
_EXACT = """
xf AS (SELECT country, name, count(*) AS df FROM pool WHERE name <> '' AND (country, name) IN (SELECT country, name FROM s1) GROUP BY ALL),
xk AS (SELECT country, name FROM xf JOIN tot USING (country) WHERE df <= least(n_records, 5000)),
exact AS (SELECT s1.entity_id AS s1_id, pool.entity_id AS cand_id FROM s1 JOIN xk USING (country, name) JOIN pool USING (country, name))"""
_PAIR = f"""
p1k AS (SELECT country, entity_id, unnest({_PAIRS}) AS key FROM (SELECT country, entity_id, {_SET.format("name")}[1:12] AS t FROM s1)),
ppk AS (SELECT country, entity_id, unnest({_PAIRS}) AS key FROM (SELECT country, entity_id, {_SET.format("name")}[1:12] AS t FROM pool)),
pf AS (SELECT country, key, count(*) AS df FROM ppk WHERE (country, key) IN (SELECT country, key FROM p1k) GROUP BY ALL),
pk AS (SELECT country, key FROM pf JOIN tot USING (country) WHERE df <= least(n_records, 5000)
       AND NOT ((country, split_part(key, ' ', 1)) IN (SELECT country, key FROM kept) AND (country, split_part(key, ' ', 2)) IN (SELECT country, key FROM kept))),
pairs AS (SELECT p1k.entity_id AS s1_id, ppk.entity_id AS cand_id, count(*) AS pair_hits FROM p1k JOIN pk USING (country, key) JOIN ppk USING (country, key) GROUP BY ALL)"""
_HYBRID = """
few AS (SELECT entity_id AS s1_id FROM s1 LEFT JOIN (SELECT s1_id, count(*) AS n FROM hits GROUP BY 1) h ON h.s1_id = entity_id WHERE coalesce(n, 0) <= 5),
hybrid AS (SELECT s1_id, cand_id, coalesce(token_hits, 0) AS token_hits, CASE WHEN x.s1_id IS NULL THEN 0 ELSE 1 END AS exact, coalesce(pair_hits, 0) AS pair_hits,
                  greatest(coalesce(token_hits, 0), CASE WHEN x.s1_id IS NULL THEN 0 ELSE 100 END) + 10 * coalesce(pair_hits, 0) AS score
           FROM hits FULL JOIN (SELECT * FROM exact WHERE s1_id IN (FROM few)) x USING (s1_id, cand_id) FULL JOIN (SELECT * FROM pairs WHERE s1_id IN (FROM few)) p USING (s1_id, cand_id))"""
_a, _b = coefficients(64)


def _signed(x: str) -> str:
    return f"""
coef AS (SELECT * FROM (VALUES {", ".join(f"({k}, {_a[k]}::BIGINT, {_b[k]}::BIGINT)" for k in range(64))}) v(k, a, b)),
sh AS (SELECT entity_id, country, src, ('0x' || substr(md5(g), 1, 15))::BIGINT % {PRIME} AS h FROM (SELECT entity_id, country, src, unnest({_GRAMS}) AS g FROM (SELECT *, {x} AS x FROM rec) WHERE x <> '')),
sig AS (SELECT entity_id, country, src, k, min((a * h + b) % {PRIME}) AS v FROM sh CROSS JOIN coef GROUP BY ALL),
bands AS (SELECT entity_id, country, src, k // 3 AS band, string_agg(v::VARCHAR, '-' ORDER BY k) AS key FROM sig WHERE k < 63 GROUP BY ALL)"""


_SIGNED, _SIGNED_TEXTS = _signed("trim(concat_ws(' ', name, address))"), _signed("text")
_LSH = """
lsh AS (SELECT q.entity_id AS s1_id, c.entity_id AS cand_id, count(*) AS hits FROM bands q JOIN bands c ON q.country = c.country AND q.band = c.band AND q.key = c.key AND q.src = 1 AND c.src > 1 GROUP BY ALL)"""
_SPARSE = f"""
a1 AS (SELECT country, entity_id, unnest({_SET.format("address")}) AS key FROM s1),
ap AS (SELECT country, entity_id, unnest({_SET.format("address")}) AS key FROM pool),
af AS (SELECT country, key, count(*) AS df FROM ap WHERE (country, key) IN (SELECT country, key FROM a1) GROUP BY ALL),
ak AS (SELECT country, key FROM af JOIN tot USING (country) WHERE df <= least(n_records * 0.05::DOUBLE, 5000)),
shared AS (SELECT a1.entity_id AS s1_id, ap.entity_id AS cand_id, count(*) AS shared FROM a1 JOIN ak USING (country, key) JOIN ap USING (country, key) GROUP BY ALL),
sparse AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id) AS rank FROM (
    SELECT s1_id, cand_id, shared / sqrt((x.n * y.n)::DOUBLE) AS score FROM shared JOIN (SELECT entity_id, count(*) AS n FROM a1 GROUP BY 1) x ON x.entity_id = s1_id JOIN (SELECT entity_id, count(*) AS n FROM ap GROUP BY 1) y ON y.entity_id = cand_id)) WHERE rank <= 10)"""
_FOLD = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY score DESC, cand_id) AS rank FROM (
    SELECT s1_id, cand_id, 'p1' AS source, score::DOUBLE AS score FROM hybrid UNION ALL SELECT s1_id, cand_id, 'p2', hits FROM lsh UNION ALL SELECT s1_id, cand_id, 'p3', score FROM sparse)),
fold AS (SELECT *, coalesce(1::DOUBLE / (60 + r1), 0) + coalesce(1::DOUBLE / (60 + r2), 0) + coalesce(1::DOUBLE / (60 + r3), 0) + 0.005::DOUBLE * bit_count(mask) AS rrf, (mask & 3) > 0 AS core FROM (
    SELECT s1_id, cand_id, bit_or(CASE source WHEN 'p1' THEN 1 WHEN 'p2' THEN 2 ELSE 4 END) AS mask,
           min(rank) FILTER (WHERE source = 'p1') AS r1, min(rank) FILTER (WHERE source = 'p2') AS r2, min(rank) FILTER (WHERE source = 'p3') AS r3,
           max(score) FILTER (WHERE source = 'p1') AS p1, max(score) FILTER (WHERE source = 'p2') AS p2, max(score) FILTER (WHERE source = 'p3') AS p3 FROM ranked GROUP BY ALL)),
placed AS (SELECT *, count(*) OVER q AS n, count(*) FILTER (WHERE core) OVER q AS n_core, count(*) FILTER (WHERE NOT core) OVER q AS n3,
           row_number() OVER (PARTITION BY s1_id, core ORDER BY rrf DESC, cand_id) AS by_rrf, row_number() OVER (PARTITION BY s1_id, core ORDER BY p3 DESC NULLS LAST, cand_id) AS by_p3
           FROM fold WINDOW q AS (PARTITION BY s1_id))"""
_OUT = "SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id) AS rank, mask, score FROM (SELECT *, rrf + 0.0005::DOUBLE * coalesce(p3, 0) AS score FROM {} WHERE {})"
# a cap of 5 and a quota of 0.3: round half even of 1.5 is 2
_RANKED_KEEP = "n <= 5 OR (core AND by_rrf <= 5 - least(n3, 2)) OR (NOT core AND by_p3 <= least(n3, 2))"
_BEST = f"best AS ({_OUT.format('placed', _RANKED_KEEP)})"
_ALL = (_KEYS.strip(), _EXACT.strip(), _PAIR.strip(), _HYBRID.strip(), _SIGNED.strip(), _LSH.strip(), _SPARSE.strip(), _FOLD.strip())
_JAC = "CASE WHEN len(list_distinct(list_concat({0}, {1}))) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({0}, {1}))::DOUBLE / len(list_distinct(list_concat({0}, {1}))) END"
_OVER = "CASE WHEN least(len({0}), len({1})) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({0}, {1}))::DOUBLE / least(len({0}), len({1})) END"
_LEN = "CASE WHEN greatest(length({0}), length({1})) = 0 THEN 1.0::DOUBLE ELSE least(length({0}), length({1}))::DOUBLE / greatest(length({0}), length({1})) END"
_PREP = f"""
prep AS (SELECT entity_id, name, address, list_distinct({_TOKENS.format("name")}) AS nt, list_distinct({_TOKENS.format("address")}) AS ad, lower(trim(coalesce(country, ''))) AS c,
         list_distinct(regexp_extract_all(name, '\\p{{Nd}}+')) AS nd, list_distinct(regexp_extract_all(address, '\\p{{Nd}}+')) AS dd FROM rec)"""
_SCORED = f"scored AS (SELECT s1_id, cand_id, rank, 0.6::DOUBLE * ({_JAC.format('q.nt', 'c.nt')}) + 0.4::DOUBLE * ({_JAC.format('q.ad', 'c.ad')}) AS score FROM best JOIN prep q ON q.entity_id = s1_id JOIN prep c ON c.entity_id = cand_id)"
_LISTS = "lists AS (SELECT s1.entity_id AS s1_id, country, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS ids, count(cand_id)::INT AS n, count(*) FILTER (WHERE cand_id LIKE 'S2-%') AS n2, count(*) FILTER (WHERE cand_id LIKE 'S3-%') AS n3 FROM s1 LEFT JOIN truth ON s1_id = s1.entity_id GROUP BY ALL)"
_META = "meta AS (SELECT s1_id AS entity_id, country, n AS match_count, CASE WHEN n = 0 THEN 'singleton' WHEN n = 1 THEN 'one_match' WHEN n <= 3 THEN 'small_multi' WHEN n <= 6 THEN 'medium_multi' ELSE 'high_multi' END AS match_category, CASE WHEN n = 0 THEN 'singleton' WHEN n2 > 0 AND n3 > 0 THEN 'both' WHEN n2 > 0 THEN 'S2_only' ELSE 'S3_only' END AS source_coverage FROM lists)"


def _per(cand: str) -> str:
    return f"""
cand AS (SELECT DISTINCT s1_id, cand_id FROM {cand}),
pq AS (SELECT s1.entity_id AS s1_id, country, coalesce(n_cand, 0) AS n_cand, coalesce(n_true, 0) AS n_true, coalesce(n_found, 0) AS n_found FROM s1
    LEFT JOIN (SELECT s1_id, count(*) AS n_cand FROM cand GROUP BY 1) a ON a.s1_id = entity_id
    LEFT JOIN (SELECT truth.s1_id, count(*) AS n_true, count(cand.cand_id) AS n_found FROM truth LEFT JOIN cand USING (s1_id, cand_id) GROUP BY 1) b ON b.s1_id = entity_id)"""


_REPORT = "count(*) AS n_queries, sum(n_true)::BIGINT AS true_pairs, sum(n_found)::BIGINT AS found_pairs, sum(n_found)::DOUBLE / nullif(sum(n_true), 0) AS pairwise_recall, count(*) FILTER (WHERE n_true > 0 AND n_found = n_true)::DOUBLE / nullif(count(*) FILTER (WHERE n_true > 0), 0) AS full_recall, avg(n_cand) AS mean_candidates, max(n_cand) AS max_candidates, count(*) FILTER (WHERE n_cand = 0) AS zero_candidates"
_MEDIAN = "quantile_cont(n_cand, 0.5) AS median_candidates, list_sort(list(n_cand))[round_even(0.9::DOUBLE * (count(*) - 1), 0)::INT + 1] AS p90_candidates"
_F05 = "CASE WHEN n_true = 0 THEN CASE WHEN {n} = 0 THEN 1.0 ELSE 0.0 END WHEN {n} = 0 OR {tp} = 0 THEN 0.0 ELSE 1.25 * ({tp}::DOUBLE / {n}) * ({tp}::DOUBLE / n_true) / (0.25 * ({tp}::DOUBLE / {n}) + {tp}::DOUBLE / n_true) END::DOUBLE"


def _decided(threshold: float, most: int, gate: float) -> str:
    return f"""
g AS (SELECT *, first_value(score) OVER (PARTITION BY s1_id ORDER BY rank) AS first FROM scored),
d AS (SELECT *, count(*) OVER (PARTITION BY s1_id) AS n, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, rank) AS best FROM g WHERE score >= greatest({threshold}::DOUBLE, first * {gate}::DOUBLE)),
decided AS (SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY CASE WHEN n > {most} THEN best ELSE rank END) AS place, rank, score FROM d WHERE best <= {most})"""


def _draw(seed: int, cols: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || {cols}), 1, 15))::BIGINT"


_BYTES = "octet_length(encode(entity_id))"
_PQ = _per("hits").strip()
_AGREE = "bit_count(mask) DESC, coalesce(p2, 0) DESC, least(coalesce(p1, 0), 100) DESC, coalesce(p3, 0) DESC, cand_id DESC"
_HITS = "bit_count(mask) DESC, coalesce(p2, 0) DESC, coalesce(p1, 0) DESC, coalesce(p3, 0) DESC, cand_id"
_GRID = "(VALUES (2), (5)) a(rank_k), (VALUES (0.2::DOUBLE), (0.4::DOUBLE), (0.6::DOUBLE), (0.8::DOUBLE)) b(threshold), (VALUES (1), (2), (4)) c(max_matches)"

ORACLE_SQL: dict[str, str] = {
    "normalize_names": _with(select="SELECT entity_id, text FROM rec"),
    "token_sets": _with(select=f"SELECT entity_id, array_to_string({_SET.format('text')}, ' ') AS tokens FROM rec"),
    "token_pairs": _with(select=f"SELECT entity_id, len({_PAIRS}) AS n_pairs, array_to_string({_PAIRS}, '|') AS pairs FROM (SELECT entity_id, {_SET.format('text')}[1:12] AS t FROM rec)"),
    "char_shingles": _with(select=f"SELECT entity_id, len(g) AS n_shingles, md5(coalesce(array_to_string(list_sort(g), '|'), '')) AS shingles_md5 FROM (SELECT entity_id, CASE WHEN x = '' THEN [] ELSE {_GRAMS} END AS g FROM (SELECT entity_id, text AS x FROM rec))"),
    "digit_runs": r"SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), '\p{Nd}+'))), ' '), '') AS runs FROM documents",
    "country_keys": _with(select="SELECT country, lower(trim(coalesce(country, ''))) AS country_key, substr(sha1(country), 1, 16) AS digest, count(*) AS n FROM rec GROUP BY country"),
    "portable_hashes": _with(select="SELECT entity_id, ('0x' || substr(md5(entity_id), 1, 15))::BIGINT AS hash FROM rec"),
    "record_statistics": _with(select=f"SELECT count(*) AS n_rows, max({_BYTES}) AS max_id_bytes FROM rec"),
    "country_totals": _with(select="SELECT country, count(*) AS n_records FROM pool GROUP BY 1"),
    "country_shares": _with(select="SELECT country, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM rec) AS share FROM rec GROUP BY 1"),
    "source_union": _with(select="SELECT src, country, count(*) AS n FROM pool GROUP BY ALL"),
    "token_union": _with(select=f"SELECT DISTINCT country, unnest({_SET.format('text')}) AS token FROM pool"),
    "token_intersection": _with(select=f"SELECT country, unnest({_SET.format('text')}) AS token FROM rec WHERE src = 1 INTERSECT SELECT country, unnest({_SET.format('text')}) FROM rec WHERE src = 2"),
    "token_difference": _with(select=f"SELECT country, unnest({_SET.format('text')}) AS token FROM rec WHERE src = 1 EXCEPT SELECT country, unnest({_SET.format('text')}) FROM rec WHERE src = 2"),
    "missing_ids_anti": _with(_KEYS.strip(), select="SELECT entity_id FROM s1 WHERE entity_id NOT IN (SELECT s1_id FROM hits)"),
    "token_doc_freq": _with(_KEYS.strip(), select="SELECT country, key, df FROM freq"),
    "token_kept": _with(_KEYS.strip(), select="SELECT country, key, df FROM kept"),
    "exact_block": _with(_KEYS.strip(), _EXACT.strip(), select="SELECT s1_id, cand_id FROM exact"),
    "pair_block": _with(_KEYS.strip(), _PAIR.strip(), select="SELECT s1_id, cand_id, pair_hits FROM pairs"),
    "token_block": _with(_KEYS.strip(), select="SELECT s1_id, cand_id, token_hits FROM hits"),
    "hybrid_block_scored": _with(*_ALL[:4], select="SELECT s1_id, cand_id, token_hits, exact, pair_hits, score FROM hybrid"),
    "stored_token_index": _with(*_ALL[:4], select="SELECT s1_id, cand_id, token_hits, exact, pair_hits, score FROM hybrid"),
    "candidate_lists": _with(*_ALL[:4], select="SELECT entity_id AS source1_entity_id, coalesce(string_agg(cand_id, ',' ORDER BY score DESC, cand_id), '') AS candidate_entity_ids FROM s1 LEFT JOIN hybrid ON s1_id = entity_id GROUP BY 1"),
    "minhash_signature": _with(_SIGNED_TEXTS.strip(), select="SELECT entity_id, string_agg(v::VARCHAR, '-' ORDER BY k) AS signature FROM sig GROUP BY 1"),
    "lsh_parameters": "SELECT * FROM (VALUES (0.3::DOUBLE, 21, 3), (0.4::DOUBLE, 16, 4), (0.5::DOUBLE, 14, 4)) t(threshold, bands, band_rows)",
    "lsh_bands": _with(_SIGNED_TEXTS.strip(), select="SELECT entity_id, band, key FROM bands"),
    "lsh_candidates": _with(_SIGNED.strip(), _LSH.strip(), select="SELECT s1_id, cand_id, hits FROM lsh"),
    "lsh_min_hits_topk": _with(_SIGNED.strip(), _LSH.strip(), select="SELECT s1_id, cand_id, hits FROM lsh WHERE hits >= 2 QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY hits DESC, cand_id) <= 5"),
    "knn_topk": "SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id) AS rank, round(score, 6) AS score FROM (SELECT q.vec_id AS s1_id, c.vec_id AS cand_id, list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS score FROM embeddings q JOIN embeddings c ON q.label = c.label AND q.vec_id <> c.vec_id AND q.vec_id % 20 = 0) QUALIFY rank <= 10",
    "sparse_knn": _with(_KEYS.strip(), _SPARSE.strip(), select="SELECT s1_id, cand_id, score, rank FROM sparse"),
    "source_rank": _with(*_ALL, select="SELECT s1_id, cand_id, source, score, rank FROM ranked"),
    "rrf_fusion": _with(*_ALL, select="SELECT s1_id, cand_id, mask, r1, r2, r3, rrf FROM fold"),
    "prune_ranked": _with(*_ALL, _BEST, select="SELECT * FROM best"),
    "prune_opt": _with(*_ALL, "o1 AS (SELECT *, least(greatest(5 - n_core, 0), 2) AS slots FROM placed)", "o2 AS (SELECT *, NOT core AND by_p3 <= slots AS first FROM o1)", "o3 AS (SELECT *, row_number() OVER (PARTITION BY s1_id, core OR first ORDER BY rrf DESC, cand_id) AS later FROM o2)",
                       select=_OUT.format("o3", "n <= 5 OR (n_core <= 5 AND (core OR first OR later <= 5 - n_core - least(n3, slots))) OR (n_core > 5 AND core AND by_rrf <= 5)")),
    "prune_p1p3": _with(*_ALL, "f13 AS (SELECT s1_id, cand_id, mask & 5 AS mask, p3, coalesce(1::DOUBLE / (60 + r1), 0) + coalesce(1::DOUBLE / (60 + r3), 0) + 0.005::DOUBLE * bit_count(mask & 5) AS rrf, (mask & 1) > 0 AS core FROM fold WHERE (mask & 5) > 0)",
                        "q13 AS (SELECT *, count(*) OVER q AS n, count(*) FILTER (WHERE NOT core) OVER q AS n3, row_number() OVER (PARTITION BY s1_id, core ORDER BY rrf DESC, cand_id) AS by_rrf, row_number() OVER (PARTITION BY s1_id, core ORDER BY p3 DESC NULLS LAST, cand_id) AS by_p3 FROM f13 WINDOW q AS (PARTITION BY s1_id))", select=_OUT.format("q13", _RANKED_KEEP)),
    "prune_agreement": _with(*_ALL,
        "g1 AS (SELECT *, CASE WHEN bit_count(mask) >= 2 THEN 0 WHEN mask = 4 THEN 2 ELSE 1 END AS kind FROM fold)",
        f"g2 AS (SELECT *, count(*) OVER q AS n, count(*) FILTER (WHERE kind = 0) OVER q AS n_two, count(*) FILTER (WHERE kind = 2) OVER q AS n_three, CASE kind WHEN 0 THEN row_number() OVER (PARTITION BY s1_id, kind ORDER BY {_AGREE}) WHEN 1 THEN row_number() OVER (PARTITION BY s1_id, kind ORDER BY least(coalesce(p1, 0), 100) DESC, coalesce(p2, 0) DESC, coalesce(p3, 0) DESC, cand_id DESC) ELSE row_number() OVER (PARTITION BY s1_id, kind ORDER BY coalesce(p3, 0) DESC, coalesce(p2, 0) DESC, least(coalesce(p1, 0), 100) DESC, cand_id DESC) END AS place FROM g1 WINDOW q AS (PARTITION BY s1_id))",
        "g3 AS (SELECT *, greatest(5 - n_two, 0) AS free, least(n_three, round_even(greatest(5 - n_two, 0) * 0.3::DOUBLE, 0)) AS p3_slots FROM g2)",
        "g4 AS (SELECT *, n <= 5 OR (kind = 0 AND place <= 5) OR (kind = 1 AND place <= free - p3_slots) OR (kind = 2 AND place <= p3_slots) AS first FROM g3)",
        f"g5 AS (SELECT *, count(*) FILTER (WHERE first) OVER (PARTITION BY s1_id) AS n_first, row_number() OVER (PARTITION BY s1_id, first ORDER BY {_AGREE}) AS later FROM g4)",
        select=f"SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY {_AGREE}) AS rank, mask, rrf AS score FROM g5 WHERE first OR later <= 5 - n_first"),
    "prune_by_hits": _with(*_ALL,
        "g1 AS (SELECT *, CASE WHEN bit_count(mask) >= 2 THEN 0 WHEN mask = 4 THEN 2 ELSE 1 END AS kind FROM fold)",
        f"g2 AS (SELECT *, count(*) OVER q AS n, count(*) FILTER (WHERE kind = 0) OVER q AS n_two, count(*) FILTER (WHERE kind = 2) OVER q AS n_three, CASE kind WHEN 0 THEN row_number() OVER (PARTITION BY s1_id, kind ORDER BY {_HITS}) WHEN 1 THEN row_number() OVER (PARTITION BY s1_id, kind ORDER BY coalesce(p2, 0) DESC, coalesce(p1, 0) DESC, coalesce(p3, 0) DESC, cand_id) ELSE row_number() OVER (PARTITION BY s1_id, kind ORDER BY coalesce(p3, 0) DESC, coalesce(p2, 0) DESC, coalesce(p1, 0) DESC, cand_id) END AS place FROM g1 WINDOW q AS (PARTITION BY s1_id))",
        "g3 AS (SELECT *, greatest(5 - n_two, 0) AS free, least(n_three, round_even(greatest(5 - n_two, 0) * 0.3::DOUBLE, 0)) AS p3_slots FROM g2)",
        "g4 AS (SELECT *, n <= 5 OR (kind = 0 AND place <= 5) OR (kind = 1 AND place <= free - p3_slots) OR (kind = 2 AND place <= p3_slots) AS first FROM g3)",
        f"g5 AS (SELECT *, count(*) FILTER (WHERE first) OVER (PARTITION BY s1_id) AS n_first, row_number() OVER (PARTITION BY s1_id, first ORDER BY {_HITS}) AS later FROM g4)",
        select=f"SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY {_HITS}) AS rank, mask, rrf AS score FROM g5 WHERE first OR later <= 5 - n_first"),
    "prune_core_first": _with(*_ALL, "c1 AS (SELECT *, row_number() OVER (PARTITION BY s1_id, core ORDER BY bit_count(mask) DESC, coalesce(p2, 0) DESC, coalesce(p1, 0) DESC, coalesce(p3, 0) DESC, cand_id) AS agreed FROM placed)", select=_OUT.format("c1", "(core AND agreed <= 5) OR (NOT core AND by_p3 <= 5 - n_core)")),
    "pair_features_sql": _with(*_ALL, _BEST, _PREP.strip(), select=f"""
SELECT s1_id, cand_id, {_JAC.format("q.nt", "c.nt")} AS name_jaccard, {_JAC.format("q.ad", "c.ad")} AS address_jaccard, {_OVER.format("q.nt", "c.nt")} AS name_token_overlap, {_OVER.format("q.ad", "c.ad")} AS address_token_overlap,
  (q.name <> '' AND q.name = c.name)::INT::DOUBLE AS name_exact, (q.address <> '' AND q.address = c.address)::INT::DOUBLE AS address_exact, {_LEN.format("q.name", "c.name")} AS name_length_ratio, {_LEN.format("q.address", "c.address")} AS address_length_ratio,
  {_JAC.format("q.nd", "c.nd")} AS name_digit_jaccard, {_JAC.format("q.dd", "c.dd")} AS address_digit_jaccard, list_has_any(q.dd, c.dd)::INT::DOUBLE AS address_number_match,
  (q.address <> '' AND c.address <> '' AND (contains(q.address, c.address) OR contains(c.address, q.address)))::INT::DOUBLE AS address_contains, (q.name <> '' AND q.name[1] = c.name[1])::INT::DOUBLE AS name_first_char_match,
  (q.c = c.c)::INT::DOUBLE AS country_match, (q.address = '')::INT::DOUBLE AS address_missing_query, (c.address = '')::INT::DOUBLE AS address_missing_candidate, 1::DOUBLE / (60 + rank) AS blocker_rank_score, 1::DOUBLE / log2(2 + rank) AS blocker_rank_log,
  bit_count(mask)::DOUBLE AS blocker_source_count, ((mask & 1) > 0)::INT::DOUBLE AS blocker_p1_hit, ((mask & 2) > 0)::INT::DOUBLE AS blocker_p2_hit, ((mask & 4) > 0)::INT::DOUBLE AS blocker_p3_hit
FROM best JOIN prep q ON q.entity_id = s1_id JOIN prep c ON c.entity_id = cand_id"""),
    "exact_match_shortcut": _with(*_ALL, _BEST, select="SELECT s1_id, cand_id, rank FROM best JOIN rec q ON q.entity_id = s1_id JOIN rec c ON c.entity_id = cand_id WHERE q.name = c.name AND q.address = c.address AND q.name <> '' AND q.address <> ''"),
    "truth_label_join": _with(*_ALL, _BEST, select="SELECT s1_id, cand_id, rank, ((s1_id, cand_id) IN (SELECT s1_id, cand_id FROM truth))::INT AS label FROM best"),
    "decide_matches": _with(*_ALL, _BEST, _PREP.strip(), _SCORED, _decided(0.3, 2, 0.9).strip(), select="SELECT * FROM decided"),
    "macro_f05": _with(*_ALL, _BEST, _PREP.strip(), _SCORED, _decided(0.3, 2, 0.0).strip(), _per("decided").strip(), select=f"SELECT count(*) AS n_queries, count(*) FILTER (WHERE n_cand = 0) AS empty_queries, avg({_F05.format(n='n_cand', tp='n_found')}) AS macro_f05 FROM pq"),
    "threshold_grid": _with(*_ALL, _BEST, _PREP.strip(), _SCORED, f"grid AS (SELECT * FROM {_GRID})",
        "kg AS (SELECT grid.*, s.s1_id, s.cand_id, row_number() OVER (PARTITION BY rank_k, threshold, max_matches, s.s1_id ORDER BY score DESC, rank) AS best FROM grid JOIN scored s ON rank <= rank_k AND score >= threshold)",
        "nt AS (SELECT s1_id, count(*) AS n_true FROM truth GROUP BY 1)",
        "gq AS (SELECT rank_k, threshold, max_matches, kg.s1_id, count(*) AS n, count(t.cand_id) AS tp FROM kg LEFT JOIN truth t ON t.s1_id = kg.s1_id AND t.cand_id = kg.cand_id WHERE best <= max_matches GROUP BY ALL)",
        "every AS (SELECT grid.*, s1.entity_id AS s1_id FROM grid CROSS JOIN s1)",
        select=f"SELECT rank_k, threshold, 0.0::DOUBLE AS gate, max_matches, avg({_F05.format(n='n', tp='tp')}) AS macro_f05 FROM (SELECT rank_k, threshold, max_matches, coalesce(n, 0) AS n, coalesce(tp, 0) AS tp, coalesce(n_true, 0) AS n_true FROM every LEFT JOIN gq USING (rank_k, threshold, max_matches, s1_id) LEFT JOIN nt USING (s1_id)) GROUP BY ALL"),
    "match_category": _with(_LISTS, _META, select="SELECT entity_id, match_count, match_category FROM meta"),
    "source_coverage": _with(_LISTS, _META, select="SELECT country, source_coverage, count(*) AS n FROM meta GROUP BY ALL"),
    "category_shares": _with(_LISTS, _META, select="SELECT match_category, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM meta) AS share FROM meta GROUP BY 1"),
    "validation_split": _with(_LISTS, _META,
        "tt AS (SELECT country, count(*) AS n_test FROM rec WHERE src = 2 AND country IN (SELECT country FROM meta) GROUP BY 1)",
        "tg AS (SELECT country, round_even((SELECT count(*) FROM meta) * 0.2::DOUBLE * n_test / (SELECT sum(n_test) FROM tt), 0)::BIGINT AS target FROM tt)",
        "st AS (SELECT country, match_category, source_coverage, count(*) AS n, target, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY country) * target AS raw FROM meta JOIN tg USING (country) GROUP BY country, match_category, source_coverage, target)",
        "sb AS (SELECT *, floor(raw) AS base, target - sum(floor(raw)) OVER (PARTITION BY country) AS rest, row_number() OVER (PARTITION BY country ORDER BY raw - floor(raw) DESC, match_category, source_coverage) AS place FROM st)",
        select=f"SELECT entity_id, country, match_count, match_category, source_coverage, CASE WHEN row_number() OVER (PARTITION BY country, match_category, source_coverage ORDER BY {_draw(42, 'entity_id')}, entity_id) <= base + CASE WHEN place <= rest THEN 1 ELSE 0 END THEN 'validation' ELSE 'train' END AS split FROM meta LEFT JOIN sb USING (country, match_category, source_coverage)"),
    "dev_sample": _with(select=f"SELECT entity_id, name, country FROM s1 ORDER BY {_draw(42, 'entity_id')}, entity_id LIMIT 50"),
    "first_by_country": _with(select="SELECT entity_id, country FROM rec QUALIFY row_number() OVER (PARTITION BY country ORDER BY entity_id) <= 20"),
    "hard_negatives": _with(*_ALL, _BEST, "lb AS (SELECT s1_id, cand_id, rank, ((s1_id, cand_id) IN (SELECT s1_id, cand_id FROM truth))::INT AS label FROM best)", "nr AS (SELECT *, label = 1 OR rank <= 2 AS near FROM lb)", select=f"SELECT s1_id, cand_id, rank, label FROM nr QUALIFY near OR row_number() OVER (PARTITION BY s1_id, near ORDER BY {_draw(42, chr(39).join(['s1_id || ', ':', ' || cand_id']))}, cand_id) <= 1"),
    "random_negatives": _with(*_ALL, _BEST, "lb AS (SELECT s1_id, cand_id, ((s1_id, cand_id) IN (SELECT s1_id, cand_id FROM truth))::INT AS label FROM best)", select=f"SELECT s1_id, cand_id, label FROM lb QUALIFY label = 1 OR row_number() OVER (PARTITION BY s1_id ORDER BY {_draw(42, chr(39).join(['s1_id || ', ':', ' || cand_id']))}, cand_id) <= 2"),
    "recall_report": _with(_KEYS.strip(), _PQ, select=f"SELECT {_REPORT}, {_MEDIAN}, 1 - avg(n_cand) / (SELECT count(*)::DOUBLE FROM pool) AS reduction_ratio FROM pq"),
    "recall_by_country": _with(_KEYS.strip(), _PQ, select=f"SELECT country, {_REPORT} FROM pq GROUP BY ROLLUP (country)"),
    "recall_at_k": _with(*_ALL, _BEST, "kq AS (SELECT k, truth.s1_id, count(*) AS n_true, count(*) FILTER (WHERE rank <= k) AS n_found FROM truth LEFT JOIN best USING (s1_id, cand_id) CROSS JOIN (VALUES (1), (2), (3), (5), (8)) v(k) GROUP BY ALL)", select="SELECT k, sum(n_found)::DOUBLE / sum(n_true) AS pairwise_recall, count(*) FILTER (WHERE n_found = n_true)::DOUBLE / count(*) AS full_recall FROM kq GROUP BY 1"),
    "percentile_variants": _with(_KEYS.strip(), _PQ, select="SELECT list_sort(list(n_cand))[round_even(0.9::DOUBLE * (count(*) - 1), 0)::INT + 1] AS nearest, quantile_cont(n_cand, 0.9) AS linear, list_sort(list(n_cand))[floor(0.9::DOUBLE * (count(*) - 1))::INT + 1]::DOUBLE AS floored FROM pq"),
    "run_statistics": _with(_KEYS.strip(), _PQ, select="SELECT count(*) AS n, count(*) FILTER (WHERE n_cand = 0) AS zero, avg(n_cand) AS mean, min(n_cand) AS least, max(n_cand) AS most FROM pq"),
    "union_recall": _with(_KEYS.strip(), _SIGNED.strip(), _LSH.strip(), "un AS (SELECT s1_id, cand_id FROM hits UNION SELECT s1_id, cand_id FROM lsh)", _per("un").strip(), select=f"SELECT {_REPORT}, {_MEDIAN} FROM pq"),
    "missed_matches": _with(_KEYS.strip(), select="SELECT s1_id, cand_id FROM truth EXCEPT SELECT s1_id, cand_id FROM hits"),
    "validate_lists": _with(_LISTS,
        "vl AS (SELECT s1_id, ids FROM lists WHERE right(s1_id, 1) <> '7' UNION ALL VALUES ('S1-none', 'S2-1,S2-1,X9'), ('S1-other', 'S1-5,S3-none'), ('S1-none', ''))",
        "vi AS (SELECT s1_id, unnest(list_filter(string_split(ids, ','), lambda x: x <> '')) AS id FROM vl)",
        """vp AS (SELECT 'duplicate_rows' AS kind, s1_id AS id FROM vl GROUP BY s1_id HAVING count(*) > 1
    UNION ALL SELECT 'duplicate_ids', s1_id FROM vl WHERE len(string_split(ids, ',')) <> len(list_distinct(string_split(ids, ',')))
    UNION ALL SELECT 'self_matches', id FROM vi WHERE id LIKE 'S1-%' UNION ALL SELECT 'wrong_prefix', id FROM vi WHERE NOT regexp_matches(id, '^S[123]-')
    UNION ALL SELECT 'missing_rows', entity_id FROM s1 WHERE entity_id NOT IN (SELECT s1_id FROM vl) UNION ALL SELECT DISTINCT 'extra_rows', s1_id FROM vl WHERE s1_id NOT IN (SELECT entity_id FROM s1)
    UNION ALL SELECT DISTINCT 'unknown_ids', id FROM vi WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT entity_id FROM pool))""",
        select="SELECT kind, count(*) AS n, array_to_string(list_sort(list_distinct(list(id)))[1:5], ', ') AS examples FROM vp GROUP BY 1"),
    "unlisted_matches": _with(_KEYS.strip(), select="SELECT s1_id, cand_id FROM truth EXCEPT SELECT s1_id, cand_id FROM hits"),
}

_ORDERED = "SELECT entity_id AS s1_id, count(cand_id)::INT AS n, coalesce(string_agg(cand_id, ',' ORDER BY score DESC, cand_id), '') AS ids FROM s1 LEFT JOIN hybrid ON s1_id = entity_id GROUP BY 1"
ORACLE_SQL |= {
    "record_files": _with(select="SELECT entity_id, name AS business_name, address AS business_address, coalesce(country, '') AS country FROM pool"),
    "truth_files": _with(select="SELECT s1.entity_id AS s1_id, cand_id FROM s1 LEFT JOIN truth ON s1_id = s1.entity_id"),
    "candidate_files": _with(*_ALL[:4], select=_ORDERED),
    "id_files": _with(select="SELECT entity_id, name, address, country FROM s1 WHERE entity_id IN (SELECT s1_id FROM truth)"),
    "split_files": f"SELECT entity_id, split FROM ({ORACLE_SQL['validation_split']})",
    "truth_metadata": _with(_LISTS, _META, select="SELECT entity_id, country, match_count, match_category, source_coverage FROM meta"),
    "list_union": _with(*_ALL[:4], select="SELECT entity_id AS s1_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS ids FROM s1 LEFT JOIN (SELECT s1_id, cand_id FROM hybrid UNION SELECT s1_id, cand_id FROM truth) u ON u.s1_id = entity_id GROUP BY 1"),
    "stream_block": ORACLE_SQL["hybrid_block_scored"],
}
