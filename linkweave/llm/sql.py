"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from linkweave.llm.imatch import MAX_SHARE, MIN_DOCS, MIN_SHARE, SUBSETS
from linkweave.llm.licenses import COPYRIGHT_LINE, PUNCTUATION, SPELLINGS, known_licenses


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    c = f"regexp_replace(lower({text}), {_q(COPYRIGHT_LINE)}, '', 'g')"
    for pattern, to in SPELLINGS:
        c = f"regexp_replace({c}, {_q(pattern)}, {_q(to.format(chr(92)))}, 'g')"
    c = f"regexp_replace({c}, {_q(PUNCTUATION)}, ' ', 'g')"
    return f"list_filter(list_transform(string_split({c}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


def _op3() -> str:
    known = ", ".join(f"({_q(k)}, {_q(t)})" for k, t in known_licenses())
    return f"""
    WITH known AS (SELECT sha256(array_to_string({_canonical('t')}, ' ')) AS digest, min(license) AS license FROM (VALUES {known}) v(license, t) GROUP BY 1),
    lines AS (SELECT doc_id, {_canonical('text')} AS lines FROM documents WHERE text IS NOT NULL),
    units AS (SELECT doc_id, true AS whole, array_to_string(lines, ' ') AS unit FROM lines UNION ALL SELECT doc_id, false, unnest(lines) FROM lines),
    hits AS (SELECT doc_id, whole, license FROM units JOIN known ON sha256(unit) = digest)
    SELECT doc_id, min(license) FILTER (WHERE whole) AS text_license,
           coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (WHERE NOT whole), '') AS line_licenses,
           count(*) FILTER (WHERE NOT whole) AS n_license_lines
    FROM hits GROUP BY doc_id"""


OP8 = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
p AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
             replace(replace(role, '\', '\\'), '<|', '<\|') AS role_out, replace(replace(text, '\', '\\'), '<|', '<\|') AS text_out FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(text_out) + CASE WHEN role = before THEN length('<|also|>') ELSE length('<|turn|><|says|><|end|>') + length(role_out) END)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id"""

OP7 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f"""

OP9 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                     ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS n_shingles FROM s),
x AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM pairs JOIN n nu ON u = nu.doc_id JOIN n nv ON v = nv.doc_id WHERE 100 * c >= 75 * (nu.n_shingles + nv.n_shingles - c)),
edges AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT e.v, r.root FROM reach r JOIN edges e ON e.u = r.node AND r.root < e.v)
SELECT n.doc_id, n_shingles, min(root) AS component_id, n.doc_id = min(root) AS kept FROM n JOIN reach ON node = n.doc_id GROUP BY n.doc_id, n_shingles"""

def _op2() -> str:
    terms = lambda c: f"list_distinct(list_filter(regexp_split_to_array(lower({c}), '[\\x20\\x09-\\x0D]+'), lambda t: t <> ''))"
    slot = "CASE WHEN {0} = '' THEN '' ELSE substr(md5({0}), 1, 8) END"

    def printed(c: str) -> str:
        parts = []
        for k, part in enumerate(SUBSETS):
            mine = "l" if part == 128 else f"list_filter(l, lambda x: ((('0x' || substr(md5(x), {1 if k < 8 else 17}, 14))::BIGINT >> {7 * (k % 8)}) & 127) < {part})"
            parts.append(slot.format(f"array_to_string({mine}, ' ')"))
        return f"SELECT id, CASE WHEN len(l) = 0 THEN 'text:' || md5(t) ELSE concat_ws('-', {', '.join(parts)}) END AS print FROM (SELECT doc_id AS id, {c} AS t, coalesce(list_sort(x.l), []) AS l FROM e LEFT JOIN (SELECT doc_id AS own, list(term) AS l FROM (SELECT doc_id, unnest({terms(c)}) AS term FROM e) JOIN lexicon USING (term) GROUP BY 1) x ON own = doc_id)"

    like = "CASE WHEN starts_with({0}, 'text:') OR starts_with({1}, 'text:') THEN ({0} = {1})::INT::DOUBLE ELSE len(list_filter(list_zip(string_split({0}, '-'), string_split({1}, '-')), lambda s: s[1] <> '' AND s[1] = s[2]))::DOUBLE / len(list_filter(list_zip(string_split({0}, '-'), string_split({1}, '-')), lambda s: s[1] <> '' OR s[2] <> '')) END"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    n AS (SELECT *, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text FROM d WINDOW w AS (ORDER BY doc_id)),
    e AS (SELECT doc_id, next_id, text, length(text) AS n_chars, substr(text, 1, length(text) - length(text) // 4) || substr(next_text, 1, length(text) // 4) AS edited FROM n),
    lexicon AS (SELECT term FROM (SELECT unnest({terms("text")}) AS term FROM d) GROUP BY term HAVING count(*) >= {MIN_DOCS} AND count(*) * 1000 >= {MIN_SHARE} * (SELECT count(*) FROM d) AND count(*) * 1000 <= {MAX_SHARE} * (SELECT count(*) FROM d)),
    a AS ({printed("text")}), b AS ({printed("edited")})
    SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, a.print AS fingerprint, b.print AS edited_fingerprint,
           {like.format("a.print", "b.print")} AS near_edited, {like.format("a.print", "c.print")} AS near_next
    FROM e JOIN a ON a.id = doc_id JOIN b ON b.id = doc_id JOIN a c ON c.id = next_id"""


ORACLE_SQL = {"op2_fingerprints": _op2(), "op3_license_scan": _op3(), "op7_warc": OP7, "op8_chat_format": OP8, "op9_near_dedup": OP9}
