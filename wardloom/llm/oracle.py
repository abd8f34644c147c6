"""SQL checks of the text operators, where SQL can express them; the others are tested against brute force.

op1 (a fitted classifier), op2 (determinants found in steps), op3 (rounds of best fit), op5 (dependent rounding), op10 (HTML), op11 (tokenizers) and
op13 (approximate) have none.
"""

from __future__ import annotations

from wardloom.llm.queries import LISTED_WORDS, URL_RULES

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4 = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
s AS (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)])
                               WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)),
both_ways AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON b.x = r.other)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
OP6 = rf"""
WITH RECURSIVE c AS (
    SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i, len(regexp_extract_all(text, '{WORD}')) + 4 AS tokens,
           len('<s>[INST]  [/INST]</s>') + len(regexp_replace(role, '{CONTROL}', '\1\2\\\3', 'g'))
           + len(regexp_replace(text, '{CONTROL}', '\1\2\\\3', 'g')) AS chars
    FROM c),
sys AS (SELECT conv_id, min(i) AS i FROM t WHERE role = 'system' GROUP BY conv_id),
sy AS (SELECT sys.conv_id, sys.i, t.tokens, t.chars FROM sys JOIN t ON t.conv_id = sys.conv_id AND t.i = sys.i),
walk AS (
    SELECT t.conv_id, t.i, t.tokens AS used, t.i AS start FROM t WHERE t.i = 0
    UNION ALL
    SELECT t.conv_id, t.i, CASE WHEN walk.used + t.tokens > 1024 - 256 - coalesce(sy.tokens, 0) THEN t.tokens ELSE walk.used + t.tokens END,
           CASE WHEN walk.used + t.tokens > 1024 - 256 - coalesce(sy.tokens, 0) THEN t.i ELSE walk.start END
    FROM walk JOIN t ON t.conv_id = walk.conv_id AND t.i = walk.i + 1 LEFT JOIN sy ON sy.conv_id = t.conv_id),
spans AS (SELECT conv_id, start, max(i) + 1 AS stop FROM walk GROUP BY conv_id, start),
back AS (
    SELECT spans.*, CASE WHEN a.tokens IS NULL OR a.tokens > 256 THEN 0 WHEN b.tokens IS NULL OR a.tokens + b.tokens > 256 THEN 1 ELSE 2 END AS again
    FROM spans LEFT JOIN t a ON a.conv_id = spans.conv_id AND a.i = start - 1 LEFT JOIN t b ON b.conv_id = spans.conv_id AND b.i = start - 2),
shown AS (
    SELECT back.conv_id, start, sum(t.chars) + max(CASE WHEN sy.i < start - again THEN sy.chars ELSE 0 END) AS chars
    FROM back JOIN t ON t.conv_id = back.conv_id AND t.i >= start - again AND t.i < stop LEFT JOIN sy ON sy.conv_id = back.conv_id
    GROUP BY back.conv_id, start),
whole AS (SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM shown GROUP BY conv_id),
d AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS turns,
           coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS loss
    FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(len(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM d JOIN whole USING (conv_id)
"""


def _op7() -> str:
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)
    words = ", ".join(f"'{w}'" for w in LISTED_WORDS)
    return rf"""
WITH p AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
           regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
best AS (
    SELECT page_id, arg_max(rule_host || rule_path, len(rule_host || rule_path)) AS rule, arg_max(verdict, len(rule_host || rule_path)) AS verdict
    FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT p.page_id, host, path, best.rule,
       coalesce(best.verdict, CASE WHEN list_has_any(regexp_split_to_array(host, '[.-]'), [{words}]) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best USING (page_id)
"""


OP8 = rf"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
c AS (SELECT *, len(regexp_extract_all(line, '{WORD}')) AS w FROM l),
e AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS ends FROM c),
ahead AS (
    SELECT s.doc_id, s.pos AS first_, min(e.pos) AS last_ FROM e s JOIN e ON e.doc_id = s.doc_id AND e.pos >= s.pos AND e.ends - (s.ends - s.w) >= 50 GROUP BY ALL),
behind AS (
    SELECT e.doc_id, max(s.pos) AS first_, e.pos AS last_ FROM e JOIN e s ON e.doc_id = s.doc_id AND s.pos <= e.pos AND e.ends - (s.ends - s.w) >= 50
    GROUP BY e.doc_id, e.pos),
runs AS (SELECT doc_id, first_, last_ FROM ahead UNION SELECT doc_id, first_, last_ FROM behind),
named AS (SELECT runs.*, array_to_string(ls[first_:last_], chr(10)) || chr(10) || (last_ - first_) AS content FROM runs JOIN d USING (doc_id)),
firsts AS (SELECT content, min(struct_pack(d := doc_id, p := first_)) AS earliest FROM named GROUP BY content HAVING count(*) > 1),
copies AS (SELECT doc_id, first_, last_ FROM named JOIN firsts USING (content) WHERE struct_pack(d := doc_id, p := first_) > earliest),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM l JOIN copies ON copies.doc_id = l.doc_id AND l.pos BETWEEN first_ AND last_),
islands AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM gone),
counts AS (SELECT doc_id, count(*) AS n_deleted, count(DISTINCT island) AS n_runs FROM islands GROUP BY doc_id),
left_ AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) AS text FROM l ANTI JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = l.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(left_.text, '') END AS text, coalesce(n_deleted, 0) AS n_deleted,
       coalesce(n_runs, 0) AS n_runs, coalesce(n_deleted, 0) > 0 AND NOT regexp_matches(coalesce(left_.text, ''), '[^\x20\x09-\x0D]') AS emptied
FROM d LEFT JOIN left_ USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

OP9 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP12 = rf"""
WITH w AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS ws
    FROM documents WHERE doc_id IS NOT NULL),
lengths AS (SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n FROM w WHERE len(ws) > 0),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM w) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM f GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, whole),
q AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark WHERE item_id IS NOT NULL) GROUP BY ALL),
m AS (SELECT r, doc_id, 75 + (25 * n * n_docs) // n_terms AS m FROM lengths, whole),
scored AS (
    SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM q JOIN weights USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY item_id, r),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def registered() -> dict[str, str]:
    return {
        "op4_size_aware_jaccard": OP4,
        "op6_budgeted_windows": OP6,
        "op7_bloom_cascade": _op7(),
        "op8_line_suffix_array": OP8,
        "op9_pivot_topk": OP9,
        "op12_ranked_lexical": OP12,
    }
