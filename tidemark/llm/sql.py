"""DuckDB SQL of the queries that SQL can express."""

from .quality import BOILERPLATE
from .url_filter import TWO_LABELS

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_PHRASES = "|".join(BOILERPLATE).replace("'", "''")
_HOST = "regexp_replace(regexp_replace({}, '^.*@', ''), ':[0-9]*$', '')"


def _labels(host: str, n: int) -> str:
    """The last n labels of a host, one more where two make the suffix."""
    return f"array_to_string(list_slice(string_split({host}, '.'), CASE WHEN regexp_matches({host}, '{TWO_LABELS}') THEN -{n + 1} ELSE -{n} END, -1), '.')"


_FIT = """(SELECT CASE WHEN k = 0 OR t = 0 THEN 1000.0 ELSE 1 / least(greatest(coalesce((bb - 2 * p0 * b + p0 * p0 * t - p0 * (1 - p0) * (k - 1)) / nullif(p0 * (1 - p0) * (t - nn / t - (k - 1)), 0), 0), 1.0 / 1001), 0.5) - 1 END
    FROM (SELECT coalesce(sum(bad * bad / n), 0.0) AS bb, coalesce(sum(bad), 0.0) AS b, coalesce(sum(n), 0.0) AS t, coalesce(sum(n * n), 0.0) AS nn, count(*) AS k FROM {g}), corpus)"""

SQL: dict[str, str] = {
    "op3_cover_tree": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.r AS query, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST) AS INT) AS rank, vec_id, score FROM s QUALIFY rank <= 5""",
    "op5_url_filter": rf"""
WITH p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), {_AZ}), '') AS host, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
o AS (SELECT {_HOST.format("host")} AS host, CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS bad FROM labels JOIN p ON p.page_id = labels.doc_id WHERE (quality = 0 OR toxic = 1) IS NOT NULL),
hosts AS (SELECT host, {_labels("host", 2)} AS domain, {_labels("host", 1)} AS suffix, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad FROM o GROUP BY 1, 2, 3),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY 1),
corpus AS (SELECT (coalesce(sum(bad), 0.0) + 1) / (coalesce(sum(n), 0.0) + 2) AS p0, coalesce(sum(bad), 0.0) + 1 AS a0, coalesce(sum(n) - sum(bad), 0.0) + 1 AS b0 FROM suffixes),
fit AS (SELECT p0, a0, b0, {_FIT.format(g="suffixes")} AS m1, {_FIT.format(g="domains")} AS m2, {_FIT.format(g="hosts")} AS m3 FROM corpus),
s AS (SELECT suffix, m1 * p0 + bad AS a1, m1 * (1 - p0) + n - bad AS b1 FROM suffixes, fit),
dd AS (SELECT domain, m2 * a1 / (a1 + b1) + bad AS a2, m2 * (1 - a1 / (a1 + b1)) + n - bad AS b2 FROM domains JOIN s USING (suffix), fit),
h AS (SELECT host, m3 * a2 / (a2 + b2) + bad AS a3, m3 * (1 - a2 / (a2 + b2)) + n - bad AS b3 FROM hosts JOIN dd USING (domain), fit),
j AS (SELECT page_id, p.host, path, coalesce(a3, a2, a1, a0) AS a, coalesce(b3, b2, b1, b0) AS b FROM (SELECT *, {_HOST.format("host")} AS bare FROM p) p LEFT JOIN h ON h.host = p.bare
    LEFT JOIN dd ON dd.domain = {_labels("p.bare", 2)} LEFT JOIN s ON s.suffix = {_labels("p.bare", 1)}, fit),
r AS (SELECT *, CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/7') THEN 'example.com/en/7'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/de/8') THEN 'example.net/de/8'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/en/') THEN 'com/en/' WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/de/') THEN 'net/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/es/') THEN 'org/es/' END AS rule FROM j)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/7', 'net/de/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.25 THEN 'block' ELSE 'allow' END AS verdict FROM r""",
    "op6_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
dup AS (SELECT doc_id, g FROM tri GROUP BY 1, 2 HAVING count(*) > 1),
pos AS (SELECT DISTINCT doc_id, i + k AS p FROM tri JOIN dup USING (doc_id, g), (VALUES (0), (1), (2)) o(k)),
rep AS (SELECT doc_id, count(*) AS n FROM pos GROUP BY 1),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT *, list_filter(lines, lambda x: (len(regexp_extract_all(x, ' [|] ')) < 3 OR len(regexp_extract_all(x, ' [|] ')) * 4 < len(regexp_extract_all(x, '[ \t]+')) + 1)
    AND (len(regexp_extract_all(x, '[#*$%&|<>]')) < 3 OR len(regexp_extract_all(x, '[#*$%&|<>]')) * 10 <= (len(regexp_extract_all(x, '[ \t]+')) + 1) * 3)
    AND (len(regexp_extract_all(x, '[!?]')) < 3 OR len(regexp_extract_all(x, '[!?]')) * 10 <= (len(regexp_extract_all(x, '[ \t]+')) + 1) * 3)
    AND (len(regexp_extract_all(x, '[ \t]+')) >= 3 OR regexp_matches(x, '[.!?:;…)"''»”]\s*$'))
    AND NOT regexp_matches(lower(x), '{_PHRASES}')) AS good FROM l),
c AS (SELECT g.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, length(array_to_string(good, chr(10))) AS kept_chars, length(array_to_string(lines, chr(10))) AS all_chars FROM g LEFT JOIN rep ON rep.doc_id = g.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND all_chars > 0 AND CAST(kept_chars AS DOUBLE) / nullif(all_chars, 0) >= 0.5 AS kept FROM c""",
    "op7_near_dedup": rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), {_AZ})")} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM d UNION SELECT node, b FROM reach JOIN e ON e.a = other),
m AS (SELECT node, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op11_chat_tree": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')) f)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256, CAST(sum(CASE WHEN role = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN t END, '' ORDER BY turn), '')) AS loss_sha256,
    CAST(sum(length('<|im_start|>' || role || '<|im_end|>') + 2 + length(t) + len(regexp_extract_all(t, '<\\*[|]'))) AS BIGINT) AS formatted_chars FROM c GROUP BY conv_id""",
    "op13_fill_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT doc_id, t, n, least(c1, c2) AS i, greatest(c1, c2) - least(c1, c2) AS m,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, substring(t, 1, i) AS pre, substring(t, i + 1, m) AS mid, substring(t, i + m + 1, n) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN m END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p""",
}
