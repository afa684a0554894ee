"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

#: Words of a text, split at ASCII whitespace (an empty list for null).
_RAW_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_RAW_WORDS} AS w FROM documents),
word AS (SELECT rid, unnest(range(len(w))) AS p, unnest(w) AS x FROM d),
win AS (SELECT rid, p, md5(string_agg(x, ' ') OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) AS h,
               lead(p, 34) OVER (PARTITION BY rid ORDER BY p) AS whole FROM word),
rep AS (SELECT rid, p, count(*) OVER (PARTITION BY h) AS n FROM win WHERE whole IS NOT NULL),
mark AS (SELECT rid, p, x, max(coalesce(n, 0)) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) > 1 AS gone
         FROM word LEFT JOIN rep USING (rid, p)),
kept AS (SELECT rid, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM mark WHERE NOT gone GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""

OP2 = r"""
WITH d AS (SELECT doc_id, text, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\r\x0B\x0C]')) AS w FROM documents),
line AS (SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS x FROM d),
pair AS (SELECT a.doc_id, a.p, row_number() OVER (PARTITION BY a.x, b.x ORDER BY a.doc_id, a.p) AS nth
         FROM line a JOIN line b ON b.doc_id = a.doc_id AND b.p = a.p + 1),
solo AS (SELECT doc_id, p, row_number() OVER (PARTITION BY x ORDER BY doc_id, p) AS nth FROM line
         WHERE len(regexp_extract_all(x, '[^ \t\n\r\x0B\x0C]+')) >= 20),
gone AS (SELECT doc_id, p FROM pair WHERE nth > 1 UNION SELECT doc_id, p + 1 FROM pair WHERE nth > 1 UNION SELECT doc_id, p FROM solo WHERE nth > 1),
left_ AS (SELECT doc_id, count(*) AS n, string_agg(x, chr(10) ORDER BY p) AS t FROM line ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_lines, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(CASE WHEN len(w) = coalesce(n, 0) THEN text ELSE coalesce(t, '') END) AS kept_sha256
FROM d LEFT JOIN left_ USING (doc_id)"""

_ALNUM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_ALNUM_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark),
phrase AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS t
           FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
word AS (SELECT rid, unnest(range(len(w))) AS p, unnest(w) AS x FROM d),
size AS (SELECT DISTINCT n FROM phrase),
place AS (SELECT rid, p, n, list(x) OVER (PARTITION BY rid, n ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS v FROM word, size),
found AS (SELECT DISTINCT rid, p, n, item_id FROM (SELECT rid, p, n, array_to_string(v[1:n], ' ') AS t FROM place WHERE len(v) >= n) JOIN phrase USING (n, t)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS p FROM found) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)"""

#: Three rakings a sweep; twenty sweeps meet the targets far below the digits compared.
OP5 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, text, source, lang, len({_RAW_WORDS})::BIGINT AS n,
         CASE WHEN contains(text, ' | ') THEN 'table' WHEN regexp_matches(text, '[#$%&*][#$%&*][#$%&*]') THEN 'markup'
              WHEN contains(text, '!! ') THEN 'upper' WHEN contains(text, 'icense') THEN 'notice' ELSE 'prose' END AS topic FROM documents),
cell AS (SELECT source, lang, topic, sum(n)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(n) > 0),
share AS (SELECT *, sum(tokens) OVER (PARTITION BY source) ** 0.5 AS s, sum(tokens) OVER (PARTITION BY lang) ** 0.7 AS l, sum(tokens) OVER (PARTITION BY topic) AS t FROM cell),
target AS (SELECT source, lang, topic, tokens, s / (SELECT sum(x) FROM (SELECT DISTINCT source, s AS x FROM share)) AS ts,
                  l / (SELECT sum(x) FROM (SELECT DISTINCT lang, l AS x FROM share)) AS tl,
                  t / (SELECT sum(x) FROM (SELECT DISTINCT topic, t AS x FROM share)) AS tt FROM share),
ipf AS (SELECT 0 AS step, *, tokens AS w FROM target
        UNION ALL
        SELECT step + 1, source, lang, topic, tokens, ts, tl, tt, CASE step % 3
                 WHEN 0 THEN w * ts / sum(w) OVER (PARTITION BY source)
                 WHEN 1 THEN w * tl / sum(w) OVER (PARTITION BY lang)
                 ELSE w * tt / sum(w) OVER (PARTITION BY topic) END FROM ipf WHERE step < 60),
prob AS (SELECT source, lang, topic, w / tokens / (SELECT max(w / tokens) FROM ipf WHERE step = 60) AS p FROM ipf WHERE step = 60),
chance AS (SELECT doc_id, text, n, d.topic AS topic, CASE WHEN n > 0 THEN coalesce(p, 0) ELSE 0 END AS p
           FROM d LEFT JOIN prob ON d.source IS NOT DISTINCT FROM prob.source AND d.lang IS NOT DISTINCT FROM prob.lang AND d.topic = prob.topic)
SELECT doc_id, n AS n_tokens, topic, round(p, 6) AS probability,
       ('0x' || substr(md5(concat_ws(':', 'mix', doc_id::VARCHAR, text)), 1, 13))::BIGINT / 4503599627370496.0 < p AS kept FROM chance"""

#: Length of an escaped text: one more for every place where a control string begins, also inside another.
_MARKED = r"""(length(text) + len(list_filter(range(1, length(text) + 1), lambda i: text[i] IN ('<', '[')
  AND regexp_matches(text[i:], '^[<\[]\\*(/?INST\]|/?s>|</?SYS>>|\|[^|\n]*\|>)'))))"""

OP8 = f"""
WITH m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({_MARKED} + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 ELSE length(role) + 13 END)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id"""

_PIECES = r"regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')"

#: Phrases as lists of words; counts of more than 64 bits on the way are HUGEINT.
OP13 = f"""
WITH piece AS (SELECT row_number() OVER () AS pid, lang, p FROM (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS p FROM documents)),
split AS (SELECT pid, lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
gram AS (SELECT lang, w[i:i + k - 1] AS g FROM place, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, g, count(*) AS a FROM gram GROUP BY lang, g HAVING count(*) >= 100),
cut AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1),
scored AS (SELECT c.lang, c.g, c.a, c.k, x.a AS l, y.a AS r, n, (1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS score
           FROM cut c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:] JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
sub AS (SELECT lang, a, g[i:j] AS g FROM (SELECT lang, a, g, i, unnest(range(i + 1, len(g) + 1)) AS j FROM (SELECT lang, a, g, unnest(range(1, len(g))) AS i FROM f WHERE len(g) > 2)) WHERE j - i + 1 < len(g)),
inside AS (SELECT lang, g, max(a) AS longer FROM sub GROUP BY lang, g),
ranked AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM best LEFT JOIN inside USING (lang, g) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked QUALIFY rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1, "op2_line_dedup": OP2, "op4_benchmark_decontamination": OP4, "op5_source_mixing": OP5, "op8_chat_formatting": OP8, "op13_collocations": OP13}
