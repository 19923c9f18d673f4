"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import licences, passages, repetition

WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def _covered(n: int, later: bool) -> str:
    """Whether each word lies in a repeated window of n words; needs w(r, i, word, len)."""
    least = "earlier > 1" if later else "often > 1"
    return f"""g{n} AS (
    SELECT r, i, row_number() OVER (PARTITION BY r, gram ORDER BY i) AS earlier, count(*) OVER (PARTITION BY r, gram) AS often
    FROM (SELECT r, i, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS gram,
                 count(*) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS long
          FROM w)
    WHERE long = {n}),
c{n} AS (
    SELECT r, count(*) AS words, sum(length(word)) AS chars
    FROM (SELECT w.r, word, max(CASE WHEN {least} THEN 1 ELSE 0 END) OVER
                 (PARTITION BY w.r ORDER BY w.i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside
          FROM w LEFT JOIN g{n} USING (r, i))
    WHERE inside = 1 GROUP BY r)"""


def _repetition_sql() -> str:
    limits = repetition.GRAM_LIMITS
    parts = ",\n".join(
        [_covered(repetition.BASE_WINDOW, later=False)] + [_covered(n, later=True) for n in limits]
    )
    joins = "\n".join(f"LEFT JOIN c{n} ON c{n}.r = d.r" for n in (repetition.BASE_WINDOW, *limits))
    chars = {n: f"coalesce(c{n}.chars, 0)" for n in limits}
    shares = ", ".join(f"{c} / greatest(word_chars, 1)::DOUBLE" for c in chars.values())
    low = " AND ".join(f"100 * repeat_chars_{n} <= {limit} * word_chars" for n, limit in limits.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
w AS (SELECT r, i, words[i] AS word FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM d)),
{parts},
n AS (SELECT r, sum(length(word)) AS word_chars FROM w GROUP BY r),
l AS (SELECT r, line, row_number() OVER (PARTITION BY r, line) AS earlier FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT r, count(*) AS lines, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS chars FROM l WHERE earlier > 1 GROUP BY r),
m AS (SELECT doc_id, len(d.words)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.lines, 0)::BIGINT AS n_dup_lines, coalesce(c{repetition.BASE_WINDOW}.words, 0)::BIGINT AS n_repeat_words,
    {", ".join(f"{c}::BIGINT AS repeat_chars_{n}" for n, c in chars.items())},
    coalesce(dup.chars, 0)::BIGINT AS dup_line_chars,
    greatest({shares}) AS repeat_share
  FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN dup ON dup.r = d.r
  {joins})
SELECT *, n_words < {repetition.LEAST_WORDS} OR 100 * n_repeat_words > {repetition.BASE_LIMIT} * n_words AS base_failed,
    NOT (n_words < {repetition.LEAST_WORDS} OR 100 * n_repeat_words > {repetition.BASE_LIMIT} * n_words)
    AND {low} AND 100 * dup_line_chars <= {repetition.LINE_LIMIT} * word_chars AS kept
FROM m
"""


REPETITION_SQL = _repetition_sql()


def _licence_sql() -> str:
    templates = licences.Templates(licences.TEMPLATES, licences.BASE_PHRASES, licences.CONTAINMENT)
    rows = ", ".join(
        f"({i}, {[*words]!r}, '{label}', {need}, {base}, {width})"
        for i, (words, label, need, base, width) in enumerate(templates.rows)
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH t(id, words, label, need, base, width) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
q AS (SELECT r, words, i - 1 AS place, words[i] AS word FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM d
        WHERE len(words) > 0)),
p AS (SELECT r, t.label, place FROM q JOIN t ON t.base AND t.words[1] = q.word
        AND q.words[place + 1 : place + len(t.words)] = t.words),
b AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY r),
o AS (SELECT id, need, label, width, len(list_distinct(words)) AS size, unnest(list_distinct(words)) AS word FROM t WHERE NOT base),
held AS (SELECT r, id, need, label, width, size, place, word FROM q JOIN o USING (word)),
near AS (SELECT * FROM held SEMI JOIN (SELECT r, id FROM held GROUP BY r, id, need HAVING count(DISTINCT word) >= need) USING (r, id)),
win AS (SELECT x.r, x.id, x.place, x.label, x.need, x.size, count(DISTINCT y.word) AS shared FROM near x JOIN near y
    ON x.r = y.r AND x.id = y.id AND y.place BETWEEN x.place AND x.place + x.width - 1 GROUP BY ALL),
m AS (SELECT r, label, max(shared / size::DOUBLE) AS share FROM win WHERE shared >= need GROUP BY r, label),
u AS (SELECT r, label, 1.0::DOUBLE AS share FROM p UNION ALL SELECT r, label, share FROM m),
a AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM u GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
    first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN a USING (r)
"""


LICENCE_SQL = _licence_sql()

NEAREST_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])))) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM s) WHERE rank <= 10
"""

_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:@\[\]]+)', 1))"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^?#]*)', 1)"
URL_SQL = f"""
WITH c AS (SELECT row_number() OVER () AS r, page_id,
    TIMESTAMP '2024-01-01' + to_days((page_id * 37 % 400)::INT) + to_hours((page_id % 24)::INT) AS fetched_at,
    {_HOST} AS host, string_split({_PATH}, '/') AS parts FROM pages),
k AS (SELECT r, fetched_at, -length(key) AS place, 1 AS parent, key FROM (
        SELECT r, fetched_at, host || '/' || array_to_string(parts[1:i], '/') AS key
        FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM c WHERE host <> '')) WHERE key NOT LIKE '%/'
    UNION ALL SELECT r, fetched_at, i AS place, 2 AS parent, array_to_string(string_split(host, '.')[i:], '.') AS key
    FROM (SELECT *, unnest(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1)) AS i FROM c WHERE host <> '')),
listed AS (SELECT DISTINCT key FROM k WHERE len(string_split(key, '/')) <= 4),
turns AS (SELECT key AS pattern, md5(key || '#' || turn) AS digest FROM listed, range(3) x(turn)),
e AS (SELECT pattern, TIMESTAMP '2024-01-01' + to_days((('0x' || substr(digest, 1, 6))::BIGINT % 400)::INT)
        + to_hours((('0x' || substr(digest, 9, 4))::BIGINT % 24)::INT) AS valid_from,
    max(CASE ('0x' || substr(digest, 7, 1))::BIGINT % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'allow' ELSE 'remove' END) AS action
    FROM turns GROUP BY 1, 2),
v AS (SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY pattern ORDER BY valid_from), TIMESTAMP '9999-12-31') AS valid_to FROM e),
b AS (SELECT r, min_by(action, (parent, place)) AS action, min_by(pattern, (parent, place)) AS pattern FROM k JOIN v
    ON k.key = v.pattern AND fetched_at >= valid_from AND fetched_at < valid_to AND action <> 'remove' GROUP BY r)
SELECT page_id, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at, coalesce(action, 'none') AS verdict, pattern
FROM c LEFT JOIN b USING (r)
"""

FILL_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
c AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS one, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS two,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
         WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[1 : least(one, two)], '') AS prefix, array_to_string(u[greatest(one, two) + 1 :], '') AS suffix,
    array_to_string(u[least(one, two) + 1 : greatest(one, two)], '') AS middle FROM c)
SELECT doc_id, len(u)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                     WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""


def _passage_sql() -> str:
    def words(columns: str, of: str) -> str:
        lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"SELECT {columns}, regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM {of}"

    slop = passages.SLOP
    return f"""
WITH d AS ({words("row_number() OVER () AS r, doc_id", "documents")}),
i AS (SELECT *, least({passages.WINDOW}, len(words)) AS size FROM ({words("item_id", "benchmark")}) WHERE len(words) > 0),
w AS (SELECT row_number() OVER () AS id, * FROM (SELECT item_id, size, words[s + 1 : s + size] AS gram
        FROM (SELECT *, unnest(range(0, len(words) - size + 1)) AS s FROM i))),
g AS (SELECT r, s, size, words[s + 1 : s + size] AS gram
        FROM (SELECT r, words, size, unnest(range(0, len(words) - size + 1)) AS s FROM d, (SELECT DISTINCT size FROM w))),
exact AS (SELECT r, s, g.size, item_id FROM g JOIN w USING (gram)),
hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + size)) FROM exact) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
        FROM exact GROUP BY r),
place AS (SELECT r, i - 1 AS p, words[i] AS term FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM d)),
often AS (SELECT term, count(*) AS n FROM place GROUP BY term),
rarest AS (SELECT id, j, term FROM (SELECT id, i - 1 AS j, gram[i] AS term FROM (SELECT id, gram, unnest(range(1, size + 1)) AS i FROM w))
        JOIN often USING (term) QUALIFY row_number() OVER (PARTITION BY id ORDER BY n, j) = 1),
spot AS (SELECT DISTINCT id, r, p - j + off AS s FROM rarest JOIN place USING (term), range(-{slop}, {slop} + 1) x(off)),
near AS (SELECT r, count(DISTINCT item_id) AS n_near_items FROM spot JOIN w USING (id) JOIN d USING (r)
        WHERE len(list_filter(range(0, size), lambda k: list_contains(
            words[greatest(1, s + k - {slop} + 1) : greatest(0, s + k + {slop} + 1)], gram[k + 1]))) = size GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
    coalesce(n_near_items, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN near USING (r)
"""


PASSAGE_SQL = _passage_sql()

RUNS_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS own,
    xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
        lambda sum, byte: list_reduce([xor(sum, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, (a & 1) * 3988292384)))) AS h
  FROM documents),
g AS (SELECT *, len(own) AS n, h // 10 AS g, (h // 10) % len(own) AS a FROM d),
t AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i:
        own[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE own END AS words FROM g),
w AS (SELECT r, n, i - 1 AS i, words[i] AS word FROM (SELECT r, n, words, unnest(range(1, n + 1)) AS i FROM t)),
pair AS (SELECT x.r, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretch AS (SELECT r, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pair)
    GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT * FROM stretch x WHERE NOT EXISTS (SELECT 1 FROM stretch y WHERE y.r = x.r AND y.q < x.q AND x.q % y.q = 0
    AND y.start <= x.start AND y.start + y.length >= x.start + x.length)),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / q DESC, start, q) = 1),
every AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines
    FROM run GROUP BY r),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS words FROM w WHERE NOT EXISTS
    (SELECT 1 FROM run WHERE run.r = w.r AND w.i >= start + q AND w.i < start + length) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, q::BIGINT AS period,
    (1000 * length // q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
    sha256(coalesce(kept.words, '')) AS collapsed_sha256
FROM t LEFT JOIN best USING (r) LEFT JOIN every USING (r) LEFT JOIN kept USING (r)
"""
