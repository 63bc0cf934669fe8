"""SQL that the corpus queries must agree with, where SQL can say what they do.

Every statement searches plainly, without the index, automaton, cells or trees of the
operator it belongs to. Trees, token merges, page structure, entropy windows and XXH64 have
no SQL form here; their operators are tested against plain versions instead.
"""

from __future__ import annotations

from shelfline.llm import licenses, urls
from shelfline.llm.mixing import EPOCHS, SHARE, WEIGHTS

_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _ASCII_LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _listed(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _templates() -> str:
    """Licence templates as rows: label, whether base, words, key phrase and its place, least share."""
    rows = []
    for i, (label, text, *key) in enumerate((*licenses.BASE, *licenses.TEMPLATES)):
        words = text.split()
        phrase = (key[0] if key else text).split()
        at = next(k for k in range(len(words)) if words[k : k + len(phrase)] == phrase)
        base = i < len(licenses.BASE)
        rows.append(f"({i}, '{label}', {base}, {_listed(words)}, {_listed(phrase)}, {at}, {1.0 if base else licenses.LEAST}::DOUBLE)")
    return ", ".join(rows)


LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT * FROM (VALUES {_templates()}) AS v(k, label, base, words, phrase, key_at, least)),
df AS (SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct(w)) AS word FROM d) GROUP BY 1),
tw AS (SELECT k, unnest(words) AS word, unnest(range(len(words))) AS j FROM t),
idf AS (SELECT k, j, ln(((SELECT count(*) FROM documents) + 2.0::DOUBLE) / (coalesce(n, 0) + 1.0::DOUBLE)) AS x
  FROM tw LEFT JOIN df USING (word)),
tt AS (SELECT t.*, (SELECT list(x ORDER BY j) FROM idf WHERE idf.k = t.k) AS idf FROM t),
c AS (SELECT r, tt.*, w, unnest(list_filter(range(0, len(w) - len(words) + 1),
    lambda s: w[s + key_at + 1 : s + key_at + len(phrase)] = phrase)) AS s
  FROM d, tt WHERE list_contains(w, phrase[1])),
m AS (SELECT r, label, base, s, least, list_sum(list_transform(range(1, len(words) + 1),
    lambda j: CASE WHEN w[s + j] = words[j] THEN idf[j] ELSE 0.0 END)) / list_sum(idf) AS share FROM c),
g AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word, max(s) FILTER (WHERE base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM m WHERE share >= least - 1e-9 GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(coalesce(score, 0.0::DOUBLE), 6) AS score
FROM d LEFT JOIN g USING (r)"""

CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item, array_to_string(w[s + 1 : s + 10], ' ') AS x, least(len(w), 10) AS n
  FROM (SELECT item, w, unnest(range(0, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT r, n, s, array_to_string(w[s + 1 : s + n], ' ') AS x
  FROM (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
f AS (SELECT r, s, n, item FROM dw JOIN iw USING (x, n)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM f) GROUP BY 1),
g AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM f GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN g USING (r)"""

# CRC-32 by its rule: the remainders of all bytes first, then byte after byte.
_CRC_STEPS = "list_reduce(list_concat([b::BIGINT], repeat([0::BIGINT], 8)), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)"

SHARDING = f"""
WITH crc AS (SELECT list({_CRC_STEPS} ORDER BY b) AS t FROM range(256) AS x(b)),
d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS x FROM documents),
e AS (SELECT *, lower(hex(encode(x))) AS h FROM d),
b AS (SELECT r, doc_id, source, strlen(x) + 1 AS size, xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(range(0, strlen(x)), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295::BIGINT) AS crc FROM e, crc),
k AS (SELECT *, md5('5:' || coalesce(doc_id::VARCHAR, '')) AS key FROM b),
f AS (SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY key) - 1)::DOUBLE / (2 * count(*) OVER (PARTITION BY source)) AS part FROM k),
p AS (SELECT *, row_number() OVER (ORDER BY part, key, source IS NULL, coalesce(source, '')) - 1 AS place, count(*) OVER () AS n FROM f),
s AS (SELECT *, place * 16 // n AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, shard::INT AS shard,
  (row_number() OVER (PARTITION BY shard ORDER BY place) - 1)::BIGINT AS slot, NULL::INT AS grown_shard FROM s"""

TOP_K = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5"""

MIXING = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  md5('8:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS turn FROM d GROUP BY source),
w AS (SELECT *, [{', '.join(f'{x}::DOUBLE' for x in WEIGHTS)}][turn % {len(WEIGHTS)} + 1] AS weight, {EPOCHS}.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * {SHARE}::DOUBLE - (sum(cap) OVER o - cap)) / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, turn)),
t AS (SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM l),
b AS (SELECT *, floor(target + 0.5)::BIGINT AS budget FROM t),
c AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS rounds FROM b),
p AS (SELECT doc_id, size, source_size, target, rounds, budget - rounds * source_size AS rest,
  sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size::BIGINT AS size, source_size, round(target, 6) AS target,
  (rounds * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM p"""

DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
v AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM o GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
l AS (SELECT lang, count(*)::HUGEINT AS terms, sum(total)::HUGEINT AS n FROM v GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM o JOIN v USING (lang, term) GROUP BY 1, 2, 3),
gn AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
p AS MATERIALIZED (SELECT lang, source, term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (gn.total + 2 * terms) AS p,
    1 + (1000000000::HUGEINT * (v.total + 2)) // (l.n + 2 * terms) AS q
  FROM gn JOIN l USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
parts AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pairs LEFT JOIN apart USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, row_number() OVER w::INT AS rank FROM parts
WINDOW w AS (PARTITION BY lang, source, part ORDER BY value DESC, item) QUALIFY part = 'pair' OR row_number() OVER w <= 10"""

# Words one edit apart: one replaced letter leaves two words equal without it, one more letter
# leaves the longer word equal to the other without it.
SPELLING = rf"""
WITH crc AS (SELECT list({_CRC_STEPS} ORDER BY b) AS t FROM range(256) AS x(b)),
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS x FROM documents),
u AS (SELECT id, x, count(*) AS n, lower(hex(encode(id || ':' || x))) AS h FROM r GROUP BY 1, 2),
k AS (SELECT x, n, xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS h FROM u, crc),
m AS (SELECT n, CASE WHEN h % 97 = 0 THEN substr(x, 1, (h % length(x))::INT) || substr(x, (h % length(x))::INT + 2) ELSE x END AS word FROM k),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM m GROUP BY 1 HAVING sum(n) >= 3 AND length(word) >= 5),
s AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM w)),
e AS (SELECT a.word, b.word AS near, b.n FROM s a JOIN s b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM s JOIN w ON s.short = w.word
  UNION SELECT w.word, s.word, s.n FROM s JOIN w ON s.short = w.word),
b AS (SELECT word, count(*)::BIGINT AS n_near, max(n) AS most FROM e GROUP BY 1),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN most >= 2 * w.n THEN (SELECT min(near) FROM e WHERE e.word = w.word AND e.n = most) END AS form,
    CASE WHEN most >= 2 * w.n THEN most END AS form_n FROM w LEFT JOIN b USING (word)),
z AS (WITH RECURSIVE up AS (SELECT word, word AS root, form AS next FROM f
  UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON f.word = up.next) SELECT word, root FROM up WHERE next IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN z USING (word)"""


def _url_verdicts() -> str:
    """Rules as rows, and every step of trust and distrust as a table."""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)
    host = _ASCII_LOWER.format(f"regexp_extract(coalesce({{0}}, ''), '{urls.HOST}', 1)")
    path = f"regexp_extract(coalesce(url, ''), '{urls.HOST}', 2)"
    link = urls.LINK.replace("'", "''")
    part = f"floor({{0}}::DOUBLE * {urls.DAMPING}::DOUBLE * n::DOUBLE / total::DOUBLE)::BIGINT"
    steps = "".join(
        f"""s{k + 1} AS MATERIALIZED (SELECT host, sum(trust)::BIGINT AS trust, sum(distrust)::BIGINT AS distrust, sum(t)::BIGINT AS t, sum(d)::BIGINT AS d FROM (
  SELECT host, trust + t AS trust, distrust + d AS distrust, 0 AS t, 0 AS d FROM s{k}
  UNION ALL SELECT dst, 0, 0, {part.format("t")}, 0 FROM s{k} JOIN ahead ON host = src
  UNION ALL SELECT src, 0, 0, 0, {part.format("d")} FROM s{k} JOIN back ON host = dst) GROUP BY 1),
"""
        for k in range(urls.ROUNDS)
    )
    return f"""
WITH rules AS (SELECT * FROM (VALUES {rules}) AS v(rule_host, rule_path, ruled)),
p AS MATERIALIZED (SELECT row_number() OVER () AS r, page_id, {host.format("url")} AS host, {path} AS path, html FROM pages),
f AS (SELECT r, rule_host || rule_path AS rule, ruled FROM p JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1),
j AS MATERIALIZED (SELECT p.*, rule, ruled FROM p LEFT JOIN f USING (r)),
h AS MATERIALIZED (SELECT host, count(*) AS n_pages, count(*) FILTER (WHERE ruled = 'allow') * {urls.UNIT} AS t,
  count(*) FILTER (WHERE ruled = 'block') * {urls.UNIT} AS d FROM j WHERE host <> '' GROUP BY 1),
a AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) AS x FROM p),
b AS (SELECT src, {host.format("CASE WHEN starts_with(x, '//') THEN 'http:' || x ELSE x END")} AS dst FROM a),
c AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM b WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
ahead AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY src) AS total FROM c),
back AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY dst) AS total FROM c),
s0 AS MATERIALIZED (SELECT host, 0 AS trust, 0 AS distrust, t, d FROM h),
{steps}bad AS (SELECT host FROM s{urls.ROUNDS} s JOIN h USING (host)
  WHERE (distrust + s.d) - (trust + s.t) > n_pages * {urls.UNIT * urls.THRESHOLD}::DOUBLE)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM j"""


ORACLES: dict[str, str] = {
    "op1_license_scan": LICENSES,
    "op3_decontamination": CONTAMINATION,
    "op5_sharding": SHARDING,
    "op6_exact_top_k": TOP_K,
    "op8_source_mixing": MIXING,
    "op11_source_divergence": DIVERGENCE,
    "op12_spelling_variants": SPELLING,
    "op13_url_filter": _url_verdicts(),
}
