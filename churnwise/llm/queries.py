"""Registered queries of the training-data operators, and their oracle SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnwise.llm import ann, decontaminate, merkle, minhash, mix, pii, ppm, quality, suffixes, tokens, toxicity, trie, urls
from churnwise.llm.tables import table


def op1_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(table(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.report(table(spark, sf_dir, "embeddings"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.report(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.report(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count(table(spark, sf_dir, "documents"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.report(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op10_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.report(table(spark, sf_dir, "conversations"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_minhash_groups": op1_minhash_groups,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_mix_sources": op3_mix_sources,
    "op4_url_filters": op4_url_filters,
    "op5_toxicity": op5_toxicity,
    "op6_personal_data": op6_personal_data,
    "op7_token_counts": op7_token_counts,
    "op8_language_model": op8_language_model,
    "op9_decontaminate": op9_decontaminate,
    "op10_repeated_substrings": op10_repeated_substrings,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_quality_rules": op12_quality_rules,
    "op13_merkle_manifest": op13_merkle_manifest,
}

OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (
    SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
inter AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM inter JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * inter.n >= 85 * (x.n + y.n - inter.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 15) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS pos
  FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][((pos - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
-- a source is capped where even the level that caps exactly the sources under it would exceed twice its size
levels AS (
  SELECT a.pos, (1.5 * (SELECT sum(source_size) FROM w)
      - 2.0 * coalesce((SELECT sum(source_size) FROM w b WHERE b.source_size / b.weight < a.source_size / a.weight), 0))
      / (SELECT sum(weight) FROM w b WHERE b.source_size / b.weight >= a.source_size / a.weight) AS level,
      a.source_size, a.weight
  FROM w a),
fill AS (SELECT arg_min(level, source_size / weight) AS level FROM levels WHERE level * weight <= 2.0 * source_size),
t AS (SELECT w.source, w.source_size, least(2.0 * w.source_size, fill.level * w.weight)::DOUBLE AS target FROM w, fill),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((budget // greatest(source_size, 1)) * size
        + least(greatest(budget % greatest(source_size, 1) - start, 0), size))::BIGINT AS taken
FROM p
"""

OP4_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + (('0x' || substr(md5('fetch' || page_id::VARCHAR), 1, 8))::BIGINT % 360)::INT AS day,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
         string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/') AS steps
  FROM pages),
k AS (
  SELECT DISTINCT page_id, day, host, unnest(
    list_transform(generate_series(1, greatest(len(string_split(host, '.')) - 1, 1)), lambda i: array_to_string(string_split(host, '.')[i:], '.'))
    || list_transform(generate_series(1, len(steps) - 2), lambda i: host || '/' || array_to_string(steps[2 : i + 1], '/') || '/')) AS key
  FROM p WHERE host IS NOT NULL),
n AS (SELECT key, ('0x' || substr(md5('list' || key), 1, 8))::BIGINT AS n FROM (SELECT DISTINCT key FROM k)),
e AS (
  SELECT key, n, unnest([0, 60, 120]) AS after, DATE '2024-01-01' + ((n // 30) % 240)::INT AS start FROM n WHERE n % 3 = 0),
entries AS (
  SELECT key, ['adult', 'malware', 'phishing', 'spam'][((n // 7) % 4 + 1)::INT] AS category, after <> 60 AS adds, start + after::INT AS day
  FROM e WHERE after = 0 OR (after = 60 AND n % 2 = 0) OR (after = 120 AND n % 5 = 0)),
answers AS (SELECT k.*, entries.category, entries.adds, entries.day AS since FROM k ASOF JOIN entries ON k.key = entries.key AND k.day >= entries.day),
best AS (
  SELECT page_id, count(DISTINCT key) AS n_listed, arg_min(struct_pack(key := key, category := category, since := since), (-length(key), key)) AS b
  FROM answers WHERE adds GROUP BY page_id)
SELECT p.page_id, p.day, p.host, coalesce(n_listed, 0) > 0 AS blocked, coalesce(n_listed, 0)::BIGINT AS n_listed,
       b.key AS listed_key, b.category, b.since
FROM p LEFT JOIN best USING (page_id)
"""

OP9_SQL = r"""
WITH words AS (
  SELECT doc_id, w, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i
    FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
hits AS (
  SELECT doc_id, p, n, item_id FROM (
    SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS s FROM words, lengths WHERE p + n - 1 <= len(w)) d
  JOIN windows USING (n, s)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, coalesce(item_id::VARCHAR, '') AS item_id FROM hits) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_words FROM words GROUP BY doc_id)
SELECT d.doc_id, coalesce(counts.n_words, 0)::BIGINT AS n_words, coalesce(covered.n_hit, 0)::BIGINT AS n_hit,
       coalesce(found.n_items, 0)::BIGINT AS n_items, sha256(coalesce(found.ids, '')) AS items_sha256,
       coalesce(covered.n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || strlen(text) || ':' || text)) - 1 AS pos,
         md5(strlen(role) || ':' || role || strlen(text) || ':' || text) AS turn, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS donor,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
           lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: xor(p >> 1, 3988292384 * (p & 1)))), 4294967295) % 4 AS h
  FROM t),
r AS (
  SELECT c.conv_id, 0 AS part, t.pos, turn, words FROM c JOIN t ON t.conv_id = donor AND t.pos < h
  UNION ALL SELECT c.conv_id, 1, t.pos, turn, words FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= h),
lists AS (
  SELECT c.conv_id, coalesce(string_agg(turn, '' ORDER BY part, pos), '') AS path, coalesce(list(words ORDER BY part, pos) FILTER (words IS NOT NULL), []) AS words
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
prefixes AS (
  SELECT conv_id, d, path[1 : 32 * d] AS key, d = len(words) AS ends, CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words
  FROM (SELECT *, unnest(generate_series(0, len(words))) AS d FROM lists)),
nodes AS (
  SELECT d AS depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY d, key),
up AS (SELECT n.*, p.conv_id AS parent_conv_id, p.key AS parent_key FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND n.key[1 : 32 * (n.depth - 1)] = p.key),
kids AS (SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n_children FROM up WHERE parent_key IS NOT NULL GROUP BY ALL),
own AS (SELECT up.*, coalesce(kids.n_children, 0) AS n_children FROM up LEFT JOIN kids USING (depth, key)),
sums AS (
  SELECT a AS depth, key[1 : 32 * a] AS key, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT *, unnest(generate_series(0, depth)) AS a FROM own) GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens, ends_sha256 FROM own JOIN sums USING (depth, key)
"""

OP12_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS id, doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT id, i, w[i : i + 2] AS s FROM (SELECT id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w WHERE len(w) > 2)),
places AS (SELECT id, i FROM (SELECT *, count(*) OVER (PARTITION BY id, s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT id, count(DISTINCT q) AS n FROM (SELECT id, unnest([i, i + 1, i + 2]) AS q FROM places) GROUP BY id),
lines AS (SELECT id, count(*) AS n, count(DISTINCT line) AS u FROM (SELECT id, unnest(string_split(text, chr(10))) AS line FROM w)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY id),
s AS (
  SELECT w.id, doc_id, lang, text, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(lines.n - lines.u, 0)::BIGINT AS n_dup_lines,
         coalesce(lines.n, 0) AS n_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered ON covered.id = w.id LEFT JOIN lines ON lines.id = w.id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
grid(rule, step, cutoff) AS (VALUES
  ('symbols', 1, 2.0), ('symbols', 2, 1.0), ('symbols', 3, 0.5), ('symbols', 4, 0.3), ('symbols', 5, 0.2), ('symbols', 6, 0.1), ('symbols', 7, 0.05),
  ('lines', 1, 0.9), ('lines', 2, 0.7), ('lines', 3, 0.5), ('lines', 4, 0.4), ('lines', 5, 0.3),
  ('repeated', 1, 0.45), ('repeated', 2, 0.4), ('repeated', 3, 0.35), ('repeated', 4, 0.3), ('repeated', 5, 0.25),
  ('long', 1, 12), ('long', 2, 10), ('long', 3, 9), ('long', 4, 8), ('long', 5, 7), ('long', 6, 6.5),
  ('short', 1, -2.5), ('short', 2, -3), ('short', 3, -3.5), ('short', 4, -4)),
v AS (
  SELECT id, doc_id, lang, text, rule, CASE rule WHEN 'symbols' THEN n_symbols::DOUBLE / n_words WHEN 'lines' THEN n_dup_lines::DOUBLE / greatest(n_lines, 1)
         WHEN 'repeated' THEN n_repeat_words::DOUBLE / n_words WHEN 'long' THEN word_chars::DOUBLE / n_words ELSE -(word_chars::DOUBLE / n_words) END AS value
  FROM b, (SELECT DISTINCT rule FROM grid) WHERE NOT base_failed),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
trials AS (SELECT DISTINCT lang, text, rule, value FROM v SEMI JOIN good USING (doc_id)),
counts AS (
  SELECT lang, rule, step, any_value(cutoff)::DOUBLE AS cutoff, count(*)::DOUBLE AS n, count(*) FILTER (value > cutoff::DOUBLE) AS k
  FROM trials JOIN grid USING (rule) GROUP BY lang, rule, step),
p AS (
  SELECT *, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))) AS p,
         (SELECT count(*) FROM (SELECT DISTINCT lang, rule FROM counts)) AS tests FROM counts),
usable AS (SELECT * FROM (SELECT *, max(p) OVER (PARTITION BY lang, rule ORDER BY step) AS worst FROM p) WHERE worst <= 0.05 / tests),
cutoffs AS (SELECT lang, rule, min(cutoff) AS cutoff FROM usable GROUP BY lang, rule),
rejected AS (SELECT DISTINCT id FROM v JOIN cutoffs ON v.rule = cutoffs.rule AND v.lang IS NOT DISTINCT FROM cutoffs.lang WHERE value > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND id NOT IN (SELECT id FROM rejected) AS kept FROM b
"""

OP13_SQL = r"""
WITH RECURSIVE parts AS (
  SELECT doc_id, source, doc_id::VARCHAR AS a, source::VARCHAR AS b, lang::VARCHAR AS c, n_chars::VARCHAR AS d, text AS e,
         replace(text, chr(10), '') AS f,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
           lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: xor(p >> 1, 3988292384 * (p & 1)))), 4294967295) % 2 = 0 AS picked
  FROM documents),
leaves AS (
  SELECT doc_id, source, picked, sha256(start || coalesce(strlen(e) || ':' || e, '-')) AS leaf,
         sha256(start || coalesce(strlen(f) || ':' || f, '-')) AS other
  FROM (SELECT *, coalesce(strlen(a) || ':' || a, '-') || coalesce(strlen(b) || ':' || b, '-') || coalesce(strlen(c) || ':' || c, '-')
               || coalesce(strlen(d) || ':' || d, '-') AS start FROM parts)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves),
nodes(tree, level, i, n, digest) AS (
  SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT tree, any_value(level) + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY tree, i // 3),
subroots AS (SELECT tree, level, digest, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper(level, i, n, digest) AS (
  SELECT 0, tree, n, digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY i))
  FROM upper WHERE n > 1 GROUP BY i // 3),
root AS (SELECT digest AS root FROM upper WHERE n = 1),
-- the climb of each document: the first tall[tree] steps in its source, the others above
steps AS (
  SELECT tree, level, i, string_agg(s.digest, '' ORDER BY s.j) FILTER (s.j < i) AS l, string_agg(s.digest, '' ORDER BY s.j) FILTER (s.j > i) AS r
  FROM nodes JOIN (SELECT tree AS t, level AS h, i AS j, digest FROM nodes) s ON s.t = tree AND s.h = level AND s.j // 3 = i // 3
  WHERE n > 1 GROUP BY tree, level, i),
upsteps AS (
  SELECT level, i, string_agg(s.digest, '' ORDER BY s.j) FILTER (s.j < i) AS l, string_agg(s.digest, '' ORDER BY s.j) FILTER (s.j > i) AS r
  FROM upper JOIN (SELECT level AS h, i AS j, digest FROM upper) s ON s.h = level AND s.j // 3 = i // 3
  WHERE n > 1 GROUP BY level, i),
climb(row, tree, i, level, above, proof, now) AS (
  SELECT row_number() OVER (ORDER BY tree, pos), tree, pos, 0, false, '', CASE WHEN picked THEN other ELSE leaf END FROM placed
  UNION ALL
  SELECT row, c.tree, CASE WHEN done THEN c.tree ELSE c.i // 3 END, CASE WHEN done THEN 0 ELSE c.level + 1 END, above OR done,
         proof || coalesce(CASE WHEN above THEN u.l ELSE s.l END, '') || coalesce(CASE WHEN above THEN u.r ELSE s.r END, ''),
         CASE WHEN done THEN now ELSE sha256(coalesce(CASE WHEN above THEN u.l ELSE s.l END, '') || now || coalesce(CASE WHEN above THEN u.r ELSE s.r END, '')) END
  FROM (SELECT climb.*, NOT above AND climb.level = t.level AS done FROM climb JOIN subroots t USING (tree)) c
  LEFT JOIN steps s ON NOT above AND NOT done AND s.tree = c.tree AND s.level = c.level AND s.i = c.i
  LEFT JOIN upsteps u ON above AND u.level = c.level AND u.i = c.i
  WHERE NOT above OR u.level IS NOT NULL),
ends AS (SELECT row, arg_max(proof, (above, level)) AS proof, arg_max(now, (above, level)) AS now FROM climb GROUP BY row)
SELECT doc_id, leaf, t.digest AS subroot, root, sha256(proof) AS proof_sha256, now AS folded_root, now = root AS verified
FROM (SELECT *, row_number() OVER (ORDER BY tree, pos) AS row FROM placed) p JOIN ends USING (row) JOIN subroots t USING (tree), root
"""

ORACLE_SQL = {
    "op1_minhash_groups": OP1_SQL,
    "op3_mix_sources": OP3_SQL,
    "op4_url_filters": OP4_SQL,
    "op9_decontaminate": OP9_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_quality_rules": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
