"""DuckDB SQL of the queries that SQL can express, over whole tables."""

SQL: dict[str, str] = {}

# words: A-Z lower-cased, maximal runs of characters other than 0x20 and 0x09-0x0D
_SHINGLES = r"""
words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
           ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words),
sizes AS (SELECT d.doc_id, count(s.s) AS n FROM documents d LEFT JOIN sets s USING (doc_id) GROUP BY 1)"""

SQL["op5_bbit_minhash"] = f"""
WITH RECURSIVE {_SHINGLES},
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a)
SELECT doc_id, n AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""

# exact dynamic programme over (buckets used, last length); ties take the smallest predecessor
SQL["op1_length_buckets"] = r"""
WITH RECURSIVE lens AS MATERIALIZED (
  SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n
  FROM documents),
hist AS (SELECT n, count(*) AS c FROM lens WHERE n > 0 GROUP BY n),
pre AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY n) AS i, n, sum(c) OVER (ORDER BY n)::BIGINT AS docs,
         sum(c * n) OVER (ORDER BY n)::BIGINT AS toks FROM hist),
dp(k, i, best) AS (
  SELECT 1, i, {'cost': n * docs - toks, 'prev': 0::BIGINT, 'bounds': [n]} FROM pre
  UNION ALL
  SELECT k, i, {'cost': best.cost, 'prev': best.prev, 'bounds': list_append(best.bounds, n)} FROM (
    SELECT dp.k + 1 AS k, p.i AS i, p.n AS n,
           min({'cost': dp.best.cost + p.n * (p.docs - q.docs) - (p.toks - q.toks), 'prev': dp.i,
                'bounds': dp.best.bounds}) AS best
    FROM dp JOIN pre q ON q.i = dp.i JOIN pre p ON p.i > dp.i
    WHERE dp.k < 8 GROUP BY ALL)),
final AS (SELECT unnest(best.bounds) AS b, generate_subscripts(best.bounds, 1) - 1 AS bucket FROM dp
          WHERE i = (SELECT max(i) FROM pre) AND k = (SELECT least(8, max(i)) FROM pre)),
placed AS (
  SELECT doc_id, n, (SELECT min(bucket) FROM final WHERE b >= n AND n > 0) AS bucket FROM lens),
ranked AS (
  SELECT p.*, b, greatest(1, 16384 // b) AS fit, row_number() OVER (PARTITION BY p.bucket ORDER BY n, doc_id) - 1 AS r
  FROM placed p LEFT JOIN final f ON p.bucket = f.bucket)
SELECT doc_id, n AS n_tokens, bucket, b AS bucket_length, CASE WHEN b IS NOT NULL THEN r // fit END AS batch,
       CASE WHEN b IS NOT NULL THEN r % fit END AS slot, coalesce(b, 0) - n AS padding FROM ranked
"""

SQL["op9_spaced_seeds"] = r"""
WITH dw AS (
  SELECT doc_id, w, generate_subscripts(ws, 1) - 1 AS p, unnest(ws) AS word FROM (
    SELECT doc_id, 0 AS w, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
    FROM documents)),
bw AS (
  SELECT item_id, len(ws) AS n, generate_subscripts(ws, 1) - 1 AS q, unnest(ws) AS word FROM (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
    FROM benchmark)),
hits AS (SELECT doc_id, item_id, p - q AS d, p, q, n FROM dw JOIN bw USING (word)),
groups AS (
  SELECT *, CASE WHEN n >= 11 THEN lead(q, 10) OVER w - q <= 12
                 WHEN n >= 5 THEN q = 0 AND count(*) OVER (PARTITION BY doc_id, item_id, d) = n END AS opens
  FROM hits WINDOW w AS (PARTITION BY doc_id, item_id, d ORDER BY q)),
inside AS (
  SELECT *, bool_or(coalesce(opens, false)) OVER (PARTITION BY doc_id, item_id, d ORDER BY q
                                                  ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS covered
  FROM groups)
SELECT doc_id, item_id, count(DISTINCT q) AS n_matched, min(p) AS first_word, max(p) AS last_word
FROM inside WHERE covered GROUP BY doc_id, item_id
"""

SQL["op2_adaptive_quality"] = r"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM words WHERE len(ws) > 4),
grams AS (SELECT doc_id, i, ws[i:i + 4] AS g FROM windows),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS k FROM grams),
covered AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS p FROM twice WHERE k > 1),
rep AS (SELECT doc_id, count(*) AS r FROM covered GROUP BY 1),
base AS (
  SELECT w.doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words
  FROM words w LEFT JOIN rep ON rep.doc_id = w.doc_id),
vals AS MATERIALIZED (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbols,
         CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_lines,
         CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_length
  FROM base),
each AS (
  SELECT lang, source, 'symbols' AS rule, symbols AS v FROM vals WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'dup_lines', dup_lines FROM vals WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'word_length', word_length FROM vals WHERE NOT base_failed),
bins AS (
  SELECT *, (v // step + 1) * step - 1 AS b FROM (SELECT *, 1 << greatest(0, len(bin(v)) - 6) AS step FROM each)),
all_q AS (SELECT rule, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM bins GROUP BY rule),
lang_q AS (
  SELECT lang, rule, (count(*) * quantile_disc(b, 0.25) + 20 * any_value(q1)) // (count(*) + 20) AS q1,
         (count(*) * quantile_disc(b, 0.75) + 20 * any_value(q3)) // (count(*) + 20) AS q3
  FROM bins JOIN all_q USING (rule) GROUP BY lang, rule),
quart AS (
  SELECT b.lang, b.source, b.rule, (count(*) * quantile_disc(b, 0.25) + 20 * any_value(q1)) // (count(*) + 20) AS q1,
         (count(*) * quantile_disc(b, 0.75) + 20 * any_value(q3)) // (count(*) + 20) AS q3
  FROM bins b JOIN lang_q q ON b.rule = q.rule AND b.lang IS NOT DISTINCT FROM q.lang GROUP BY ALL),
tops AS (
  SELECT lang, source,
         max(q3 + 6 * greatest(15, q3 - q1)) FILTER (rule = 'symbols') AS top_symbols,
         max(q3 + 6 * greatest(45, q3 - q1)) FILTER (rule = 'dup_lines') AS top_dup_lines,
         max(q3 + 6 * greatest(80, q3 - q1)) FILTER (rule = 'word_length') AS top_word_length
  FROM quart GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND symbols <= top_symbols AND dup_lines <= top_dup_lines
                AND word_length <= top_word_length, false) AS kept,
       n_lines, symbols, dup_lines, word_length, top_symbols, top_dup_lines, top_word_length
FROM vals LEFT JOIN tops ON vals.lang IS NOT DISTINCT FROM tops.lang AND vals.source IS NOT DISTINCT FROM tops.source
"""

_PROBE = "'</s>[INST] ok [/INST]'"


def _escape(x: str) -> str:
    out = f"replace({x}, '\\', '\\0')"
    for k, c in enumerate("<[]", 1):
        out = f"replace({out}, '{c}', '\\{k}')"
    return out


SQL["op8_chat_machine"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_PROBE} UNION ALL SELECT -1, 1, 'assistant', {_PROBE}),
numbered AS (
  SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         coalesce(lag(role) OVER w, '') AS before, lag(role) OVER w IS NULL AS opens FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
judged AS (
  SELECT *, CASE WHEN opens THEN role IN ('system', 'user') WHEN role = 'user' THEN before IN ('system', 'assistant')
                 ELSE role = 'assistant' AND before = 'user' END AS fits FROM numbered),
conv AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS turns,
         coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS loss,
         sum(length('<s>[INST:' || {_escape('role')} || ']' || {_escape('text')} || '</s>')) AS formatted_chars,
         min(i) FILTER (NOT fits) AS bad, arg_max(role, i) IN ('user', 'assistant') AS ends_well
  FROM judged GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars, bad IS NULL AND ends_well AS valid,
       coalesce(bad, CASE WHEN NOT ends_well THEN n_turns END)::INTEGER AS first_bad_turn
FROM conv
"""

SQL["op11_dual_tree"] = r"""
WITH t AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
docs AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
corpus AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
m AS (SELECT doc_id, 100 - 50 + ((50 * n * big_n) // big_l) AS m FROM docs, corpus),
w AS (SELECT term, CAST(floor(1000 * ln((2 * max(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY term),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL HAVING score > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores QUALIFY rank <= 50
"""

SQL["op13_residue_negatives"] = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
