"""The registered queries of the dealt operators, with production parameters, and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm import (arc, collocations, decontaminate, hypervectors, jaccard_join, licenses, lm_interpolation, pieces, pii, preference,
                          quality, substring_dedup, term_audit)
from goldleaf.llm.text import table

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def op1_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    scored = lm_interpolation.score(table(spark, sf_dir, "documents"), ~held_out, order=3)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM d, unnest(range(1, len(w) - 18)) AS r(i)),
late AS (SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT rid, i + o AS p FROM late, unnest(range(20)) AS u(o)),
each AS (SELECT rid, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS r(p)),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM each ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


def op3_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_BARE = f"""regexp_extract_all(translate(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '{decontaminate.PUNCTUATION.replace("'", "''")}', ''), '[^\\x20\\x09-\\x0D]+')"""
OP3_SQL = f"""
WITH i0 AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {_BARE} AS w FROM benchmark WHERE item_id IS NOT NULL),
it AS (SELECT row_number() OVER () AS iid, item_id, w, len(w) AS length, least(len(w), 5) AS k FROM i0 WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_BARE} AS w FROM documents),
ish AS (SELECT iid, length, k, j, array_to_string(w[j + 1:j + k], ' ') AS s FROM it, unnest(range(0, length - k + 1)) AS r(j)),
dsh AS (SELECT rid, kk.k, p, array_to_string(w[p + 1:p + kk.k], ' ') AS s, len(w) AS n
  FROM d, (SELECT DISTINCT k FROM it) kk, unnest(range(0, len(w) - kk.k + 1)) AS r(p)),
win AS (SELECT DISTINCT rid, iid, length, dsh.k, greatest(0, least(p - j, n - length)) AS start, n FROM dsh JOIN ish USING (s, k)),
wsh AS (SELECT win.rid, iid, start, least(length, win.n) AS m, length, win.k, s, count(*) AS c FROM win JOIN dsh ON dsh.rid = win.rid
  AND dsh.k = win.k AND p >= start AND p + win.k <= start + least(length, win.n) GROUP BY ALL),
ic AS (SELECT iid, s, count(*) AS c FROM ish GROUP BY ALL),
sh AS (SELECT rid, iid, start, m, length, k, sum(least(wsh.c, ic.c)) AS shared FROM wsh JOIN ic USING (iid, s) GROUP BY ALL),
ok AS (SELECT DISTINCT rid, item_id, start, start + m AS e FROM sh JOIN it USING (iid)
  WHERE 100 * shared >= 80 * ((m - sh.k + 1) + (sh.length - sh.k + 1) - shared)),
g AS (SELECT rid, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS item_ids,
  string_agg(item_id || ':' || start || ':' || e, ',' ORDER BY item_id, start, e) AS spans FROM ok GROUP BY rid)
SELECT doc_id, item_ids IS NOT NULL AS contaminated, coalesce(item_ids, '') AS item_ids, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""


def op4_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.cascade(table(spark, sf_dir, "documents"), features=base)
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return judged.select("doc_id", *base, failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"))


OP4_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM d, unnest(range(1, len(w) - 1)) AS r(i)),
dup AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, s) AS c FROM g) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + o) AS n FROM dup, (VALUES (0), (1), (2)) AS v(o) GROUP BY rid),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
  len(regexp_extract_all(t, '[A-Z]')) AS up, len(regexp_extract_all(t, '[a-z]')) AS lo,
  len(regexp_extract_all(t, '[!?]')) AS marks, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid)),
j AS (SELECT *, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 14 * n_words OR 10 * n_symbols > n_words OR up > lo
    OR 3 * marks > n_words OR (n_dup_lines > 2 AND 100 * n_dup_lines > 30 * len(ls))) AS kept FROM j
"""


def op5_adaptive_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


OP5_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM
  (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
s AS (SELECT DISTINCT rid, array_to_string(w[i:i + 2], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS r(i)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
common AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
reach AS (SELECT rid AS x, rid AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
comp AS (SELECT x AS rid, min(doc_id) AS component_id FROM reach JOIN d ON d.rid = y GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM d JOIN comp USING (rid) LEFT JOIN n USING (rid)
"""


def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.archive_pages(table(spark, sf_dir, "pages")).drop("url")


def op7_bootstrap_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(pii.shown(F.col("base")), 256).alias("base_sha256"), pii.shown(F.col("spans")).alias("spans"),
                        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_")).drop("_")


def op8_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
                        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op9_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.known_digests(spark, licenses.KNOWN + licenses.whole_texts()))


OP6_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""


def _canonical_sql(x: str) -> str:
    lines = (f"array_to_string(list_filter(string_split(lower({x}), chr(10)), "
             "lambda l: NOT regexp_matches(l, '^[^a-z0-9]*(copyright|\\(c\\)|©|all rights reserved)')), chr(10))")
    marks = f"[{licenses._MARKS}\\x0A]+"
    flat = f"' ' || regexp_replace({lines}, '{marks}', '  ', 'g') || ' '"
    for a, b in licenses.EQUIVALENT:
        flat = f"replace({flat}, ' {a} ', ' {b} ')"
    return f"trim(regexp_replace({flat}, ' +', ' ', 'g'), ' ')"


_KNOWN_SQL = ", ".join("({}, {})".format(*("'" + v.replace("'", "''") + "'" for v in kv)) for kv in licenses.KNOWN)
OP9_SQL = f"""
WITH k AS (SELECT sha256(c) AS digest, min(license_id) AS license_id FROM
  (SELECT license_id, {_canonical_sql('text')} AS c FROM (VALUES {_KNOWN_SQL}) AS v(license_id, text)) GROUP BY 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, {_canonical_sql('t')} AS c FROM d),
l AS (SELECT rid, {_canonical_sql('x')} AS c FROM d, unnest(string_split(t, chr(10))) AS u(x)),
n AS (SELECT rid, array_to_string(list_sort(list(DISTINCT license_id)), ',') AS notice_ids, count(*) AS n_notices
  FROM l JOIN k ON k.digest = sha256(l.c) GROUP BY rid)
SELECT w.doc_id, CASE WHEN c <> '' THEN sha256(c) END AS digest, k.license_id, coalesce(n.notice_ids, '') AS notice_ids,
  CAST(coalesce(n.n_notices, 0) AS BIGINT) AS n_notices
FROM w LEFT JOIN n USING (rid) LEFT JOIN k ON k.digest = CASE WHEN c <> '' THEN sha256(c) END
"""


def op10_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.format_pairs(preference.mismatched_pairs(table(spark, sf_dir, "conversations")))
    shown = lambda m: F.array_join(F.transform(m, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(m)
    return pairs.select("pair_id", F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"), "prompt", "chosen", "rejected",
                        shown("chosen_mask"), shown("rejected_mask"))


def _side_sql(side: str) -> str:
    """Rendered completion and mask of one side: turns beyond the prompt, with running lengths."""
    return f"""{side}_t AS (SELECT s.pair_id, pos, role, text, '<|' || role || '|>' || chr(10) || text || chr(10) AS shown
  FROM s JOIN cut USING (pair_id) WHERE side = '{side}' AND pos > n),
{side}_s AS (SELECT *, sum(length(shown)) OVER (PARTITION BY pair_id ORDER BY pos) - length(text) - 1 AS a FROM {side}_t),
{side}_c AS (SELECT pair_id, string_agg(shown, '' ORDER BY pos) AS body,
  string_agg(CAST(CAST(a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(a + length(text) AS BIGINT) AS VARCHAR), ',' ORDER BY pos)
  FILTER (WHERE role = 'assistant') AS mask FROM {side}_s GROUP BY pair_id)"""


OP10_SQL = f"""
WITH t AS (SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '<||') AS role,
  replace(coalesce(text, ''), '<|', '<||') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back FROM conversations),
r AS (SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM t
  UNION ALL SELECT conv_id, 'rejected', turn, role, text FROM t WHERE back > 1
  UNION ALL SELECT a.conv_id, 'rejected', a.turn, b.role, b.text FROM t a JOIN t b ON b.conv_id = xor(a.conv_id, 1)
    WHERE a.back = 1 AND b.back = 1),
s AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS pos FROM r),
m AS (SELECT a.pair_id, a.pos, a.role = b.role AND a.text = b.text AS same FROM s a LEFT JOIN s b
  ON a.pair_id = b.pair_id AND a.pos = b.pos AND b.side = 'rejected' WHERE a.side = 'chosen'),
cut AS (SELECT pair_id, coalesce(min(pos) FILTER (WHERE same IS NOT TRUE) - 1, max(pos)) AS n FROM m GROUP BY pair_id),
{_side_sql('chosen')},
{_side_sql('rejected')},
p AS (SELECT pair_id, string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY pos) AS prompt
  FROM s JOIN cut USING (pair_id) WHERE side = 'chosen' AND pos <= n GROUP BY pair_id)
SELECT cut.pair_id, CAST(n AS BIGINT) AS n_prompt_turns, coalesce(prompt, '') AS prompt, coalesce(c.body, '') AS chosen,
  coalesce(j.body, '') AS rejected, coalesce(c.mask, '') AS chosen_mask, coalesce(j.mask, '') AS rejected_mask
FROM cut LEFT JOIN p USING (pair_id) LEFT JOIN chosen_c c USING (pair_id) LEFT JOIN rejected_c j USING (pair_id)
"""


def op11_suffix_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000, absorbed_percent=100)


OP11_SQL = """
WITH p AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, w[i:i + m - 1] AS ws, m FROM p, unnest(range(1, 6)) AS k(m), unnest(range(1, len(w) - m + 2)) AS r(i)),
f AS (SELECT lang, array_to_string(ws, ' ') AS phrase, any_value(ws) AS ws, any_value(m) AS m, CAST(count(*) AS HUGEINT) AS total
  FROM g GROUP BY lang, array_to_string(ws, ' ') HAVING count(*) >= 100),
c AS (SELECT f.lang, f.phrase, f.m, f.total AS a, n.n, x.total AS l, y.total AS r, k,
  (CAST(1000 AS HUGEINT) * f.total * n.n) // (x.total * y.total) AS score
  FROM f JOIN n USING (lang), unnest(range(1, f.m)) AS u(k)
  JOIN f x ON x.lang = f.lang AND x.phrase = array_to_string(f.ws[1:k], ' ')
  JOIN f y ON y.lang = f.lang AND y.phrase = array_to_string(f.ws[k + 1:f.m], ' ')),
s AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT DISTINCT f.lang, array_to_string(f.ws[i:i + m2 - 1], ' ') AS phrase, f.total AS longer
  FROM f, unnest(range(2, f.m)) AS u(m2), unnest(range(1, f.m - m2 + 2)) AS v(i)),
kept AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM inside x WHERE x.lang = s.lang AND x.phrase = s.phrase AND 100 * x.longer >= 100 * s.a)),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
first AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
mark AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
  100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first, false)] AS fails
  FROM d JOIN first USING (t) LEFT JOIN mark USING (doc_id)),
cell AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
o AS (SELECT [a.x, b.x, c.x, e.x, f.x] AS o FROM range(1, 6) a(x), range(1, 6) b(x), range(1, 6) c(x), range(1, 6) e(x), range(1, 6) f(x)
  WHERE len(list_distinct([a.x, b.x, c.x, e.x, f.x])) = 5),
s AS (SELECT o, step, o[step] AS own, list_transform(o, lambda x: 'ABCDE'[x]) AS letters FROM o, range(1, 6) AS r(step)),
j AS (SELECT part, array_to_string(letters, '') AS filter_order, step, own, n, good, toxic, fails[own] AS mine,
  len(list_filter(o[1:step - 1], lambda x: fails[x])) > 0 AS gone, len(list_filter(fails, lambda x: x)) AS n_fails FROM cell, s),
t AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT mine THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mine AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN mine AND gone THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mine AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN mine AND NOT gone THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN mine AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost FROM j GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM t
"""


def op13_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    predicted = hypervectors.predict(docs, ~held_out)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op1_interpolated_lm": op1_interpolated_lm,
    "op2_automaton_dedup": op2_automaton_dedup,
    "op3_simhash_decontamination": op3_simhash_decontamination,
    "op4_rule_cascade": op4_rule_cascade,
    "op5_adaptive_jaccard": op5_adaptive_jaccard,
    "op6_arc_to_warc": op6_arc_to_warc,
    "op7_bootstrap_pii": op7_bootstrap_pii,
    "op8_piece_sampling": op8_piece_sampling,
    "op9_license_digest": op9_license_digest,
    "op10_preference_format": op10_preference_format,
    "op11_suffix_collocations": op11_suffix_collocations,
    "op12_filter_audit": op12_filter_audit,
    "op13_hyperdimensional_language": op13_hyperdimensional_language,
}
ORACLE = {
    "op2_automaton_dedup": OP2_SQL,
    "op5_adaptive_jaccard": OP5_SQL,
    "op3_simhash_decontamination": OP3_SQL,
    "op4_rule_cascade": OP4_SQL,
    "op6_arc_to_warc": OP6_SQL,
    "op9_license_digest": OP9_SQL,
    "op10_preference_format": OP10_SQL,
    "op11_suffix_collocations": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
}
