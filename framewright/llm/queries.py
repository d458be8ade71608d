"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.chat import perspectives
from framewright.llm.decontamination import contaminated
from framewright.llm.fixity import audit, manifest, warc_record
from framewright.llm.languages import identify
from framewright.llm.packing import pack_buckets
from framewright.llm.quality import quality_rules
from framewright.llm.ranking import ranked_search
from framewright.llm.scoring import backoff_scores
from framewright.llm.secrets import find_secrets
from framewright.llm.sharding import pack_shards
from framewright.llm.similarity import similar_components
from framewright.llm.trie import shared_openings_trie
from framewright.llm.urls import filter_urls

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op2_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = perspectives(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m.start, m.end)), ",")
    return rows.withColumn("mask", spans)


def op3_suffix_array_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_repeats", "longest_repeat", "covered_chars"]
    return rows.select("doc_id", *(F.col(f"repetition.{c}").alias(c) for c in counts), "base_failed", "kept")


def op4_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pack_shards(table(spark, sf_dir, "documents"), n_shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")


def replica_with_faults(pages: DataFrame) -> DataFrame:
    """A copy of ``pages`` in which a record in 97 has its first letter changed and a file in 8 lacks its last record."""
    html = F.when(F.col("page_id") % 97 == 5, F.concat(F.lit("#"), F.substring("html", 2, 1 << 30))).otherwise(F.col("html"))
    return pages.withColumn("html", html).filter("page_id % 4096 <> 511")


def op5_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    file = F.floor(F.col("page_id") / 512).cast("long")
    one, two = (manifest(x, file, [F.col("page_id")], warc_record(F.col("url"), F.col("html"))) for x in (pages, replica_with_faults(pages)))
    return audit(one, two)


def op6_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_buckets(table(spark, sf_dir, "documents"))


def op7_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"), stable=True)


def op8_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.withColumns({c: F.round(c, 6) for c in ("bm25", "question_overlap", "answer_overlap")})


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", *(f"secrets.{c}" for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_urls(table(spark, sf_dir, "pages"), RULES)
    return rows.select("page_id", "host", "path", "rule", "verdict", F.array_join("words", " ").alias("words"), "odds")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = identify(table(spark, sf_dir, "documents"))
    return rows.withColumn("spans", F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.start, s.end, s.lang)), ","))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_openings_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_ngram_jaccard,
        op2_chat_perspectives,
        op3_suffix_array_rules,
        op4_vector_shards,
        op5_merkle_fixity,
        op6_length_buckets,
        op7_stupid_backoff,
        op8_bm25_decontamination,
        op9_secret_scan,
        op10_url_filter,
        op11_ranked_search,
        op12_language_spans,
        op13_prefix_trie,
    )
    return {f.__name__: f for f in own}


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
                               WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)
), b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), r AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, b.y FROM r JOIN b ON b.x = r.reached
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""

OP2_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations
), p AS (SELECT DISTINCT conv_id, role AS participant FROM t WHERE role <> 'system'
), r AS (
  SELECT t.*, participant, role = participant AS own, row_number() OVER (PARTITION BY t.conv_id, participant ORDER BY turn NULLS FIRST, role, text) AS k,
         '<|im_start|>' || CASE WHEN role = participant THEN 'assistant' WHEN role = 'system' THEN role ELSE 'user name=' || translate(replace(role, '<|', '< |'), chr(10) || chr(13), '  ') END || chr(10) AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), z AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS seg FROM r
), a AS (
  SELECT *, coalesce(sum(length(seg)) OVER (PARTITION BY conv_id, participant ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM z
)
SELECT conv_id, participant, 0 AS part, count(*) AS n_turns, 0 AS n_carried, string_agg(seg, '' ORDER BY k) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN CAST(base + length(head) AS BIGINT) || ':' || CAST(base + length(seg) - 1 AS BIGINT) END, ',' ORDER BY k), '') AS mask
FROM a GROUP BY conv_id, participant
"""

OP5_SQL = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, page_id // 512 AS file,
         CASE WHEN page_id % 97 = 5 THEN '#' || substr(coalesce(html, ''), 2) ELSE coalesce(html, '') END AS html2 FROM pages
), r AS (
  SELECT *, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' AS head,
         chr(13) || chr(10) || chr(13) || chr(10) AS gap FROM p
), d AS (
  SELECT file, page_id, strlen(one) AS length, sha256(one) AS expected, sha256(two) AS actual, page_id % 4096 = 511 AS lost
  FROM (SELECT *, head || strlen(html) || gap || html || gap AS one, head || strlen(html2) || gap || html2 || gap AS two FROM r)
), o AS (
  SELECT *, row_number() OVER w - 1 AS seq,
         CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM d WINDOW w AS (PARTITION BY file ORDER BY page_id)
)
SELECT file, seq, CASE WHEN lost THEN 'missing' ELSE 'corrupt' END AS kind, "offset", length, expected, CASE WHEN NOT lost THEN actual END AS actual
FROM o WHERE lost OR expected <> actual
"""


#: Words ``word`` and tokens ``p`` with their first code points as ``pos`` (from 0): words of over 40 code points are taken apart,
#: but for runs of over 40 equal ones. ``weight`` is in sixths of a word.
OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, regexp_extract_all(text, '[\x20\x09-\x0D]+') AS gs, regexp_matches(text, '^[\x20\x09-\x0D]') AS lead FROM d
), word AS (
  SELECT rid, i, ws[i] AS w, CAST(sum(length(ws[i])) OVER o - length(ws[i]) + sum(CASE WHEN lead THEN length(gs[i]) WHEN i > 1 THEN length(gs[i - 1]) ELSE 0 END) OVER o AS BIGINT) AS pos
  FROM (SELECT rid, ws, gs, lead, unnest(range(1, len(ws) + 1)) AS i FROM w) WINDOW o AS (PARTITION BY rid ORDER BY i)
), sign AS (SELECT rid, i, pos, k, string_split(w, '')[k] AS c FROM (SELECT *, unnest(range(1, length(w) + 1)) AS k FROM word WHERE length(w) > 40)
), equal AS (SELECT *, k - row_number() OVER (PARTITION BY rid, i, c ORDER BY k) AS run FROM sign
), piece AS (SELECT rid, i, pos, k, c, count(*) OVER (PARTITION BY rid, i, c, run) AS m, row_number() OVER (PARTITION BY rid, i, c, run ORDER BY k) AS r FROM equal
), token AS (
  SELECT rid, i, 0 AS k, w, pos FROM word WHERE length(w) <= 40
  UNION ALL SELECT rid, i, k, CASE WHEN m > 40 THEN repeat(c, m) ELSE c END, pos + k - 1 FROM piece WHERE m <= 40 OR r = 1
), p AS (SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY i, k) AS i, w, pos, CASE WHEN count(*) OVER (PARTITION BY rid, i) > 1 THEN 1 ELSE 6 END AS weight FROM token
), five AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS j FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS m
    FROM (SELECT rid, i, len(list(w) OVER f) AS n, array_to_string(list(w) OVER f, ' ') AS g FROM word WINDOW f AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) WHERE n = 5) WHERE m > 1) GROUP BY rid
), ten AS (SELECT rid, i, len(list(w) OVER t) AS n, array_to_string(list(w) OVER t, ' ') AS g FROM p WINDOW t AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)
), pairs AS (SELECT a.rid, a.i, b.i - a.i AS shift FROM ten a JOIN ten b ON a.rid = b.rid AND a.g = b.g AND a.i <> b.i WHERE a.n = 10 AND b.n = 10
), runs AS (SELECT *, i - row_number() OVER (PARTITION BY rid, shift ORDER BY i) AS run FROM pairs
), most AS (SELECT rid, i, max(n) AS n FROM (SELECT rid, i, max(i) OVER (PARTITION BY rid, shift, run) - i + 10 AS n FROM runs) GROUP BY rid, i
), fits AS (SELECT m.rid, m.i, m.n FROM most m JOIN p a ON a.rid = m.rid AND a.i = m.i JOIN p b ON b.rid = m.rid AND b.i = m.i + m.n - 1 WHERE b.pos + length(b.w) - a.pos >= 40
), firsts AS (SELECT f.* FROM fits f LEFT JOIN fits e ON e.rid = f.rid AND e.i = f.i - 1 AND e.i + e.n >= f.i + f.n WHERE e.rid IS NULL
), heavy AS (SELECT rid, max(s) AS s FROM (SELECT f.rid, f.i, sum(p.weight) AS s FROM firsts f JOIN p ON p.rid = f.rid AND p.i >= f.i AND p.i < f.i + f.n GROUP BY f.rid, f.i) GROUP BY rid
), cover AS (SELECT DISTINCT rid, unnest(range(i, i + n)) AS i FROM firsts
), own AS (SELECT rid, count(*) AS n_repeats, max(n) AS longest_repeat FROM firsts GROUP BY rid
), chars AS (SELECT c.rid, sum(length(p.w)) AS covered_chars FROM cover c JOIN p ON p.rid = c.rid AND p.i = c.i GROUP BY c.rid
), lines AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid
), f AS (
  SELECT w.rid, w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines, coalesce(five.n, 0) AS n_repeat_words,
         coalesce(n_repeats, 0) AS n_repeats, coalesce(longest_repeat, 0) AS longest_repeat, coalesce(covered_chars, 0) AS covered_chars
  FROM w LEFT JOIN lines ON lines.rid = w.rid LEFT JOIN five ON five.rid = w.rid LEFT JOIN own ON own.rid = w.rid LEFT JOIN chars ON chars.rid = w.rid
)
SELECT f.* EXCLUDE rid, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND covered_chars <= 0.2 * word_chars AND coalesce(heavy.s, 0) <= 64 * 6 AS kept FROM f LEFT JOIN heavy ON heavy.rid = f.rid
"""

OP8_SQL = r"""
WITH b AS (SELECT row_number() OVER () AS b, item_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
), it AS (SELECT *, len(ws) AS n, CAST(greatest(8, pow(2, ceil(log2(len(ws))))) AS BIGINT) AS h FROM b WHERE len(ws) > 0
), tf AS (SELECT b, h, n, w, count(*) AS f FROM (SELECT b, h, n, unnest(ws) AS w FROM it) GROUP BY ALL
), raw AS (
  SELECT tf.b, h, tf.w, ln(1 + (c.n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * f * 2.2::DOUBLE / (f + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * tf.n / c.mean)) AS x
  FROM tf JOIN (SELECT w, count(*) AS df FROM tf GROUP BY w) d ON d.w = tf.w CROSS JOIN (SELECT count(*) AS n, avg(n) AS mean FROM it) c
), imp AS (SELECT b, h, w, x / sum(x) OVER (PARTITION BY b) AS x FROM raw
), doc AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents
), word AS (SELECT rid, i, ws[i + 1] AS w FROM (SELECT rid, ws, unnest(range(len(ws))) AS i FROM doc)
), win AS (SELECT DISTINCT rid, h, w, i // h - s AS k FROM word JOIN (SELECT DISTINCT h, w FROM imp) USING (w) CROSS JOIN (VALUES (0), (1)) o(s) WHERE i // h - s >= 0
), hit AS (SELECT rid, win.h, k, b, round(sum(x), 9) AS s FROM win JOIN imp ON imp.h = win.h AND imp.w = win.w GROUP BY ALL HAVING sum(x) >= 0.5
), part AS (
  SELECT b, CASE WHEN len(ps) > 1 THEN flatten(ps[1:len(ps) - 1]) ELSE ws[1:greatest(1, n - greatest(1, n // 3))] END AS q, CASE WHEN len(ps) > 1 THEN ps[len(ps)] ELSE ws[greatest(1, n - greatest(1, n // 3)) + 1:] END AS a
  FROM (SELECT *, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)), lambda x: regexp_extract_all(lower(x), '[\p{L}\p{N}]+')), lambda x: len(x) > 0) AS ps FROM it)
), near AS (SELECT hit.*, doc_id, doc.ws[k * h + 1:(k + 2) * h] AS ws, q, a, least(3, len(q)) AS nq, least(3, len(a)) AS na FROM hit JOIN doc USING (rid) JOIN part USING (b)
), gram AS (
  SELECT *, list_distinct(list_transform(range(1, len(q) - nq + 2), lambda j: array_to_string(q[j:j + nq - 1], ' '))) AS gq, list_distinct(list_transform(range(1, len(a) - na + 2), lambda j: array_to_string(a[j:j + na - 1], ' '))) AS ga,
    list_transform(range(1, len(ws) - nq + 2), lambda j: array_to_string(ws[j:j + nq - 1], ' ')) AS wq, list_transform(range(1, len(ws) - na + 2), lambda j: array_to_string(ws[j:j + na - 1], ' ')) AS wa FROM near
), o AS (
  SELECT *, CASE WHEN nq = 0 THEN 1.0::DOUBLE ELSE len(list_filter(gq, lambda x: list_contains(wq, x)))::DOUBLE / len(gq) END AS oq, CASE WHEN na = 0 THEN 1.0::DOUBLE ELSE len(list_filter(ga, lambda x: list_contains(wa, x)))::DOUBLE / len(ga) END AS oa FROM gram
), best AS (SELECT *, row_number() OVER (PARTITION BY rid, b ORDER BY s DESC, oq DESC, oa DESC) AS r FROM o WHERE oq >= 0.6 AND oa >= 0.5)
SELECT doc_id, item_id, round(s, 6) AS bm25, round(oq, 6) AS question_overlap, round(oa, 6) AS answer_overlap FROM best JOIN it USING (b) WHERE r = 1
"""


def _either_case(words: str) -> str:
    return "".join(f"[{x}{x.upper()}]" if x.isalpha() else x for x in words)


#: The n-th match starts where its text comes first after the match before it. Checksums are CRC-32 in base 62, bit by bit.
OP9_SQL = (
    r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), m AS (
  SELECT rid, t, 'assign' AS kind, 1 AS o, regexp_extract_all(t, '(?:ASSIGN)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') AS ms FROM d
  UNION ALL SELECT rid, t, 'access', 2, regexp_extract_all(t, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT rid, t, 'hex', 3, regexp_extract_all(t, '[0-9a-f]+') FROM d
  UNION ALL SELECT rid, t, 'github', 4, regexp_extract_all(t, '(?:gh[pousr]|npm)_[A-Za-z0-9]+') FROM d
), p AS (
  SELECT rid, kind, o, t, ms, 0 AS k, CAST(0 AS BIGINT) AS s, CAST(0 AS BIGINT) AS e FROM m WHERE kind <> 'hex' AND len(ms) > 0
  UNION ALL SELECT rid, kind, o, t, ms, k + 1, e + instr(substr(t, e + 1), ms[k + 1]) - 1, e + instr(substr(t, e + 1), ms[k + 1]) - 1 + length(ms[k + 1]) FROM p WHERE k < len(ms)
), hx AS (
  SELECT rid, t, ms, 0 AS k, CAST(0 AS BIGINT) AS e, CAST(0 AS BIGINT) AS s FROM (SELECT rid, t, list_filter(ms, lambda x: length(x) >= 32) AS ms FROM m WHERE kind = 'hex') WHERE len(ms) > 0
  UNION ALL SELECT rid, t, ms, k + 1, e + instr(substr(t, e + 1), ms[k + 1]) - 1 + length(ms[k + 1]), e + instr(substr(t, e + 1), ms[k + 1]) - 1 FROM hx WHERE k < len(ms)
), c AS (
  SELECT rid, kind, o, s, e, ms[k] AS x, substr(t, s, 1) AS prev FROM p WHERE k > 0
), f AS (
  SELECT rid, kind, o, s, e FROM c WHERE kind = 'assign' AND length(regexp_extract(x, '^(?:ASSIGN)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 8
  UNION ALL SELECT rid, kind, o, s, e FROM c WHERE kind = 'access' AND length(x) >= 16
  UNION ALL SELECT rid, 'hex', 3, s, e FROM hx WHERE k > 0
  UNION ALL SELECT rid, CASE WHEN x LIKE 'npm%' THEN 'npm' ELSE 'github' END, CASE WHEN x LIKE 'npm%' THEN 5 ELSE 4 END, s, e
    FROM (SELECT *, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(substr(x, 5, 30), ''), lambda y: CAST(ascii(y) AS BIGINT))),
      lambda r, y: list_reduce([xor(r, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))) AS crc FROM c WHERE kind = 'github' AND length(x) = 40 AND NOT regexp_matches(coalesce(prev, ''), '[A-Za-z0-9]'))
    WHERE substr(x, 35, 6) = array_to_string(list_transform([916132832, 14776336, 238328, 3844, 62, 1], lambda q: substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', CAST((crc // q) % 62 AS BIGINT) + 1, 1)), '')
), a AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o, e) FILTER (o <= 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o, e) AS spans FROM f GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a ON a.rid = d.rid
"""
).replace("ASSIGN", "|".join(_either_case(x) for x in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), z AS (SELECT count(*) AS n_docs, sum(len(ws)) AS n_terms FROM d WHERE len(ws) > 0
), m AS (SELECT rid, doc_id, 10 + (90 * len(ws) * n_docs) // n_terms AS m, ws FROM d, z
), tf AS (SELECT rid, w, count(*) AS tf FROM (SELECT rid, unnest(ws) AS w FROM d) GROUP BY rid, w
), wt AS (SELECT w, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS wt FROM (SELECT w, count(*) AS df FROM tf GROUP BY w), z
), b AS (SELECT row_number() OVER () AS b, * FROM (SELECT DISTINCT item_id, text FROM benchmark)
), q AS (SELECT DISTINCT b, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM b
), s AS (
  SELECT b, rid, doc_id, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN wt USING (w) JOIN tf USING (w) JOIN m USING (rid) GROUP BY b, rid, doc_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY b ORDER BY score DESC, doc_id) AS INT) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r JOIN b USING (b) WHERE rank <= 10
"""


#: CRC-32 bit by bit. A node is the list of its turns; of a node's members the smallest has all nodes above it.
OP13_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), s AS (
  SELECT c, max(k) AS own, c - c % 5 AS base, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda y: CAST(ascii(y) AS BIGINT))),
    lambda r, y: list_reduce([xor(r, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))) % 9 AS h FROM t GROUP BY c
), z AS (SELECT s.*, least(s.h, coalesce(b.own, 0)) AS taken FROM s LEFT JOIN s b ON b.c = s.base
), r AS (
  SELECT z.c, k AS d, role, text FROM z JOIN t ON t.c = z.base WHERE k <= h UNION ALL SELECT z.c, taken + k - h, role, text FROM z JOIN t ON t.c = z.c WHERE k > h
), p AS (
  SELECT c, d, sha256(CAST(list({'r': role, 't': text}) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS VARCHAR)) AS s, strlen(text) AS size FROM r
  UNION ALL SELECT c, 0, '', 0 FROM z
), x AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS ends, lag(s) OVER (PARTITION BY c ORDER BY d) AS up FROM p
), n AS (
  SELECT d, s, min(c) AS c, min(up) AS up, count(*) AS n, (count(*) - 1) * max(size) AS saved, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends FROM x GROUP BY d, s
), f AS (SELECT d - 1 AS d, up AS s, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL
), u AS (
  SELECT x.d, x.s, sum(v.saved) AS saved, count(*) FILTER (v.n_children = 0) AS leaves
  FROM (SELECT n.*, coalesce(f.n, 0) AS n_children FROM n LEFT JOIN f USING (d, s)) v JOIN x ON x.c = v.c AND x.d <= v.d GROUP BY x.d, x.s
)
SELECT n.c AS conv_id, n.d AS depth, a.c AS parent_conv_id, n.n AS n_convs, coalesce(f.n, 0) AS n_children, u.leaves AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN u USING (d, s) LEFT JOIN f USING (d, s) LEFT JOIN n a ON a.d = n.d - 1 AND a.s = n.up
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard": OP1_SQL,
        "op2_chat_perspectives": OP2_SQL,
        "op3_suffix_array_rules": OP3_SQL,
        "op5_merkle_fixity": OP5_SQL,
        "op8_bm25_decontamination": OP8_SQL,
        "op9_secret_scan": OP9_SQL,
        "op11_ranked_search": OP11_SQL,
        "op13_prefix_trie": OP13_SQL,
    }
