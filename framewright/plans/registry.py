"""The library's queries over the given tables, and their DuckDB SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions import geometry as G
from framewright.functions import text as X
from framewright.operators import catalog as C
from framewright.operators import dedup as D
from framewright.operators import grouping as A
from framewright.operators import hooks as H
from framewright.operators import pixels as P
from framewright.plans.session import scratch
from framewright.sources import files as S
from framewright.sources.chains import page_order
from framewright.streaming import unseen as U

DIR = "concat(CAST(doc_id % 4 AS STRING), '_', source, '/', lang)"
VIEWS = {
    "images_fx": f"""SELECT doc_id AS id, {DIR} AS rel_dir, concat('img', CAST(CAST(floor(doc_id / 3) AS BIGINT) AS STRING), CASE WHEN doc_id % 7 = 0 THEN '.jpg' ELSE '.png' END) AS filename,
        concat('img', CAST(CAST(floor(doc_id / 3) AS BIGINT) AS STRING)) AS stem, 200 + (doc_id * 7919) % 1400 AS width, 200 + (doc_id * 104729) % 1400 AS height FROM documents""",
    "captions_fx": f"""SELECT doc_id AS id, {DIR} AS rel_dir, concat('img', CAST(CAST(floor((doc_id + doc_id % 5) / 3) AS BIGINT) AS STRING)) AS stem,
        CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'wd14' ELSE 'blip' END AS kind, text FROM documents""",
    "detections_fx": """SELECT o_custkey AS image_id, o_orderkey AS det_idx, CAST(o_orderkey % 3 AS INT) AS class_id, CAST((o_orderkey * 37) % 100 AS DOUBLE) / 100 AS confidence,
        CAST((o_orderkey * 31) % 700 AS DOUBLE) AS x1, CAST((o_orderkey * 17) % 500 AS DOUBLE) AS y1, CAST((o_orderkey * 31) % 700 + 20 + (o_orderkey * 13) % 560 AS DOUBLE) AS x2,
        CAST((o_orderkey * 17) % 500 + 20 + (o_orderkey * 11) % 560 AS DOUBLE) AS y2, 1280 AS img_w, 1080 AS img_h FROM orders""",
    "fetch_fx": "SELECT event_id + 2875469 AS seq, event_type <> 'error' AS ok, CAST(floor((event_id - least_id) / 37) AS BIGINT) AS batch FROM events CROSS JOIN (SELECT min(event_id) AS least_id FROM events) m",
    "api_fx": """SELECT p_partkey AS id, p_brand AS source, CAST((p_partkey - p_partkey % 8) / 8 AS BIGINT) AS page_no, p_partkey % 8 AS pos, concat('http://x/', CAST(p_partkey % 1500 AS STRING)) AS url,
        p_size % 15 AS heart, p_size % 11 AS likes, p_partkey % 5 AS laugh, p_partkey % 4 AS cry, 300 + (p_partkey * 37 + 600) % 1200 AS width, 300 + (p_partkey * 53 + 700) % 1200 AS height,
        CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE concat(p_name, ' <lora:', p_type, ':0.8>, ', p_brand) END AS prompt FROM part""",
    "chain_fx": """SELECT o_custkey, r, concat('http://x/', CAST(o_orderkey AS STRING)) AS url, concat('http://x/', CAST(following AS STRING)) AS next FROM (SELECT *, CASE WHEN lead_key IS NOT NULL THEN lead_key
        WHEN o_custkey % 50 = 1 THEN first_key WHEN o_custkey % 50 = 2 THEN second_key END AS following FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r,
        lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS lead_key, min(o_orderkey) OVER (PARTITION BY o_custkey) AS first_key,
        nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_key FROM orders) a) b WHERE o_custkey % 50 IN (1, 2) OR o_orderkey % 17 <> 3""",
    "nested_fx": """SELECT doc_id AS id, concat(CAST(doc_id % 4 AS STRING), '/', source) AS rel_dir, concat('n', CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat('_', CAST(doc_id * 7919 % 23 AS STRING)) END,
        CASE WHEN doc_id % 7 = 0 THEN concat('_', CAST(doc_id * 31 % 3 AS STRING)) ELSE '' END, CASE WHEN doc_id % 11 = 0 THEN '.jpg' ELSE '.png' END) AS filename FROM documents""",
    "scores_fx": "SELECT p_partkey AS path, p_brand AS grp, CAST(p_retailprice AS DOUBLE) AS vol, CAST(p_partkey * 31 % 997 AS DOUBLE) / 997 AS ssim FROM part",
    "rowsums_fx": "SELECT user_id AS image_id, event_id AS y, value AS gray_sum FROM events",
    "pixels_fx": "SELECT l_suppkey % 20 AS image_id, l_partkey % 8 AS x, l_orderkey % 8 AS y, concat(l_returnflag, l_linestatus) AS rgba, 8 AS w, 8 AS h FROM lineitem",
    "videos_fx": "SELECT s_suppkey AS video_idx, CASE WHEN s_suppkey % 23 = 1 THEN 0 ELSE CAST(10 + s_suppkey % 5 AS DOUBLE) END AS fps, CASE WHEN s_suppkey % 29 = 2 THEN 0 WHEN s_suppkey % 31 = 3 THEN 90000 ELSE 40 + (s_suppkey * 97) % 900 END AS frame_count FROM supplier",
    "sized_fx": "SELECT doc_id AS id, CASE WHEN doc_id % 40 = 1 THEN 0 ELSE 200 + (doc_id * 7919) % 1400 END AS width, CASE WHEN doc_id % 50 = 1 THEN 0 ELSE 200 + (doc_id * 104729) % 1400 END AS height FROM documents",
    "rooted_fx": f"""SELECT doc_id AS id, CASE WHEN doc_id % 20 = 3 THEN '' ELSE {DIR} END AS rel_dir, concat('img', CAST(doc_id AS STRING)) AS stem, text FROM documents""",
    "results_fx": "SELECT conv_id AS image_id, turn, role AS key, text FROM conversations",
    "ids_fx": "SELECT c_custkey AS id, concat(CAST(c_custkey % 30 AS STRING), '.', CAST(c_nationkey AS STRING), CASE WHEN c_custkey % 4 = 0 THEN 'a' ELSE '' END, '.png') AS filename FROM customer",
    "names_fx": "SELECT CAST(n_nationkey AS STRING) AS id, n_name AS name FROM nation",
    "dedup_fx": "SELECT label AS grp, CASE WHEN vec_id % 3 = 0 THEN 'delete' ELSE 'keep' END AS status FROM embeddings",
    "gray_fx": "SELECT vec_id AS id, 8 AS width, 8 AS height, embedding FROM embeddings",
    "leaf_fx": "SELECT vec_id AS id, embedding AS vec, concat('d', CAST(label % 4 AS STRING), CASE WHEN label % 4 > 1 OR vec_id % 3 = 0 THEN concat('/s', CAST(vec_id % 2 AS STRING), CASE WHEN vec_id % 5 = 0 THEN '/t' ELSE '' END) ELSE '' END) AS rel_dir FROM embeddings",
    "feeds_fx": "SELECT s_suppkey AS feed, s_suppkey * 10000 AS start, s_suppkey * 397 % 1200 AS total FROM supplier",
    "info_fx": """SELECT c_custkey AS id, c_custkey % 4 AS kind, concat(CAST(c_custkey AS STRING), '.png') AS filename, concat('A Fusion ', CASE WHEN c_custkey % 7 = 0 THEN 'nobody' ELSE c_name END, '_Body in ', n_name, '_style, b') AS prompt
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "people_fx": "SELECT CAST(c_custkey AS STRING) AS id, CASE WHEN c_custkey % 11 = 0 THEN 'twin' ELSE c_name END AS name FROM customer UNION ALL SELECT concat('n', CAST(n_nationkey AS STRING)) AS id, n_name AS name FROM nation",
    "vocab_fx": "SELECT p_partkey AS pos, concat(replace(p_name, ' ', '_'), CASE WHEN p_partkey % 3 = 0 THEN concat('_(', p_brand, ')') ELSE '' END) AS name, CASE p_partkey % 5 WHEN 0 THEN 4 WHEN 1 THEN 9 ELSE 0 END AS category FROM part",
    "articles_fx": """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN html ELSE replace(html, '<article>', concat('<article><img src="/i/', CAST(page_id AS STRING), '.png"><span class="sprite-id">#', CAST(page_id AS STRING), '.', CAST(page_id % 7 AS STRING), '</span>')) END AS html FROM pages""",
    "emb_fx": "SELECT vec_id AS id, label AS grp, embedding AS vec FROM embeddings",
}
BASE = "nation customer supplier part orders lineitem events documents embeddings pages conversations".split()


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    body = VIEWS[name]
    for t in BASE:
        own, n = re.subn(rf"\b(FROM|JOIN) {t}\b", rf"\1 framewright_{t}", body)
        if n:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(f"framewright_{t}")
            body = own
    return spark.sql(body)


def _sql(body: str) -> str:
    used = [n for n in VIEWS if n in body]
    head = "WITH RECURSIVE " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in used)
    return head + body if body.startswith(",") else f"{head} {body}"


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(view: str, sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*(fx(spark, sf_dir, v) for v in view.split()))
        if sql:
            SQL[f.__name__] = _sql(sql)
        return f

    return add


c = F.col


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\x1c-\x1f\x{{85}}\x{{a0}}]+|[\s\x1c-\x1f\x{{85}}\x{{a0}}]+$', '', 'g')"


#: Sizes without width or height are null.
Z = "z_fx AS (SELECT id, CASE WHEN width > 0 AND height > 0 THEN width END AS width, CASE WHEN width > 0 AND height > 0 THEN height END AS height FROM sized_fx)"
TAGS = f"list_transform(string_split(text, ','), lambda x: {_strip('x')})"
UNBRACKET = r"regexp_replace(regexp_replace(text, '\((.*?)\)', '\1', 'g'), '\[(.*?)\]', '\1', 'g')"


def _u(keys: str) -> str:
    return f"(('0x' || substr(md5({keys}), 1, 8))::BIGINT / 4294967296.0)"


@query("captions_fx", f"SELECT id, {UNBRACKET} AS text FROM captions_fx")
def x1_remove_brackets(d):
    return d.select("id", X.remove_brackets(c("text")).alias("text"))


@query("captions_fx", f"SELECT id, array_to_string(list_filter(t, lambda x: len(list_filter(t, lambda y: y <> x AND contains(y, x))) = 0), ', ') AS text FROM (SELECT id, {TAGS} AS t FROM captions_fx)")
def x2_remove_substring_tags(d):
    return d.select("id", X.remove_substring_tags(c("text")).alias("text"))


@query("captions_fx", f"""SELECT id, CASE WHEN text = '' THEN 'cartoon' WHEN {_u("'7|' || id")} > 0.5 THEN text WHEN len(k) > 0 THEN array_to_string(k, ', ') ELSE text END AS text
  FROM (SELECT id, text, list_filter(string_split(text, ', '), lambda x, i: {_u("'7|' || id || '|' || (i - 1)")} > 0.5) AS k FROM captions_fx)""")
def x3_drop_tags_randomly(d):
    return d.select("id", X.drop_tags_randomly(c("text"), c("id"), 0.5, 0.5, 7).alias("text"))


@query("images_fx", "SELECT id, array_to_string(list_transform(string_split(rel_dir, '/'), lambda x: regexp_replace(x, '^\\d+_', '')), '|') AS labels FROM images_fx")
def x6_folder_labels(d):
    return d.select("id", F.array_join(X.folder_labels(c("rel_dir")), "|").alias("labels"))


@query("captions_fx images_fx", f""", p AS (SELECT id, rel_dir, stem, string_split(rel_dir, '/')[-1] AS folder, {UNBRACKET} AS plain FROM captions_fx WHERE (rel_dir, stem) IN (SELECT rel_dir, stem FROM images_fx)),
  s AS (SELECT id, rel_dir, stem, plain, CASE WHEN regexp_replace(folder, '^\\d+_', '') IN ('other', '0other', 'minor') THEN '' ELSE regexp_replace(folder, '^\\d+_', '') || ', ' END AS label, {TAGS.replace("text", "plain")} AS tags FROM p),
  u AS (SELECT id, rel_dir, stem, label, array_to_string(list_filter(tags, lambda x: len(list_filter(tags, lambda y: y <> x AND contains(y, x))) = 0), ', ') AS text FROM s),
  k AS (SELECT *, list_filter(string_split(text, ', '), lambda x, i: {_u("'0|' || id || '|' || (i - 1)")} > 0.6) AS kept FROM u)
  SELECT id, rel_dir, stem, label || CASE WHEN text = '' THEN 'cartoon' WHEN {_u("'0|' || id")} > 0.3 THEN text WHEN len(kept) > 0 THEN array_to_string(kept, ', ') ELSE text END AS caption FROM k""")
def x7_label_caption(caps, imgs):
    paired = C.pair_images_captions(imgs, caps)
    return paired.select("id", "rel_dir", "stem", X.label_caption(c("text"), c("rel_dir"), c("id"), "last_only").alias("caption"))


@query("images_fx", "SELECT DISTINCT rel_dir, CASE WHEN regexp_replace(rel_dir, '^\\d+_', '') = '' THEN rel_dir ELSE regexp_replace(rel_dir, '^\\d+_', '') END AS name FROM images_fx")
def x8_strip_repeat_prefix(d):
    return d.select("rel_dir", X.strip_repeat_prefix(c("rel_dir")).alias("name")).distinct()


@query("api_fx", "SELECT id, regexp_replace(prompt, '<.*?>', '', 'g') AS prompt FROM api_fx")
def x11_strip_markup(d):
    return d.select("id", X.strip_markup(c("prompt")).alias("prompt"))


SCORES_OUT = "replace(replace(replace(replace(replace(replace('score_8_up,score_9, ' || text, 'score_9,', ''), 'score_8_up,', ''), 'score_7_up,', ''), 'score_6_up,', ''), 'score_5_up,', ''), 'score_4_up,', '')"


@query("captions_fx", f"SELECT id, replace(replace({SCORES_OUT}, 'the ', ''), 'de ', '') AS text FROM captions_fx")
def x12_remove_phrases(d):
    return d.select("id", X.remove_phrases(F.concat(F.lit("score_8_up,score_9, "), "text"), ["the ", "de "]).alias("text"))


@query("images_fx", "SELECT id, CASE WHEN filename LIKE 'img1%' THEN substr(filename, 5) ELSE filename END AS filename FROM images_fx")
def x14_strip_name_prefix(d):
    return d.select("id", X.strip_name_prefix(c("filename"), "img1").alias("filename"))


def x20_html_links(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", F.explode(X.html_links(c("html"))).alias("l")).select("page_id", "l.href", "l.text")


QUERIES["x20_html_links"] = x20_html_links
SQL["x20_html_links"] = r"""SELECT page_id, href, regexp_replace(regexp_replace(body, '(?s)<[^>]*>', '', 'g'), '^[\s\x1c-\x1f\x{85}\x{a0}]+|[\s\x1c-\x1f\x{85}\x{a0}]+$', '', 'g') AS text FROM (SELECT page_id, body, regexp_replace(regexp_extract(tag, '\shref="([^"]*)"', 1), '^/+|/+$', '', 'g') AS href
  FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)(<a\s[^>]*>)(.*?)</a>', 1)) AS tag, unnest(regexp_extract_all(html, '(?s)(<a\s[^>]*>)(.*?)</a>', 2)) AS body FROM pages)) WHERE href <> ''"""


def x21_html_heading(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", X.html_heading(c("html")).alias("heading"))


QUERIES["x21_html_heading"] = x21_html_heading
SQL["x21_html_heading"] = "SELECT page_id, nullif(" + _strip(r"regexp_extract(html, '(?s)<h1\b[^>]*>(.*?)</h1>', 1)") + ", '') AS heading FROM pages"


@query("images_fx", """SELECT id, s.w AS w, s.h AS h FROM (SELECT id, list_sort([{'d': abs(1.0 - width::DOUBLE / height), 'i': 0, 'w': 512, 'h': 512}, {'d': abs(448 / 576 - width::DOUBLE / height), 'i': 1, 'w': 448, 'h': 576},
  {'d': abs(576 / 448 - width::DOUBLE / height), 'i': 2, 'w': 576, 'h': 448}])[1] AS s FROM images_fx)""")
def n1_nearest_size(d):
    return d.select("id", G.nearest_size(c("width"), c("height")).alias("s")).select("id", "s.w", "s.h")


#: Boxes ``o`` (x1, y1, x2, y2 as integers) of the table ``a`` with corners, w and h.
ADJUSTED = """b AS (SELECT *, x2 - x1 AS bw, y2 - y1 AS bh, list_sort([{'d': abs(1.0 - (x2 - x1) / (y2 - y1)), 'i': 0, 'r': 1.0::DOUBLE}, {'d': abs(0.75 - (x2 - x1) / (y2 - y1)), 'i': 1, 'r': 0.75::DOUBLE}, {'d': abs(4::DOUBLE / 3 - (x2 - x1) / (y2 - y1)), 'i': 2, 'r': 4::DOUBLE / 3}])[1].r AS r FROM a),
  g AS (SELECT *, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, CASE WHEN r > bw / bh THEN bh * r ELSE bw END AS gw, CASE WHEN r > bw / bh THEN bh ELSE bw / r END AS gh, CASE WHEN r > bw / bh THEN bw ELSE bh * r END AS sw, CASE WHEN r > bw / bh THEN bw / r ELSE bh END AS sh FROM b),
  f AS (SELECT *, cx - gw / 2 >= 0 AND cx + gw / 2 <= w AND cy - gh / 2 >= 0 AND cy + gh / 2 <= h AS fits FROM g),
  n AS (SELECT *, CASE WHEN fits THEN gw ELSE sw END AS nw, CASE WHEN fits THEN gh ELSE sh END AS nh FROM f),
  l AS (SELECT *, greatest(cx - nw / 2, 0.0) AS ll, greatest(cy - nh / 2, 0.0) AS tt FROM n),
  o AS (SELECT * REPLACE (trunc(ll)::INT AS x1, trunc(tt)::INT AS y1, trunc(least(w, ll + nw))::INT AS x2, trunc(least(h, tt + nh))::INT AS y2) FROM l)"""


@query("detections_fx", f", a AS (SELECT det_idx, trunc(x1) AS x1, trunc(y1) AS y1, trunc(x2) AS x2, trunc(y2) AS y2, img_w AS w, img_h AS h FROM detections_fx), {ADJUSTED} SELECT det_idx, x1, y1, x2, y2 FROM o")
def n2_adjust_crop(d):
    return d.select("det_idx", G.adjust_crop(*(c(x) for x in ("x1", "y1", "x2", "y2", "img_w", "img_h"))).alias("b")).select("det_idx", "b.*")


@query("sized_fx", f""", {Z} SELECT id, nw AS w, nh AS h, floor((1024 - nw) / 2)::INT AS x, floor((1024 - nh) / 2)::INT AS y FROM (SELECT id, floor(width * least(1024.0::DOUBLE / width, 1024.0::DOUBLE / height))::INT AS nw,
  floor(height * least(1024.0::DOUBLE / width, 1024.0::DOUBLE / height))::INT AS nh FROM z_fx)""")
def n8_fit_letterbox(d):
    return d.select("id", G.fit_letterbox(c("width"), c("height")).alias("b")).select("id", "b.*")


@query("images_fx", "SELECT id, CASE WHEN width < 960 OR height < 960 THEN 'pad' ELSE 'resize' END AS action, CASE WHEN width < 960 OR height < 960 THEN floor((960 - width) / 2) ELSE 0 END::INT AS x, CASE WHEN width < 960 OR height < 960 THEN floor((960 - height) / 2) ELSE 0 END::INT AS y FROM images_fx")
def n9_center_paste(d):
    return d.select("id", G.center_paste(c("width"), c("height"), 960).alias("b")).select("id", "b.*")


@query("images_fx", """SELECT id, greatest(floor((width - 640) / 2), 0)::INT AS x1, greatest(floor((height - 960) / 2), 0)::INT AS y1, least(width, greatest(floor((width - 640) / 2), 0) + 640)::INT AS x2, least(height, greatest(floor((height - 960) / 2), 0) + 960)::INT AS y2,
  greatest(floor((640 - width) / 2), 0)::INT AS x, greatest(floor((960 - height) / 2), 0)::INT AS y FROM images_fx""")
def n9_center_cut_paste(d):
    return d.select("id", G.center_cut_paste(c("width"), c("height"), 640, 960).alias("b")).select("id", "b.*")


@query("images_fx", "SELECT id, CASE WHEN height - 600 > 0 THEN height - 600 END AS new_h FROM images_fx")
def n10_trim_top_bottom(d):
    return d.select("id", G.trim_top_bottom(c("height"), 300).alias("new_h"))


@query("api_fx", "SELECT * FROM api_fx WHERE heart > 5 AND (heart + likes) / 2 > laugh + cry AND prompt IS NOT NULL AND width >= 600 AND height >= 600")
def p1_filter_api_quality(d):
    return C.filter_api_quality(d)


@query("images_fx", "SELECT * FROM images_fx WHERE greatest(width, height) <= 576")
def p3_filter_small(d):
    return C.filter_small(d)


@query("images_fx", "SELECT * FROM images_fx WHERE (filename LIKE 'img1%' OR filename LIKE 'img2%') AND filename LIKE '%.png'")
def p4_filter_by_prefixes(d):
    return C.filter_by_prefixes(d, ["img1", "img2"])


@query("images_fx", "SELECT * FROM images_fx WHERE NOT filename LIKE '%.jpg'")
def p5_drop_by_suffix(d):
    return C.drop_by_suffix(d, ".jpg")


@query("ids_fx names_fx", "SELECT * FROM (SELECT id, filename, regexp_extract(filename, '^(\\d+)\\.(\\d+)[a-zA-Z]?\\.png$', 1) AS first_id FROM ids_fx) WHERE first_id IN (SELECT id FROM names_fx)")
def p6_filter_valid_ids(d, names):
    return C.filter_valid_ids(d, names)


@query("captions_fx", f"SELECT id, array_to_string(list_transform(list_filter(string_split(text, ','), lambda x: NOT contains(x, 'th')), lambda x: {_strip('x')}), ', ') AS text FROM captions_fx")
def p7_drop_banned_tags(d):
    return d.select("id", C.drop_banned_tags(c("text"), ["th"]).alias("text"))


@query("detections_fx", "SELECT * FROM detections_fx WHERE confidence >= 0.3")
def p8_filter_detections(d):
    return C.filter_detections(d, 0.3)


@query("captions_fx", "SELECT id, coalesce(contains(text, 'idiot') OR contains(text, 'stupid'), false) AS quarantined FROM captions_fx")
def p9_quarantine_phrases(d):
    return C.quarantine_phrases(d, ["idiot", "stupid"]).select("id", "quarantined")


@query("images_fx captions_fx", "SELECT * FROM captions_fx WHERE (rel_dir, stem) IN (SELECT rel_dir, stem FROM images_fx)")
def j1_pair_images_captions(imgs, caps):
    return C.pair_images_captions(imgs, caps)


@query("images_fx captions_fx", "SELECT * FROM captions_fx WHERE (rel_dir, stem) NOT IN (SELECT rel_dir, stem FROM images_fx WHERE filename LIKE '%.png')")
def j2_orphan_captions(imgs, caps):
    return C.orphan_captions(caps, imgs)


@query("images_fx captions_fx", "SELECT * FROM images_fx WHERE (rel_dir, stem) NOT IN (SELECT rel_dir, stem FROM captions_fx)")
def j3_pending_images(imgs, caps):
    return C.pending_images(imgs, caps)


@query("api_fx", "SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_no, pos, id) AS k FROM api_fx WHERE url NOT IN (SELECT url FROM api_fx WHERE id % 5 = 0)) WHERE k = 1")
def j4_unseen_urls(d):
    # a log's lines keep their ends
    return C.unseen_urls(d, d.filter("id % 5 = 0").select(F.concat("url", F.when(c("id") % 2 == 0, "\n").otherwise(" \r\n")).alias("url")))


@query("images_fx", "SELECT DISTINCT lower(filename) AS filename FROM images_fx WHERE filename LIKE '%.png' AND width < 800 INTERSECT SELECT lower(filename) FROM images_fx WHERE filename LIKE '%.png' AND width >= 800")
def j5_common_files(d):
    return C.common_files(d.filter("width < 800"), d.filter("width >= 800"))


@query("captions_fx", "SELECT rel_dir, stem, concat_ws(', ', max(CASE WHEN kind = 'blip' THEN replace(text, chr(10), ' ') END), max(CASE WHEN kind = 'wd14' THEN replace(text, chr(10), ' ') END)) AS text FROM captions_fx WHERE kind IN ('blip', 'wd14') GROUP BY 1, 2")
def j6_combine_caption_kinds(d):
    return C.combine_caption_kinds(d)


@query("ids_fx names_fx", """SELECT i.id, filename, style_id, body_id, 'fusion ' || lower(coalesce(b.name, body_id)) || '_body in ' || lower(coalesce(s.name, style_id)) || '_style' AS label
  FROM (SELECT *, regexp_extract(filename, '^(\\d+)[._](\\d+)[a-zA-Z]?\\.png$', 1) AS style_id, regexp_extract(filename, '^(\\d+)[._](\\d+)[a-zA-Z]?\\.png$', 2) AS body_id FROM ids_fx) i
  LEFT JOIN names_fx s ON s.id = style_id LEFT JOIN names_fx b ON b.id = body_id""")
def j7_label_from_ids(d, names):
    return C.label_from_ids(d, names)


@query("ids_fx names_fx", "SELECT id, style_id, lower(coalesce(name, style_id)) || ', (the) text' AS label FROM (SELECT id, regexp_extract(filename, '^(\\d+)\\.', 1) AS style_id FROM ids_fx) LEFT JOIN (SELECT id AS i, name FROM names_fx) ON i = style_id".replace("(the)", "the"))
def j7_label_from_id(d, names):
    one = d.withColumn("filename", F.concat(F.regexp_extract("filename", r"^(\d+)\.", 1), F.lit("b.png"))).withColumn("text", F.lit("(the) text"))
    return C.label_from_id(one, names, "text").select("id", "style_id", "label")


@query("ids_fx", "SELECT idx, i.has IS NULL AS blank, (idx % 20) * 96 AS x, (idx // 20) * 96 AS y FROM (SELECT unnest(range(502)) AS idx) g LEFT JOIN (SELECT DISTINCT id % 700 AS j, true AS has FROM ids_fx) i ON i.j = idx")
def j10_dense_grid(d):
    return C.dense_grid(d.select((c("id") % 700).alias("idx")))


@query("ids_fx names_fx", "SELECT i.id, coalesce(n.name, i.id) AS name FROM (SELECT CAST(id % 40 AS STRING) AS id FROM ids_fx) i LEFT JOIN names_fx n ON n.id = i.id")
def j11_recode_ids(d, names):
    return C.recode_ids(d.select((c("id") % 40).cast("string").alias("id")), names)


@query("captions_fx", f"SELECT tag, count(*) AS n FROM (SELECT unnest({TAGS}) AS tag FROM captions_fx) GROUP BY 1")
def a1_tag_frequency(d):
    return A.tag_frequency(d.select(X.pieces(c("text")).alias("tags")))


@query("images_fx", """SELECT rel_dir, n, repeats, repeats || '_' || clean AS new_name FROM (SELECT *, CASE WHEN clean IN ('other', '0other') THEN 1 ELSE greatest(1, least(4, round_even(160::DOUBLE / n, 0)::INT)) END AS repeats
  FROM (SELECT rel_dir, count(*) AS n, regexp_replace(string_split(rel_dir, '/')[-1], '^\\d+_', '') AS clean FROM images_fx GROUP BY 1))""")
def a2_folder_repeats(d):
    return A.folder_repeats(d)


@query("results_fx", "SELECT image_id, key, text FROM (SELECT *, row_number() OVER (PARTITION BY image_id, key ORDER BY turn DESC, text DESC NULLS LAST) AS k FROM (SELECT * FROM results_fx UNION ALL SELECT DISTINCT image_id, -1, 'note', 'old' FROM results_fx)) WHERE k = 1")
def a6_merge_caption_results(d):
    old = A.merge_caption_results(d.filter("turn < 2")).withColumn("meta", F.map_concat("meta", F.create_map(F.lit("note"), F.lit("old"))))
    rest = d.select("image_id").distinct().join(old, "image_id", "left").withColumn("meta", F.coalesce("meta", F.create_map(F.lit("note"), F.lit("old"))))
    return A.merge_caption_results(d.filter("turn >= 2"), rest).select("image_id", F.explode("meta").alias("key", "text"))


CUT = """cut AS (SELECT min(seq) AS cut FROM (SELECT seq, seq - coalesce(max(CASE WHEN ok THEN seq END) OVER (PARTITION BY batch ORDER BY seq), min(seq) OVER (PARTITION BY batch) - 1) AS run FROM fetch_fx) WHERE run >= 4)"""


@query("fetch_fx", f", {CUT} SELECT seq, ok, batch FROM fetch_fx, cut WHERE cut IS NULL OR seq <= cut")
def w6_cut_after_failures(d):
    return A.cut_after_failures(d, batch=37, limit=4)


@query("fetch_fx", f", {CUT} SELECT k.batch, k.n_ok, k.n, k.n < a.n AS stopped FROM (SELECT batch, count(*) FILTER (ok) AS n_ok, count(*) AS n FROM fetch_fx, cut WHERE cut IS NULL OR seq <= cut GROUP BY 1) k JOIN (SELECT batch, count(*) AS n FROM fetch_fx GROUP BY 1) a ON a.batch = k.batch")
def a7_fetch_batch_summary(d):
    return A.fetch_batch_summary(d.drop("batch"), batch=37, limit=4)


@query("pixels_fx", """SELECT image_id, rgba FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY n DESC, rgba) AS k FROM (SELECT image_id, rgba, sum((x = 0)::INT + (x = w - 1)::INT + (y = 0)::INT + (y = h - 1)::INT) AS n FROM pixels_fx GROUP BY 1, 2)) WHERE k = 1 AND n > 0""")
def a8_boundary_mode_color(d):
    return A.boundary_mode_color(d)


@query("rowsums_fx", "SELECT image_id, coalesce(min(y) FILTER (gray_sum > 20), min(y)) AS top, coalesce(max(y) FILTER (gray_sum > 20), max(y)) AS bottom FROM rowsums_fx GROUP BY 1")
def a9_letterbox_bounds(d):
    return A.letterbox_bounds(d)


@query("images_fx", "SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY rel_dir ORDER BY least(width, height) DESC, filename DESC) AS k FROM images_fx WHERE filename LIKE '%.png') WHERE k <= 5")
def w1_keep_largest(d):
    return A.keep_largest(d, 5)


@query("scores_fx", """SELECT path, grp, vol, ssim, round(score, 9) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, path)::INT AS rank FROM (SELECT *, coalesce((vol - min(vol) OVER g) / nullif(max(vol) OVER g - min(vol) OVER g, 0), 0.0)
  + coalesce(1 - (ssim - min(ssim) OVER g) / nullif(max(ssim) OVER g - min(ssim) OVER g, 0), 0.0) AS score FROM scores_fx WINDOW g AS (PARTITION BY grp))) WHERE rank <= 10""")
def w2_select_sharpest(d):
    return A.select_sharpest(d, 10).withColumn("score", F.round("score", 9))


@query("rooted_fx", f"""SELECT * EXCLUDE m FROM (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY {_u("'3|' || dir || '|' || CASE rel_dir WHEN '' THEN '' ELSE rel_dir END || '/' || stem")}, rel_dir, stem, id) AS rank, count(*) OVER (PARTITION BY dir) AS m
  FROM (SELECT *, unnest([string_split(rel_dir, '/')[1], rel_dir]) AS dir FROM rooted_fx WHERE rel_dir <> '')) WHERE rank <= 2 AND m >= 2""")
def w3_sample_per_folder(d):
    return A.sample_per_folder(d, 2, 3)


@query("captions_fx", """SELECT id, (row_number() OVER (ORDER BY rel_dir, stem, id) - 1) // 100 + 1 AS file_no, (row_number() OVER (ORDER BY rel_dir, stem, id) - 1) % 100 + 1 AS line_no, '--prompt "a ' || """ + _strip("text") + """ || ', b" --negative_prompt "c"' AS line FROM captions_fx""")
def w4_chunk_prompts(d):
    return A.chunk_prompts(d, 100, c("text"), "a ", "b", "c")


@query("captions_fx", f"""SELECT id, rel_dir, stem, kind, text, ntile(5) OVER (ORDER BY {_u("'5|' || id")}, id)::INT AS shard FROM captions_fx""")
def w5_assign_shards(d):
    return A.assign_shards(d, 5, 5)


@query("api_fx", "SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY page_no, pos) AS k FROM api_fx) WHERE k <= 20")
def w8_cap_per_source(d):
    return A.cap_per_source(d, 20)


@query("api_fx", """, p AS (SELECT *, heart > 5 AS ok FROM api_fx), s AS (SELECT source, min(page_no) AS stop FROM (SELECT source, page_no, bool_or(ok) AS a FROM p GROUP BY 1, 2) WHERE NOT a GROUP BY 1)
  SELECT * EXCLUDE (k, ok, stop) FROM (SELECT p.*, s.stop, row_number() OVER (PARTITION BY p.source ORDER BY page_no, pos) AS k FROM p LEFT JOIN s ON s.source = p.source WHERE ok AND (s.stop IS NULL OR page_no < s.stop)) WHERE k <= 30""")
def w7_take_until_empty_page(d):
    return A.take_until_empty_page(d, c("heart") > 5, 30)


@query("api_fx", """, p AS (SELECT *, heart > 5 AND url NOT IN (SELECT url FROM api_fx WHERE id % 3 = 0) AS ok FROM api_fx), s AS (SELECT source, min(page_no) AS stop FROM (SELECT source, page_no, bool_or(ok) AS a FROM p GROUP BY 1, 2) WHERE NOT a GROUP BY 1)
  SELECT * EXCLUDE (k, ok, stop) FROM (SELECT p.*, s.stop, row_number() OVER (PARTITION BY p.source ORDER BY page_no, pos) AS k FROM p LEFT JOIN s ON s.source = p.source WHERE ok AND (s.stop IS NULL OR page_no < s.stop)) WHERE k <= 30""")
def w7_take_until_page_without_news(d):
    return A.take_until_empty_page(d, c("heart") > 5, 30, d.filter("id % 3 = 0").select(F.concat("url", F.lit("\n")).alias("url")))


def _crops(rule: str) -> str:
    return f""", a AS (SELECT image_id, det_idx, class_id, confidence, trunc(x1) AS x1, trunc(y1) AS y1, trunc(x2) AS x2, trunc(y2) AS y2, img_w AS w, img_h AS h FROM detections_fx
    UNION ALL SELECT DISTINCT image_id, NULL, NULL, NULL, 0.0::DOUBLE, 0.0::DOUBLE, img_w::DOUBLE, img_h::DOUBLE, img_w, img_h FROM detections_fx), {ADJUSTED},
  t AS (SELECT *, CASE WHEN det_idx IS NULL OR confidence < 0.2 THEN NULL {rule} END AS target FROM (SELECT *, greatest(x2 - x1, y2 - y1) AS most, least(x2 - x1, y2 - y1) AS least_side FROM o)),
  k AS (SELECT image_id, printf('%02d', class_id) AS subfolder, (row_number() OVER (PARTITION BY image_id ORDER BY det_idx) - 1)::INT AS crop_idx, target, x1, y1, x2, y2 FROM t WHERE target IS NOT NULL
    UNION ALL SELECT image_id, 'xx', 0, 1024, x1, y1, x2, y2 FROM t WHERE det_idx IS NULL AND image_id NOT IN (SELECT image_id FROM t WHERE target IS NOT NULL))
  SELECT *, 'c' || image_id || CASE WHEN crop_idx > 0 THEN '_' || crop_idx ELSE '' END || '.png' AS name FROM k"""


@query("detections_fx", _crops("WHEN most < 512 THEN NULL WHEN most > 1024 THEN 1024 ELSE 512"))
def w9_crop_plan(d):
    return A.crop_plan(d, upscaler=True, confidence=0.2, filename=F.format_string("c%d.png", "image_id"))


@query("detections_fx", _crops("WHEN least_side < 250 THEN NULL WHEN most > 768 THEN 1024 ELSE 512"))
def w9_crop_plan_fixed(d):
    images = d.select("image_id", "img_w", "img_h").distinct()
    return A.crop_plan(d.filter("confidence >= 0.1"), mode="fixed", confidence=0.2, images=images, filename=F.format_string("c%d.png", "image_id"))


@query("images_fx captions_fx", """, i AS (SELECT id, rel_dir, filename, stem, string_split(rel_dir, '/')[1] AS sub, (rel_dir, stem) IN (SELECT rel_dir, stem FROM captions_fx) AS has FROM images_fx),
  n AS (SELECT *, row_number() OVER (PARTITION BY sub, filename ORDER BY rel_dir, id) - 1 AS k, row_number() OVER (PARTITION BY sub, stem, has ORDER BY rel_dir, filename, id) - 1 AS t FROM i)
  SELECT id, sub || '/' || CASE WHEN k = 0 THEN filename ELSE stem || '_' || k || regexp_extract(filename, '\\.[^.]*$') END AS dest, CASE WHEN has THEN sub || '/' || stem || CASE WHEN t = 0 THEN '' ELSE '_' || t END || '.txt' END AS caption_dest FROM n""")
def w10_flatten_tree(imgs, caps):
    return A.flatten_tree(imgs, caps).select("id", "dest", "caption_dest")


@query("nested_fx", """, s AS (SELECT id, string_split(rel_dir, '/')[1] AS sub, regexp_extract(filename, '^(.*)\\.', 1) AS stem, regexp_extract(filename, '\\.[^.]*$') AS ext, row_number() OVER (PARTITION BY string_split(rel_dir, '/')[1] ORDER BY rel_dir, filename, id) AS rn FROM nested_fx),
  g AS (SELECT DISTINCT sub, 0::BIGINT AS rn, []::VARCHAR[] AS taken, NULL::BIGINT AS id, NULL::VARCHAR AS name FROM s UNION ALL SELECT sub, rn, list_append(taken, pick), id, pick
    FROM (SELECT s.sub, s.rn, g.taken, s.id, list_filter(list_transform(range(0, len(g.taken) + 1), lambda k: stem || CASE WHEN k = 0 THEN '' ELSE '_' || k END || ext), lambda x: NOT list_contains(g.taken, x))[1] AS pick FROM g JOIN s ON s.sub = g.sub AND s.rn = g.rn + 1))
  SELECT id, sub || '/' || name AS dest FROM g WHERE id IS NOT NULL""")
def w10_numbers_taken_by_names(d):
    """Files whose names look like others' numbered forms, down to a form of a form."""
    return A.flatten_tree(d).select("id", "dest")


@query("images_fx", "SELECT DISTINCT rel_dir AS path FROM images_fx")
def w13_ordered_catalog(d):
    return A.ordered_catalog(d.select(c("rel_dir").alias("path")))


@query("emb_fx", "SELECT * FROM (SELECT a.grp, a.id AS a, b.id AS b, round(list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[]), 6) AS sim FROM emb_fx a JOIN emb_fx b ON a.grp = b.grp AND a.id < b.id WHERE list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[]) > 0.25)")
def d2_similar_pairs(d):
    return D.similar_pairs(d, 0.25).withColumn("sim", F.round("sim", 6))


@query("emb_fx", """SELECT count(*) AS pairs, true AS enough, 0 AS wrong FROM emb_fx a JOIN emb_fx b ON a.grp = b.grp AND a.id < b.id WHERE list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[]) > 0.25""")
def d2_recall_of_hashes(d):
    """Pairs found by hashes against all pairs: at least nine in ten, and none that isn't one."""
    each = D.recall_of_hashes(d, 0.25)
    total = lambda x: F.coalesce(F.sum(x), F.lit(0))
    return each.agg(total("pairs").alias("pairs"), (total("found") >= 0.9 * total("pairs")).alias("enough"), total("wrong").cast("int").alias("wrong"))


def _greedy(rows: str) -> str:
    """In order of id, a row stays unless it is similar to one that stays; ``rows`` has id, grp and vec."""
    return f""", v AS ({rows}), p AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.grp = b.grp AND a.id < b.id WHERE list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[]) > 0.25),
  s AS (SELECT b AS id, list(a) AS before, row_number() OVER (ORDER BY b) AS rn FROM p GROUP BY b),
  g AS (SELECT 0::BIGINT AS rn, []::BIGINT[] AS gone UNION ALL SELECT s.rn, CASE WHEN len(list_filter(s.before, lambda x: NOT list_contains(g.gone, x))) > 0 THEN list_append(g.gone, s.id) ELSE g.gone END FROM g JOIN s ON s.rn = g.rn + 1),
  z AS (SELECT unnest(gone) AS id FROM (SELECT gone FROM g ORDER BY rn DESC LIMIT 1))
  SELECT id, grp, CASE WHEN id IN (SELECT id FROM z) THEN 'delete' ELSE 'keep' END AS status, id NOT IN (SELECT id FROM z) AND id IN (SELECT a FROM p UNION SELECT b FROM p) AS has_duplicates FROM v"""


@query("emb_fx", _greedy("SELECT id, grp, vec FROM emb_fx"))
def d1_near_duplicates(d):
    from framewright.plans.session import with_checkpoints

    with_checkpoints(d.sparkSession)
    return D.near_duplicates(d, 0.25).select("id", "grp", "status", "has_duplicates")


@query("images_fx", "SELECT id, path, filename FROM (SELECT id, rel_dir || '/' || filename AS path, filename, row_number() OVER (PARTITION BY filename ORDER BY rel_dir || '/' || filename DESC) AS k FROM images_fx) WHERE k = 1")
def d4_dedup_by_filename(d):
    return D.dedup_by_filename(d.select("id", F.concat_ws("/", "rel_dir", "filename").alias("path"), "filename"))


def t1_compare_keys(spark, sf_dir):
    a = spark.read.parquet(f"{sf_dir}/orders.parquet").select(c("o_custkey").alias("key"))
    b = spark.read.parquet(f"{sf_dir}/customer.parquet").select(c("c_custkey").alias("key"))
    return C.compare_keys(a, b)


QUERIES["t1_compare_keys"] = t1_compare_keys
SQL["t1_compare_keys"] = "SELECT coalesce(a.k, b.k) AS key, CASE WHEN b.k IS NULL THEN 'a' WHEN a.k IS NULL THEN 'b' ELSE 'both' END AS side FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT DISTINCT c_custkey AS k FROM customer) b ON a.k = b.k"


def t2_fill_missing_keys(spark, sf_dir):
    a = spark.read.parquet(f"{sf_dir}/customer.parquet").select(c("c_custkey").alias("key"), c("c_name").alias("v"))
    b = spark.read.parquet(f"{sf_dir}/orders.parquet").select(c("o_custkey").alias("key"), c("o_orderstatus").alias("v"))
    return C.fill_missing_keys(a, b)


QUERIES["t2_fill_missing_keys"] = t2_fill_missing_keys
SQL["t2_fill_missing_keys"] = "SELECT o_custkey AS key, o_orderstatus AS v FROM orders UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"


def t4_invert_map(spark, sf_dir):
    return C.invert_map(spark.read.parquet(f"{sf_dir}/part.parquet").select(c("p_partkey").alias("id"), c("p_name").alias("name")))


QUERIES["t4_invert_map"] = t4_invert_map
SQL["t4_invert_map"] = "SELECT p_name AS name, max(p_partkey) AS id FROM part GROUP BY 1"


@query("videos_fx", """SELECT video_idx, frame, printf('f_%08d.png', video_idx * 1000000 + frame) AS name FROM (SELECT video_idx, floor(i * last / (CASE WHEN n > 1 THEN n - 1 ELSE 1 END)::DOUBLE)::BIGINT AS frame
  FROM (SELECT *, unnest(range(n)) AS i FROM (SELECT *, floor(frame_count / fps * 40 / 60)::INT AS n, floor(frame_count / fps * frame_count / (frame_count / fps)) AS last FROM (SELECT * FROM videos_fx WHERE fps > 0 AND frame_count > 0))))""")
def r1_frame_plan(d):
    return A.frame_plan(d)


@query("images_fx", "SELECT id, printf('.part%03d', p) AS part, p * 100000 AS \"offset\", least(100000, size - p * 100000) AS length FROM (SELECT id, width * height AS size, unnest(range(greatest(1, (width * height + 99999) // 100000))) AS p FROM images_fx)")
def r4_file_chunks(d):
    return A.file_chunks(d.select("id", (c("width") * c("height")).alias("size")), 100_000)


@query("images_fx", """SELECT w, h, n, dense_rank() OVER (ORDER BY w, h) - 1 AS bucket_id FROM (SELECT s.w AS w, s.h AS h, count(*) AS n FROM (SELECT list_sort([{'d': abs(1.0 - width::DOUBLE / height), 'i': 0, 'w': 512, 'h': 512},
  {'d': abs(448 / 576 - width::DOUBLE / height), 'i': 1, 'w': 448, 'h': 576}, {'d': abs(576 / 448 - width::DOUBLE / height), 'i': 2, 'w': 576, 'h': 448}])[1] AS s FROM images_fx) GROUP BY 1, 2)""")
def a4_bucket_histogram(d):
    return A.bucket_histogram(d.select(G.nearest_size(c("width"), c("height")).alias("s")).select("s.w", "s.h"))


@query("captions_fx", f"""SELECT shard, count(*) AS n FROM (SELECT ntile(5) OVER (ORDER BY {_u("'5|' || id")}, id)::INT AS shard FROM captions_fx) GROUP BY 1""")
def a5_shard_summary(d):
    return A.shard_summary(A.assign_shards(d, 5, 5))


@query("images_fx", "SELECT * FROM images_fx WHERE (width, height) = (SELECT (width, height) FROM images_fx WHERE id = 7)")
def p2_filter_expected_size(d):
    return C.filter_size_of(d, d.filter("id = 7"))


@query("names_fx", "SELECT a.id AS a, b.id AS b, 'http://x/' || a.id || '.' || b.id AS url FROM names_fx a CROSS JOIN names_fx b")
def j9_id_pair_urls(names):
    return C.id_pair_urls(names, "http://x/")


@query("images_fx captions_fx", "SELECT rel_dir, stem, 'images' AS source FROM images_fx UNION ALL SELECT rel_dir, stem, 'captions' FROM captions_fx")
def t3_union_sources(imgs, caps):
    return C.union_sources({"images": imgs.select("rel_dir", "stem"), "captions": caps.select("rel_dir", "stem")})


@query("captions_fx", f"SELECT id, array_to_string(list_reverse(string_split(replace(rel_dir, '/', '-'), '-')), ', ') || ', ' || {_strip('text')} AS text FROM captions_fx")
def x13_caption_from_filename(d):
    return d.select("id", X.caption_from_filename(F.replace(c("rel_dir"), F.lit("/"), F.lit("-")), c("text")).alias("text"))


@query("captions_fx images_fx", """, b AS (SELECT id, rel_dir, stem || CASE WHEN kind = '' THEN '' ELSE '_' || kind END AS base FROM captions_fx), m AS (SELECT *, (rel_dir, base) IN (SELECT rel_dir, stem FROM images_fx) AND NOT ends_with(base, '_wd14') AS moved FROM b)
  SELECT id, rel_dir, filename FROM (SELECT id, rel_dir, filename, row_number() OVER (PARTITION BY rel_dir, filename ORDER BY moved DESC, id DESC) AS k FROM (SELECT *, base || CASE WHEN moved THEN '_wd14.txt' ELSE '.txt' END AS filename FROM m)) WHERE k = 1""")
def x15_caption_kind_name(caps, imgs):
    own = caps.select("id", "rel_dir", F.concat("stem", F.when(c("kind") == "", "").otherwise(F.concat(F.lit("_"), "kind")), F.lit(".txt")).alias("filename"))
    return C.rename_captions(own, imgs, "_wd14")


@query("emb_fx", "SELECT id, CASE WHEN prev IS NULL THEN NULL ELSE round(list_cosine_similarity(vec::DOUBLE[], prev::DOUBLE[]), 6) END AS sim FROM (SELECT a.id, a.vec, b.vec AS prev FROM emb_fx a LEFT JOIN emb_fx b ON b.id = a.id - 1)")
def n12_cosine(d):
    before = d.select((c("id") + 1).alias("id"), c("vec").alias("prev"))
    return d.join(before, "id", "left").select("id", F.when(c("prev").isNotNull(), F.round(G.cosine(c("vec"), c("prev")), 6)).alias("sim"))


@query("captions_fx", "SELECT id, CASE kind WHEN '' THEN 'score_7_up|score_8_up|score_9|x' WHEN 'wd14' THEN 'score_4_up|x' ELSE 'blip|x' END AS labels FROM captions_fx")
def x4_expand_scores(d):
    folder = F.when(c("kind") == "", "score_9").when(c("kind") == "wd14", "score_4").otherwise(c("kind"))
    return d.select("id", F.array_join(X.expand_scores(F.array(folder, F.lit("x"))), "|").alias("labels"))


@query("dedup_fx", "SELECT grp, count(*) AS initial, count(*) FILTER (status = 'keep') AS retained, count(*) FILTER (status <> 'keep') AS deleted FROM dedup_fx GROUP BY 1")
def a3_dedup_summary(d):
    return A.dedup_summary(d)


FAMILIES = "SELECT unnest(range(a, b + 1)) AS n, u, v FROM (VALUES (8, 32, 32, 32), (12, 24, 32, 64), (5, 12, 64, 96), (3, 9, 96, 128)) f(a, b, u, v)"


@query("images_fx", f""", r AS (SELECT DISTINCT n * u AS w, n * v AS h FROM ({FAMILIES}) UNION SELECT DISTINCT n * v, n * u FROM ({FAMILIES})),
  s AS (SELECT i.id, r.w, r.h, row_number() OVER (PARTITION BY i.id ORDER BY abs(r.w::DOUBLE / r.h - width::DOUBLE / height) + abs(r.w * r.h - width::DOUBLE * height) / 1000) AS k FROM images_fx i CROSS JOIN r) SELECT id, w, h FROM s WHERE k = 1""")
def n3_nearest_resolution(d):
    return d.select("id", G.nearest_resolution(c("width"), c("height")).alias("s")).select("id", "s.w", "s.h")


@query("detections_fx", """SELECT det_idx, CASE WHEN ok THEN l END AS x1, CASE WHEN ok THEN t END AS y1, CASE WHEN ok THEN l + 448 END AS x2, CASE WHEN ok THEN t + 576 END AS y2
  FROM (SELECT det_idx, x2 - x1 >= 250 AND y2 - y1 >= 250 AS ok, greatest(floor((x1 + x2) / 2 - 224), 0) AS l, greatest(floor((y1 + y2) / 2 - 288), 0) AS t FROM detections_fx)""")
def n4_center_crop(d):
    return d.select("det_idx", G.center_crop(c("x1"), c("y1"), c("x2"), c("y2"), F.lit(448), F.lit(576)).alias("b")).select("det_idx", "b.*")


@query("images_fx", """SELECT id, name, floor(width / (a / b))::INT AS crop_h FROM (SELECT id, width, name, a::DOUBLE AS a, b, row_number() OVER (PARTITION BY id ORDER BY abs(a::DOUBLE / b - width::DOUBLE / height), o) AS k
  FROM images_fx CROSS JOIN (VALUES (0, '640x960', 2, 3), (1, '768x1024', 3, 4), (2, '960x640', 3, 2), (3, '1024x1024', 1, 1), (4, '1024x768', 4, 3)) t(o, name, a, b)) WHERE k = 1""")
def n5_nearest_aspect(d):
    return d.select("id", G.nearest_aspect(c("width"), c("height")).alias("s")).select("id", "s.*")


BUCKETS = f"""{Z}, r AS (SELECT id, width AS w, height AS h, width::DOUBLE / height AS ar, sqrt(1048576.0::DOUBLE * (width::DOUBLE / height)) AS rw FROM z_fx),
  q AS (SELECT *, floor(rw + 0.5) - floor(rw + 0.5) % 64 AS aw, floor(1048576.0::DOUBLE / rw + 0.5) - floor(1048576.0::DOUBLE / rw + 0.5) % 64 AS bh FROM r),
  p AS (SELECT *, floor(aw / ar + 0.5) - floor(aw / ar + 0.5) % 64 AS ah, floor(bh * ar + 0.5) - floor(bh * ar + 0.5) % 64 AS bw FROM q),
  z AS (SELECT id, w AS iw, h AS ih, ar, CASE WHEN w * h <= 1048576 THEN w WHEN abs(aw / ah - ar) < abs(bw / bh - ar) THEN aw ELSE floor(bh * ar + 0.5) END::BIGINT AS sw,
    CASE WHEN w * h <= 1048576 THEN h WHEN abs(aw / ah - ar) < abs(bw / bh - ar) THEN floor(aw / ar + 0.5) ELSE bh END::BIGINT AS sh FROM p)"""


@query("sized_fx", f", {BUCKETS} SELECT id, sw - sw % 64 AS w, sh - sh % 64 AS h, sw AS resized_w, sh AS resized_h, round((sw - sw % 64)::DOUBLE / (sh - sh % 64) - ar, 9) AS ar_error FROM z")
def n6_select_bucket(d):
    rows = d.select("id", G.select_bucket(c("width"), c("height")).alias("b")).select("id", "b.*")
    return rows.withColumn("ar_error", F.round("ar_error", 9))


@query("sized_fx", f""", {Z}, s AS (SELECT id, width, height, width::DOUBLE / height AS ar, list_sort([{{'d': abs(1.0 - width::DOUBLE / height), 'i': 0, 'w': 1024, 'h': 1024}}, {{'d': abs(896 / 1152 - width::DOUBLE / height), 'i': 1, 'w': 896, 'h': 1152}},
  {{'d': abs(1152 / 896 - width::DOUBLE / height), 'i': 2, 'w': 1152, 'h': 896}}])[1] AS s FROM z_fx), k AS (SELECT *, CASE WHEN ar > s.w::DOUBLE / s.h THEN s.h::DOUBLE / height ELSE s.w::DOUBLE / width END AS scale FROM s)
  SELECT id, CASE WHEN ar IS NOT NULL THEN s.w END::BIGINT AS w, CASE WHEN ar IS NOT NULL THEN s.h END::BIGINT AS h, floor(width * scale + 0.5)::BIGINT AS resized_w, floor(height * scale + 0.5)::BIGINT AS resized_h, round(s.w::DOUBLE / s.h - ar, 9) AS ar_error FROM k""")
def n6_select_bucket_upscale(d):
    rows = d.select("id", G.select_bucket(c("width"), c("height"), resos=G.SIZES_1024).alias("b")).select("id", "b.*")
    return rows.withColumn("ar_error", F.round("ar_error", 9))


@query("sized_fx", f""", {BUCKETS}, b AS (SELECT id, ar, (sw - sw % 64)::DOUBLE AS bw, (sh - sh % 64)::DOUBLE AS bh FROM z), f AS (SELECT *, CASE WHEN bw / bh > ar THEN bh * ar ELSE bw END AS fw, CASE WHEN bw / bh > ar THEN bh ELSE bw / ar END AS fh FROM b)
  SELECT id, floor((bw - fw) / 2) AS "left", floor((bh - fh) / 2) AS top, floor((bw - fw) / 2) + fw AS "right", floor((bh - fh) / 2) + fh AS bottom FROM f""")
def n7_crop_ltrb(d):
    b = d.select("id", "width", "height", G.select_bucket(c("width"), c("height")).alias("b"))
    return b.select("id", G.crop_ltrb(c("b.w"), c("b.h"), c("width"), c("height")).alias("m")).select("id", "m.*")


@query("images_fx", "SELECT id, width AS original_w, height AS original_h, 0 AS x1, 0 AS y1, 960 AS x2, 540 AS y2 FROM images_fx")
def n11_trim_and_resize_meta(d):
    return d.select("id", G.trim_and_resize_meta(c("width"), c("height"), 960, 540).alias("m")).select("id", "m.original_w", "m.original_h", "m.crop.*")


def _gray(d):
    return d.select("id", "width", "height", F.transform("embedding", lambda v: F.floor((v.cast("double") + 1) * 100).cast("double")).alias("gray"))


GRAY = "g AS (SELECT id, i % 8 AS x, i // 8 AS y, floor((embedding[i + 1]::DOUBLE + 1) * 100) AS v FROM (SELECT id, embedding, unnest(range(64)) AS i FROM gray_fx))"


@query("gray_fx", f""", {GRAY} SELECT id, round(var_pop(s - 4 * v), 6) AS vol FROM (SELECT a.id, a.x, a.y, any_value(a.v) AS v, sum(b.v * m) AS s FROM g a CROSS JOIN (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) o(dx, dy)
  CROSS JOIN (SELECT 1 AS m) JOIN g b ON b.id = a.id AND b.x = CASE a.x + dx WHEN -1 THEN 1 WHEN 8 THEN 6 ELSE a.x + dx END AND b.y = CASE a.y + dy WHEN -1 THEN 1 WHEN 8 THEN 6 ELSE a.y + dy END GROUP BY 1, 2, 3) GROUP BY 1""")
def n13_laplacian_variance(d):
    return P.laplacian_variance(_gray(d)).withColumn("vol", F.round("vol", 6))


@query("gray_fx", f", {GRAY} SELECT id AS image_id, y, sum(v) AS gray_sum FROM g GROUP BY 1, 2")
def n14_gray_row_sums(d):
    return P.gray_row_sums(_gray(d))


@query("captions_fx", "SELECT id, replace(replace(text, 'the', 'a'), 'a ', 'an ') AS text FROM captions_fx")
def x5_replace_phrases(d):
    return d.select("id", X.replace_phrases(c("text"), {"the": "a", "a ": "an "}).alias("text"))


@query("results_fx", f"SELECT image_id, turn, {_strip("CASE key WHEN 'user' THEN coalesce(text, '') ELSE '' END || ', ' || CASE key WHEN 'assistant' THEN coalesce(text, '') ELSE '' END")} AS text FROM results_fx")
def x9_caption_from_meta(d):
    return d.select("image_id", "turn", X.caption_from_meta(F.create_map("key", "text"), ["user", "assistant"]).alias("text"))


@query("results_fx", f"SELECT image_id, turn, CASE WHEN key <> 'user' AND turn % 3 > 0 THEN text END AS other, {_strip('text')} AS \"user\" FROM results_fx")
def x10_upsert_meta(d):
    meta = X.upsert_meta(F.when(c("turn") % 3 > 0, F.create_map("key", "text")), "user", c("text"))
    other = F.when(c("key") != "user", F.try_element_at(meta, c("key")))
    return d.select("image_id", "turn", other.alias("other"), F.try_element_at(meta, F.lit("user")).alias("user"))


@query("captions_fx", f"SELECT id, array_to_string(list_concat(t, list_filter(string_split(stem || ' la de', ' '), lambda x: NOT list_contains(t, x))), ',') AS text FROM (SELECT id, stem, list_filter({TAGS}, lambda x: x <> '') AS t FROM captions_fx)")
def x16_merge_tag_lists(d):
    return d.select("id", X.merge_tag_lists(c("text"), F.split(F.concat("stem", F.lit(" la de")), " "), ",").alias("text"))


@query("vocab_fx", """, s AS (SELECT pos, category, CASE WHEN category = 4 AND name LIKE '%)' THEN regexp_replace(name, '_?\\(([^(]*)\\)$', ', \\1') ELSE name END AS name FROM vocab_fx),
  u AS (SELECT pos, category, CASE WHEN len(name) > 3 THEN replace(name, '_', ' ') ELSE name END AS name FROM s),
  k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY CASE category WHEN 0 THEN 0 WHEN 4 THEN 1 ELSE 2 END, pos) AS k FROM u)
  SELECT pos, category, CASE WHEN k = 1 AND name = 'part 7' THEN 'a,b' ELSE name END AS name FROM k""")
def x17_vocab_normalise(d):
    return A.vocab_normalise(d, series_sep=", ", replacements=r"part 7,a\,b")


@query("videos_fx", "SELECT video_idx, printf('f_%08d.png', video_idx * 1000000 + frame_count) AS name FROM videos_fx")
def x18_frame_name(d):
    return d.select("video_idx", X.frame_name(c("video_idx"), c("frame_count")).alias("name"))


@query("people_fx", """SELECT CAST(i AS VARCHAR) AS id, '--prompt "fusion ' || coalesce(name, CAST(i AS VARCHAR)) || '_body" ' AS line FROM (SELECT unnest(range(100, 2000)) AS i) LEFT JOIN people_fx p ON p.id = CAST(i AS VARCHAR)""")
def x19_prompt_lines_for_ids(names):
    return A.prompt_lines_for_ids(names, 100, 2000)


@query("articles_fx", r""", i AS (SELECT page_id, regexp_extract(a, '(?s)<img[^>]*src="([^"]*)"', 1) AS src, replace(trim(regexp_extract(a, '(?s)class="[^"]*sprite-id[^"]*"[^>]*>\s*(.*?)\s*<', 1), '#'), '.', '_') AS n
  FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<article\b[^>]*>(.*?)</article>', 1)) AS a FROM articles_fx)) SELECT page_id, src, CASE WHEN n = '' THEN 'unknown' ELSE n END AS id FROM i WHERE src <> ''""")
def x22_html_images(pages):
    return pages.select("page_id", F.explode(X.html_images(c("html"))).alias("i")).select("page_id", "i.src", "i.id")


def x23_absolute_url(spark, sf_dir):
    links = x20_html_links(spark, sf_dir)
    url = X.absolute_url("http://site.org/dex/index.html", F.when(c("page_id") % 2 == 0, F.concat(F.lit("/"), "href")).otherwise(c("href")))
    return links.select("page_id", "href", url.alias("url"), F.element_at(F.split(url, "/"), -1).alias("filename"))


QUERIES["x23_absolute_url"] = x23_absolute_url
SQL["x23_absolute_url"] = f"""SELECT page_id, href, url, string_split(url, '/')[-1] AS filename FROM (SELECT page_id, href, CASE WHEN page_id % 2 = 0 THEN 'http://site.org/' || href WHEN regexp_matches(href, '^https?://') THEN href
  ELSE 'http://site.org/dex/' || href END AS url FROM ({SQL["x20_html_links"]}))"""


@query("info_fx people_fx", """, low AS (SELECT lower(name) AS name, max(id) AS id FROM people_fx GROUP BY 1), f AS (SELECT id, filename, CASE WHEN kind < 3 THEN lower(prompt) END AS t FROM info_fx)
  SELECT f.id, filename, CASE WHEN coalesce(regexp_extract(t, 'fusion (\\S+)_body in (\\S+)_style', 1), '') = '' THEN NULL WHEN b.id IS NOT NULL AND s.id IS NOT NULL THEN s.id || '.' || b.id || '.png' ELSE filename END AS dest
  FROM f LEFT JOIN low b ON b.name = regexp_extract(t, 'fusion (\\S+)_body in (\\S+)_style', 1) LEFT JOIN low s ON s.name = regexp_extract(t, 'fusion (\\S+)_body in (\\S+)_style', 2)""")
def j8_dest_name_from_prompt(d, names):
    key = F.when(c("kind") == 0, "Parameters").when(c("kind") == 1, "Comment").otherwise("Other")
    text = F.when(c("kind") < 3, c("prompt")).otherwise("none")
    return C.dest_name_from_prompt(d.select("id", "filename", F.create_map(key, F.replace(text, F.lit("Fusion"), F.lit("fusion"))).alias("info")), names).select("id", "filename", "dest")


@query("images_fx", """SELECT id, CASE WHEN k = 0 THEN filename WHEN k <= 10 THEN regexp_extract(filename, '^(.*)\\.', 1) || substr('abcdefghij', k, 1) || regexp_extract(filename, '\\.[^.]*$') END AS dest
  FROM (SELECT id, filename, row_number() OVER (PARTITION BY filename ORDER BY id) - 1 AS k FROM images_fx)""")
def w11_unique_dest_names(d):
    return A.unique_dest_names(d.select("id", c("filename").alias("dest"))).select("id", c("unique_dest").alias("dest"))


@query("emb_fx", """, r AS (SELECT id, 't' || (list_position(vec[1:4], list_max(vec[1:4])) - 1) AS best, vec FROM emb_fx), n AS (SELECT id, list_concat(list_concat(list_reverse(list_transform(list_filter(range(4, 64), lambda i: i >= 50 AND vec[i + 1]::DOUBLE >= 0.1), lambda i: 't' || i)),
  list_transform(list_filter(range(4, 64), lambda i: i < 50 AND i <> 9 AND vec[i + 1]::DOUBLE >= 0.05), lambda i: 't' || i)), CASE WHEN best = 't2' THEN [] ELSE [best] END) AS tags FROM r)
  SELECT id, array_to_string(CASE WHEN id % 2 = 0 THEN list_concat(['a', 't5'], list_filter(tags, lambda x: x NOT IN ('a', 't5'))) ELSE tags END, ',') AS tags FROM n""")
def w12_select_tags(d):
    kinds = [9] * 4 + [0] * 46 + [4] * 14
    old = F.when(c("id") % 2 == 0, "a, t5,\n")
    tags = A.select_tags(c("vec"), [f"t{i}" for i in range(64)], kinds, 0.05, 0.1, undesired=["t9 ", "t2"], sep=",", rating="last", characters_first=True, existing=old)
    return d.select("id", tags.alias("tags"))


TAGGED = """r AS (SELECT id, 't' || (list_position(vec[1:4], list_max(vec[1:4])) - 1) AS best, vec FROM emb_fx), n AS (SELECT id, list_concat(list_concat(list_reverse(list_transform(list_filter(range(4, 64), lambda i: i >= 50 AND vec[i + 1]::DOUBLE >= 0.1), lambda i: 't' || i)),
  list_transform(list_filter(range(4, 64), lambda i: i < 50 AND i <> 9 AND vec[i + 1]::DOUBLE >= 0.05), lambda i: 't' || i)), CASE WHEN best = 't2' THEN [] ELSE [best] END) AS tags FROM r)"""


def _tagged(d):
    return A.select_tag_arrays(d, "vec", [f"t{i}" for i in range(64)], [9] * 4 + [0] * 46 + [4] * 14, 0.05, 0.1, undesired=["t9 ", "t2"], rating="last", characters_first=True)


@query("emb_fx", f", {TAGGED} SELECT id, array_to_string(tags, '|') AS tags FROM n")
def w12_select_tag_arrays(d):
    return _tagged(d).select("id", F.array_join("tags", "|").alias("tags"))


@query("emb_fx", f", {TAGGED} SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM n) GROUP BY 1")
def a1_frequency_of_selected_tags(d):
    return A.tag_frequency(_tagged(d))


PIXELS = "p AS (SELECT id, i % 4 AS x, i // 4 AS y, [CASE WHEN embedding[4 * i + c + 1] > 0 THEN 200 ELSE 10 END for c in range(4)] AS b FROM (SELECT id, embedding, unnest(range(16)) AS i FROM gray_fx))"


def _raw(d):
    """The vectors as images of four by four pixels with alpha."""
    data = F.unhex(F.array_join(F.transform("embedding", lambda v: F.when(v > 0, "C8").otherwise("0A")), ""))
    return d.select("id", F.lit(4).alias("width"), F.lit(4).alias("height"), F.lit(4).alias("channels"), data.alias("data"))


@query("gray_fx", f""", {PIXELS}, k AS (SELECT id, lower(printf('%02x%02x%02x%02x', b[3], b[2], b[1], b[4])) AS rgba, sum((x = 0)::INT + (x = 3)::INT + (y = 0)::INT + (y = 3)::INT) AS n FROM p GROUP BY 1, 2)
  SELECT id, rgba FROM (SELECT id, rgba, row_number() OVER (PARTITION BY id ORDER BY n DESC, rgba) AS r FROM k) WHERE r = 1""")
def a8_edge_colors_of_images(d):
    return P.edge_colors(_raw(d))


@query("gray_fx", f""", {PIXELS}, g AS (SELECT id, y, sum(round_even(0.114::DOUBLE * b[1] + 0.587::DOUBLE * b[2] + 0.299::DOUBLE * b[3], 0)) AS s FROM p GROUP BY 1, 2)
  SELECT id, coalesce(min(y) FILTER (s > 400), 0)::INT AS top, coalesce(max(y) FILTER (s > 400), 3)::INT AS bottom FROM g GROUP BY 1""")
def a9_row_bounds_of_images(d):
    return P.row_bounds(_raw(d), 400)


@query("leaf_fx", """SELECT id, (SELECT min(r) FROM (SELECT DISTINCT rel_dir AS r FROM leaf_fx) WHERE l.rel_dir = r OR starts_with(l.rel_dir, r || '/')) AS grp FROM leaf_fx l""")
def d3_leaf_groups(d):
    return D.leaf_groups(d).select("id", "grp")


@query("leaf_fx", _greedy("SELECT id, (SELECT min(r) FROM (SELECT DISTINCT rel_dir AS r FROM leaf_fx) WHERE l.rel_dir = r OR starts_with(l.rel_dir, r || '/')) AS grp, vec FROM leaf_fx l"))
def d3_near_duplicates_by_leaf(d):
    from framewright.plans.session import with_checkpoints

    with_checkpoints(d.sparkSession)
    return D.near_duplicates_by_leaf(d, 0.25).select("id", "grp", "status", "has_duplicates")


@query("ids_fx", f""", p AS (SELECT id, row_number() OVER (ORDER BY floor({_u("'3|' || id")} * 4096), id) AS rn, count(*) OVER () AS m FROM ids_fx),
  k AS (SELECT k, floor({_u("'3|a|' || k")} * m) + 1 AS i, floor({_u("'3|b|' || k")} * m) + 1 AS j FROM (SELECT unnest(range(2064)) AS k) CROSS JOIN (SELECT DISTINCT m FROM p)),
  f AS (SELECT i, j, min(k) AS k FROM k GROUP BY 1, 2 ORDER BY 3 LIMIT 1000) SELECT a.id AS a, b.id AS b FROM f JOIN p a ON a.rn = i JOIN p b ON b.rn = j""")
def d5_sample_unique_pairs(d):
    return A.sample_unique_pairs(d, 1000, 3)


@query("videos_fx", """SELECT video_idx, frame, printf('f_%08d.png', video_idx * 1000000 + frame) AS name FROM (SELECT video_idx, floor(i * (frame_count - 1) / (CASE WHEN n > 1 THEN n - 1 ELSE 1 END)::DOUBLE)::BIGINT AS frame
  FROM (SELECT *, unnest(range(n)) AS i FROM (SELECT *, floor(frame_count / fps * 40 / 60)::INT AS n FROM (SELECT * FROM videos_fx WHERE fps > 0 AND frame_count > 0))))""")
def r2_frame_plan_legacy(d):
    return A.frame_plan_legacy(d)


@query("feeds_fx", "SELECT feed, start + i AS seq, 'http://x/' || (start + i) || '.jpg' AS url, printf('batch_%02d', i // 100) AS folder FROM (SELECT feed, start, unnest(range(total)) AS i FROM feeds_fx)")
def r3_fetch_plan(d):
    return A.fetch_plan(d, "http://x/{}.jpg", 100)


@query("captions_fx", "SELECT id, CAST(length(text) AS BIGINT) AS score FROM captions_fx WHERE text IS NOT NULL")
def u1_score_batches(d):
    return A.score_batches(d.filter("text is not null"), lambda f: f[["id"]].assign(score=f["text"].str.len()), "id long, score long")


@query("captions_fx", "SELECT id, CAST(length(text) AS BIGINT) AS score FROM captions_fx WHERE text IS NOT NULL")
def u1_score_resumable(d):
    """Scored in two runs; the second finds the first one's rows and scores the rest."""
    def setup():
        return lambda f: f[["id"]].assign(score=f["text"].str.len())

    rows, out = d.filter("text is not null"), scratch(d.sparkSession, "u1")
    H.score_resumable(rows.filter("id % 3 = 0"), setup, "id long, score long", out, chunks=4)
    return H.score_resumable(rows, setup, "id long, score long", out, chunks=4)


@query("captions_fx", "SELECT id, k AS key, contains(text, p) AS hit FROM captions_fx CROSS JOIN (VALUES ('the', 'en'), ('der', 'de')) v(p, k) WHERE text IS NOT NULL")
def u2_score_prompts(d):
    def hit(f):
        return f[["id", "key"]].assign(hit=[p in t for p, t in zip(f["prompt"], f["text"], strict=True)])

    return A.score_prompts(d.filter("text is not null"), [("the", "en"), ("der", "de")], hit, "id long, key string, hit boolean")


def st1_stream_unseen(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    out = scratch(spark, "st1")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parquet*")
    U.stream_pending(U.stream_unseen(stream.select("user_id"), "user_id"), out, f"{out}-state").awaitTermination()
    return spark.read.parquet(out)


QUERIES["st1_stream_unseen"] = st1_stream_unseen
SQL["st1_stream_unseen"] = "SELECT DISTINCT user_id FROM events"


def st1_unseen_by_log(spark, sf_dir):
    """Events in three batches, the second one twice as after a failure; each user's first event of its first batch, by a log of users."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.concat(c("user_id").cast("string"), F.when(c("event_id") % 2 == 0, "\n").otherwise("")).alias("who"))
    out, log = scratch(spark, "st1-rows"), scratch(spark, "st1-log")
    for number in (0, 1, 1, 2):
        if number == 2:
            U.compact_log(spark, log, 2)
        U.take_unseen(events.filter(c("event_id") % 3 == number), number, "who", ["event_id"], log, out)
    return spark.read.schema("event_id long, who string, batch int").parquet(out)


QUERIES["st1_unseen_by_log"] = st1_unseen_by_log
SQL["st1_unseen_by_log"] = "SELECT event_id, CAST(user_id AS VARCHAR) AS who, CAST(event_id % 3 AS INT) AS batch FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3, event_id) AS k FROM events) WHERE k = 1"


def st2_stream_pending(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    out = scratch(spark, "st2")
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(orders.schema).parquet(f"{sf_dir}/orders.parquet*")
        U.stream_pending(stream.select("o_orderkey", "o_custkey"), out, f"{out}-state").awaitTermination()
    return spark.read.parquet(out)


QUERIES["st2_stream_pending"] = st2_stream_pending
SQL["st2_stream_pending"] = "SELECT o_orderkey, o_custkey FROM orders"


@query("images_fx", "SELECT id, filename, split_part(rel_dir, '/', 1) AS folder FROM images_fx")
def s6_write_training_set(d):
    out = scratch(d.sparkSession, "s6")
    S.write_training_set(d.select("id", "filename", F.split_part("rel_dir", F.lit("/"), F.lit(1)).alias("folder")), out)
    return d.sparkSession.read.schema("id long, filename string, folder string").parquet(out)


@query("captions_fx", """SELECT (row_number() OVER (ORDER BY rel_dir, stem, id) - 1) // 100 + 1 AS file_no, '--prompt "' || """ + _strip("replace(replace(text, chr(10), ' '), chr(13), ' ')") + """ || ', " --negative_prompt ""' AS line FROM captions_fx WHERE text IS NOT NULL""")
def s7_write_prompt_files(d):
    out = scratch(d.sparkSession, "s7")
    S.write_prompt_files(A.chunk_prompts(d.filter("text is not null"), 100, F.translate("text", "\n\r", "  ")), out)
    return d.sparkSession.read.schema("value string, file_no long").text(out).select("file_no", c("value").alias("line"))


@query("chain_fx", """, g AS (SELECT *, r - row_number() OVER (PARTITION BY o_custkey ORDER BY r) AS run FROM chain_fx), h AS (SELECT *, min(r) OVER (PARTITION BY o_custkey, run) AS low FROM g),
  p AS (SELECT *, CASE WHEN o_custkey % 50 = 2 AND r > 1 THEN 2 ELSE low END AS head FROM h), z AS (SELECT o_custkey AS c, r AS hr, url AS source FROM chain_fx)
  SELECT url, CASE WHEN o_custkey % 50 <> 1 THEN source END AS source, CASE WHEN o_custkey % 50 <> 1 THEN r - head END AS page_no,
    CASE WHEN o_custkey % 50 = 1 THEN 'cyclic' WHEN head = 2 AND o_custkey % 50 = 2 THEN 'merged' WHEN head = 1 THEN 'ok' ELSE 'broken' END AS status FROM p JOIN z ON c = o_custkey AND hr = head""")
def s5_page_order(pages):
    """Customers' orders as chains of pages: some lack pages, some end at their first or second page."""
    return page_order(pages, starts=pages.filter("r = 1").select("url"))


def s8_json_values_to_lines(spark, sf_dir):
    return S.json_values_to_lines(spark.read.parquet(f"{sf_dir}/events.parquet"), "props")


QUERIES["s8_json_values_to_lines"] = s8_json_values_to_lines
SQL["s8_json_values_to_lines"] = "SELECT json_extract_string(props, unnest(json_keys(props))) AS line FROM events"


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
