"""Curation of media metadata, table checks and text functions."""

from pyspark.sql import functions as F

from palaver.functions import text as tx
from palaver.functions.draws import draw, seeded_uuid
from palaver.operators import curate as c
from palaver.plans import profile as plans
from registry.base import SEED, messages, query, sql_draw, table

EXTENSIONS = [".jpg", ".png", ".svg", ".gif", ".jpeg"]
_EXT_SQL = "(['.jpg', '.png', '.svg', '.gif', '.jpeg'])"


def media(spark, sf_dir):
    """``pages`` as image metadata: title, size, type and category."""
    page = F.col("page_id")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("page_title"))
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]),
                       (F.pmod(draw(SEED, "ext", page), F.lit(5)) + 1).cast("int"))
    mime = F.when(ext == ".svg", "image/svg+xml").when(ext == ".gif", "image/gif").when(
        ext == ".png", "image/png").otherwise("image/jpeg")
    site = F.regexp_extract("url", "^http://([^/]*)", 1)
    return pages.select(
        "page_id", F.concat("page_title", ext).alias("title"), "url",
        (F.lit(100) + F.pmod(draw(SEED, "w", page), F.lit(1900))).alias("width"),
        (F.lit(100) + F.pmod(draw(SEED, "h", page), F.lit(1400))).alias("height"),
        mime.alias("mime_type"), site.alias("site"),
        F.concat(F.lit("cat"), F.pmod(draw(SEED, "cat", page), F.lit(7))).alias("category"),
        F.pmod(draw(SEED, "cat", page), F.lit(7)).alias("category_order"))


MEDIA_CTE = f"""media0 AS (
  SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS page_title,
         {_EXT_SQL}[({sql_draw('ext', 'page_id')} % 5 + 1)] AS ext FROM pages),
media AS (
  SELECT page_id, page_title || ext AS title, url,
         100 + {sql_draw('w', 'page_id')} % 1900 AS width,
         100 + {sql_draw('h', 'page_id')} % 1400 AS height,
         CASE ext WHEN '.svg' THEN 'image/svg+xml' WHEN '.gif' THEN 'image/gif'
              WHEN '.png' THEN 'image/png' ELSE 'image/jpeg' END AS mime_type,
         regexp_extract(url, '^http://([^/]*)', 1) AS site,
         'cat' || ({sql_draw('cat', 'page_id')} % 7) AS category,
         {sql_draw('cat', 'page_id')} % 7 AS category_order FROM media0)"""

_SKIP = "|".join(c.SKIP_KEYWORDS)


@query("media_filter", f"""WITH {MEDIA_CTE}
SELECT page_id, title, width, height, mime_type FROM media
WHERE NOT regexp_matches(lower(title), '\\.svg|\\.gif|\\.tif')
  AND NOT regexp_matches(lower(title), '{_SKIP}')
  AND width >= 400 AND height >= 300 AND mime_type LIKE 'image/%'
  AND mime_type NOT IN ('image/svg+xml', 'image/gif')""")
def media_filter(spark, sf_dir):
    keep = c.usable_media(F.col("title"), F.col("width"), F.col("height"), F.col("mime_type"))
    return media(spark, sf_dir).filter(keep).select("page_id", "title", "width", "height",
                                                    "mime_type")


@query("dedupe_first", f"""WITH {MEDIA_CTE},
r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY category_order, page_id) AS rn
      FROM media)
SELECT site, page_id, category, title FROM r WHERE rn = 1""")
def dedupe_first(spark, sf_dir):
    rows = media(spark, sf_dir).select("site", "page_id", "category", "category_order", "title")
    return c.first_per_key(rows, "site", ["category_order", "page_id"]).drop("category_order")


@query("dedupe_events", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) AS rn
           FROM events)
SELECT user_id, event_id, event_type, value FROM r WHERE rn = 1""")
def dedupe_events(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return c.first_per_key(rows, "user_id", ["event_type", "event_id"])


@query("topic_cap", f"""WITH {MEDIA_CTE},
k AS (SELECT count(DISTINCT category) AS k FROM media),
r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY page_id) AS rn FROM media),
kept AS (SELECT * FROM r WHERE rn <= 40 // (SELECT k FROM k)),
spare AS (SELECT *, row_number() OVER (ORDER BY category_order, rn) AS sn FROM r
          WHERE rn > 40 // (SELECT k FROM k))
SELECT page_id, category FROM kept
UNION ALL SELECT page_id, category FROM spare WHERE sn <= 40 - (SELECT count(*) FROM kept)""")
def topic_cap(spark, sf_dir):
    rows = media(spark, sf_dir).select("page_id", "category", "category_order")
    return c.balanced_cap(rows, "category", "category_order", "page_id", 40).select(
        "page_id", "category")


@query("media_profile", f"""WITH {MEDIA_CTE}
SELECT category AS value, count(*) AS count,
       100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percentage,
       (SELECT count(DISTINCT site) FROM media) AS unique_items
FROM media GROUP BY category""")
def media_profile(spark, sf_dir):
    items, categories = plans.multimodal_profile(media(spark, sf_dir), "site", "category")
    return categories.withColumn("unique_items", items.scalar())


@query("strip_html", """
SELECT page_id, md5(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^[[:space:]]+|[[:space:]]+$', '', 'g')) AS text_md5,
       substr(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^[[:space:]]+|[[:space:]]+$', '', 'g'), 1, 500) AS description
FROM pages""")
def strip_html(spark, sf_dir):
    text = tx.strip_tags(F.col("html"))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.md5(text).alias("text_md5"), tx.preview(text, 500).alias("description"))


_STORED = """stored AS (
  SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '[]' WHEN doc_id % 7 = 0 THEN text
         WHEN doc_id % 11 = 0 THEN '[{"role":"user","role":"system","content":"x"}]'
         WHEN doc_id % 13 = 0 THEN '[{"role":"user"}] and more' WHEN doc_id % 17 = 0 THEN '[1]]'
         ELSE to_json([{'role': 'user', 'content': text}])::VARCHAR END AS messages
  FROM documents)"""


@query("json_validate", f"""WITH {_STORED}
SELECT doc_id, CASE WHEN NOT json_valid(messages) THEN 'invalid'
       WHEN json_type(messages) <> 'ARRAY' THEN 'not a list' ELSE 'empty' END AS problem
FROM stored WHERE NOT json_valid(messages) OR json_type(messages) <> 'ARRAY'
  OR json_array_length(messages) = 0""")
def json_validate(spark, sf_dir):
    good = F.to_json(F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))))
    stored = table(spark, sf_dir, "documents").select("doc_id", F.when(
        F.col("doc_id") % 5 == 0, "[]").when(F.col("doc_id") % 7 == 0, F.col("text"))
        .when(F.col("doc_id") % 11 == 0, '[{"role":"user","role":"system","content":"x"}]')
        .when(F.col("doc_id") % 13 == 0, '[{"role":"user"}] and more')
        .when(F.col("doc_id") % 17 == 0, "[1]]")
        .otherwise(good).alias("messages"))
    return c.invalid_messages(stored).select("doc_id", "problem")


_JOINED = ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), (
    "n_chars", "bigint"), ("quality", "int"), ("toxic", "int")


@query("null_profile", "WITH j AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l "
       "USING (doc_id))\n" + "\nUNION ALL ".join(
           f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS rows, count({c}) AS non_null, "
           f"count(*) - count({c}) AS nulls FROM j" for c, t in _JOINED))
def null_profile(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return plans.column_inspection(table(spark, sf_dir, "documents").join(labels, "doc_id", "left"))


@query("text_functions", rf"""
WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')
             AS ws FROM documents)
SELECT doc_id, length(text) AS n_chars, length(text) // 4 AS n_tokens,
       greatest(1, length(text) // 4) AS out_tokens, len(ws)::BIGINT AS n_words,
       substr(text, 1, 80) AS preview,
       md5(replace(regexp_replace(text, '^[[:space:]]+|[[:space:]]+$', '', 'g'), E'\n', ' ')) AS one_line_md5,
       ((length(text) - length(replace(text, 'en', ''))) // 2)::BIGINT AS n_en,
       '0x' || lpad(upper(to_hex(doc_id * 7919)), 6, '0') AS code,
       contains(lower(text), 'icon') OR contains(lower(text), 'ent') AS has_key
FROM w""")
def text_functions(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.chars(t).alias("n_chars"), tx.tokens(tx.chars(t)).alias("n_tokens"),
        tx.output_tokens(t).alias("out_tokens"), tx.word_count(t).alias("n_words"),
        tx.preview(t, 80).alias("preview"), F.md5(tx.one_line(t)).alias("one_line_md5"),
        tx.occurrences(t, F.lit("en")).alias("n_en"),
        tx.hex_code(F.col("doc_id") * 7919).alias("code"),
        tx.contains_any(t, ["icon", "ent"]).alias("has_key"))


@query("seeded_ids", """
WITH h AS (SELECT DISTINCT conv_id, md5(concat_ws('|', '42', conv_id, 'id')) AS h FROM conversations),
m AS (SELECT conv_id, substr(h, 1, 12) || '4' || substr(h, 14, 3)
        || substr('89ab', (('0x' || substr(h, 17, 1))::BIGINT % 4 + 1)::BIGINT, 1)
        || substr(h, 18, 15) AS x FROM h)
SELECT conv_id, substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-' || substr(x, 13, 4) || '-'
       || substr(x, 17, 4) || '-' || substr(x, 21, 12) AS conversation_id FROM m""")
def seeded_ids(spark, sf_dir):
    ids = messages(spark, sf_dir).select("conv_id").distinct()
    return ids.select("conv_id", seeded_uuid(SEED, "id", F.col("conv_id")).alias("conversation_id"))


@query("sentence_cut", rf"""
WITH w AS (SELECT doc_id, array_to_string(list_slice(list_filter(
             regexp_split_to_array(text, '\s+'), lambda w: w <> ''), 1, 40), ' ') AS t
           FROM documents),
p AS (SELECT *, instr(reverse(t), '.') AS i FROM w)
SELECT doc_id, CASE WHEN i > 0 AND length(t) - i > 0.7 * length(t)
                    THEN substr(t, 1, length(t) - i + 1) ELSE t END AS cut FROM p""")
def sentence_cut(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.cut_at_sentence(F.col("text"), F.lit(40)).alias("cut"))


@query("metadata_fields", rf"""WITH {MEDIA_CTE},
t AS (SELECT *, list_filter(regexp_split_to_array(replace(title, '&', ' '), '\s+'), lambda w: w <> '')
        AS names FROM media)
SELECT page_id, list_last(string_split(url, '.com/')) AS tail,
       array_to_string(names[1:3], ', ') || CASE WHEN len(names) > 3 THEN ' et al.' ELSE '' END
         AS authors,
       replace(regexp_replace(title, '^[[:space:]]+|[[:space:]]+$', '', 'g'), E'\n', ' ') AS title, printf('%.3f', width / 7.0::DOUBLE) AS ratio,
       page_id::VARCHAR || 'px' AS label
FROM t""")
def metadata_fields(spark, sf_dir):
    names = tx.words(F.replace(F.col("title"), F.lit("&"), F.lit(" ")))
    return media(spark, sf_dir).select(
        "page_id", tx.url_tail(F.col("url"), r"\.com/").alias("tail"),
        tx.author_list(names).alias("authors"), tx.one_line(F.col("title")).alias("title"),
        F.format_string("%.3f", F.col("width") / F.lit(7.0)).alias("ratio"),
        F.format_string("%dpx", F.col("page_id")).alias("label"))


@query("event_days", """
SELECT strftime(ts, '%Y%m%d') AS day, count(*) AS count FROM events GROUP BY ALL""")
def event_days(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(
        tx.utc_stamp(F.col("ts")).alias("day")).agg(F.count(F.lit(1)).alias("count"))
