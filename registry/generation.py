"""Synthetic conversations, grown from the given tables.

One conversation is generated per conversation id of the message table; word
pools are the words of all its messages, templates and extensions come from other
tables, so the work and the data both come from the tables.
"""

from pyspark.sql import functions as F

from palaver.functions import synth as y
from palaver.functions.draws import draw, pick, uniform_int
from palaver.functions.text import words
from palaver.operators import generate as g
from palaver.operators.assemble import conversation_rows
from registry.base import (SEED, TOPIC_WEIGHTS, messages, query, sql_choice, sql_draw, sql_unit,
                           table)

BUCKETS = ((100, 2, 5), (150, 6, 15), (150, 16, 30), (100, 31, 50))
REPEAT_WEIGHTS = {k: 0.2 for k in y.REPEAT_BOUNDS}
RANDOM_WEIGHTS = {k: 0.2 for k in y.USER_BOUNDS}
FREE = ((150, 2, 4), (200, 5, 8), (150, 9, 15))


def _tasks(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _ids(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id").distinct()


_IDS_SQL = "ids AS (SELECT DISTINCT conv_id FROM conversations)"


def _upper(text: str) -> str:
    """Upper case as Unicode has it: one letter becomes two, which DuckDB keeps as one."""
    return f"replace(upper({text}), 'ẞ', 'SS')"


def _turn_case(bucket: str) -> str:
    draw = sql_draw("turns", "conv_id")
    return (f"CASE {bucket} WHEN 0 THEN 2 + {draw} % 4 WHEN 1 THEN 6 + {draw} % 10 "
            f"WHEN 2 THEN 16 + {draw} % 15 ELSE 31 + {draw} % 20 END")


@query("gen_turns", f"""WITH {_IDS_SQL},
p AS (SELECT conv_id, row_number() OVER (ORDER BY {sql_draw('bucket', 'conv_id')}, conv_id) AS k,
             count(*) OVER () AS n FROM ids),
b AS (SELECT conv_id, CASE WHEN k <= n * 100 // 500 THEN 0 WHEN k <= n * 250 // 500 THEN 1
             WHEN k <= n * 400 // 500 THEN 2 ELSE 3 END AS b FROM p)
SELECT conv_id, {sql_choice(sql_unit('topic', 'conv_id'), TOPIC_WEIGHTS)} AS topic,
       ({_turn_case('b')})::BIGINT AS num_turns FROM b""")
def gen_turns(spark, sf_dir):
    ids = g.with_topic(_ids(spark, sf_dir), TOPIC_WEIGHTS, SEED)
    return g.allocated_turns(ids, BUCKETS, SEED)


@query("gen_free_turns", f"""WITH {_IDS_SQL}
SELECT conv_id, (CASE {sql_draw('bucket', 'conv_id')} % 3
   WHEN 0 THEN 2 + {sql_draw('turns', 'conv_id')} % 3 WHEN 1 THEN 5 + {sql_draw('turns', 'conv_id')} % 4
   ELSE 9 + {sql_draw('turns', 'conv_id')} % 7 END)::BIGINT AS num_turns FROM ids""")
def gen_free_turns(spark, sf_dir):
    return g.free_bucket_turns(_ids(spark, sf_dir), FREE, SEED)


def _phase_sql(first: int, second: int) -> str:
    unit = sql_unit("length", "conv_id", "turn_no")
    e, mi, la = (sql_choice(unit, g.LENGTH_WEIGHTS[p]) for p in ("early", "middle", "late"))
    t = sql_draw("target", "conv_id", "turn_no")
    return f"""turns AS (SELECT conv_id, num_turns, unnest(range(num_turns)) AS turn_no FROM plan),
classed AS (SELECT *, CASE WHEN turn_no < {first} THEN {e} WHEN turn_no < {second} THEN {mi}
            ELSE {la} END AS length_class FROM turns),
sized AS (SELECT *, (CASE length_class WHEN 'short' THEN 20 + {t} % 61 WHEN 'medium' THEN 80 + {t} % 171
          ELSE 250 + {t} % 351 END)::BIGINT AS target_words FROM classed)"""


_UNIFORM_PLAN = f"""{_IDS_SQL},
plan AS (SELECT conv_id, (2 + {sql_draw('turns', 'conv_id')} % 24)::BIGINT AS num_turns FROM ids)"""


@query("gen_lengths", f"""WITH {_UNIFORM_PLAN}, {_phase_sql(5, 20)}
SELECT conv_id, turn_no, length_class, target_words FROM sized""")
def gen_lengths(spark, sf_dir):
    turns = g.turn_rows(g.uniform_turns(_ids(spark, sf_dir), 2, 25, SEED))
    return g.with_target_words(turns, SEED).select("conv_id", "turn_no", "length_class",
                                                   "target_words")


def _pools(spark, sf_dir):
    """The words of all messages of every conversation, in order."""
    said = F.coalesce(words(F.col("text")), F.array().cast("array<string>"))
    told = messages(spark, sf_dir).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", said.alias("w")))).alias("m"))
    return told.select("conv_id", F.flatten(F.transform("m", lambda x: x["w"])).alias("pool"))


_POOL_SQL = r"""pools AS (SELECT conv_id, flatten(list(list_filter(regexp_split_to_array(text, '\s+'),
   lambda w: w <> '') ORDER BY turn)) AS pool FROM conversations GROUP BY conv_id)"""


def _repeat_turns(spark, sf_dir, most=9):
    """Turns with a base of the style: a drawn word, its first letters, or 2 to 9 words from there on."""
    plan = g.uniform_turns(g.with_topic(_pools(spark, sf_dir), REPEAT_WEIGHTS, SEED, "style"),
                           2, most, SEED)
    at = (F.pmod(draw(SEED, "base", F.col("conv_id")), F.size("pool")) + 1).cast("int")
    size = uniform_int(draw(SEED, "size", F.col("conv_id")), 2, 9).cast("int")
    word = F.try_element_at("pool", at)
    base = F.when(F.col("style") == "single_word", word).when(
        F.col("style") == "letter_repeat", F.substring(word, 1, 3)).otherwise(
        F.array_join(F.slice("pool", at, size), " "))
    return g.turn_rows(plan.withColumn("base", base).drop("pool"), _tasks(spark))


def _repeat_text():
    d = y.Draws(SEED, (F.col("conv_id"), F.col("turn_no")))
    return y.repeated_text(F.col("style"), F.col("base"), d)


_R = sql_draw("repeat", "conv_id", "turn_no")


def _repeat_cte(most: int) -> str:
    return f"""{_POOL_SQL},
rp AS (SELECT conv_id, pool, (2 + {sql_draw('turns', 'conv_id')} % {most - 1})::BIGINT AS num_turns,
        {sql_choice(sql_unit('style', 'conv_id'), REPEAT_WEIGHTS)} AS style FROM pools),
rs AS (SELECT *, ({sql_draw('base', 'conv_id')} % len(pool) + 1)::BIGINT AS at_,
        (2 + {sql_draw('size', 'conv_id')} % 8)::BIGINT AS size_ FROM rp),
rb AS (SELECT conv_id, num_turns, style, CASE style WHEN 'single_word' THEN pool[at_]
        WHEN 'letter_repeat' THEN substr(pool[at_], 1, 3)
        ELSE array_to_string(pool[at_:at_ + size_ - 1], ' ') END AS base FROM rs),
rt AS (SELECT *, unnest(range(num_turns)) AS turn_no FROM rb),
rn AS (SELECT *, (CASE style WHEN 'single_word' THEN 5 + {_R} % 96 WHEN 'phrase_repeat' THEN 3 + {_R} % 48
        WHEN 'counting_repeat' THEN 5 + {_R} % 26 WHEN 'letter_repeat' THEN 50 + {_R} % 451
        ELSE 2 + {_R} % 19 END) AS k FROM rt),
ru AS (SELECT *, CASE WHEN style = 'letter_repeat'
        THEN substr(repeat(base, k // length(base) + 1), 1, k)
        ELSE array_to_string(list_transform(range(k), lambda i: base), ' ') END AS user_text FROM rn)"""


@query("gen_repeat", f"""WITH {_repeat_cte(9)}
SELECT conv_id, turn_no, style, length(user_text) AS n_chars, md5(user_text) AS text_md5 FROM ru""")
def gen_repeat(spark, sf_dir):
    rows = _repeat_turns(spark, sf_dir).withColumn("user_text", _repeat_text())
    return rows.select("conv_id", "turn_no", "style", F.length("user_text").cast("bigint")
                       .alias("n_chars"), F.md5("user_text").alias("text_md5"))


def _random_pools():
    pool = F.col("pool")
    return {name: pool for name in ("words", "lorem", "subjects", "adverbs", "verbs", "objects",
                                    "phrases", "fillers")}


def _random_turns(spark, sf_dir, most):
    plan = g.with_topic(_pools(spark, sf_dir), RANDOM_WEIGHTS, SEED, "style")
    return g.turn_rows(g.uniform_turns(plan, 2, most, SEED), _tasks(spark))


def _pk(salt: str, *idx: str) -> str:
    return f"pool[({sql_draw(salt, 'conv_id', 'turn_no', *idx)} % len(pool) + 1)::BIGINT]"


def _rd(salt: str, *idx: str) -> str:
    return sql_draw(salt, "conv_id", "turn_no", *idx)


def _rn(salt: str, a: int, b: int, c: int, e: int) -> str:
    low = f"(CASE WHEN turn_no < 3 THEN {a} ELSE {b} END)"
    high = f"(CASE WHEN turn_no < 5 THEN {c} ELSE {e} END)"
    return f"({low} + {_rd(salt)} % ({high} - {low} + 1))"


def _run_sql(alphabet: str, salt: str, least: int, most: int) -> str:
    quoted = alphabet.replace("'", "''")
    return (f"array_to_string(list_transform(range(({least} + {_rd(salt + '_n', 'i')} % "
            f"{most - least + 1})::BIGINT), lambda j: substr('{quoted}', "
            f"({_rd(salt, 'i', 'j')} % {len(alphabet)} + 1)::BIGINT, 1)), '')")


_REAL = f"(-1000.0::DOUBLE + 2000.0::DOUBLE * {sql_unit('number', 'conv_id', 'turn_no', 'i')})"
_NUMBER = f"""CASE {_rd('format', 'i')} % 4 WHEN 0 THEN ({_rd('number', 'i')} % 10000)::VARCHAR
  WHEN 1 THEN CASE {_rd('digits', 'i')} % 6 """ + " ".join(
    f"WHEN {k - 1} THEN printf('%.{k}f', {_REAL})" for k in range(1, 7)) + f""" END
  WHEN 2 THEN '0x' || lpad(upper(to_hex({_rd('number', 'i')} % 16777216)), 6, '0')
  ELSE (100000 + {_rd('number', 'i')} % 99900000)::VARCHAR END"""
_KIND = sql_choice(sql_unit("kind", "conv_id", "turn_no", "i"), y.MIXED_WEIGHTS)

_TURNS_SQL = f"""WITH RECURSIVE {_POOL_SQL},
rp AS (SELECT conv_id, pool, (2 + {sql_draw('turns', 'conv_id')} % 11)::BIGINT AS num_turns,
        {sql_choice(sql_unit('style', 'conv_id'), RANDOM_WEIGHTS)} AS style FROM pools),
rt AS (SELECT *, unnest(range(num_turns)) AS turn_no FROM rp)"""

# Every character appends to what came before it; a break draws the next chunk size.
_CHARS_SQL = f"""
tk AS (SELECT conv_id, turn_no, style, {_rn('chars', 10, 20, 80, 200)} AS n, 0::BIGINT AS i, '' AS t,
              4 + {_rd('chunk')} % 9 AS chunk FROM rt WHERE style = 'random_chars'
       UNION ALL
       SELECT conv_id, turn_no, style, n, i + 1,
              t || CASE WHEN i > 0 AND i % chunk = 0 THEN ' ' ELSE '' END
              || substr('{y.ALPHANUMERIC}', ({_rd('char', 'i')} % {len(y.ALPHANUMERIC)} + 1)::BIGINT, 1),
              CASE WHEN i > 0 AND i % chunk = 0 THEN 4 + {_rd('chunk', 'i')} % 9 ELSE chunk END
       FROM tk WHERE i < n),
tc AS (SELECT conv_id, turn_no, style, t FROM tk WHERE i = n)"""

RANDOM_SQL = f"""{_TURNS_SQL},{_CHARS_SQL},
tw AS (SELECT conv_id, turn_no, style, array_to_string(list_transform(
         range({_rn('words', 3, 5, 15, 30)}), lambda i: {_pk('word', 'i')}), ' ') AS t
       FROM rt WHERE style = 'random_words'),
ts AS (SELECT conv_id, turn_no, style, array_to_string(list_transform(
         range({_rn('sentences', 1, 2, 3, 6)}), lambda i: {_pk('subject', 'i')}
         || CASE WHEN {_rd('has_adverb', 'i')}::DOUBLE / 4294967296.0::DOUBLE < 0.4
            THEN ' ' || {_pk('adverb', 'i')} ELSE '' END
         || ' ' || {_pk('verb', 'i')} || ' ' || {_pk('object', 'i')}
         || CASE WHEN {_rd('has_phrase', 'i')}::DOUBLE / 4294967296.0::DOUBLE < 0.5
            THEN ' ' || {_pk('phrase', 'i')} ELSE '' END || '.'), ' ') AS t
       FROM rt WHERE style = 'random_sentences'),
tm AS (SELECT conv_id, turn_no, style, array_to_string(list_transform(
         range({_rn('parts', 5, 8, 15, 25)}), lambda i: CASE {_KIND}
           WHEN 'word' THEN {_pk('word', 'i')} WHEN 'number' THEN {_NUMBER}
           WHEN 'symbol' THEN {_run_sql(y.SYMBOLS, 'symbol', 1, 4)}
           ELSE {_run_sql(y.ALPHANUMERIC, 'run', 3, 10)} END), ' ') AS t
       FROM rt WHERE style = 'random_mixed'),
l0 AS (SELECT *, {_rn('words', 10, 15, 30, 60)} AS n FROM rt WHERE style = 'random_lorem'),
l1 AS (SELECT *, unnest(range(ceil(n / 4.0)::BIGINT)) AS s FROM l0),
l2 AS (SELECT *, 4 + {_rd('length', 's')} % 9 AS len FROM l1),
l3 AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY conv_id, turn_no ORDER BY s
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM l2),
l4 AS (SELECT *, least(len, n - start) AS size FROM l3 WHERE start < n),
l5 AS (SELECT *, CASE WHEN size > 5 AND {_rd('has_comma', 's')}::DOUBLE / 4294967296.0::DOUBLE < 0.4
         THEN 2 + {_rd('comma', 's')} % (size - 3) ELSE -1 END AS comma FROM l4),
l6 AS (SELECT *, unnest(range(size::BIGINT)) AS q FROM l5),
l7 AS (SELECT *, pool[({sql_draw('word', 'conv_id', 'turn_no', '(start + q)::BIGINT')} % len(pool) + 1)::BIGINT]
         AS w FROM l6),
l8 AS (SELECT conv_id, turn_no, style, s, string_agg(CASE WHEN q = 0
         THEN {_upper('substr(w, 1, 1)')} || lower(substr(w, 2)) ELSE w END
         || CASE WHEN q = comma THEN ',' ELSE '' END, ' ' ORDER BY q) || '.' AS x
       FROM l7 GROUP BY conv_id, turn_no, style, s),
tl AS (SELECT conv_id, turn_no, style, string_agg(x, ' ' ORDER BY s) AS t FROM l8
       GROUP BY conv_id, turn_no, style)
SELECT conv_id, turn_no, style, length(t) AS n_chars, md5(t) AS text_md5
FROM (SELECT * FROM tw UNION ALL SELECT * FROM ts UNION ALL SELECT * FROM tm
      UNION ALL SELECT * FROM tl UNION ALL SELECT * FROM tc)"""


@query("gen_random", RANDOM_SQL)
def gen_random(spark, sf_dir):
    d = y.Draws(SEED, (F.col("conv_id"), F.col("turn_no")))
    rows = _random_turns(spark, sf_dir, 12)
    text = y.random_text(F.col("style"), _random_pools(), d, y.user_bounds(F.col("turn_no")))
    return rows.withColumn("t", text).select(
        "conv_id", "turn_no", "style", F.length("t").cast("bigint").alias("n_chars"),
        F.md5("t").alias("text_md5"))


@query("gen_random_chars", f"""{_TURNS_SQL},{_CHARS_SQL}
SELECT conv_id, turn_no, t AS text FROM tc""")
def gen_random_chars(spark, sf_dir):
    d = y.Draws(SEED, (F.col("conv_id"), F.col("turn_no")))
    low, high = y.user_bounds(F.col("turn_no"))["random_chars"]
    rows = _random_turns(spark, sf_dir, 12).filter("style = 'random_chars'")
    return rows.select("conv_id", "turn_no", y.random_characters(d, low, high).alias("text"))


def _reply_sql() -> str:
    """Blocks one after the other until the target is reached, each step from the draws of its number."""
    def d(salt, *idx):
        return sql_draw(salt, "conv_id", "turn_no", "blk", *idx)

    def u(salt, *idx):
        return sql_unit(salt, "conv_id", "turn_no", "blk", *idx)

    def pk(salt, *idx):
        return f"pool[({d(salt, *idx)} % len(pool) + 1)::BIGINT]"

    def between(low, high, salt, *idx):
        return f"({low} + {d(salt, *idx)} % {high - low + 1})::BIGINT"

    def joined(n, var, item, sep="' '"):
        return f"array_to_string(list_transform(range({n}), lambda {var}: {item}), {sep})"

    def run(alphabet, salt, low, high):
        quoted = alphabet.replace("'", "''")
        return joined(between(low, high, salt + "_n", "k"), "j",
                      f"substr('{quoted}', ({d(salt, 'k', 'j')} % {len(alphabet)} + 1)::BIGINT, 1)", "''")

    bounds = y.ECHO_BOUNDS
    words_ = joined(between(*bounds["random_words"], "words"), "w", pk("word", "w"))
    state = "{'t': '', 'k': " + between(4, 12, "chunk") + "}"
    broken = "x.k > 0 AND x.k % acc.k = 0"
    characters = f"""list_reduce(list_prepend({state}, list_transform(range({between(*bounds["random_chars"], "chars")}),
        lambda k: {{'t': '', 'k': k}})), lambda acc, x: {{'t': acc.t || CASE WHEN {broken} THEN ' ' ELSE '' END
        || substr('{y.ALPHANUMERIC}', ({d("char", "x.k")} % {len(y.ALPHANUMERIC)} + 1)::BIGINT, 1),
        'k': CASE WHEN {broken} THEN {between(4, 12, "chunk", "x.k")} ELSE acc.k END}}).t"""
    sentences = joined(between(*bounds["random_sentences"], "sentences"), "k", f"""{pk('subject', 'k')}
        || CASE WHEN {u('has_adverb', 'k')} < 0.4 THEN ' ' || {pk('adverb', 'k')} ELSE '' END
        || ' ' || {pk('verb', 'k')} || ' ' || {pk('object', 'k')}
        || CASE WHEN {u('has_phrase', 'k')} < 0.5 THEN ' ' || {pk('phrase', 'k')} ELSE '' END || '.'""")
    real = f"(-1000.0::DOUBLE + 2000.0::DOUBLE * {u('number', 'k')})"
    shown = " ".join(f"WHEN {n - 1} THEN printf('%.{n}f', {real})" for n in range(1, 7))
    number = f"""CASE {d('format', 'k')} % 4 WHEN 0 THEN ({d('number', 'k')} % 10000)::VARCHAR
        WHEN 1 THEN CASE {d('digits', 'k')} % 6 {shown} END
        WHEN 2 THEN '0x' || lpad(upper(to_hex({d('number', 'k')} % 16777216)), 6, '0')
        ELSE (100000 + {d('number', 'k')} % 99900000)::VARCHAR END"""
    mixed = joined(between(*bounds["random_mixed"], "parts"), "k", f"""CASE
        {sql_choice(u('kind', 'k'), y.MIXED_WEIGHTS)} WHEN 'word' THEN {pk('word', 'k')}
        WHEN 'number' THEN {number} WHEN 'symbol' THEN {run(y.SYMBOLS, 'symbol', 1, 4)}
        ELSE {run(y.ALPHANUMERIC, 'run', 3, 10)} END""")
    n = between(*bounds["random_lorem"], "words")
    lengths = f"list_transform(range(ceil({n} / 4.0)::BIGINT), lambda s: {between(4, 12, 'length', 's')})"
    word = pk("word", "(x.start + q)::BIGINT")
    comma = f"CASE WHEN x.size > 5 AND {u('has_comma', 'x.s')} < 0.4 THEN 2 + {d('comma', 'x.s')} % (x.size - 3) ELSE -1 END"
    lorem = f"""array_to_string(list_transform(list_filter(list_transform(range(ceil({n} / 4.0)::BIGINT), lambda s: {{
        's': s, 'start': coalesce(list_sum(({lengths})[1:s]), 0)::BIGINT,
        'size': least(({lengths})[s + 1], {n} - coalesce(list_sum(({lengths})[1:s]), 0))::BIGINT}}),
        lambda x: x.size > 0), lambda x: {joined('x.size', 'q', f"""CASE WHEN q = 0
            THEN {_upper(f'substr({word}, 1, 1)')} || lower(substr({word}, 2)) ELSE {word} END
            || CASE WHEN q = {comma} THEN ',' ELSE '' END""")} || '.'), ' ')"""
    bullets = joined(between(3, 6, "items"), "j", "'- ' || " + joined(
        between(3, 8, "words", "j"), "w", pk("word", "j", "w")), "chr(10)")
    numbered = joined(between(2, 5, "points"), "j", f"(j + 1)::VARCHAR || '. ' || {pk('point', 'j')}", "chr(10)")
    count = "len(list_filter(regexp_split_to_array({0}, '\\s+'), lambda w: w <> ''))"
    return f"""{_TURNS_SQL},
plan AS (SELECT conv_id, num_turns FROM rp), {_phase_sql(5, 20)},
started AS (SELECT conv_id, turn_no, style, pool, target_words FROM rt JOIN sized USING (conv_id, turn_no)),
blocks AS (
  SELECT conv_id, turn_no, style, pool, target_words, 0::BIGINT AS blk, '' AS t, 0::BIGINT AS n FROM started
  UNION ALL
  SELECT conv_id, turn_no, style, pool, target_words, blk + 1,
         CASE WHEN blk = 0 THEN b ELSE t || chr(10) || chr(10) || b END,
         n + {count.format('b')} - CASE WHEN kind IN ('list', 'numbered')
             THEN len(string_split(b, chr(10))) ELSE 0 END
  FROM (SELECT *, CASE kind WHEN 'filler' THEN {pk('filler')} WHEN 'list' THEN {bullets}
          WHEN 'numbered' THEN {numbered} ELSE CASE style WHEN 'random_chars' THEN {characters}
            WHEN 'random_sentences' THEN {sentences} WHEN 'random_mixed' THEN {mixed}
            WHEN 'random_lorem' THEN {lorem} ELSE {words_} END END AS b
        FROM (SELECT *, {sql_choice(u('block'), y.BLOCK_WEIGHTS)} AS kind FROM blocks
              WHERE n < target_words AND blk < target_words))),
whole AS (SELECT conv_id, turn_no, any_value(style) AS style, any_value(target_words) AS target_words,
            arg_max(t, blk) AS t FROM blocks GROUP BY conv_id, turn_no),
counted AS (SELECT *, list_filter(regexp_split_to_array(t, '\\s+'), lambda w: w <> '') AS ws FROM whole),
short AS (SELECT *, array_to_string(ws[1:target_words], ' ') AS s FROM counted),
cut AS (SELECT *, CASE WHEN len(ws) > target_words * 1.3 THEN CASE WHEN strpos(reverse(s), '.') > 0
          AND length(s) - strpos(reverse(s), '.') > 0.7 * length(s)
          THEN substr(s, 1, length(s) - strpos(reverse(s), '.') + 1) ELSE s END ELSE t END AS reply FROM short)
SELECT conv_id, turn_no, style, target_words, length(reply) AS n_chars, md5(reply) AS reply_md5 FROM cut"""


@query("gen_random_reply", _reply_sql())
def gen_random_reply(spark, sf_dir):
    d = y.Draws(SEED, (F.col("conv_id"), F.col("turn_no")))
    rows = g.with_target_words(_random_turns(spark, sf_dir, 12), SEED)
    reply = y.random_reply(F.col("style"), _random_pools(), d, F.col("target_words"))
    return rows.withColumn("reply", reply).select(
        "conv_id", "turn_no", "style", "target_words", F.length("reply").cast("bigint").alias("n_chars"),
        F.md5("reply").alias("reply_md5"))


TEMPLATE = "About {title} at {url}: {word}, {word} and {missing}{word}."


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


def _media_turns(spark, sf_dir):
    plan = g.uniform_turns(_pools(spark, sf_dir), 2, 6, SEED)
    picked = g.pick_from_table(plan, _pages(spark, sf_dir), "page_id",
                               draw(SEED, "page", F.col("conv_id")), SEED)
    return g.by_turn_kind(g.turn_rows(picked, _tasks(spark)))


def _rendered():
    d = y.Draws(SEED, (F.col("conv_id"), F.col("turn_no")))
    template = F.when(F.col("kind") == "opener", F.lit(TEMPLATE)).otherwise(
        F.lit("And {word}, {unknown} what of {title}?"))
    return y.render(template, {"title": F.col("title"), "url": F.col("url")},
                    {"word": F.col("pool")}, d)


_MEDIA_CTE = f"""{_POOL_SQL},
pg AS (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
         row_number() OVER (ORDER BY {sql_draw('pool', 'page_id')}, page_id) AS no,
         count(*) OVER () AS k FROM pages),
mp AS (SELECT conv_id, pool, (2 + {sql_draw('turns', 'conv_id')} % 5)::BIGINT AS num_turns,
         {sql_draw('page', 'conv_id')} AS d FROM pools),
mj AS (SELECT mp.*, url, title FROM mp JOIN pg ON pg.no = mp.d % (SELECT count(*) FROM pages) + 1),
mt AS (SELECT *, unnest(range(num_turns)) AS turn_no FROM mj),
mu AS (SELECT *, regexp_replace(CASE WHEN turn_no = 0 THEN 'About ' || title || ' at ' || url || ': '
           || {_pk('word', '1')} || ', ' || {_pk('word', '2')} || ' and ' || {_pk('word', '3')} || '.'
         ELSE 'And ' || {_pk('word', '1')} || ',  what of ' || title || '?' END,
         '^[[:space:]]+|[[:space:]]+$', '', 'g') AS user_text FROM mt)"""


@query("gen_template", f"""WITH {_MEDIA_CTE}
SELECT conv_id, turn_no, user_text FROM mu""")
def gen_template(spark, sf_dir):
    return _media_turns(spark, sf_dir).select("conv_id", "turn_no", _rendered().alias("user_text"))


def _names(spark, sf_dir, name, key, value):
    """A column of a small table as one array, by key."""
    return table(spark, sf_dir, name).agg(F.transform(F.array_sort(F.collect_list(
        F.struct(key, value))), lambda x: x[value])).scalar()


def generated_messages(spark, sf_dir):
    """Repetitive chats: reply templates named after regions, extended by names of nations."""
    d = y.Draws(SEED, (F.col("conv_id"), F.col("turn_no")))
    turns = g.with_target_words(_repeat_turns(spark, sf_dir), SEED).withColumns(
        {"user_text": _repeat_text(), "regions": _names(spark, sf_dir, "region", "r_regionkey", "r_name"),
         "nations": _names(spark, sf_dir, "nation", "n_nationkey", "n_name")})
    template = F.concat(F.lit("In "), pick(d("template"), F.col("regions")),
                        F.lit(" they say {word} here: {count} times in {length} characters."))
    reply = y.repeat_reply(F.col("style"), template, F.col("base"), F.col("user_text"))
    reply = g.sized_reply(reply, F.col("target_words"), F.col("nations"), d)
    return g.chat_messages(turns, F.concat(F.lit("Style: "), F.col("style")), F.col("user_text"), reply)


_GEN_CTE = f"""{_repeat_cte(9)},
plan AS (SELECT conv_id, num_turns FROM rb), {_phase_sql(5, 20)},
names AS (SELECT (SELECT list(r_name ORDER BY r_regionkey) FROM region) AS regions,
            (SELECT list(n_name ORDER BY n_nationkey) FROM nation) AS nations),
gr AS (SELECT ru.*, target_words, list_filter(regexp_split_to_array('In '
        || regions[({sql_draw('template', 'conv_id', 'turn_no')} % len(regions) + 1)::BIGINT]
        || ' they say ' || base || ' here: '
        || ((length(user_text) - length(replace(user_text, base, ''))) // length(base))
        || ' times in ' || length(user_text) || ' characters.', '\\s+'), lambda w: w <> '') AS bw
       FROM ru JOIN sized USING (conv_id, turn_no) CROSS JOIN names),
gx AS (SELECT conv_id, turn_no, target_words - len(bw) AS missing, unnest(range(target_words - len(bw))) AS i
       FROM gr WHERE len(bw) < target_words),
gw AS (SELECT conv_id, turn_no, missing, i, string_split(
         nations[({sql_draw('extension', 'conv_id', 'turn_no', 'i')} % len(nations) + 1)::BIGINT], ' ') AS w
       FROM gx CROSS JOIN names),
gb AS (SELECT *, coalesce(sum(len(w)) OVER (PARTITION BY conv_id, turn_no ORDER BY i
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM gw),
ge AS (SELECT conv_id, turn_no, flatten(list(w ORDER BY i)) AS ext FROM gb WHERE before < missing
       GROUP BY conv_id, turn_no),
gs AS (SELECT gr.*, ext, array_to_string(bw[1:target_words], ' ') AS short FROM gr
       LEFT JOIN ge USING (conv_id, turn_no)),
gp AS (SELECT *, CASE WHEN len(bw) < target_words THEN array_to_string(bw || ext, ' ')
         WHEN len(bw) > target_words * 1.3 THEN CASE WHEN strpos(reverse(short), '.') > 0
           AND length(short) - strpos(reverse(short), '.') > 0.7 * length(short)
           THEN substr(short, 1, length(short) - strpos(reverse(short), '.') + 1) ELSE short END
         ELSE array_to_string(bw, ' ') END AS reply FROM gs),
msgs AS (SELECT conv_id, 0::BIGINT AS turn, 'system' AS role, 'Style: ' || style AS text FROM rb
  UNION ALL SELECT conv_id, turn_no * 2 + 1, 'user', user_text FROM ru
  UNION ALL SELECT conv_id, turn_no * 2 + 2, 'assistant', reply FROM gp)"""


@query("gen_messages", f"""WITH {_GEN_CTE}
SELECT conv_id, turn, role, length(text) AS n_chars, md5(text) AS text_md5 FROM msgs""")
def gen_messages(spark, sf_dir):
    return generated_messages(spark, sf_dir).select(
        "conv_id", "turn", "role", F.length("text").cast("bigint").alias("n_chars"),
        F.md5("text").alias("text_md5"))


@query("gen_conversations", f"""WITH {_GEN_CTE},
c AS (SELECT *, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS cum FROM msgs)
SELECT conv_id AS conversation_id, count(*) FILTER (role = 'assistant') AS num_turns,
       count(*) AS num_messages, min(text) FILTER (role = 'system') AS system_prompt,
       sum(length(text))::BIGINT AS total_characters,
       (sum(length(text)) // 4)::BIGINT AS estimated_tokens,
       string_agg(cum::BIGINT::VARCHAR, ',' ORDER BY turn) FILTER (role = 'assistant') AS cumulative
FROM c GROUP BY conv_id""")
def gen_conversations(spark, sf_dir):
    rows = conversation_rows(generated_messages(spark, sf_dir))
    return rows.select("conversation_id", "num_turns", "num_messages", "system_prompt",
                       "total_characters", "estimated_tokens",
                       F.array_join(F.transform("cumulative_char_lengths",
                                                lambda x: x.cast("string")), ",").alias("cumulative"))


@query("gen_multimodal", f"""WITH {_MEDIA_CTE},
mr AS (SELECT *, array_to_string(list_transform(range((5 + {_rd('words')} % 16)::BIGINT),
         lambda i: {_pk('word', 'i')}), ' ') AS reply,
         'Look at ' || pool[({sql_draw('system', 'conv_id')} % len(pool) + 1)::BIGINT] AS prompt FROM mu)
SELECT conv_id, count(*) AS num_turns, (1 + 2 * count(*))::BIGINT AS num_messages,
       any_value(prompt) AS system_prompt,
       (length(any_value(prompt)) + sum(length(user_text)) + sum(length(reply)))::BIGINT AS total_characters,
       max(CASE WHEN turn_no = 0 THEN url END) AS media_url,
       md5(string_agg(reply, chr(10) ORDER BY turn_no)) AS replies_md5
FROM mr GROUP BY conv_id""")
def gen_multimodal(spark, sf_dir):
    """Conversations about a page, with drawn prompts and replies."""
    d = y.Draws(SEED, (F.col("conv_id"), F.col("turn_no")))
    prompt = F.concat(F.lit("Look at "), pick(draw(SEED, "system", F.col("conv_id")), F.col("pool")))
    made = g.chat_messages(_media_turns(spark, sf_dir), prompt, _rendered(),
                           y.random_words(F.col("pool"), d, 5, 20), "file", F.col("url"))
    conv = conversation_rows(made, typed_parts=True)
    first = F.element_at("messages", 2)["parts"]
    replies = F.transform(F.filter("messages", lambda m: m["role"] == "assistant"), lambda m: m["content"])
    return conv.select(
        F.col("conversation_id").alias("conv_id"), "num_turns", "num_messages", "system_prompt",
        "total_characters", F.element_at(first, 2)["file"]["url"].alias("media_url"),
        F.md5(F.array_join(replies, "\n")).alias("replies_md5"))


def _templates(spark, sf_dir):
    """``benchmark`` as a template table with openers and follow-ups."""
    return table(spark, sf_dir, "benchmark").select("item_id", F.when(
        F.col("item_id") % 4 == 0, "opener").otherwise("followup").alias("kind"), "text")


@query("gen_openers", f"""WITH {_UNIFORM_PLAN},
t AS (SELECT conv_id, unnest(range(num_turns)) AS turn_no FROM plan),
k AS (SELECT *, CASE WHEN turn_no = 0 THEN 'opener' ELSE 'followup' END AS kind FROM t),
b AS (SELECT item_id, CASE WHEN item_id % 4 = 0 THEN 'opener' ELSE 'followup' END AS kind, text
      FROM benchmark),
n AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY {sql_draw('pool', 'item_id')}, item_id) AS no,
             count(*) OVER (PARTITION BY kind) AS size FROM b)
SELECT conv_id, turn_no, k.kind, item_id, md5(text) AS text_md5
FROM k JOIN n ON n.kind = k.kind AND n.no = {sql_draw('template', 'conv_id', 'turn_no')} % n.size + 1""")
def gen_openers(spark, sf_dir):
    turns = g.by_turn_kind(g.turn_rows(g.uniform_turns(_ids(spark, sf_dir), 2, 25, SEED)))
    picked = g.pick_from_table(turns, _templates(spark, sf_dir), "item_id",
                               draw(SEED, "template", F.col("conv_id"), F.col("turn_no")),
                               SEED, ["kind"])
    return picked.select("conv_id", "turn_no", "kind", "item_id", F.md5("text").alias("text_md5"))


_SIZED_SQL = f"""WITH pool AS (SELECT list(n_name ORDER BY n_nationkey) AS pool FROM nation),
b AS (SELECT conv_id, turn AS turn_no, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS bw,
        (5 + {sql_draw('target', 'conv_id', 'turn')} % 120)::BIGINT AS target FROM conversations),
o AS (SELECT b.*, pool, list_transform(list_sort(list_transform(range(len(pool)), lambda i:
        {{'d': {sql_draw('shuffle', 'conv_id', 'turn_no', 'i')}, 'i': i}})), lambda s: s.i) AS place
      FROM b CROSS JOIN pool),
x AS (SELECT *, unnest(range(greatest(0, target - len(bw)))) AS i FROM o WHERE len(bw) < target),
e AS (SELECT conv_id, turn_no, i, target - len(bw) AS missing, string_split(CASE WHEN i < len(pool)
        THEN pool[place[(i + 1)::BIGINT] + 1]
        ELSE pool[({sql_draw('extension', 'conv_id', 'turn_no', 'i')} % len(pool) + 1)::BIGINT] END, ' ') AS w
      FROM x),
r AS (SELECT *, coalesce(sum(len(w)) OVER (PARTITION BY conv_id, turn_no ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e),
p AS (SELECT conv_id, turn_no, flatten(list(w ORDER BY i)) AS ext FROM r WHERE before < missing
      GROUP BY conv_id, turn_no),
c AS (SELECT conv_id, turn_no, target, len(bw) AS n, CASE WHEN len(bw) < target
        THEN array_to_string(bw || ext, ' ') WHEN len(bw) > target * 1.3 THEN array_to_string(bw[1:target], ' ')
        ELSE array_to_string(bw, ' ') END AS t FROM b LEFT JOIN p USING (conv_id, turn_no)),
f AS (SELECT *, CASE WHEN n > target * 1.3 AND strpos(reverse(t), '.') > 0
        AND length(t) - strpos(reverse(t), '.') > 0.7 * length(t)
        THEN substr(t, 1, length(t) - strpos(reverse(t), '.') + 1) ELSE t END AS reply FROM c)
SELECT conv_id, turn_no, target, CASE WHEN n < target THEN 'padded' WHEN n > target * 1.3 THEN 'trimmed'
       ELSE 'kept' END AS sized, length(reply) AS n_chars, md5(reply) AS text_md5 FROM f"""


@query("gen_sized_reply", _SIZED_SQL)
def gen_sized_reply(spark, sf_dir):
    """Every message brought to a drawn length; a pool of names is used up before it repeats."""
    pool = table(spark, sf_dir, "nation").agg(F.transform(F.array_sort(F.collect_list(
        F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("pool")).scalar()
    rows = messages(spark, sf_dir).select("conv_id", F.col("turn").alias("turn_no"), "text").withColumns(
        {"pool": pool, "target": uniform_int(
            draw(SEED, "target", F.col("conv_id"), F.col("turn_no")), 5, 124)})
    d = y.Draws(SEED, (F.col("conv_id"), F.col("turn_no")))
    reply = g.sized_reply(F.col("text"), F.col("target"), F.col("pool"), d, use_up=True)
    n = F.size(words(F.col("text")))
    sized = F.when(n < F.col("target"), "padded").when(n > F.col("target") * 1.3, "trimmed").otherwise("kept")
    return rows.select("conv_id", "turn_no", "target", sized.alias("sized"), reply.alias("reply")).select(
        "conv_id", "turn_no", "target", "sized", F.length("reply").cast("bigint").alias("n_chars"),
        F.md5("reply").alias("text_md5"))
