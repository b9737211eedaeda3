"""Export shapes on edge cases, including conversations of several parts."""

import json

import pytest
from pyspark.sql import functions as F

from palaver.functions import content as c
from palaver.operators import assemble as a
from palaver.operators import export as e


def plain(rows):
    return [r.asDict(recursive=True) for r in rows]


def test_sessions(hot_messages, by_conversation):
    got = {r["session_id"]: [t["text"] for t in r["turns"]]
           for r in plain(e.sessions(hot_messages).collect())}
    want = {k: [t for _, role, t in v if role == "user"] for k, v in by_conversation.items()}
    assert got == {k: v for k, v in want.items() if v}
    kept = {r.session_id for r in e.sessions(hot_messages, keep_empty=True).collect()}
    assert kept == set(by_conversation)


@pytest.mark.parametrize("size", [4, 10, 1024])
def test_trace_is_whole_at_every_part_size(hot_messages, by_conversation, size):
    by_key = {(r.session_id, r.turn): r for r in e.trace(hot_messages, size).collect()}
    expected = 0
    for conv, msgs in by_conversation.items():
        replies = 0
        for i, (turn, role, text) in enumerate(msgs):
            if role != "assistant":
                continue
            expected += 1
            replies += 1
            r = by_key[conv, turn]
            assert [tuple(x) for x in r.messages] == [(ro, t) for _, ro, t in msgs[: i + 1]]
            assert r.output_length == max(1, len(text) // 4)
            assert r.delay == (0 if replies > 1 else None)
    assert expected == len(by_key)


@pytest.mark.parametrize("size", [4, 1024])
def test_replay_and_splits(hot_messages, by_conversation, size):
    replay = {(r.session_id, r.turn): r for r in e.replay_trace(hot_messages, part_size=size).collect()}
    lean = {(r.session_id, r.turn): r.output_length
            for r in e.replay_trace(hot_messages, nested=False, part_size=size).collect()}
    pairs = {(r.session_id, r.turn): r for r in e.replay_split(hot_messages, part_size=size).collect()}
    for conv, msgs in by_conversation.items():
        for i, (turn, role, _) in enumerate(msgs):
            nxt = msgs[i + 1] if i + 1 < len(msgs) else None
            want = len(nxt[2]) if nxt and nxt[1] == "assistant" else 100
            assert replay[conv, turn].output_length == lean[conv, turn] == want
            is_pair = role == "user" and nxt is not None and nxt[1] == "assistant" and i > 0
            assert ((conv, turn) in pairs) == is_pair
            if is_pair:
                assert pairs[conv, turn].prefix_messages == i
                assert [tuple(m) for m in pairs[conv, turn].prefix] == [
                    (ro, t) for _, ro, t in msgs[:i]]
                assert [m.role for m in pairs[conv, turn].new_turn] == ["user", "assistant"]


@pytest.mark.parametrize("size", [6, 1024])
@pytest.mark.parametrize("granularity", ["turn", "message"])
def test_mixed_trace(hot_messages, by_conversation, size, granularity):
    rows = {(r.session_id, r.entry): r for r in e.mixed_trace(
        hot_messages, granularity, size).collect()}
    count = 0
    for conv, msgs in by_conversation.items():
        total, entries = 0, []
        for _, role, text in msgs:
            total += len(text)
            if granularity == "message" or role == "assistant":
                entries.append(total)
        for i, cum in enumerate(entries):
            count += 1
            r = rows[conv, i + 1]
            assert [tuple(x) for x in r.messages] == [
                (ro, t) for _, ro, t in msgs[: (i + 1) * 2 + 1]]
            assert r.output_length == cum
    assert count == len(rows)


def test_word_trace(hot_messages, by_conversation):
    rows = {(r.session_id, r.turn): r for r in e.word_trace(hot_messages).collect()}
    want = {}
    for conv, msgs in by_conversation.items():
        for i in range(1, len(msgs), 2):
            if i + 1 < len(msgs):
                want[conv, msgs[i + 1][0]] = (len(msgs[: i + 2]), len(msgs[i + 1][2].split()))
    assert {k: (len(r.messages), r.output_length) for k, r in rows.items()} == want


def test_mixed_trace_with_granularity_per_source(hot_messages, by_conversation):
    kind = F.when(F.col("conv_id") == 7, "message").otherwise("turn")
    rows = e.mixed_trace(hot_messages, kind, 8).groupBy("session_id").count().collect()
    want = {k: len(v) if k == 7 else sum(role == "assistant" for _, role, _ in v)
            for k, v in by_conversation.items()}
    assert {r.session_id: r["count"] for r in rows} == {k: n for k, n in want.items() if n}


def test_fine_tuning(hot_messages, by_conversation):
    rows = e.fine_tuning(hot_messages)
    assert rows.columns == ["messages"]
    got = sorted([tuple(m) for m in r.messages] for r in rows.collect())
    assert got == sorted([(ro, t) for _, ro, t in v] for v in by_conversation.values())


PDF = json.dumps([{"type": "text", "text": "Read"}, {"type": "text", "text": "this"},
                  {"type": "file", "file": {"url": "http://a/1.pdf", "mime_type": "application/pdf"}},
                  {"type": "file", "file": {"url": "http://a/2.pdf"}}])
IMAGE = json.dumps([{"type": "text", "text": "Look"},
                    {"type": "image_url", "image_url": {"url": "http://a/i.png"}}])


@pytest.mark.parametrize("text, media, inline, size", [
    (PDF, "Read this\n\n[PDF: http://a/1.pdf]",
     "Readthis[FILE: http://a/1.pdf] [FILE: http://a/2.pdf]", 8),
    (IMAGE, "Look\n\n[Image: http://a/i.png]", "Look[IMAGE: http://a/i.png]", 4),
    ("[note] plain text", "[note] plain text", "[note] plain text", 17),
    ("[1, 2]", "[1, 2]", "[1, 2]", 6),
    ("[]", "[]", "[]", 2),
    ("plain 😀é", "plain 😀é", "plain 😀é", 8),
])
def test_content_union(spark, text, media, inline, size):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(c.flatten_content(F.col("t")).alias("m"), c.inline_content(F.col("t")).alias("i"),
                    c.part_chars(F.col("t")).alias("n")).first()
    assert (got.m, got.i, got.n) == (media, inline, size)


def test_media_content_round_trip(spark):
    df = spark.createDataFrame([('say "hi"\n[x]', "http://u/1")], "t string, u string")
    made = df.select(c.media_content(F.col("t"), "file", F.col("u")).alias("x"))
    assert json.loads(made.first().x) == [
        {"type": "text", "text": 'say "hi"\n[x]'},
        {"type": "file", "file": {"url": "http://u/1", "mime_type": "application/pdf"}}]
    assert made.select(c.flatten_content(F.col("x")).alias("f")).first().f == \
        'say "hi"\n[x]\n\n[PDF: http://u/1]'


def test_conversation_rows_round_trip(hot_messages, by_conversation):
    rows = a.conversation_rows(hot_messages)
    stored = a.to_stored(rows)
    assert dict(stored.dtypes)["messages"] == "string"
    back = {}
    for r in a.explode_messages(stored).orderBy("conv_id", "turn").collect():
        back.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    assert back == by_conversation
    profile = {r.conversation_id: r for r in a.profile_input(stored).collect()}
    assert set(profile) == set(by_conversation)
    for conv, msgs in by_conversation.items():
        r = profile[conv]
        assert r.num_messages == len(msgs)
        assert r.total_characters == sum(len(t) for _, _, t in msgs)
        assert r.num_entries == sum(role == "assistant" for _, role, _ in msgs)
        assert (r.growth_ratio is None) == (r.num_entries < 2)
