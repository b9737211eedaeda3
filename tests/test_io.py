"""Readers, writers, manifests and the batch job on temporary folders."""

import json

import pytest
from pyspark.sql import functions as F

from palaver.operators import assemble as a
from palaver.operators import export as e
from palaver.operators import mix as x
from palaver.plans.batch import regenerate_manifests
from palaver.plans.manifest import build_manifests
from palaver.sources import readers as r
from palaver.sources import schemas, writers as w


@pytest.fixture(scope="module")
def dataset_dir(tmp_path_factory, hot_messages):
    root = tmp_path_factory.mktemp("data")
    rows = a.conversation_rows(hot_messages).withColumn(
        "topic", F.when(F.col("conversation_id") % 2 == 0, "even").otherwise("odd")).withColumn(
        "conversation_id", F.col("conversation_id").cast("string"))
    w.write_dataset(rows, str(root / "multi_turn_text_chat.parquet"))
    tasks = rows.drop("topic").withColumn("task_type", F.lit("code_generation")).withColumn(
        "success_score", F.lit(0.5)).withColumn("num_tool_calls", F.lit(4).cast("bigint")).withColumn(
        "num_errors", F.lit(1).cast("bigint"))
    w.write_dataset(tasks, str(root / "agent" / "multi_turn_agentic_task.parquet"))
    w.write_dataset(rows, str(root / "multi_turn_text_trace.parquet"))
    return root


def test_read_dataset(spark, dataset_dir, by_conversation):
    path = str(dataset_dir / "multi_turn_text_chat.parquet")
    df = r.read_dataset(spark, path, "text")
    assert df.count() == len(by_conversation)
    lean = r.read_dataset(spark, path, "text", ["conversation_id", "num_turns"])
    assert lean.columns == ["conversation_id", "num_turns"]
    plan = lean._jdf.queryExecution().executedPlan().toString()
    assert "messages" not in plan.split("ReadSchema")[1]
    assert r.read_dataset(spark, path, "text", sample_size=5).count() == 5


def test_session_and_trace_lines(spark, tmp_path, hot_messages, by_conversation):
    w.write_sessions(hot_messages, str(tmp_path / "s"))
    sessions = r.read_sessions(spark, str(tmp_path / "s"))
    assert sessions.count() == sum(any(m[1] == "user" for m in v) for v in by_conversation.values())
    w.write_traces(hot_messages, str(tmp_path / "t"), records_per_file=10)
    traces = r.read_traces(spark, str(tmp_path / "t"))
    assert traces.count() == sum(m[1] == "assistant" for v in by_conversation.values() for m in v)
    line = json.loads(next((tmp_path / "t").glob("*.json")).read_text().splitlines()[0])
    assert {"session_id", "messages", "output_length"} <= set(line) <= {
        "session_id", "messages", "output_length", "delay"}
    for variant in ("words", "mixed", "replay"):
        w.write_traces(hot_messages, str(tmp_path / variant), variant=variant)
        assert r.read_traces(spark, str(tmp_path / variant)).count() > 0


def test_other_sinks(spark, tmp_path, dataset_dir, hot_messages, by_conversation):
    df = r.read_dataset(spark, str(dataset_dir / "multi_turn_text_chat.parquet"), "text")
    w.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(
        str(tmp_path / "csv"))
    assert back.count() == df.count() and back.columns == df.columns
    w.write_rows(df, str(tmp_path / "rows"))
    assert spark.read.json(str(tmp_path / "rows")).count() == df.count()
    w.write_fine_tuning(hot_messages, str(tmp_path / "ft"))
    lines = [json.loads(x) for f in (tmp_path / "ft").glob("*.json") for x in f.read_text().splitlines()]
    assert len(lines) == len(by_conversation) and all(set(x) == {"messages"} for x in lines)
    assert w.subset_name("text", "subset", 100) == "text_subset_100"
    assert w.subset_name("text", "filtered", 2, 5) == "text_filtered_2_5"
    assert w.subset_name("text", "balanced") == "balanced_text_payload"


def test_metadata(spark, tmp_path):
    path = tmp_path / "images.json"
    path.write_text(json.dumps([{"title": f"t{i}", "url": f"u{i}", "width": i} for i in range(9)], indent=2))
    df = r.read_metadata(spark, str(path), schemas.IMAGE, ["title"], 4)
    assert [x.title for x in df.collect()] == ["t0", "t1", "t2", "t3"]


def test_sources(spark, dataset_dir):
    here = str(dataset_dir / "multi_turn_text_chat.parquet")
    missing = str(dataset_dir / "none.parquet")
    got = r.read_sources(spark, [{"type": "text", "path": here, "required": True},
                                 {"type": "pdf", "path": missing}])
    assert list(got) == ["text"] and x.SOURCE in got["text"].columns
    with pytest.raises(FileNotFoundError):
        r.read_sources(spark, [{"type": "pdf", "path": missing, "required": True}])
    with pytest.raises(ValueError):
        r.read_sources(spark, [{"type": "pdf", "path": missing}])


def test_manifest_file(spark, tmp_path, dataset_dir, by_conversation):
    path = str(dataset_dir / "multi_turn_text_chat.parquet")
    rows = a.profile_input(r.read_dataset(spark, path, "text")).withColumn("dataset_type", F.lit("text"))
    manifest = build_manifests(rows, seed=7, meta={"text": {"description": "café"}}, user_tags=["mine"])
    w.write_manifests(manifest, str(tmp_path / "m"))
    text = next((tmp_path / "m").rglob("*.txt")).read_text()
    doc = json.loads(text)
    assert "café" in text and "\n" in text.strip()
    assert doc["dataset"]["num_conversations"] == len(by_conversation)
    assert doc["dataset"]["seed"] == 7 and "mine" in doc["tags"]["all_tags"]
    profile = doc["distribution_profile"]
    assert sum(b["count"] for b in profile["turn_distribution"]["bucket_distribution"]) == len(by_conversation)
    assert sum(b["count"] for b in profile["token_distribution"]["histogram"]) == len(by_conversation)
    assert profile["category_distribution"]["column"] == "topic"
    assert {c["value"] for c in profile["category_distribution"]["distribution"]} == {"even", "odd"}
    assert "agentic_metrics" not in profile
    stored = r.read_manifest(spark, str(tmp_path / "m"), path, "text")
    assert stored.select("dataset.num_conversations").first()[0] == len(by_conversation)
    fresh = r.read_manifest(spark, str(tmp_path / "absent.json"), path, "text")
    assert fresh.select("dataset.num_conversations").first()[0] == len(by_conversation)


def test_batch_manifests(spark, dataset_dir, by_conversation, tmp_path):
    manifests, broken = regenerate_manifests(spark, str(dataset_dir))
    got = {x.dataset.type: x for x in manifests.collect()}
    assert set(got) == {"text", "agentic"} and broken.isEmpty()  # the derived trace dataset is skipped
    agentic = got["agentic"].distribution_profile.agentic_metrics
    n = len(by_conversation)
    assert agentic.tool_calls.total == 4 * n and agentic.errors.error_rate == 25.0
    assert agentic.success_score.histogram[0]["range"] == "0.5-0.5"
    assert got["text"].distribution_profile.agentic_metrics is None
    assert got["text"].output_files["parquet"] == "multi_turn_text_chat.parquet"
    assert got["agentic"].payload_scores.decode_breakdown.raw.tool_call_penalty == pytest.approx(0.4 * n)
    w.write_manifests(manifests, str(tmp_path / "m"))
    back = r.read_manifests(spark, str(tmp_path / "m")).collect()
    assert {x.dataset.type: x.dataset.num_conversations for x in back} == {"text": n, "agentic": n}


def test_datasets_are_told_apart_by_path(spark, dataset_dir, tmp_path, by_conversation):
    rows = spark.read.parquet(str(dataset_dir / "multi_turn_text_chat.parquet"))
    n = len(by_conversation)
    for place in ("text/data/run.parquet", "pdf/data/run.parquet", "multi_turn_context.parquet"):
        rows.repartition(2).write.parquet(str(tmp_path / place))
    rows.withColumn("part", F.lit("a b")).union(rows.withColumn("part", F.lit("c"))).write \
        .partitionBy("part").parquet(str(tmp_path / "random" / "parted.parquet"))
    rows.write.csv(str(tmp_path / "text" / "data" / "run_rows.csv"))
    manifests, broken = regenerate_manifests(spark, str(tmp_path), families={
        "multi_turn_context.parquet": "repeat"})
    got = {x.dataset_file: (x.dataset.type, x.dataset.num_conversations) for x in manifests.collect()}
    assert got == {"text/data/run.parquet": ("text", n), "pdf/data/run.parquet": ("pdf", n),
                   "multi_turn_context.parquet": ("repeat", n),
                   "random/parted.parquet": ("random", 2 * n)} and broken.isEmpty()
    files = {x.dataset_file: x.output_files for x in manifests.collect()}
    assert files["text/data/run.parquet"] == {"parquet": "run.parquet", "rows_csv": "run_rows.csv"}


def test_manifest_scans_its_input_once(spark, dataset_dir):
    path = str(dataset_dir / "multi_turn_text_chat.parquet")
    rows = a.profile_input(r.read_dataset(spark, path, "text")).withColumn("dataset_type", F.lit("text"))
    df = build_manifests(rows)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1


def test_a_dataset_with_a_broken_file_is_named_and_left_out(spark, tmp_path, dataset_dir):
    df = spark.read.parquet(str(dataset_dir / "multi_turn_text_chat.parquet"))
    df.write.parquet(str(tmp_path / "multi_turn_text_chat.parquet"))
    df.repartition(4).write.parquet(str(tmp_path / "half.parquet"))
    part = sorted((tmp_path / "half.parquet").glob("part-*.parquet"))[1]
    part.write_bytes(part.read_bytes()[:-40])
    (tmp_path / "multi_turn_repeat_chat.parquet").write_bytes(b"not a parquet file")
    df.filter("false").write.parquet(str(tmp_path / "none.parquet"))
    # The page of a column is overwritten; the footer is whole.
    df.union(df).coalesce(1).write.parquet(str(tmp_path / "page.parquet"))
    (part,) = (tmp_path / "page.parquet").glob("part-*.parquet")
    data = bytearray(part.read_bytes())
    data[4:len(data) // 3] = bytes(len(data) // 3 - 4)
    part.write_bytes(bytes(data))
    for crc in (tmp_path / "page.parquet").glob(".*.crc"):
        crc.unlink()
    rows, broken = r.read_all_datasets(spark, str(tmp_path))
    assert rows.count() == df.count()
    assert sorted((b.dataset_file, b.broken_files) for b in broken.collect()) == [
        ("half.parquet", 1), ("multi_turn_repeat_chat.parquet", 1), ("page.parquet", 1)]


def test_batch_plan_does_not_grow_with_the_datasets(spark, dataset_dir, tmp_path):
    def size(root):
        manifests, broken = regenerate_manifests(spark, str(root))
        return [len(x._jdf.queryExecution().analyzed().treeString().splitlines())
                for x in (manifests, broken)]

    df = spark.read.parquet(str(dataset_dir / "multi_turn_text_chat.parquet"))
    df.write.parquet(str(tmp_path / "d0.parquet"))
    before = size(tmp_path)
    for k in range(1, 4):
        df.write.parquet(str(tmp_path / f"d{k}.parquet"))
    assert size(tmp_path) == before


def test_json_array(spark, tmp_path):
    w.write_json_array(spark.range(50).repartition(4), str(tmp_path / "rows"))
    (file,) = (tmp_path / "rows").glob("part-*")
    assert sorted(x["id"] for x in json.loads(file.read_text())) == list(range(50))
    assert not (tmp_path / "rows_lines").exists()
    w.write_json_array(spark.range(0), str(tmp_path / "none"))
    (file,) = (tmp_path / "none").glob("part-*")
    assert json.loads(file.read_text()) == []


def test_trace_rows_equal_replies(hot_messages):
    assert e.trace_index(hot_messages).count() == hot_messages.filter("role = 'assistant'").count()
