import json
import os

from pyspark.sql import functions as F

from conftest import SF001
from tablestats import (chat_content, chat_requests, prompt_text, report_lines, summary,
                        summary_lines, write_report)
from tablestats.plans.bindings import catalog
from tablestats.plans.chat import DEFAULT_INSTRUCTIONS, DEFAULT_MODEL


def test_summary_lines_text(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)], "x double")
    lines = [r.line for r in summary_lines(summary(df, "x", exact=True)).orderBy("seq").collect()]
    assert lines == ["count: 10", "mean: 5.5", "stddev: 3.0276503540974917", "min: 1.0",
                     "25%: 3.25", "50%: 5.5", "75%: 7.75", "max: 10.0"]
    two = [r.line for r in summary_lines(summary(df, "x", exact=True), digits=2).orderBy("seq").collect()]
    assert two[1] == "mean: 5.50" and two[0] == "count: 10"
    empty = spark.createDataFrame([], "x double")
    lines = [r.line for r in summary_lines(summary(empty, "x")).orderBy("seq").collect()]
    assert lines[0] == "count: 0" and lines[1] == "mean: None"


def test_report_lines_structure(spark, tmp_out):
    clean = catalog(spark, SF001)
    lines = report_lines(clean)
    rows = lines.orderBy("section", "seq").collect()
    text = [r.line for r in rows]
    assert text[0].startswith("DATASET ANALYSIS RESULTS") and text[1] == "=" * 70
    assert any(t.startswith("Total number of games in the dataset: ") for t in text)
    heads = [t for t in text if t[:2] in ("1.", "2.", "3.", "4.", "5.")]
    assert [h[:2] for h in heads] == ["1.", "2.", "3.", "4.", "5."]
    years = [t for t in text if t[:4].isdigit() and ": count=" not in t]
    assert len(years) <= 10 and years == sorted(years)
    assert any(t.startswith("- The year with the most game releases is") for t in text)
    assert any(t.startswith("- The dataset covers the period from") for t in text)
    out = os.path.join(tmp_out, "report")
    write_report(lines, out)
    parts = [p for p in os.listdir(out) if p.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(out, parts[0]), encoding="utf-8") as fh:
        assert fh.read().splitlines() == text


def test_report_lines_empty_table(spark):
    clean = catalog(spark, SF001).where(F.lit(False))
    text = [r.line for r in report_lines(clean).orderBy("section", "seq").collect()]
    assert "Total number of games in the dataset: 0" in text
    assert not any(t.startswith("- The year with") for t in text)
    assert not any(t.startswith("- The average game price") for t in text)


def test_prompt_text_orders_lines(spark):
    df = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, "b"), (2, 0, "z")],
                               "k int, turn int, text string")
    got = {r.k: r.prompt for r in prompt_text(df, "I:\n", key="k", order=("turn",),
                                              text_col="text").collect()}
    assert got == {1: "I:\na\nb\nc\n", 2: "I:\nz\n"}
    one = prompt_text(df.withColumnRenamed("turn", "seq").withColumn("section", F.lit(0))
                      .withColumnRenamed("text", "line"), "X").first().prompt
    assert one.startswith("X") and one.endswith("\n")


def test_chat_requests_json(spark):
    df = spark.createDataFrame([("hello \"w\"\nline",)], "prompt string")
    body = json.loads(chat_requests(df).first().request)
    assert body == {"model": DEFAULT_MODEL, "messages": [{"role": "user", "content": "hello \"w\"\nline"}],
                    "temperature": 0.5, "max_tokens": -1, "stream": False}
    assert DEFAULT_INSTRUCTIONS.endswith("answer on:\n\n")


def test_chat_content_outcomes(spark):
    bodies = ['{"choices":[{"message":{"content":"hi"}}]}', '{"choices":[]}', '{"other":1}',
              '{"choices":[{"message":{}}]}', '{"choices":[{"message":{"content":""}}]}',
              "not json", None]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [(r.content, r.status) for r in chat_content(df).collect()]
    assert got == [("hi", "ok"), (None, "no_choices"), (None, "no_choices"), (None, "empty"),
                   (None, "empty"), (None, "bad_json"), (None, "bad_json")]


def test_answer_text_sink(spark, tmp_out):
    """A9: the model answer text goes out through the ordered text sink."""
    bodies = ['{"choices":[{"message":{"content":"line one\\nline two"}}]}', "not json"]
    df = chat_content(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "k int, body string"))
    answers = df.where(F.col("status") == "ok").select(
        F.lit(0).alias("section"), F.col("k").alias("seq"), F.col("content").alias("line"))
    out = os.path.join(tmp_out, "answer")
    write_report(answers, out)
    part = [p for p in os.listdir(out) if p.startswith("part-")][0]
    with open(os.path.join(out, part), encoding="utf-8") as fh:
        assert fh.read() == "line one\nline two\n"


def test_report_key_must_be_year_like(spark):
    import pytest
    clean = catalog(spark, SF001)
    with pytest.raises(ValueError):
        report_lines(clean.withColumn("release_year", F.col("release_year").cast("string")))
