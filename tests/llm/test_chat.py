"""Formatted conversations give back every turn."""

import random

from pyspark.sql import functions as F

from geoloom.llm.chat import format_chat, parse_chat, trained_text

SCHEMA = "conv_id bigint, turn bigint, role string, text string, spans string, formatted int"
PARTS = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "\\", "\\b", "\\c", "\\n", "<", "|", ">", "\n", "assistant", "é😀", " ", "<|"]


def read_back(df):
    return {r["conv_id"]: r for r in format_chat(df).withColumn("turns", parse_chat(F.col("formatted"))).withColumn(
        "loss", trained_text(F.col("formatted"), F.col("spans"))).collect()}


def test_random_control_strings_come_back(frame):
    rng = random.Random(3)
    rows, wanted = [], {}
    for conv in range(200):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "assistant", "sys\ntem", "<|im_end|>\n", ""])
            text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8)))
            rows.append((conv, turn, role, text, "clash", 1))
            wanted.setdefault(conv, []).append((role, text))
    got = read_back(frame(rows, SCHEMA))
    for conv, turns in wanted.items():
        r = got[conv]
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns and r["n_turns"] == len(turns)
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
        assert r["n_blocks"] == 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))


def test_nulls_ties_repeats_and_no_rows(spark, frame):
    rows = [(None, 1, "user", "q", None, 0), (None, None, None, None, None, 0), (7, 1, "b", "2", "", 0), (7, 1, "a", "1", "", 0), (7, 1, "a", "1", "", 0),
            (8, 0, "assistant", "x" * 200_000, "", 0)]
    got = read_back(frame(rows, SCHEMA))
    assert [tuple(t) for t in got[None]["turns"]] == [("", ""), ("user", "q")]
    assert [tuple(t) for t in got[7]["turns"]] == [("a", "1"), ("a", "1"), ("b", "2")] and got[7]["n_blocks"] == 2
    assert got[8]["loss"] == "x" * 200_000
    assert format_chat(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_python(frame):
    df = format_chat(frame([(1, 1, "user", "x", "", 0)], SCHEMA)).select(parse_chat(F.col("formatted")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
