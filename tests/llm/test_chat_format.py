"""Round trips of formatted conversations, the machine's verdicts, and edge rows."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.llm.chat_format import (
    CHAT, Template, assemble, escape, format_turns, loss_text, read_back, unescape,
)

NASTY = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "<\\|im_end|>", "<\\\\|", "<|", "|>", "<", "\\", "|", "\n", "a", "é", "$1", "<<||"]


def whole(df, template=CHAT):
    out = assemble(format_turns(df, template))
    return {
        r["conv_id"]: r
        for r in out.withColumn("turns", read_back(F.col("formatted"), template))
        .withColumn("loss", loss_text(F.col("segments"))).collect()
    }


def test_escape_is_reversible(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(NASTY) for _ in range(rng.randrange(0, 12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"] and "<|" not in r["e"]


def test_round_trip(spark):
    rng = random.Random(2)
    said = {}
    for c in range(60):
        said[c] = [
            (rng.choice(["user", "assistant", "system", "tool", "".join(rng.choice(NASTY) for _ in range(3))]),
             "".join(rng.choice(NASTY) for _ in range(rng.randrange(0, 9))))
            for _ in range(rng.randrange(1, 9))
        ]
    data = [(c, t, role, text) for c, turns in said.items() for t, (role, text) in enumerate(turns)]
    rng.shuffle(data)
    found = whole(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    for c, turns in said.items():
        assert [tuple(t) for t in found[c]["turns"]] == turns
        assert found[c]["loss"] == "".join(t for r, t in turns if r == "assistant")
        assert "".join(s["text"] for s in found[c]["segments"]) == found[c]["formatted"]
        assert found[c]["formatted"].count("<|im_end|>") == len(turns)


@pytest.mark.parametrize("roles, error", [
    ("system user assistant", None), ("user assistant user assistant", None), ("user assistant user", 2), ("assistant user", 0),
    ("user user assistant", 1), ("system assistant", 1), ("user tool", 1), ("user assistant system", 2), ("system", 0),
])
def test_machine(spark, roles, error):
    df = spark.createDataFrame([(1, i, r, "x") for i, r in enumerate(roles.split())], "conv_id int, turn int, role string, text string")
    row = whole(df)[1]
    assert (row["valid"], row["first_error"]) == (error is None, error)


def test_other_template(spark):
    template = Template(start="<|s|>", middle="<|m|>", end="<|e|>", learn=("bot",), follows={"": ("bot",), "bot": ("bot",)}, final=("bot",))
    df = spark.createDataFrame([(1, 0, "bot", "hi <|e|>"), (1, 1, "bot", "there")], "conv_id int, turn int, role string, text string")
    row = whole(df, template)[1]
    assert row["valid"] and row["loss"] == "hi <|e|>there" and row["formatted"] == "<|s|>bot<|m|>hi <\\|e|><|e|><|s|>bot<|m|>there<|e|>"
    with pytest.raises(ValueError):
        Template(start="[INST]")


def test_edge_rows(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", None, 9), (1, 1, None, "b", 9), (1, 1, None, "b", 9), (1, None, "user", "first", 9), (None, 0, "user", "q", 9),
         (None, 1, "assistant", "x" * 300_000, 9), (2, 5, "assistant", "", 9), (2, 5, "assistant", "", 9)],
        "conv_id long, turn long, role string, text string, position int",
    )
    found = whole(df)
    assert [tuple(t) for t in found[1]["turns"]] == [("user", "first"), ("user", ""), ("", "b"), ("", "b")]
    assert found[None]["valid"] and len(found[None]["loss"]) == 300_000
    assert len(found[2]["turns"]) == 2 and found[2]["loss"] == ""
    assert whole(df.where("false")) == {}
