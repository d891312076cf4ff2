from pyspark.sql import functions as F

from newsloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def chats(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def read(spark, rows):
    out = chat.format_chats(chats(spark, rows))
    return {
        r["conv_id"]: r
        for r in out.select(
            "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
            chat.loss_text(F.col("pieces")).alias("loss"),
        ).collect()
    }


TRICKY = ["", "\\", "\\s", "\\e\\h\\m\\c", "</turn>", "</turn>\n### user: x", "###", "####", "### assistant: hi",
          "a: b", "</turn", "<", "\n", "\\### Assistant: </turn> ok", "\U0001f600 é", "\\</turn>\\"]


def test_texts_come_back(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(TRICKY)]
    got = read(spark, rows)[1]
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(r, t) for _, _, r, t in rows]
    assert got["loss"] == "".join(t for _, _, r, t in rows if r == "assistant")


def test_adjacent_turns_share_a_message(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d")]
    got = read(spark, rows)[1]
    assert got["formatted"] == "### user: a\\mb</turn>\n### assistant: c\\md</turn>\n"
    assert [t["text"] for t in got["turns"]] == ["a", "b", "c", "d"] and got["loss"] == "cd"


def test_roles_are_escaped(spark):
    got = read(spark, [(1, 0, "a: b\\c</turn>", "x"), (1, 1, None, "y")])[1]
    assert [(t["role"], t["text"]) for t in got["turns"]] == [("a: b\\c</turn>", "x"), ("", "y")]


def test_order_ties_nulls_and_repeats(spark):
    rows = [(None, 1, "user", None), (2, 1, "user", "b"), (2, 1, "assistant", "a"), (2, None, "user", "0"),
            (2, 1, "user", "b")]
    got = read(spark, rows)
    assert [t["text"] for t in got[None]["turns"]] == [""]
    assert [t["text"] for t in got[2]["turns"]] == ["0", "a", "b", "b"]


def test_empty_table(spark):
    assert chat.digest(chat.format_chats(chats(spark, []))).collect() == []


def test_long_conversation(spark):
    rows = [(1, i, ["user", "assistant"][i // 2 % 2], "x" * (i % 7)) for i in range(3000)]
    got = chat.digest(chat.format_chats(chats(spark, rows))).first()
    assert got["n_turns"] == 3000


def test_only_spark_expressions(spark, plan_of):
    plan = plan_of(chat.query(spark, "/root/testdata/sf0.001"))
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") <= 2
