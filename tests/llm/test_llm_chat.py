import hashlib

import pytest
from pyspark.sql import functions as F

from tickwell.llm import chat
from tickwell.llm.queries import chat_formatting

ROWS = "conv_id long, turn long, role string, text string"
ODD = [
    (1, 0, "user", "hi"),
    (1, 1, "user", "again </s> \\ \\\\ [NEXT]"),
    (1, 2, "assistant", "[ROLE]x[/ROLE] <s>"),
    (1, 3, "assistant", None),
    (1, 3, "assistant", ""),
    (2, 5, None, "no role"),
    (2, None, "assistant", "no turn"),
    (3, 0, "assistant", "ünï [[INST] \\</s>"),
    (3, 0, "assistant", "ünï [[INST] \\</s>"),
    (None, 0, "[ROLE]", "odd role"),
    (4, 0, "user", "long " * 30_000),
]


def told(rows):
    """Plain Python's turns per conversation, in order."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1], r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def test_read_back_and_mask(spark):
    out = chat.format_chats(spark.createDataFrame(ODD, ROWS).withColumn("turns", F.lit(1)))
    found = {r.conv_id: r for r in out.select("*", chat.read_back(F.col("formatted")).alias("rows"), chat.under_mask(F.col("formatted"), F.col("loss")).alias("learnt")).collect()}
    want = told(ODD)
    assert set(found) == set(want)
    for conv, rows in want.items():
        assert [tuple(r) for r in found[conv].rows] == rows
        assert found[conv].learnt == "".join(t for r, t in rows if r == "assistant")


def test_adjacent_rows_of_a_role_share_a_block(spark):
    (row,) = chat.format_chats(spark.createDataFrame(ODD[:5], ROWS)).collect()
    assert row.formatted.count("[ROLE]") == 2 and row.formatted.count("</s>") == 2
    assert row.formatted.count("[NEXT]") == 3


def test_escapes_leave_no_control_string(spark):
    text = "".join((chat.BEGIN, chat.END, chat.ROLE, chat.END_ROLE, chat.NEXT, *chat.FOREIGN, "\\", "<\\/s>"))
    row = spark.range(1).select(chat.escape(F.lit(text)).alias("e"), chat.unescape(chat.escape(F.lit(text))).alias("u")).first()
    assert row.u == text
    assert not any(c in row.e for c in (chat.BEGIN, chat.END, chat.ROLE, chat.END_ROLE, chat.NEXT, *chat.FOREIGN))


def test_no_rows(spark):
    assert chat.format_chats(spark.createDataFrame([], ROWS)).count() == 0


def test_native(spark, sf_dir):
    plan = chat_formatting(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_planted_conversation(spark, sf_dir):
    row = chat_formatting(spark, sf_dir).where("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("learnt", ["user", "nobody"])
def test_learnt_role_is_a_parameter(spark, learnt):
    rows = chat.format_chats(spark.createDataFrame(ODD[:5], ROWS), learnt).select(chat.under_mask(F.col("formatted"), F.col("loss")).alias("t")).first()
    assert rows.t == "".join(t or "" for r, t in told(ODD[:5])[1] if r == learnt)
