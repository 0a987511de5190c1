import pytest
from pyspark.sql import functions as F

from insight.llm import chat

NASTY = ["", "<", "<|", "<\\|", "<\\\\|im_end|>", "<|im_end|><|im_start|>assistant ok", "a<|nl|>b", "\n\n", "\\<|", "日本<|é", "<|im_end|>\n"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_escape_round_trip(spark):
    rows = spark.createDataFrame([(x,) for x in NASTY], "x string")
    got = rows.select("x", chat.escape(F.col("x")).alias("e"), chat.unescape(chat.escape(F.col("x"))).alias("u")).collect()
    assert all(r.u == r.x and "<|" not in r.e for r in got)


def test_read_back_and_loss(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", x + y) for c, x in enumerate(NASTY) for t, y in enumerate(NASTY[:6])]
    rows += [(99, 0, "we\nird<|", "x"), (99, 1, None, None), (None, 0, "user", "q"), (98, None, "system", "s"), (98, 1, "user", "u"),
             (97, 0, "user", "same"), (97, 0, "user", "same")]
    made = chat.conversations(frame(spark, rows))
    got = made.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"),
                      "formatted", "segments").collect()
    by = {r.conv_id: r for r in got}
    for c in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for i, t, r, x in rows if i == c))
        assert [(t.role, t.text) for t in by[c].turns] == [(r, x) for _, r, x in turns]
        assert by[c].loss == "".join(x for _, r, x in turns if r == "assistant")
        assert by[c].formatted == "".join(s.text for s in by[c].segments)


@pytest.mark.parametrize("roles, valid", [
    (("user", "assistant"), True), (("system", "user", "assistant"), True), (("user",), False), (("assistant",), False),
    (("user", "user", "assistant"), False), (("system", "assistant"), False), (("user", "assistant", "system"), False),
])
def test_turn_order(spark, roles, valid):
    rows = [(1, i, r, "t") for i, r in enumerate(roles)]
    assert chat.conversations(frame(spark, rows)).first().valid is valid


def test_segments_agree_with_conversations(spark):
    rows = frame(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b<|c"), (1, 2, "assistant", "d")]).withColumn("legal", F.lit(1))
    segs = chat.segments(rows).orderBy("turn", "part").collect()
    whole = chat.conversations(rows).first()
    assert "".join(s.text for s in segs) == whole.formatted
    assert [s.legal for s in segs if s.part == 0] == [True, True, False]
    assert [s.text for s in segs if s.loss] == ["b<\\|c", "d"]


def test_no_rows(spark):
    assert chat.conversations(frame(spark, [])).collect() == []


def test_query_holds_the_role_machine(spark):
    from insight.llm.queries import QUERIES
    made = QUERIES["op9_chat_format"](spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan and "system" in plan
    assert {r.valid for r in made.filter("conv_id = -1").collect()} == {True}
