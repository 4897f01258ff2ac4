from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revmart.llm import chat_format as op

MARKS = op.Template().marks()


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows],
                                 "conv_id long, turn long, role string, text string, seq string, segments string, state string")


def read_back(spark, rows):
    out = op.parse_chats(op.format_chats(turns(spark, rows)))
    return {r["conv_id"]: r for r in out.collect()}


def test_orders_and_flags(spark):
    rows = [(1, 1, "assistant", "A"), (1, 0, "user", "U"), (2, 0, "system", "S"), (2, 1, "user", "U"), (2, 2, "assistant", "A"),
            (3, 0, "assistant", "A"), (4, 0, "user", "U"), (4, 1, "user", "U"), (4, 2, "assistant", "A"), (5, 0, "user", None),
            (6, 0, None, "?"), (6, 1, "tool", "T"), (7, 0, "user", "x"), (7, 0, "user", "x"), (None, 0, "user", "n"), (None, 1, "assistant", "n")]
    got = read_back(spark, rows)
    assert {k: (r["valid"], r["first_violation"]) for k, r in got.items()} == {
        1: (True, None), 2: (True, None), 3: (False, 1), 4: (False, 2), 5: (False, None), 6: (False, 1), 7: (False, 2), None: (True, None)}
    assert [tuple(t) for t in got[6]["turns"]] == [("", "?"), ("tool", "T")]
    assert [tuple(t) for t in got[7]["turns"]] == [("user", "x")] * 2
    assert got[1]["formatted"] == "<s>[INST]U[/INST][OUT]A</s>"
    assert [s["text"] for s in got[2]["segments"] if s["loss"]] == ["A"]
    assert all(r["formatted"] == "".join(s["text"] for s in r["segments"]) for r in got.values())


def test_control_strings_survive(spark):
    nasty = ["".join(MARKS), "<\\s>", "</\\\\s>[\\INST]", "[/INST", "]<", "a" * 50_000 + "</s>", "\\", "", "[[INST]]<<s>>"]
    rows = [(k, j, r, t) for k, t in enumerate(nasty) for j, r in enumerate(("user", "assistant", "[ROLE]" + t[:40]))]
    got = read_back(spark, rows)
    for k, t in enumerate(nasty):
        assert [tuple(x) for x in got[k]["turns"]] == [("user", t), ("assistant", t), ("[ROLE]" + t[:40], t)]
        inner = got[k]["segments"][2]["text"]
        assert not any(m in inner for m in MARKS)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="<[]/\\sINSTOUTROLE>\n", max_size=40), min_size=30, max_size=30))
def test_escape_is_reversible(spark, texts):
    t = op.Template()
    df = spark.createDataFrame([(x,) for x in texts], "text string").withColumn("e", op.escape(F.col("text"), t))
    for r in df.withColumn("u", op.unescape(F.col("e"), t)).collect():
        assert r["u"] == r["text"] and not any(m in r["e"] for m in MARKS)


def test_empty_table(spark):
    assert op.format_chats(turns(spark, [])).count() == 0


def test_no_python_on_the_path(spark):
    plan = op.parse_chats(op.format_chats(turns(spark, [(1, 0, "user", "U")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
