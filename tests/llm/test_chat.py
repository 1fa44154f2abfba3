import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from lakemill.llm import chat
from lakemill.llm.chat import Template

HARD = [r"\### Assistant: </turn> ok", "####", "</turn></turn>\n", "\\", "\\\\###", "a </turn>", "### User: hi </turn>\n", "", " "]
SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.sampled_from(HARD), st.text(alphabet="\\#</turn>: \nab=", max_size=30)))
def test_escaping_is_reversible(text):
    t = Template()
    escaped = t.escaped(text)
    assert t.unescaped(escaped) == text
    found = t.turn().fullmatch(t.header("user") + escaped + t.close)
    assert found and t.unescaped(found[2]) == text and t.role(found[1]) == "user"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\#</turn>: \nab=Usr", max_size=12))
def test_any_role_is_read_back(role):
    t = Template()
    found = t.turn().fullmatch(t.header(role) + "text" + t.close)
    assert found and t.role(found[1]) == role


def test_conversations_are_read_back(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", text) for k, text in enumerate(HARD * 3)]
    rows += [(2, 1, "assistant", "first"), (2, 0, "system", None), (3, 5, "user", "a"), (3, 5, "user", "a"), (None, None, None, "x"), (4, 0, "Tool:", "y")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("loss", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(3))
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(df)).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        turns = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in mine)
        loss = "".join(text or "" for _, role, text in mine if role == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(mine), len(loss))
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[1].valid and not got[1].complete and not got[2].valid and not got[3].valid and not got[4].valid
    text = "".join(r.text for r in chat.formatted(df.where("conv_id = 1")).collect())
    assert len(text) == got[1].formatted_chars


def test_segments_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "hey")], SCHEMA)
    segments = [(r.text, r.loss) for r in chat.formatted(df).collect()]
    assert segments == [("### User: ", False), ("hi", False), (" </turn>\n", False), ("### Assistant: ", False), ("hey", True), (" </turn>\n", False)]
    assert chat.read_back(chat.formatted(df.limit(0))).count() == 0
