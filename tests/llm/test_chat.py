import hashlib

from hypothesis import given
from hypothesis import strategies as st

from sparkprep.llm.chat import (
    escape, format_conversations, op4_chat_formatting, read_back, read_turns, spans, turn_template, unescape,
)

texts = st.text(alphabet="ab<>\\/turnsays\n é", max_size=30)


@given(st.lists(st.tuples(texts, texts), max_size=5))
def test_round_trip_and_spans(turns):
    whole, found, rewrite = spans(turn_template, turns)
    assert rewrite is None
    assert read_turns(whole) == turns
    assert [unescape(whole[t[3] : t[4]]) for t in found] == [t for _, t in turns]
    assert "".join(whole[t[1] : t[2]] for t in found) == whole


@given(texts)
def test_escape_is_reversible(text):
    assert unescape(escape(text)) == text


def test_history_rewrites_are_detected():
    def only_last_system(turns):
        system = [t for r, t in turns if r == "system"][-1:]
        return "|".join(system) + "".join(f"[{t}]" for r, t in turns if r != "system")

    turns = [("user", "a"), ("assistant", "b"), ("system", "be kind"), ("user", "c")]
    _, found, rewrite = spans(only_last_system, turns)
    assert rewrite == 2
    assert found[1][1:] == (3, 6, 4, 5)
    assert found[2][1] is None


def test_odd_rows(spark):
    rows = [
        (1, 1, "assistant", None), (1, 0, "user", "hi"), (1, 1, "assistant", "again"), (None, 0, "user", "x"),
        (2, None, None, "y"), (2, 0, "assistant", "z"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {r.conv_id: r for r in read_back(format_conversations(df)).collect()}
    assert {k: r.n_turns for k, r in found.items()} == {1: 3, None: 1, 2: 2}
    assert found[1].loss_chars == 5
    said = "\ny\nassistant\nz\n"
    assert found[2].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert read_back(format_conversations(df.limit(0))).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect()
    turns = {-7: [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]}
    for r in rows:
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    found = {r.conv_id: r for r in op4_chat_formatting(spark, sf).collect()}
    assert set(found) == set(turns)
    for conv, said in turns.items():
        r = found[conv]
        digest = hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        loss = "".join(b for a, b in said if a == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(said), digest)
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(turn_template(said))
