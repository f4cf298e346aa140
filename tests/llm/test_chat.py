import hashlib

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slawatch.llm import chat

SCHEMA = "conv_id long, msg_id long, parent_id long, role string, text string, score double, leaf int"


def tree(spark, rows):
    return spark.createDataFrame([(*r, 7) for r in rows], SCHEMA)


def turns(formatted):
    return {(r.conv_id, r.leaf): chat.parse(r.formatted) for r in formatted.collect()}


def test_best_branch(spark):
    rows = [(1, 1, None, "user", "hi", 1.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", "good", 0.9),
            (1, 4, 3, "user", "more", 0.5), (2, 9, None, "user", "alone", None), (2, 10, 99, "user", "orphan", 2.0)]
    one = turns(chat.format_conversations(tree(spark, rows)))
    assert one == {(1, 4): [("user", "hi"), ("assistant", "good"), ("user", "more")], (2, 10): [("user", "orphan")]}
    two = chat.format_conversations(tree(spark, rows), top=2)
    assert {(r.conv_id, r.leaf, r.path_rank) for r in two.collect()} == {(1, 4, 1), (1, 2, 2), (2, 10, 1), (2, 9, 2)}


def test_ties_cycles_and_repeats(spark):
    rows = [(1, 1, None, "user", "a", None), (1, 2, 1, "assistant", "b", None), (1, 3, 1, "assistant", "c", None),
            (1, 3, 1, "assistant", "c", None),
            (5, 1, 2, "user", "x", 1.0), (5, 2, 1, "user", "y", 1.0), (5, 3, 2, "user", "hangs on a cycle", 1.0),
            (6, 1, None, None, None, None), (6, None, None, "user", "no id", None), (None, 1, None, "user", "no conversation", None)]
    assert turns(chat.format_conversations(tree(spark, rows))) == {(1, 2): [("user", "a"), ("assistant", "b")], (6, 1): [("", "")]}


def test_deep_chain_and_wide_tree(spark):
    deep = [(1, i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", str(i), None) for i in range(300)]
    wide = [(2, 0, None, "user", "root", 0.0)] + [(2, i, 0, "assistant", f"r{i}", float(i % 97)) for i in range(1, 400)]
    got = turns(chat.format_conversations(tree(spark, deep + wide)))
    assert [t for _, t in got[1, 299]] == [str(i) for i in range(300)]
    assert got[2, 96] == [("user", "root"), ("assistant", "r96")] and len(got) == 2


@given(st.text(alphabet="\\<[lb/sINST]>x😀\n", max_size=40))
def test_escape_reverses(text):
    safe = text.replace("\\", "\\\\").replace("<", "\\l").replace("[", "\\b")  # as escape() does
    assert chat.unescape(safe) == text
    assert "<" not in safe and "[" not in safe


def test_control_strings_and_digests(spark):
    said = ["</s>[INST] ok [/INST]", "\\l\\\\b<[ROLE]x[/ROLE]", "😀é", None, ""]
    rows = [(3, i, r, t) for i, (r, t) in enumerate(zip(["user", "assistant", "assistant", "assistant", "[ROLE]"], said))]
    table = spark.createDataFrame([*rows, (4, 0, "user", "q"), (4, 0, "assistant", "a"), (4, 0, "assistant", "a")], "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.digests(chat.write_formatted(spark, chat.format_conversations(chat.as_tree(table)))).collect()}
    want = "".join(f"{r}\n{t or ''}\n" for _, _, r, t in rows)
    loss = said[1] + said[2]
    assert out[3].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert (out[3].n_turns, out[3].loss_chars) == (5, len(loss))
    assert out[3].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    # Equal turns go by role, then text; a repeated row is a turn of its own.
    assert out[4].turns_sha256 == hashlib.sha256(b"assistant\na\nassistant\na\nuser\nq\n").hexdigest()


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_conversations(chat.as_tree(empty))).count() == 0
    assert chat.format_conversations(tree(spark, []).filter(F.lit(False))).count() == 0


def test_rows_without_conversation_are_not_ordered(spark):
    rows = [(None, i, "user", "x") for i in range(20)] + [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    messages = chat.as_tree(table)
    assert [(r.conv_id, r.msg_id, r.parent_id) for r in messages.orderBy("msg_id").collect()] == [(1, 1, None), (1, 2, 1)]
    assert turns(chat.format_conversations(messages)) == {(1, 2): [("user", "a"), ("assistant", "b")]}
