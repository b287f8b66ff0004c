from __future__ import annotations

from . import brute
import pyarrow as pa
from hirelens.llm.chat_columns import END, START, assemble, format_and_read, format_chats, parse
from hypothesis import given, settings
from hypothesis import strategies as st

CONTROL = st.text(alphabet="<|>im_startend\\\n a\u00e9", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(CONTROL, CONTROL), max_size=6))
def test_escapes_are_reversible(turns):
    raw, at, first, size = assemble(pa.array([r for r, _ in turns], pa.string()), pa.array([t for _, t in turns], pa.string()))
    assert parse(raw.tobytes()) == [(r.encode(), t.encode()) for r, t in turns]
    assert raw.tobytes().count(START) == raw.tobytes().count(END) == len(turns)


def _rows():
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said), (1, 1, "assistant", None), (1, 0, "user", ""), (1, None, None, "x"), (None, 0, "assistant", "y"), (None, 0, "assistant", "y")]
    rows += [(2, 5, "assistant", "tie b"), (2, 5, "assistant", "tie a"), (2, 5, "user", "z"), (3, 0, "us\ner\\", "<||x<|"), (4, 0, "assistant", "\U0001f600" * 30_000)]
    return rows + [(7, k, "assistant" if k % 2 else "user", f"turn {k} <|im_end|>") for k in range(2000)]


def test_odd_rows(spark):
    rows = _rows()
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string").repartition(5)
    out = {r["conv_id"]: tuple(r)[1:5] for r in format_and_read(df).collect()}
    assert out == brute.chat_digests(rows)


def test_a_long_conversation_is_spread_and_whole(spark):
    rows = [(7, k, "user", f"turn {k}") for k in range(5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = format_chats(df).select("part").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1


def test_formatted_characters(spark):
    df = spark.createDataFrame([(1, 0, "user", "h\u00e9"), (1, 1, "assistant", "<|")], "conv_id long, turn long, role string, text string")
    text = "<|im_start|>user\nh\u00e9<|im_end|>\n<|im_start|>assistant\n<||<|im_end|>\n"
    assert format_and_read(df).first()["formatted_chars"] == len(text)
    f = format_chats(df).first()
    assert bytes(f["formatted"]).decode() == text and f["mask_sizes"] == [3]


def test_empty_table(spark):
    assert format_and_read(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
