"""Byte assembly of formatted turns against plain joins."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import chat

PIECE = st.sampled_from(["<", "|", "[", "\\", ">", "s>", "/s>", "INST]", "/INST]", "ü", "日", "a", "\n", "<|end|>", "</s>"])
TEXT = st.lists(PIECE, max_size=12).map("".join)
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a<|b", "ß"]), TEXT), min_size=1, max_size=20)


def plain(role, text):
    return b"<|" + chat.escape(role.encode()) + b"|>\n" + chat.escape(text.encode()) + chat.END


@settings(max_examples=300, deadline=None)
@given(TURNS, st.integers(0, 3), st.integers(1, 40))
def test_assembly_is_a_join(turns, skip, chunk):
    was, chat.CHUNK = chat.CHUNK, chunk
    try:
        skip = min(skip, len(turns) - 1)
        roles, texts = (pa.array(x, pa.string())[skip:] for x in zip(*turns))
        buf, offs = chat.assemble(roles, texts)
    finally:
        chat.CHUNK = was
    raw = buf.to_pybytes()
    assert [raw[a:b] for a, b in zip(offs[:-1:3], offs[3::3])] == [plain(r, t) for r, t in turns[skip:]]
    assert [chat.unescape(raw[a:b]).decode() for a, b in zip(offs[1::3], offs[2::3])] == [t for _, t in turns[skip:]]


def test_long_turns_and_clashing_columns(spark, monkeypatch):
    rows = [(1, 0, "user", "x<|" * 700_000, 1, "f"), (1, 1, "assistant", "[/INST]" * 300_000, 2, "g"), (2, None, None, None, 3, None),
            (2, 0, "assistant", "ok", 4, "h"), (2, 0, "assistant", "ok", 4, "h"), (None, 1, "user", "", 5, "i")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, loss_start int, formatted string")
    got = chat.format_turns(df).collect()
    want = sorted(plain(r or "", t or "") for _, _, r, t, _, _ in rows)
    assert sorted(bytes(r.formatted) for r in got) == want
    said = {bytes(r.formatted)[r.loss_start:r.loss_end] for r in got if r.loss_end}
    assert {chat.unescape(x) for x in said} == {b"ok", b"[/INST]" * 300_000}
    n = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digest(chat.format_turns(df)).collect()}
    assert n == {1: (2, 2_100_000), 2: (3, 4), None: (1, 0)}
    assert chat.digest(chat.format_turns(df.limit(0))).count() == 0
