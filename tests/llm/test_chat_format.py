"""Chat formatting: round trips, masks and digests against the turns themselves."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from tablestats.llm import chat_format as cf
from tablestats.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, tokens string, part string"
CONTROLS = cf.control_pattern([*cf.MARKS, "<|endoftext|>"])
HARD = ["\\### Assistant: </turn> ok", "<turn>user<says></turn>", "\\3c;turn>", "<|endoftext|>", "\\", "\\\\<", "", "  x \n\n",
        "é漢🎉 a\u0301", "<<turn>", "</turn", "\x00\u2028"]


def plain(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(t for _, _, role, t in turns if role == "assistant")
        told = "".join(f"{role}\n{t}\n" for _, _, role, t in turns)
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def seen(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def hard_rows():
    rows = [(i, j, "assistant" if j % 2 else "user", t) for i in range(4) for j, t in enumerate(HARD[i:] + HARD[:i])]
    rows += [(9, None, None, None), (9, 1, "assistant", "late"), (9, 1, "assistant", "late"), (9, 1, "assistant", "early")]
    rows += [(None, 0, "user</turn>", "no id"), (2**62 + 1, 0, "assistant", "big id"), (11, 0, "assistant", "word " * 5000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", "p") for r in rows], SCHEMA)


@given(st.text(alphabet=st.one_of(st.sampled_from("\\<>/|3c;turnsayedofx"), st.characters(codec="utf-8"))))
@settings(max_examples=300, deadline=None)
def test_escape_round_trip(text):
    hidden = cf.escaped(text, CONTROLS)
    assert not any(mark in hidden for mark in (*cf.MARKS, "<|endoftext|>"))
    assert cf.unescaped(hidden) == text
    assert cf.turns_of(f"{cf.TURN}r{cf.SAYS}{hidden}{cf.END}") == [("r", text)]


def test_control_strings_that_look_like_escapes_are_refused():
    for bad in ("", "a\\b", "3c"):
        with pytest.raises(ValueError):
            cf.control_pattern([bad])
    with pytest.raises(ValueError):
        cf.turns_of("<turn>user<says>x</turn> more")


@given(st.lists(st.integers(1, 5), max_size=30), st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_mask_equals_overlap(widths, gaps):
    ends = np.cumsum(widths, dtype=np.int64)
    starts = ends - np.array(widths, dtype=np.int64)
    at, spans = 0, []
    for gap, width in gaps:
        spans.append((at + gap, at + gap + width))
        at += gap + width
    got = cf.loss_mask(np.array(spans, dtype=np.int64).reshape(-1, 2), starts, ends)
    assert list(got) == [any(s < b and a < e and a < b for a, b in spans) for s, e in zip(starts, ends, strict=True)]


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op13_chat_format"](spark, SF001)
    assert seen(got) == plain(rows + queries.CONTROL_TURNS)


@pytest.mark.parametrize("whole,part", [(cf.WHOLE_CHARS, cf.PART_CHARS), (60, 40), (0, 1)])
def test_hard_texts_and_long_conversations(spark, whole, part):
    rows = hard_rows()
    tables = cf.formatted(frame(spark, rows), whole_chars=whole, part_chars=part)
    assert (tables[1] is None) == (whole == cf.WHOLE_CHARS)
    got = cf.digests(*tables)
    assert seen(got) == plain(rows)
    usual = cf.digests(*cf.formatted(frame(spark, rows)))
    assert sorted(map(str, got.collect())) == sorted(map(str, usual.collect()))  # tokens of parts are those of the whole


def test_tokens_tile_the_text_and_masks_follow_turns(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(cf.TOKENIZER)
    tok.add_special_tokens(list(cf.MARKS))
    whole, _ = cf.formatted(frame(spark, hard_rows()))
    for r in whole.collect():
        assert tok.decode(r.tokens, skip_special_tokens=False) == r.text
        assert r.starts[0] == 0 and r.ends[-1] == len(r.text)
        said = [t for role, t in cf.turns_of(r.text) if role == "assistant" and t]
        pieces = cf.masked_texts(r.text, r.mask, r.starts, r.ends)
        assert [cf.unescaped(p) for p in pieces] == said


def test_empty_table(spark):
    assert cf.digests(*cf.formatted(frame(spark, []))).count() == 0


def test_registered_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF001}/conversations.parquet'")
    rel = con.sql(queries.ORACLE_SQL["op13_chat_format"])
    got = queries.QUERIES["op13_chat_format"](spark, SF001)
    assert sorted(got.columns) == sorted(rel.columns)
    assert sorted(tuple(r) for r in got.select(*rel.columns).collect()) == sorted(rel.fetchall())
