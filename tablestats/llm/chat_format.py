r"""Conversations as training text: one string, its tokens and a loss mask per token.

A whole conversation is rendered, ``<turn>role<says>text</turn>`` for each turn
in order, and encoded once; the tokenizer gives each token's span of code
points.  Spans of the trained roles' texts and token spans are both sorted, so
a binary search finds the first and last token that each text meets, and those
carry the mask.  The three marks are added to the tokenizer as special tokens,
so no token reaches over a mark: a mask covers a text wholly or not at all.

Inside roles and texts a backslash is doubled, and wherever one of the marks or
of the tokenizer's own special strings begins, its first character is written as
``\`` + hexadecimal code point + ``;``.  So no text can close its turn, open
another one or make a special token, and ``unescaped`` gives every text back.

Scale: turns are dealt by conversation, sorted, and streamed through
``Renderer``, which holds one conversation at a time.  A conversation of more
than ``WHOLE_CHARS`` (none, as a rule; they are counted first) is dealt by
ranges of its turns over many tasks instead and comes in several parts that
break between turns; since special tokens stand there, the parts' tokens are
those of the whole.  The vocabulary (a file of a few MB, ``tokenizer``) is read
once and broadcast; nothing is trained, and no row passes through the driver.

Defined cases: a null text or role is empty; turns go by ``turn`` (null first),
then role, then text; repeated turns are as many turns; a null conv_id is one
conversation; an empty table has no conversations; an empty text takes no token;
a single turn of any length is encoded whole, in one task; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestats.llm.common import small_batches, small_side, written

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

# The template's marks.
TURN, SAYS, END = "<turn>", "<says>", "</turn>"
MARKS = (TURN, SAYS, END)

#: The role whose texts carry the loss.
LOSS_ROLES = ("assistant",)
#: Code points of roles, texts and marks up to which a conversation is rendered in one piece.
WHOLE_CHARS = 1 << 20
#: Code points after which a part of a longer one ends, and after which rows are handed on.
PART_CHARS = 1 << 16
#: Code points of the marks of a turn.
MARK_CHARS = sum(map(len, MARKS))

PARTS = ("conv_id long, text string, tokens array<int>, mask array<boolean>, "
         "starts array<int>, ends array<int>")
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_tokens long, n_loss_tokens long")

_PIECE = re.compile(f"{TURN}(.*?){SAYS}(.*?){END}", re.DOTALL)
_ESCAPE = re.compile(r"\\(?:\\|([0-9a-f]+);)")


def control_pattern(strings: Sequence[str]) -> re.Pattern:
    """Matches a backslash, and the first character of each control string wherever one begins."""
    for s in strings:
        if not s or "\\" in s or s[0] in "0123456789abcdef;":
            raise ValueError(f"the control string {s!r} can't be told from an escape")
    return re.compile("|".join([r"\\", *(f"{re.escape(s[0])}(?={re.escape(s[1:])})" for s in strings)]), re.DOTALL)


def escaped(text: str, controls: re.Pattern) -> str:
    return controls.sub(lambda m: "\\\\" if m[0] == "\\" else f"\\{ord(m[0]):x};", text)


def unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else "\\", text)


def turns_of(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    out, at = [], 0
    for m in _PIECE.finditer(text):
        if m.start() != at:
            break
        out.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError("not a formatted text")
    return out


def loss_mask(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True for the tokens that meet a span of ``spans`` (rows of start, end); all sorted."""
    mask = np.zeros(len(starts), dtype=bool)
    spans = spans[spans[:, 0] < spans[:, 1]] if len(spans) else spans.reshape(0, 2)
    first = np.searchsorted(ends, spans[:, 0], side="right")
    last = np.searchsorted(starts, spans[:, 1], side="left")
    for a, b in zip(first, last, strict=True):
        mask[a:b] = True
    return mask


def masked_texts(text: str, mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """The pieces of ``text`` under each run of masked tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], np.asarray(mask, dtype=np.int8), [0]))))
    return [text[starts[a]:ends[b - 1]] for a, b in edges.reshape(-1, 2)]


@lru_cache(maxsize=2)
def _loaded(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are what runs in parallel
    from tokenizers import AddedToken, Tokenizer

    tok = Tokenizer.from_str(vocabulary)
    tok.no_truncation()
    tok.no_padding()
    own = [t.content for t in tok.get_added_tokens_decoder().values() if t.content not in MARKS]
    tok.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in MARKS])
    return tok, control_pattern([*MARKS, *own])


def framed(rows: list[tuple], schema: str) -> pd.DataFrame:
    """``rows`` with the columns of ``schema``; ids stay whole numbers beside nulls."""
    columns = zip(*rows, strict=True) if rows else [()] * len(schema.split(", "))
    out = {c.split()[0]: list(values) for c, values in zip(schema.split(", "), columns, strict=True)}
    return pd.DataFrame(out | {"conv_id": pd.array(out["conv_id"], dtype="Int64")})


class Renderer:
    """Rows of turns, sorted by conversation, to rows of ``PARTS``; ``most``: code points after which a part ends."""

    def __init__(self, vocabulary, most: int | None):
        self.vocabulary, self.most = vocabulary, most

    def __call__(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, controls = _loaded(self.vocabulary.value)
        now, begun = None, False
        pieces: list[str] = []
        spans: list[tuple[int, int]] = []
        length = held = 0
        done: list[tuple] = []

        def close() -> None:
            nonlocal pieces, spans, length, held
            done.append((now, "".join(pieces), np.array(spans, dtype=np.int64).reshape(-1, 2)))
            held += length
            pieces, spans, length = [], [], 0

        def handed() -> pd.DataFrame:
            nonlocal done, held
            rows = []
            for (conv, text, own), code in zip(done, tok.encode_batch([d[1] for d in done], add_special_tokens=False), strict=True):
                offsets = np.array(code.offsets, dtype=np.int32).reshape(-1, 2)
                starts, ends = offsets[:, 0], offsets[:, 1]
                rows.append((conv, text, np.array(code.ids, dtype=np.int32), loss_mask(own, starts, ends), starts.copy(), ends.copy()))
            done, held = [], 0
            return framed(rows, PARTS)

        for batch in batches:
            for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"], strict=True):
                conv = None if conv is None else int(conv)
                if begun and (conv != now or (self.most is not None and length >= self.most)):
                    close()
                    if held >= PART_CHARS:
                        yield handed()
                now, begun = conv, True
                pieces += [TURN, escaped(role, controls), SAYS, escaped(text, controls), END]
                start = length + sum(map(len, pieces[-5:-2]))
                stop = start + len(pieces[-2])
                if role in LOSS_ROLES:
                    spans.append((start, stop))
                length = stop + len(END)
        if begun:
            close()
        if done:
            yield handed()


def formatted(conversations: DataFrame, tokenizer: str = TOKENIZER, whole_chars: int = WHOLE_CHARS,
              part_chars: int = PART_CHARS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ``PARTS``: whole conversations, one row each, and the parts of those beyond ``whole_chars``.

    The second table (None if there are none) has a column ``part``: parts of a conversation stand in its order."""
    spark = conversations.sparkSession
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    # As text on the way through pandas: whole numbers with nulls would become floats there.
    turns = conversations.select(F.col("conv_id").cast("long").cast("string").alias("conv_id"), "turn",
                                 *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = ["conv_id", "turn", "role", "text"]
    chars = F.sum(F.length("role") + F.length("text") + MARK_CHARS)
    long = written(turns.groupBy("conv_id").agg(chars.alias("chars")).where(F.col("chars") > whole_chars)
                   .select("conv_id"), "long")
    n_long = long.count()
    usual = turns
    if n_long:
        both = turns.alias("t").join(small_side(long.alias("l"), n_long), F.col("t.conv_id").eqNullSafe(F.col("l.conv_id")), "left_anti")
        usual = both.select(*order)
    whole = (usual.repartition("conv_id").sortWithinPartitions(*order)
             .mapInPandas(Renderer(vocabulary, None), PARTS))
    if not n_long:
        return whole, None
    split = turns.alias("t").join(small_side(long.alias("l"), n_long), F.col("t.conv_id").eqNullSafe(F.col("l.conv_id")), "left_semi")
    dealt = split.select(*order, F.monotonically_increasing_id().alias("tie")).repartitionByRange(*order, "tie")
    parts = written(dealt.sortWithinPartitions(*order, "tie").mapInPandas(Renderer(vocabulary, part_chars), PARTS)
                    .withColumn("part", F.monotonically_increasing_id()), "parts")
    return whole, parts


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of ``PARTS``, parts of a conversation one after another, to a row of ``DIGESTS`` each."""
    now, sums, rows = None, None, []

    def closed() -> tuple:
        turns, loss, counts = sums
        return (now, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), *counts[2:])

    for batch in batches:
        for row in batch.itertuples(index=False):
            conv = None if row.conv_id is None else int(row.conv_id)
            if sums is None or conv != now:
                if sums is not None:
                    rows.append(closed())
                now, sums = conv, (hashlib.sha256(), hashlib.sha256(), [0, 0, 0, 0, 0])
            turns, loss, counts = sums
            for role, text in turns_of(row.text):
                turns.update(f"{role}\n{text}\n".encode())
                counts[0] += 1
            mask = np.asarray(row.mask, dtype=bool)
            for piece in masked_texts(row.text, mask, row.starts, row.ends):
                said = unescaped(piece)
                loss.update(said.encode())
                counts[1] += len(said)
            counts[2] += len(row.text)
            counts[3] += len(mask)
            counts[4] += int(mask.sum())
        if len(rows) >= 1000:
            yield framed(rows, DIGESTS)
            rows = []
    if sums is not None:
        rows.append(closed())
        yield framed(rows, DIGESTS)


def digests(whole: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """``DIGESTS`` of every conversation, read back from its formatted text, spans and mask.

    Parts are streamed through one hash in order, a batch of them held at a time."""
    named = F.col("conv_id").cast("string").alias("conv_id")
    columns = [c.split()[0] for c in PARTS.split(", ")][1:]
    out = whole.select(named, *columns).mapInPandas(_digested, DIGESTS)
    if parts is None:
        return out
    joined = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").select(named, *columns)
    return out.unionByName(joined.mapInPandas(_digested, DIGESTS))
