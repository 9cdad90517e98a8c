"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole into one string, encoded once with offsets, and the sorted spans of its assistant
texts are intersected with the sorted token spans by binary search: those tokens carry the loss.

Template: user turns are ``[INST] text [/INST]``, assistant turns ``<s> text </s>``, any other role
``<<role>> text <</>>``, with a line feed between turns. Control strings inside texts and roles are escaped with a
backslash (``unescape`` gives them back exactly), so a text cannot close its own turn.

A conversation is one training example and one output row; rows arrive sorted by turn and are streamed, and tokens stay
in numpy arrays: a task holds conversations of about SLICE characters at a time, or one longer one. The mask is kept as
one range of tokens per assistant text; a token at a text's edge may also hold a blank of the template, so the text under
the mask is what the masked tokens cover of the spans.

Defined cases: a null text or role counts as empty; rows with a null conv_id form one conversation; turns that tie are
ordered by role and text (nulls first), and repeated rows are repeated turns; a very long text is encoded whole and its
offsets are read PART tokens at a time; an empty table gives an empty result; extra columns are left out, so clashing
names do no harm.
"""

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table

#: What may not stand inside a text as it is, by the letter that its escape uses.
_CONTROL = re.compile(r"\\|\[(?=/?INST\])|<(?=/?s>)|<(?=<)|>(?=>)")
_LETTER = {"\\": "\\", "[": "b", "<": "l", ">": "g"}
_BACK = {v: k for k, v in _LETTER.items()}
_ESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]|<s> (?P<assistant>.*?) </s>|<<(?P<role>.*?)>> (?P<other>.*?) <</>>", re.S)
#: Characters that are held at a time, rows that are turned into Python texts at once, and tokens whose offsets are.
SLICE, ROWS, PART = 1 << 20, 256, 1 << 16

_LISTS = ("token_ids", "token_starts", "token_ends", "loss_starts", "loss_ends", "loss_from", "loss_to")
#: Assistant text i stands at loss_starts[i] to loss_ends[i] and under the tokens from loss_from[i] to loss_to[i] - 1.
FORMATTED = "conv_id long, formatted string, " + ", ".join(f"{n} array<int>" for n in _LISTS)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + _LETTER[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: _BACK[m[1]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The conversation's string and the spans of its assistant texts."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        inner = escape(text)
        head, tail = ("[INST] ", " [/INST]") if role == "user" else ("<s> ", " </s>") if role == "assistant" else (f"<<{escape(role)}>> ", " <</>>")
        piece = ("\n" if parts else "") + head
        if role == "assistant":
            starts.append(at + len(piece))
            ends.append(at + len(piece) + len(inner))
        piece += inner + tail
        parts.append(piece)
        at += len(piece)
    return "".join(parts), starts, ends


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a rendered conversation."""
    for m in _TURN.finditer(formatted):
        role = unescape(m["role"]) if m["role"] is not None else "user" if m["user"] is not None else "assistant"
        yield role, unescape(next(x for x in (m["user"], m["assistant"], m["other"]) if x is not None))


def encode(tokenizer, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token ids, starts and ends of a text that is encoded once; only PART tokens are Python objects at a time."""
    encoded = tokenizer.encode(text, add_special_tokens=False)
    encoded.truncate(PART)  # what is cut off stays, as further parts
    ids, spans = [], []
    for part in (encoded, *encoded.overflowing):
        ids.append(np.array(part.ids, np.int32))
        spans.append(np.fromiter(chain.from_iterable(part.offsets), np.int32, 2 * len(ids[-1])).reshape(-1, 2))
    every = np.concatenate(spans)
    return np.concatenate(ids), every[:, 0], every[:, 1]


def mask(starts: np.ndarray, ends: np.ndarray, loss_starts: np.ndarray, loss_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each loss span the range of tokens that share a character with it; an empty span has an empty range."""
    first = np.searchsorted(ends, loss_starts, side="right")
    last = np.searchsorted(starts, loss_ends, side="left")
    return first.astype(np.int32), np.where(loss_ends > loss_starts, np.maximum(first, last), first).astype(np.int32)


def loss_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, spans: Iterator[tuple[int, int, int, int]]) -> Iterator[str]:
    """What the masked tokens of each span (start, end, first token, last token) cover of it, unescaped."""
    for a, b, first, last in spans:
        if first < last:
            left, right = np.maximum(starts[first:last], a), np.maximum.accumulate(np.minimum(ends[first:last], b))
            # Tokens that part a character overlap; a gap between tokens would be left out.
            gaps = np.flatnonzero(left[1:] > right[:-1])
            edges = zip(left[np.append(0, gaps + 1)].tolist(), right[np.append(gaps, -1)].tolist(), strict=True)
            yield unescape("".join(formatted[x:y] for x, y in edges))


def _conversations(batches: Iterator[pa.RecordBatch]):
    """(conv_id, turns) of rows that arrive sorted."""
    key, turns = None, None
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            for conv, role, text in zip(*(part.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
                if turns is not None and conv != key:
                    yield key, turns
                    turns = None
                key, turns = conv, turns or []
                turns.append((role or "", text or ""))
    if turns is not None:
        yield key, turns


def _ragged(parts: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(p) for p in parts])), pa.int32()), pa.array(np.concatenate(parts), pa.int32()))


def format_conversations(conversations: DataFrame, path: str) -> DataFrame:
    """One row per conversation: its string, its tokens with offsets, the spans of the loss and its mask (FORMATTED)."""

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # special strings in a text are ordinary text
        rows, size = [], 0

        def out() -> pa.RecordBatch:
            conv, formatted, *lists = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(formatted, pa.string()), *map(_ragged, lists)], names=["conv_id", "formatted", *_LISTS])

        for conv, turns in _conversations(batches):
            formatted, *loss = render(turns)
            ids, starts, ends = encode(tokenizer, formatted)
            loss_starts, loss_ends = (np.array(x, np.int32) for x in loss)
            rows.append((conv, formatted, ids, starts, ends, loss_starts, loss_ends, *mask(starts, ends, loss_starts, loss_ends)))
            size += len(formatted)
            if size > SLICE:
                yield out()
                rows.clear()
                size = 0
        if rows:
            yield out()

    rows = conversations.select(F.col("conv_id").cast("long"), "turn", "role", "text")
    # A whole conversation is one row in the end, so its turns meet in one task; the sort lets that task stream them.
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(rendered, FORMATTED)


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests per conversation, read back from the formatted rows alone."""
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = {n: (batch.column(n).offsets.to_numpy(), batch.column(n).values.to_numpy()) for n in _LISTS}
            rows = []
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                one = batch.column("formatted")[i].as_py()
                _, starts, ends, *spans = (flat[at[i] : at[i + 1]] for at, flat in lists.values())
                turns, all_turns, loss, chars = 0, hashlib.sha256(), hashlib.sha256(), 0
                for role, text in parse(one):
                    turns += 1
                    all_turns.update(f"{role}\n{text}\n".encode())
                for text in loss_texts(one, starts, ends, zip(*(s.tolist() for s in spans), strict=True)):
                    chars += len(text)
                    loss.update(text.encode())
                rows.append((conv, turns, all_turns.hexdigest(), chars, loss.hexdigest(), len(one), len(starts), int((spans[3] - spans[2]).sum())))
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if "sha" in n else pa.int64()) for n, c in zip(names, columns, strict=True)], names=names)

    return formatted.mapInArrow(read, ", ".join(f"{n} {'string' if 'sha' in n else 'long'}" for n in names))


def op9_chat_format(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    probe = spark.sql("select -1L conv_id, posexplode(array('user', 'assistant')) as (turn, role), '</s>[INST] ok [/INST]' text")
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = rows.unionByName(probe.withColumn("turn", F.col("turn").cast("long")))
    return digest(stored(format_conversations(rows, str(public_tokenizers.path("byte_bpe_50k.json"))), "op9-formatted"))


SQL: dict[str, str] = {}
QUERIES = {"op9_chat_format": op9_chat_format}
