r"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole with marks around each turn, encoded once with
character offsets, and the sorted spans of its assistant texts are intersected with
the sorted spans of its tokens by binary search; the tokens inside carry the
loss.  The marks are special tokens of the vocabulary, so that no token crosses one.

Texts and roles are escaped reversibly: a backslash stands before every backslash and
after the first character of every control string (ours and those of other
templates), so that no text can pose as a mark.

A conversation is rendered in parts of up to ``PART_TURNS`` turn numbers: as marks are
tokens of their own, the parts' renderings and encodings, end to end, are the whole
conversation's.  So a conversation of any length is encoded by many tasks; within a
task rows stream by, and at most ``PART_TURNS`` turns or ``PART_CHARS`` characters are held.

Defined results: turns in order of turn number, then role, then text (NULL first); a NULL
text or role is empty; repeated rows are turns of their own; rows without conversation id are one
conversation; an empty table gives an empty result.  Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PART_TURNS, PART_CHARS = 64, 1 << 20
#: Control strings that texts may not hold unescaped ("<|" covers all of that form).
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
_ESCAPE = re.compile(r"(\\)|(<)(?=\||/?s>)|(\[)(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_RENDERED = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string of (role, text) turns, and the spans of the assistant's texts in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns that a formatted string was rendered from."""
    return [(unescape(r), unescape(t)) for r, t in _RENDERED.findall(formatted)]


@lru_cache(maxsize=2)
def encoder(path: str):
    """The vocabulary with our marks as special tokens; offsets keep leading spaces."""
    from tokenizers import Tokenizer, processors

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([TURN, TEXT, END])
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


def mask_of(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """1 for every token that overlaps a span; both sorted."""
    s = np.array(spans, np.int64).reshape(-1, 2)
    first, last = np.searchsorted(ends, s[:, 0], side="right"), np.searchsorted(starts, s[:, 1], side="left")
    edge = np.zeros(len(starts) + 1, np.int64)
    filled = s[:, 0] < s[:, 1]
    np.add.at(edge, first[filled], 1)
    np.add.at(edge, last[filled], -1)
    return (np.cumsum(edge[:-1]) > 0).astype(np.int8)


def masked_spans(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Character spans of the runs of tokens under the mask."""
    edge = np.flatnonzero(np.diff(np.r_[0, mask, 0]))
    return [{"start": int(starts[a]), "end": int(ends[b - 1])} for a, b in zip(edge[::2], edge[1::2])]


FORMATTED = ("part long, piece int, n_turns long, formatted string, ids array<int>, loss_mask array<byte>, "
             "loss_spans array<struct<start:int,end:int>>")


def format_conversations(df: DataFrame, path: str, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Parts of conversations, in order of (part, piece): the formatted text, its token ids, the loss mask
    over tokens, and the character spans under the mask."""
    rows = df.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    id_type = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(-(1 << 62))))
    order = ["conv_id", "part", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(),
             F.col("text").asc_nulls_first()]
    rows = rows.repartition("conv_id", "part").sortWithinPartitions(*order).select("conv_id", "part", "role", "text")
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_kind = None

        def made(held: list) -> pa.RecordBatch:
            rendered = [render(turns) for *_, turns in held]
            encoded = encoder(path).encode_batch([text for text, _ in rendered], add_special_tokens=False)
            ids, masks, spans = [], [], []
            for (_, of), e in zip(rendered, encoded):
                offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
                mask = mask_of(of, offsets[:, 0], offsets[:, 1])
                ids.append(e.ids)
                masks.append(mask)
                spans.append(masked_spans(mask, offsets[:, 0], offsets[:, 1]))
            return pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in held], id_kind), pa.array([h[1] for h in held], pa.int64()),
                 pa.array([h[2] for h in held], pa.int32()), pa.array([len(h[3]) for h in held], pa.int64()),
                 pa.array([t for t, _ in rendered], pa.string()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(masks, pa.list_(pa.int8())), pa.array(spans, spans_type)],
                names=["conv_id", "part", "piece", "n_turns", "formatted", "ids", "loss_mask", "loss_spans"])

        held, key, piece, chars, total = [], None, 0, 0, 0
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for conv, part, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                role, text = role or "", text or ""
                fresh = key != (conv, part) or not held and not total
                if fresh or len(held[-1][3]) >= PART_TURNS or chars + len(text) > PART_CHARS:
                    piece = 0 if fresh else piece + 1
                    if total > PART_CHARS:
                        yield made(held)
                        held, total = [], 0
                    key, chars = (conv, part), 0
                    held.append((conv, part, piece, []))
                held[-1][3].append((role, text))
                chars += len(text)
                total += len(text)
        if held:
            yield made(held)

    return rows.mapInArrow(run, f"conv_id {id_type}, {FORMATTED}")


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its formatted parts alone: n_turns, turns_sha256 (role, newline, text, newline per
    turn), loss_chars, loss_sha256 (the text under the loss mask), formatted_chars.

    Parts stream by in order; a digest is all that is held of a conversation.
    """
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    rows = (formatted.select("conv_id", "part", "piece", "formatted", "loss_spans").repartition("conv_id")
            .sortWithinPartitions("conv_id", "part", "piece").select("conv_id", "formatted", "loss_spans"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, kind, out = None, None, None, []

        def done() -> tuple:
            n, turns, chars, loss, total = state
            return key, n, turns.hexdigest(), chars, loss.hexdigest(), total

        def flush() -> pa.RecordBatch:
            ids, *rest = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), *map(pa.array, rest)], names=[
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != key:
                    if state is not None:
                        out.append(done())
                        if len(out) >= 10_000:
                            yield flush()
                            out = []
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for s in spans:
                    said = unescape(text[s["start"]:s["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
        if state is not None:
            out.append(done())
            yield flush()

    return rows.mapInArrow(run, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long")
