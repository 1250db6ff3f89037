"""Chat formatting at the level of tokens (operator 6).

A turn is `### <role>: <text></turn>` and a line end. The three marks of a turn are reserved ids beyond the
vocabulary, spliced between the separately encoded role and text, so no text can produce one. Control strings
inside roles and texts are escaped by a backslash before they are encoded, so the plain string can be parsed as
well. Turns are encoded in parallel, then the rows of a conversation are read in order by one task, which keeps
running sums only: token places and the loss mask come from prefix sums over the lengths of the segments. A
conversation of any length is written as parts of about PART_TOKENS tokens, so no row grows with it. (Digests of
a whole conversation are sequential by nature, so its rows do pass through one task, one batch at a time.)

Turns are ordered by turn, then role, then text; null comes first. Null text or role counts as empty. Null
conv_id is a conversation of its own. Repeated rows are turns of their own. An empty table gives no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.llm.common import arrow_map, slices, table
from videonet.llm.registry import query

#: The marks of the template; their ids follow those of the vocabulary and its end of text.
MARKS = ("### ", ": ", "</turn>\n")
TURN, ROLE_END, TURN_END = 50_257, 50_258, 50_259
LOSS_ROLE = "assistant"
PART_TOKENS = 1 << 16
BATCH_BYTES = 2 << 20
#: The library's pattern fails on white-space runs of about a million characters, so longer ones than this are cut.
SPACE_RUN = 100_000
_ESCAPED = re.compile(r"\\|###|</turn>|:")
_IN_TEXT = re.compile(r"\\|###|</turn>")
_UNESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_SPACES = re.compile(r"\s+")
PARTS = "conv_id long, part long, first_token long, ids binary, loss_mask binary"
READ_BACK = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
             " formatted_chars long")


def escape(text: str, in_role: bool = False) -> str:
    """A backslash before each control string, and before a colon in a role."""
    return (_ESCAPED if in_role else _IN_TEXT).sub(lambda found: "\\" + found[0], text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """A rank file as an encoding without special tokens, one per worker process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(codec: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text in pieces cut inside long white-space runs; decoded one after the other they are the text."""
    if len(text) <= SPACE_RUN:
        return codec.encode_ordinary(text)
    ids, at = [], 0
    for run in _SPACES.finditer(text):
        for cut in range(run.start() + SPACE_RUN, run.end(), SPACE_RUN):
            ids += codec.encode_ordinary(text[at:cut])
            at = cut
    return ids + codec.encode_ordinary(text[at:])


def _encode_turns(path: str, pattern: str):
    def work(batches):
        codec = encoding(path, pattern)
        for batch in slices(batches, "text", BATCH_BYTES):
            ids, lengths = [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                role = role or ""
                head = [TURN, *encode(codec, escape(role, in_role=True)), ROLE_END]
                body = encode(codec, escape(text or ""))
                ids.append(np.array([*head, *body, TURN_END], "<u4").tobytes())
                # Lengths of what is outside, inside and again outside the loss.
                lengths.append([len(head), len(body), 1] if role == LOSS_ROLE else [len(head) + len(body) + 1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.binary()), pa.array(lengths, pa.list_(pa.int32()))],
                names=["conv_id", "turn", "role", "text", "ids", "lengths"],
            )

    return work


def loss_mask(lengths: list[int]) -> np.ndarray:
    """The mask of a turn's tokens from its segments' lengths, of which every second one is in the loss.

    A one is added where such a segment begins and taken away where it ends; the prefix sums are the mask.
    """
    ends = np.cumsum(lengths)
    change = np.zeros(ends[-1] + 1, np.int8)
    np.add.at(change, ends[:-1:2], 1)
    np.add.at(change, ends[1::2], -1)
    return np.cumsum(change[:-1], dtype=np.int8)


def _assemble(batches):
    conv, part, first_token, ids, masks, held, started = None, 0, 0, [], [], 0, False
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    names = ["conv_id", "part", "first_token", "ids", "loss_mask"]

    def row():
        return conv, part, first_token, b"".join(ids), b"".join(masks)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    rows, size = [], 0
    for batch in batches:
        for owner, own, lengths in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if started and (owner != conv or held >= PART_TOKENS):
                rows.append(row())
                size += held
                part, first_token = (0, 0) if owner != conv else (part + 1, first_token + held)
                ids, masks, held = [], [], 0
            conv, started = owner, True
            ids.append(own)
            masks.append(loss_mask(lengths).tobytes())
            held += len(own) // 4
            if size >= PART_TOKENS:
                yield batch_of(rows)
                rows, size = [], 0
    if started:
        rows.append(row())
    if rows:
        yield batch_of(rows)


def format_conversations(turns: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(conv_id, part, first_token, ids, loss_mask) from (conv_id, turn, role, text), conversations in order.

    `ids` are little-endian unsigned 32-bit numbers, `loss_mask` has a byte for each of them; `first_token` is
    the place of the part's first token in its conversation. Rows of a conversation follow each other.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    encoded = arrow_map(
        rows, _encode_turns(ranks_path, pattern),
        "conv_id long, turn long, role string, text string, ids binary, lengths array<int>",
    )
    ordered = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return arrow_map(ordered.select("conv_id", "ids", "lengths"), _assemble, PARTS)


class _Reading:
    """What has been read of one conversation."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self):
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def _read(path: str, pattern: str):
    def work(batches):
        codec = encoding(path, pattern)

        def text(ids: np.ndarray) -> str:
            return codec.decode_bytes(ids.tolist()).decode()

        def add(reading: _Reading, ids: np.ndarray, mask: np.ndarray) -> None:
            starts, role_ends, ends = (np.flatnonzero(ids == mark) for mark in (TURN, ROLE_END, TURN_END))
            for start, role_end, end in zip(starts, role_ends, ends):
                role, body = text(ids[start + 1:role_end]), text(ids[role_end + 1:end])
                reading.turns += 1
                reading.chars += sum(map(len, MARKS)) + len(role) + len(body)
                reading.all.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
            edges = np.flatnonzero(np.diff(mask, prepend=0, append=0))
            for first, last in zip(edges[::2], edges[1::2]):
                learned = unescape(text(ids[first:last]))
                reading.loss_chars += len(learned)
                reading.loss.update(learned.encode())

        reading, done = None, []
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [field.split()[0] for field in READ_BACK.split(", ")]
        for batch in batches:
            for conv_id, ids, mask in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
                if reading is None or conv_id != reading.conv_id:
                    if reading is not None:
                        done.append(reading.row())
                    reading = _Reading(conv_id)
                add(reading, np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.int8))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
                done = []
        if reading is not None:
            done = [reading.row()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    return work


def read_formatted(parts: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digests of formatted conversations, from their tokens and masks alone; parts as they were made, in order."""
    return arrow_map(parts.select("conv_id", "part", "first_token", "ids", "loss_mask"), _read(ranks_path, pattern),
                     READ_BACK)


PROBE = r"\### Assistant: </turn> ok"

SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(role) + len(regexp_extract_all(role, '\\|###|</turn>|:')) + length(text)
                + len(regexp_extract_all(text, '\\|###|</turn>'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query("op6_chat_format", SQL)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    probe = spark.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, LOSS_ROLE, PROBE)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    codec = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return read_formatted(format_conversations(turns, *codec), *codec)
