"""Packing documents into sequences of tokens by minimum bin slack (operator 3).

A document's tokens fill whole sequences first; what is left of each is kept in a pool. A sequence takes the
longest piece of the pool and the multiset of other lengths that comes closest to the room left: a bitset holds
all reachable sums, one shift for each power of two of a length's count, and the steps are walked backwards to
read off how many pieces of each length were used. Room that no sum fills takes the front of another piece, so
only the last sequence of a task has any. These last sequences, one a task, are stored and packed once more,
1,024 tasks' at a time, so there is one padded sequence for about 1,024 tasks.

Null text counts as empty: a document of the end token alone. Repeated rows are documents of their own; null
doc_ids are packed like others. An empty table gives an empty result. Only doc_id and text are read. The pool
holds at most POOL pieces shorter than a sequence, so memory does not grow with the input.
"""

from __future__ import annotations

import os
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.llm.common import arrow_map, slices, store, table
from videonet.llm.registry import query
from videonet.llm.word_bpe import word_model

CAPACITY = 2048
END_ID = 1
POOL = 4096
BATCH_BYTES = 2 << 20
WORD_CACHE_BYTES = 128 << 20
TASKS_MERGED_BITS = 10
_SEQUENCE_BITS = 33
_MERGED = 1 << 62
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long,"
          " open boolean")


def closest_fill(lengths: list[int], count: Callable[[int], int], room: int) -> dict[int, int]:
    """How many pieces of each length to take for the largest sum of at most `room`; lengths are ascending."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for at in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[at]
        left, part = min(count(length), room // length), 1
        while left > 0:
            copies = min(part, left)
            steps.append((length, copies, reach))
            reach |= (reach << (length * copies)) & mask
            left -= copies
            part *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    taken: dict[int, int] = defaultdict(int)
    for length, copies, before in reversed(steps):
        if not before >> total & 1:
            taken[length] += copies
            total -= length * copies
    return dict(taken)


class Pool:
    """Pieces shorter than a sequence, by length, and the rows of the sequences made so far."""

    def __init__(self, first_sequence: int, capacity: int):
        self.capacity = capacity
        self.sequence = first_sequence
        self.pieces: dict[int, list[tuple]] = {}
        self.lengths: list[int] = []  # of the pieces, ascending
        self.size = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        """Give a document's tokens from `start` on; whole sequences are made at once."""
        whole, at = 4 * self.capacity, 0
        while len(ids) - at >= whole:
            self._close([(doc_id, start + at // 4, ids[at:at + whole], doc_tokens)], False)
            at += whole
        if at < len(ids):
            length = (len(ids) - at) // 4
            if length not in self.pieces:
                self.pieces[length] = []
                insort(self.lengths, length)
            self.pieces[length].append((doc_id, start + at // 4, ids[at:] if at else ids, doc_tokens))
            self.size += 1

    def _take(self, length: int) -> tuple:
        stack = self.pieces[length]
        piece = stack.pop()
        if not stack:
            del self.pieces[length]
            del self.lengths[bisect_left(self.lengths, length)]
        self.size -= 1
        return piece

    def _close(self, pieces: list[tuple], is_open: bool) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            length = len(ids) // 4
            self.rows.append((doc_id, start, length, ids, doc_tokens, self.sequence, offset, is_open))
            offset += length
        self.sequence += 1

    def pack(self, keep: int) -> None:
        """Make sequences until at most `keep` pieces are left."""
        while self.size > keep:
            longest = self.lengths[-1]
            chosen = [self._take(longest)]
            room = self.capacity - longest
            taken = closest_fill(self.lengths, lambda length: len(self.pieces[length]), room)
            for length, copies in taken.items():
                chosen += [self._take(length) for _ in range(copies)]
                room -= length * copies
            if room and self.pieces:  # every piece left is longer than the room
                doc_id, start, ids, doc_tokens = self._take(self.lengths[0])
                chosen.append((doc_id, start, ids[:4 * room], doc_tokens))
                self.add(doc_id, start + room, ids[4 * room:], doc_tokens)
                room = 0
            self._close(chosen, room > 0)

    def flush(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        columns = zip(*rows) if rows else [()] * len(kinds)
        names = [field.split()[0] for field in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _pack_texts(path: str, end_id: int, capacity: int):
    end = end_id.to_bytes(4, "little")

    def work(batches):
        pool = Pool(TaskContext.get().partitionId() << _SEQUENCE_BITS, capacity)
        model = word_model(path, WORD_CACHE_BYTES)
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), map(model.encode, texts)):
                pool.add(doc_id, 0, ids + end, len(ids) // 4 + 1)
                if pool.size >= POOL:
                    pool.pack(POOL // 2)
            yield pool.flush()
        pool.pack(0)
        yield pool.flush()

    return work


def _pack_pieces(capacity: int):
    def work(batches):
        pool = Pool(_MERGED | TaskContext.get().partitionId() << _SEQUENCE_BITS, capacity)
        for batch in batches:
            for row in batch.to_pylist():
                pool.add(row["doc_id"], row["start"], row["ids"], row["doc_tokens"])
            if pool.size >= POOL:
                pool.pack(POOL // 2)
            yield pool.flush()
        pool.pack(0)
        yield pool.flush()

    return work


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): one row for each piece of a document.

    `ids` are the piece's tokens as little-endian unsigned 32-bit numbers; `start` counts the document's tokens
    before it, `offset` those of its sequence. The tokenizer is one of word ends that drops white space (see word_bpe).
    """
    tokenizer_path = os.fspath(tokenizer_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = store(arrow_map(rows, _pack_texts(tokenizer_path, end_id, capacity), PIECES), "packed")
    # Sequences that tasks could not fill; which task made one is in the upper bits of its id.
    task_group = F.shiftright("sequence_id", _SEQUENCE_BITS + TASKS_MERGED_BITS)
    rest = first.filter("open").repartition(task_group).sortWithinPartitions("sequence_id", "offset")
    merged = arrow_map(rest, _pack_pieces(capacity), PIECES)
    return first.filter("NOT open").union(merged).drop("open")


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
