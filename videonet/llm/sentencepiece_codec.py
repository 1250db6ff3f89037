"""SentencePiece encoding and decoding (operator 5).

An Aho-Corasick automaton over the pieces reads a text once; at each position its output links give all pieces
that end there, longest first, and the best way to reach the position is chosen among them:

- Unigram models: the piece with the best sum of scores, which is the Viterbi path.
- BPE models: the piece that stands next to the last piece of the position it starts from, that is, encoding the
  two together gives just these two. Exactly one does, and following them back gives what merging gives. (The sum
  of scores of a BPE model does not tell its segmentation, so scores enter through the merges alone.)

Characters that no piece covers become byte pieces, or the unknown piece where the model has none. No piece
crosses from a character to a following blank, so what lies between is encoded once per worker and remembered.

Both directions agree with the library for models with the identity normaliser; others are refused. Null text
counts as empty and has no ids; null ids decode to the empty string. Repeated rows are treated each. An empty
table gives an empty result. Other columns pass through, except those named like an output, which are replaced.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from videonet.llm.common import arrow_map, schema_with, slices, table
from videonet.llm.registry import query

CACHE_ENTRIES = 400_000
CACHED_LENGTH = 64
BATCH_BYTES = 2 << 20
#: Fixed values of the model format: the blank's sign, piece types, and the penalty of unknown characters.
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0
UNKNOWN_TEXT = " ⁇ "


class PieceCodec:
    """Encoder and decoder for one model file."""

    def __init__(self, model: bytes):
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        rules = spec.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are supported")
        if any(p.type == USER_DEFINED for p in spec.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        if any(re.search(f"[^{BLANK}]{BLANK}", p.piece) for p in spec.pieces if p.type == NORMAL):
            raise ValueError("models whose pieces cross blanks are not supported")
        self._bpe = spec.trainer_spec.model_type == BPE
        if not self._bpe and spec.trainer_spec.model_type != UNIGRAM:
            raise ValueError("only BPE and unigram models are supported")
        self._prefix = BLANK if rules.add_dummy_prefix else ""
        self._scores = {p.piece: p.score for p in spec.pieces if p.type == NORMAL}
        self._ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        unknown = next(i for i, p in enumerate(spec.pieces) if p.type == UNKNOWN)
        self._bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        self._unknown = [unknown]
        self._texts = [
            bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
            else UNKNOWN_TEXT.encode() if p.type == UNKNOWN
            else b"" if p.type == CONTROL
            else p.piece.replace(BLANK, " ").encode()
            for p in spec.pieces
        ]
        self._least = min(self._scores.values(), default=0.0) - UNKNOWN_PENALTY
        self._line_apart = not any("\n" in piece for piece in self._ids)
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for piece in self._ids:
            if not self._bpe or self._merged(piece) == [piece]:
                self._automaton.add_word(piece, piece)
        self._automaton.make_automaton()
        self._pairs: dict[tuple[str, str], bool] = {}
        self._words: dict[str, bytes] = {}

    def _merged(self, text: str) -> list[str]:
        """Plain merging: the neighbours that make the piece with the best score, the leftmost of equal ones."""
        parts = list(text)
        score_of = self._scores.get
        while len(parts) > 1:
            scores = [score_of(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            best = max(scores)
            if best == -np.inf:
                break
            at = scores.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _neighbours(self, left: str, right: str) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) > CACHE_ENTRIES:
                self._pairs.clear()
            # Where the two would make a piece, they cannot stay two.
            known = left + right not in self._scores and self._merged(left + right) == [left, right]
            self._pairs[left, right] = known
        return known

    def _segment_bpe(self, text: str) -> list[str | None]:
        """Pieces of a text; None stands for a character without a piece."""
        size = len(text)
        last: list[str | None] = [None] * (size + 1)
        done = 0
        neighbours = self._neighbours
        for end, piece in self._automaton.iter(text):  # longer pieces first among those with the same end
            end += 1
            if end == done:
                continue
            start = end - len(piece)
            before = last[start]
            if before is None or neighbours(before, piece):
                last[end] = piece
                done = end
        return self._walk(text, last)

    def _segment_unigram(self, text: str) -> list[str | None]:
        size = len(text)
        last: list[str | None] = [None] * (size + 1)
        score = [0.0] + [-np.inf] * size
        at = 0
        for end, piece in [*self._automaton.iter(text), (size, "")]:
            end += 1
            while at < min(end - 1, size):  # positions that no further piece can end at
                at += 1
                if text[at - 1] not in self._scores and score[at - 1] + self._least > score[at]:
                    score[at], last[at] = score[at - 1] + self._least, None
            if piece:
                found = score[end - len(piece)] + self._scores[piece]
                if found > score[end]:
                    score[end], last[end] = found, piece
        return self._walk(text, last)

    @staticmethod
    def _walk(text: str, last: list[str | None]) -> list[str | None]:
        pieces, at = [], len(text)
        while at:
            piece = last[at]
            pieces.append(piece)
            at -= 1 if piece is None else len(piece)
        pieces.reverse()
        return pieces

    def _word_ids(self, word: str) -> bytes:
        pieces = self._segment_bpe(word) if self._bpe else self._segment_unigram(word)
        ids = array("I")
        at = 0
        for piece in pieces:
            if piece is None:
                ids.extend([self._bytes[b] for b in word[at].encode()] if self._bytes else self._unknown)
                at += 1
            else:
                ids.append(self._ids[piece])
                at += len(piece)
        return ids.tobytes()

    def _words_of(self, text: str) -> list[str]:
        """Parts of a text that are encoded on their own: blanks and what follows up to the next blank."""
        first, *rest = text.replace(BLANK, " ").split(" ")
        words = [self._prefix + first, *[BLANK + part for part in rest]]
        if BLANK in words:  # blanks that follow each other or end the text
            joined = [words[0]]
            for word in words[1:]:
                if joined[-1].strip(BLANK):
                    joined.append(word)
                else:
                    joined[-1] += word
            words = joined
        return words

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if not self._line_apart:
            return self._encode_words(self._words_of(text))
        # A line end is in no piece, so lines are encoded on their own; only the first has the prefix.
        words: list[str] = []
        for n, line in enumerate(text.split("\n")):
            own = self._words_of(line)
            if n:
                words.append("\n")
                own[0] = own[0][len(self._prefix):]
            words += own
        return self._encode_words(words)

    def _encode_words(self, words: list[str]) -> bytes:
        found = list(map(self._words.get, words))
        if None in found:
            if len(self._words) > CACHE_ENTRIES:
                self._words.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    word = words[i]
                    ids = self._words.get(word)
                    if ids is None:
                        ids = self._word_ids(word)
                        if len(word) <= CACHED_LENGTH:
                            self._words[word] = ids
                    found[i] = ids
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        text = b"".join(map(self._texts.__getitem__, numbers)).decode("utf-8", "replace")
        return text[1:] if self._prefix and text.startswith(" ") else text


@lru_cache(maxsize=4)
def piece_codec(path: str) -> PieceCodec:
    """One codec per worker process and file."""
    with open(path, "rb") as file:
        return PieceCodec(file.read())


def _with_column(df: DataFrame, source: str, name: str, kind: str, arrow_kind: pa.DataType, make) -> DataFrame:
    rest = df.drop(name) if name != source else df

    def work(batches):
        for batch in slices(batches, source, BATCH_BYTES):
            values = make(batch.column(batch.schema.get_field_index(source)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, arrow_kind)], names=[*batch.schema.names, name]
            )

    return arrow_map(rest, work, schema_with(rest, (name, kind)))


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with the ids of their text, as little-endian unsigned 32-bit numbers."""
    return _with_column(docs, text, ids, "binary", pa.binary(),
                        lambda texts: list(map(piece_codec(model_path).encode, (t or "" for t in texts))))


def decode(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text of their ids."""
    return _with_column(rows, ids, text, "string", pa.string(),
                        lambda lists: list(map(piece_codec(model_path).decode, (x or b"" for x in lists))))


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every text, and whether decoding them gives the text back."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )
