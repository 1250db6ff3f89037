"""Encoding and decoding with word-end byte-pair encoding by a prefix programme (operator 11).

A word is a row of symbols: its bytes as letters, the last one marked as the word's end. A list of tokens is the
encoding of its symbols if each token encodes to itself and no merge that byte-pair encoding would have done earlier
crosses two neighbours. Hence each prefix has one last token only: the one that ends there and is compatible with
the last token of the prefix before it. An automaton over all tokens reports, symbol by symbol, those that are
suffixes of the prefix; the one that passes the pair test is stored, and following the stored tokens back from the
word's end gives the ids.

Words are encoded once per worker and remembered. What lies between blanks is a stretch of words of its own for the
tokenizer: texts that Latin-1 can write are cut into words here, stretches of other texts by the library's
normalizer and splitter, so that composed letters and lower case are as its own tables have them. Special strings in
texts are special tokens, none are added, nothing is cut or padded.

Null text counts as empty: no ids, and an empty text when decoded. Repeated rows are encoded each; an empty table
gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from videonet.llm.byte_bpe import byte_letters
from videonet.llm.common import arrow_map, slices, store, table
from videonet.llm.registry import query

BATCH_BYTES = 1 << 20
IDS_AT_ONCE = 1 << 16
#: Memory of a worker: entries and bytes of remembered words, longest word kept, remembered pair tests.
CACHE_ENTRIES = 800_000
CACHE_BYTES = 64 << 20
LONGEST_KEPT = 48
PAIRS_KEPT = 1_000_000
_ENTRY_BYTES = 160  # places in the dictionary, headers of key and value

WORD_END = "</w>"
#: A letter at the end of a word is the letter this far on.
_END_SHIFT = 0x1000

LOWER = bytes(ord(chr(byte).lower()) for byte in range(256))
# The tokenizer's pattern for words, restricted to lower-case Latin-1. Letters come first, as no other
# alternative begins with one.
LATIN_WORDS = re.compile(
    rb"[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    rb"|[^\t-\r \x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+"
)


#: Bytes as kinds: letters and digits, full stops and commas, white space, all others.
_KINDS = bytes(
    ord(" ") if byte in b"\t\n\x0b\x0c\r " else ord(".") if byte in b".," else
    ord("a") if re.fullmatch(rb"[a-z0-9\xaa\xb5\xba\xdf-\xf6\xf8-\xff]", bytes([byte])) else ord("p")
    for byte in range(256)
)


def latin_stretches(data: bytes) -> list[bytes]:
    """Stretches of whole words of a lower-case Latin-1 text, in order.

    Where no full stop or comma touches another sign, each is a word of its own, and the text is cut at blanks after
    blanks are set around them; else it is cut into its words.
    """
    kinds = data.translate(_KINDS)
    if b".." in kinds or b".p" in kinds or b"p." in kinds:
        return LATIN_WORDS.findall(data)
    return data.replace(b".", b" . ").replace(b",", b" , ").split()


class WordModel:
    """The tokens of one vocabulary file and the words encoded so far."""

    def __init__(self, path: str, cache_bytes: int | None = None):
        self._cache_bytes = cache_bytes
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model.get("end_of_word_suffix") != WORD_END or model["type"] != "BPE":
            raise ValueError(f"{path} holds no byte-pair encoding with word ends")
        library = Tokenizer.from_file(path)
        self._normalize = library.normalizer.normalize_str
        self._split = library.pre_tokenizer.pre_tokenize_str
        letters = byte_letters()
        self._latin = {byte: "".join(letters[part] for part in chr(byte).encode()) for byte in range(256)}
        self._ids = {self._symbols(token): number for token, number in model["vocab"].items()}
        #: For each pair of tokens that merges: the rank of the merge.
        self._ranks: dict[tuple[str, str], int] = {}
        #: For each token: the rank of the merge that makes it, and its two halves.
        self._made: dict[str, tuple[int, str, str]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            left, right = self._symbols(left), self._symbols(right)
            self._ranks[left, right] = rank
            self._made.setdefault(left + right, (rank, left, right))
        self._specials = {token["content"]: token["id"] for token in spec["added_tokens"]}
        found = "|".join(re.escape(special) for special in sorted(self._specials, key=len, reverse=True))
        self._special = re.compile(f"({found})") if found else None
        self.written = {number: token for token, number in model["vocab"].items()}
        self.written |= {number: special for special, number in self._specials.items()}
        self._pairs: dict[int, bool] = {}  # by both ids
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        # Of each token: its symbols, their number, its id, and the id as the left part of a key of _pairs.
        for token in self._ids:
            if len(token) == 1 or self._whole(token):
                number = self._ids[token]
                self._automaton.add_word(token, (token, len(token), number, number << 32))
        self._automaton.make_automaton()
        self._known: dict[bytes | str, bytes] = {}
        self._held = 0

    def _symbols(self, token: str) -> str:
        """A vocabulary entry as symbols."""
        if len(token) > len(WORD_END) and token.endswith(WORD_END):
            body = token[:-len(WORD_END)]
            return body[:-1] + chr(ord(body[-1]) + _END_SHIFT)
        return token

    def _whole(self, token: str) -> bool:
        """Whether a token's symbols encode to the token: the merge that makes it joins compatible halves."""
        made = self._made.get(token)
        if made is None:
            return False
        rank, left, right = made
        return (len(left) == 1 or self._whole(left)) and (len(right) == 1 or self._whole(right)) and (
            self._unmerged_before(left, right, rank))

    def _unmerged_before(self, left: str, right: str, bound: int) -> bool:
        """Whether merging leaves the border between two tokens alone as long as ranks are below `bound`.

        The later one of the tokens that touch the border is taken apart, until single symbols are left; at
        each step a merge of the two that ranks before what was taken apart would have come first.
        """
        ranks, made = self._ranks, self._made
        while True:
            rank = ranks.get((left, right))
            if rank is not None and rank < bound:
                return False
            of_left = made[left][0] if len(left) > 1 else -1
            of_right = made[right][0] if len(right) > 1 else -1
            if of_left < 0 and of_right < 0:
                return True
            if of_left >= of_right:
                # At equal ranks the left one of two equal merges is done first, so the right one is taken apart first.
                if of_left == of_right:
                    bound, right = of_right, made[right][1]
                else:
                    bound, left = of_left, made[left][2]
            else:
                # A merge across the border of the same rank stands to the left of the one taken apart.
                bound, right = of_right + 1, made[right][1]

    def compatible(self, left: str, right: str) -> bool:
        """Whether two tokens may stand side by side."""
        return self._unmerged_before(left, right, len(self._ranks))

    def _test(self, left: tuple, right: tuple) -> bool:
        """The same for entries of the automaton, remembered."""
        if len(self._pairs) >= PAIRS_KEPT:
            self._pairs = {}
        fits = self._pairs[left[3] | right[2]] = self.compatible(left[0], right[0])
        return fits

    def word_ids(self, symbols: str) -> array:
        """The ids of one word, given as its symbols."""
        size = len(symbols)
        last: list = [None] * (size + 1)  # the last token of each prefix
        known = self._pairs.get
        done = 0
        for end, token in self._automaton.iter(symbols):  # of those with the same end the longer ones first
            end += 1
            if end == done:
                continue
            start = end - token[1]
            if start:
                left = last[start]
                fits = known(left[3] | token[2])
                if fits is None:
                    fits = self._test(left, token)
                    known = self._pairs.get
                if not fits:
                    continue
            last[end] = token
            done = end
        if done != size:
            raise ValueError("a symbol is not in the vocabulary")
        ids, at = [], size
        while at:
            token = last[at]
            ids.append(token[2])
            at -= token[1]
        ids.reverse()
        return array("I", ids)

    def _word(self, letters: str) -> bytes:
        return self.word_ids(letters[:-1] + chr(ord(letters[-1]) + _END_SHIFT)).tobytes()

    def learn(self, stretch: bytes | str) -> bytes:
        """Ids of a stretch of whole words in lower-case Latin-1, or of one between blanks that may hold special strings."""
        if isinstance(stretch, bytes):
            words = (stretch,) if stretch.isalpha() else LATIN_WORDS.findall(stretch)
            return b"".join(self._word(word.decode("latin-1").translate(self._latin)) for word in words)
        if self._special is not None and self._special.search(stretch):
            parts = self._special.split(stretch)
            return b"".join(
                array("I", [self._specials[part]]).tobytes() if i % 2 else self._words(part)
                for i, part in enumerate(parts)
            )
        return self._words(stretch)

    def _words(self, stretch: str) -> bytes:
        return b"".join(self._word(word) for word, _ in self._split(self._normalize(stretch)) if word)

    def _remember(self, stretch: bytes | str) -> bytes:
        ids = self.learn(stretch)
        if len(stretch) <= LONGEST_KEPT:
            self._held += _ENTRY_BYTES + len(stretch) + len(ids)
            if len(self._known) >= CACHE_ENTRIES or self._held > (self._cache_bytes or CACHE_BYTES):
                self._known, self._held = {}, 0
            self._known[stretch] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special strings."""
        try:
            words = latin_stretches(text.encode("latin-1").translate(LOWER))
        except UnicodeEncodeError:
            words = re.split(r"[\t-\r ]+", text)
        found = list(map(self._known.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    word = words[i]
                    ids = self._known.get(word)
                    found[i] = self._remember(word) if ids is None else ids
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """The text's ids as unsigned 32-bit numbers, in the machine's byte order."""
        if self._special is None or not any(special in text for special in self._specials):
            return self._plain(text)
        parts = self._special.split(text)
        return b"".join(
            array("I", [self._specials[part]]).tobytes() if i % 2 else self._plain(part)
            for i, part in enumerate(parts)
        )

    def decode(self, ids: list[int]) -> str:
        """The tokens as written in the vocabulary with a blank between two, as the library gives without a decoder."""
        return " ".join(map(self.written.__getitem__, ids))


@lru_cache(maxsize=1)
def word_model(path: str, cache_bytes: int | None = None) -> WordModel:
    """One model per worker process."""
    return WordModel(path, cache_bytes)


@lru_cache(maxsize=1)
def written_tokens(path: str) -> pa.Array:
    """The tokens of a vocabulary file as written, by id; null where there is none."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    written = {number: token for token, number in spec["model"]["vocab"].items()}
    written |= {token["id"]: token["content"] for token in spec["added_tokens"]}
    return pa.array([written.get(number) for number in range(max(written) + 1)], pa.large_string())


def _encode(path: str):
    def work(batches):
        model = word_model(path)
        for batch in slices(batches, "text", BATCH_BYTES):
            found = [model.encode(text or "") for text in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *(len(ids) // 4 for ids in found)], dtype=np.int32)
            values = np.frombuffer(b"".join(found), np.uint32).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["doc_id", "ids"]
            )

    return work


def _of_size(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about so many ids; a longer list stands alone."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(batch.column(1)), 0).to_pylist()
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += size + 1
    if sizes:
        yield batch.slice(first)


def _decode(path: str):
    def work(batches):
        tokens = written_tokens(path)
        for batch in batches:
            for part in _of_size(batch, IDS_AT_ONCE):
                lists = part.column(1)
                ends = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy().cumsum()
                each = pa.LargeListArray.from_arrays(
                    pa.array([0, *ends.tolist()], pa.int64()), tokens.take(pa.compute.list_flatten(lists)))
                texts = pa.compute.binary_join(each, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=["doc_id", "ids", "decoded"])

    return work


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, in order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, _encode(os.fspath(tokenizer_path)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids, decoded): the text that each list of ids stands for; null ids are an empty list."""
    rows = encoded.select("doc_id", "ids")
    return arrow_map(rows, _decode(os.fspath(tokenizer_path)), "doc_id long, ids array<int>, decoded string")


@query("op11_word_bpe")
def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    decoded = decode(store(encode(table(spark, sf_dir, "documents"), path), "word-ids"), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
