"""Tokens, packing and chat formatting against the libraries and direct answers."""

import hashlib
import random
import time
import zlib
from array import array
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, empty, prose
from videonet.llm import byte_bpe, chat, packing, sentencepiece_codec, token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CHAT = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SYLLABLES = [" ", " ", "  ", "\n", "\t", "'", "re", "s", "ll", "the", "ing", "é", "日", "😀", "!", ".", ", ", "12", "A",
             "<|endoftext|>", "ÉÀ", "\x1c", " ", "é", "ΣΑΣ", "x" * 30]
FIXED = ["", " ", "   b", "a  b ", "x\n\ny", "it's we're 're ''re", "  <|endoftext|>  <|endoftext|>x", "a\n b", "A.B, c. d,"]


def _texts(count, seed):
    rng = random.Random(seed)
    return FIXED + ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 14))) for _ in range(count)]


def test_every_prefix_has_the_count_of_the_library():
    counter, library = byte_bpe.PrefixCounter(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    for text in _texts(250, 1) + [prose(3, 60), "ab" * 60]:
        prefixes = [text[:i] for i in range(len(text) + 1)]
        wanted = [len(e.ids) for e in library.encode_batch(prefixes, add_special_tokens=False)]
        assert counter.prefix_counts(text).tolist() == wanted, text


def test_counts_do_not_depend_on_the_cache(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 5)
    counter, library = byte_bpe.PrefixCounter(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    for text in _texts(60, 2):
        assert counter.prefix_counts(text)[-1] == len(library.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_awkward_rows(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    counted = token_counts.prefix_tokens(awkward(spark).select("*"), BYTE_BPE)
    rows = counted.select("doc_id", "n_bytes", token_counts.tokens_of().alias("n"),
                          token_counts.tokens_of(F.lit(5)).alias("five"),
                          token_counts.longest_within(3).alias("cut")).collect()
    by_id = {r["doc_id"]: r for r in awkward(spark).select("doc_id", "text").collect()}
    assert len(rows) == awkward(spark).count()
    for row in rows:
        text = by_id[row["doc_id"]]["text"] or ""
        size = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(min(len(text), 40) + 1)]
        assert row["n_bytes"] == len(text.encode())
        assert row["n"] == len(library.encode(text, add_special_tokens=False).ids)
        assert row["five"] == size[min(5, len(text))]
        assert row["cut"] == max(i for i, n in enumerate(size) if n <= 3)
    assert token_counts.prefix_tokens(empty(spark), BYTE_BPE).count() == 0


def test_closest_fill_is_the_best_subset_sum():
    rng = random.Random(5)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        room = rng.randint(1, 60)
        taken = packing.closest_fill(sorted(counts), counts.__getitem__, room)
        best = max(total for copies in product(*[range(n + 1) for n in counts.values()])
                   if (total := sum(c * k for c, k in zip(copies, counts))) <= room)
        assert sum(length * n for length, n in taken.items()) == best
        assert all(0 < n <= counts[length] for length, n in taken.items())


def test_a_document_of_millions_of_tokens_in_linear_time():
    ids = np.arange(8_000_000, dtype=np.uint32).tobytes()
    pool = packing.Pool(0, 2048)
    start = time.monotonic()
    pool.add(5, 0, ids, 8_000_000)
    assert time.monotonic() - start < 1
    assert pool.size == 1 and len(pool.rows) == 8_000_000 // 2048
    assert b"".join(row[3] for row in pool.rows) + pool.pieces[8_000_000 % 2048][0][2] == ids
    assert [row[1] for row in pool.rows[:3]] == [0, 2048, 4096]


@pytest.mark.parametrize("pool", [4096, 8])
def test_packing(spark, monkeypatch, pool):
    monkeypatch.setattr(packing, "POOL", pool)
    docs = awkward(spark, [(1000 + i, prose(i, 1 + 37 * i % 900), "en", "a", 0) for i in range(60)])
    library = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack(docs, WORD_BPE, capacity=256).collect()
    wanted = {}
    for doc in docs.collect():
        ids = library.encode(doc["text"] or "", add_special_tokens=False).ids + [1]
        wanted.setdefault(doc["doc_id"], []).append(ids)
    covered = {}
    for row in rows:
        ids = list(array("I", row["ids"]))
        doc = wanted[row["doc_id"]][0]
        assert ids == doc[row["start"]:row["start"] + row["length"]] and row["doc_tokens"] == len(doc)
        covered.setdefault(row["doc_id"], []).extend(range(row["start"], row["start"] + row["length"]))
    for doc_id, copies in wanted.items():
        assert sorted(covered[doc_id]) == sorted(list(range(len(copies[0]))) * len(copies))
    sequences = {}
    for row in rows:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    sizes = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        sizes.append(at)
    assert max(sizes) <= 256 and sum(size < 256 for size in sizes) <= 1
    assert packing.pack(empty(spark), WORD_BPE).count() == 0


def _unigram_model():
    """The pieces of the given model as a unigram one; without runs of blanks, whose scores are no log-probabilities."""
    spec = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as file:
        spec.ParseFromString(file.read())
    spec.trainer_spec.model_type = sentencepiece_codec.UNIGRAM
    kept = [p for p in spec.pieces if p.score > -1e6]
    del spec.pieces[:]
    spec.pieces.extend(kept)
    return spec.SerializeToString()


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_pieces_are_those_of_the_library(kind):
    if kind == "bpe":
        with open(PIECES, "rb") as file:
            model = file.read()
    else:
        model = _unigram_model()
    codec, library = sentencepiece_codec.PieceCodec(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for text in _texts(400, 6) + [prose(7, 400), " " * 45 + "a" + " " * 33, "▁x▁ y"]:
        if kind == "unigram" and "▁" in text:
            continue
        ids = codec.encode(text)
        assert list(array("I", ids)) == library.encode(text), text
        assert codec.decode(ids) == library.decode(library.encode(text)), text


def test_round_trip_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, PIECES), PIECES).collect()
    assert len(rows) == docs.count()
    assert all(row["decoded"] == (row["text"] or "") for row in rows)
    assert sentencepiece_codec.encode(empty(spark), PIECES).count() == 0


TURNS = "conv_id long, turn long, role string, text string, part int, lengths int"


def _conversations():
    nasty = r"\### Assistant: </turn> ok \\### #### </turn></turn> \:"
    rows = [(1, 2, "user", "b", 0, 0), (1, 0, "system", None, 0, 0), (1, 1, "assistant", nasty, 0, 0),
            (2, 0, "assistant", "", 0, 0), (2, 0, "assistant", "", 0, 0), (2, None, "tool: x", nasty, 0, 0),
            (None, 0, None, "no id 日😀", 0, 0), (3, 0, "assistant", prose(1, 40_000), 0, 0)]
    return rows + [(4, i, ("user", "assistant")[i % 2], prose(i, 50), 0, 0) for i in range(900)]


def test_chat_round_trip(spark, monkeypatch):
    rows = _conversations()
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    parts = chat.format_conversations(turns, *CHAT)
    assert parts.filter("conv_id = 4").count() > 1
    found = {r["conv_id"]: r for r in chat.read_formatted(parts, *CHAT).collect()}
    none_first = lambda value: (value is not None, value or 0)
    by_conv = {}
    for row in sorted(rows, key=lambda r: (none_first(r[1]), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or ""))):
        by_conv.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    assert set(found) == set(by_conv)
    for conv_id, pairs in by_conv.items():
        learned = "".join(text for role, text in pairs if role == "assistant")
        got = found[conv_id]
        assert got["n_turns"] == len(pairs)
        assert got["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in pairs).encode()).hexdigest()
        assert (got["loss_chars"], got["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        plain = "".join(f"### {chat.escape(r, True)}: {chat.escape(t)}</turn>\n" for r, t in pairs)
        assert got["formatted_chars"] == len(plain)
    assert chat.format_conversations(spark.createDataFrame([], TURNS), *CHAT).count() == 0


def test_white_space_runs_of_any_length_are_encoded():
    codec = chat.encoding(*CHAT)
    for run in (" " * 2_000_000, "\n" * 2_000_000, "\t \r\n" * 500_000):
        for text in (run, f"a{run}b c", f"a {run[:chat.SPACE_RUN]}{run[:chat.SPACE_RUN]}"):
            assert codec.decode_bytes(chat.encode(codec, text)).decode() == text


def test_chat_of_a_long_white_space_run(spark):
    text = "before" + " " * 2_000_000 + "after"
    turns = spark.createDataFrame([(1, 0, "assistant", text, 0, 0)], TURNS)
    row = chat.read_formatted(chat.format_conversations(turns, *CHAT), *CHAT).first()
    assert (row["loss_chars"], row["loss_sha256"]) == (len(text), hashlib.sha256(text.encode()).hexdigest())


def test_parts_and_masks(spark):
    turns = spark.createDataFrame(_conversations(), TURNS)
    rows = chat.format_conversations(turns, *CHAT).filter("conv_id = 4").orderBy("part").collect()
    at = 0
    for i, row in enumerate(rows):
        ids, mask = np.frombuffer(row["ids"], "<u4"), np.frombuffer(row["loss_mask"], np.int8)
        assert (row["part"], row["first_token"], len(mask)) == (i, at, len(ids))
        assert set(ids[mask == 1].tolist()).isdisjoint({chat.TURN, chat.ROLE_END, chat.TURN_END})
        at += len(ids)


def test_escaping_is_reversible_and_hides_control_strings():
    rng = random.Random(8)
    for _ in range(2000):
        text = "".join(rng.choices(["\\", "#", "##", "</turn>", "<", ":", " ", "a", "###"], k=rng.randint(0, 9)))
        for in_role in (False, True):
            assert chat.unescape(chat.escape(text, in_role)) == text
    assert zlib.crc32(chat.escape("plain").encode()) == zlib.crc32(b"plain")


def test_loss_mask():
    assert chat.loss_mask([2, 3, 1]).tolist() == [0, 0, 1, 1, 1, 0]
    assert chat.loss_mask([2, 0, 1]).tolist() == [0, 0, 0]
    assert chat.loss_mask([4]).tolist() == [0] * 4
