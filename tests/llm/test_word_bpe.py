"""Word-end byte-pair encoding against the library and plain merging."""

import hashlib
import json
import random
import time
from array import array

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, empty, prose
from videonet.llm import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
SYLLABLES = [" ", " ", "  ", "\n", "\t", "'", "re", "s", "'S", "the", "ing", "é", "日", "😀", "!", ".", ", ", "12", "A", "½",
             "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "ÉÀ", "\x1c", "\x85", "\xa0", " ", "é",
             "J̌", "İ", "İ", "ΣΑΣ", "x" * 30, "aaaa", "anan", "--", "%", "​"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    return word_bpe.WordModel(PATH)


def _ids(model, text):
    return array("I", model.encode(text)).tolist()


def test_ids_and_decoded_texts_are_those_of_the_library(model, library):
    rng = random.Random(2)
    texts = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 14))) for _ in range(3000)]
    texts += ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 40))) for _ in range(3000)]
    texts += ["", " ", "a" * 500, "=" * 301, "ab" * 400, prose(4, 300)]
    for text, theirs in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = _ids(model, text)
        assert ids == theirs.ids, text
        assert model.decode(ids) == library.decode(theirs.ids, skip_special_tokens=False)


def _small(path, merges):
    """A vocabulary over a and b with the given merges."""
    symbols = ["a", "b", "a</w>", "b</w>"]
    vocab = {token: i for i, token in enumerate(dict.fromkeys(symbols + ["".join(pair) for pair in merges]))}
    spec = json.loads(open(PATH, encoding="utf-8").read())
    spec["added_tokens"] = []
    spec["model"] |= {"vocab": vocab, "merges": [list(pair) for pair in merges]}
    path.write_text(json.dumps(spec))
    return str(path)


def test_small_vocabularies_with_overlapping_merges(tmp_path):
    """Vocabularies trained on random texts of two letters, so that ties and equal merges decide."""
    for seed in range(40):
        rng = random.Random(seed)
        words = [list("".join(rng.choices("ab", k=rng.randint(1, 30)))) for _ in range(30)]
        words = [word[:-1] + [word[-1] + "</w>"] for word in words]
        merges = []
        for _ in range(rng.randint(1, 14)):
            counts = {}
            for word in words:
                for pair in zip(word, word[1:]):
                    counts[pair] = counts.get(pair, 0) + 1
            if not counts:
                break
            best = max(sorted(counts), key=counts.get)
            merges.append(best)
            for word in words:
                at = 0
                while at < len(word) - 1:
                    if (word[at], word[at + 1]) == best:
                        word[at:at + 2] = ["".join(best)]
                    at += 1
        path = _small(tmp_path / f"{seed}.json", merges)
        model, theirs = word_bpe.WordModel(path), Tokenizer.from_file(path)
        for _ in range(150):
            text = "".join(rng.choices("ab", k=rng.randint(1, 25)))
            assert _ids(model, text) == theirs.encode(text, add_special_tokens=False).ids, (merges, text)


def test_each_prefix_has_one_last_token(model):
    """Of the tokens that end at a prefix, exactly one stands next to the last token of the prefix before it."""
    symbols = "internationalisation"
    last = {0: ""}
    for end in range(1, len(symbols) + 1):
        fit = [symbols[start:end] for start in range(end) if symbols[start:end] in model._ids and (
            start == 0 or model.compatible(last[start], symbols[start:end]))]
        assert len(fit) == 1
        last[end] = fit[0]


def test_a_word_of_a_million_letters_in_linear_time(model):
    letters = "".join(random.Random(8).choices("abcdefgh", k=1_000_000))
    model.encode(letters[:10_000])
    start = time.monotonic()
    ids = _ids(model, letters)
    assert time.monotonic() - start < 30
    assert "".join(model.written[i].removesuffix("</w>") for i in ids) == letters


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(word_bpe, "CACHE_ENTRIES", 50)
    monkeypatch.setattr(word_bpe, "PAIRS_KEPT", 20)
    small, text = word_bpe.WordModel(PATH), prose(3, 600)
    assert _ids(small, text) == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert len(small._known) <= 50 and len(small._pairs) <= 20


def test_long_parts_are_not_kept(monkeypatch, library):
    texts = ["\u4e2d\u6587" * 1000 + " short", "a" * 65 + " short", "\u65e5\u672c " * 40 + "b" * 5000]
    for most in (word_bpe.CACHE_BYTES, 500):
        monkeypatch.setattr(word_bpe, "CACHE_BYTES", most)
        own = word_bpe.WordModel(PATH)
        for text in [*texts, *texts[::-1], *(f"new{i} words{i}" for i in range(50)), *texts]:
            assert _ids(own, text) == library.encode(text, add_special_tokens=False).ids
            assert max(map(len, own._known), default=0) <= word_bpe.LONGEST_KEPT
            assert own._held <= most + 1000


def test_awkward_rows(spark, library):
    docs = awkward(spark).withColumn("ids", F.lit(1))
    rows = docs.select("doc_id", "text").collect()
    out = word_bpe.decode(word_bpe.encode(docs, PATH), PATH).collect()
    wanted = []
    for row in rows:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        wanted.append((row["doc_id"], ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(repr, wanted)) == sorted(repr((r["doc_id"], r["ids"], r["decoded"])) for r in out)


def test_empty_table_and_null_ids(spark):
    assert word_bpe.decode(word_bpe.encode(empty(spark), PATH), PATH).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert word_bpe.decode(none, PATH).collect()[0]["decoded"] == ""


def test_query_digests_equal_those_of_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = word_bpe.op11_word_bpe(spark, sf_dir).collect()
    assert len(out) == len(texts)
    for row in out:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())
