"""Phrases against direct counting, with all ways to find them."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOC_SCHEMA, awkward, empty, prose
from videonet.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def direct(rows, longest, least_count, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least_count}
        chosen = []
        for phrase, a in candidates.items():
            if any(len(other) > len(phrase) and 100 * b >= 50 * a and any(
                    other[i:i + len(phrase)] == phrase for i in range(len(other))) for other, b in candidates.items()):
                continue
            cuts = [(1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            chosen.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(chosen)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def _docs(spark, seed=3, docs=60):
    rng = random.Random(seed)
    words = ["Up", "to", "the", "é", "日本", "x", "new", "york", "City", "of", "😀"]
    rows = []
    for i in range(docs):
        parts = [rng.choice(["new york city", "up to", rng.choice(words), rng.choice(words)]) for _ in range(40)]
        text = "".join(part + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "!? "]) for part in parts)
        rows.append((i, text, rng.choice(["en", "fr", None, ""]), "a", 0))
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(5)


def _found(df):
    return sorted(tuple(row) for row in df.collect())


# Small blocks cut pieces; a small bitmap leaves the semi-joins to shuffles; names of few bits need other seeds.
@pytest.mark.parametrize("longest, settings", [
    (3, {}), (3, {"block_words": 7}), (3, {"most_bits": 1}), (2, {"block_words": 5, "most_bits": 1}),
    (4, {}), (5, {"most_bits": 1, "block_words": 9}), (4, {"most_bits": 1 << 7}), (3, {"name_bits": 10}), (3, {"top": 4})])
def test_equals_direct_counting(spark, monkeypatch, longest, settings):
    monkeypatch.setattr(co, "SEEDS", 200)
    docs = _docs(spark)
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    wanted = direct(rows, longest, 5, settings.get("top", 2000))
    assert len(wanted) > 10
    assert _found(co.collocations(docs, longest, 5, **{"top": 2000, **settings})) == wanted


def test_long_texts_are_cut_into_stretches_and_blocks(spark, monkeypatch):
    text = prose(3, 40_000, 30)  # one piece
    assert b"".join(co._stretches(b"ab cd" * 900_000)) == b"ab cd" * 900_000
    docs = spark.createDataFrame([(1, text, "en", "a", 0), (2, "x" * 3_000_000, "en", "a", 0)], DOC_SCHEMA)
    wanted = direct([(text, "en"), ("x", "en")], 3, 10, 2000)
    assert _found(co.collocations(docs, block_words=1000)) == wanted


def test_one_block_goes_on_in_the_next(monkeypatch):
    monkeypatch.setattr(co, "STRETCH_BYTES", 4)
    block = co._Block(0)
    block.add("en", b"a b c d")
    assert block.last_words(2) == [("en", b"c"), ("en", b"d")]
    block.add("en", b" . e")
    assert block.last_words(3) == [("en", b"e")]
    block.end_piece()
    assert block.last_words(3) == []


def test_places_and_merge_join():
    places, names = np.array([0, 1, 2, 5, 6, 9]), [np.array([10, 11, 12, 13, 14, 15])]
    places, names = co.merge_join(places, names)
    assert places.tolist() == [0, 1, 5] and [c.tolist() for c in names] == [[10, 11, 13], [11, 12, 14]]
    places, names = co.merge_join(places, names)
    assert places.tolist() == [0] and [c.tolist() for c in names] == [[10], [11], [12]]


def test_awkward_rows(spark):
    more = [(50 + i, "same words here. Same words", None if i % 2 else "en", "a", 0) for i in range(30)]
    docs = awkward(spark, more).withColumn("name", F.lit("x")).withColumn("f", F.lit(1))
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert _found(co.collocations(docs)) == direct(rows, 3, 10, 2000)


def test_empty_tables(spark):
    assert co.collocations(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, 0), (2, " . ", "en", None, 0)], DOC_SCHEMA)
    assert co.collocations(blank).count() == 0


def test_scores_beyond_64_bits(spark):
    """Products of counts are formed in wide decimals."""
    big = 4_000_000_000_000
    names = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 2, big)], "lang string, word string, name long, f long")
    row = names.selectExpr(
        "cast((cast(1000000 AS decimal(38, 0)) * f * f) div (cast(f AS decimal(38, 0)) * f) AS bigint) AS s").first()
    assert row["s"] == 1_000_000
