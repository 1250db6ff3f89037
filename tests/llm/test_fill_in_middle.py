"""Fill-in-middle: exact round trips, cuts against plain slicing, awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOC_SCHEMA, awkward, empty, prose
from videonet.llm import fill_in_middle as fim


@pytest.mark.parametrize("size", [0, 1, 15, 16, 17, 255, 256, 257, 5000])
def test_seek_is_the_sum_of_the_widths_before(size):
    widths = np.random.default_rng(size).integers(0, 9, size)
    units = fim.SkipList(widths)
    sums = np.concatenate(([0], np.cumsum(widths)))
    ranks = range(size + 1) if size < 300 else [0, 1, 16, 4095, 4096, 4097, size - 1, size]
    assert [units.seek(rank) for rank in ranks] == sums[list(ranks)].tolist()
    for rank in (-1, size + 1):
        with pytest.raises(IndexError):
            units.seek(rank)


def test_lanes_are_short():
    units = fim.SkipList(np.ones(1_000_000, np.uint8))
    assert [len(points) for points, _ in units.lanes] == [1_000_000, 62_500, 3907, 245, 16]


def test_units_of_a_pattern():
    text = "ab  cde\nf tail"
    assert fim.unit_points(text, r"\w+\s").tolist() == [3, 5, 2]  # blanks before a match belong to it
    out = fim.transform_text(5, text, fim.Settings(unit=r"\w+\s", transformed_percent=100))
    assert out["n_units"] == 3
    assert out["prefix"] + out["middle"] + out["suffix"] == text
    assert len(out["prefix"]) in (0, 3, 8, 10) and len(out["prefix"] + out["middle"]) in (0, 3, 8, 10)


@pytest.mark.parametrize("marks", [("a", "b", "ab"), ("", "b", "c"), ("x", "x", "y"), ("aba", "c", "d"), ("ab", "bc", "d")])
def test_marks_that_could_be_misread_are_refused(marks):
    with pytest.raises(ValueError):
        fim.Settings(prefix_mark=marks[0], suffix_mark=marks[1], middle_mark=marks[2])


def test_round_trip_of_texts_of_mark_letters(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("<PSM> é😀", k=rng.randint(0, 12))) for _ in range(1500)]
    docs = spark.createDataFrame([(i, text, "en", "a", 0) for i, text in enumerate(texts)], DOC_SCHEMA)
    out = fim.restore(fim.fill_in_middle(docs)).collect()
    assert {row["form"] for row in out} == {"plain", "psm", "spm"}
    for row in out:
        text = texts[row["doc_id"]]
        assert row["restored"] == text and row["n_units"] == len(text)
        if row["form"] == "plain":
            assert row["output"] == text and row["prefix"] is None
        else:
            assert row["prefix"] + row["middle"] + row["suffix"] == text and "<P>" in row["output"]
        if any(mark in text for mark in ("<P>", "<S>", "<M>")) or not text:
            assert row["form"] == "plain"


def test_awkward_rows(spark):
    docs = awkward(spark, [(900 + i, "x y " * i, "en", "a", 0) for i in range(40)]).withColumn("output", F.lit(1))
    rows = docs.select("doc_id", "text").collect()
    out = fim.restore(fim.fill_in_middle(docs)).collect()
    assert sorted(map(repr, [(r["doc_id"], r["text"] or "") for r in rows])) == sorted(
        repr((r["doc_id"], r["restored"])) for r in out)


def test_words_as_units_and_own_marks(spark):
    settings = fim.Settings(unit=r"\S+\s*", seed="other", transformed_percent=100, suffix_first_percent=50,
                            prefix_mark="[pre]", suffix_mark="[suf]", middle_mark="[mid]")
    docs = spark.createDataFrame([(i, prose(i, 60), "en", "a", 0) for i in range(60)], DOC_SCHEMA)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = fim.restore(fim.fill_in_middle(docs, settings), settings).collect()
    assert {row["form"] for row in out} == {"psm", "spm"}
    for row in out:
        assert row["restored"] == texts[row["doc_id"]] and row["n_units"] == 60
        assert not row["prefix"] or row["prefix"].endswith(" ") or not row["middle"] + row["suffix"]


def test_empty_table(spark):
    assert fim.restore(fim.fill_in_middle(empty(spark))).count() == 0


def test_a_long_text(spark):
    text = "日本é😀 x" * 700_000
    docs = spark.createDataFrame([(3, text, "en", "a", 0)], DOC_SCHEMA)
    row = fim.restore(fim.fill_in_middle(docs, fim.Settings(transformed_percent=100))).collect()[0]
    assert row["restored"] == text and row["n_units"] == len(text)
