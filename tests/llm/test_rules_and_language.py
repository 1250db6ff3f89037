"""Quality rules against plain Python; held-out accuracy of the language network."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOC_SCHEMA, awkward, empty, prose
from videonet.llm import language_id, quality_rules
from videonet.llm.common import store
from videonet.llm.quality_rules import FENCES, MEASURES, MIN_DOCS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.1"


def _measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def _extra():
    loop = "one two three four five six " * 3
    return [
        (20, loop + prose(2, 80), "en", "a", 0), (21, "\n".join([prose(3, 12)] * 3), "en", "a", 0),
        (22, "### " * 30 + prose(4, 40), "en", "a", 0), (23, "a a a a a a a a a a a", "de", None, 0),
        (24, (prose(5, 9) + "\n") * 2 + prose(6, 200), "en", "b", 0), (25, "w " * 3000, "fr", "c", 0),
    ]


def test_measures(spark):
    docs = awkward(spark, _extra())
    for row in quality_rules.measure(docs).collect():
        got = row[MEASURES]
        for name, value in _measures(row["text"]).items():
            assert got[name] == value, (name, row["doc_id"])


def _corpus(spark):
    rows = []
    for i in range(260):
        lang, source = ("en", "de")[i % 2], f"s{i % 3}" if i < 250 else "rare"
        text = prose(i, 30 + i)
        if i % 17 == 3:
            text = text.replace(" ", "### ")
        if i % 23 == 5:
            text = text.replace(" ", "longlonglonglong ")
        rows.append((i, text, lang, source, 0))
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(4)


def _bin(value):
    return value - value % (1 << max(0, len(bin(value)) - 2 - 6))


def _limits(rows):
    """Quartiles of each group's bins, from whole sorted lists."""
    rules = {
        "word_length": lambda m: 100 * m["word_chars"] // m["n_words"],
        "symbols": lambda m: 1000 * m["n_symbols"] // m["n_words"],
        "dup_lines": lambda m: 1000 * m["n_dup_lines"] // max(1, m["n_lines"]),
    }
    limits = {}
    good = [r for r in rows if not r["base_failed"]]
    for lang, source in {(r["lang"], r["source"]) for r in good}:
        for members in (
            [r for r in good if (r["lang"], r["source"]) == (lang, source)], [r for r in good if r["lang"] == lang], good
        ):
            if len(members) >= MIN_DOCS or members is good:
                break
        for rule, (times, least) in FENCES.items():
            bins = sorted(_bin(rules[rule](m)) for m in members)
            low, high = bins[-(-len(bins) // 4) - 1], bins[-(-3 * len(bins) // 4) - 1]
            reach = times * max(high - low, least)
            limits[lang, source, rule] = (low - reach, high + high // 32 + reach, rules[rule])
    return limits


def test_verdicts(spark):
    docs = _corpus(spark)
    rows = [dict(_measures(r["text"]), lang=r["lang"], source=r["source"], doc_id=r["doc_id"], n_lines=1)
            for r in docs.collect()]
    limits = _limits(rows)
    wanted = {
        m["doc_id"] for m in rows if not m["base_failed"] and all(
            limits[m["lang"], m["source"], rule][0] <= limits[m["lang"], m["source"], rule][2](m)
            <= limits[m["lang"], m["source"], rule][1] for rule in FENCES)
    }
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == wanted
    assert 0 < len(wanted) < len(rows)


def test_sketches_merge_by_adding(spark):
    """Sketches of two halves added up are the sketch of the whole."""
    measured = store(quality_rules.measure(_corpus(spark)), "measured")
    whole = quality_rules.sketches(measured)
    halves = quality_rules.sketches(measured.filter("doc_id % 2 = 0")).union(
        quality_rules.sketches(measured.filter("doc_id % 2 = 1")))
    added = halves.groupBy("lang", "source", "rule", "bin").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, whole.collect()))


def test_quality_of_awkward_rows(spark):
    kept = quality_rules.keep_good(awkward(spark), min_docs=1)
    assert {r["doc_id"] for r in kept.collect()} <= {6, 10, 11}
    assert quality_rules.keep_good(empty(spark)).count() == 0


def test_training_learns_two_alphabets():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(list(b"abc "), 200)) for _ in range(60)] + [
        bytes(rng.choice(list(b"xyz "), 200)) for _ in range(60)]
    net = language_id.train(texts, ["a"] * 60 + ["x"] * 60, epochs=10)
    windows, counts = language_id.as_windows([b"aabc cab" * 90, b"zzy"])
    assert counts.tolist() == [3, 1]
    assert net.probabilities(windows).argmax(axis=1).tolist() == [0, 0, 0, 1]


@pytest.fixture(scope="module")
def net(spark):
    return language_id.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"), 400)


def test_held_out_accuracy(spark, net):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = language_id.predict(docs, net).filter(language_id.held_out() & F.col("lang").isNotNull())
    row = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.count("*")).first()
    assert row["right"] > 0.98


def test_prediction_is_the_mean_over_all_windows(spark, net):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    mixed = [r["text"] for r in docs.filter("lang = 'fr'").orderBy("doc_id").limit(1).collect()] + [
        r["text"] for r in docs.filter("lang = 'de'").orderBy("doc_id").limit(1).collect()]
    frame = spark.createDataFrame([(1, mixed[0] * 2 + mixed[1])], "doc_id long, text string")
    got = language_id.predict(frame, net).first()
    data = frame.first()["text"].encode().lower()
    pieces = [data[i:i + 256] for i in range(0, len(data), 256)]
    shares = net.probabilities(language_id.as_windows(pieces)[0])
    mean = (shares * np.array([len(p) for p in pieces])[:, None]).sum(axis=0) / len(data)
    assert net.languages[int(mean.argmax())] == got["lang_pred"]
    assert got["score"] == pytest.approx(float(mean.max()), abs=1e-5)


def test_language_of_awkward_rows(spark, net):
    docs = awkward(spark)
    rows = language_id.predict(docs, net).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert 0 <= row["score"] <= 1
        assert (row["lang_pred"] == "und") == (not any(c.isalpha() for c in row["text"] or ""))
    assert language_id.predict(empty(spark), net).count() == 0
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} & {0, 1, 2} == set()


def test_without_labels_nothing_is_identified(spark):
    docs = empty(spark)
    assert language_id.fit(docs) is None
    unlabelled = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.predict(unlabelled, language_id.fit(unlabelled)).collect()} == {"und"}


STRANGE = [
    "Это предложение написано на русском языке, и его никто не учил раньше в этой сети. " * 12,
    "この文章は日本語で書かれており、ネットワークはこの言語を学習したことがありません。" * 12,
    "To zdanie jest napisane po polsku i nikt nie uczył tej sieci takiego języka. Pies biega po lesie. " * 10,
    "Tämä lause on kirjoitettu suomeksi, eikä verkko ole koskaan nähnyt tätä kieltä ennen tätä päivää. " * 10,
    "".join(np.random.default_rng(3).choice(list("abcdefghijklmnopqrstuvwxyz     "), 2000)),
    "".join(np.random.default_rng(4).choice(list("abcdefghijKLMNOPQRSTUVWXYZ0123456789+/"), 2000)),
]


@pytest.mark.parametrize("languages", [["en"], ["en", "fr"], ["de", "en", "fr"], ["de", "en", "es", "fr"]])
def test_strange_text_is_not_identified(spark, languages):
    """However many labels there are, unknown languages and noise go, and known or mixed texts stay."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter(F.col("lang").isin(languages)).select(
        "doc_id", "text", "lang").filter(F.length("text") > 300)
    some = [r["text"][:2048] for lang in languages for r in docs.filter(F.col("lang") == lang).orderBy("doc_id").limit(3).collect()]
    more = [(-1 - i, text, None) for i, text in enumerate([*STRANGE, " ".join(some)])]
    known = docs.count()
    kept = {r["doc_id"] for r in language_id.keep_identified(docs.union(spark.createDataFrame(more, docs.schema))).collect()}
    assert {i for i in kept if i < 0} == {-1 - len(STRANGE)}
    assert len(kept) - 1 > 0.98 * known
