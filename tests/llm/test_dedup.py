"""Exact and near duplicates against direct answers."""

import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import DOC_SCHEMA, awkward, empty, prose
from videonet.llm import exact_dedup, row_filter, simhash


def _plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def _groups(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[_plain(row["text"])].append(row)
    return groups


def _copies():
    base = prose(5, 900)
    return [(100 + i, base.replace(" ", "  " if i % 3 else "\n", i), "en", "a", 0) for i in range(12)] + [
        (200 + i, base[:-1] + "xyz"[i], "en", "a", 0) for i in range(3)]


# With two bits, nearly all chunks share a hash with others, so the numbered identifiers decide.
@pytest.mark.parametrize("hash_bits", [64, 2])
def test_exact_duplicates(spark, hash_bits):
    docs = awkward(spark, _copies()).select("doc_id", "text", F.monotonically_increasing_id().alias("n"))
    rows = docs.collect()
    found = exact_dedup.exact_duplicates(docs, F.col("n"), hash_bits).collect()
    assert len(found) == len(rows)
    by_row = {row["row_id"]: row for row in found}
    for members in _groups(rows).values():
        best = min(members, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0, r["n"]))
        for member in members:
            got = by_row[member["n"]]
            assert got["keep_id"] == best["doc_id"]
            assert got["group_size"] == len(members)
            assert got["kept"] == (member["n"] == best["n"])


def test_drop_copies_keeps_one_of_each_group(spark):
    docs = awkward(spark, _copies())
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [_plain(row["text"]) for row in kept.collect()]
    assert sorted(texts) == sorted(_groups(docs.collect()))


def test_equal_texts_have_equal_cuts_wherever_they_lie():
    import numpy as np

    text = prose(9, 5000).replace(" ", "").encode()
    alone = exact_dedup.chunk_bounds(exact_dedup.cut_points(np.frombuffer(text, np.uint8)), 0, len(text))
    before = prose(10, 700).encode()
    joined = np.frombuffer(before + text, np.uint8)
    moved = exact_dedup.chunk_bounds(exact_dedup.cut_points(joined), len(before), len(joined))
    assert [b - len(before) for b in moved] == alone
    assert max(b - a for a, b in zip(alone, alone[1:])) <= exact_dedup.MAX_CHUNK


def test_empty_tables(spark):
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def _fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else (
        [" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(prints, max_bits=4):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def _near_copies():
    base = prose(7, 600).split()
    rows = []
    for i in range(40):
        words = list(base)
        for k in range(i % 5):
            words[(37 * i + 101 * k) % len(words)] = f"changed{i}x{k}"
        rows.append((300 + i, " ".join(words), "en", "a", 0))
    return rows


# A limit of three sends most buckets through the midpoints, one of 1,024 none.
@pytest.mark.parametrize("bucket_limit", [1024, 3, 1])
def test_near_duplicates(spark, bucket_limit):
    docs = awkward(spark, _near_copies()).select("doc_id", "text", F.monotonically_increasing_id().alias("n"))
    rows = docs.collect()
    prints = [_fingerprint(row["text"]) for row in rows]
    roots = _components(prints)
    lows = defaultdict(list)
    for row, root in zip(rows, roots):
        lows[root].append(row["doc_id"])
    found = {r["row_id"]: r for r in simhash.near_duplicates(docs, F.col("n"), bucket_limit=bucket_limit).collect()}
    assert len(found) == len(rows)
    for row, print_, root in zip(rows, prints, roots):
        assert found[row["n"]]["fp"] % 2**64 == print_
        assert found[row["n"]]["component_id"] == min((d for d in lows[root] if d is not None), default=None)


def test_links_between_random_fingerprints(spark):
    """Chains of fingerprints four bits apart, where no bucket holds a whole chain."""
    import random

    rng = random.Random(2)
    prints = [rng.getrandbits(64)]
    for _ in range(150):
        value = prints[-1] if rng.random() < 0.8 else rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.choice([1, 3, 4, 5])):
            value ^= 1 << bit
        prints.append(value)
    signed = sorted({p - 2**64 if p >= 2**63 else p for p in prints})
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    wanted = _components([p % 2**64 for p in signed])
    for limit in (1024, 1):
        links = simhash.links(frame, bucket_limit=limit).collect()
        assert all(((a ^ b) % 2**64).bit_count() <= 4 or limit == 1024 for a, b in links)
        parent = {p: p for p in signed}

        def find(p):
            while parent[p] != p:
                p = parent[p]
            return p

        for a, b in links:
            parent[find(a)] = find(b)
        got = [find(p) for p in signed]
        assert len(set(zip(got, wanted))) == len(set(got)) == len(set(wanted))


def test_drop_near_duplicates(spark):
    docs = awkward(spark, _near_copies())
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(_components([_fingerprint(r["text"]) for r in docs.collect()])))


def test_schema_of_helper_is_that_of_documents(spark):
    columns = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").columns
    assert [field.split()[0] for field in DOC_SCHEMA.split(", ")] == columns


def test_rows_are_dropped_where_they_lie(spark):
    """Without a shuffle of the other rows, from any number of partitions, with columns of many types."""
    docs = spark.range(5000, numPartitions=7).select(
        "id", F.array("id").alias("row"), F.struct("id").alias("part"), F.lit(None).cast("date").alias("a.b"))
    rows = row_filter.numbered(docs)
    for share in (0, 1, 50, 100):
        gone = rows.filter(F.pmod(F.xxhash64("id"), F.lit(100)) < share).select(row_filter.ROW)
        wanted = {r["id"] for r in rows.collect()} - {
            r["id"] for r in rows.filter(F.pmod(F.xxhash64("id"), F.lit(100)) < share).collect()}
        kept = row_filter.without_rows(rows, gone)
        assert kept.columns == docs.columns
        assert {r["id"] for r in kept.collect()} == wanted
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
