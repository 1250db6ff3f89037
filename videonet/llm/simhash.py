"""Near duplicates by SimHash fingerprints (operator 7).

A text's shingles are hashed, and a bit of its fingerprint is one where more than half of the hashes have it.
Fingerprints that differ in at most `max_bits` bits are linked; documents whose fingerprints are connected by
links form a group. The search works on distinct fingerprints, so copies cost nothing:

- Pigeonhole: the 64 bits are cut into max_bits + 3 blocks. Two linked fingerprints agree on three of them at
  least, so they meet in one of the tables keyed by three blocks.
- A bucket of two is compared at once, a bucket of up to BUCKET_LIMIT as one small matrix.
- Members of larger buckets are linked through midpoints: fingerprints at distance four or less have a value at
  distance two or less from both. Each member sends all values near it, and members that meet at a value are
  chained. That is linear in the members, finds the same groups, and lists no pairs.

Only links that keep groups connected are passed on. Null and empty texts, and texts without a word, have
fingerprint zero, which is linked like any other. Repeated rows get the same result each. A group without any
doc_id has null as its id. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.llm.common import arrow_map, slices, store, table
from videonet.llm.registry import query
from videonet.llm.row_filter import ROW, numbered, without_rows
from videonet.operators.structure import weak_components

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
AGREEING_BLOCKS = 3
BUCKET_LIMIT = 1024
BATCH_BYTES = 4 << 20
HASHES_AT_ONCE = 1 << 18


def shingle_hashes(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle of the text with A-Z in lower case, repeats included."""
    words = (text or "").encode().lower().split()  # on bytes both know ASCII only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < words_per_shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - words_per_shingle + 1]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[words_per_shingle - 1:].tolist())),
        np.uint64, len(starts),
    )


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    ones = np.zeros(64, np.int64)
    for first in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[first:first + HASHES_AT_ONCE]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(words_per_shingle: int):
    def work(batches):
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            found = np.fromiter(
                (fingerprint(shingle_hashes(text, words_per_shingle)) for text in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["row_id", "doc_id", "fp"]
            )

    return work


def block_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Signed masks of all choices of blocks on which linked fingerprints may agree."""
    count = max_bits + AGREEING_BLOCKS
    edges = [64 * i // count for i in range(count + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, AGREEING_BLOCKS)]
    return [mask - 2**64 if mask >= 2**63 else mask for mask in masks]


def _matrix_links(max_bits: int):
    """Links that connect, in each bucket, what its comparisons connect."""

    def work(batches):
        for batch in batches:
            found = []
            for members in batch.column(0).to_pylist():
                fps = np.sort(np.array(members, np.int64))
                near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
                label = np.arange(len(fps))
                while True:
                    lower = np.where(near, label[None, :], len(fps)).min(axis=1)
                    if (lower == label).all():
                        break
                    label = lower
                moved = label != np.arange(len(fps))
                found.append((fps[moved], fps[label[moved]]))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(side)) for side in zip(*found)], names=["src", "dst"]
                )

    return work


def _near_values(radius: int):
    flips = [0] + [sum(1 << bit for bit in bits) for n in range(1, radius + 1) for bits in combinations(range(64), n)]
    masks = np.array(flips, np.uint64).view(np.int64)

    def work(batches):
        for batch in batches:
            members = batch.column(0).to_numpy()
            for first in range(0, len(members), 256):
                part = members[first:first + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((part[:, None] ^ masks[None, :]).ravel()), pa.array(np.repeat(part, len(masks)))],
                    names=["value", "fp"],
                )

    return work


def _chain(batches):
    """Links between neighbours in rows sorted by value; the last row is carried over to the next batch."""
    last_value = last_fp = None
    for batch in batches:
        values, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(values):
            continue
        if last_value is not None:
            values, fps = np.concatenate(([last_value], values)), np.concatenate(([last_fp], fps))
        same = (values[1:] == values[:-1]) & (fps[1:] != fps[:-1])
        pairs = np.unique(np.stack([fps[1:][same], fps[:-1][same]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["src", "dst"])
        last_value, last_fp = values[-1], fps[-1]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(src, dst): links between distinct fingerprints `fp` that connect all that lie within `max_bits`."""
    masks = block_masks(max_bits)
    tagged = distinct.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(mask)) for mask in masks])).alias("block", "key"),
    )
    buckets = store(
        tagged.groupBy("block", "key")
        .agg(F.count(F.lit(1)).alias("members"), F.min("fp").alias("src"), F.max("fp").alias("dst"))
        .filter("members > 1"),
        "fingerprint-buckets",
    )
    twos = buckets.filter("members = 2").select("src", "dst").filter(
        F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits
    )
    # Stored by themselves, so that Spark sends these short lists to all tasks only where they are short.
    few = store(buckets.filter(F.col("members").between(3, bucket_limit)).select("block", "key"), "small-buckets")
    large = store(buckets.filter(F.col("members") > bucket_limit).select("block", "key"), "large-buckets")
    some = (
        tagged.join(few, ["block", "key"])
        .groupBy("block", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
    )
    within = arrow_map(some, _matrix_links(max_bits), "src long, dst long")
    many = tagged.join(large, ["block", "key"]).select("fp").distinct()
    # Each member sends over 2,000 values, so these few rows are spread over all partitions first.
    spread = many.repartition(int(many.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    met = arrow_map(spread, _near_values(max_bits // 2), "value long, fp long").repartition("value")
    chained = arrow_map(met.sortWithinPartitions("value", "fp"), _chain, "src long, dst long")
    return twos.union(within).union(chained).distinct()


def near_duplicates(docs: DataFrame, row_id: Column | None = None, words_per_shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(row_id, doc_id, fp, root, component_id): one row for each row of `docs`; max_bits must be even.

    root is the smallest fingerprint of the group, component_id its smallest doc_id. `row_id` names rows where
    the caller has numbered them.
    """
    rows = docs.select(
        (F.monotonically_increasing_id() if row_id is None else row_id).alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"), "text",
    )
    prints = store(
        arrow_map(rows, _fingerprints(words_per_shingle), "row_id long, doc_id long, fp long"), "fingerprints"
    )
    distinct = store(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    linked = store(links(distinct, max_bits, bucket_limit), "fingerprint-links")
    roots = store(weak_components(linked).withColumnsRenamed({"id": "fp", "component": "root"}), "fingerprint-roots")
    # A group's smallest doc_id; fingerprints without a link are groups of their own.
    lows = store(
        distinct.join(roots, "fp").groupBy("root").agg(F.min("low").alias("group_low")), "group-lows"
    )
    labels = store(
        distinct.join(roots, "fp", "left").join(lows, "root", "left")
        .select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("group_low", "low").alias("component_id")),
        "fingerprint-labels",
    )
    return prints.join(labels, "fp").select("row_id", "doc_id", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest doc_id, with all its columns.

    Of repeated rows of that document the first as stored stays; of a group without any doc_id, its first row.
    """
    rows = numbered(docs)
    found = store(near_duplicates(rows, F.col(ROW)), "near-duplicates")
    owners = (
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root").agg(F.min("row_id").alias("row_id"))
    )
    return without_rows(rows, found.select("row_id").join(owners, "row_id", "left_anti"))


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
