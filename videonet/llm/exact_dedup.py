"""Exact duplicates by content-defined chunk recipes (operator 2).

A text without its white space is cut where a rolling hash of its last 32 bytes has ten leading zero bits, so
equal texts have equal cuts wherever they lie. The distinct chunks move once, to find hashes that stand for
more than one chunk; such chunks get different identifiers, so an identifier always means one exact byte
string. Documents are then compared by their ordered lists of identifiers, a few numbers each; the texts
themselves are not moved again.

Null text counts as empty; all empty texts form one group. Of equal texts, the row with the most code points
in the original text stays, then the smallest doc_id (null last), then the first row as stored, so that of
repeated rows exactly one stays. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.llm.common import SPACE_BYTES, arrow_map, slices, store, table
from videonet.llm.registry import query
from videonet.llm.row_filter import ROW, numbered, without_rows

MIN_CHUNK = 256
MAX_CHUNK = 16_384
CUT_BITS = 10
BATCH_BYTES = 4 << 20
_FACTOR = 0x9E3779B97F4A7C15


def cut_points(data: np.ndarray) -> np.ndarray:
    """The places after which the rolling hash of 32 bytes allows a cut, in ascending order."""
    rolled = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    factor = _FACTOR
    for span in (1, 2, 4, 8, 16):
        if len(rolled) > span:
            shifted = rolled[:-span] * np.uint64(factor)
            rolled[span:] += shifted
        factor = factor * factor % 2**64
    return np.flatnonzero(rolled >> np.uint64(64 - CUT_BITS) == 0) + 1


def chunk_bounds(cuts: np.ndarray, start: int, end: int) -> list[int]:
    """Bounds of the chunks of data[start:end]; a chunk has MIN_CHUNK to MAX_CHUNK bytes, the last may be shorter.

    The first allowed cut lies over 32 bytes into the text, so no hash there covers bytes of another one.
    """
    bounds, at = [start], start
    low, high = np.searchsorted(cuts, (start, end))
    for cut in cuts[low:high].tolist():
        if cut - at < MIN_CHUNK:
            continue
        while cut - at > MAX_CHUNK:
            at += MAX_CHUNK
            bounds.append(at)
        if cut - at >= MIN_CHUNK:
            bounds.append(cut)
            at = cut
    while end - at > MAX_CHUNK:
        at += MAX_CHUNK
        bounds.append(at)
    if end > at:
        bounds.append(end)
    return bounds


def _chunked(batch: pa.RecordBatch) -> Iterator[tuple[int, str, bytes, list[bytes]]]:
    """For each row: its place in the batch, the text, the text without white space, its chunks."""
    texts = [text or "" for text in batch.column(batch.schema.get_field_index("text")).to_pylist()]
    plain = [text.encode().translate(None, SPACE_BYTES) for text in texts]
    joined = b"".join(plain)
    cuts = cut_points(np.frombuffer(joined, np.uint8))
    end = 0
    for row, (text, own) in enumerate(zip(texts, plain)):
        start, end = end, end + len(own)
        bounds = chunk_bounds(cuts, start, end)
        yield row, text, own, [joined[a:b] for a, b in zip(bounds, bounds[1:])]


def _hash(chunk: bytes, hash_bits: int) -> int:
    value = xxhash.xxh3_64_intdigest(chunk) >> (64 - hash_bits)
    return value - 2**64 if value >= 2**63 else value


def _recipes(hash_bits: int):
    def work(batches):
        for batch in slices(batches, "text", BATCH_BYTES):
            points, digests, hashes = [], [], []
            for _, text, own, chunks in _chunked(batch):
                points.append(len(text))
                digests.append(hashlib.sha256(own).hexdigest())
                hashes.append([_hash(chunk, hash_bits) for chunk in chunks])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(points, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(hashes, pa.list_(pa.int64()))],
                names=["row_id", "doc_id", "n_points", "text_sha256", "recipe"],
            )

    return work


def _chunks(hash_bits: int):
    def work(batches):
        for batch in slices(batches, "text", BATCH_BYTES):
            ids = batch.column(0).to_pylist()
            rows, places, hashes, found = [], [], [], []
            for row, _, _, chunks in _chunked(batch):
                rows += [ids[row]] * len(chunks)
                places += range(len(chunks))
                hashes += [_hash(chunk, hash_bits) for chunk in chunks]
                found += chunks
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(places, pa.int32()), pa.array(hashes, pa.int64()),
                 pa.array(found, pa.binary())],
                names=["row_id", "place", "hash", "chunk"],
            )

    return work


def recipes(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """(row_id, doc_id, n_points, text_sha256, recipe): each row's ordered list of chunk identifiers.

    `docs` has row_id, doc_id and text. An identifier is a chunk's hash; where several chunks share a hash, all
    but the first in byte order get a second number, appended to the list as (place, number) pairs.
    """
    lists = arrow_map(
        docs, _recipes(hash_bits),
        "row_id long, doc_id long, n_points long, text_sha256 string, recipe array<long>",
    )
    chunks = arrow_map(docs, _chunks(hash_bits), "row_id long, place int, hash long, chunk binary")
    distinct = chunks.select("hash", "chunk").distinct()
    shared = store(
        distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("chunks")).filter("chunks > 1"), "shared-hashes"
    )
    if shared.isEmpty():
        return lists
    # Rare: chunks that differ under one hash. They are numbered, and the numbers go into the lists they occur in.
    from pyspark.sql import Window

    numbered = (
        distinct.join(shared, "hash", "left_semi")
        .withColumn("number", F.row_number().over(Window.partitionBy("hash").orderBy("chunk")) - 1)
        .filter("number > 0")
    )
    marks = (
        chunks.join(numbered, ["hash", "chunk"])
        .groupBy("row_id")
        .agg(F.sort_array(F.collect_list(F.struct("place", "number"))).alias("marks"))
        .select("row_id", F.flatten(F.transform("marks", lambda m: F.array(
            m["place"].cast("long"), m["number"].cast("long")))).alias("marks"))
    )
    none = F.expr("cast(array() AS array<long>)")
    # A separator keeps a list with marks apart from a longer list without.
    return lists.join(marks, "row_id", "left").withColumn(
        "recipe",
        F.when(F.col("marks").isNull(), F.col("recipe")).otherwise(
            F.concat("recipe", F.array(F.lit(None).cast("long")), F.coalesce("marks", none))
        ),
    ).drop("marks")


def exact_duplicates(docs: DataFrame, row_id: Column | None = None, hash_bits: int = 64) -> DataFrame:
    """(row_id, doc_id, keep_id, group_size, kept, text_sha256): one row for each row of `docs`.

    `row_id` names rows where the caller has numbered them in a stored table.
    """
    rows = docs.select(
        (F.monotonically_increasing_id() if row_id is None else row_id).alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"), "text",
    )
    lists = store(recipes(rows, hash_bits), "recipes")
    best = F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_id"))
    # Groups of one need no partner; the others are stored, so the join deals both sides out anew and
    # adaptive execution can split a large group.
    groups = store(
        lists.groupBy("recipe").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("size")).filter("size > 1")
        .select(F.col("recipe").alias("shared"), "size", F.col("best.doc_id").alias("best_doc"),
                F.col("best.row_id").alias("best_row")),
        "equal-recipes",
    )
    return lists.join(groups, F.col("recipe") == F.col("shared"), "left").select(
        "row_id", "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("best_doc")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("best_row") == F.col("row_id"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts, with all its columns."""
    rows = numbered(docs)
    return without_rows(rows, exact_duplicates(rows, F.col(ROW)).filter("NOT kept").select("row_id"))


SQL = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(t) AS text_sha256
FROM plain WINDOW best AS (PARTITION BY t ORDER BY n DESC, doc_id)
"""


@query("op2_exact_dedup", SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
