"""Token counts of every prefix of every text (operator 10).

For each document an array holds the exact number of tokens of each prefix, by code points from the empty prefix
on. With it the size of the whole text, of any truncation, and the longest prefix within a budget are lookups.
See byte_bpe for the dynamic programme; what lies between blanks is computed once per worker and remembered.

The counts are those of the tokenizers library for a byte-level BPE file: special strings inside texts are
special tokens, none are added, nothing is cut or padded. Null text counts as empty: one prefix, no token.
Repeated rows are counted each. An empty table gives an empty result. Only the named id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.llm.byte_bpe import prefix_counter
from videonet.llm.common import arrow_map, slices, table
from videonet.llm.registry import query

BATCH_BYTES = 1 << 20
TOKEN_LIMIT = 512


def _count(path: str):
    def work(batches):
        counter = prefix_counter(path)
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            found = [counter.prefix_counts(text) for text in texts]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found), pa.int32())),
                ],
                names=["doc_id", "n_bytes", "prefix_tokens"],
            )

    return work


def prefix_tokens(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_bytes, prefix_tokens): prefix_tokens[i] is the number of tokens of the first i code points."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, _count(tokenizer_path), "doc_id long, n_bytes long, prefix_tokens array<int>")


def tokens_of(length: Column | str | None = None, prefixes: str = "prefix_tokens") -> Column:
    """Tokens of the first `length` code points (of the whole text if none is given or it is shorter)."""
    last = F.size(prefixes) - 1
    at = last if length is None else F.least(last, F.col(length) if isinstance(length, str) else length)
    return F.get(F.col(prefixes), at).cast("long")


def longest_within(budget: int, prefixes: str = "prefix_tokens") -> Column:
    """Code points of the longest prefix of at most `budget` tokens; counts may fall as a prefix grows."""
    return F.array_max(F.transform(prefixes, lambda n, i: F.when(n <= budget, i)))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = prefix_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    whole = counted.select("doc_id", "n_bytes", tokens_of().alias("n_tokens"))
    return whole.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
