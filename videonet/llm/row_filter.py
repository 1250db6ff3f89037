"""Dropping some rows of a stored table without moving the others.

Joining texts with a list of row ids shuffles all texts as soon as the list is too long to be sent to every task. Here
the list is written below the shared folder instead, one small file for each partition that numbered the
rows (the upper bits of a row id), and the task that reads such rows opens the file of their partition. What is
shuffled are the ids of the dropped rows; a task holds those of one partition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from videonet.llm.common import arrow_map, store
from videonet.session import scratch_path

ROW = "__row"
#: Bits of a row id within a partition.
_ROW_BITS = 33


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with a column ROW, stored, so that the ids cannot change."""
    return store(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a folder."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def without_rows(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The numbered rows whose id is not in the only column of `gone`, without the ids."""
    spark = rows.sparkSession
    folder = scratch_path(spark, "dropped-rows")
    ids = gone.toDF("row").withColumn("part", F.shiftright("row", _ROW_BITS))
    ids.repartition("part").write.partitionBy("part").parquet(folder)
    names = [name for name in rows.columns if name != ROW]
    schema = StructType([rows.schema[name] for name in names])

    def work(batches):
        files, path = open_folder(folder)
        part, dropped = None, np.empty(0, np.int64)
        for batch in batches:
            numbers = batch.column(batch.num_columns - 1).to_numpy()
            keep = np.ones(len(numbers), bool)
            parts = numbers >> _ROW_BITS
            for other in np.unique(parts).tolist():
                if other != part:
                    part, dropped = other, np.empty(0, np.int64)
                    own = f"{path}/part={part}"
                    if files.get_file_info(own).type == fs.FileType.Directory:
                        dropped = pq.read_table(own, columns=["row"], filesystem=files, partitioning=None)["row"].to_numpy()
                keep &= (parts != other) | ~np.isin(numbers, dropped)
            yield batch.select(list(range(batch.num_columns - 1))).filter(pa.array(keep))

    return arrow_map(rows.select(*[F.col(f"`{name}`") for name in names], ROW), work, schema)
