"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from videonet.session import scratch_path, scratch_paths

#: The characters that separate words (fixed by the operators' contracts).
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Stands for a full stop in a column name.
_STOP = "\u2024"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as a table in the shared folder and read back.

    Later steps read these rows even if an executor is lost, so row ids and
    other choices of one run cannot differ between two uses.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The frame that `make` returns, stored; the scratch tables made for it are deleted at once."""
    path = scratch_path(spark, name)
    with scratch_paths() as made:
        try:
            df = make()
            df.write.option("compression", "zstd").parquet(path)
        finally:
            for folder in made:
                delete_folder(spark, folder)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a column's values sum to about `most_bytes`; a longer value stands alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_pylist()
        first, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size
        yield batch.slice(first)


def ship_package(spark: SparkSession) -> None:
    """Send this package to all executors once per application, wherever it was imported from.

    Spark's file server hands the archive out; the driver's temporary file is only what it is given.
    """
    context = spark.sparkContext
    if getattr(context, "_videonet_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="videonet-ship-")) / "videonet.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._videonet_shipped = True


def arrow_map(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    """mapInArrow for frames with any column names; it cannot itself resolve names with full stops."""
    ship_package(df.sparkSession)
    if not any("." in name for name in df.columns):
        return df.mapInArrow(work, schema)
    plain = df.toDF(*[name.replace(".", _STOP) for name in df.columns])
    if isinstance(schema, str):
        return plain.mapInArrow(work, schema)
    renamed = StructType([StructField(f.name.replace(".", _STOP), f.dataType, f.nullable) for f in schema.fields])
    return plain.mapInArrow(work, renamed).toDF(*[f.name for f in schema.fields])


def schema_with(df: DataFrame, *columns: tuple[str, str]) -> StructType:
    """The frame's schema and further columns; a new one, as add() changes the schema it is called on."""
    schema = StructType(list(df.schema.fields))
    for name, kind in columns:
        schema = schema.add(name, kind)
    return schema
