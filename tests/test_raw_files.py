"""Raw crawl files of the checks."""

import os

from pyspark.sql import functions as F

from checks import source_queries
from checks.registry import Data
from videonet.operators import ingest
from videonet.sources import crawl_files


def small_tables(spark, tmp_path):
    spark.range(3000).selectExpr(
        "id + 1 AS l_orderkey", "id % 50 + 1 AS l_partkey", "id % 9 + 1 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber",
        "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice",
        "date_add(date'1995-01-01', CAST(id % 900 AS INT)) AS l_shipdate",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(1, 51).selectExpr(
        "id AS p_partkey", "'brand' AS p_brand", "'PROMO' AS p_type", "CAST(id % 50 + 1 AS INT) AS p_size",
    ).write.parquet(str(tmp_path / "part.parquet"))
    return Data(spark, str(tmp_path))


def test_files_grow_in_number_with_the_lines(spark, tmp_path, monkeypatch):
    """With eight ranges at any size, one task wrote an eighth of all lines."""
    data = small_tables(spark, tmp_path)
    few = spark.read.text(source_queries.raw_files(data), pathGlobFilter="part-*").select("value", "crawl_id")
    monkeypatch.setattr(source_queries, "LINES_PER_RANGE", 100)
    many = spark.read.text(source_queries.raw_files(data), pathGlobFilter="part-*").select("value", "crawl_id")
    assert len({path.rsplit("/", 1)[1].split("-")[1] for path in many.inputFiles()}) > 20
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_files_written_in_several_goes_hold_the_same_lines_in_order(spark, tmp_path, monkeypatch):
    """All lines were shuffled and written at once, as text that was not compressed."""
    data = small_tables(spark, tmp_path)
    early = spark.read.parquet(f"{data.sf_dir}/lineitem.parquet").withColumn("l_shipdate", F.when(
        F.col("l_quantity") != 3, F.col("l_shipdate")))  # some without a crawl
    early.write.parquet(f"{tmp_path}/dated/lineitem.parquet")
    spark.read.parquet(f"{data.sf_dir}/part.parquet").write.parquet(f"{tmp_path}/dated/part.parquet")
    data = Data(spark, f"{tmp_path}/dated")

    def stored(path):
        lines = crawl_files.read_raw_crawl(spark, path) if path else data.lines
        crawl = F.regexp_replace("crawl_id", "crawl_id=", "") if path else F.coalesce(
            "crawl_id", F.lit("__HIVE_DEFAULT_PARTITION__"))
        rows = lines.withColumn("crawl", crawl).orderBy("crawl", "file_name", "block_start", "line_no").collect()
        return [(r.crawl, r.value) for r in rows]

    wanted = stored(None)
    assert len(wanted) == 3000 and stored(source_queries.raw_files(data)) == wanted
    monkeypatch.setattr(source_queries, "LINES_PER_WRITE", 500)
    path = source_queries.raw_files(data, "gzip")
    names = [name for _, _, names in os.walk(path.removeprefix("file:")) for name in names if name.startswith("part-")]
    assert names and all(name.endswith(".txt.gz") for name in names)
    assert len({name.split("-", 2)[2].split(".")[0] for name in names}) == 4  # an id for each go
    lines = crawl_files.with_line_order(spark.read.text(f"{path}/*", pathGlobFilter="part-*"))
    lines = lines.withColumn("line_no", F.monotonically_increasing_id()).withColumn("crawl", F.substring("crawl_id", 10, 99))
    rows = lines.orderBy("crawl", "file_name", "block_start", "line_no").collect()
    assert [(r.crawl, r.value) for r in rows] == wanted


def test_first_records_of_lines_leave_out_known_ones(spark):
    fields = [" up ", "1", "Music & More", "60", "1_000", "4.5", " 7", "x8", "abcdefghijk", "bad"]
    rows = [("c1", f"{i % 3}.txt", 0, i, "\t".join([f"v{i % 5:010d}", *fields, str(i)])) for i in range(30)]
    lines = spark.createDataFrame(
        rows + [("c1", "0.txt", 0, 99, "short"), ("c1", "0.txt", 0, 98, " "), ("c1", "0.txt", 0, 97, None)],
        "crawl_id string, file_name string, block_start long, line_no long, value string")
    old = ingest.first_records(ingest.classify_malformed(lines))
    assert sorted(map(str, ingest.first_records_of_lines(lines).collect())) == sorted(map(str, old.collect()))
    known = spark.createDataFrame([("c1", f"v{1:010d}"), ("c2", f"v{2:010d}")], "crawl_id string, video_id string")
    new = ingest.first_records_of_lines(lines, known)
    assert sorted(map(str, new.collect())) == sorted(map(str, old.filter(f"video_id <> 'v{1:010d}'").collect()))


def test_first_records_are_those_of_all_records(spark):
    """Only lines that stay are made into records, with the same result."""
    def line(place, video, age, views):
        fields = [video, " up ", age, "Music & More", "60", views, "4.5", " 7", "x8", "abcdefghijk", "bad"]
        return ("c1", f"{place % 3}.txt", 0, place, "\t".join(fields))

    rows = [line(i, f"v{i % 5:010d}", f" {i} " if i % 2 else "abc", "-5" if i % 3 else "1_000") for i in range(30)]
    lines = spark.createDataFrame(
        rows + [("c1", "0.txt", 0, 99, "short")], "crawl_id string, file_name string, block_start long, line_no long, value string")
    old = ingest.dedupe_in_crawl(ingest.typed_records(lines))
    new = ingest.first_records(ingest.classify_malformed(lines))
    assert sorted(map(str, new.select(*old.columns).collect())) == sorted(map(str, old.collect()))
    assert new.count() == 5
