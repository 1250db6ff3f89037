"""Catalog, sinks, run log and whole jobs on small tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import edge_frame
from videonet import schemas
from videonet.functions import labels
from videonet.operators import metrics, search
from videonet.operators.categories import histogram
from videonet.plans import jobs
from videonet.session import checkpoint_root, cut_lineage, write_through
from videonet.sources import catalog, sinks


@pytest.fixture
def tables(spark, tmp_path):
    store = catalog.Catalog(spark, str(tmp_path / "tables"))
    edges = edge_frame(spark, [("a", "b"), ("a", "b"), ("b", "c"), ("c", "a")])
    videos = spark.createDataFrame(
        [("a", "u1", "music", 100, date(2006, 1, 1), ["0101"]),
         ("b", "u2", "music", 400, date(2006, 1, 2), ["0101"]),
         ("c", "u1", None, None, None, ["0101"])],
        schemas.VIDEOS,
    )
    snapshots = spark.createDataFrame(
        [("a", "0101", 10, "music", 100, 50, 4.5, 7, 1), ("a", "0202", 10, "music", 100, 90, 4.0, 9, 1),
         ("b", "0101", 20, "music", 400, 5000, None, 0, 0)],
        schemas.VIDEO_SNAPSHOTS,
    )
    sinks.write_entities(edges, store.path("edges"))
    sinks.write_entities(snapshots, store.path("video_snapshots"))
    videos.write.parquet(store.path("videos"))
    return store


def test_tables_keep_their_schema(tables):
    for name in ("videos", "video_snapshots", "edges"):
        frame = tables.load_table(name)
        assert dict(frame.dtypes) == {f.name: f.dataType.simpleString() for f in schemas.TABLES[name]}
    crawls = {r.crawl_id for r in tables.load_table("video_snapshots").collect()}
    assert crawls == {"0101", "0202"}


def test_missing_table_is_reported(spark, tables):
    assert not tables.exists("crawls")
    assert sorted(tables.load_all()) == ["edges", "video_snapshots", "videos"]
    profile = {r.table_name: r for r in tables.profile().collect()}
    assert (profile["edges"].num_rows, profile["edges"].table_exists) == (4, True)
    assert (profile["crawls"].num_rows, profile["crawls"].table_exists) == (0, False)
    assert set(tables.create_views()) <= set(catalog.list_tables(spark))


def test_one_crawl_is_replaced_alone(spark, tables):
    new = tables.load_table("video_snapshots").filter("crawl_id = '0202'").withColumn("views", F.lit(1))
    sinks.write_entities(write_through(new, "new"), tables.path("video_snapshots"))
    views = {(r.video_id, r.crawl_id): r.views for r in tables.load_table("video_snapshots").collect()}
    assert views == {("a", "0101"): 50, ("a", "0202"): 1, ("b", "0101"): 5000}


def test_graph_columns_adapt(spark):
    videos = spark.createDataFrame([("a", "music", 9)], "_id string, category string, views int")
    vertices, _ = catalog.load_graph(videos, edge_frame(spark, [("a", "b")]))
    assert vertices.columns == ["id", "category", "view_count"]


def test_archive_appends_runs(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = spark.createDataFrame([("x", 1)], "name string, n int")
    for minute in (1, 2):
        sinks.archive_result(rows, path, "top", {"k": 5}, datetime(2024, 1, 31, 9, minute, 3))
    got = sorted((r.created_date, r.created_time, r.run_ts, r.k) for r in spark.read.parquet(path).collect())
    assert got == [
        ("01-31-2024", "09:01:03", "01-31-2024_09-01-03", 5),
        ("01-31-2024", "09:02:03", "01-31-2024_09-02-03", 5),
    ]


def test_export_formats(spark, tmp_path):
    rows = spark.createDataFrame([("x", 1)], "name string, n int")
    sinks.export_result(rows, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["name", "n"]
    with pytest.raises(ValueError):
        sinks.export_result(rows, str(tmp_path / "x"), "xls")


def test_run_log(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    row = metrics.run_measured(
        "top", tables.load_table("video_snapshots"), lambda s: search.most_viewed(s, 2),
        lambda result: result.write.parquet(out), {"k": 2},
    ).first()
    assert (row.rows_processed, row.rows_returned) == (3, 2)
    assert row.selectivity == pytest.approx(200 / 3) and row.execution_time > 0
    assert spark.read.parquet(out).count() == 2


def test_latest_snapshot_uses_the_crawl_as_tie_break(tables):
    latest = {r.video_id: r.views for r in search.latest_snapshot(tables.load_table("video_snapshots")).collect()}
    assert latest == {"a": 90, "b": 5000}


def test_jobs(tables):
    results = jobs.degree_job(tables)
    runs = metrics.run_history(tables.spark.read.parquet(tables.path("run_log"))).collect()
    assert {r.query_type for r in runs} == {
        "degree_statistics", "category_counts", "length_distribution", "view_distribution"}
    assert results["summary"].first().num_vertices == 3
    assert tables.load_table("degree_statistics").count() == 3
    sampled = jobs.degree_analysis(tables.load_table("edges"), sample_size=10)
    assert sampled["summary"].first().avg_total_degree == pytest.approx(8 / 3)
    flow = jobs.notebook_flow(tables, "Music", 2)
    assert [r.video_id for r in flow["most_viewed"].collect()] == ["b", "a"]
    assert flow["motif"].count() == 3
    assert flow["influence"].count() == 2


def test_labels(spark):
    rows = spark.createDataFrame(
        [(120, 1000, 0.0), (121, 1001, 5.0), (None, None, 6.0), (1201, 10_000_001, -1.0)],
        "length long, views long, rate double",
    )
    got = rows.select(
        labels.length_bucket(F.col("length")), labels.view_bucket(F.col("views")),
        labels.rating_bucket(F.col("rate")), labels.duration_formatted(F.col("length")),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("0-2m", "0-1K", "0-1", "2:00"), ("2-5m", "1K-10K", "5-6", "2:01"),
        (">20m", ">10M", "Other", "0:00"), (">20m", ">10M", "Other", "20:01"),
    ]
    assert labels.video_urls(rows, "p", "q").columns == rows.columns


def test_histogram_of_equal_values(spark):
    rows = spark.createDataFrame([(5,), (5,), (None,)], "x int")
    assert [(r.bin, r.num_rows) for r in histogram(rows, "x", 4).collect()] == [(1, 2)]


def test_input_rules(tables):
    snapshots = tables.load_table("video_snapshots")
    for k in (0, -1):
        with pytest.raises(ValueError):
            search.most_viewed(snapshots, k)
    with pytest.raises(ValueError):
        search.by_views(snapshots, 10, 10)
    with pytest.raises(ValueError):
        search.multi_criteria(snapshots, search.Criteria(related_count=(1, 2)))
    assert search.by_category(snapshots, "All Categories").count() == 3


def test_checkpoints_use_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert folder in checkpoint_root(spark)
    cut = cut_lineage(spark.range(10))
    assert cut.count() == 10
