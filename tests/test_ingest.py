"""Cleaning rules on hand-written lines, and whole ingest runs over files."""

import datetime
import os

import pytest

from videonet.operators import ingest
from videonet.plans.jobs import ingest_crawls
from videonet.sources import crawl_files, sinks
from videonet.sources.catalog import Catalog
from videonet.streaming.incremental import stream_ingest

GOOD = ["abcdefghij1", "joe", "100", "News & Politics", "60", "10", "4.5", "3", "2"]


def line(*related, **changes):
    names = ["id", "uploader", "age", "category", "length", "views", "rate", "ratings", "comments"]
    values = [changes.get(name, value) for name, value in zip(names, GOOD)]
    return "\t".join([*values, *related])


def frame(spark, *values):
    rows = [("c1", "0.txt", 0, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "crawl_id string, file_name string, block_start long, line_no long, value string"
    )


def related(i):
    return f"r{i:010d}"


@pytest.mark.parametrize(
    "text, reason",
    [
        (line(related(1)), None),
        ("\t".join(GOOD[:8]), "insufficient_fields"),
        (line(comments=""), "insufficient_fields"),
        ("\t" + line(), None),
        (line(id="abcdefghij"), "invalid_video_id"),
        (line(id="abc$efghijk"), "invalid_video_id"),
        (line(id="abcdéfghijk"), None),
        (line(id="ab_-efghijk"), None),
        (line(age="-1"), "invalid_age"),
        (line(age="10001"), "invalid_age"),
        (line(age="99999999999999999999"), "invalid_age"),
        (line(age="abc"), None),
        (line(length="0"), "invalid_length"),
        (line(length="abc"), "invalid_length"),
        (line(length="12.0"), "invalid_length"),
        (line(length=" 1_2 "), None),
    ],
)
def test_reasons(spark, text, reason):
    rows = ingest.classify_malformed(frame(spark, text)).collect()
    assert [row.reason for row in rows] == [reason]


def record(spark, **changes):
    return ingest.typed_records(frame(spark, line(**changes))).first()


def test_blank_lines_are_not_counted(spark):
    assert ingest.split_lines(frame(spark, "", "  ", "\t", " ", "x")).count() == 1


@pytest.mark.parametrize(
    "changes, column, expected",
    [
        ({"views": "-5"}, "views", 0),
        ({"views": "1_000"}, "views", 1000),
        ({"views": "+7"}, "views", 7),
        ({"views": "12.0"}, "views", 0),
        ({"rate": "7.2"}, "rate", 5.0),
        ({"rate": "nan"}, "rate", 5.0),
        ({"rate": "-inf"}, "rate", 0.0),
        ({"rate": "1d"}, "rate", 0.0),
        ({"rate": "3."}, "rate", 3.0),
        ({"rate": " 1e0 "}, "rate", 1.0),
        ({}, "category", "news_and_politics"),
        ({"category": ""}, "category", "unknown"),
        ({"category": "   "}, "category", ""),
        ({"uploader": ""}, "uploader", "unknown"),
        ({"uploader": " ann "}, "uploader", "ann"),
        ({"age": "abc"}, "age_days", 0),
    ],
)
def test_cleaned_values(spark, changes, column, expected):
    assert record(spark, **changes)[column] == expected


def test_upload_day(spark):
    records = ingest.typed_records(frame(spark, line(age="14")))
    assert ingest.project_videos(records).first().date_uploaded == datetime.date(2005, 3, 1)


def test_related_ids_keep_the_first_fifty_valid_ones(spark):
    ids = [related(i) for i in range(60)]
    text = line("bad", " " + ids[0] + " ", *ids[1:], "also bad")
    edges = ingest.explode_edges(ingest.typed_records(frame(spark, text)))
    assert [row.dst for row in edges.collect()] == ids[:50]


def test_duplicates_and_self_loops_stay(spark):
    text = line(related(1), related(1), GOOD[0])
    edges = ingest.explode_edges(ingest.typed_records(frame(spark, text))).collect()
    assert [row.dst for row in edges] == [related(1), related(1), GOOD[0]]


def test_first_record_in_path_order_wins(spark):
    rows = [
        ("c1", "2.txt", 0, 0, line(views="2")),
        ("c1", "10.txt", 0, 5, line(views="10")),
        ("c1", "10.txt", 0, 4, line(length="0", views="4")),
        ("c2", "2.txt", 0, 9, line(views="3")),
    ]
    lines = spark.createDataFrame(rows, frame(spark).schema)
    records = ingest.dedupe_in_crawl(ingest.typed_records(lines))
    got = {row.crawl_id: (row.views, row.copies) for row in records.collect()}
    assert got == {"c1": (10, 2), "c2": (3, 1)}


def write(root, crawl, name, *lines, raw=None):
    os.makedirs(f"{root}/{crawl}", exist_ok=True)
    with open(f"{root}/{crawl}/{name}", "wb") as out:
        out.write(raw if raw is not None else ("\n".join(lines) + "\n").encode())


LOG = ["Start:  Mon 1 ", "noise", "finish: Tue 2", "Total 12 34", "total 56 x", "total"]


@pytest.fixture
def raw(tmp_path):
    root = str(tmp_path / "raw")
    write(root, "0101", "log.txt", *LOG)
    write(root, "0101", "readme.txt", line(id="readmereadm"))
    write(root, "0101", "2.txt", line(related(1), views="2"), line(id="bbbbbbbbbbb"))
    write(root, "0101", "10.txt", line(related(2), views="10"), "", line(length="0"))
    write(root, "0202", "0.txt", line(related(3), category="Music"), line(age="-1"))
    return root


def tables(spark, base):
    catalog = Catalog(spark, base)
    result = {}
    for name in ("videos", "video_snapshots", "edges"):
        rows = catalog.load_table(name).collect()
        result[name] = sorted(map(str, rows))
    result["crawls"] = sorted(r.id for r in catalog.load_table("crawls").collect())
    return result


def test_log_fields(spark, raw):
    logs = {r.crawl_id: r for r in crawl_files.read_crawl_log(spark, raw).collect()}
    log = logs["0101"]
    assert (log.log_file, log.start_time, log.finish_time) == ("log.txt", "mon 1", "tue 2")
    assert (log.total_videos, log.total_time) == (56, 34)
    assert log.raw_log == "\n".join(LOG) + "\n"
    assert logs["0202"].log_file == "0.txt" and logs["0202"].start_time is None


def test_only_data_files_are_read(spark, tmp_path):
    root = str(tmp_path)
    write(root, "c", "part_log.txt", "Start: x")
    write(root, "c", "ReadMe.txt", "no")
    write(root, "c", "a.txt", "a1", "a2")
    write(root, "c", "7.txt", raw=b"ok\xff\xfe!\n")
    write(root, "c", "8.txt", raw="a\ufffdb\nc\ufffdd".encode() + b"\xff\n")
    lines = crawl_files.read_raw_crawl(spark, root).collect()
    assert sorted((r.file_name, r.value) for r in lines) == [
        ("7.txt", "ok!"), ("8.txt", "a\ufffdb"), ("8.txt", "c\ufffdd"), ("a.txt", "a1"), ("a.txt", "a2"),
    ]


def test_ingest_twice_equals_once(spark, raw, tmp_path):
    base = str(tmp_path / "tables")
    stats = {r.crawl_id: r for r in ingest_crawls(spark, raw, base).collect()}
    total = stats[None]
    assert (total.total_lines, total.valid_records) == (6, 3)
    assert (total.malformed, total.duplicates, total.crawls_processed) == (2, 1, 2)
    for row in stats.values():
        assert row.total_lines == row.valid_records + row.malformed + row.duplicates
    first = tables(spark, base)
    catalog = Catalog(spark, base)
    videos = {r.id: r for r in catalog.load_table("videos").collect()}
    assert videos[GOOD[0]].seen_in_crawls == ["0101", "0202"]
    assert videos[GOOD[0]].category == "music"
    snapshots = catalog.load_table("video_snapshots").collect()
    views = {(r.video_id, r.crawl_id): r.views for r in snapshots}
    assert views[(GOOD[0], "0101")] == 10
    edges = {(r.crawl_id, r.dst) for r in catalog.load_table("edges").collect()}
    assert edges == {("0101", related(2)), ("0202", related(3))}
    notes = {r.id: r.notes for r in catalog.load_table("crawls").collect()}
    assert notes == {
        "0101": "Crawl processing from mon 1 to tue 2",
        "0202": "Crawl processing from unknown to unknown",
    }
    assert ingest_crawls(spark, raw, base) is None
    assert tables(spark, base) == first


def test_new_crawl_is_merged_and_force_replaces(spark, raw, tmp_path):
    base = str(tmp_path / "tables")
    ingest_crawls(spark, raw, base)
    write(raw, "0303", "0.txt", line(category="Sport"), line(id="ccccccccccc"))
    ingest_crawls(spark, raw, base)
    videos = {r.id: r for r in Catalog(spark, base).load_table("videos").collect()}
    assert videos[GOOD[0]].seen_in_crawls == ["0101", "0202", "0303"]
    assert videos[GOOD[0]].category == "sport"
    assert set(videos) == {GOOD[0], "bbbbbbbbbbb", "ccccccccccc"}
    incremental = tables(spark, base)
    ingest_crawls(spark, raw, base, force=True)
    assert tables(spark, base) == incremental


@pytest.mark.parametrize("step", ["video_snapshots", "videos", "crawls"])
def test_failed_run_changes_nothing_that_is_visible(spark, raw, tmp_path, monkeypatch, step):
    """A run that dies before writing a table, or before registering, is repeated by the next one."""
    base = str(tmp_path / "tables")
    ingest_crawls(spark, raw, base)
    before = tables(spark, base)
    write(raw, "0303", "0.txt", line(category="Sport"), line(id="ccccccccccc"))
    entities, version = sinks.write_entities, Catalog.write_version

    def failing_entities(df, path, replace_all=False):
        if path.endswith(step):
            raise RuntimeError("lost")
        entities(df, path, replace_all)

    def failing_version(self, name, rows):
        if name == step:
            # Files of a write that was broken off, without the mark of a complete one.
            rows.write.mode("overwrite").parquet(f"{self.path(name)}/version=99")
            os.remove(f"{self.path(name)}/version=99/_SUCCESS")
            raise RuntimeError("lost")
        return version(self, name, rows)

    monkeypatch.setattr(sinks, "write_entities", failing_entities)
    monkeypatch.setattr(Catalog, "write_version", failing_version)
    with pytest.raises(RuntimeError):
        ingest_crawls(spark, raw, base)
    monkeypatch.undo()
    assert tables(spark, base) == before
    ingest_crawls(spark, raw, base)
    whole = str(tmp_path / "whole")
    ingest_crawls(spark, raw, whole)
    assert tables(spark, base) == tables(spark, whole)


def test_first_run_that_fails_shows_nothing(spark, raw, tmp_path, monkeypatch):
    base = str(tmp_path / "tables")

    def failing(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "crawl_registry", failing)
    with pytest.raises(RuntimeError):
        ingest_crawls(spark, raw, base)
    monkeypatch.undo()
    assert tables(spark, base) == {"videos": [], "video_snapshots": [], "edges": [], "crawls": []}


def test_old_versions_are_dropped(spark, raw, tmp_path):
    base = str(tmp_path / "tables")
    for i in range(4):
        write(raw, f"05{i:02d}", "0.txt", line(category="Sport"))
        ingest_crawls(spark, raw, base)
    assert len(os.listdir(f"{base}/videos")) <= 3


def test_stream_equals_batch_and_takes_late_files(spark, raw, tmp_path):
    base, batch_base = str(tmp_path / "stream"), str(tmp_path / "batch")
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        query = stream_ingest(spark, raw, base, checkpoint)
        query.awaitTermination()
        assert query.exception() is None

    run()
    ingest_crawls(spark, raw, batch_base)
    assert tables(spark, base) == tables(spark, batch_base)
    run()
    assert tables(spark, base) == tables(spark, batch_base)
    write(raw, "0101", "3.txt", line(views="77"), line(related(9), id="ddddddddddd"))
    run()
    snapshots = Catalog(spark, base).load_table("video_snapshots").filter("crawl_id = '0101'")
    assert {r.video_id: r.views for r in snapshots.collect()} == {
        GOOD[0]: 10, "bbbbbbbbbbb": 10, "ddddddddddd": 10,
    }
    edges = Catalog(spark, base).load_table("edges").filter("crawl_id = '0101'").collect()
    assert sorted(r.dst for r in edges) == sorted([related(2), related(9)])
