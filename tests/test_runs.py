"""Runs of ingest that are broken off, buckets of videos, and what is left behind."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tests.test_ingest import GOOD, LOG, line, related, tables, write
from videonet.operators import ingest
from videonet.plans.jobs import ingest_crawls
from videonet.session import checkpoint_root
from videonet.sources import crawl_files
from videonet.sources.catalog import Catalog
from videonet.streaming import incremental
from videonet.streaming.incremental import stream_ingest


@pytest.fixture
def raw(tmp_path):
    root = str(tmp_path / "raw")
    write(root, "0101", "log.txt", *LOG)
    write(root, "0101", "2.txt", line(related(1), views="2"), line(id="bbbbbbbbbbb"), line(length="0"))
    write(root, "0202", "0.txt", line(related(3), category="Music"), line(age="-1"))
    return root


def _state(spark, base):
    rejects = sorted(map(str, Catalog(spark, base).load_table("rejected_lines").drop("line_no").collect()))
    return {**tables(spark, base), "rejects": rejects}


@pytest.mark.parametrize("kind", ["new", "repeated", "forced"])
def test_a_run_that_fails_between_any_two_writes_changes_nothing(spark, raw, tmp_path, monkeypatch, kind):
    base, checkpoint = str(tmp_path / "tables"), str(tmp_path / "checkpoint")

    def run():
        if kind == "repeated":
            query = stream_ingest(spark, raw, base, checkpoint)
            query.processAllAvailable()
            query.awaitTermination()
        else:
            ingest_crawls(spark, raw, base, force=kind == "forced")

    run()
    before = _state(spark, base)
    if kind == "new":
        write(raw, "0303", "0.txt", line(category="Sport"), line(id="ccccccccccc"), line(length="x"))
    else:
        write(raw, "0101", "3.txt", line(views="77"), line(related(9), id="ddddddddddd"), line(age="x9"), line(length="y"))
    plain = DataFrameWriter.parquet
    writes, fail_at = [0], [0]

    def counted(self, path, *args, **kwargs):
        if path.startswith(base):
            writes[0] += 1
            if writes[0] == fail_at[0]:
                raise RuntimeError("lost before a write")
            plain(self, path, *args, **kwargs)
            if writes[0] == -fail_at[0]:
                raise RuntimeError("lost behind a write")
        else:
            plain(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", counted)
    # Rejected lines, edges, snapshots, videos, the list of their buckets, and the registry.
    for at in (1, 2, 3, 4, 5, 6, -5):
        writes[0], fail_at[0] = 0, at
        with pytest.raises(Exception, match="lost"):
            run()
        assert _state(spark, base) == before, at
    writes[0], fail_at[0] = 0, 0
    run()
    assert writes[0] == 6
    monkeypatch.undo()
    after = _state(spark, base)
    assert after != before
    if kind != "repeated":  # there the first record of a video that came in stays
        whole = str(tmp_path / "whole")
        ingest_crawls(spark, raw, whole)
        assert _state(spark, whole) == after


def _parts(base):
    return {
        os.path.join(folder, name) for folder, _, names in os.walk(f"{base}/video_parts") for name in names
        if name.endswith(".parquet")
    }


def test_a_small_crawl_rewrites_the_buckets_of_its_ids(spark, tmp_path):
    raw, base = str(tmp_path / "raw"), str(tmp_path / "tables")
    write(raw, "0101", "0.txt", *(line(id=f"{i:011d}") for i in range(600)))
    ingest_crawls(spark, raw, base, video_buckets=32)
    before = _parts(base)
    assert len(before) == 32
    write(raw, "0202", "0.txt", line(id=f"{7:011d}", category="Sport"), line(id=f"{8:011d}"))
    ingest_crawls(spark, raw, base)
    added = _parts(base) - before
    assert before <= _parts(base) and 1 <= len(added) <= 2  # under a tenth of the files
    videos = {r.id: r for r in Catalog(spark, base).load_table("videos").collect()}
    assert len(videos) == 600 and videos[f"{7:011d}"].category == "sport"
    assert videos[f"{7:011d}"].seen_in_crawls == ["0101", "0202"] and videos[f"{9:011d}"].seen_in_crawls == ["0101"]


def test_unused_partitions_are_dropped(spark, raw, tmp_path):
    base = str(tmp_path / "tables")
    ingest_crawls(spark, raw, base)
    catalog = Catalog(spark, base)
    assert catalog.drop_unused() == 0
    for i in range(4):
        ingest_crawls(spark, raw, base, force=True)
    state = _state(spark, base)
    runs = {name for _, names, _ in os.walk(f"{base}/edges") for name in names if name.startswith("run=")}
    assert len(runs) <= 3
    assert catalog.drop_unused() == 0 and _state(spark, base) == state


def test_crawls_of_a_video_beyond_one_word_of_the_bitmap(spark):
    rng = random.Random(4)
    names = spark.createDataFrame([(n, f"c{n:03d}") for n in range(200)], "number long, id string")
    seen = {f"v{i}": sorted(rng.sample(range(200), rng.randint(1, 150))) for i in range(20)}
    seen["all"] = list(range(200))
    rows = [(v, "u", f"cat{n}", n, None, f"c{n:03d}", n, ) for v, numbers in seen.items() for n in numbers]
    new = spark.createDataFrame(
        rows, "id string, uploader string, category string, length_sec long, date_uploaded date, crawl string, number long"
    ).withColumn("bucket", ingest.bucket_of(F.col("id"), 4))
    early = F.col("number") % 3 == 0
    merged = ingest.merge_videos(ingest.merge_videos(None, new.filter(early)), new.filter(~early))
    got = {r.id: r for r in merged.collect()}
    flat = new.withColumn("seen_in_crawls", F.array("crawl")).drop("crawl", "number", "bucket")
    wanted = {r.id: r for r in ingest.upsert_videos(
        ingest.upsert_videos(None, flat.filter(F.col("length_sec") % 3 == 0)), flat.filter(F.col("length_sec") % 3 != 0)
    ).collect()}
    assert set(got) == set(wanted) == set(seen)
    for video, row in got.items():
        numbers = [64 * word + bit for word, bits in row.seen.items() for bit in range(64) if bits >> bit & 1]
        assert sorted(numbers) == seen[video] and len(row.seen) <= 4
        assert (row.category, row.length_sec) == (wanted[video].category, wanted[video].length_sec)
        assert wanted[video].seen_in_crawls == [f"c{n:03d}" for n in seen[video]]
    assert names.count() == 200


def test_stored_bitmaps_read_as_crawl_ids(spark, tmp_path):
    raw, base = str(tmp_path / "raw"), str(tmp_path / "tables")
    for i in range(70):
        write(raw, f"{i:04d}", "0.txt", line(id="aaaaaaaaaaa"), *([line(id="bbbbbbbbbbb")] if i % 9 == 0 else []))
    ingest_crawls(spark, raw, base)
    write(raw, "9999", "0.txt", line(id="bbbbbbbbbbb"), line(GOOD[0]))
    ingest_crawls(spark, raw, base)
    videos = {r.id: r.seen_in_crawls for r in Catalog(spark, base).load_table("videos").collect()}
    assert videos["aaaaaaaaaaa"] == [f"{i:04d}" for i in range(70)]
    assert videos["bbbbbbbbbbb"] == [f"{i:04d}" for i in range(0, 70, 9)] + ["9999"]


def test_only_named_partitions_are_read(spark, raw, tmp_path):
    base = str(tmp_path / "tables")
    ingest_crawls(spark, raw, base)
    for name in ("edges", "videos"):
        plan = Catalog(spark, base).load_table(name)._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan


def _scratch(spark):
    root = checkpoint_root(spark).removeprefix("file:")
    return {name for name in os.listdir(root) if name.startswith(("classified-", "records-", "new-"))}


def test_a_stream_stores_a_batch_by_parts_and_leaves_no_scratch_tables(spark, raw, tmp_path, monkeypatch):
    """All lines and records of a batch were stored at once, twice over, and stayed until the session ended."""
    write(raw, "0303", "0.txt", line(category="Sport"), line(id="ccccccccccc"), line(length="x"), "  ", line(age="-1"))
    monkeypatch.setattr(incremental, "PART_BYTES", 1)
    monkeypatch.setattr(incremental, "PARTS", 1000)
    stored, plain = [], ingest.first_records_of_lines

    def seen(lines, known=None):
        stored.append(sorted({r.crawl_id for r in lines.collect()}))
        return plain(lines, known)

    monkeypatch.setattr(ingest, "first_records_of_lines", seen)
    before, base, whole = _scratch(spark), str(tmp_path / "tables"), str(tmp_path / "whole")
    for i in range(2):  # with another checkpoint, so that all is read again
        stream_ingest(spark, raw, base, str(tmp_path / f"checkpoint-{i}")).awaitTermination()
        assert _scratch(spark) == before
        if i == 0:
            ingest_crawls(spark, raw, whole)
            before = _scratch(spark)
        assert _state(spark, base) == _state(spark, whole)
    assert stored == [["0101"], ["0202"], ["0303"]] * 2


def test_parts_hold_whole_crawls():
    assert incremental.parts_of({"a": 3, "b": 2, "c": 9, "d": 0, "e": 4, "f": 2}, 5) == [["a", "b"], ["c"], ["d", "e"], ["f"]]
    assert incremental.parts_of({"a": 0, "b": 0}, 0) == [["a", "b"]]
    assert incremental.parts_of({}, 5) == []


def test_a_batch_without_data_files_keeps_the_rejects(spark, raw, tmp_path):
    base, checkpoint = str(tmp_path / "tables"), str(tmp_path / "checkpoint")
    stream_ingest(spark, raw, base, checkpoint).awaitTermination()
    before = _state(spark, base)
    assert before["rejects"]
    write(raw, "0101", "readme.txt", "about")
    stream_ingest(spark, raw, base, checkpoint).awaitTermination()
    assert _state(spark, base) == before


def test_file_names_are_not_patterns(spark, raw, tmp_path):
    write(raw, "0101", "[7] {a,b} c%41+?.txt", line(related(5), id="eeeeeeeeeee"))
    base = str(tmp_path / "tables")
    stream_ingest(spark, raw, base, str(tmp_path / "checkpoint")).awaitTermination()
    videos = Catalog(spark, base).load_table("video_snapshots").filter("crawl_id = '0101'")
    assert sorted(r.video_id for r in videos.collect()) == [GOOD[0], "bbbbbbbbbbb", "eeeeeeeeeee"]


def test_compressed_files_are_read_where_asked_for(spark, raw, tmp_path):
    plain, packed, base = (str(tmp_path / name) for name in ("plain", "packed", "tables"))
    write(raw, "0101", "10.txt", line(views="9"), line(id="bbbbbbbbbbb", views="8"), line(id="fffffffffff"))
    stream_ingest(spark, raw, plain, str(tmp_path / "c0")).awaitTermination()
    for folder, _, names in os.walk(raw):
        for name in names:
            if name != "2.txt":
                with open(f"{folder}/{name}", "rb") as text, gzip.open(f"{folder}/{name}.gz", "wb") as out:
                    out.write(text.read())
                os.remove(f"{folder}/{name}")
    query = stream_ingest(spark, raw, packed, str(tmp_path / "c1"), crawl_files.TEXT_OR_GZIP)
    query.awaitTermination()
    assert _state(spark, packed) == _state(spark, plain)
    stream_ingest(spark, raw, base, str(tmp_path / "c2")).awaitTermination()
    assert [r["id"] for r in Catalog(spark, base).load_table("crawls").collect()] == ["0101"]
