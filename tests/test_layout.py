"""Stored edge layouts: same answers, no shuffle of edges, whole or not there at all."""

import re

import pytest

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests import helpers
from tests.helpers import edge_frame, hub_graph
from videonet.operators import influence, patterns
from videonet.operators.graph import MessageRoutes
from videonet.operators.skew import SLICE
from videonet.sources.layout import EdgeLayout

HUBS = hub_graph()
SLICES = [1_000_000, 3]


def videos(spark):
    rows = [(v, f"u{i % 3}", "music" if i % 2 else "film") for i, v in enumerate(helpers.nodes(HUBS))]
    return spark.createDataFrame(rows, "id string, uploader string, category string")


def matches(frame):
    return sorted(tuple(map(str, row)) for row in frame.collect())


@pytest.mark.parametrize("rows_per_slice", SLICES)
def test_layout_gives_the_same_answers(spark, tmp_path, rows_per_slice):
    lost = edge_frame(spark, HUBS + [("n01", None), (None, "n02"), ("n05", "n05")])
    layout = EdgeLayout.store(lost, str(tmp_path / "layout"), buckets=4, rows_per_slice=rows_per_slice)
    kept = HUBS + [("n05", "n05")]
    assert {end: layout.by(end).count() for end in ("src", "dst")} == {"src": len(kept), "dst": len(kept)}
    ranks = {r.id: r.pagerank for r in influence.pagerank(layout, 0.2, 4).collect()}
    assert ranks == pytest.approx(helpers.pagerank(kept, 0.2, 4), abs=1e-9)
    whole = patterns.motif_edge(edge_frame(spark, kept), videos(spark), "music")
    assert matches(patterns.motif_edge(layout, videos(spark), "music")) == matches(whole)


def test_no_bucket_holds_all_edges_of_a_hub(spark, tmp_path):
    edges = edge_frame(spark, [("hub", f"v{i:04d}") for i in range(3000)] + [("v0001", "v0002")])
    layout = EdgeLayout.store(edges, str(tmp_path / "layout"), buckets=8, rows_per_slice=100)
    files = layout.by("src").groupBy(F.input_file_name()).count().collect()
    assert sum(row["count"] for row in files) == 3001 and max(row["count"] for row in files) < 1500
    assert layout.by("src").filter("src = 'hub'").select(SLICE).distinct().count() == 30


def plan_of(frame):
    """The plan that was run, as adaptive execution knows the partitioning of a cached frame only then."""
    execution = frame._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def below(plan, marker):
    """Operators between the root of a plan and the scan whose line holds the marker, from the scan upwards."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if marker in line)
    depth, found = len(re.match(r"[\s:|+-]*", lines[at])[0]), []
    for line in reversed(lines[:at]):
        here = len(re.match(r"[\s:|+-]*", line)[0])
        if here < depth:
            depth = here
            found.append(line)
    return found


def first_join(path):
    return next(i for i, line in enumerate(path) if "Join" in line)


@pytest.mark.parametrize("rows_per_slice", SLICES)
def test_edges_meet_vertices_without_a_shuffle(spark, tmp_path, rows_per_slice):
    layout = EdgeLayout.store(edge_frame(spark, HUBS), str(tmp_path / "layout"), 4, rows_per_slice)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        path = below(plan_of(patterns.motif_edge(layout, videos(spark), "music")), "edges_by_src")
        assert not [line for line in path[: first_join(path)] if "Exchange" in line]
        with MessageRoutes.stored(layout) as routes:
            inner = routes.edges._jdf.queryExecution().withCachedData().toString()
            assert "InMemoryRelation" in inner and "Exchange" not in inner
            state = layout.vertices().select("id", F.lit(1.0).alias("rank"))
            path = below(plan_of(routes.send(state)), "InMemoryTableScan")
            assert not [line for line in path[: first_join(path)] if "Exchange" in line]
        links = edge_frame(spark, HUBS).selectExpr("src AS sender", "dst AS receiver", "1L AS weight")
        with MessageRoutes(links, rows_per_slice) as routes:
            path = below(plan_of(routes.send(state)), "InMemoryTableScan")
            assert not [line for line in path[: first_join(path)] if "Exchange" in line]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_layout_is_opened_by_path_and_only_when_whole(spark, tmp_path):
    path = str(tmp_path / "layout")
    EdgeLayout.store(edge_frame(spark, HUBS), path, 4, 3).forget()
    again = EdgeLayout(spark, path + "/")
    assert again.buckets == 4
    assert matches(again.by("dst").select("src", "dst")) == sorted(HUBS)
    with pytest.raises(AnalysisException):
        EdgeLayout.store(edge_frame(spark, HUBS), path)
    with pytest.raises(AnalysisException):
        EdgeLayout(spark, str(tmp_path / "broken-off"))


def test_layout_of_no_edges(spark, tmp_path):
    layout = EdgeLayout.store(edge_frame(spark, []), str(tmp_path / "layout"))
    assert layout.by("src").count() == 0 and layout.vertices().count() == 0
    assert influence.pagerank(layout).count() == 0
