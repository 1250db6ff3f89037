"""Fill-in-middle transformation with cuts found in an indexable skip list (operator 12).

A text is a row of units: the matches of a pattern from left to right, each with what stands unmatched before it.
Two cut ranks are drawn per document from a digest of its id, and prefix, middle and suffix are what lies before,
between and behind the cuts. An indexable skip list over the units finds them: each node of an express lane covers
up to FAN_OUT nodes of the lane below and carries its width in units and in code points. A descent from the
top lane adds widths while the rank is not passed, so it reads at most FAN_OUT nodes a lane and arrives at the exact
unit and at its code point at once. A list is searched twice and never changed, so its nodes rise at even steps
instead of at random ones.

The parts are written as prefix-suffix-middle or suffix-prefix-middle with marks between them, or as they are:
documents drawn to stay plain, empty ones, and texts that hold a mark themselves. As a transformed text holds no mark of
its own and no mark begins as another ends, the first mark of each kind is the true one, and `restore` is exact.

Null text counts as empty, a null id as the digest of the seed alone. Repeated rows get equal results; an empty table
gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.llm.common import arrow_map, slices, table
from videonet.llm.registry import query

BATCH_BYTES = 2 << 20
FAN_OUT = 16
#: A unit of one code point.
CODE_POINT = "(?s:.)"


@dataclass(frozen=True)
class Settings:
    """How documents are cut: pattern of a unit, seed of the draws, shares in percent, and the three marks."""

    unit: str = CODE_POINT
    seed: str = "1"
    transformed_percent: int = 90
    suffix_first_percent: int = 20
    prefix_mark: str = "<P>"
    suffix_mark: str = "<S>"
    middle_mark: str = "<M>"

    def marks(self) -> tuple[str, str, str]:
        return self.prefix_mark, self.suffix_mark, self.middle_mark

    def __post_init__(self):
        marks = self.marks()
        borders = any(one[i:] and other.startswith(one[i:]) for one in marks for other in marks
                      for i in range(len(one)) if (one, 0) != (other, i))
        if not all(marks) or len(set(marks)) < 3 or borders or any(
                one in other for one in marks for other in marks if one != other):
            raise ValueError("no mark may be empty, hold another one, or begin as one ends")


class SkipList:
    """Units by rank: `seek` gives the code points before a unit."""

    def __init__(self, points: np.ndarray):
        """`points` are the code points of each unit."""
        self.size = len(points)
        # From the lowest lane up: code points and units of each node.
        self.lanes = [(points, np.ones(len(points), np.uint8))]
        while len(self.lanes[-1][0]) > FAN_OUT:
            below_points, below_units = self.lanes[-1]
            starts = np.arange(0, len(below_points), FAN_OUT)
            self.lanes.append((
                np.add.reduceat(below_points, starts, dtype=np.int64), np.add.reduceat(below_units, starts, dtype=np.int64)
            ))

    def seek(self, rank: int) -> int:
        """The code points of the first `rank` units."""
        if not 0 <= rank <= self.size:
            raise IndexError(rank)
        node = units = points = 0
        for lane_points, lane_units in reversed(self.lanes):
            node *= FAN_OUT
            while node < len(lane_units) and units + int(lane_units[node]) <= rank:
                units += int(lane_units[node])
                points += int(lane_points[node])
                node += 1
        return points


def unit_points(text: str, unit: str) -> np.ndarray:
    """The code points of each unit of a text."""
    if unit == CODE_POINT:
        return np.ones(len(text), np.uint8)
    ends = np.fromiter((match.end() for match in regex.finditer(unit, text)), np.int64)
    return np.diff(ends, prepend=0)


def transform_text(doc_id: int | None, text: str, settings: Settings) -> dict:
    """The form, the parts and the written text of one document."""
    key = f"{settings.seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    points = unit_points(text, settings.unit)
    n = len(points)
    plain = not text or h3 % 100 >= settings.transformed_percent or any(mark in text for mark in settings.marks())
    if plain:
        return {"n_units": n, "form": "plain", "prefix": None, "middle": None, "suffix": None, "output": text}
    units = SkipList(points)
    first, second = sorted((units.seek(h1 % (n + 1)), units.seek(h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    p, s, m = settings.marks()
    if h4 % 100 < settings.suffix_first_percent:
        form, output = "spm", f"{s}{suffix}{p}{prefix}{m}{middle}"
    else:
        form, output = "psm", f"{p}{prefix}{s}{suffix}{m}{middle}"
    return {"n_units": n, "form": form, "prefix": prefix, "middle": middle, "suffix": suffix, "output": output}


_COLUMNS = ("n_units", "form", "prefix", "middle", "suffix", "output")
_FIM = "doc_id long, n_units long, form string, prefix string, middle string, suffix string, output string"


def _transform(settings: Settings):
    def work(batches):
        for batch in slices(batches, "text", BATCH_BYTES):
            rows = [
                transform_text(doc_id, text or "", settings)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            columns = [pa.array([row[name] for row in rows], pa.int64() if name == "n_units" else pa.string())
                       for name in _COLUMNS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *_COLUMNS])

    return work


def fill_in_middle(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_units, form, prefix, middle, suffix, output): the parts are null where the form is plain."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, _transform(settings), _FIM)


def restore(transformed: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows with a column `restored`: the text as it was, from `output` and `form` alone."""
    p, s, m = settings.marks()
    output, form = F.col("output"), F.col("form")

    def behind(whole, first, mark):
        return whole.substr(F.length(first) + len(mark) + 1, F.length(whole))

    body = F.substring_index(output, m, 1)
    middle = behind(output, body, m)
    rebuilt = {}
    for name, outer, inner in (("psm", p, s), ("spm", s, p)):
        first = F.substring_index(body, inner, 1)
        rebuilt[name] = first.substr(F.lit(len(outer) + 1), F.length(first)), behind(body, first, inner)
    return transformed.withColumn(
        "restored",
        F.when(form == "psm", F.concat(rebuilt["psm"][0], middle, rebuilt["psm"][1]))
        .when(form == "spm", F.concat(rebuilt["spm"][1], middle, rebuilt["spm"][0]))
        .otherwise(output),
    )


SQL = r"""
WITH plain AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, n, ('0x' || h[1:8])::BIGINT % (n + 1) AS c1, ('0x' || h[9:16])::BIGINT % (n + 1) AS c2,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
           OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
         WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM plain),
cut AS (
  SELECT *, substring(t, 1, least(c1, c2)) AS p, substring(t, least(c1, c2) + 1, abs(c1 - c2)) AS m,
    substring(t, greatest(c1, c2) + 1) AS s FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(c1, c2) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN abs(c1 - c2) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM cut
"""


@query("op12_fill_in_middle", SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore(fill_in_middle(table(spark, sf_dir, "documents"))).select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )
