"""Quality rules with thresholds learned from the data (operator 9).

Every document is measured with SQL functions alone. The measures of the documents that pass the base rules
go into quantile sketches per language and source: counts per bin of a log-linear histogram, 32 bins to an
octave, so a quantile is off by at most 1/32 of its value. Sketches are merged by adding counts, which is an
ordinary grouped sum with map-side combine; a group of fewer than `min_docs` documents takes the merged
sketch of its language, and failing that the one of all documents. Each rule rejects what lies far outside
the quartiles of its group. All arithmetic is on integers, so a rerun gives the same verdicts.

Null text counts as empty: no words, so the base rule rejects it. Null language or source is a group of its
own. Repeated rows are measured each. An empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.llm.common import SPACE_CLASS, WORD_CLASS, store, table
from videonet.llm.registry import query

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_DOCS = 100
#: Rule: (times the quartile distance, least quartile distance assumed).
FENCES = {"word_length": (8, 25), "symbols": (4, 30), "dup_lines": (4, 100)}
RULES = list(FENCES)
MEASURES = "__measures"


def _paired(left: str, right: str, body: str) -> Column:
    return F.expr(f"zip_with({left}, {right}, (a, b) -> {body})")


def _windows(df: DataFrame, words: str, out: str, join_words) -> DataFrame:
    """Arrays over all windows of five words, built from pairs and pairs of pairs: linear in the words."""
    n = f"size({words})"

    def part(array: str, start: int, size: int) -> str:
        # The elements of `array` that begin a run of `size` words, from the `start`th word on.
        return f"slice({array}, {start}, greatest({n} - {size - 1}, 0))"

    df = df.withColumn("__two", _paired(part(words, 1, 2), part(words, 2, 2), join_words))
    df = df.withColumn("__four", _paired(part("__two", 1, 4), part("__two", 3, 4), join_words))
    df = df.withColumn(out, _paired(part("__four", 1, 5), part(words, 5, 5), join_words))
    return df.drop("__two", "__four")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with a struct of measures: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, and per rule an integer (word length in hundredths, symbols and repeated lines in thousandths).

    n_repeat_words counts the words in windows of five words that the text has twice or more. Hashes of the
    windows tell whether there are any; only then are the windows themselves compared, so the count is exact.
    Store the result before filtering by a measure: the optimizer would copy the expressions into the filter.
    """
    kept = docs.columns
    df = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("__words", F.expr(f"array_remove(split(__text, r'{SPACE_CLASS}+'), '')"))
    df = df.withColumn("__lines", F.expr(rf"filter(split(__text, '\n'), l -> l rlike r'{WORD_CLASS}')"))
    df = df.withColumn("__hashes", F.expr("transform(__words, w -> xxhash64(w))"))
    df = _windows(df, "__hashes", "__hashed", "xxhash64(a, b)")
    df = df.withColumn(
        "__again",
        F.when(F.size(F.array_distinct("__hashed")) < F.size("__hashed"), F.col("__words")).otherwise(
            F.expr("cast(array() AS array<string>)")
        ),
    )
    df = _windows(df, "__again", "__spelled", "concat(a, ' ', b)")
    df = df.withColumn(
        "__sorted", F.expr("sort_array(transform(__spelled, (w, i) -> struct(w AS w, i AS i)))")
    )
    df = df.withColumn("__rest", F.expr("greatest(size(__sorted) - 1, 0)"))
    df = df.withColumn(
        "__starts",
        F.sort_array(F.array_distinct(F.flatten(_paired(
            "slice(__sorted, 1, __rest)", "slice(__sorted, 2, __rest)",
            "if(a.w = b.w, array(a.i, b.i), cast(array() AS array<int>))",
        )))),
    )
    # Each window adds the words up to the next one, five at most; the last adds five.
    df = df.withColumn("__left", F.expr("greatest(size(__starts) - 1, 0)"))
    steps = _paired(
        "slice(__starts, 1, __left)", "slice(__starts, 2, __left)", f"least({WINDOW}, b - a)"
    )
    df = df.withColumn(
        "__repeat",
        F.when(F.size("__starts") == 0, F.lit(0).cast("long")).otherwise(
            F.aggregate(steps, F.lit(WINDOW).cast("long"), lambda total, x: total + x)
        ),
    )
    counts = df.withColumn(
        "__counts",
        F.struct(
            F.size("__words").cast("long").alias("n_words"),
            F.char_length(F.concat_ws("", "__words")).cast("long").alias("word_chars"),
            (F.char_length("__text")
             - F.char_length(F.regexp_replace("__text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
            F.size("__lines").cast("long").alias("n_lines"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            F.col("__repeat").alias("n_repeat_words"),
        ),
    ).select(*[F.col(f"`{name}`") for name in kept], "__counts")
    return counts.withColumn(MEASURES, F.expr(f"""struct(
        __counts.n_words, __counts.word_chars, __counts.n_symbols, __counts.n_dup_lines, __counts.n_repeat_words,
        __counts.n_words < {MIN_WORDS}
          OR 100 * __counts.n_repeat_words > {MAX_REPEAT_PERCENT} * __counts.n_words AS base_failed,
        100 * __counts.word_chars div greatest(__counts.n_words, 1) AS word_length,
        1000 * __counts.n_symbols div greatest(__counts.n_words, 1) AS symbols,
        1000 * __counts.n_dup_lines div greatest(__counts.n_lines, 1) AS dup_lines)""")).drop("__counts")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, rule, bin, n): the histogram of each rule's measure; add up n to merge groups.

    A bin is named by its least value: the value itself below 64, else its first six binary digits.
    """
    rules = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(f"{MEASURES}.{rule}").alias("value")) for rule in RULES
    ]))
    return (
        measured.filter(~F.col(f"{MEASURES}.base_failed"))
        .select("lang", "source", rules.alias("r"))
        .select(
            "lang", "source", "r.rule",
            F.expr("r.value - r.value % shiftleft(1L, greatest(length(bin(r.value)) - 6, 0))").alias("bin"),
        )
        .groupBy("lang", "source", "rule", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quartiles(merged: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rule, docs, low, high): quartiles from sketches; a group has no more rows than a sketch has bins."""
    from pyspark.sql import Window

    group = Window.partitionBy(*keys, "rule")
    ranked = merged.withColumn("docs", F.sum("n").over(group)).withColumn(
        "upto", F.sum("n").over(group.orderBy("bin"))
    )
    return ranked.groupBy(*keys, "rule").agg(
        F.max("docs").alias("docs"),
        F.min(F.when(F.col("upto") * 4 >= F.col("docs"), F.col("bin"))).alias("low"),
        F.min(F.when(F.col("upto") * 4 >= F.col("docs") * 3, F.col("bin"))).alias("high"),
    )


def thresholds(measured: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, <rule>_least, <rule>_most): one row for each language and source."""
    leaves = sketches(measured)
    leaves = store(leaves, "quality-sketches")
    by_lang = leaves.groupBy("lang", "rule", "bin").agg(F.sum("n").alias("n"))
    overall = by_lang.groupBy("rule", "bin").agg(F.sum("n").alias("n"))
    own = quartiles(leaves, ["lang", "source"])
    lang = quartiles(by_lang, ["lang"]).select(
        F.col("lang").alias("lang_"), F.col("rule").alias("rule_"), F.struct("docs", "low", "high").alias("of_lang")
    )
    whole = quartiles(overall, []).select(F.col("rule").alias("rule_"), F.struct("docs", "low", "high").alias("of_all"))
    chosen = (
        own.join(lang, F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("rule") == F.col("rule_")))
        .drop("lang_", "rule_")
        .join(whole, F.col("rule") == F.col("rule_"))
        .select(
            "lang", "source", "rule",
            F.when(F.col("docs") >= min_docs, F.struct("docs", "low", "high"))
            .when(F.col("of_lang.docs") >= min_docs, F.col("of_lang"))
            .otherwise(F.col("of_all")).alias("q"),
        )
    )

    def fence(rule: str, side: str) -> Column:
        times, least = FENCES[rule]
        reach = f"{times}L * greatest(q.high - q.low, {least}L)"
        bound = f"q.high + q.high div 32 + {reach}" if side == "most" else f"q.low - {reach}"
        return F.max(F.when(F.col("rule") == rule, F.expr(bound))).alias(f"{rule}_{side}")

    return chosen.groupBy("lang", "source").agg(
        *[fence(rule, side) for rule in RULES for side in ("least", "most")]
    )


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """The measured rows with `__kept`, by a join with their group's thresholds."""
    renamed = limits.withColumnsRenamed({name: f"__{name}" for name in limits.columns})
    joined = measured.join(
        renamed,
        F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")),
        "left",
    )
    inside = F.lit(True)
    for rule in RULES:
        inside &= F.col(f"{MEASURES}.{rule}").between(F.col(f"__{rule}_least"), F.col(f"__{rule}_most"))
    kept = ~F.col(f"{MEASURES}.base_failed") & F.coalesce(inside, F.lit(False))
    return joined.withColumn("__kept", kept).drop(*renamed.columns)


def keep_good(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents that all rules keep, with their columns."""
    measured = store(measure(docs), "quality-measured")
    limits = store(thresholds(measured, min_docs), "quality-thresholds")
    return judge(measured, limits).filter("__kept").select(*[F.col(f"`{name}`") for name in docs.columns])


# Whether a document is kept, in DuckDB's SQL: the measures, sketches, quartiles and fences as above.
SQL = f"""
WITH worded AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
places AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM worded),
grams AS (
  SELECT doc_id, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o || ' '
         || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS g
  FROM places WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
starts AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
  FROM grams JOIN (SELECT doc_id, g FROM grams WHERE g IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
       USING (doc_id, g)),
repeats AS (SELECT doc_id, sum(CASE WHEN before IS NULL THEN 5 ELSE least(5, i - before) END) AS r
            FROM starts GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang, source, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words
  FROM worded LEFT JOIN repeats USING (doc_id)),
measured AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         100 * word_chars // greatest(n_words, 1) AS word_length,
         1000 * n_symbols // greatest(n_words, 1) AS symbols,
         1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines
  FROM counted),
vals AS (
  SELECT lang, source, 'word_length' AS rule, word_length AS v FROM measured WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'symbols', symbols FROM measured WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'dup_lines', dup_lines FROM measured WHERE NOT base_failed),
leaf AS (
  SELECT lang, source, rule, v - v % (1::BIGINT << greatest(length(bin(v)) - 6, 0)) AS b, count(*) AS n
  FROM vals GROUP BY ALL),
own AS (SELECT lang, source, rule, max(d) AS docs, min(CASE WHEN 4 * u >= d THEN b END) AS lo,
               min(CASE WHEN 4 * u >= 3 * d THEN b END) AS hi
        FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, rule) AS d,
                     sum(n) OVER (PARTITION BY lang, source, rule ORDER BY b) AS u FROM leaf) GROUP BY ALL),
of_lang AS (SELECT lang, rule, max(d) AS docs, min(CASE WHEN 4 * u >= d THEN b END) AS lo,
               min(CASE WHEN 4 * u >= 3 * d THEN b END) AS hi
        FROM (SELECT *, sum(n) OVER (PARTITION BY lang, rule) AS d,
                     sum(n) OVER (PARTITION BY lang, rule ORDER BY b) AS u
              FROM (SELECT lang, rule, b, sum(n) AS n FROM leaf GROUP BY ALL)) GROUP BY ALL),
of_all AS (SELECT rule, max(d) AS docs, min(CASE WHEN 4 * u >= d THEN b END) AS lo,
               min(CASE WHEN 4 * u >= 3 * d THEN b END) AS hi
        FROM (SELECT *, sum(n) OVER (PARTITION BY rule) AS d,
                     sum(n) OVER (PARTITION BY rule ORDER BY b) AS u
              FROM (SELECT rule, b, sum(n) AS n FROM leaf GROUP BY ALL)) GROUP BY ALL),
chosen AS (
  SELECT o.lang, o.source, o.rule,
    CASE WHEN o.docs >= {MIN_DOCS} THEN o.lo WHEN g.docs >= {MIN_DOCS} THEN g.lo ELSE a.lo END AS lo,
    CASE WHEN o.docs >= {MIN_DOCS} THEN o.hi WHEN g.docs >= {MIN_DOCS} THEN g.hi ELSE a.hi END AS hi
  FROM own o JOIN of_lang g ON o.lang IS NOT DISTINCT FROM g.lang AND o.rule = g.rule
             JOIN of_all a ON o.rule = a.rule),
fences AS (
  SELECT lang, source, rule, lo - k * greatest(hi - lo, s) AS least_, hi + hi // 32 + k * greatest(hi - lo, s) AS most_
  FROM chosen JOIN (VALUES {", ".join(f"('{r}', {k}, {s})" for r, (k, s) in FENCES.items())}) AS f(rule, k, s)
       USING (rule)),
wide AS (
  SELECT lang, source,
    {", ".join(f"max(CASE WHEN rule = '{r}' THEN least_ END) AS {r}_least, max(CASE WHEN rule = '{r}' THEN most_ END) AS {r}_most" for r in RULES)}
  FROM fences GROUP BY lang, source)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({" AND ".join(f"{r} BETWEEN {r}_least AND {r}_most" for r in RULES)}, false) AS kept
FROM measured m LEFT JOIN wide w ON m.lang IS NOT DISTINCT FROM w.lang AND m.source IS NOT DISTINCT FROM w.source
"""


@query("op9_quality_rules", SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; the text is dropped before anything is written."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    measured = store(measure(docs).drop("text"), "quality-measured")
    limits = store(thresholds(measured), "quality-thresholds")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judge(measured, limits).select(
        "doc_id", *[F.col(f"{MEASURES}.{name}") for name in names], F.col("__kept").alias("kept")
    )
