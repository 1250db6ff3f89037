"""Phrase collocations by set-oriented relational mining of occurrences (operator 13).

The texts are read once into a relation of word occurrences (place, word), sorted by place and stored. Places count the
words of a block of texts and skip one wherever a piece or a document ends, so two occurrences lie side by side in one
piece if their places differ by one. Phrases of k + 1 words then come from a merge-join of the sorted
occurrences of phrases of k words with themselves at the next place; they are counted by groups, and the occurrences
are semi-joined with the frequent groups before they are extended to the next length.

- Blocks hold a bounded number of words and a dictionary of their own, so the relation is stored in small numbers
  and every row can be joined within itself: occurrences are never shuffled, only counts are. A piece longer than a block
  goes on in the next one, which begins with the last words of the one before; a phrase is counted where its
  last word is new.
- A word is named by a 64-bit hash of its language and its letters. That no two words share a name is verified on
  the counts; if two do, the relation is made anew with another seed.
- The frequent groups of a length go to the tasks as a bitmap of at most MOST_BITS bits. A false hit only adds a phrase
  that the following count drops, so results are exact. Where the groups would fill more than a quarter of
  the bitmap, the occurrences are joined with them by a shuffle instead, and sorted by place again.

Scores, counts and products are exact (decimals of 38 digits). Null text counts as empty, a null language as `und`.
Repeated rows count each; an empty table gives an empty result. Only text and lang are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from videonet.llm.common import arrow_map, slices, store, table
from videonet.llm.registry import query

BATCH_BYTES = 1 << 20
#: A block is closed at the end of the stretch of text in which it reaches so many words; longest stretch in bytes.
BLOCK_WORDS = 1 << 17
STRETCH_BYTES = 1 << 20
LEAST_COUNT = 10
LONGEST_PHRASE = 3
TOP = 2000
#: 32 MB, the most that is sent to every task.
MOST_BITS = 1 << 28
SEEDS = 20

# A piece ends at . , ; : ! ? and line ends, and words are separated by blanks and tabs.
_FOLD = bytes.maketrans(b",;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"......... abcdefghijklmnopqrstuvwxyz")
_RELATION = ("block long, size int, first_new int, places binary, items binary, names array<long>, langs array<string>,"
             " words array<string>, counts array<long>")


def _stretches(text: bytes) -> Iterator[bytes]:
    """A text in parts of bounded size that are cut before a blank or the end of a piece."""
    at = 0
    while len(text) - at > STRETCH_BYTES:
        cuts = [found for mark in b" ." if (found := text.find(mark, at + STRETCH_BYTES)) >= 0]
        if not cuts:
            break
        yield text[at:min(cuts)]
        at = min(cuts)
    yield text[at:]


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers as they are stored, a quarter of their size or less: batches hold many blocks."""
    return pa.compress(numbers.astype("<i4").tobytes(), "zstd", asbytes=True)


def _unpacked(data: pa.Scalar, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data.as_buffer(), 4 * size, "zstd"), "<i4")


def _numbers(counter) -> dict:
    """Numbers of words in the order in which they are asked for; -1 for the end of a piece."""
    own = defaultdict(counter.__next__)
    own[b"."] = -1
    return own


class _Block:
    """Occurrences of words and the dictionary of one block."""

    def __init__(self, seed: int):
        self.seed = seed
        # Without a reference to the block, which would keep it until cycles are collected.
        self.items: dict[str, dict] = defaultdict(partial(_numbers, count()))
        self.tokens: list[np.ndarray] = []
        self.size = 0
        self.context: list[tuple[str, bytes]] = []  # words of the block before that end it within a piece

    def begin_with(self, context: list[tuple[str, bytes]]) -> None:
        self.context = context
        if context:
            self.tokens.append(np.array([self.items[lang][word] for lang, word in context], np.int32))

    def add(self, lang: str, stretch: bytes) -> None:
        words = stretch.replace(b".", b" . ").split()  # of white space only blanks are left
        numbers = np.fromiter(map(self.items[lang].__getitem__, words), np.int32, len(words))
        self.tokens.append(numbers)
        self.size += len(numbers)

    def end_piece(self) -> None:
        self.tokens.append(np.array([-1], np.int32))

    def row(self, number: int) -> pa.RecordBatch:
        tokens = np.concatenate(self.tokens) if self.tokens else np.empty(0, np.int32)
        places = np.flatnonzero(tokens >= 0).astype(np.int32)
        items = tokens[places]
        known = sorted((item, lang, word) for lang, own in self.items.items() for word, item in own.items() if item >= 0)
        counts = np.bincount(items[len(self.context):], minlength=len(known))
        names = [name_of(lang, word, self.seed) for _, lang, word in known]
        steps = np.diff(places, prepend=np.int32(0))
        values = [number, len(places), len(self.context), _packed(steps), _packed(items), names,
                  [lang for _, lang, _ in known], [word.decode() for _, _, word in known], counts]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()),
                 pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]
        fields = [field.split()[0] for field in _RELATION.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(values, kinds)], names=fields)

    def last_words(self, most: int) -> list[tuple[str, bytes]]:
        """The last words of the block, if it ends within a piece."""
        tail: list[int] = []
        for numbers in reversed(self.tokens):
            for item in numbers[::-1][:most - len(tail)].tolist():
                if item < 0 or len(tail) == most:
                    break
                tail.append(item)
            else:
                if len(tail) < most:
                    continue
            break
        named = {item: (lang, word) for lang, own in self.items.items() for word, item in own.items() if item in tail}
        return [named[item] for item in reversed(tail)]


def name_of(lang: str, word: bytes, seed: int) -> int:
    value = xxhash.xxh64_intdigest(f"{len(lang)}:{lang}".encode() + word, seed)
    return value - 2**64 if value >= 2**63 else value


def _occurrences(seed: int, longest: int, block_words: int, name_bits: int):
    from pyspark import TaskContext

    def work(batches):
        numbers = count(TaskContext.get().partitionId() << 32)
        block = _Block(seed)

        def closed() -> pa.RecordBatch:
            row = block.row(next(numbers))
            fields = row.schema.names
            if name_bits < 64:
                names = [[name >> (64 - name_bits) for name in row.column("names")[0].as_py()]]
                row = row.set_column(fields.index("names"), "names", pa.array(names, pa.list_(pa.int64())))
            return row

        for batch in slices(batches, "text", BATCH_BYTES):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lang = "und" if lang is None else lang
                for stretch in _stretches((text or "").encode().translate(_FOLD)):
                    if block.size >= block_words:
                        yield closed()
                        tail = block.last_words(longest - 1)
                        block = _Block(seed)
                        block.begin_with(tail)
                    block.add(lang, stretch)
                block.end_piece()
        if block.size:
            yield closed()

    return work


def occurrences(docs: DataFrame, seed: int, longest: int = LONGEST_PHRASE, block_words: int = BLOCK_WORDS,
                name_bits: int = 64) -> DataFrame:
    """The sorted relation of word occurrences, one row a block.

    places (as steps from one to the next) and items (numbers of words in the block) are compressed columns; names,
    langs, words and counts are the block's dictionary.
    """
    rows = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    return arrow_map(rows, _occurrences(seed, longest, block_words, name_bits), _RELATION)


def _slots(names: list[np.ndarray], bits: int) -> np.ndarray:
    """The place of each group in a bitmap of a power of two bits."""
    mixed = np.zeros(len(names[0]), np.uint64)
    for column in names:
        mixed = (mixed ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits.bit_length() + 1)


class _Member:
    """Whether groups are frequent: a bitmap (with false hits), or everything where there is none."""

    def __init__(self, data):
        self.bitmap = np.frombuffer(data.value, np.uint8) if data is not None else None

    def __call__(self, names: list[np.ndarray]) -> np.ndarray:
        if self.bitmap is None:
            return np.ones(len(names[0]), bool)
        slots = _slots(names, 8 * len(self.bitmap))
        return (self.bitmap[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1


def merge_join(places: np.ndarray, names: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Occurrences of phrases one word longer: each phrase with the one at the next place; sorted in, sorted out."""
    side_by_side = np.flatnonzero(places[1:] == places[:-1] + 1)
    return places[side_by_side], [names[0][side_by_side], *(column[side_by_side + 1] for column in names)]


def _phrases(length: int, frequent: list, flat: bool):
    """Occurrences of phrases of a length from the stored relation, or only their words where they are to be counted."""
    columns = [f"w{i}" for i in range(1, length + 1)]

    def work(batches):
        members = [_Member(data) for data in frequent]
        for batch in batches:
            for row in range(batch.num_rows):
                block, size, first_new = (batch.column(i)[row].as_py() for i in range(3))
                if not size:
                    continue
                steps, items = (_unpacked(batch.column(i)[row], size) for i in (3, 4))
                places, own = np.cumsum(steps, dtype=np.int32), batch.column(5)[row].values.to_numpy()
                new_from = int(places[first_new]) if first_new < len(places) else int(places[-1]) + 1
                names = [own[items]]
                for words in range(1, length + 1):
                    if words > 1:
                        places, names = merge_join(places, names)
                    if words <= len(members):
                        kept = members[words - 1](names)
                        places, names = places[kept], [column[kept] for column in names]
                if flat:
                    size = len(places)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(size, block)), pa.array(np.full(size, new_from, np.int32)),
                         pa.array(places), *map(pa.array, names)], names=["block", "new_from", "place", *columns])
                else:
                    new = places + (length - 1) >= new_from
                    yield pa.RecordBatch.from_arrays([pa.array(column[new]) for column in names], names=columns)

    return work


def _extended(length: int):
    """Phrases of `length` words from sorted rows (block, new_from, place, w1, ...) of phrases one word shorter."""
    columns = [f"w{i}" for i in range(1, length + 1)]

    def work(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [column.to_numpy() for column in batch.columns]
            rows = now if held is None else [np.concatenate(pair) for pair in zip(held, now)]
            held = [column[-1:] for column in rows]
            block, new_from, place = rows[:3]
            at = np.flatnonzero((block[1:] == block[:-1]) & (place[1:] == place[:-1] + 1))
            names = [rows[3][at], *(column[at + 1] for column in rows[3:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column) for column in (block[at], new_from[at], place[at], *names)],
                names=["block", "new_from", "place", *columns])

    return work


def _kinds(length: int) -> str:
    return ", ".join(f"w{i} long" for i in range(1, length + 1))


def _bitmap(frequent: DataFrame, groups: int, columns: list[str], most_bits: int):
    """The frequent groups as a broadcast bitmap; None where they would fill more than a quarter of the largest."""
    if 4 * groups > most_bits:
        return None
    spark = frequent.sparkSession
    bits = min(most_bits, max(1 << 15, 1 << (16 * groups).bit_length()))

    def slots(batches):
        for batch in batches:
            found = _slots([column.to_numpy() for column in batch.columns], bits)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64))], names=["slot"])

    parts = (
        arrow_map(frequent.select(*columns), slots, "slot long")
        .groupBy(F.shiftright("slot", 15).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit((1 << 15) - 1))).alias("bitmap"))
    )
    whole = bytearray(bits // 8)
    for row in parts.collect():  # at most MOST_BITS in all
        whole[row["part"] << 12:(row["part"] << 12) + len(row["bitmap"])] = row["bitmap"]
    return spark.sparkContext.broadcast(bytes(whole))


def phrase_counts(relation: DataFrame, words: DataFrame, longest: int, least_count: int,
                  most_bits: int = MOST_BITS) -> list[DataFrame]:
    """For each length a table (w1, ..., f) of the frequent phrases, from the relation and the stored counts of words."""
    tables = [words.filter(F.col("f") >= least_count).select(F.col("name").alias("w1"), "f")]
    bitmaps: list = []
    flat: DataFrame | None = None  # occurrences of the phrases counted last, once a bitmap would not hold them
    read = relation.select("block", "size", "first_new", "places", "items", "names")
    for length in range(2, longest + 1):
        before = [f"w{i}" for i in range(1, length)]
        if flat is None:
            found = _bitmap(tables[-1], tables[-1].count(), before, most_bits)
            if found is not None:
                bitmaps.append(found)
            else:
                flat = arrow_map(read, _phrases(length - 1, list(bitmaps), True),
                                 f"block long, new_from int, place int, {_kinds(length - 1)}")
        if flat is None:
            rows = arrow_map(read, _phrases(length, list(bitmaps), False), _kinds(length))
        else:
            semi = flat.join(tables[-1].select(*before), before, "left_semi").select("block", "new_from", "place", *before)
            parts = int(relation.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            # Blocks are of bounded size, so the occurrences of one are a bounded group.
            together = semi.repartition(parts, "block").sortWithinPartitions("block", "place")
            flat = store(
                arrow_map(together, _extended(length), f"block long, new_from int, place int, {_kinds(length)}"),
                f"occurrences-{length}")
            rows = flat.filter(F.col("place") + (length - 1) >= F.col("new_from"))
        columns = [f"w{i}" for i in range(1, length + 1)]
        tables.append(store(
            rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") >= least_count),
            f"frequent-{length}",
        ))
    return tables


def _counted_words(docs: DataFrame, longest: int, block_words: int, name_bits: int) -> tuple[DataFrame, DataFrame]:
    """The stored relation and the stored counts (lang, word, name, f) of all words, each with a name of its own."""
    for seed in range(SEEDS):
        relation = store(occurrences(docs, seed, longest, block_words, name_bits), "word-occurrences")
        entries = relation.select(F.explode(F.arrays_zip("langs", "words", "names", "counts")).alias("e")).select(
            F.col("e.langs").alias("lang"), F.col("e.words").alias("word"), F.col("e.names").alias("name"),
            F.col("e.counts").alias("n"))
        words = store(
            entries.groupBy("lang", "word", "name").agg(F.sum("n").alias("f")).filter("f > 0"), "word-counts")
        if words.groupBy("name").agg(F.count(F.lit(1)).alias("words")).filter("words > 1").isEmpty():
            return relation, words
    raise RuntimeError(f"none of {SEEDS} seeds gave every word a name of its own")


def collocations(docs: DataFrame, longest: int = LONGEST_PHRASE, least_count: int = LEAST_COUNT, top: int = TOP,
                 block_words: int = BLOCK_WORDS, most_bits: int = MOST_BITS, name_bits: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language.

    A phrase of 2 to `longest` words that occurs `least_count` times or more is cut where its score, the floor of
    1,000,000 a a / (l r), is least; phrases within a longer one that has half of their occurrences are left out.
    """
    relation, all_words = _counted_words(docs, longest, block_words, name_bits)
    words = store(all_words.filter(F.col("f") >= least_count), "frequent-words")
    tables = phrase_counts(relation, words, longest, least_count, most_bits)
    totals = all_words.groupBy("lang").agg(F.sum("f").alias("n"))
    chosen = None
    for length in range(2, longest + 1):
        names = [f"w{i}" for i in range(1, length + 1)]
        rows = tables[length - 1].withColumnRenamed("f", "a")
        for cut in range(1, length):
            left, right = tables[cut - 1], tables[length - cut - 1]
            rows = rows.join(left.select(*(F.col(f"w{i}") for i in range(1, cut + 1)), F.col("f").alias(f"l{cut}")),
                             names[:cut])
            rest = right.select(*(F.col(f"w{i}").alias(f"w{i + cut}") for i in range(1, length - cut + 1)),
                                F.col("f").alias(f"r{cut}"))
            rows = rows.join(rest, names[cut:])
        cuts = [
            F.struct(
                F.expr(f"cast((cast(1000000 AS decimal(38, 0)) * a * a) div (cast(l{cut} AS decimal(38, 0)) * r{cut})"
                       " AS bigint)").alias("score"),
                F.lit(cut).alias("cut"), F.col(f"l{cut}").alias("l"), F.col(f"r{cut}").alias("r"))
            for cut in range(1, length)
        ]
        rows = rows.withColumn("best", cuts[0] if len(cuts) == 1 else F.least(*cuts))
        covers = [
            tables[more - 1].select(
                *(F.col(f"w{i + at}").alias(f"w{i}") for i in range(1, length + 1)), F.col("f").alias("longer"))
            for more in range(length + 1, longest + 1) for at in range(more - length + 1)
        ]
        if covers:
            union = covers[0]
            for cover in covers[1:]:
                union = union.union(cover)
            rows = rows.join(union.groupBy(*names).agg(F.max("longer").alias("longer")), names, "left").filter(
                F.coalesce(100 * F.col("longer") < 50 * F.col("a"), F.lit(True)))
        for i, name in enumerate(names):
            spelled = words.select(F.col("name").alias(name), F.col("word").alias(f"t{i}"),
                                   *([F.col("lang")] if i == 0 else []))
            rows = rows.join(spelled, name)
        part = rows.select("lang", F.concat_ws(" ", *(f"t{i}" for i in range(length))).alias("phrase"), "a",
                           F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))
        chosen = part if chosen is None else chosen.union(part)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = chosen.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]') AS p
  FROM documents),
piece AS (SELECT d, lang, unnest(p) AS t, generate_subscripts(p, 1) AS j FROM pieces),
split AS (SELECT d, lang, j, regexp_extract_all(t, '[^ \t]+') AS w FROM piece),
word AS (SELECT d, lang, j, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM split),
run AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM word WINDOW o AS (PARTITION BY d, j ORDER BY i)),
f1 AS (SELECT lang, w1, count(*) AS f FROM run GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM run WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM run WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
cut AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r, 1 AS k FROM f2
  JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w1 = f2.w1 AND f3.w2 = f2.w2 AND 100 * f3.f >= 50 * f2.f)
    AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w2 = f2.w1 AND f3.w3 = f2.w2 AND 100 * f3.f >= 50 * f2.f)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, x.f, y.f, 1 FROM f3
  JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1
  JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, x.f, y.f, 2 FROM f3
  JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2
  JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cut),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best JOIN total USING (lang) QUALIFY rank <= 2000
"""


@query("op13_collocations", SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
