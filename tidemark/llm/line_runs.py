"""Repeated runs of lines across a corpus, by prefix doubling over line ids.

The texts are sequences of line ids. Suffixes are classed by their first 1, 2, 4, ... lines; the
class of twice as many lines is the pair of the class here and the class that many lines on. A class
is named by its earliest member, so one grouping per round gives names and earliest copies
together. Classes of one member leave after each round: no common prefix of theirs is longer.
The doubling ends at `min_lines`, the common-prefix interval that decides: every maximal repeated
run of at least that many lines is the union of the members of such intervals that overlap it, and
a member that is not the earliest is a later copy. Neighbouring later copies join to maximal runs,
and their lines are deleted. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut

MIN_LINES = 3


def line_id(line: Column) -> Column:
    """128 bits of the line without its outer white space and with inner runs as one space."""
    bare = F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))
    return F.when(bare != "", F.struct(F.xxhash64(bare), F.xxhash64(F.lit(1), bare)))


def numbered_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, place, line): `place` counts the lines with a word, null for others."""
    lines = docs.select(
        "doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "raw")
    ).select("doc_id", "line_no", line_id(F.col("raw")).alias("line"))
    return lines


def later_copies(lines: DataFrame, min_lines: int) -> DataFrame:
    """(doc_id, place) where a run of `min_lines` lines starts that also starts earlier somewhere.

    `lines`: doc_id, place, line; places of a document count from 0 without gaps.
    """
    classes = cut(_classes(lines.select("doc_id", "place", F.col("line").alias("pair"))))
    step = 1
    while step < min_lines:
        shift = min(step, min_lines - step)
        after = classes.select(
            "doc_id", (F.col("place") - shift).alias("place"), F.col("name").alias("next")
        )
        pairs = classes.join(after, ["doc_id", "place"]).select(
            "doc_id", "place", F.struct("name", "next").alias("pair")
        )
        classes = cut(_classes(pairs))
        step += shift
    return classes.where(
        (F.col("name.doc_id") != F.col("doc_id")) | (F.col("name.place") != F.col("place"))
    ).select("doc_id", "place")


def _classes(suffixes: DataFrame) -> DataFrame:
    """Each suffix of a class with two or more members, with the class's earliest member."""
    named = (
        suffixes.groupBy("pair")
        .agg(
            F.min(F.struct("doc_id", "place")).alias("name"),
            F.count(F.lit(1)).alias("n_members"),
        )
        .where("n_members > 1")
        .select("pair", "name")
    )
    return suffixes.join(named, "pair").select("doc_id", "place", "name")


def line_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES
) -> DataFrame:
    """One row per id: id, n_lines, n_deleted, the deleted runs, and the text without them.

    A line is deleted when it lies in a run of at least `min_lines` lines (those without a word not
    counted) that also starts earlier, by id and line. Lines without a word stay. `runs` lists
    (first line, last line) of the deleted stretches, in the numbers of the original lines, broken
    only by a line that stays and has a word. Null texts are empty: one line, nothing deleted. Rows
    that repeat an id and its text are one document, as are those without an id; of different
    texts under one id each is judged alone, and all of them are returned.
    Other columns are not read. An empty table gives an empty result.
    """
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    keyed = own.select(
        F.struct("id", F.xxhash64("text").alias("version")).alias("doc_id"), "id", "text"
    )
    by_text = Window.partitionBy("doc_id").orderBy("line_no")
    numbered = cut(
        numbered_lines(keyed)
        .dropDuplicates(["doc_id", "line_no"])
        .where("line IS NOT NULL")
        .withColumn("place", F.row_number().over(by_text) - 1)
    )
    starts = later_copies(numbered.select("doc_id", "place", "line"), min_lines)
    spans = starts.select("doc_id", "place", F.lit(1).alias("opens")).unionByName(
        starts.select("doc_id", (F.col("place") + min_lines).alias("place"), F.lit(-1).alias("opens"))
    )
    edges = spans.groupBy("doc_id", "place").agg(F.sum("opens").alias("opens"))
    running = Window.partitionBy("doc_id").orderBy("place")
    deleted = (
        numbered.join(starts.select("doc_id").distinct(), "doc_id", "left_semi")
        .join(edges, ["doc_id", "place"], "left")
        .select("doc_id", "line_no", "place", F.sum(F.coalesce("opens", F.lit(0))).over(running).alias("open"))
        .where("open > 0")
        .select(
            "doc_id", "line_no", (F.col("place") - F.row_number().over(running)).alias("stretch")
        )
    )
    runs = (
        deleted.groupBy("doc_id", "stretch")
        .agg(
            F.min("line_no").alias("first"),
            F.max("line_no").alias("last"),
            F.collect_list("line_no").alias("line_nos"),
        )
        .groupBy("doc_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"),
            F.array_sort(F.flatten(F.collect_list("line_nos"))).alias("line_nos"),
        )
    )
    kept_lines = F.filter(
        F.transform(
            F.split("text", "\n"),
            lambda line, i: F.when(~F.array_contains("gone", i), line),
        ),
        lambda line: line.isNotNull(),
    )
    nothing = F.array().cast("array<int>")
    return (
        keyed.join(runs, "doc_id", "left")
        .withColumn("gone", F.coalesce("line_nos", nothing))
        .select(
            F.col("id").alias(id_col),
            F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
            F.size("gone").cast("bigint").alias("n_deleted"),
            F.coalesce("runs", F.array().cast("array<struct<first:int,last:int>>")).alias("runs"),
            F.when(F.size("gone") == 0, F.col("text"))
            .otherwise(F.array_join(kept_lines, "\n"))
            .alias("text"),
        )
    )


def sql(min_lines: int = MIN_LINES) -> str:
    """The query's result in DuckDB."""
    return rf"""
WITH raw AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no
             FROM documents),
bare AS (SELECT doc_id, line_no, line,
                trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS norm FROM raw),
seq AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS place
        FROM bare WHERE norm <> ''),
win AS (SELECT doc_id, place, list(norm) OVER (PARTITION BY doc_id ORDER BY place
               ROWS BETWEEN CURRENT ROW AND {min_lines - 1} FOLLOWING) AS run FROM seq),
later AS (SELECT doc_id, place, row_number() OVER (PARTITION BY run ORDER BY doc_id, place) AS n
          FROM win WHERE len(run) = {min_lines}),
gone AS (SELECT DISTINCT s.doc_id, s.line_no FROM seq s JOIN later l
         ON l.doc_id = s.doc_id AND l.n > 1 AND s.place BETWEEN l.place AND l.place + {min_lines - 1})
SELECT r.doc_id, count(*) AS n_lines, count(g.line_no) AS n_deleted,
       sha256(coalesce(string_agg(r.line, chr(10) ORDER BY r.line_no)
                       FILTER (WHERE g.line_no IS NULL), '')) AS text_sha256
FROM raw r LEFT JOIN gone g ON g.doc_id = r.doc_id AND g.line_no = r.line_no GROUP BY r.doc_id"""
