"""Secrets in every version of every text, scanned once per content and rule.

Texts are addressed by the digest of their content. A ledger on shared storage holds, per content,
the rules it was scanned for and what they found; a scan looks only at pairs of content and rule
version that the ledger does not have, one copy of each, and adds them in one commit. Findings are
then joined back to all rows, so a text that occurs a million times, or comes again tomorrow, is
read by the rules once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import few_rows_a_batch, slices, utf8
from tidemark.operators.hot import HOT_ROWS, lookup_join
from tidemark.session import cut
from tidemark.sources.tables import CommitLog

# Contents to scan that are broadcast at most (about 100 bytes each); beyond, Spark shuffles.
BROADCAST_BLOBS = 200_000

SPANS = "array<struct<rule string, start bigint, end bigint>>"
LEDGER = f"blob string, rules array<string>, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and not overlapping, whose `group` has `least` characters.

    Patterns are of Python's `re`, for ASCII. A text in which none of `words` occurs, in small
    letters, is not searched. A change of a rule needs a new `version`: the ledger goes by it.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    words: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.version}"


# The patterns and least lengths of the three kinds, in the order of equal starts.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = (
    Rule("assign", 1, ASSIGN, 2, 6, True, ("passw", "secret", "token", "api")),
    Rule("access", 1, "AKIA[A-Z0-9]+", least=20, words=("akia",)),
    # A shorter run of these letters can never be part of a longer one
    Rule("hex", 1, "[0-9a-f]{24,}"),
)


class BlobLedger:
    """What was scanned for which rules, in Parquet: `blob`, `rules`, `spans`.

    Scans add a version each, which counts once it is committed; `compacted` begins anew with one
    row per content, without the rules that are not used any more.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root}/scans"
        marks = T.StructType([T.StructField("whole", T.BooleanType())])
        self.commits = CommitLog(spark, f"{root}/commits", marks)

    def read(self) -> DataFrame:
        """All committed rows; a content has one for each scan that it was new to."""
        commits = self.commits.rows().orderBy("version").collect()
        whole = max((n for n, row in enumerate(commits) if row["whole"]), default=0)
        paths = [f"{self.path}/v={row['version']}" for row in commits[whole:]]
        if not paths:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(*paths)

    def add(self, rows: DataFrame, whole: bool = False) -> None:
        version = self.commits.next_version()
        rows.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        self.commits.commit(version, whole=whole)

    def compacted(self, rules: Sequence[Rule] = RULES) -> None:
        self.add(_known(self.read(), rules), whole=True)


def _names(rules: Sequence[Rule]):
    return F.array(*[F.lit(rule.name) for rule in rules]).cast("array<string>")


def _known(ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per content: those of `rules` it was scanned for, and their spans."""
    names = _names(rules)
    return ledger.groupBy("blob").agg(
        F.array_intersect(names, F.array_distinct(F.flatten(F.collect_list("rules")))).alias("rules"),
        F.filter(
            F.flatten(F.collect_list("spans")), lambda span: F.array_contains(names, span["rule"])
        ).alias("spans"),
    )


def addressed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, blob, text): the text as UTF-8, null as empty, and the digest of it."""
    few_rows_a_batch(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), utf8(F.col(text_col)).alias("text"))
    return rows.select("doc_id", F.sha2("text", 256).alias("blob"), "text")


def scan_unseen(rows: DataFrame, paths: DataFrame, ledger: BlobLedger, rules: Sequence[Rule]) -> int:
    """Add to the ledger what it lacks of the contents of `rows`; returns how many were scanned.

    `paths` are the same rows without their texts. Copies of a content are united before they are
    shuffled, so one that a third of all rows have is one row per task.
    """
    known = _known(ledger.read(), rules)
    missing = F.array_except(_names(rules), F.coalesce("rules", F.array().cast("array<string>")))
    todo = cut(
        paths.select("blob")
        .distinct()
        .join(known, "blob", "left")
        .select("blob", missing.alias("wanted"))
        .where(F.size("wanted") > 0)
    )
    n_blobs = todo.count()
    if not n_blobs:
        return 0
    texts = rows.select("blob", "text")
    if n_blobs <= BROADCAST_BLOBS:
        unseen = texts.join(F.broadcast(todo), "blob").dropDuplicates(["blob"])
    else:
        unseen = texts.dropDuplicates(["blob"]).join(todo, "blob")
    ledger.add(unseen.select("blob", "wanted", "text").mapInArrow(_scan(tuple(rules)), LEDGER))
    return n_blobs


def secret_scan(
    docs: DataFrame,
    ledger: BlobLedger,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per row of `docs`: id, blob, and spans (kind, start, end) of all rules.

    Rows may be versions or copies of the same document: each is scanned unless its content was.
    Spans are in code points, the end exclusive, by start and then in the order of the rules. Null
    text is empty; rows without findings have an empty list. No other column is read. An empty
    table gives an empty result.
    """
    rows = addressed(docs, id_col, text_col)
    paths = cut(rows.select("doc_id", "blob"))
    scan_unseen(rows, paths, ledger, rules)
    order = F.create_map(*[F.lit(x) for n, r in enumerate(rules) for x in (r.name, n)])
    kinds = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.kind)])
    by_place = F.array_sort(
        F.transform(
            "spans", lambda s: F.struct(s["start"], order[s["rule"]].alias("place"), s["end"], s["rule"])
        )
    )
    spans = F.transform(
        by_place, lambda s: F.struct(kinds[s["rule"]].alias("kind"), s["start"], s["end"])
    )
    found = _known(ledger.read(), rules).where(F.size("spans") > 0)
    joined = lookup_join(paths, found.select("blob", spans.alias("spans")), ["blob"], hot_rows)
    none = F.array().cast("array<struct<kind string, start bigint, end bigint>>")
    return joined.select(
        F.col("doc_id").alias(id_col), "blob", F.coalesce("spans", none).alias("spans")
    )


@lru_cache(maxsize=64)
def _finder(rule: Rule) -> Callable[[str], list[tuple[int, int]]]:
    pattern = re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0))

    def find(text: str) -> list[tuple[int, int]]:
        return [
            found.span()
            for found in pattern.finditer(text)
            if found.end(rule.group) - found.start(rule.group) >= rule.least
        ]

    return find


def spans_of(text: str, rules: Sequence[Rule]) -> list[dict]:
    """What the rules find in a text, rule by rule."""
    small = text.lower() if any(rule.words for rule in rules) else ""
    return [
        {"rule": rule.name, "start": start, "end": end}
        for rule in rules
        if not rule.words or any(word in small for word in rule.words)
        for start, end in _finder(rule)(text)
    ]


def _scan(rules: tuple[Rule, ...]):
    by_name = {rule.name: rule for rule in rules}
    schema = pa.schema(
        [
            ("blob", pa.string()),
            ("rules", pa.list_(pa.string())),
            (
                "spans",
                pa.list_(
                    pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
                ),
            ),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            wanted = batch.column("wanted").to_pylist()
            texts = batch.column("text")
            spans = [
                spans_of(texts[i].as_py().decode(errors="replace"), [by_name[n] for n in names])
                for i, names in enumerate(wanted)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("blob"),
                    pa.array(wanted, schema.field("rules").type),
                    pa.array(spans, schema.field("spans").type),
                ],
                schema=schema,
            )

    return scan


def digest_columns(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), the spans as text."""
    text = F.array_join(
        F.transform(
            "spans",
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(rule.kind).alias(f"n_{rule.kind}") for rule in RULES],
        F.sha2(text, 256).alias("base_sha256"),
        text.alias("spans"),
    )


def sql() -> str:
    """The query in DuckDB: matches with the gaps before them, whose lengths give the places."""

    def any_case(word: str) -> str:
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)

    keywords = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    assign = ASSIGN.replace("password|passwd|secret|token|api_?key", keywords).replace("'", "''")
    parts = []
    for place, (kind, pattern, value, least) in enumerate(
        [("assign", assign, 4, 6), ("access", "AKIA[A-Z0-9]+", 2, 20), ("hex", "[0-9a-f]{24,}", 2, 24)]
    ):
        whole = f"'(?s)(.*?)({pattern})'"
        parts.append(
            f"SELECT row, '{kind}' AS kind, {place} AS place, {least} AS least, "
            f"regexp_extract_all(text, {whole}, 1) AS gaps, "
            f"regexp_extract_all(text, {whole}, 2) AS hits, "
            f"regexp_extract_all(text, {whole}, {value}) AS told FROM d"
        )
    before = "list_sum(list_transform({}, lambda x: length(x)))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(parts)}),
n AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
s AS (SELECT row, kind, place, coalesce({before.format("gaps[1:i]")}, 0)
             + CASE WHEN i > 1 THEN {before.format("hits[1:i-1]")} ELSE 0 END AS start,
             length(hits[i]) AS long FROM n WHERE length(told[i]) >= least),
a AS (SELECT row, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
             count(*) FILTER (WHERE kind = 'access') AS n_access,
             count(*) FILTER (WHERE kind = 'hex') AS n_hex,
             string_agg(concat_ws(':', kind, start::BIGINT, (start + long)::BIGINT), ','
                        ORDER BY start, place) AS spans FROM s GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (row)"""
