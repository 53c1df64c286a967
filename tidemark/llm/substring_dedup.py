"""Repeated passages across a corpus, by hashing units of text.

Units are normalised (words, A-Z lower-cased) and hashed; digests are grouped over the whole
corpus, the unit that comes first by id and place stays, and the others are removed, with their
places in the original text retained. A line or paragraph is too coarse a unit, since passages start
and end inside lines: the units are all runs of `unit_words` words, one from each word on, so that a
repeated passage of at least that many words is found wherever it lies, and to the word.

Two rounds keep the shuffles small. First, of every unit only the smallest digest of its shorter
runs is grouped (winnowing): equal units have equal smallest digests, so a unit without a second one
cannot repeat. Then the remaining units themselves are grouped. Records travel packed. A task sends
one record per digest it holds, so no digest has more records than there are slices of input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import exchange
from tidemark.llm.text import (
    Words,
    documents,
    in_one_text,
    quoted,
    slices,
    utf8,
    window_hashes,
)

UNIT_WORDS = 50

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
RECORD = {"digest": "u8", "doc_id": "i8", "place": "i4", "known": "?"}
PLACES = {"doc_id": "i8", "place": "i4"}


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit_words: int = UNIT_WORDS
) -> DataFrame:
    """One row per row of `docs`: id, text without later copies, n_words, n_removed, spans.

    A word is removed, with the white space after it, when it lies in a run of `unit_words` words
    that also starts earlier, by id and place, in the same or another document. `spans` lists
    (start, end) of what is removed, in characters of the original text. Null texts are empty and
    texts of fewer words keep all. Ids are integers and name documents: rows that repeat an id are
    one document, and what is removed from one is removed from all. A row without an id keeps its
    text and is compared with nothing. Other columns are not read.
    """
    return _applied(docs, id_col, text_col, unit_words).drop("carried")


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit_words: int = UNIT_WORDS
) -> DataFrame:
    """The rows of `docs` with all of their columns and the shortened texts."""
    found = _applied(docs, id_col, text_col, unit_words)
    return found.select(
        *[
            F.col("text").alias(name) if name == text_col else F.col("carried").getField(name).alias(name)
            for name in docs.columns
        ]
    )


def _applied(docs: DataFrame, id_col: str, text_col: str, unit_words: int) -> DataFrame:
    later = later_units(docs, id_col, text_col, unit_words)
    others = F.struct(*[F.col(quoted(name)) for name in docs.columns if name != text_col])
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        utf8(F.col(text_col)).alias("text"),
        others.alias("carried"),
    )
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("text", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(SPAN)),
            rows.schema["carried"],
        ]
    )

    def applied(batches):
        for batch in slices(batches):
            yield _removed(batch)

    return rows.join(later, "doc_id", "left").mapInArrow(applied, schema).withColumnRenamed("doc_id", id_col)


def later_units(docs: DataFrame, id_col: str, text_col: str, unit_words: int) -> DataFrame:
    """(doc_id, places): the words that lie in a later copy, as bytes of pairs (first, end)."""
    spark = docs.sparkSession
    rows = documents(docs, id_col, text_col).where("doc_id IS NOT NULL")
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    n_buckets = exchange.bucket_count(spark)
    # Every digest bucket writes to every document bucket: as many rows as a shuffle has blocks.
    n_doc_buckets = exchange.bucket_count(spark, 1)
    part = (unit_words + 1) // 2
    window = unit_words - part + 1

    def sampled(batches):
        for batch in slices(batches):
            words = Words(batch.column("text").to_pylist(), lower=True)
            hashes = words.hashes()
            starts = in_one_text(words, unit_words)
            if len(starts):
                digests = window_hashes(hashes, part)
                places = np.unique(smallest_places(digests, window)[starts])
                yield _records(words, batch, digests[places], places, n_buckets, earliest=False)

    def shared(table):
        found = exchange.unpack(table, RECORD)
        order = np.argsort(found["digest"])
        start, size = exchange.groups(found["digest"][order])
        several = found["known"].copy()
        several[order] |= np.repeat(size > 1, size)
        return to_documents(found["doc_id"][several], found["place"][several])

    def to_documents(doc_id, place):
        """Packed places, dealt by document: a row per document bucket and not per place."""
        order = np.lexsort((place, doc_id))
        doc_id, place = doc_id[order], place[order]
        by_doc = exchange.bucket_of(_spread(doc_id), n_doc_buckets)
        return pa.Table.from_batches(
            [exchange.pack(by_doc, {"doc_id": doc_id, "place": place})],
        )

    def gathered(table):
        found = exchange.unpack(table, PLACES)
        order = np.lexsort((found["place"], found["doc_id"]))
        doc_id, place = found["doc_id"][order], found["place"][order]
        fresh = np.ones(len(place), bool)
        fresh[1:] = (doc_id[1:] != doc_id[:-1]) | (place[1:] != place[:-1])
        doc_id, place = doc_id[fresh], place[fresh]
        start, size = exchange.groups(doc_id)
        data = [place[s : s + n].tobytes() for s, n in zip(start, size, strict=True)]
        return pa.table({"doc_id": doc_id[start], "places": pa.array(data, pa.binary())})

    repeated = (
        rows.mapInArrow(sampled, exchange.schema(RECORD))
        .groupBy("bucket")
        .applyInArrow(shared, exchange.schema(PLACES))
        .groupBy("bucket")
        .applyInArrow(gathered, "doc_id bigint, places binary")
    )

    def units(batches):
        for batch in slices(batches):
            words = Words(batch.column("text").to_pylist(), lower=True)
            starts = in_one_text(words, unit_words)
            lists = [np.frombuffer(x, np.int32) for x in batch.column("places").to_pylist()]
            text = np.repeat(np.arange(batch.num_rows), [len(x) for x in lists])
            hit = np.zeros(len(words) + 1, np.int64)
            np.add.at(hit, words.first[text] + np.concatenate(lists), 1)
            hits = np.concatenate([[0], np.cumsum(hit)])
            starts = starts[hits[starts + window] > hits[starts]]
            if len(starts):
                digests = window_hashes(words.hashes(), unit_words)
                yield _records(words, batch, digests[starts], starts, n_buckets, earliest=True)

    def copies(table):
        found = exchange.unpack(table, RECORD)
        order = np.lexsort((found["place"], found["doc_id"], found["digest"]))
        doc_id, place = found["doc_id"][order], found["place"][order]
        start, size = exchange.groups(found["digest"][order])
        first = np.repeat(start, size)
        gone = found["known"][order] | (doc_id != doc_id[first]) | (place != place[first])
        return to_documents(doc_id[gone], place[gone])

    def joined(table):
        found = exchange.unpack(table, PLACES)
        order = np.lexsort((found["place"], found["doc_id"]))
        doc_id, place = found["doc_id"][order], found["place"][order].astype(np.int64)
        # A new stretch begins with a new document or behind the end of the units before.
        new = np.ones(len(place), bool)
        new[1:] = (doc_id[1:] != doc_id[:-1]) | (place[1:] > place[:-1] + unit_words)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place)) - 1
        spans = np.stack([place[first], place[last] + unit_words], 1).astype(np.int32)
        start, size = exchange.groups(doc_id[first])
        data = [spans[s : s + n].tobytes() for s, n in zip(start, size, strict=True)]
        return pa.table(
            {"doc_id": doc_id[first][start], "places": pa.array(data, pa.binary())}
        )

    return (
        rows.join(repeated, "doc_id")
        .select("doc_id", "text", "places")
        .mapInArrow(units, exchange.schema(RECORD))
        .groupBy("bucket")
        .applyInArrow(copies, exchange.schema(PLACES))
        .groupBy("bucket")
        .applyInArrow(joined, "doc_id bigint, places binary")
    )


def smallest_places(digests: np.ndarray, window: int) -> np.ndarray:
    """For each place the first place of the smallest of the `window` digests from there on."""
    values, places, width = digests, np.arange(len(digests)), 1
    found, done = None, 0
    while done < window:
        if window & width:
            n = len(digests) - done - width + 1
            part = values[done : done + n], places[done : done + n]
            found = part if found is None else _smaller(found[0][:n], found[1][:n], *part)
            done += width
        if done < window:
            values, places = _smaller(
                values[:-width], places[:-width], values[width:], places[width:]
            )
            width *= 2
    return found[1]


def _smaller(values, places, other_values, other_places):
    less = other_values < values
    return np.where(less, other_values, values), np.where(less, other_places, places)


def _spread(doc_id: np.ndarray) -> np.ndarray:
    x = doc_id.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(31)) ^ (x << np.uint64(32))


def _records(words, batch, digests, places, n_buckets, earliest):
    """Packed records of a slice.

    Of equal digests, one goes to their bucket, the earliest. The others are already known to be
    repeated; they only pass through, dealt by document. Where every member of a repeated digest
    counts and not only the later ones, the one that goes to the bucket is also sent as known.
    """
    text = words.text[places]
    doc_id = batch.column("doc_id").to_numpy().astype(np.int64)[text]
    place = (places - words.first[text]).astype(np.int32)
    order = np.lexsort((place, doc_id, digests))
    digests, doc_id, place = digests[order], doc_id[order], place[order]
    start, size = exchange.groups(digests)
    first = np.zeros(len(digests), bool)
    first[start] = True
    known = ~first
    if earliest:  # the same document may be there twice
        same = np.repeat(start, size)
        known &= (doc_id != doc_id[same]) | (place != place[same])
    else:
        known |= np.repeat(size > 1, size)
    sent = first | known
    # What only passes through gets digests of its own.
    through = known & ~first
    digests = np.where(through, _spread(doc_id) ^ place.astype(np.uint64), digests)
    columns = {"digest": digests, "doc_id": doc_id, "place": place, "known": known}
    by_place = np.lexsort((place, doc_id))
    by_place = by_place[sent[by_place]]
    columns = {name: values[by_place] for name, values in columns.items()}
    return exchange.pack(exchange.bucket_of(columns["digest"], n_buckets), columns)


def _removed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The texts without the words of `places`, and the characters these took."""
    texts, spans, n_words, n_removed = [], [], [], []
    raw = batch.column("text").to_pylist()
    words = Words(raw)
    starts = words.starts
    for i, (text, places) in enumerate(
        zip(raw, batch.column("places").to_pylist(), strict=True)
    ):
        first, end = words.first[i], words.first[i + 1]
        n_words.append(end - first)
        if not places:
            texts.append(text)
            spans.append([])
            n_removed.append(0)
            continue
        pairs = np.frombuffer(places, np.int32).reshape(-1, 2)
        pairs = pairs[pairs[:, 0] < end - first]
        offset, own = words.offsets[i], []
        kept, at, chars = [], 0, 0
        for a, b in pairs:
            b = min(int(b), end - first)
            begin = int(starts[first + a] - offset)
            stop = int(starts[first + b] - offset) if first + b < end else len(text)
            kept.append(text[at:begin])
            chars += len(text[at:begin].decode())
            gone = len(text[begin:stop].decode())
            own.append({"start": chars, "end": chars + gone})
            chars += gone
            at = stop
        kept.append(text[at:])
        texts.append(b"".join(kept))
        spans.append(own)
        n_removed.append(int(sum(min(int(b), end - first) - a for a, b in pairs)))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch.column("doc_id"),
            "text": pa.array(texts, pa.binary()).cast(pa.string()),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "spans": pa.array(spans, kind),
            "carried": batch.column("carried"),
        }
    )


def sql(unit_words: int = UNIT_WORDS) -> str:
    """The query's result in DuckDB."""
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*')
                      AS pieces,
                  regexp_extract(coalesce(text, ''), '^[\x20\x09-\x0D]*') AS head
           FROM documents),
n AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM t),
w AS (SELECT doc_id, i, hash(list_slice(words, i, i + {unit_words - 1})) AS unit
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - {unit_words - 2})) AS i
            FROM n WHERE len(words) >= {unit_words})),
later AS (SELECT doc_id, i FROM w
          QUALIFY row_number() OVER (PARTITION BY unit ORDER BY doc_id, i) > 1),
gone AS (SELECT doc_id, i + k AS i FROM later, range({unit_words}) g(k) GROUP BY ALL),
p AS (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM t),
r AS (SELECT p.doc_id, count(*) AS n_words, count(gone.i) AS n_removed,
             string_agg(piece, '' ORDER BY p.i) FILTER (WHERE gone.i IS NULL) AS rest
      FROM p LEFT JOIN gone USING (doc_id, i) GROUP BY p.doc_id)
SELECT t.doc_id, head || coalesce(rest, '') AS text, coalesce(n_words, 0) AS n_words,
       coalesce(n_removed, 0) AS n_removed, length(text) - length(head || coalesce(rest, ''))
           AS n_removed_chars
FROM t LEFT JOIN r USING (doc_id)"""
