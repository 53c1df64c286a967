"""Quality rules on repetition inside a document, from its suffix array.

Each task sorts the suffixes of its documents, as sequences of words, by prefix doubling, many
documents at once in numpy. Longest common prefixes of neighbouring suffixes come from the ranks
of the doubling rounds. The innermost interval of common prefixes around a suffix tells the longest
maximal repeat that starts there; the union of the spans of all repeats of at least `min_words`
words is the covered part. A document is kept unless a base rule fails, more than `max_covered`
of its words are covered, or its longest repeat has more than `max_repeat` words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.text import Words, documents, mixed, slices

MIN_WORDS = 8
MAX_COVERED = 0.3
MAX_REPEAT = 60

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
BASE_WORDS = 50
BASE_WINDOW = 3
BASE_REPEATED = 0.5

IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, covered_words bigint, longest_repeat bigint, "
    "kept boolean"
)
NAMES = [column.split()[0] for column in SCHEMA.split(", ")]


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_covered: float = MAX_COVERED,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """One row per row of `docs`: its id, the base counts, the repeats and whether it is kept.

    A null or empty text has no words and is not kept. Ids are only carried along, so they may be
    null or repeat. Other columns are not read. No shuffle.
    """

    def measured(batches):
        for batch in slices(batches):
            found = measure(batch.column("text").to_pylist(), min_words)
            n_words = found["n_words"]
            found["base_failed"] = (n_words < BASE_WORDS) | (
                found["n_repeat_words"] > BASE_REPEATED * n_words
            )
            found["kept"] = ~(
                found["base_failed"]
                | (found["covered_words"] > max_covered * n_words)
                | (found["longest_repeat"] > max_repeat)
            )
            columns = {name: found[name] for name in NAMES}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **columns})

    rows = documents(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(measured, f"doc_id {kind}, {SCHEMA}").withColumnRenamed("doc_id", id_col)


def measure(texts: list[bytes], min_words: int) -> dict[str, np.ndarray]:
    """The base counts and the repeats of each text."""
    words = Words(texts)
    longest = longest_repeats(words)
    longest_of_text = np.zeros(len(texts), np.int64)
    np.maximum.at(longest_of_text, words.text, longest)
    first_bytes = words.solid & ((words.data & 0xC0) != 0x80)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": words.per_text(first_bytes),
        "n_symbols": words.per_text(IS_SYMBOL[words.data]),
        "n_dup_lines": np.fromiter(map(repeated_lines, texts), np.int64, len(texts)),
        "n_repeat_words": words.per_words(
            covered(np.where(longest >= BASE_WINDOW, BASE_WINDOW, 0))
        ),
        "covered_words": words.per_words(covered(np.where(longest >= min_words, longest, 0))),
        "longest_repeat": longest_of_text,
    }


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line in seen:
            found += bool(line.strip())
        else:
            seen.add(line)
    return found


def covered(lengths: np.ndarray) -> np.ndarray:
    """Places inside the union of the spans that start at each place with these lengths."""
    places = np.arange(len(lengths))
    return np.maximum.accumulate(places + lengths) > places if len(lengths) else lengths > 0


def longest_repeats(words: Words) -> np.ndarray:
    """For each word, how many words from there on occur a second time in the same text."""
    n = len(words)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    rounds = doubled(words)
    order = np.argsort(rounds[-1])
    common = common_prefixes(order, rounds)
    longest[order[:-1]] = common
    longest[order[1:]] = np.maximum(longest[order[1:]], common)
    return longest


def doubled(words: Words) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until all differ.

    A suffix ends with its text, and suffixes of different texts never share a rank. Suffixes with
    the same rank form a group; only groups of two and more are sorted again.
    """
    n = len(words)
    text = words.text.astype(np.uint64)
    ends = np.repeat(words.first[1:], words.counts)
    keys = mixed(words.hashes(), text)
    order = np.argsort(keys)
    rank, open_places = _ranks(order, keys[order], np.arange(n), n)
    rounds = [rank]
    step = 1
    while len(open_places):
        after = open_places + step
        inside = after < ends[open_places]
        follower = np.where(inside, rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        keys = rank[open_places].astype(np.int64) * (n + 1) + follower
        order = np.argsort(keys)
        sorted_places, keys = open_places[order], keys[order]
        rank = rank.copy()
        # A group's members take the ranks from the group's own on.
        old = rounds[-1][sorted_places]
        start = np.flatnonzero(np.diff(old, prepend=-1))
        base = old - np.repeat(start, np.diff(start, append=len(old)))
        own, open_places = _ranks(sorted_places, keys, base + np.arange(len(old)), None)
        rank[sorted_places] = own
        rounds.append(rank)
        step *= 2
    return rounds


def _ranks(places, keys, positions, n):
    """Ranks by sorted keys (the position of the first equal one), and the places that share one."""
    changed = np.diff(keys, prepend=keys[:1]) != 0
    changed[0] = True
    start = np.flatnonzero(changed)
    sizes = np.diff(start, append=len(keys))
    own = np.repeat(positions[start], sizes).astype(np.int32)
    shared = places[np.repeat(sizes > 1, sizes)]
    if n is None:
        return own, shared
    rank = np.empty(n, np.int32)
    rank[places] = own
    return rank, shared


def common_prefixes(order: np.ndarray, rounds: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix of the order has in common with the next one."""
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(left), np.int64)
    same = [np.arange(len(left))]
    for rank in rounds:
        pairs = same[-1]
        same.append(pairs[rank[left[pairs]] == rank[right[pairs]]])
    last = len(rounds[0]) - 1
    todo = np.empty(0, np.int64)
    for level in range(len(rounds) - 1, -1, -1):
        rank, step = rounds[level], 1 << level
        a, b = left[todo] + common[todo], right[todo] + common[todo]
        fits = (a <= last) & (b <= last)
        equal = todo[fits & (rank[np.minimum(a, last)] == rank[np.minimum(b, last)])]
        common[equal] += step
        # Pairs whose highest common level this is begin here.
        begin = np.setdiff1d(same[level + 1], todo, assume_unique=True)
        common[begin] += step
        todo = np.concatenate([todo, begin])
    return common




def _windows(size: int) -> str:
    """Words inside a window of `size` words that occurs twice in its text, in DuckDB."""
    return f"""
w{size} AS (SELECT doc_id, i, list_slice(words, i, i + {size - 1}) AS run
       FROM (SELECT doc_id, words, unnest(range(1, len(words) - {size - 2})) AS i FROM t
             WHERE len(words) >= {size})),
r{size} AS (SELECT doc_id, i FROM w{size}
       QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
c{size} AS (SELECT doc_id, count(DISTINCT i + k) AS n
       FROM r{size}, range({size}) g(k) GROUP BY doc_id)"""


# A text has a repeat longer than a limit if a window one longer occurs twice, and the union of all
# repeats of some least length is that of the windows of this length that occur twice. The exact
# longest repeat is left to the tests.
SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
           FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
d AS (SELECT doc_id, sum(n - 1) AS n FROM
      (SELECT doc_id, line, count(*) AS n FROM l
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL) GROUP BY doc_id),
{_windows(BASE_WINDOW)}, {_windows(MIN_WORDS)},
m AS (SELECT doc_id, list_slice(words, i, i + {MAX_REPEAT}) AS run
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - {MAX_REPEAT - 1})) AS i FROM t
            WHERE len(words) > {MAX_REPEAT})),
long AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, run FROM m GROUP BY ALL HAVING count(*) > 1)),
f AS (SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
       CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
           AS n_symbols,
       CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines,
       CAST(coalesce(c{BASE_WINDOW}.n, 0) AS BIGINT) AS n_repeat_words,
       len(words) < {BASE_WORDS}
           OR coalesce(c{BASE_WINDOW}.n, 0) > {BASE_REPEATED} * len(words) AS base_failed,
       CAST(coalesce(c{MIN_WORDS}.n, 0) AS BIGINT) AS covered_words,
       long.doc_id IS NOT NULL AS repeat_too_long
FROM t LEFT JOIN d USING (doc_id) LEFT JOIN c{BASE_WINDOW} USING (doc_id)
       LEFT JOIN c{MIN_WORDS} USING (doc_id) LEFT JOIN long USING (doc_id))
SELECT *, NOT (base_failed OR repeat_too_long OR covered_words > {MAX_COVERED} * n_words) AS kept
FROM f"""
