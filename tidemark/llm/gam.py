"""Quality scores by a generalised additive model with pairwise interactions.

Each document gives a few numbers about its words, characters, lines and repetition. On a bounded
sample of labelled documents the driver learns one lookup table per number by cyclic boosting: round
after round, a shallow tree on one binned number takes a small step, then on the next. The pairs of
numbers that explain most of what is left get tables in the same way. A score is the logistic
function of the tables' entries added up, for whole batches at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import (
    Words,
    documents,
    few_rows_a_batch,
    give_back,
    in_one_text,
    mixed,
    parts,
    slices,
    window_hashes,
)

# The most labelled rows that are collected for training, by the order of a hash of their id.
MAX_ROWS = 40_000
# Text whose features are taken at once: their arrays are some forty times as large.
FEATURE_BYTES = 1 << 20
BINS = 48
PAIR_BINS = 12
ROUNDS = 80
PAIR_ROUNDS = 30
PAIRS = 8
RATE = 0.15
SMOOTHING = 2.0
LEAST_ROWS = 8

FEATURES = [
    "words",
    "word_length",
    "long_words",
    "short_words",
    "symbols",
    "exclamations",
    "capitals",
    "digits",
    "sentence_ends",
    "commas",
    "non_ascii",
    "distinct_words",
    "commonest_word",
    "same_as_before",
    "repeated_triples",
    "lines",
    "line_words",
    "repeated_lines",
    "wordless",
    "capital_starts",
]


def _among(letters: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(letters))


SYMBOLS = _among(b"#*$%&|<>@^~=+_{}[]\\/")
CAPITALS = _among(bytes(range(65, 91)))
LETTERS = CAPITALS | _among(bytes(range(97, 123))) | (np.arange(256) >= 128)
DIGITS = _among(b"0123456789")
ENDS = _among(b".?")


def features(texts: list[bytes]) -> np.ndarray:
    """One row of numbers per text, in the order of FEATURES; shares of nothing are 0."""
    words = Words(texts)
    data, n_texts = words.data, len(texts)
    n_words = words.counts
    some = np.maximum(n_words, 1)
    characters = np.maximum(words.per_text(words.solid), 1)
    lengths = words.ends - words.starts
    hashes = words.hashes()
    text = words.text
    distinct, commonest = _distinct(hashes, text, n_texts)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    places = in_one_text(words, 3)
    triples = window_hashes(hashes, 3)[places] if len(places) else hashes[:0]
    own = text[places]
    n_triples = np.bincount(own, minlength=n_texts)
    distinct_triples, _ = _distinct(triples, own, n_texts)
    n_lines, repeated = np.array([_lines(x) for x in texts], np.int64).reshape(-1, 2).T
    letters = np.concatenate([[0], np.cumsum(LETTERS[data])])
    wordless = letters[words.ends] == letters[words.starts]
    columns = [
        np.log1p(n_words),
        words.per_words(lengths) / some,
        words.per_words(lengths > 12) / some,
        words.per_words(lengths < 3) / some,
        words.per_text(SYMBOLS[data]) / characters,
        words.per_text(data == 33) / characters,
        words.per_text(CAPITALS[data]) / np.maximum(words.per_text(LETTERS[data]), 1),
        words.per_text(DIGITS[data]) / characters,
        words.per_words(ENDS[data[words.ends - 1]]) / some,
        words.per_text(data == 44) / some,
        words.per_text(data >= 128) / characters,
        distinct / some,
        commonest / some,
        words.per_words(same) / some,
        1 - distinct_triples / np.maximum(n_triples, 1),
        np.log1p(n_lines),
        np.log1p(n_words / np.maximum(n_lines, 1)),
        repeated / np.maximum(n_lines, 1),
        words.per_words(wordless) / some,
        words.per_words(CAPITALS[data[words.starts]]) / some,
    ]
    return np.stack(columns, 1).astype(np.float32)


def _distinct(hashes: np.ndarray, text: np.ndarray, n_texts: int):
    """Distinct digests of each text, and how often its commonest one occurs."""
    keys = mixed(hashes, text.astype(np.uint64))
    order = np.argsort(keys)
    start = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]) != 0)
    times = np.diff(start, append=len(keys))
    owner = text[order[start]]
    commonest = np.zeros(n_texts, np.int64)
    np.maximum.at(commonest, owner, times)
    return np.bincount(owner, minlength=n_texts), commonest


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


@dataclass
class Model:
    """Lookup tables of a fitted model."""

    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(rows), self.start)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, rows[:, k], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[
                np.searchsorted(self.pair_edges[i], rows[:, i], "right"),
                np.searchsorted(self.pair_edges[j], rows[:, j], "right"),
            ]
        return _logistic(total)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Learn the tables. Without rows every score is 0.5."""
    n_features = rows.shape[1]
    edges = [_edges(rows[:, k], BINS) for k in range(n_features)]
    bins = [np.searchsorted(edges[k], rows[:, k], "right") for k in range(n_features)]
    positive = labels.sum() + 0.5
    start = float(np.log(positive / (len(labels) - labels.sum() + 0.5)))
    model = Model(start, edges, [np.zeros(len(e) + 1) for e in edges])
    total = np.full(len(rows), start)
    for _ in range(ROUNDS if len(rows) else 0):
        for k in range(n_features):
            step = RATE * _tree(*_sums(bins[k], len(edges[k]) + 1, total, labels))
            model.tables[k] += step
            total += step[bins[k]]
    model.pair_edges = [_edges(rows[:, k], PAIR_BINS) for k in range(n_features)]
    if not len(rows):
        return model
    coarse = [
        np.searchsorted(model.pair_edges[k], rows[:, k], "right") for k in range(n_features)
    ]
    sizes = [len(e) + 1 for e in model.pair_edges]
    gains = []
    for i in range(n_features):
        for j in range(i):
            gain, _ = _cross(*_pair_sums(coarse, sizes, i, j, total, labels))
            gains.append((gain, i, j))
    model.pairs = [(i, j) for gain, i, j in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            _, step = _cross(*_pair_sums(coarse, sizes, i, j, total, labels))
            table += RATE * step
            total += RATE * step[coarse[i], coarse[j]]
    return model


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    if not len(values):
        return np.empty(0, np.float32)
    return np.unique(np.quantile(values, np.arange(1, bins) / bins).astype(np.float32))


def _sums(bins, n_bins, total, labels):
    """Gradient, curvature and rows of each bin."""
    chance = _logistic(total)
    return (
        np.bincount(bins, labels - chance, n_bins),
        np.bincount(bins, chance * (1 - chance), n_bins),
        np.bincount(bins, minlength=n_bins),
    )


def _pair_sums(bins, sizes, i, j, total, labels):
    n = sizes[i] * sizes[j]
    return [x.reshape(sizes[i], sizes[j]) for x in _sums(bins[i] * sizes[j] + bins[j], n, total, labels)]


def _gain(gradient, curvature):
    return gradient**2 / (curvature + SMOOTHING)


def _best_cut(gradient, curvature, rows):
    """(gain, cut) of the best split of bins in two; cut 0 is none."""
    left_g, left_h, left_n = (np.cumsum(x)[:-1] for x in (gradient, curvature, rows))
    if not len(left_g):
        return 0.0, 0
    all_g, all_h = gradient.sum(), curvature.sum()
    gain = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
    gain[(left_n < LEAST_ROWS) | (rows.sum() - left_n < LEAST_ROWS)] = 0
    best = int(np.argmax(gain))
    return (float(gain[best]), best + 1) if gain[best] > 0 else (0.0, 0)


def _tree(gradient, curvature, rows):
    """Leaf values, by bin, of a tree of at most three leaves on one binned number."""
    n = len(gradient)
    _, cut_at = _best_cut(gradient, curvature, rows)
    parts = [slice(0, cut_at), slice(cut_at, n)] if cut_at else [slice(0, n)]
    cuts = [_best_cut(gradient[p], curvature[p], rows[p]) for p in parts] if cut_at else []
    if cuts and max(cuts)[0] > 0:
        k = int(np.argmax([gain for gain, _ in cuts]))
        part, at = parts[k], parts[k].start + cuts[k][1]
        parts[k : k + 1] = [slice(part.start, at), slice(at, part.stop)]
    values = np.zeros(n)
    for part in parts:
        values[part] = gradient[part].sum() / (curvature[part].sum() + SMOOTHING)
    return values


def _cross(gradient, curvature, rows):
    """(gain, leaf values) of the best tree that cuts one number, then each side by the other."""
    g, h, n = (np.cumsum(np.cumsum(x, 0), 1) for x in (gradient, curvature, rows))
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)

    def quarters(x):
        upper, left, both = x[:-1, -1:], x[-1:, :-1], x[:-1, :-1]
        return np.stack([both, upper - both, left - both, x[-1, -1] - upper - left + both])

    q_g, q_h, q_n = quarters(g), quarters(h), quarters(n)
    gain = _gain(q_g, q_h).sum(0) - _gain(g[-1, -1], h[-1, -1])
    gain[(q_n < LEAST_ROWS).any(0)] = 0
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = np.zeros(g.shape)
    if gain[i, j] > 0:
        leaves = q_g[:, i, j] / (q_h[:, i, j] + SMOOTHING)
        values[: i + 1, : j + 1], values[: i + 1, j + 1 :] = leaves[0], leaves[1]
        values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = leaves[2], leaves[3]
    return float(gain[i, j]), values


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from; a row without an id is one."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def fit_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = MAX_ROWS,
) -> Model:
    """A model of `labels.quality` from the texts of labelled documents that are not held out.

    Labels other than 0 and 1 are not learned from. Labels that repeat count as often as they do.
    At most `max_rows` labels are learned from; without any, all scores are 0.5.
    """
    sample = (
        labels.select(F.col(id_col).alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(max_rows)
    )
    # A bounded number of ids and labels, some 12 bytes each.
    rows = documents(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")

    def measured(batches):
        for batch in slices(batches, FEATURE_BYTES):
            found = features(batch.column("text").to_pylist())
            listed = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), listed.cast(pa.list_(pa.float32()))], ["label", "features"]
            )

    found = (
        rows.select("label", "text")
        .mapInArrow(measured, "label int, features array<float>")
        .toArrow()
        .combine_chunks()
    )
    numbers = found.column("features").combine_chunks().flatten().to_numpy()
    numbers = numbers.reshape(-1, len(FEATURES))
    wanted = found.column("label").to_numpy().astype(float)
    # The same rows in the same order, however they were dealt out.
    order = np.lexsort([*numbers.T, wanted])
    return fit(numbers[order], wanted[order])


def quality_scores(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Only the text is an input of the score; a null text counts as empty and is scored like any
    other. Ids may be null or repeat. Other columns are not read. No shuffle.
    """
    rows = documents(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scored(batches):
        for batch in slices(batches, FEATURE_BYTES):
            score = model.score(features(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return rows.mapInArrow(scored, f"doc_id {kind}, score double, predicted int").select(
        F.col("doc_id").alias(id_col), held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score 0.5 or more, with all of their columns. No shuffle."""
    few_rows_a_batch(docs.sparkSession)
    # Rows travel whole, since Arrow functions take no names with dots.
    rows, place = docs.select(F.struct("*").alias("row")), docs.columns.index(text_col)

    def chosen(batches):
        for batch in batches:
            texts = pc.struct_field(batch.column("row"), [place])
            texts = pc.fill_null(texts.cast(pa.binary()), b"")
            own = pa.RecordBatch.from_arrays([texts], ["text"])
            score = [
                model.score(features(part.column("text").to_pylist()))
                for part in parts(own, FEATURE_BYTES)
            ]
            yield batch.filter(pa.array(np.concatenate([*score, np.empty(0)]) >= 0.5))
        give_back()

    return rows.mapInArrow(chosen, rows.schema).select("row.*")
