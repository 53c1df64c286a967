"""Documents scored by a recurrent language model learned from the corpus.

Word counts, the vocabulary, the classes and the base score come from all training documents. The
network is trained in rounds. Each round takes the training documents of one hash slice, every one of
them in exactly one round; tasks start from the same network, learn from every window of their
documents with the state carried along, and the networks are averaged by the number of words. Words outside the head
have a class by their ending, learned by the network, and their share of the class by counts.

The words of largest count, `LISTED` of them, are broadcast; counts of the others are joined. Texts
are read twice, for the counts and for the symbols; the network learns from symbols and scores them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import gru
from tidemark.llm.gru import HEAD, Network, Trainer
from tidemark.llm.text import Words, documents, give_back, keep_freed, mixed, slices
from tidemark.session import cut

LISTED = 200_000
ROUNDS = 3
RATE = 0.01
WINDOW = 32
LANES = 192
SCORED_SYMBOLS = 32_768
# Networks that are averaged in one place.
GROUP = 64
COUNTED_BYTES = 12 << 20
SCORE_BYTES = 16 << 20
# Tokens of documents that are scored side by side. Few documents are long, and a step of a few takes
# nearly as long as one of many.
SCORED_TOKENS = 4 << 20
# A space is in no word: it stands for the end of a document.
END_WORD = b" "
ENDING_BYTES = 3
# How symbols are kept.
SYMBOL = np.dtype("<i2")
NUMBERED = "row doc_id symbols n_tokens n_listed log_listed log_shares rest".split()
PUNCTUATED = 4
IS_PUNCTUATION = np.isin(np.arange(256), list(b".,;:!?%&*#$|\"'()"))


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from; a row without an id is not one."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def endings(words: Words, places=slice(None)) -> np.ndarray:
    """The last bytes of each word, as a number, without up to PUNCTUATED signs behind them."""
    starts, stops = words.starts[places], words.ends[places].copy()
    for _ in range(PUNCTUATED):
        stops -= IS_PUNCTUATION[words.data[stops - 1]] & (stops > starts + 1)
    found = np.minimum(stops - starts, ENDING_BYTES) << 8 * ENDING_BYTES
    for k in range(ENDING_BYTES):
        inside = stops - 1 - k >= starts
        found += np.where(inside, words.data[stops - 1 - k].astype(np.int64) << 8 * k, 0)
    return found


def count_words(rows: DataFrame) -> DataFrame:
    """(word, ending, n) of all words and ends of the documents, summed up in tasks first."""

    def counted(batches):
        n_ends = 0
        for texts in _many(slices(batches)):
            words = Words(texts, lower=True)
            n_ends += len(texts)
            places, times = distinct(words.hashes())
            yield _counts(words.array(places), endings(words, places), times)
        if n_ends:
            yield _counts(pa.array([END_WORD], pa.binary()), [0], [n_ends])

    return (
        rows.select("text")
        .mapInArrow(counted, "word binary, ending bigint, n bigint")
        .groupBy("word", "ending")
        .agg(F.sum("n").alias("n"))
    )


def _many(batches):
    """Lists of the texts of several slices, of COUNTED_BYTES together at most or of one slice. A word
    is one row for each of them."""
    some, n_bytes = [], 0
    for batch in batches:
        texts = batch.column("text").to_pylist()
        own = sum(map(len, texts))
        if some and n_bytes + own > COUNTED_BYTES:
            yield some
            some, n_bytes = [], 0
        some, n_bytes = some + texts, n_bytes + own
    if some:
        yield some


def distinct(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct digest, and how often it occurs. Digests are put into slots, where the
    last one stays; only those that another one has displaced are sorted."""
    n = len(digests)
    slots = (digests & np.uint64((1 << (2 * n).bit_length()) - 1)).astype(np.int64)
    stays = np.empty(1 << (2 * n).bit_length(), np.int64)
    stays[slots] = np.arange(n)
    stays = stays[slots]
    same = digests[stays] == digests
    times = np.bincount(stays[same], minlength=n)
    places, displaced = np.flatnonzero(times), np.flatnonzero(~same)
    _, others, more = np.unique(digests[displaced], return_index=True, return_counts=True)
    return np.concatenate([places, displaced[others]]), np.concatenate([times[places], more])


def _counts(words, ends, times) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "word": words,
            "ending": pa.array(ends, pa.int64()),
            "n": pa.array(times, pa.int64()),
        }
    )


@dataclass
class Vocabulary:
    """What of the counts is small: the listed words, the classes and the totals."""

    words: list[bytes]  # the end of documents first, then by count
    counts: np.ndarray
    endings: np.ndarray  # sorted: each common ending has a tail class, the others the last one
    tail_totals: np.ndarray  # of each tail class: counts plus one of its words, plus one
    n_tokens: int
    n_distinct: int

    def tail_classes(self, words: Words, places=slice(None)) -> np.ndarray:
        own = endings(words, places)
        if not len(self.endings):
            return np.full(len(own), gru.TAIL_CLASSES - 1)
        near = np.minimum(np.searchsorted(self.endings, own), len(self.endings) - 1)
        return np.where(self.endings[near] == own, near, gru.TAIL_CLASSES - 1)


class Index:
    """Numbers of words: the place of a listed word, or from LISTED on the tail class of another."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        listed = vocabulary.words
        # The end of documents, a space, has no words of its own here
        words = Words([b"\n".join(listed[1:])])
        self._enter(words.hashes())
        own = vocabulary.tail_classes(words)[HEAD - 1 :]
        heads = np.arange(min(len(listed), HEAD))
        unused = np.full(LISTED - len(listed), HEAD)
        classes = HEAD + np.arange(gru.TAIL_CLASSES)
        self.symbols = np.concatenate([heads, HEAD + own, unused, classes])

    def _enter(self, digests: np.ndarray) -> None:
        """A table of twice as many slots or more: a digest is in the first free one from its own on."""
        n_slots = 1 << max(3, (2 * len(digests)).bit_length())
        self.last_slot = np.uint64(n_slots - 1)
        self.places, self.digests = np.full(n_slots, -1, np.int64), np.zeros(n_slots, np.uint64)
        todo = np.arange(len(digests))
        slots = (digests & self.last_slot).astype(np.int64)
        while len(todo):
            free = self.places[slots] < 0
            self.places[slots[free]] = todo[free]
            own = self.places[slots] == todo
            self.digests[slots[own]] = digests[todo[own]]
            todo, slots = todo[~own], (slots[~own] + 1) % n_slots

    def numbers(self, words: Words, digests: np.ndarray | None = None) -> np.ndarray:
        digests = words.hashes() if digests is None else digests
        slots = (digests & self.last_slot).astype(np.int64)
        found = self.places[slots]
        # Slots that hold another digest; a free one says that the word is not listed
        others = np.flatnonzero((self.digests[slots] != digests) & (found >= 0))
        slots = slots[others]
        while len(others):
            slots = (slots + 1) % len(self.places)
            found[others] = self.places[slots]
            left = (self.digests[slots] != digests[others]) & (found[others] >= 0)
            others, slots = others[left], slots[left]
        found += 1
        tail = np.flatnonzero(found == 0)
        found[tail] = LISTED + self.vocabulary.tail_classes(words, tail)
        return found


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    """From the counts of all training words. At most LISTED of them are collected."""
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toArrow()
    by_n, n_words = sizes.column("n").to_numpy(), sizes.column("words").to_numpy()
    behind = np.flatnonzero(np.cumsum(n_words) >= LISTED)
    # Words of smaller counts are not sorted, as those above them are enough
    least = int(by_n[behind[0]]) if len(behind) else 0
    is_end = F.col("word") == END_WORD
    listed = (
        counts.where(is_end | (F.col("n") >= least))
        .orderBy(~is_end, F.desc("n"), "word")
        .select("word", "n")
        .limit(LISTED)
        .toArrow()
    )
    words = listed.column("word").to_pylist()
    numbers = listed.column("n").to_numpy().astype(np.int64)
    outside = F.lit(False)
    if len(words) > HEAD:
        n, least_n = F.col("n"), int(numbers[HEAD - 1])
        outside = ~is_end & ((n < least_n) | ((n == least_n) & (F.col("word") > words[HEAD - 1])))
    sums = cut(counts.where(outside).groupBy("ending").agg(F.sum(F.col("n") + 1).alias("n")))
    common = sums.orderBy(F.desc("n"), "ending").limit(gru.TAIL_CLASSES - 1).collect()
    common = sorted((row["ending"], row["n"]) for row in common)
    tail = np.zeros(gru.TAIL_CLASSES)
    tail[: len(common)] = [n for _, n in common]
    tail[-1] = (sums.agg(F.sum("n")).first()[0] or 0) - tail.sum()
    classes = np.array([code for code, _ in common], np.int64)
    n_tokens, n_distinct = int((by_n * n_words).sum()), int(n_words.sum())
    return Vocabulary(words, numbers, classes, tail + 1, n_tokens, n_distinct)


def numbered(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per document: its symbols, and what of its scores does not need the network.

    row, doc_id, symbols, n_tokens, n_listed, log_listed; log_shares: of its words in their classes;
    rest: its distinct words that are not listed, and how often each occurs.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row bigint, doc_id {kind}, symbols binary, n_tokens bigint, n_listed bigint, "
        "log_listed double, log_shares double, rest array<struct<word: binary, times: bigint>>"
    )

    def read(batches):
        index, n_listed = Index(vocabulary), len(vocabulary.words)
        logs = np.zeros(len(index.symbols))
        logs[:n_listed] = np.log10(vocabulary.counts + 1.0)
        # What a word's share of its class divides by; a head word is scored by the network alone.
        totals = np.log10(vocabulary.tail_totals)
        number = TaskContext.get().partitionId() << 32
        has_end = n_listed > 0
        for some in _gathered(slices(batches, SCORE_BYTES), index, logs, totals):
            for own in some:
                n = len(own.counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + n)),
                        own.doc_id,
                        _packed(own.symbols, own.counts),
                        pa.array(own.counts + 1),
                        pa.array(own.n_listed + has_end),
                        pa.array(own.log_listed + (logs[0] if has_end else 0)),
                        pa.array(own.log_shares),
                        own.rest,
                    ],
                    NUMBERED,
                )
                number += n

    return rows.mapInArrow(read, schema)


def _packed(symbols: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The symbols of each document, as bytes."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * symbols.itemsize
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(symbols))]
    return pa.Array.from_buffers(pa.large_binary(), len(counts), buffers).cast(pa.binary())


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all documents of a batch, and how many each has."""
    own = batch.column("symbols").to_pylist()
    symbols = np.frombuffer(b"".join(own), SYMBOL)
    return symbols, np.fromiter(map(len, own), np.int64, len(own)) // symbols.itemsize


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Network:
    """The network after one pass over the numbered documents, in `rounds` hash slices."""
    head = np.zeros(HEAD)
    head[: min(HEAD, len(vocabulary.words))] = vocabulary.counts[:HEAD]
    network = Network.started(head, vocabulary.tail_totals)
    turn = F.pmod(F.coalesce(F.xxhash64("doc_id"), F.lit(0)), F.lit(rounds))
    for number in range(rounds):
        found = _averaged(docs.where(turn == number), network)
        network = found or network
    return network


def _averaged(docs: DataFrame, network: Network) -> Network | None:
    start = network.to_bytes()

    def trained(batches):
        keep_freed()
        trainer = Trainer(Network.from_bytes(start), RATE, WINDOW, LANES)
        n_symbols = 0
        for batch in batches:
            symbols, counts = _unpacked(batch)
            laid = np.insert(symbols, np.cumsum(counts), gru.END)
            trainer.learn(laid)
            n_symbols += len(laid)
        trainer.finish()
        give_back()
        if n_symbols:
            part = TaskContext.get().partitionId()
            yield _network(part, trainer.network.to_bytes(), n_symbols)

    def summed(table):
        part = table.column("part")[0].as_py() // GROUP
        return pa.Table.from_batches([_mean(part, table)])

    schema = "part bigint, network binary, weight double"
    found = docs.select("symbols").mapInArrow(trained, schema)
    # Averages of averages: a group has GROUP networks at most, at any number of tasks.
    for _ in range(2):
        found = found.groupBy(F.floor(F.col("part") / GROUP)).applyInArrow(summed, schema)
    last = found.toArrow()
    if not last.num_rows:
        return None
    return Network.from_bytes(_mean(0, last).column("network")[0].as_py())


def _mean(part: int, table: pa.Table) -> pa.RecordBatch:
    weights = table.column("weight").to_numpy()
    flat = [np.frombuffer(x, np.float32) for x in table.column("network").to_pylist()]
    mean = np.average(flat, axis=0, weights=weights).astype(np.float32)
    return _network(part, mean.tobytes(), weights.sum())


def _network(part: int, data: bytes, weight: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array([part], pa.int64()),
            "network": pa.array([data], pa.binary()),
            "weight": pa.array([float(weight)], pa.float64()),
        }
    )


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities of the words of the whole text, A-Z lower-cased, and its end; a
    null or empty text is only an end. The base gives each word its share of the training tokens,
    with one added for each distinct word and for all unknown ones together; the model spreads its
    probability over the same words. A row without an id is learned from. Rows that repeat are
    counted and scored each on their own. With nothing to learn from, every word is unknown.
    Other columns are not read.
    """
    rows = documents(docs, id_col, text_col)
    training = rows.where(~held_out(F.col("doc_id")))
    counts = cut(count_words(training))
    vocabulary = learn_vocabulary(counts)
    docs = cut(numbered(rows, vocabulary))
    network = train(docs.where(~held_out(F.col("doc_id"))), vocabulary)
    return _scored(docs, counts, vocabulary, network, id_col)


def _scored(docs, counts, vocabulary: Vocabulary, network: Network, id_col: str) -> DataFrame:
    data = network.to_bytes()
    whole = docs.drop("rest")
    schema = whole.withColumn("log_model", F.lit(0.0)).drop("symbols").schema

    def scored(batches):
        keep_freed()
        own_network = Network.from_bytes(data)
        for some in _together(map(Stored.of, batches)):
            symbols = np.concatenate([own.symbols for own in some])
            first = np.concatenate([[0], np.cumsum(np.concatenate([own.counts for own in some]))])
            likely = gru.log_likelihoods(own_network, symbols, first, SCORED_SYMBOLS) / np.log(10)
            at = 0
            for own in some:
                n = len(own.counts)
                yield own.others.append_column("log_model", pa.array(likely[at : at + n]))
                at += n
        give_back()

    found = cut(whole.mapInArrow(scored, schema))
    others = (
        docs.select("row", F.explode("rest").alias("own"))
        .select("row", "own.word", "own.times")
        .join(counts, "word")
        .groupBy("row")
        .agg(
            F.sum("times").alias("n_others"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log_others"),
        )
    )
    divisor = float(np.log10(vocabulary.n_tokens + vocabulary.n_distinct + 1.0))
    log_others = F.coalesce("log_others", F.lit(0.0))
    return found.join(others, "row", "left").select(
        F.col("doc_id").alias(id_col),
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_listed") + F.coalesce("n_others", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_listed") + log_others - F.col("n_tokens") * F.lit(divisor)).alias("base_score"),
        (F.col("log_model") + F.col("log_shares") + log_others).alias("score"),
    )


@dataclass
class Read:
    """What scoring needs of a slice of documents, without their texts."""

    doc_id: pa.Array
    counts: np.ndarray
    symbols: np.ndarray
    n_listed: np.ndarray
    log_listed: np.ndarray
    log_shares: np.ndarray  # of the words of a class in it
    rest: pa.Array


@dataclass
class Stored:
    """A batch of numbered documents: symbols, and the columns beside them."""

    counts: np.ndarray
    symbols: np.ndarray
    others: pa.RecordBatch

    @staticmethod
    def of(batch: pa.RecordBatch) -> Stored:
        symbols, counts = _unpacked(batch)
        return Stored(counts, symbols, batch.drop_columns(["symbols"]))


def _gathered(batches, index: Index, logs: np.ndarray, totals: np.ndarray):
    """What is read of batches of texts, in lists as `_together` makes them."""
    return _together(_read(batch, index, logs, totals) for batch in batches)


def _together(slices_read):
    """Lists of slices that hold SCORED_TOKENS tokens together, or the last of them."""
    some, n_tokens = [], 0
    for own in slices_read:
        some.append(own)
        n_tokens += len(own.symbols) + len(own.counts)
        if n_tokens >= SCORED_TOKENS:
            yield some
            some, n_tokens = [], 0
    if some:
        yield some


def _read(batch: pa.RecordBatch, index: Index, logs: np.ndarray, totals: np.ndarray) -> Read:
    words = Words(batch.column("text").to_pylist(), lower=True)
    digests = words.hashes()
    numbers = index.numbers(words, digests)
    symbols = index.symbols[numbers]
    in_tail = symbols >= HEAD
    shares = np.where(in_tail, logs[numbers] - totals[np.where(in_tail, symbols - HEAD, 0)], 0)
    is_listed = numbers < LISTED
    return Read(
        batch.column("doc_id"),
        words.counts,
        symbols.astype(SYMBOL),
        words.per_words(is_listed),
        _float_sums(logs[numbers], words.first),
        _float_sums(shares, words.first),
        _rest(words, digests, ~is_listed),
    )


def _float_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _rest(words: Words, digests: np.ndarray, chosen: np.ndarray) -> pa.Array:
    """The distinct ones of the chosen words of each text, and how often each occurs there."""
    places = np.flatnonzero(chosen)
    kept, times = distinct(mixed(digests[places], words.text[places].astype(np.uint64)))
    order = np.argsort(kept)
    places = places[kept[order]]
    found = pa.StructArray.from_arrays(
        [words.array(places), pa.array(times[order], pa.int64())],
        ["word", "times"],
    )
    return pa.ListArray.from_arrays(np.searchsorted(places, words.first).astype(np.int32), found)
