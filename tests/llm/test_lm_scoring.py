"""The language model: its counts, its gradients and its probabilities."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.corpus import frame, odd_rows, prose, words_of
from tidemark.llm import gru, lm_scoring
from tidemark.llm.gru import Network
from tidemark.llm.text import Words


def network(seed=0):
    rng = np.random.default_rng(seed)
    found = Network.started(
        rng.integers(1, 100, gru.HEAD), rng.integers(2, 100, gru.TAIL_CLASSES).astype(float)
    )
    found.values = {name: value.astype(float) * 3 for name, value in found.values.items()}
    return found


def forward(model, symbols):
    state = np.zeros((symbols.shape[1], gru.HIDDEN))
    trace, states, ended = [], [], []
    for now in symbols:
        states.append(state)
        state = model.step(now, state, trace)
        state[now == gru.END] = 0
        ended.append(now == gru.END)
    return trace, ended, np.stack(states)


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    model, symbols = network(), rng.integers(0, gru.SYMBOLS, (6, 3))
    symbols[2, 1] = gru.END
    weights = np.ones(symbols.shape)
    weights[5, 2] = 0

    def loss():
        states = forward(model, symbols)[2].reshape(-1, gru.HIDDEN)
        return -(model.log_chances(states, symbols.ravel()) * weights.ravel()).sum()

    value, grads = model.gradients(*forward(model, symbols), symbols, weights)
    assert value == pytest.approx(loss())
    for name, grad in grads.items():
        flat = model.values[name].reshape(-1)
        for place in np.argsort(-np.abs(grad.ravel()))[:5]:
            kept = flat[place]
            flat[place] = kept + 1e-5
            above = loss()
            flat[place] = kept - 1e-5
            below = loss()
            flat[place] = kept
            slope = (above - below) / 2e-5 / weights.sum()
            assert grad.ravel()[place] == pytest.approx(slope, rel=1e-3, abs=1e-6)


def test_probabilities_of_symbols_sum_to_one():
    model = network(3)
    state = np.random.default_rng(2).normal(size=(1, gru.HIDDEN))
    every = np.arange(gru.SYMBOLS)
    found = model.log_chances(np.repeat(state, len(every), 0), every)
    assert np.exp(found).sum() == pytest.approx(1)


def test_documents_side_by_side_score_as_alone():
    rng = np.random.default_rng(4)
    model = network(5)
    lengths = [0, 40, 3, 0, 17, 40]
    first = np.concatenate([[0], np.cumsum(lengths)])
    symbols = rng.integers(1, gru.SYMBOLS, first[-1])
    for window in (1, 16, 10_000):
        found = gru.log_likelihoods(model, symbols, first, window)
        for i, n in enumerate(lengths):
            own = np.append(symbols[first[i] : first[i + 1]], gru.END)
            state, total = np.zeros((1, gru.HIDDEN)), 0.0
            for symbol in own:
                total += model.log_chances(state, np.array([symbol]))[0]
                state = model.step(np.array([symbol]), state)
            assert found[i] == pytest.approx(total, rel=1e-5)


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "LISTED", 150)
    rows = [*odd_rows(), *[(100 + i, prose(i, 150, ["the", "of", "sun", "sea"])) for i in range(60)]]
    rows += [(200 + i, prose(i, 150, ["le", "de", "mer", "ciel"]) + f" unique{i}") for i in range(60)]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter()
    for (_, text), out in zip(rows, held, strict=True):
        if not out:
            counts.update([*words_of(text, lower=True), " "])
    total, distinct = sum(counts.values()), len(counts)
    found = lm_scoring.lm_scores(frame(spark, rows)).collect()
    expected = []
    for (number, text), out in zip(rows, held, strict=True):
        tokens = [*words_of(text, lower=True), " "]
        base = sum(np.log10((counts[x] + 1) / (total + distinct + 1)) for x in tokens)
        known = sum(counts[x] > 0 for x in tokens)
        expected.append((str(number), out, len(tokens), known, total, round(base, 6)))
    assert sorted(expected) == sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in found
    )
    assert all(r.score < 0 for r in found)
    unseen = [r for r in found if r.held_out and r.doc_id >= 100]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_digests_that_meet_in_a_slot_are_told_apart():
    rng = np.random.default_rng(9)
    digests = rng.choice(rng.integers(0, 1 << 63, 400, np.uint64) << np.uint64(6), 3_000)
    for own in (digests, digests[:1], digests[:0], np.zeros(5, np.uint64)):
        places, times = lm_scoring.distinct(own)
        assert Counter(own.tolist()) == dict(zip(own[places].tolist(), times.tolist(), strict=True))


@pytest.mark.parametrize("n", [1, 2, 400])
def test_numbers_of_words_that_meet_in_a_slot(monkeypatch, n):
    listed = [b" ", *[b"w%d" % i for i in range(1, n)]]
    vocabulary = lm_scoring.Vocabulary(
        listed, np.arange(n), np.empty(0, np.int64), np.ones(gru.TAIL_CLASSES), n, n
    )
    words = Words([b" ".join([b"other", *listed[1:], b"w0", *listed[:0:-1], b"more"])])
    # Eight digests in a slot, words that are not listed among them
    hashes = Words.hashes
    monkeypatch.setattr(Words, "hashes", lambda self: hashes(self) << np.uint64(3))
    index = lm_scoring.Index(vocabulary)
    assert set(index.digests.tolist()) >= set(Words([b"\n".join(listed[1:])]).hashes().tolist())
    own = lm_scoring.LISTED + gru.TAIL_CLASSES - 1
    places = list(range(1, n))
    assert index.numbers(words).tolist() == [own, *places, own, *places[::-1], own]


def test_words_of_a_class_share_it(spark):
    """The shares of a class's words and of one unknown word sum to one."""
    rows = [(i, prose(i, 3000, [f"t{k}" for k in range(3000)])) for i in range(10)]
    docs = frame(spark, rows).selectExpr("doc_id", "encode(text, 'utf-8') AS text")
    counts = lm_scoring.count_words(docs)
    vocabulary = lm_scoring.learn_vocabulary(counts)
    sums = np.ones(gru.TAIL_CLASSES)
    head = set(vocabulary.words[: gru.HEAD])
    for row in counts.collect():
        if bytes(row.word) not in head:
            sums[vocabulary.tail_classes(Words([bytes(row.word)]))[0]] += row.n + 1
    assert sums.tolist() == vocabulary.tail_totals.tolist()


def test_every_symbol_is_learned_once_from_the_start_of_its_document():
    rng = np.random.default_rng(6)
    docs = [np.append(rng.integers(1, gru.SYMBOLS, n), gru.END) for n in [0, 1, 700, *range(5, 60)]]
    trainer = gru.Trainer(Network.started(np.ones(gru.HEAD), np.ones(gru.TAIL_CLASSES)), 0.01, 8, 5)
    update, windows = trainer._update, []

    def noted(trace, ended, states, symbols, weights):
        windows.append((states.copy(), symbols.copy(), weights.copy()))
        update(trace, ended, states, symbols, weights)

    trainer._update = noted
    for part in (docs[:3], docs[3:10], docs[10:]):
        trainer.learn(np.concatenate(part))
    trainer.finish()
    read = np.concatenate([symbols[weights > 0] for _, symbols, weights in windows])
    assert np.array_equal(np.sort(read), np.sort(np.concatenate(docs)))
    assert trainer.weight == len(read) and trainer.gathered == 0
    # A state is empty at the start of a document and nowhere else
    begun = sum(
        int(((np.abs(states).sum(2) == 0) & (weights > 0)).sum())
        for states, _, weights in windows
    )
    assert begun == len(docs)


def test_documents_of_several_slices_are_scored_side_by_side(spark, monkeypatch):
    rows = [(i, prose(i, 40 + 7 * i, ["the", "of", "sun", "sea", f"own{i}"])) for i in range(30)]
    vocabulary = lm_scoring.learn_vocabulary(
        lm_scoring.count_words(frame(spark, rows).selectExpr("encode(text, 'utf-8') AS text"))
    )
    index, logs = lm_scoring.Index(vocabulary), np.zeros(lm_scoring.LISTED + gru.TAIL_CLASSES)
    batches = [
        pa.RecordBatch.from_pydict({"doc_id": [i], "text": [text.encode()]}) for i, text in rows
    ]
    monkeypatch.setattr(lm_scoring, "SCORED_TOKENS", 600)
    found = list(lm_scoring._gathered(batches, index, logs, np.zeros(gru.TAIL_CLASSES)))
    own = [x.doc_id[0].as_py() for some in found for x in some]
    assert own == [i for i, _ in rows] and 1 < len(found) < len(rows)
    sums = [sum(len(x.symbols) + len(x.counts) for x in some) for some in found]
    assert min(sums[:-1]) >= 600 and max(sums) < 600 + 40 + 7 * 30 + 1


def test_windows_of_one_step_have_the_mean_of_their_gradients():
    rng = np.random.default_rng(11)
    model, windows = network(7), []
    for times, lanes in ((6, 3), (2, 1), (5, 4)):
        symbols = rng.integers(0, gru.SYMBOLS, (times, lanes))
        weights = (rng.random(symbols.shape) < 0.8).astype(float)
        windows.append((*forward(model, symbols), symbols, weights))
    loss, grads = model.mean_gradients(windows)
    alone = [model.gradients(*window) for window in windows]
    sums = [window[-1].sum() for window in windows]
    assert loss == pytest.approx(sum(own for own, _ in alone))
    for name, grad in grads.items():
        mean = sum(own[name] * n for (_, own), n in zip(alone, sums, strict=True)) / sum(sums)
        assert np.allclose(grad, mean, rtol=1e-6, atol=1e-9)


def test_weights_that_lie_far_apart_have_probabilities():
    model = network(3)
    model.values["classes"] *= 400
    state = np.full((1, gru.HIDDEN), 0.9)
    every = np.arange(gru.SYMBOLS)
    found = model.log_chances(np.repeat(state, len(every), 0), every)
    assert np.isfinite(found).all() and np.exp(found).sum() == pytest.approx(1)


def test_exponentials_of_the_tables():
    x = np.random.default_rng(12).uniform(-80, 0, 5_000).astype(np.float32)
    x[:3] = 0, -0.25 / gru.FINE, -80
    for table, own in ((gru.EXPONENTIALS, x), (gru.AROUND, x + 40)):
        steps = own * np.float32(gru.FINE)
        found = gru.listed_factors(steps, table) * steps
        assert np.allclose(found, np.exp(own.astype(float)), rtol=2e-6, atol=0)


def test_states_and_chances_by_the_tables_are_those_without():
    rng = np.random.default_rng(13)
    exact, model = network(6), network(6)
    model.values = {name: value.astype(np.float32) for name, value in model.values.items()}
    assert model.parts(many=True).is_listed and all(x.is_listed for x in model._outputs())
    assert not any(x.is_listed for x in exact._outputs())
    symbols, state = rng.integers(0, gru.SYMBOLS, 500), rng.uniform(-1, 1, (500, gru.HIDDEN))
    own = model.step(symbols, state.astype(np.float32), parts=model.parts(many=True))
    assert np.allclose(own, exact.step(symbols, state), atol=2e-6)
    chances = model.log_chances(state.astype(np.float32), symbols)
    assert np.allclose(chances, exact.log_chances(state, symbols), atol=2e-5)


def test_a_trace_in_one_piece_gives_the_gradients_of_a_list():
    rng = np.random.default_rng(14)
    model, symbols = network(8), rng.integers(0, gru.SYMBOLS, (11, 4))
    steps, ended, states = forward(model, symbols)
    weights = np.ones(symbols.shape)
    loss, grads = model.gradients(steps, ended, states, symbols, weights)
    trace = gru.Trace(*symbols.shape, float)
    for now, state in zip(symbols, states, strict=True):
        model.step(now, state, trace)
    found, own = model.gradients(trace, ended, states, symbols, weights)
    assert found == loss and all(np.allclose(grads[x], own[x]) for x in grads)


def test_documents_are_numbered_once(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "LISTED", 4)
    rows = [(1, "a b a zz zz"), (2, None), (3, "zz b\ty a"), (4, "a"), (None, "a b")]
    docs = frame(spark, rows).selectExpr("doc_id", "encode(coalesce(text, ''), 'utf-8') AS text")
    vocabulary = lm_scoring.learn_vocabulary(lm_scoring.count_words(docs))
    assert vocabulary.words == [b" ", b"a", b"b", b"zz"]
    assert (vocabulary.n_tokens, vocabulary.n_distinct) == (17, 5)
    vocabulary.words, vocabulary.counts = vocabulary.words[:3], vocabulary.counts[:3]
    found = {r.doc_id: r for r in lm_scoring.numbered(docs, vocabulary).collect()}
    symbols = {k: np.frombuffer(r.symbols, lm_scoring.SYMBOL).tolist() for k, r in found.items()}
    last = gru.SYMBOLS - 1
    assert symbols == {1: [1, 2, 1, last, last], 2: [], 3: [last, 2, last, 1], 4: [1], None: [1, 2]}
    rest = {k: sorted((bytes(x.word), x.times) for x in r.rest) for k, r in found.items()}
    assert rest == {1: [(b"zz", 2)], 2: [], 3: [(b"y", 1), (b"zz", 1)], 4: [], None: []}
    assert [found[k].n_listed for k in (1, 2, 3, 4)] == [4, 1, 3, 2]


@pytest.mark.parametrize("listed", [2, 5, 9, 40])
def test_words_are_listed_by_count_then_by_bytes(spark, monkeypatch, listed):
    monkeypatch.setattr(lm_scoring, "LISTED", listed)
    monkeypatch.setattr(lm_scoring, "HEAD", 3)
    texts = [" ".join(f"w{k:02d}" for k in range(30) for _ in range(k % 4 + 1))]
    docs = frame(spark, [(1, texts[0])]).selectExpr("encode(text, 'utf-8') AS text")
    found = lm_scoring.learn_vocabulary(lm_scoring.count_words(docs))
    counts = Counter(x.encode() for x in texts[0].split())
    order = [b" ", *sorted(counts, key=lambda x: (-counts[x], x))]
    assert found.words == order[:listed]
    outside = order[3:] if listed >= 3 else []
    if listed > 3:
        assert found.tail_totals.sum() == sum(counts[x] + 1 for x in outside) + gru.TAIL_CLASSES


def test_words_as_arrow_has_them():
    words = Words([b"", b"one  two\tthree", b"four "])
    for places in ([], [0], [3, 1, 1, 2]):
        places = np.array(places, np.int64)
        assert words.array(places).to_pylist() == words.words(places)
