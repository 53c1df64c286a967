"""A small gated recurrent network with a class-factored output, in numpy.

Symbols are the head words, one number each, and behind them one symbol per class of the other
words. A head word's probability is that of its class, times its own among the members of the class;
for other words the network gives the class only. Head classes are runs of `CLASS_SIZE` head words.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np

HEAD = 1_024
CLASS_SIZE = 32
HEAD_CLASSES = HEAD // CLASS_SIZE
TAIL_CLASSES = 96
CLASSES = HEAD_CLASSES + TAIL_CLASSES
SYMBOLS = HEAD + TAIL_CLASSES
HIDDEN = 16
# Fixed place of the end of a document among the symbols.
END = 0
# Rows of a softmax that are worked on at once, to stay in a core's cache.
BLOCK = 1_024
# Steps of a table of exponentials in one unit, and how many it has.
FINE = 512
STEPS = 1 << 16
# A float of this size has no place behind the point, and its last 16 bits are a whole number.
WHOLE = np.float32(1.5 * 2**23)
# Times of a window whose factors are made at once, for the same reason.
TIMES = 8

SHAPES = {
    "inputs": (SYMBOLS, 3 * HIDDEN),
    "states": (HIDDEN, 3 * HIDDEN),
    "classes": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "members": (HEAD_CLASSES, HIDDEN, CLASS_SIZE),
    "member_bias": (HEAD_CLASSES, CLASS_SIZE),
}


@dataclass
class Network:
    """Parameters by name."""

    values: dict[str, np.ndarray]

    @staticmethod
    def started(head_counts: np.ndarray, tail_counts: np.ndarray) -> Network:
        """Small weights, and the output of the word counts alone."""
        rng = np.random.default_rng(7)
        values = {
            name: rng.normal(0, 0.1, shape).astype(np.float32) for name, shape in SHAPES.items()
        }
        heads = (head_counts + 1.0).reshape(HEAD_CLASSES, CLASS_SIZE)
        totals = np.concatenate([heads.sum(1), tail_counts])
        values["member_bias"] = np.log(heads).astype(np.float32)
        values["class_bias"] = np.log(totals / totals.sum()).astype(np.float32)
        return Network(values)

    @staticmethod
    def from_bytes(data: bytes) -> Network:
        flat, at, values = np.frombuffer(data, np.float32), 0, {}
        for name, shape in SHAPES.items():
            n = int(np.prod(shape))
            values[name] = flat[at : at + n].reshape(shape).copy()
            at += n
        return Network(values)

    def to_bytes(self) -> bytes:
        return b"".join(self.values[name].astype(np.float32).tobytes() for name in SHAPES)

    def parts(self, many: bool = False) -> Parts:
        """The weights of the update, the reset and the inner part, each in one piece.

        Those of the gates are negative, as a gate takes the exponential of less its sum, and for steps
        of many lanes in steps of the exponentials' table, if no sum leaves it.
        """
        found = Parts(_by_part(self.values["inputs"]), _by_part(self.values["states"]))
        for weights in (found.inputs, found.states):
            np.negative(weights[:2], out=weights[:2])
        if many and found.inputs.dtype == np.float32:
            most = np.abs(found.inputs[:2]).max() + np.abs(found.states[:2]).sum(1).max()
            found.is_listed = bool(most < STEPS / FINE / 2 - 1)
            if found.is_listed:
                found.inputs[:2] *= np.float32(FINE)
                found.states[:2] *= np.float32(FINE)
        return found

    def step(
        self,
        symbols: np.ndarray,
        state: np.ndarray,
        trace: list | Trace | None = None,
        parts: Parts | None = None,
    ) -> np.ndarray:
        """The states after one more symbol each. `parts` saves their making at every step."""
        parts = parts or self.parts()
        given, own = trace.room() if isinstance(trace, Trace) else (None, None)
        given = parts.inputs.take(symbols, 1, out=given, mode="clip")
        own = np.matmul(state, parts.states, out=own)
        gates, new, inner = given[:2], given[2], own[2]
        gates += own[:2]
        _logistic(gates, parts.is_listed)
        update, reset = gates
        new += reset * inner
        np.tanh(new, out=new)
        if isinstance(trace, list):
            trace.append((gates, inner, new))
        found = state - new
        found *= update
        found += new
        return found

    def log_chances(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each symbol in the state before it."""
        classes, members = self._outputs()
        found = np.empty(len(symbols), states.dtype)
        for at in range(0, len(symbols), BLOCK):
            block = slice(at, at + BLOCK)
            found[block] = classes.logs(_with_one(states[block]), class_of(symbols[block]))
        order = np.argsort(symbols.astype(np.int16), kind="stable")
        heads, bounds = _heads(symbols[order])
        order = order[:heads]
        own = symbols[order] % CLASS_SIZE
        found[order] += members.logs(_with_one(states[order]), own, bounds)
        return found

    def _outputs(self) -> tuple[Softmax, Softmax]:
        values = self.values
        return (
            Softmax(values["classes"], values["class_bias"]),
            Softmax(values["members"], values["member_bias"]),
        )

    def gradients(self, trace, ended, states, symbols, weights) -> tuple[float, dict]:
        """Loss and gradients of one window.

        `trace`: what `step` kept for each time; `ended`: which lanes were reset after it;
        `states`, `symbols`, `weights`: by time and lane, the states before the symbols.
        """
        return self.mean_gradients([(trace, ended, states, symbols, weights)])

    def mean_gradients(self, windows: list[tuple]) -> tuple[float, dict]:
        """Loss of several windows, and gradients of its mean over their symbols by weight."""
        flat = np.concatenate([window[3].ravel() for window in windows])
        weight = np.concatenate([window[4].ravel() for window in windows])
        flat_states = _with_one(np.concatenate([w[2].reshape(-1, HIDDEN) for w in windows]))
        scale = weight * np.float32(1 / max(weight.sum(), 1))
        classes, members = self._outputs()
        grads = {name: np.zeros_like(value) for name, value in self.values.items()}
        back = np.empty((len(flat), HIDDEN), flat_states.dtype)
        own_classes, loss = class_of(flat), 0.0
        for at in range(0, len(flat), BLOCK):
            block = slice(at, at + BLOCK)
            part, own = flat_states[block], own_classes[block]
            chance, total, logs = classes.chances(part, own)
            loss -= float((logs * weight[block]).sum())
            chance.reshape(-1)[_places(chance, own)] -= total
            share = (scale[block] / total)[:, None]
            np.matmul(chance, classes.weights.T, out=back[block])
            back[block] *= share
            sums = (part * share).T @ chance
            grads["classes"] += sums[:-1]
            grads["class_bias"] += sums[-1]
        order = np.argsort(flat.astype(np.int16), kind="stable")
        ordered = flat[order]
        heads, bounds = _heads(ordered)
        places = order[:heads]
        part, own = flat_states[places], ordered[:heads] % CLASS_SIZE
        chance, total, logs = members.chances(part, own, bounds)
        loss -= float((logs * weight[places]).sum())
        chance.reshape(-1)[_places(chance, own)] -= total
        chance *= (scale[places] / total)[:, None]
        more = np.empty((heads, HIDDEN), back.dtype)
        for number, start, stop in _runs(bounds):
            run = chance[start:stop]
            np.matmul(run, members.weights[number].T, out=more[start:stop])
            sums = part[start:stop].T @ run
            grads["members"][number] = sums[:-1]
            grads["member_bias"][number] = sums[-1]
        back[places] += more
        at, going = 0, _by_part(self.values["states"]).transpose(0, 2, 1)
        # Gradients of what the states gave to each part, and of what the inputs gave to the inner part
        given = np.empty((4, len(flat), HIDDEN), back.dtype)
        for trace, ended, states, symbols, _ in windows:
            block = slice(at, at + symbols.size)
            of_window = given[:, block].reshape(4, *states.shape)
            _back(going, trace, ended, states, back[block].reshape(states.shape), of_window)
            at += symbols.size
        states = flat_states[:, :-1].T
        start = np.flatnonzero(np.diff(ordered, prepend=-1))
        for number, of_inputs in enumerate((0, 1, 3)):
            part = slice(number * HIDDEN, (number + 1) * HIDDEN)
            grads["states"][:, part] = states @ given[number]
            # Pairs of columns are summed as complex numbers, in half as many sums
            rows = given[of_inputs].take(order, 0).view(np.result_type(back, np.complex64))
            sums = np.add.reduceat(rows, start).view(back.dtype)
            grads["inputs"][ordered[start], part] = sums
        return loss, grads


class Trace:
    """What `step` keeps of all times of a window, in one piece: gates and new by time in `given`, the
    inner part in `own`. `_back` uses it up."""

    def __init__(self, times: int, lanes: int, dtype):
        self.given, self.own = np.empty((2, times, 3, lanes, HIDDEN), dtype)
        self.times = 0

    def room(self) -> tuple[np.ndarray, np.ndarray]:
        self.times += 1
        return self.given[self.times - 1], self.own[self.times - 1]

    @staticmethod
    def of(steps: list) -> Trace:
        gates, inner, new = steps[0]
        found = Trace(len(steps), len(new), new.dtype)
        for gates, inner, new in steps:
            given, own = found.room()
            given[:2], given[2], own[2] = gates, new, inner
        return found


@dataclass
class Parts:
    """Weights by part: update, reset and inner part."""

    inputs: np.ndarray
    states: np.ndarray
    is_listed: bool = False


def _by_part(weights: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(weights.reshape(len(weights), 3, HIDDEN).transpose(1, 0, 2))


def _back(going, trace, ended, states, back, given) -> None:
    """Writes into `given`, by part, time and lane, the gradients of what the states gave to the
    update, the reset and the inner part, and of what the inputs gave to the inner part.

    `back`: gradients of the states before each time's symbols, by what was read from them;
    `going`: the states' weights, by part, from the parts to the states.
    """
    times, lanes, _ = back.shape
    trace = trace if isinstance(trace, Trace) else Trace.of(trace)
    # First what a state's gradient is multiplied by, for all lanes of some times
    for at in range(0, times, TIMES):
        some = slice(at, at + TIMES)
        update, reset, new = trace.given[some].swapaxes(0, 1)
        inner = trace.own[some, 2]
        of_update, of_reset, of_inner, left = given[:, some]
        np.subtract(states[some], new, out=of_update)
        of_update *= update
        np.subtract(1, update, out=left)
        of_update *= left
        new *= new
        np.subtract(1, new, out=new)
        left *= new
        np.multiply(left, reset, out=of_inner)
        np.multiply(of_inner, inner, out=of_reset)
        np.subtract(1, reset, out=reset)
        of_reset *= reset
    coming = np.zeros((lanes, HIDDEN), back.dtype)
    through = np.empty((3, lanes, HIDDEN), back.dtype)
    any_ended = np.any(ended, 1)
    for t in range(times - 1, -1, -1):
        if any_ended[t]:
            coming[ended[t]] = 0
        factors = given[:, t]
        factors *= coming
        np.matmul(factors[:3], going, out=through)
        coming *= trace.given[t, 0]
        first, second, third = through
        first += second
        first += third
        coming += first
        coming += back[t]


def class_of(symbols: np.ndarray) -> np.ndarray:
    return np.where(
        symbols < HEAD, symbols // CLASS_SIZE, symbols - HEAD + HEAD_CLASSES
    )


def _heads(ordered: np.ndarray) -> tuple[int, np.ndarray]:
    """How many of the ordered symbols are head words, and where each class of them begins."""
    bounds = np.searchsorted(ordered, np.arange(0, HEAD + 1, CLASS_SIZE))
    return int(bounds[-1]), bounds


def _runs(bounds: np.ndarray):
    """(number, start, end) of each class that occurs."""
    places = bounds.tolist()
    for number in range(len(places) - 1):
        if places[number] < places[number + 1]:
            yield number, places[number], places[number + 1]


def _with_one(states: np.ndarray) -> np.ndarray:
    """The states with a column of ones behind them, which the bias is the weight of."""
    found = np.empty((len(states), HIDDEN + 1), states.dtype)
    found[:, :-1] = states
    found[:, -1] = 1
    return found


def _logistic(x: np.ndarray, is_listed: bool = False) -> None:
    """Of less the sums, in place."""
    if is_listed:
        x *= listed_factors(x, AROUND)
    else:
        exponentials(x)
    x += 1
    np.reciprocal(x, out=x)


class Softmax:
    """A softmax layer, or several with a row of weights each, for states between -1 and 1."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights = weights
        reach = np.abs(weights).sum(-2)
        most = (reach + bias).max(-1, keepdims=True)
        # No logit is above 0, and too far below none unless the reach is long
        self.is_near = float(reach.max()) <= 40
        self.table = np.concatenate([weights, np.expand_dims(bias - most, -2)], -2)
        # The logits as steps of the exponentials' table, if all of them are in it
        least = float((bias - reach - most).min())
        in_table = weights.dtype == np.float32 and least > 1 - STEPS / FINE
        self.is_listed = in_table and self.is_near
        if self.is_listed:
            self.table *= np.float32(FINE)

    def chances(self, states: np.ndarray, chosen: np.ndarray, bounds: np.ndarray | None = None):
        """Exponentials of the logits, their sum, and the log probability of the chosen column.

        `states` have a one behind them; with several layers they are in runs, cut at `bounds`.
        """
        logits, own = self._logits(states, chosen, bounds)
        if self.is_listed:
            logits *= listed_factors(logits)
        else:
            exponentials(logits)
        total = logits @ np.ones(logits.shape[1], logits.dtype)
        return logits, total, own - np.log(total)

    def logs(self, states: np.ndarray, chosen: np.ndarray, bounds: np.ndarray | None = None):
        """The last of these alone."""
        logits, own = self._logits(states, chosen, bounds)
        if self.is_listed:
            return own - np.log(np.einsum("ij,ij->i", listed_factors(logits), logits))
        exponentials(logits)
        return own - np.log(logits @ np.ones(logits.shape[1], logits.dtype))

    def _logits(self, states, chosen, bounds) -> tuple[np.ndarray, np.ndarray]:
        """In steps of the table if they are in it, and the chosen ones in units."""
        logits = np.empty((len(states), self.table.shape[-1]), states.dtype)
        if bounds is None:
            np.matmul(states, self.table, out=logits)
        else:
            for number, start, stop in _runs(bounds):
                np.matmul(states[start:stop], self.table[number], out=logits[start:stop])
        if not (self.is_listed or self.is_near):  # too far apart for one shift for all rows
            logits -= logits.max(1, keepdims=True)
        own = logits.reshape(-1).take(_places(logits, chosen))
        if self.is_listed:
            own /= np.float32(FINE)
        return logits, own


def _places(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Where one column of each row is in all of them."""
    return np.arange(0, rows.size, rows.shape[1]) + columns


def exponentials(x: np.ndarray) -> None:
    """In place."""
    np.exp(x, out=x)


# Of each step from 0 down, by its last 16 bits, divided by the steps of a unit.
EXPONENTIALS = (np.exp(-(-np.arange(STEPS) % STEPS) / FINE) / FINE).astype(np.float32)
# The same with half of the steps above 0.
AROUND = np.arange(STEPS).astype(np.uint16).view(np.int16)
AROUND = (np.exp(AROUND / FINE) / FINE).astype(np.float32)


def listed_factors(x: np.ndarray, table: np.ndarray = EXPONENTIALS) -> np.ndarray:
    """For 32-bit numbers inside the table, in steps of it: two factors of their exponentials. One is
    returned, the other takes the place of the numbers.

    One is the exponential at the nearest step, the other that of the rest to the first order. The
    product is right to half a millionth.
    """
    near = x + WHOLE
    found = table.take(near.view(np.uint16)[..., ::2], mode="wrap")
    near -= WHOLE + np.float32(FINE)
    x -= near
    return found


class Trainer:
    """Steps along lanes of documents by truncated backpropagation, with Adam.

    A lane reads whole documents, one after the other; one that runs out of them takes the next
    document. Every window of every lane gives a gradient. Call `finish` after the last documents.
    """

    def __init__(self, network: Network, rate: float, window: int, lanes: int):
        self.network, self.rate, self.window, self.lanes = network, rate, window, lanes
        self.first = {name: np.zeros_like(x) for name, x in network.values.items()}
        self.second = {name: np.zeros_like(x) for name, x in network.values.items()}
        self.waiting: list[tuple] = []  # windows since the last step
        self.steps, self.loss, self.weight, self.gathered = 0, 0.0, 0.0, 0.0
        self.coming: deque[np.ndarray] = deque()
        # What each lane has left to read, and its state
        self.left: list[np.ndarray] = []
        self.state = np.zeros((0, HIDDEN), np.float32)

    def learn(self, symbols: np.ndarray) -> None:
        """Learn from documents laid end to end, each closed by END.

        Windows are taken while there are documents for all lanes; the rest waits for more.
        """
        self.coming.extend(np.split(symbols, np.flatnonzero(symbols == END)[:-1] + 1))
        while self._filled():
            self._window()

    def finish(self) -> None:
        """Learn from what is left, in fewer and fewer lanes."""
        self._filled()
        while self.left:
            self._window()
            self._filled()
        if self.gathered:
            self._step()

    def _filled(self) -> bool:
        """Gives documents to lanes with less than a window; whether all lanes have a window."""
        short = [lane for lane, rest in enumerate(self.left) if len(rest) < self.window]
        for lane in short:
            parts = [self.left[lane]]
            n = len(parts[0])
            while n < self.window and self.coming:
                parts.append(self.coming.popleft())
                n += len(parts[-1])
            if len(parts) > 1:
                self.left[lane] = np.concatenate(parts)
        while len(self.left) < self.lanes and self.coming:
            self.left.append(self.coming.popleft())
            self.state = np.concatenate([self.state, np.zeros((1, HIDDEN), np.float32)])
        if not all(len(self.left[lane]) for lane in short):
            reading = [lane for lane, rest in enumerate(self.left) if len(rest)]
            self.left = [self.left[lane] for lane in reading]
            self.state = self.state[reading]
        return len(self.left) == self.lanes and all(len(x) >= self.window for x in self.left)

    def _window(self) -> None:
        some = [rest[: self.window] for rest in self.left]
        self.left = [rest[self.window :] for rest in self.left]
        lengths = np.fromiter(map(len, some), np.int64, len(some))
        inside = np.arange(lengths.max()) < lengths[:, None]
        part = np.full(inside.shape, END, np.int64)
        part[inside] = np.concatenate(some)
        part, weights = np.ascontiguousarray(part.T), inside.T.astype(np.float32, order="C")
        state, ended = self.state, part == END
        trace = Trace(*part.shape, state.dtype)
        states = np.empty((*part.shape, HIDDEN), state.dtype)
        parts = self.network.parts()
        for t, any_ended in enumerate(ended.any(1)):
            states[t] = state
            state = self.network.step(part[t], state, trace, parts)
            if any_ended:
                state[ended[t]] = 0
        self.state = state
        self._update(trace, ended, states, part, weights)

    def _update(self, trace, ended, states, symbols, weights) -> None:
        """Keeps windows; a step is taken from as many symbols as all lanes have."""
        self.waiting.append((trace, ended, states, symbols, weights))
        self.gathered += float(weights.sum())
        if self.gathered >= self.lanes * self.window:
            self._step()

    def _step(self) -> None:
        self.weight += self.gathered
        self.steps += 1
        loss, grads = self.network.mean_gradients(self.waiting)
        self.loss += loss
        self.waiting = []
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        shrink = min(1.0, 1.0 / max(norm, 1e-9)) * min(
            1.0, self.gathered / (self.lanes * self.window)
        )
        self.gathered = 0.0
        even = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for name, grad in grads.items():
            grad *= np.float32(shrink)
            self.first[name] += 0.1 * (grad - self.first[name])
            grad *= grad
            self.second[name] += 0.001 * (grad - self.second[name])
            self.network.values[name] -= np.float32(even) * self.first[name] / (
                np.sqrt(self.second[name]) + np.float32(1e-8)
            )


def log_likelihoods(
    network: Network, symbols: np.ndarray, first: np.ndarray, window: int
) -> np.ndarray:
    """Natural log probability that the network gives each document and its end.

    `symbols` are the documents' words end to end; `first` where each begins, and the end. The
    documents run side by side, the longest ones longest; states are carried from window to window.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, shorter = first[order], -lengths[order]
    total = np.zeros(len(order))
    state = np.zeros((len(order), HIDDEN), np.float32)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    most = 1 - int(shorter[0]) if len(order) else 0
    parts = network.parts(many=True)
    n_waiting = 0
    for t in range(most):
        # Documents with a symbol left, their end included.
        n = int(np.searchsorted(shorter, -t, "right"))
        inside = int(np.searchsorted(shorter, -t, "left"))
        now = np.full(n, END, np.int64)
        now[:inside] = symbols[begin[:inside] + t]
        waiting.append((state[:n], now))
        n_waiting += n
        if n_waiting >= window or t == most - 1:
            states = np.concatenate([x for x, _ in waiting])
            chosen = np.concatenate([x for _, x in waiting])
            lane = np.concatenate([np.arange(len(x)) for _, x in waiting])
            total += np.bincount(lane, network.log_chances(states, chosen), len(total))
            waiting, n_waiting = [], 0
        state = network.step(now[:inside], state[:inside], parts=parts)
    found = np.empty(len(order))
    found[order] = total
    return found
