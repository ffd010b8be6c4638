"""A gated recurrent network over word symbols in numpy: forward, truncated backpropagation, updates.

The next symbol's probability is factored: a softmax over classes, and one over the symbols of the
class.  Symbols are numbered by falling frequency, and a class is a run of numbers, so a class's
weights are a slice.  The last symbol, the rest, is a class of its own.

Texts are lanes of a matrix, longest first: as lanes end, the active ones stay a prefix.  Arrays
grow with lanes and the window, not with the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SCORE_LANES = 2048
SCORE_TOKENS = 1 << 15  # whose states are kept before their probabilities are worked out
BETA_1, BETA_2, TINY = 0.9, 0.99, 1e-8
FEW_ROWS = 8  # of one symbol, that are added up side by side with those of others


def class_edges(counts: np.ndarray, classes: int) -> np.ndarray:
    """Where classes of symbols begin, and the end: equal shares of the square roots of counts."""
    share = np.cumsum(np.sqrt(counts + 0.1))
    number = np.minimum((share - 1e-9) / share[-1] * classes, classes - 1).astype(int)
    return np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(counts))


class Rooms:
    """Large arrays by name, kept for the next window: given back to the system and asked for again, they
    cost a quarter of all time."""

    def __init__(self) -> None:
        self.rooms: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        """An array of that shape, whose values are left from the window before."""
        size = math.prod(shape)
        if name not in self.rooms or len(self.rooms[name]) < size:
            self.rooms[name] = np.empty(size, np.float32)
        return self.rooms[name][:size].reshape(shape)


@dataclass
class Network:
    """``weights`` by name; symbols below ``edges[-1]`` are in classes, symbol ``edges[-1]`` is the rest."""

    edges: np.ndarray
    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, counts: np.ndarray, rest: float, *, hidden: int, classes: int, seed: int) -> Network:
        """Small random weights; biases say how frequent classes and symbols are."""
        draw = np.random.default_rng(seed)
        edges = class_edges(counts, classes)
        n = len(counts)
        mass = np.append(np.add.reduceat(counts + 0.1, edges[:-1]), rest + 0.1)
        weights = {
            "inputs": draw.normal(0, 0.1, (n + 1, 3 * hidden)),
            "states": draw.normal(0, hidden**-0.5, (hidden, 3 * hidden)),
            "classes": np.zeros((len(edges), hidden)),
            "class_bias": np.log(mass / mass.sum()),
            "symbols": np.zeros((n, hidden)),
            "symbol_bias": np.log(counts + 0.1),
        }
        return cls(edges, {k: w.astype(np.float32) for k, w in weights.items()})

    @property
    def hidden(self) -> int:
        return len(self.weights["states"])

    @property
    def class_of(self) -> np.ndarray:
        """Class of each symbol, the rest included."""
        sizes = np.append(np.diff(self.edges), 1)
        return np.repeat(np.arange(len(sizes)), sizes)

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights.values()])

    def with_flat(self, values: np.ndarray) -> Network:
        weights, at = {}, 0
        for k, w in self.weights.items():
            weights[k] = values[at : at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size
        return Network(self.edges, weights)

    def by_gate(self, name: str) -> np.ndarray:
        """Weights of inputs or states for the reset gate, the update gate and the candidate, ``(3, rows, hidden)``:
        what is worked out with them has the values of a gate side by side."""
        w = self.weights[name]
        return np.ascontiguousarray(w.reshape(len(w), 3, self.hidden).swapaxes(0, 1))

    def log_probability(
        self,
        states: np.ndarray,
        targets: np.ndarray,
        room: Rooms,
        gradients: dict | None = None,
    ):
        """Natural logarithm of each target's probability; with ``gradients``, which are zero, also
        fills in the loss's gradients by weights and returns those by states (of the mean over targets).
        Large arrays are in ``room``, gradients by states among them.

        Scores have a column for each target, so that sums over classes run along memory.
        """
        w, edges, learn = self.weights, self.edges, gradients is not None
        own = self.class_of[targets].astype(np.int16)
        scores = np.matmul(w["classes"], states.T, out=room("scores", len(edges), len(targets)))
        scores += w["class_bias"][:, None]
        log_p, p = _softmax(scores, own, learn)
        if learn:
            scale = np.float32(1 / len(targets))
            p[own, np.arange(len(targets))] -= 1
            p *= scale
            gradients["classes"][:] = p @ states
            gradients["class_bias"][:] = p.sum(axis=1)
            by_state = np.matmul(p.T, w["classes"], out=room("by_states", *states.shape))
        # Targets in the order of classes, those of the rest left out.
        order = np.argsort(own, kind="stable")
        bounds = np.searchsorted(own[order], np.arange(len(edges)))
        order = order[: bounds[-1]]
        sorted_states = states.take(order, axis=0, out=room("sorted", len(order), self.hidden), mode="clip")
        sorted_targets = targets[order]
        in_class = np.zeros(len(order), np.float32)
        if learn:
            back = room("back", *sorted_states.shape)
            back.fill(0)
        for c in np.flatnonzero(np.diff(bounds)).tolist():
            low, high, at = edges[c], edges[c + 1], slice(bounds[c], bounds[c + 1])
            if high - low == 1:  # its only symbol is certain
                continue
            inside, mine = sorted_targets[at] - low, sorted_states[at]
            weights = w["symbols"][low:high]
            scores = np.matmul(weights, mine.T, out=room("in_class", len(weights), len(mine)))
            scores += w["symbol_bias"][low:high, None]
            in_class[at], p = _softmax(scores, inside, learn)
            if learn:
                p[inside, np.arange(len(inside))] -= 1
                np.matmul(p, mine, out=gradients["symbols"][low:high])
                np.sum(p, axis=1, out=gradients["symbol_bias"][low:high])
                np.matmul(p.T, weights, out=back[at])
        log_p[order] += in_class
        if not learn:
            return log_p
        gradients["symbols"] *= scale
        gradients["symbol_bias"] *= scale
        back *= scale
        by_state[order] += back
        return log_p, by_state


def _step(
    state: np.ndarray, given: np.ndarray, weights: np.ndarray, gates: np.ndarray, candidate: np.ndarray, new: np.ndarray
) -> None:
    """One step of all lanes: fills in the new state, its candidate, and ``gates`` with the reset gate, the
    update gate and what the candidate has from the state.  ``given``: the symbols' input weights by gate."""
    np.matmul(state, weights, out=gates)
    both = gates[:2]
    both += given[:2]
    _sigmoid(both)
    reset, update, own = gates
    np.multiply(reset, own, out=candidate)
    candidate += given[2]
    candidate *= 2
    _sigmoid(candidate)
    candidate *= 2
    candidate -= 1
    np.subtract(state, candidate, out=new)
    new *= update
    new += candidate


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def add_by_symbol(symbols: np.ndarray, rows: np.ndarray, out: np.ndarray, spare: np.ndarray | None = None) -> None:
    """For each symbol that occurs, fills in the sum of its ``rows``; ``spare`` has their shape."""
    symbols = symbols.astype(np.int16)
    order = np.argsort(symbols, kind="stable")
    first = np.flatnonzero(np.diff(symbols[order], prepend=-1))
    length = np.diff(np.append(first, len(order)))
    # Most symbols occur a few times: their first rows are added up at once, and so on.  The order of
    # sums is that of reduceat: the first, and then all others.
    for n in range(1, FEW_ROWS + 1):
        at = first[length == n]
        if len(at):
            total = rows.take(order[at], axis=0)
            if n > 1:
                others = rows.take(order[at + 1], axis=0)
                for k in range(2, n):
                    others += rows.take(order[at + k], axis=0)
                total += others
            out[symbols[order[at]]] = total
    many = length > FEW_ROWS
    if many.any():
        order, length = order[np.repeat(many, length)], length[many]
        taken = rows.take(order, axis=0, out=None if spare is None else spare[: len(order)], mode="clip")
        first = np.cumsum(length) - length
        out[symbols[order[first]]] = np.add.reduceat(taken, first)


def _softmax(scores: np.ndarray, targets: np.ndarray, all_of_them: bool) -> tuple[np.ndarray, np.ndarray]:
    """By column: logarithm at the target and, if wanted, all probabilities."""
    scores -= scores.max(axis=0)
    at = scores[targets, np.arange(len(targets))]
    p = np.exp(scores, out=scores)
    total = p.sum(axis=0)
    if all_of_them:
        p /= total
    return at - np.log(total), p


@dataclass
class Lanes:
    """Texts side by side, longest first: symbols, and where each begins among all."""

    symbols: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    first_input: int

    def windows(self, steps: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Inputs, targets and places among all symbols, ``(steps, lanes)``; a place is -1 beyond the end."""
        t = 0
        while t < (self.length[0] if len(self.length) else 0):
            active = int(np.searchsorted(-self.length, -t, "left"))  # lengths above t
            wide = steps or max(16, SCORE_TOKENS // active)
            wide = min(wide, int(self.length[0]) - t)
            time = np.arange(t, t + wide)[:, None]
            places = self.begin[:active] + time
            inside = time < self.length[:active]
            targets = self.symbols[np.where(inside, places, 0)]
            inputs = self.symbols[np.where(inside, places, 1) - 1]  # a lane's first is set below
            if t == 0:
                inputs[0] = self.first_input
            yield inputs, targets, np.where(inside, places, -1)
            t += wide


def lanes(symbols: np.ndarray, begin: np.ndarray, length: np.ndarray, width: int, first_input: int) -> Iterator[Lanes]:
    """Groups of ``width`` texts, longest texts first; texts without symbols are left out."""
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    for k in range(0, len(order), width):
        own = order[k : k + width]
        yield Lanes(symbols, begin[own], length[own], first_input)


def score(network: Network, symbols: np.ndarray, begin: np.ndarray, length: np.ndarray, first_input: int) -> np.ndarray:
    """Natural logarithm of each symbol's probability after all that precede it in its text; the
    state goes on from window to window until the text ends."""
    out, hidden, room = np.zeros(len(symbols)), network.hidden, Rooms()
    by_input, by_state = network.by_gate("inputs"), network.by_gate("states")
    with np.errstate(over="ignore"):
        for group in lanes(symbols, begin, length, SCORE_LANES, first_input):
            state = np.zeros((len(group.length), hidden), np.float32)
            for inputs, targets, places in group.windows():
                wide = inputs.shape[1]
                states = room("states", *inputs.shape, hidden)
                given, gates = room("given", 3, wide, hidden), room("gates", 3, wide, hidden)
                candidate, before = room("candidate", wide, hidden), state[:wide]
                for t, now in enumerate(inputs):
                    by_input.take(now, axis=1, out=given, mode="clip")
                    _step(before, given, by_state, gates, candidate, states[t])
                    before = states[t]
                state = before.copy()  # its room is needed again
                inside = places >= 0
                if inside.all():
                    found = network.log_probability(states.reshape(-1, hidden), targets.ravel(), room)
                    out[places] = found.reshape(places.shape)
                else:
                    out[places[inside]] = network.log_probability(states[inside], targets[inside], room)
    return out


class Trainer:
    """Truncated backpropagation: windows of ``steps``, across which states go on and gradients don't."""

    def __init__(self, network: Network, *, steps: int, rate: float):
        self.network, self.steps, self.rate = Network(network.edges, {k: w.copy() for k, w in network.weights.items()}), steps, rate
        self.first = {k: np.zeros_like(w) for k, w in network.weights.items()}
        self.second = {k: np.zeros_like(w) for k, w in network.weights.items()}
        self.gradients = {k: np.zeros_like(w) for k, w in network.weights.items()}
        self.roots = {k: np.empty_like(w) for k, w in network.weights.items()}
        self.room = Rooms()
        self.updates = 0

    def train(self, group: Lanes) -> None:
        state = np.zeros((len(group.length), self.network.hidden), np.float32)
        with np.errstate(over="ignore"):
            for inputs, targets, places in group.windows(self.steps):
                state = self._window(state[: inputs.shape[1]], inputs, targets, places >= 0)

    def _window(self, state: np.ndarray, inputs: np.ndarray, targets: np.ndarray, inside: np.ndarray) -> np.ndarray:
        network, hidden, room = self.network, self.network.hidden, self.room
        shape, wide = (*inputs.shape, hidden), (*inputs.shape, 3 * hidden)
        given = room("given", 3, *shape)
        network.by_gate("inputs").take(inputs, axis=1, out=given, mode="clip")
        gates, candidate, line = room("gates", 3, *shape), room("candidate", *shape), room("line", len(inputs) + 1, *shape[1:])
        by_state = network.by_gate("states")
        line[0] = state
        for t in range(len(inputs)):
            _step(line[t], given[:, t], by_state, gates[:, t], candidate[t], line[t + 1])
        before, states, (reset, update, own) = line[:-1], line[1:], gates
        gradients = self.gradients
        for g in gradients.values():
            g.fill(0)
        if inside.all():
            _, by_state = network.log_probability(states.reshape(-1, hidden), targets.ravel(), room, gradients)
            by_state = by_state.reshape(shape)
        else:
            by_state = room("by_state", *shape)
            by_state.fill(0)
            _, by_state[inside] = network.log_probability(states[inside], targets[inside], room, gradients)

        # What a change of the new state means for the candidate, and of both for the gates.
        to_candidate, to_reset, to_update, spare = (
            room(name, *shape) for name in ("to_candidate", "to_reset", "to_update", "spare")
        )
        np.multiply(candidate, candidate, out=to_candidate)
        np.subtract(1, to_candidate, out=to_candidate)
        to_candidate *= np.subtract(1, update, out=spare)
        np.multiply(own, reset, out=to_reset)
        to_reset *= np.subtract(1, reset, out=spare)
        np.subtract(before, candidate, out=to_update)
        to_update *= update
        to_update *= np.subtract(1, update, out=spare)
        by_inputs, by_carried = room("by_inputs", *wide), room("by_carried", *wide)
        carry, back = np.zeros(shape[1:], np.float32), network.weights["states"].T.copy()
        for t in reversed(range(len(inputs))):
            carry += by_state[t]
            by_candidate = by_inputs[t, :, 2 * hidden :]
            np.multiply(carry, to_candidate[t], out=by_candidate)
            np.multiply(by_candidate, to_reset[t], out=by_inputs[t, :, :hidden])
            np.multiply(carry, to_update[t], out=by_inputs[t, :, hidden : 2 * hidden])
            by_carried[t, :, : 2 * hidden] = by_inputs[t, :, : 2 * hidden]
            np.multiply(by_candidate, reset[t], out=by_carried[t, :, 2 * hidden :])
            carry *= update[t]
            carry += np.matmul(by_carried[t], back, out=spare[t])
        flat = by_carried.reshape(-1, 3 * hidden)
        gradients["states"] += before.reshape(-1, hidden).T @ flat
        # What was given is no longer needed.
        add_by_symbol(inputs.ravel(), by_inputs.reshape(-1, 3 * hidden), gradients["inputs"], given.reshape(-1, 3 * hidden))
        self._update(gradients)
        return states[-1].copy()  # its room is needed again

    def _update(self, gradients: dict[str, np.ndarray]) -> None:
        """Steps by the running means of gradients and of their squares."""
        self.updates += 1
        rate = self.rate * (1 - BETA_2**self.updates) ** 0.5 / (1 - BETA_1**self.updates)
        for k, g in gradients.items():
            first, second = self.first[k], self.second[k]
            g *= 1 - BETA_1
            first *= BETA_1
            first += g
            g *= g
            g *= (1 - BETA_2) / (1 - BETA_1) ** 2
            second *= BETA_2
            second += g
            root = np.sqrt(second, out=self.roots[k])
            root += TINY
            np.divide(first, root, out=root)
            root *= np.float32(rate)
            self.network.weights[k] -= root
