"""A gated recurrent layer over symbols, in numpy: steps, backpropagation through time, Adam.

Arrays hold features by row and sequences by column, so that gates are contiguous. The
input weights are a table with one column per symbol (bias included). Rows of the table
and of the recurrent weights come in three blocks: update gate, reset gate, candidate.
"""

from __future__ import annotations

import numpy as np


def new_layer(rng: np.random.Generator, symbols: int, hidden: int) -> dict[str, np.ndarray]:
    return {
        "table": rng.normal(0, 0.3, (3 * hidden, symbols)).astype(np.float32),
        "back": rng.normal(0, 1 / np.sqrt(hidden), (3 * hidden, hidden)).astype(np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _step(layer, symbols: np.ndarray, state: np.ndarray):
    hidden = len(state)
    given = layer["table"].take(symbols, axis=1)
    recalled = layer["back"] @ state
    given[: 2 * hidden] += recalled[: 2 * hidden]
    gates = _sigmoid(given[: 2 * hidden])
    update, reset = gates[:hidden], gates[hidden:]
    inner = recalled[2 * hidden :]
    candidate = given[2 * hidden :]
    candidate += reset * inner
    np.tanh(candidate, out=candidate)
    return update, reset, candidate, inner


def states(layer, symbols: np.ndarray, state: np.ndarray, kept: np.ndarray | None = None) -> np.ndarray:
    """States after each step. symbols: steps x sequences; state: hidden x sequences; kept: 0 at
    steps x sequences that start from a new state, 1 elsewhere."""
    out = np.empty((len(symbols), *state.shape), np.float32)
    for t, row in enumerate(symbols):
        if kept is not None:
            state = state * kept[t]
        update, _, candidate, _ = _step(layer, row, state)
        new = out[t]
        np.subtract(state, candidate, out=new)
        new *= update
        new += candidate
        state = new
    return out


def states_and_tape(layer, symbols: np.ndarray, state: np.ndarray, kept: np.ndarray | None = None):
    """The same with what backpropagation needs."""
    out, tape = np.empty((len(symbols), *state.shape), np.float32), []
    for t, row in enumerate(symbols):
        if kept is not None:
            state = state * kept[t]
        update, reset, candidate, inner = _step(layer, row, state)
        tape.append((state, update, reset, candidate, inner))
        state = out[t] = candidate + update * (state - candidate)
    return out, tape


def gradients(layer, symbols: np.ndarray, tape, of_states: np.ndarray, kept: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Gradients of table and back, given those of the states after each step. kept: as there."""
    hidden = of_states.shape[1]
    back = layer["back"]
    of_back = np.zeros_like(back)
    of_given = np.empty((len(symbols), 3 * hidden, symbols.shape[1]), np.float32)
    later = 0.0
    for t in range(len(symbols) - 1, -1, -1):
        before, update, reset, candidate, inner = tape[t]
        now = of_states[t] + later
        of_candidate = now * (1 - update) * (1 - candidate * candidate)
        given = of_given[t]
        given[:hidden] = now * (before - candidate) * update * (1 - update)
        given[hidden : 2 * hidden] = of_candidate * inner * reset * (1 - reset)
        given[2 * hidden :] = of_candidate
        recalled = given.copy()
        recalled[2 * hidden :] *= reset
        of_back += recalled @ before.T
        later = now * update + back.T @ recalled
        if kept is not None:
            later *= kept[t]
    count = layer["table"].shape[1]
    flat = symbols.ravel()
    rows = of_given.transpose(1, 0, 2).reshape(3 * hidden, -1)
    of_table = np.stack([np.bincount(flat, row, count) for row in rows]).astype(np.float32)
    return {"table": of_table, "back": of_back}


class Adam:
    """Adam over a dictionary of arrays, changed in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.steps = weights, rate, 0
        self.mean = {k: np.zeros_like(w) for k, w in weights.items()}
        self.power = {k: np.zeros_like(w) for k, w in weights.items()}

    def step(self, grads: dict[str, np.ndarray], rate: float = 1.0) -> None:
        self.steps += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        shrink = min(1.0, 5.0 / (norm + 1e-9))
        rate *= self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for k, g in grads.items():
            g = g * shrink
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.power[k] += 0.001 * (g * g - self.power[k])
            self.weights[k] -= rate * self.mean[k] / (np.sqrt(self.power[k]) + 1e-8)
