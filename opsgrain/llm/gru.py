"""A small bidirectional gated recurrent network over bytes, in numpy: training by backpropagation through time, and labelling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Bytes of a window, states per direction, windows that run side by side.
WINDOW, STATES, SIDE = 128, 8, 4096
#: The input that fills the last window of a text.
PAD = 256
#: Bytes of text that are cut into windows at a time.
HELD = 8 << 20


@dataclass
class Direction:
    """Gates in the order update, reset, candidate: input weights (3H, 257), state weights (3H, H)."""

    inputs: np.ndarray
    states: np.ndarray

    def step(self, codes: np.ndarray, h: np.ndarray):
        """One position of all windows; the gates come back for the backward pass."""
        n = len(h)
        x, g = np.take(self.inputs, codes, axis=1), self.states @ h
        gates = x[: 2 * n]
        gates += g[: 2 * n]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates += 1.0
        gates *= 0.5  # the logistic function
        new = gates[n:] * g[2 * n :]
        new += x[2 * n :]
        np.tanh(new, out=new)
        out = h - new
        out *= gates[:n]
        out += new
        return out, gates, new, g[2 * n :]


@dataclass
class Network:
    labels: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # (labels, 2H)
    bias: np.ndarray  # (labels, 1)

    def parameters(self) -> list[np.ndarray]:
        return [self.forward.inputs, self.forward.states, self.backward.inputs, self.backward.states, self.out, self.bias]

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities (window bytes, labels, windows) of each position; ``codes``: (window bytes, windows)."""
        n, (time, side) = len(self.forward.states[0]), codes.shape
        h, seen = np.zeros((n, side), np.float32), np.empty((time, n, side), np.float32)
        for t in range(time):
            h = self.forward.step(codes[t], h)[0]
            seen[t] = h
        left, right = self.out[:, :n], self.out[:, n:]
        h, logits = np.zeros((n, side), np.float32), np.empty((time, len(self.labels), side), np.float32)
        for t in reversed(range(time)):
            h = self.backward.step(codes[t], h)[0]
            np.add(left @ seen[t], right @ h, out=logits[t])
        logits += self.bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def pooled(self, texts: Sequence[bytes]) -> np.ndarray:
        """Mean probabilities (texts, labels) over all positions of each text; zeros for an empty one."""
        out = np.zeros((len(texts), len(self.labels)))
        group: list[int] = []
        held = 0
        for i, text in enumerate(texts):
            group.append(i)
            held += len(text)
            if held >= HELD or i == len(texts) - 1:
                out[group] = self._pooled([texts[k] for k in group])
                group, held = [], 0
        return out

    def _pooled(self, texts: Sequence[bytes]) -> np.ndarray:
        codes, owner = windows(texts)
        total = np.zeros((len(texts), len(self.labels)))
        for at in range(0, len(codes), SIDE):
            part = np.ascontiguousarray(codes[at : at + SIDE].T)
            chances = self.positions(part)
            chances *= (part != PAD)[:, None, :]
            np.add.at(total, owner[at : at + SIDE], chances.sum(axis=0).T)
        return total / np.maximum(1, [[len(t)] for t in texts])

    def label_positions(self, text: bytes) -> list[str]:
        """The label of every byte."""
        codes, _ = windows([text])
        if not len(codes):
            return []
        best = self.positions(np.ascontiguousarray(codes.T)).argmax(axis=1)
        return [self.labels[k] for k in best.T.ravel()[: len(text)]]


def windows(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows, window bytes) of codes, the last of a text filled with PAD, and the text of each window."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], dtype=np.int64)
    codes = np.full((int(counts.sum()), WINDOW), PAD, dtype=np.int16)
    flat, at = codes.ravel(), 0
    for text, n in zip(texts, counts):
        flat[at : at + len(text)] = np.frombuffer(text, dtype=np.uint8)
        at += int(n) * WINDOW
    return codes, np.repeat(np.arange(len(texts)), counts)


def _start(labels: list[str], rng: np.random.Generator) -> Network:
    def direction() -> Direction:
        return Direction(
            rng.normal(0, 0.3, (3 * STATES, PAD + 1)).astype(np.float32), rng.normal(0, STATES**-0.5, (3 * STATES, STATES)).astype(np.float32)
        )

    out = rng.normal(0, 0.3, (len(labels), 2 * STATES)).astype(np.float32)
    return Network(labels, direction(), direction(), out, np.zeros((len(labels), 1), np.float32))


def _through_time(way: Direction, codes: np.ndarray, order: list[int], dh_at: np.ndarray, tape: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of a direction; ``dh_at``: gradient of each position's state, ``tape``: what its steps returned."""
    n = STATES
    d_in, d_st = np.zeros_like(way.inputs).T.copy(), np.zeros_like(way.states)
    dh = np.zeros_like(dh_at[0])
    for k in reversed(range(len(order))):
        t = order[k]
        before, (gates, new, gh) = tape[k]
        dh = dh + dh_at[t]
        z, r = gates[:n], gates[n:]
        d_new = dh * (1 - z) * (1 - new * new)
        d_z = dh * (before - new) * z * (1 - z)
        d_r = d_new * gh * r * (1 - r)
        d_x = np.concatenate([d_z, d_r, d_new])
        d_g = np.concatenate([d_z, d_r, d_new * r])
        d_st += d_g @ before.T
        np.add.at(d_in, codes[t], d_x.T)
        dh = dh * z + way.states.T @ d_g
    return d_in.T, d_st


def gradients(net: Network, codes: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy per position, and its gradients, by backpropagation through time; ``codes``: (bytes, windows)."""
    time, side = codes.shape
    real = (codes != PAD).astype(np.float32)
    states, tapes, orders = [], [], [list(range(time)), list(reversed(range(time)))]
    for way, order in zip((net.forward, net.backward), orders):
        h, seen, tape = np.zeros((STATES, side), np.float32), np.empty((time, STATES, side), np.float32), []
        for t in order:
            before = h
            h, *kept = way.step(codes[t], before)
            tape.append((before, kept))
            seen[t] = h
        states.append(seen)
        tapes.append(tape)
    both = np.concatenate(states, axis=1)
    logits = net.out @ both + net.bias
    logits -= logits.max(axis=1, keepdims=True)
    chances = np.exp(logits)
    chances /= chances.sum(axis=1, keepdims=True)
    wanted = chances[:, target, np.arange(side)]
    loss = float(-(np.log(wanted + 1e-12) * real).sum() / real.sum())
    chances[:, target, np.arange(side)] -= 1
    d = chances * (real / real.sum())[:, None, :]
    d_out = np.einsum("tls,tks->lk", d, both, optimize=True)
    d_both = net.out.T @ d
    grads = []
    for way, order, tape, part in zip((net.forward, net.backward), orders, tapes, (d_both[:, :STATES], d_both[:, STATES:])):
        grads += _through_time(way, codes, order, part, tape)
    return loss, [*grads, d_out, d.sum(axis=(0, 2))[:, None]]


def train(texts: Sequence[bytes], labels: Sequence[str], epochs: int = 8, side: int = 128, rate: float = 0.02, seed: int = 1) -> Network:
    """Fit on windows (each up to WINDOW bytes) of labelled texts with Adam; the same input gives the same network."""
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    net = _start(names, rng)
    codes, owner = windows(texts)
    target = np.array([names.index(x) for x in labels])[owner]
    params = net.parameters()
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    total = epochs * -(-len(codes) // side)
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for at in range(0, len(order), side):
            pick = order[at : at + side]
            _, grads = gradients(net, np.ascontiguousarray(codes[pick].T), target[pick])
            step += 1
            size = np.sqrt(sum(float((g * g).sum()) for g in grads))
            now = rate * (1 - step / (total + 1)) * (0.9**step * -1 + 1)
            for p, g, m, v in zip(params, grads, first, second):
                g = (g / max(1.0, size)).astype(np.float32)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net
