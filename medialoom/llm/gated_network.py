"""A gated recurrent network over word codes with a class-factored softmax, in numpy.

A word is one of ``CLASSES`` classes and one of ``SLOTS`` places in it; its code is
``class * SLOTS + place``.  With the state h and the code x of the word before,

    (f, z) = tanh(E[x] + h U),  f' = (1 + f) / 2,  h = f' h + (1 - f') z,
    P(word | h) = softmax(h Wc + bc)[class] * softmax(h Ws[class] + bs[class])[place],

so the state enters its own gate and candidate, and both softmaxes.  The state is zero
at the start of a document and carried through it whole.  Documents are laid end to end
in lanes; training is back-propagation through windows of ``STEPS`` words, the state
carried from window to window.  In training alone a lane may start inside a document.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

CLASSES, SLOTS, HIDDEN = 32, 32, 16
CODES = CLASSES * SLOTS
STEPS, LANES, RATE = 32, 256, 0.1
_SHAPES = {"E": (CODES, 2 * HIDDEN), "U": (HIDDEN, 2 * HIDDEN), "Wc": (HIDDEN, CLASSES), "bc": (CLASSES,), "Ws": (CLASSES, HIDDEN, SLOTS), "bs": (CLASSES, SLOTS)}
SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())


def start(mass: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters before training, with the probabilities of ``mass`` by code; codes without mass are as good as excluded."""
    r = np.random.default_rng(7)
    p = {k: r.normal(0, 0.3 if k in "EU" else 0.02, s).astype(np.float32) for k, s in _SHAPES.items()}
    share = np.maximum(mass.reshape(CLASSES, SLOTS), 1e-12)
    of_class = share.sum(axis=1)
    p["bc"] = np.log(of_class / of_class.sum()).astype(np.float32)
    p["bs"] = np.log(share / of_class[:, None]).astype(np.float32)
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in _SHAPES])


def unflat(v: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in _SHAPES.items():
        n = int(np.prod(s))
        out[k] = np.asarray(v[at : at + n], dtype=np.float32).reshape(s)
        at += n
    return out


def lanes(docs: list[np.ndarray], most: int = LANES) -> Iterator[list[int]]:
    """Documents dealt to at most ``most`` lanes of like length, the longest first."""
    free = [(0, k) for k in range(most)]
    held: list[list[int]] = [[] for _ in range(most)]
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        n, k = heapq.heappop(free)
        held[k].append(i)
        heapq.heappush(free, (n + len(docs[i]), k))
    return (x for x in held if x)


def windows(docs: list[np.ndarray], end: int) -> Iterator[tuple]:
    """(codes before, codes, document of each place, columns still in use) of each window; longest lanes first."""
    dealt = sorted(lanes(docs), key=lambda x: -sum(len(docs[i]) for i in x))
    size = np.array([sum(len(docs[i]) for i in x) for x in dealt])
    if not len(size):
        return
    x = np.full((int(size[0]) + 1, len(dealt)), end, dtype=np.int64)  # a text starts after an end
    doc = np.full(x.shape, -1, dtype=np.int64)
    for j, some in enumerate(dealt):
        x[1 : size[j] + 1, j] = np.concatenate([docs[i] for i in some])
        doc[1 : size[j] + 1, j] = np.repeat(some, [len(docs[i]) for i in some])
    for t in range(0, int(size[0]), STEPS):
        live, stop = int((size > t).sum()), min(t + STEPS, int(size[0]))
        yield x[t:stop, :live], x[t + 1 : stop + 1, :live], doc[t + 1 : stop + 1, :live], live


def recur(p, before: np.ndarray, state: np.ndarray, end: int):
    """Activations, states and the last state of a window."""
    a = p["E"][before]
    hs = np.empty((*before.shape, HIDDEN), dtype=np.float32)
    goes_on = (before != end)[:, :, None].astype(np.float32)
    olds = np.empty_like(hs)
    h = state
    for t in range(len(before)):
        np.multiply(h, goes_on[t], out=olds[t])
        x = a[t]
        x += olds[t] @ p["U"]
        np.tanh(x, out=x)
        z = x[:, HIDDEN:]
        keep = 0.5 + 0.5 * x[:, :HIDDEN]
        h = np.add(z, keep * (olds[t] - z), out=hs[t])
    return a, olds, hs, h


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return x


def outputs(p, h: np.ndarray, want: np.ndarray):
    """Log-probabilities of classes, and of places inside the wanted class; rows sorted by class.

    Returns (order, starts of classes, states in that order, class rows, place rows).
    """
    cls = (want // SLOTS).astype(np.uint16)  # sorted by radix
    order = np.argsort(cls, kind="stable")
    cut = np.searchsorted(cls[order], np.arange(CLASSES + 1))
    hs = h[order]
    of_class = _log_softmax(hs @ p["Wc"] + p["bc"])
    inside = np.empty((len(hs), SLOTS), dtype=np.float32)
    for c in np.flatnonzero(np.diff(cut)).tolist():
        a, b = cut[c], cut[c + 1]
        np.matmul(hs[a:b], p["Ws"][c], out=inside[a:b])
        inside[a:b] += p["bs"][c]
    return order, cut, hs, of_class, _log_softmax(inside)


class Trainer:
    """Adagrad on one replica."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = {k: v.copy() for k, v in p.items()}
        self.sum = {k: np.full_like(v, 1e-6) for k, v in p.items()}
        self.tokens = self.steps = 0

    def learn(self, docs: list[np.ndarray], end: int) -> None:
        """The documents as one stream, cut into ``LANES`` lanes of one length, so that every window is full."""
        stream = np.concatenate([np.full(1, end, dtype=np.int64), *docs])
        n = len(stream) - 1
        wide = max(1, min(LANES, n // STEPS))
        long = -(-n // wide)
        at = np.minimum(np.arange(wide) * long + np.arange(long)[:, None], n)  # places in the stream by time and lane
        state = np.zeros((wide, HIDDEN), dtype=np.float32)
        for t in range(0, long, STEPS):
            here = at[t : t + STEPS]
            state = self.step(stream[here], stream[np.minimum(here + 1, n)], here < n, state, end)

    def gradient(self, before, want, real, state, end):
        p = self.p
        a, olds, hs, last = recur(p, before, state, end)
        real = np.flatnonzero(real)
        code = want.ravel()[real]
        order, cut, h, of_class, inside = outputs(p, hs.reshape(-1, HIDDEN)[real], code)
        rows, code, n = np.arange(len(real)), code[order], np.float32(1 / len(real))
        d_class, d_inside = np.exp(of_class), np.exp(inside)
        d_class[rows, code // SLOTS] -= 1
        d_inside[rows, code % SLOTS] -= 1
        d_class *= n
        d_inside *= n
        g = {"Wc": h.T @ d_class, "bc": d_class.sum(axis=0), "Ws": np.zeros_like(p["Ws"]), "bs": np.zeros_like(p["bs"])}
        back = d_class @ p["Wc"].T
        for c in np.flatnonzero(np.diff(cut)).tolist():
            s = slice(cut[c], cut[c + 1])
            g["Ws"][c] = h[s].T @ d_inside[s]
            g["bs"][c] = d_inside[s].sum(axis=0)
            back[s] += d_inside[s] @ p["Ws"][c].T
        d_h = np.zeros((hs.shape[0] * hs.shape[1], HIDDEN), dtype=np.float32)
        d_h[real[order]] = back
        d_h = d_h.reshape(hs.shape)
        d_a, carry, across = np.empty_like(a), np.zeros_like(state), np.ascontiguousarray(p["U"].T)
        goes_on = (before != end)[:, :, None].astype(np.float32)
        for t in range(len(before) - 1, -1, -1):
            x, d = a[t], d_a[t]
            grad = d_h[t] + carry
            keep = 0.5 + 0.5 * x[:, :HIDDEN]
            np.multiply(grad, 0.5 * (olds[t] - x[:, HIDDEN:]), out=d[:, :HIDDEN])
            np.multiply(grad, 1 - keep, out=d[:, HIDDEN:])
            d *= 1 - x * x
            carry = (grad * keep + d @ across) * goes_on[t]
        d_a = d_a.reshape(-1, 2 * HIDDEN)
        g["U"] = olds.reshape(-1, HIDDEN).T @ d_a
        code = before.ravel().astype(np.uint16)
        o = np.argsort(code, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(code[o]) != 0]))
        seen, rows = code[o][first], np.add.reduceat(d_a[o], first, axis=0)
        return g, seen, rows, last

    def step(self, before, want, real, state, end):
        g, seen, rows, last = self.gradient(before, want, real, state, end)
        self.steps += 1
        rate = np.float32(RATE * min(1.0, self.steps / 10))
        for k, x in g.items():
            self.sum[k] += x * x
            self.p[k] -= rate * x / np.sqrt(self.sum[k])
        self.sum["E"][seen] += rows * rows
        self.p["E"][seen] -= rate * rows / np.sqrt(self.sum["E"][seen])
        self.tokens += int(real.sum())
        return last


def log_likelihood(p, docs: list[np.ndarray], end: int) -> np.ndarray:
    """Natural-log probability of each document's codes."""
    out, state = np.zeros(len(docs)), np.zeros((LANES, HIDDEN), dtype=np.float32)
    for before, want, doc, live in windows(docs, end):
        _, _, hs, state = recur(p, before, state[:live], end)
        real = np.flatnonzero(doc.ravel() >= 0)
        code = want.ravel()[real]
        order, _, _, of_class, inside = outputs(p, hs.reshape(-1, HIDDEN)[real], code)
        rows, code = np.arange(len(real)), code[order]
        got = of_class[rows, code // SLOTS].astype(np.float64) + inside[rows, code % SLOTS]
        out += np.bincount(doc.ravel()[real[order]], weights=got, minlength=len(docs))
    return out
