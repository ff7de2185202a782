"""A small causal self-attention model in numpy: one head over subword ids, trained by Adam.

Because attention reads the inputs themselves, queries, keys, values and the residual are tables by
input id, kept side by side in one. A position attends to itself and to what stands before it in its
window; the output is a distribution over classes of what comes next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH, CONTEXT, SCORED = 16, 8, 24
WINDOW = CONTEXT + SCORED
QUERY, KEY, VALUE, REST = (slice(k * WIDTH, (k + 1) * WIDTH) for k in range(4))
HIDDEN, MOST = np.float32(-1e9), np.float32(50)
ROWS, STEP = 128, 1024  # windows, and rows of logits, at once: few calls, and what is worked on stays in cache

_BACK = (np.arange(CONTEXT, WINDOW)[:, None] - np.arange(WINDOW)[None]).clip(0)
_AHEAD = np.arange(WINDOW)[None] > np.arange(CONTEXT, WINDOW)[:, None]


def initial(inputs: int, prior: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights by name; before training the output is near the prior, whatever the input."""
    rng = np.random.default_rng(seed)
    made = {"table": rng.normal(0, 0.3, (inputs, 4 * WIDTH)), "near": -0.1 * np.arange(WINDOW), "w": np.r_[rng.normal(0, 0.03, (WIDTH, len(prior))), np.log(np.maximum(prior, 1e-9))[None]]}
    return {n: x.astype(np.float32) for n, x in made.items()}


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into the joined sequences of these sizes, or -1; whether a scored position is real).

    Windows overlap by CONTEXT positions, so that each position is scored once.
    """
    sizes = np.asarray(sizes, np.int64)
    times = -(-sizes // SCORED)
    owner = np.repeat(np.arange(len(sizes)), times)
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    local = nth[:, None] * SCORED + np.arange(-CONTEXT, SCORED)[None]
    ok = (local >= 0) & (local < sizes[owner][:, None])
    index = np.where(ok, local + (np.cumsum(sizes) - sizes)[owner][:, None], -1)
    return index, ok[:, CONTEXT:]


def _norm(x: np.ndarray) -> float:
    return float(np.sqrt(np.einsum("...i,...i->...", x, x).max(initial=0)))


def attend(p: dict[str, np.ndarray], ids: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hidden, attention powers, 1 / their sums, what they read, scaled queries, table rows) for windows
    of input ids; real: which positions hold an input.

    Scores aren't shifted by their maximum, and sums are products with ones: both far cheaper over short
    rows. Where the norms don't rule out large values, they are held within MOST. Powers stay undivided;
    only what they read is divided by their sum.
    """
    rows = np.take(p["table"], ids, axis=0)
    q, k = rows[:, CONTEXT:, QUERY] * np.float32(WIDTH**-0.5), rows[:, :, KEY]
    scores = q @ k.transpose(0, 2, 1)
    if _norm(q) * _norm(k) > MOST:
        np.minimum(scores, MOST, out=scores)
    scores += np.where(_AHEAD, HIDDEN, np.minimum(p["near"], MOST / 2)[_BACK])
    some = np.flatnonzero(~real.all(1))
    scores[some] += np.where(real[some], np.float32(0), HIDDEN)[:, None]
    powers = np.exp(scores, out=scores)
    each = 1 / np.maximum(powers @ np.ones(WINDOW, powers.dtype), np.float32(1e-30))[:, :, None]
    read = (powers @ rows[:, :, VALUE]) * each
    hidden = np.ones((read.shape[0] * SCORED, WIDTH + 1), read.dtype)  # the last is for the biases
    np.add(read, rows[:, CONTEXT:, REST], out=hidden.reshape(-1, SCORED, WIDTH + 1)[:, :, :WIDTH])
    return hidden, powers, each, read, q, rows


def weighed(p: dict[str, np.ndarray], hidden: np.ndarray, goal: np.ndarray, sides: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(which rows, their goals' logits, the powers of all their logits, the goals' places among these, the powers' products with
    sides) of hidden, STEP rows at once; the powers overwrite those before, so that they stay in cache. The first of the sides is ones.

    Logits aren't shifted by their maximum either. They are held within MOST where a sum of powers tells that one may be over it;
    holding all of them takes as long as the product that makes them.
    """
    w, kind = p["w"], np.result_type(hidden, p["w"])
    held, sides, limit = np.empty((min(STEP, len(hidden)), w.shape[1]), kind), sides.astype(kind), np.exp(kind.type(MOST))
    places, flat = np.arange(len(held)) * w.shape[1], held.ravel()
    for a in range(0, len(hidden), STEP):
        own = slice(a, min(a + STEP, len(hidden)))
        out = np.matmul(hidden[own], w, out=held[: own.stop - a])
        at = places[: len(out)] + goal[own]
        told = flat[at]
        with np.errstate(over="ignore", invalid="ignore"):
            sums = np.exp(out, out=out) @ sides
        if not sums[:, 0].max() <= limit:  # nor is what isn't a number
            np.minimum(np.matmul(hidden[own], w, out=out), MOST, out=out)
            told = flat[at]
            sums = np.exp(out, out=out) @ sides
        yield own, told, out, at, sums


def forward(p: dict[str, np.ndarray], ids: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, ...]:
    """The logits of all scored positions of windows, in front of what attend gives."""
    told = attend(p, ids, real)
    return np.minimum(told[0] @ p["w"], MOST), *told


def score(p: dict[str, np.ndarray], inputs: np.ndarray, classes: np.ndarray, sizes: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two log10 probabilities of each position of the joined sequences of these sizes.

    leads tells which classes begin a word. The first is that of the target class, among the classes
    that begin a word if it is one of them; the second that a word begins there, or 0 within a word.
    """
    index, scored = windows(sizes)
    own, begins = np.empty(len(inputs)), np.zeros(len(inputs))
    both = np.stack([np.ones(len(leads)), leads], 1).astype(np.float32)
    for a in range(0, len(index), ROWS):
        at = index[a : a + ROWS]
        real = scored[a : a + ROWS].ravel()
        place = at[:, CONTEXT:].ravel()[real]
        goal = classes[place]
        told, sums = np.empty(len(place)), np.empty((len(place), 2), np.float32)
        for part, own_told, _, _, own_sums in weighed(p, attend(p, inputs[at], at >= 0)[0][real], goal, both):
            told[part], sums[part] = own_told, own_sums
        sums = np.log(np.maximum(sums, np.float32(1e-30)))
        first = leads[goal]
        own[place] = told - np.where(first, sums[:, 1], sums[:, 0])
        begins[place] = np.where(first, sums[:, 1] - sums[:, 0], 0)
    return own / np.log(10), begins / np.log(10)


def gradient(p: dict[str, np.ndarray], ids: np.ndarray, real: np.ndarray, goal: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
    """(mean loss, gradient of the weights, the table rows that its part of the table stands for) over the
    scored positions of windows; goal is -1 where there is none."""
    hidden, powers, each, read, q, rows = attend(p, ids, real)
    own = np.flatnonzero(goal.ravel() >= 0)
    goal, n, loss = goal.ravel()[own], max(1, len(own)), 0.0
    kept = hidden if len(own) == len(hidden) else hidden[own]
    d, gh = {"w": np.zeros_like(p["w"])}, np.zeros((len(hidden), WIDTH), read.dtype)
    inner, back = np.ascontiguousarray(kept[:, :WIDTH]), np.ascontiguousarray(p["w"][:WIDTH].T)
    part_w = np.zeros_like(back)
    for part, told, g, at, whole in weighed(p, kept, goal, np.ones((p["w"].shape[1], 1))):
        loss += np.log(whole).sum(dtype=float) - told.sum(dtype=float)
        g.ravel()[at] -= whole[:, 0]  # g is that of the logits, times whole and n
        scale = (1 / (whole * n)).astype(read.dtype)
        part_w += g.T @ (inner[part] * scale)
        d["w"][WIDTH] += scale[:, 0] @ g
        gh[own[part]] = (g @ back) * scale
    d["w"][:WIDTH] = part_w.T
    gh = gh.reshape(read.shape)
    k, v = rows[:, :, KEY], rows[:, :, VALUE]
    ghz = gh * each
    gs = ghz @ v.transpose(0, 2, 1)
    gs -= np.einsum("ijk,ijk->ij", ghz, read)[:, :, None]
    gs *= powers
    d["near"] = np.bincount(_BACK.ravel(), np.where(_AHEAD, 0, gs.sum(0)).ravel(), WINDOW).astype(read.dtype)
    out = np.empty_like(rows)
    out[:, :CONTEXT] = 0
    np.matmul(gs, k, out=out[:, CONTEXT:, QUERY])
    out[:, CONTEXT:, QUERY] *= np.float32(WIDTH**-0.5)
    np.matmul(gs.transpose(0, 2, 1), q, out=out[:, :, KEY])
    np.matmul(powers.transpose(0, 2, 1), ghz, out=out[:, :, VALUE])
    out[:, CONTEXT:, REST] = gh
    at, d["table"] = summed(ids.ravel(), out.reshape(-1, out.shape[2]))
    return loss / n, d, at


def summed(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct row numbers, the sums of their rows), of an even width. Two numbers are added at once, as a complex one."""
    if len(at) and at.max() < 1 << 16:
        at = at.astype(np.uint16)  # sorted by digits
    order = np.argsort(at, kind="stable")
    own = at[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    both = np.take(rows, order, axis=0).view(np.result_type(rows, np.complex64))
    return own[starts].astype(np.int64), np.add.reduceat(both, starts, axis=0).view(rows.dtype)


class Adam:
    """Steps of the weights; of the table only the rows that a step reads are moved, and their moments with them."""

    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.02) -> None:
        self.p, self.rate, self.t = {n: x.copy() for n, x in p.items()}, rate, 0
        self.m, self.s = ({n: np.zeros_like(x) for n, x in p.items()} for _ in range(2))
        self.seen = np.zeros(len(p["table"]), bool)

    def step(self, d: dict[str, np.ndarray], at: np.ndarray) -> None:
        self.t += 1
        rate = np.float32(self.rate * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t))
        self.seen[at] = True
        for n, g in d.items():
            own = at if n == "table" else slice(None)
            m, s = self.m[n][own], self.s[n][own]
            m += np.float32(0.1) * (g - m)
            s += np.float32(0.01) * (g * g - s)
            if n == "table":
                self.m[n][own], self.s[n][own] = m, s
            self.p[n][own] -= rate * m / (np.sqrt(s) + np.float32(1e-6))
