"""A small causal self-attention model in numpy: one layer, relative positions, factored output.

Each id has an input vector of its own, and a class for the output: the most
frequent ids are classes of their own, the rest share classes by frequency, and within a class an id has its smoothed
share of the training counts after the group of the id before. So the probabilities of all ids sum to one, and a step costs a few hundred products.
The state before each id attends to the ids before it in its window; a window is CONTEXT ids that are only looked at and
SCORED ids that are scored, so each id is scored once, with at least CONTEXT ids before it where the text has them.
"""

from __future__ import annotations

import numpy as np

CONTEXT, SCORED = 8, 24
WIDTH = CONTEXT + SCORED
CLASSES, DIRECT, SIZE = 96, 72, 16
GROUPS, PRIOR = 128, 10.0
_F = np.float32

#: Which keys each query may see, and how far away each is.
_QUERY = np.arange(CONTEXT, WIDTH)
_KEY = np.arange(WIDTH)
_SEEN = (_KEY[None, :] <= _QUERY[:, None]).astype(_F)
_AWAY = np.clip(_QUERY[:, None] - _KEY[None, :], 0, WIDTH - 1)


def group_of(ids: np.ndarray) -> np.ndarray:
    """Fixed group of the id before: what a within-class share depends on besides the class."""
    return (ids.astype(np.int64) * 2654435761 % (1 << 32)) >> 25


class Vocabulary:
    """Symbols (the ids, and one more before the first id of a text), classes and within-class shares, from counts over the
    whole training corpus.

    `pairs[g, i]` counts id i after an id of group g. An id's share of its class given the group is drawn towards its
    share of the class by the weight of PRIOR occurrences.
    """

    def __init__(self, pairs: np.ndarray):
        counts = pairs.sum(0, dtype=np.float64)
        size = len(counts)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(size, np.int64)
        rank[order] = np.arange(size)
        self.symbol = np.arange(size, dtype=np.int32)
        rest = np.log(np.maximum(rank - DIRECT, 0) + 1.0) / np.log(max(2.0, size - DIRECT + 1.0))
        self.classes = np.where(rank < DIRECT, rank, DIRECT + np.minimum((rest * (CLASSES - DIRECT)).astype(np.int64), CLASSES - DIRECT - 1)).astype(np.int16)
        smooth = counts + 0.05
        total = np.bincount(self.classes, smooth, CLASSES)
        share = smooth / total[self.classes]
        self.class_log = np.log((total + 1) / (total + 1).sum()).astype(_F)
        self.log_share = np.empty(pairs.shape, _F)
        by_class = np.empty((len(pairs), CLASSES))
        for g, row in enumerate(pairs):
            by_class[g] = np.bincount(self.classes, row, CLASSES)
            self.log_share[g] = np.log((row + PRIOR * share) / (by_class[g] + PRIOR)[self.classes])
        self.start = self._start(by_class, size)

    def _start(self, by_class: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Input and output vectors that say how much likelier a class is after a group than elsewhere."""
        expected = np.outer(by_class.sum(1), by_class.sum(0)) / max(1.0, by_class.sum())
        odds = np.clip(np.log((by_class + 1) / (expected + 1)), -4, 4)
        left, weight, right = np.linalg.svd(odds, full_matrices=False)
        root = np.sqrt(weight[:SIZE])
        symbols = np.zeros((size + 1, SIZE), _F)
        symbols[:size] = (left[:, :SIZE] * root)[group_of(np.arange(size))]
        return symbols, (right[:SIZE] * root[:, None]).astype(_F)


def fresh(vocabulary: Vocabulary, seed: int = 1) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    normal = lambda *shape: (draw.normal(size=shape) / np.sqrt(shape[0])).astype(_F)
    before, after = vocabulary.start
    return {
        "embed": before + (draw.normal(size=before.shape) * 0.1).astype(_F), "query": normal(SIZE, SIZE) * _F(0.5), "key": normal(SIZE, SIZE) * _F(0.5), "value": normal(SIZE, SIZE),
        "away": np.linspace(0, -1, WIDTH).astype(_F), "out": np.concatenate([normal(SIZE, CLASSES) * _F(0.1), after]), "bias": vocabulary.class_log.copy(),
    }


def logits(p: dict[str, np.ndarray], symbols: np.ndarray) -> tuple[np.ndarray, dict]:
    """Unnormalised log probabilities of the next id's class at each scored place, and what `sparse_gradient` needs."""
    count, kind = len(symbols), p["out"].dtype
    x = p["embed"].take(symbols.ravel(), 0)
    query = p["query"] * kind.type(SIZE**-0.5)
    q, k, v = ((x @ w).reshape(count, WIDTH, SIZE) for w in (query, p["key"], p["value"]))
    q = q[:, CONTEXT:]
    weight = q @ k.transpose(0, 2, 1)
    np.clip(weight, -20, 20, out=weight)
    np.exp(weight, out=weight)
    weight *= np.exp(np.clip(p["away"], -20, 20))[_AWAY] * _SEEN
    total = (weight.reshape(-1, WIDTH) @ np.ones(WIDTH, kind)).reshape(count, SCORED, 1)
    # What was seen, the place's own vector, and 1 for the bias.
    state = np.ones((count, SCORED, 2 * SIZE + 1), kind)
    np.matmul(weight, v, out=state[:, :, :SIZE])
    state[:, :, :SIZE] /= total
    state[:, :, SIZE:-1] = x.reshape(count, WIDTH, SIZE)[:, CONTEXT:]
    after = np.concatenate([p["out"], p["bias"][None]])
    out = state.reshape(-1, 2 * SIZE + 1) @ after
    if max(state.max(), -state.min()) * np.abs(after).sum(0).max() > 60:  # else no logit can be beyond 60
        np.clip(out, -60, 60, out=out)  # far beyond what training reaches; keeps the exponentials finite
    return out, {"x": x, "query": query, "q": q, "k": k, "v": v, "weight": weight, "total": total, "state": state}


def forward(p: dict[str, np.ndarray], symbols: np.ndarray) -> tuple[np.ndarray, dict]:
    """Log probabilities (natural) of all classes at each scored place; and what `sparse_gradient` needs."""
    out, c = logits(p, symbols)
    out -= np.log(np.exp(out).sum(1, keepdims=True))
    return out, c


def gradient(p: dict[str, np.ndarray], symbols: np.ndarray, targets: np.ndarray, live: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Gradient of the mean negative log probability of `targets` (classes) where `live`, and that mean."""
    g, rows, values, _ = sparse_gradient(p, symbols, targets, live)
    g["embed"] = np.zeros_like(p["embed"])
    g["embed"][rows] = values
    log_p, _ = forward(p, symbols)
    chosen = log_p[np.arange(targets.size), targets.ravel()]
    return g, float(-(chosen * live.ravel()).sum() / max(1, int(live.sum())))


def sparse_gradient(p: dict[str, np.ndarray], symbols: np.ndarray, targets: np.ndarray, live: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The gradient alone, with that of "embed" apart: the symbols that occur, their rows, and how often each occurs."""
    odds, c = logits(p, symbols)
    count, kind, n = len(symbols), odds.dtype, max(1, int(live.sum()))
    np.exp(odds, out=odds)
    whole = odds @ np.ones(CLASSES, kind)
    # Each row of `odds` times its `scale` is the gradient of the logits; the narrow factors are scaled in its place.
    odds.reshape(-1)[np.arange(0, odds.size, CLASSES) + targets.ravel()] -= whole
    scale = (live.ravel() / (n * whole)).astype(kind)[:, None]
    state = c["state"].reshape(-1, 2 * SIZE + 1)
    d_out = (state * scale).T @ odds
    g = {"out": d_out[:-1], "bias": d_out[-1]}
    d_state = odds @ p["out"].T
    d_state *= scale
    d_state = d_state.reshape(count, SCORED, 2 * SIZE)
    # A weight's share of its row comes in as 1 / total; the mean over a row's shares is what was seen.
    d_seen = d_state[:, :, :SIZE] / c["total"]
    mean = (d_seen * c["state"][:, :, :SIZE]).reshape(-1, SIZE) @ np.ones(SIZE, kind)
    d_score = d_seen @ c["v"].transpose(0, 2, 1)
    d_score -= mean.reshape(count, SCORED, 1)
    d_score *= c["weight"]
    g["away"] = np.bincount(_AWAY.ravel(), d_score.sum(0).ravel(), WIDTH).astype(kind)
    d_q = (d_score @ c["k"]).reshape(-1, SIZE)
    d_k = (d_score.transpose(0, 2, 1) @ c["q"]).reshape(-1, SIZE)
    d_v = (c["weight"].transpose(0, 2, 1) @ d_seen).reshape(-1, SIZE)
    g["query"] = state[:, SIZE:-1].T @ d_q
    g["query"] *= kind.type(SIZE**-0.5)
    g["key"], g["value"] = c["x"].T @ d_k, c["x"].T @ d_v
    d_x = d_k @ p["key"].T
    d_x += d_v @ p["value"].T
    late = (d_q @ c["query"].T).reshape(count, SCORED, SIZE)
    late += d_state[:, :, SIZE:]
    d_x.reshape(count, WIDTH, SIZE)[:, CONTEXT:] += late
    return g, *_sum(symbols, d_x)


def _sum(symbols: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols that occur, the sum of the values of each, and how often each occurs."""
    flat = symbols.ravel()
    order = np.argsort(flat, kind="stable")
    ordered = flat.take(order)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    pairs = np.add.reduceat(values.view(np.result_type(values, np.complex64)).take(order, 0), first)  # two numbers at a time
    return ordered[first], pairs.view(values.dtype), np.diff(first, append=len(flat))


class Adam:
    """Rows of "embed" move, and their moments decay, only in steps in which their symbols occur."""

    def __init__(self, rate: float):
        self.rate, self.step, self.moments = rate, 0, []

    def update(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray], rows: np.ndarray, values: np.ndarray) -> None:
        self.step += 1
        rest = np.concatenate([d.ravel() for d in g.values()])
        if not self.moments:
            self.moments = [np.zeros((2, *p["embed"].shape), _F), np.zeros((2, rest.size), _F)]
        of_rows, of_rest = self.moments
        one, two = (np.concatenate([of_rows[i].take(rows, 0).ravel(), of_rest[i]]) for i in (0, 1))
        step, split = self._step(one, two, np.concatenate([values.ravel(), rest])), values.size
        for i, moment in enumerate((one, two)):
            of_rows[i][rows], of_rest[i] = moment[:split].reshape(values.shape), moment[split:]
        p["embed"][rows] = p["embed"].take(rows, 0) - step[:split].reshape(values.shape)
        for name, d in g.items():
            p[name] -= step[split : split + d.size].reshape(d.shape)
            split += d.size

    def _step(self, one: np.ndarray, two: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Moves the moments in place; how far the parameters go."""
        one *= _F(0.9)
        one += _F(0.1) * d
        two *= _F(0.99)
        two += _F(0.01) * d * d
        below = np.sqrt(two * _F(1 / (1 - 0.99**self.step)))
        below += _F(1e-8)
        return one * _F(self.rate / (1 - 0.9**self.step)) / below


def windows_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For texts whose ids begin at `starts` (of a flat array): the first scored id of each window, and its text."""
    count = np.diff(starts)
    each = -(-count // SCORED)
    text = np.repeat(np.arange(len(count)), each)
    return starts[text] + (np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)) * SCORED, text


def fill(flat: np.ndarray, starts: np.ndarray, first: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids in and before each window: the WIDTH + 1 ids from CONTEXT + 1 before `first` on; -1 outside the text."""
    at = first[:, None] + np.arange(-CONTEXT - 1, SCORED)[None, :]
    inside = (at >= starts[text][:, None]) & (at < starts[text + 1][:, None])
    return np.where(inside, flat[np.clip(at, 0, max(0, len(flat) - 1))], -1), inside


def model_inputs(symbol: np.ndarray, classes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, target classes and which targets exist, of filled windows."""
    symbols = np.where(ids[:, :-1] >= 0, symbol[ids[:, :-1]], len(symbol)).astype(np.min_scalar_type(len(symbol)))
    targets = ids[:, CONTEXT + 1 :]
    return symbols, classes[targets].astype(np.int64), targets >= 0


def score(p: dict[str, np.ndarray], vocabulary: Vocabulary, flat: np.ndarray, starts: np.ndarray, batch: int = 128) -> np.ndarray:
    """log10 probability of each text."""
    out = np.zeros(len(starts) - 1)
    first, text = windows_of(starts)
    each = np.empty(len(first))
    one = np.ones(CLASSES, p["out"].dtype)
    shares, size = vocabulary.log_share.reshape(-1), vocabulary.log_share.shape[1]
    for begin in range(0, len(first), 2048):
        block = slice(begin, begin + 2048)
        ids, _ = fill(flat, starts, first[block], text[block])
        symbols, classes, live = model_inputs(vocabulary.symbol, vocabulary.classes, ids)
        log_p = np.empty(live.shape, one.dtype)
        for i in range(0, len(ids), batch):
            found, _ = logits(p, symbols[i : i + batch])
            chosen = found[np.arange(len(found)), classes[i : i + batch].ravel()]
            np.exp(found, out=found)
            log_p[i : i + batch] = (chosen - np.log(found @ one)).reshape(-1, SCORED)
        log_p += shares[group_of(ids[:, CONTEXT:-1]) * size + ids[:, CONTEXT + 1 :]]
        each[block] = (log_p * live).sum(1, dtype=np.float64)
    np.add.at(out, text, each)
    return out / np.log(10)
