"""A linear-chain conditional random field in NumPy: training, Viterbi and forward-backward in batches.

Tokens are worked on by type: what a type contributes as the previous, current
or next token is computed once and kept, so a batch of texts costs three gathers
a token plus the chain itself. Sequences of a batch advance together, one step at
a time, longest first, so a step is one contiguous block without padding. A
sequence longer than BLOCK tokens is worked on in blocks side by side, which
changes no result: what enters and leaves each block is found first, from the
blocks' transfer matrices.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np

#: Token types that a worker keeps between batches.
MOST_TYPES = 200_000
#: Tokens of a sequence that are worked on one after the other.
BLOCK = 512
#: Tokens whose scores are summed at once, few enough to stay in a core's cache.
_STRIP = 2048


class Steps:
    """Time-major layout of sequences: block t holds token t of all sequences longer than t."""

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max(initial=0))
        active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
        self.bounds = np.concatenate([[0], np.cumsum(active)])
        heads = starts[order]
        self.index = np.concatenate([heads[:n] + t for t, n in enumerate(active)]) if longest else np.zeros(0, np.int64)
        self.order = order
        self.blocks = list(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist()))
        # token -> place in the layout
        self.place = np.empty(len(self.index), np.int64)
        self.place[self.index] = np.arange(len(self.index))


_NONE = np.zeros(0, np.int64)


def _rows(x: np.ndarray, steps: Steps) -> np.ndarray:
    """Scores at the ends of sequences, one row for each in the layout's order; one row may stand for all."""
    return np.broadcast_to(x, (len(steps.order), len(x))) if x.ndim == 1 else x[steps.order]


def _best_moves(delta: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each label (row) and sequence the best score over the label before, and that label."""
    if delta.shape[1] < 48:
        reach = delta.T[:, None, :] + trans.T
        at = reach.argmax(2)
        return np.take_along_axis(reach, at[:, :, None], 2)[:, :, 0].T, at.T
    best = delta[0] + trans[0][:, None]
    at = np.zeros(best.shape, np.int8)
    x, better = np.empty_like(best), np.empty(best.shape, bool)
    for k in range(1, len(trans)):
        np.add(delta[k], trans[k][:, None], out=x)
        np.greater(x, best, out=better)
        np.maximum(best, x, out=best)
        np.putmask(at, better, k)
    return best, at


def viterbi(scores: np.ndarray, steps: Steps, trans: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The best label of every token; ``scores`` in token order, ``start`` and ``end`` for all sequences or each."""
    n, width = scores.shape
    best = np.zeros(n, np.int8)
    if not n:
        return best
    # label-major: one label of all sequences lies together
    e = np.ascontiguousarray(scores[steps.index].T)
    back = np.zeros((width, n), np.int8)
    blocks, start, end = steps.blocks, _rows(start, steps).T.astype(e.dtype), _rows(end, steps).T.astype(e.dtype)
    last = []
    delta = e[:, slice(*blocks[0])] + start[:, : blocks[0][1]]
    for t, (a, b) in enumerate(blocks):
        if t:
            delta, back[:, a:b] = _best_moves(delta[:, : b - a], trans)
            delta = delta + e[:, a:b]
        nxt = blocks[t + 1][1] - blocks[t + 1][0] if t + 1 < len(blocks) else 0
        last.append((delta[:, nxt:] + end[:, nxt : b - a]).argmax(0) if nxt < b - a else _NONE)  # sequences that end here
    label = _NONE
    for t in range(len(blocks) - 1, -1, -1):
        a, b = blocks[t]
        if t + 1 < len(blocks):
            c, d = blocks[t + 1]
            label = back[label, np.arange(c, d)]
        if len(last[t]):
            label = np.concatenate([label, last[t]])
        best[a:b] = label
    return best[steps.place]


def forward_backward(scores: np.ndarray, steps: Steps, trans: np.ndarray, start: np.ndarray, end: np.ndarray, pairs: bool = False):
    """(posterior of every token, log likelihoods' sum, expected transitions or None)."""
    n, width = scores.shape
    if not n:
        return np.zeros((0, width), scores.dtype), 0.0, np.zeros((width, width))
    e = scores[steps.index]
    top = e.max(1, keepdims=True)
    e = np.exp(e - top)
    move = np.exp(trans).astype(e.dtype)
    blocks = steps.blocks
    first, final = np.exp(_rows(start, steps)).astype(e.dtype), np.exp(_rows(end, steps)).astype(e.dtype)
    alpha = np.empty_like(e)
    scale = np.empty((n, 1), e.dtype)
    last = None
    for t, (a, b) in enumerate(blocks):
        x = (first[: b - a] if last is None else last[: b - a] @ move) * e[a:b]
        s = x.sum(1, keepdims=True)
        scale[a:b] = s
        last = x / s
        alpha[a:b] = last
    beta = np.empty_like(e)
    nexts = np.zeros_like(e) if pairs else None
    total = float(np.log(scale.astype(np.float64)).sum() + top.astype(np.float64).sum())
    ahead = np.zeros((0, width), e.dtype)
    for t in range(len(blocks) - 1, -1, -1):
        a, b = blocks[t]
        k = len(ahead)
        beta[a : a + k] = ahead @ move.T
        if b - a > k:
            z = (alpha[a + k : b] * final[k : b - a]).sum(1)
            total += float(np.log(z.astype(np.float64)).sum())
            beta[a + k : b] = final[k : b - a] / z[:, None]
        if pairs:
            nexts[a : a + k] = ahead
        ahead = e[a:b] * beta[a:b] / scale[a:b]
    post = alpha * beta
    post /= post.sum(1, keepdims=True)
    # expected moves in one product, in strips that keep the sums exact enough
    expected = sum((alpha[i : i + 65536].T @ nexts[i : i + 65536] for i in range(0, n, 65536)), np.zeros((width, width))) if pairs else np.zeros((width, width))
    return post[steps.place], total, expected * np.exp(trans)


def _transfers(scores: np.ndarray, steps: Steps, trans: np.ndarray, best: bool) -> np.ndarray:
    """For each sequence the scores from every label of its first token to every label of its last, emissions included.

    The best path's score, or the logarithm of the paths' sum; each matrix up to a constant.
    """
    width = scores.shape[1]
    e = scores[steps.index]
    out = np.empty((len(steps.order), width, width), np.float64)
    apart = np.where(np.eye(width, dtype=bool), 0.0, -1e9 if best else -np.inf)
    move = trans.astype(np.float64) if best else np.exp(trans.astype(np.float64))
    state = None
    for t, (a, b) in enumerate(steps.blocks):
        if state is None:
            state = apart + e[a:b, None, :].astype(np.float64)
            top = state.max((1, 2), keepdims=True)
            state = state - top if best else np.exp(state - top)
        else:
            state = state[: b - a]
            if best:
                x = np.ascontiguousarray(state.reshape(-1, width).T)
                top = x[0] + move[0][:, None]
                for k in range(1, width):
                    np.maximum(top, x[k] + move[k][:, None], out=top)
                state = top.T.reshape(state.shape) + e[a:b, None, :]
                state -= state.max((1, 2), keepdims=True)
            else:
                state = (state @ move) * np.exp(e[a:b] - e[a:b].max(1, keepdims=True))[:, None, :]
                state /= state.max((1, 2), keepdims=True)
        nxt = steps.blocks[t + 1][1] - steps.blocks[t + 1][0] if t + 1 < len(steps.blocks) else 0
        out[steps.order[nxt : b - a]] = state[nxt:] if best else np.log(np.maximum(state[nxt:], 1e-300))
    return out


def in_blocks(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray, end: np.ndarray, best: bool, block: int = BLOCK) -> tuple[Steps, np.ndarray, np.ndarray]:
    """The sequences cut into blocks, with the scores that enter and leave each block: no result depends on the cuts."""
    lengths = np.asarray(lengths, np.int64)
    if lengths.max(initial=0) <= block:
        return Steps(lengths), start, end
    parts = -(-lengths // block)
    owner = np.repeat(np.arange(len(lengths)), parts)
    first = np.concatenate([[0], np.cumsum(parts)])
    nth = np.arange(len(owner)) - first[owner]
    sizes = np.minimum(block, lengths[owner] - nth * block)
    enter = np.repeat(start[None, :], len(owner), 0).astype(np.float64)
    leave = np.repeat(end[None, :], len(owner), 0).astype(np.float64)
    several = np.flatnonzero(parts[owner] > 1)
    ends = np.cumsum(sizes)
    token = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in several])
    matrix = dict(zip(several.tolist(), _transfers(scores[token], Steps(sizes[several]), trans, best)))

    def join(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        out = x.max(axis) if best else np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)
        return out - out.max()

    for s in np.flatnonzero(parts > 1):
        a, b = int(first[s]), int(first[s + 1])
        for i in range(a + 1, b):
            enter[i] = join(join(enter[i - 1][:, None] + matrix[i - 1], 0)[:, None] + trans, 0)
        for i in range(b - 2, a - 1, -1):
            leave[i] = join(trans + join(matrix[i + 1] + leave[i + 1][None, :], 1)[None, :], 1)
    return Steps(sizes), enter, leave


_models: dict[str, object] = {}


def fitted(rows: object, fit: Callable[[], CRF]) -> CRF:
    """A model fitted on ``rows`` in this process before, or now: equal rows give the same model."""
    key = hashlib.sha256(json.dumps(rows, ensure_ascii=False).encode()).hexdigest()
    if key not in _models:
        _models[key] = fit()
    return _models[key]


def minimise(f: Callable, x: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; ``f`` returns value and gradient."""
    value, g = f(x)
    hist: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        q = g.copy()
        marks = []
        for s, y, r in reversed(hist):
            a = r * (s @ q)
            q -= a * y
            marks.append(a)
        if hist:
            s, y, _ = hist[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.abs(g).sum() ** 0.5)
        for (s, y, r), a in zip(hist, reversed(marks)):
            q += (a - r * (y @ q)) * s
        slope = -(g @ q)
        if slope > -1e-12:
            break
        step = 1.0
        for _ in range(20):
            nx = x - step * q
            nv, ng = f(nx)
            if nv <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = nx - x, ng - g
        if s @ y > 1e-10:
            hist = [*hist, (s, y, 1.0 / (s @ y))][-memory:]
        done = value - nv < 1e-6 * max(1.0, abs(value))
        x, value, g = nx, nv, ng
        if done:
            break
    return x


class CRF:
    """``features(token)`` gives the features of a token; ``near(token)`` those it lends to its neighbours."""

    def __init__(self, labels: tuple[str, ...], features: Callable[[str], list[str]], near: Callable[[str], list[str]], reach: int = 1):
        self.labels, self.features, self.near, self.reach = labels, features, near, reach
        self.shifts = [0, *[k for r in range(1, reach + 1) for k in (-r, r)]]
        self._forget()

    def _forget(self) -> None:
        self.types: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.table = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("types", "rows", "table")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _names(self, token: str, shift: int) -> list[str]:
        return self.features(token) if shift == 0 else [f"{shift}{x}" for x in self.near(token)]

    def fit(self, sequences: list[list[str]], gold: list[list[int]], rounds: int = 60, l2: float = 0.3, least: int = 2) -> CRF:
        """Maximum likelihood with a Gaussian prior, over features that at least ``least`` tokens have."""
        types: dict[str, int] = {"": 0}
        ids = np.array([types.setdefault(t, len(types)) for s in sequences for t in s], np.int64)
        width = len(self.labels)
        named = {k: [list(dict.fromkeys(self._names(t, k))) for t in types] for k in self.shifts}
        often: Counter[str] = Counter()
        for times, *rows in zip(np.bincount(ids, minlength=len(types)).tolist(), *named.values()):
            for row in rows:
                for x in row:
                    often[x] += max(times, 1)
        vocabulary = {x: i for i, x in enumerate(x for x, n in often.items() if n >= least or x.endswith("edge"))}
        lists = {k: [[vocabulary[x] for x in row if x in vocabulary] for row in rows] for k, rows in named.items()}
        lengths = np.array([len(s) for s in sequences])
        steps = Steps(lengths)
        y = np.array([v for s in gold for v in s], np.int64)
        context = {k: self._shifted(ids, lengths, k, 0) for k in self.shifts}

        def groups(keys: np.ndarray) -> tuple[np.ndarray | None, np.ndarray, np.ndarray]:
            """How to sum rows by key: the order to take them in, where groups start, their keys."""
            order = None if np.all(keys[1:] >= keys[:-1]) else np.argsort(keys, kind="stable")
            k = keys if order is None else keys[order]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
            return order, first, k[first]

        def grouped(values: np.ndarray, how: tuple, n: int) -> np.ndarray:
            order, first, keys = how
            out = np.zeros((n, width), values.dtype)
            if len(first):
                out[keys] = np.add.reduceat(values if order is None else values[order], first, axis=0)
            return out

        # tokens x types and types x features as index arrays
        spread = {}
        for k in self.shifts:
            counts = np.array([len(v) for v in lists[k]])
            flat = np.array([v for part in lists[k] for v in part], np.int64)
            owner = np.repeat(np.arange(len(counts)), counts)
            by_feature, by_type = groups(flat), groups(context[k])
            # features' gradients take the types in the features' order at once
            spread[k] = (len(counts), flat, groups(owner), owner if by_feature[0] is None else owner[by_feature[0]], (None, *by_feature[1:]), by_type)
        n_feat = len(vocabulary)
        onehot = np.zeros((len(ids), width), np.float32)
        onehot[np.arange(len(ids)), y] = 1
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        prev, cur = self._shifted(y + 1, lengths, -1, 0), y
        gold_pairs = np.zeros((width, width))
        np.add.at(gold_pairs, (prev[prev > 0] - 1, cur[prev > 0]), 1)
        ends = starts + lengths - 1

        def unpack(x):
            w = x[: n_feat * width].reshape(n_feat, width)
            rest = x[n_feat * width :]
            return w, rest[: width * width].reshape(width, width), rest[width * width : width * width + width], rest[width * width + width :]

        def loss(x):
            w, trans, start, end = unpack(x)
            scores, small = np.zeros((len(ids), width), np.float32), w.astype(np.float32)
            def lent(k: int) -> np.ndarray:
                n_types, flat, by_owner, *_ = spread[k]
                return grouped(small[flat], by_owner, n_types)[context[k]]

            for part in pool.map(lent, self.shifts):
                scores += part
            post, total, expected = forward_backward(scores, steps, trans, start, end, pairs=True)
            fit = scores[np.arange(len(ids)), y].sum(dtype=np.float64) + (gold_pairs * trans).sum() + start[y[starts]].sum() + end[y[ends]].sum()
            diff = post - onehot
            gw = np.zeros_like(w)
            def owed(k: int) -> np.ndarray:
                n_types, _, _, owner, by_feature, by_type = spread[k]
                return grouped(grouped(diff, by_type, n_types)[owner], by_feature, n_feat)

            for part in pool.map(owed, self.shifts):
                gw += part
            gs = diff[starts].sum(0, dtype=np.float64)
            ge = diff[ends].sum(0, dtype=np.float64)
            grad = np.concatenate([gw.ravel(), (expected - gold_pairs).ravel(), gs, ge]) + l2 * x
            return total - fit + 0.5 * l2 * (x @ x), grad

        keep = lengths > 0
        if not keep.all():
            raise ValueError("sequences must not be empty")
        # a step of the line search may overshoot; what is not finite is refused
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"), ThreadPoolExecutor(len(self.shifts)) as pool:
            x = minimise(loss, np.zeros(n_feat * width + width * width + 2 * width), rounds)
        w, self.trans, self.start, self.end = (v.astype(np.float32) for v in unpack(x))
        strong = np.abs(w).max(1) > 1e-3
        index = np.cumsum(strong) - 1
        self.weights = w[strong]
        self.vocabulary = {f: int(index[i]) for f, i in vocabulary.items() if strong[i]}
        self._forget()
        return self

    @staticmethod
    def _shifted(ids: np.ndarray, lengths: np.ndarray, k: int, fill: int) -> np.ndarray:
        """ids of the token ``k`` further on in the same sequence, ``fill`` beyond its ends."""
        if k == 0:
            return ids
        ends = np.cumsum(lengths)
        starts = ends - lengths
        out = np.full(len(ids), fill, ids.dtype)
        at = np.arange(len(ids)) + k
        owner = np.repeat(np.arange(len(lengths)), lengths)
        ok = (at >= starts[owner]) & (at < ends[owner])
        out[ok] = ids[at[ok]]
        return out

    def _type(self, token: str) -> int:
        get = self.vocabulary.get
        row = np.zeros((len(self.shifts), len(self.labels)), np.float32)
        for i, k in enumerate(self.shifts):
            at = [v for x in dict.fromkeys(self._names(token, k)) if (v := get(x)) is not None]
            if at:
                row[i] = self.weights[at].sum(0)
        self.types[token] = len(self.rows)
        self.rows.append(row)
        return len(self.rows) - 1

    def index(self, key: Callable[[str], str] = str) -> Types:
        """From raw tokens to rows of the model's table; ``key`` gives a token's type."""
        return Types(self, key)

    def scores(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Label scores of all tokens of a batch, given as rows of an index."""
        if self.table is None or len(self.table) != len(self.rows):
            fresh = np.array(self.rows[0 if self.table is None else len(self.table) :], np.float32).reshape(-1, len(self.shifts), len(self.labels))
            self.table = fresh if self.table is None else np.concatenate([self.table, fresh])
        # ``reach`` edge tokens around every sequence, so that a neighbour is a plain shift
        r, n = self.reach, len(ids)
        place = np.arange(n) + r * (1 + np.repeat(np.arange(len(lengths)), lengths))
        padded = np.zeros(n + r * (len(lengths) + 1), np.int64)
        padded[place] = ids
        out = np.empty((len(padded), len(self.labels)), np.float32)
        for a in range(0, len(padded), _STRIP):
            b = min(a + _STRIP, len(padded))
            lo, hi = max(0, a - r), min(b + r, len(padded))
            rows = self.table[padded[lo:hi]]
            own = rows[a - lo : b - lo, 0].copy()
            for i, k in enumerate(self.shifts[1:], 1):
                x, y = max(a + k, 0), min(b + k, len(padded))
                own[x - k - a : y - k - a] += rows[x - lo : y - lo, i]
            out[a:b] = own
        return out[place]

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        scores = self.scores(ids, lengths)
        steps, start, end = in_blocks(scores, lengths, self.trans, self.start, self.end, best=True)
        return viterbi(scores, steps, self.trans, start, end)

    def posterior(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        scores = self.scores(ids, lengths)
        steps, start, end = in_blocks(scores, lengths, self.trans, self.start, self.end, best=False)
        return forward_backward(scores, steps, self.trans, start, end)[0]


class Types(dict):
    """Rows of a model's table by raw token, kept from batch to batch as long as they are few."""

    def __init__(self, model: CRF, key: Callable[[str], str]):
        super().__init__()
        self.model, self.key = model, key
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.model._forget()
        self.model._type("")

    def __missing__(self, raw: str) -> int:
        key = self.key(raw)
        row = self.model.types.get(key)
        row = self[raw] = self.model._type(key) if row is None else row
        return row

    def rows(self, tokens: list[str]) -> np.ndarray:
        """The rows of a batch's tokens."""
        if len(self) > MOST_TYPES:
            self._empty()
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
