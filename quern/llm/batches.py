"""NumPy helpers shared by the text operators: many texts as one array of code points."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E6C63D0876A9A35 | 5  # odd, 5 mod 8: powers have the longest period
_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts together, starts): text i is ``codes[starts[i]:starts[i + 1]]``."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), starts


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that leaves no visible pattern."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            full = np.full(size, base, np.uint64)
            full[0] = 1
            _powers[k] = np.multiply.accumulate(full)
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash; see ``span_hashes``."""
    up, _ = _power_tables(max(1, len(values)))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(scramble(values.astype(np.uint64) + np.uint64(0x51ED270B)) * up[: len(values)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span [start, end), the same wherever equal spans lie."""
    _, down = _power_tables(len(prefix))
    return scramble((prefix[end] - prefix[start]) * down[start])


def window_hashes(prefix: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` values (empty if there are fewer)."""
    n = len(prefix) - k
    if n <= 0:
        return np.zeros(0, np.uint64)
    _, down = _power_tables(len(prefix))
    return scramble((prefix[k:] - prefix[:n]) * down[:n])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, in three passes whatever ``w`` is."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    pad = -len(x) % w
    block = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def chunks(texts: list[str], most: int = 1 << 21):
    """Slices (i, j) of the list with at most ``most`` characters each, or one longer text."""
    i = n = 0
    for j, t in enumerate(texts):
        if j > i and n + len(t) > most:
            yield i, j
            i, n = j, 0
        n += len(t)
    if i < len(texts):
        yield i, len(texts)
