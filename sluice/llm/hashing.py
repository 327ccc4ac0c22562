"""Hashes of byte strings and words, in arrays."""

from __future__ import annotations

import re

import numpy as np

#: Bytes of text whose words are hashed at once.
SLICE = 4 << 20

_FACTOR = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_next_space = re.compile(rb"[ \t-\r]").search
_powers: dict[str, np.ndarray] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random odd value of each byte; powers of a factor and of its inverse mod 2^64, n + 1 at least.

    With S[i] the sum of value[c_j] * down[j] over j < i, (S[e] - S[s]) * up[s] is
    a hash of the bytes from s to e that does not depend on where they lie.
    """
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, 1 << 17)
        _powers["byte"] = np.random.default_rng(57).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        for name, factor in (("up", _FACTOR), ("down", pow(_FACTOR, -1, 2**64))):
            _powers[name] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, factor, np.uint64))])
    return _powers["byte"], _powers["up"], _powers["down"]


def word_hashes(raw: bytes) -> np.ndarray:
    """A-Z lower-cased words between ASCII white space, as 64-bit hashes."""
    parts, at = [], 0
    while len(raw) - at > SLICE and (cut := _next_space(raw, at + SLICE)):
        parts.append(_hashes(raw[at : cut.start()]))
        at = cut.start()
    parts.append(_hashes(raw[at:]))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def _hashes(raw: bytes) -> np.ndarray:
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64)
    value, up, down = power_tables(n)
    code = np.frombuffer(raw, np.uint8)
    edge = np.zeros(1, bool)
    edges = np.flatnonzero(np.diff(np.concatenate([edge, ~_SPACE[code], edge])))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value[_LOWER[code]] * down[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * up[starts])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
