"""SHA-256 over many rows at once, with its running state in the open.

A message whose parts are 64 hexadecimal characters each fills one block a
part, so the state after any part is eight words and nothing else: it can be
stored in a table and resumed in another task.  Arrays hold words first:
states and digests are (8, rows), blocks (16, rows), all ``uint32``.
"""

from __future__ import annotations

import numpy as np

_U = np.uint32


def _primes(n: int) -> list[int]:
    found: list[int] = []
    candidate = 2
    while len(found) < n:
        if all(candidate % p for p in found):
            found.append(candidate)
        candidate += 1
    return found


def _root_bits(value: int, power: int) -> int:
    """The first 32 bits of the fraction of a prime's square or cube root."""
    target = value << (32 * power)
    low, high = 0, 1 << 64
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if middle ** power <= target else (low, middle)
    return low & 0xFFFFFFFF


START = np.array([_root_bits(p, 2) for p in _primes(8)], _U)
_ROUND = [_U(_root_bits(p, 3)) for p in _primes(64)]
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> _U(n)) | (x << _U(32 - n))


def start(rows: int) -> np.ndarray:
    return np.repeat(START[:, None], rows, axis=1)


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The state after one more block."""
    if not state.shape[1]:
        return state.copy()
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + w[i - 7] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> _U(3)))
                     + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> _U(10))))
        t1 = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[i] + w[i]
        t2 = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t1 + t2, a, b, c, d + t1, e, f, g
    return state + np.stack((a, b, c, d, e, f, g, h))


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digest of messages of so many whole blocks each."""
    pad = np.zeros((16, state.shape[1]), _U)
    pad[0] = 0x80000000
    bits = np.asarray(blocks, np.uint64) << np.uint64(9)
    pad[14], pad[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return absorb(state, pad)


def to_bytes(words: np.ndarray) -> np.ndarray:
    """(rows, 32) bytes of states or digests."""
    return np.ascontiguousarray(words.T).astype(">u4").view(np.uint8).reshape(-1, 32)


def from_bytes(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.ascontiguousarray(raw).view(">u4").astype(_U).T)


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """The block that a digest's hexadecimal text fills."""
    raw = to_bytes(digests)
    text = np.empty((len(raw), 64), np.uint8)
    text[:, 0::2] = _DIGITS[raw >> 4]
    text[:, 1::2] = _DIGITS[raw & 15]
    return np.ascontiguousarray(text.view(">u4").astype(_U).T)
