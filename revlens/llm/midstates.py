"""SHA-256 over many messages at once, with states that can be kept, stored and resumed.

A state is the eight 32-bit words after some whole 64-byte blocks, as a row of a uint32 array; it
can be written to a table, which Python's hash objects cannot. A hexadecimal digest is exactly one
block, so hashing digests one after another has a state between any two of them.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64
CHUNK = 4096  # messages at a time: the schedule of a chunk stays in the processor's cache


def _root_bits(p: int, degree: int) -> int:
    """First 32 bits after the point of a root of `p`."""
    target, low, high = p << (32 * degree), 0, p << 32
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle ** degree <= target else (low, middle - 1)
    return low & 0xFFFFFFFF


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, p))]
ROUND = np.array([_root_bits(p, 3) for p in _PRIMES], "u4")
START = np.array([_root_bits(p, 2) for p in _PRIMES[:8]], "u4")
HEX = np.frombuffer(b"0123456789abcdef", "u1")


def start(n: int) -> np.ndarray:
    """The states of `n` messages of which nothing has been read."""
    return np.tile(START, (n, 1))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def _absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    w = np.empty((64, len(states)), "u4")
    w[:16] = blocks.view(">u4").T
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        w[t] = w[t - 16] + w[t - 7] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3)))
        w[t] += _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
    a, b, c, d, e, f, g, h = states.T.copy()
    for t in range(64):
        rise = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + (w[t] + ROUND[t])
        fall = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = rise + fall, a, b, c, d + rise, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], 1)


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states after one more block each; `blocks` holds 64 bytes a row."""
    out = np.empty_like(states)
    for at in range(0, len(states), CHUNK):
        part = slice(at, at + CHUNK)
        out[part] = _absorb(states[part], np.ascontiguousarray(blocks[part]))
    return out


def finish(states: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """Digests, 32 bytes a row, of messages that end after `n_blocks` whole blocks."""
    last = np.zeros((len(states), BLOCK), "u1")
    last[:, 0] = 0x80
    last[:, 56:] = (np.asarray(n_blocks).astype(">u8") * np.uint64(BLOCK * 8)).astype(">u8")[:, None].view("u1")
    return as_bytes(absorb(states, last))


def as_bytes(states: np.ndarray) -> np.ndarray:
    """States as 32 bytes a row."""
    return np.ascontiguousarray(states.astype(">u4")).view("u1")


def from_bytes(rows: np.ndarray) -> np.ndarray:
    """States from 32 bytes a row."""
    return np.ascontiguousarray(rows).view(">u4").astype("u4")


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """32 bytes a row as the 64 bytes of their lowercase hexadecimal text."""
    return np.stack([HEX[digests >> 4], HEX[digests & 15]], 2).reshape(len(digests), BLOCK)
