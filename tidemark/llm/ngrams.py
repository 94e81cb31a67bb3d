"""Hashed byte n-gram counts with numpy, in slices of bounded size."""

import numpy as np

SLICE_BYTES = 1 << 19
PAD = b"\n\n\n"
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def slices(raws, size=SLICE_BYTES):
    """Lists of (index, bytes) of at most ``size`` bytes each; longer texts come in several parts."""
    group, held = [], 0
    for i, raw in enumerate(raws):
        for at in range(0, max(1, len(raw)), size):
            part = raw[at : at + size]
            if group and held + len(part) > size:
                yield group
                group, held = [], 0
            group.append((i, part))
            held += len(part)
    if group:
        yield group


def counts(parts, dim, orders, segment=None):
    """(counts, owner): a row of ``dim`` counts per segment of ``segment`` bytes (default: per part).

    ``owner`` is the position in ``parts`` of every row. A part without bytes has one row of zeros.
    """
    lens = np.array([len(p) for p in parts], dtype=np.int64)
    per = np.ones_like(lens) if segment is None else np.maximum(1, -(-lens // segment))
    first = np.concatenate(([0], np.cumsum(per)[:-1]))
    owner = np.repeat(np.arange(len(parts)), per)
    buf = np.frombuffer(b"".join(p + PAD for p in parts) + PAD, dtype=np.uint8).astype(np.uint32)
    part_of = np.repeat(np.arange(len(parts)), lens)
    inside = np.arange(len(part_of)) - np.repeat(np.cumsum(lens) - lens, lens)
    at = inside + np.repeat(np.cumsum(lens + len(PAD)) - lens - len(PAD), lens)
    row = first[part_of] if segment is None else first[part_of] + inside // segment
    total = np.zeros(int(per.sum()) * dim, dtype=np.float32)
    n = len(buf) - len(PAD)
    for order in orders:
        h = np.full(n, order * 0x165667B1 & 0xFFFFFFFF, dtype=np.uint32)
        for j in range(order):
            h = (h ^ buf[j : j + n]) * _MULTIPLIERS[j]
            h ^= h >> np.uint32(15)
        key = row * dim + (h[at] % np.uint32(dim)).astype(np.int64)
        total += np.bincount(key, minlength=len(total)).astype(np.float32)
    return total.reshape(-1, dim), owner


def scaled(x):
    """Square roots of relative frequencies: rows of length 1, or 0 for no bytes."""
    return np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1))
