"""Rolling (Rabin-Karp) hashes and anchored runs of windows, with numpy.

A window of ``length`` items is anchored at the leftmost smallest of its ``gram``-item hashes. Equal
windows have equal anchors at equal offsets, so only windows with the same anchor hash need comparing.
Neighbouring windows mostly share an anchor: they form a run, and a corpus has far fewer runs than windows.
"""

import numpy as np

SLICE_ITEMS = 1 << 18
_M1, _M2 = 0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.default_rng(20240229)
BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_powers = {}


def mix(x):
    """Spread the bits of every number (a bijection on 64 bits)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base, n):
    """Powers of ``base`` and of its inverse modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 19)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _powers[base] = both
    return _powers[base]


class Rolling:
    """Hashes of any span of a sequence of 64-bit items, from prefix sums modulo 2**64."""

    def __init__(self, items, base=_M1):
        up, self.down = _power(base, len(items) + 1)
        self.sums = np.zeros(len(items) + 1, dtype=np.uint64)
        np.cumsum(items * up[: len(items)], out=self.sums[1:])

    def spans(self, start, end):
        length = np.asarray(end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + length * np.uint64(_M2))

    def grams(self, n):
        count = len(self.sums) - n
        raw = (self.sums[n:] - self.sums[:count]) * self.down[:count]
        return mix(raw + np.uint64(n * _M2 & 0xFFFFFFFFFFFFFFFF))


def byte_items(raws):
    """(items, starts): one item per byte of all texts, and where each text starts."""
    starts = np.concatenate(([0], np.cumsum([len(r) for r in raws]))).astype(np.int64)
    return BYTE[np.frombuffer(b"".join(raws), dtype=np.uint8)], starts


def word_items(raws, part=1 << 19):
    """(items, starts): one hash per white-space separated word of all texts."""
    items, sizes = [], np.zeros(len(raws), dtype=np.int64)
    group, held = [], 0

    def flush():
        buf = np.frombuffer(b" " + b" ".join(r for _, r in group) + b" ", dtype=np.uint8)
        blank = SPACE[buf]
        first = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        last = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        items.append(Rolling(BYTE[buf]).spans(first, last))
        begin = np.cumsum([1] + [len(r) + 1 for _, r in group])
        np.add.at(sizes, [i for i, _ in group], np.diff(np.searchsorted(first, begin)))

    for i, raw in enumerate(raws):
        for piece in blank_pieces(raw, part):
            if group and held + len(piece) > part:
                flush()
                group, held = [], 0
            group.append((i, piece))
            held += len(piece)
    if group:
        flush()
    return (np.concatenate(items) if items else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))


def blank_pieces(raw, part):
    """Cut bytes at white space into pieces of about ``part`` bytes; words stay whole."""
    at = 0
    while len(raw) - at > part:
        cut = next((c for c in (raw.find(b, at + part) for b in (b" ", b"\n")) if c >= 0), -1)
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def leftmost_least(v, width):
    """Value and position of the leftmost smallest of every ``width`` neighbours."""
    p = np.arange(len(v), dtype=np.int64)
    have = 1
    while have < width:
        s = min(have, width - have)
        right = v[s:] < v[:-s]
        v, p = np.where(right, v[s:], v[:-s]), np.where(right, p[s:], p[:-s])
        have += s
    return v, p


def runs(items, starts, length, gram):
    """(text, lo, hi, anchor hash, content hash) of every run; windows lo..hi of a text, both included.

    The content hash covers all items that the run's windows cover.
    """
    n = len(items)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return none, none, none, none, none
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    least, at = leftmost_least(Rolling(items).grams(gram), length - gram + 1)
    own = np.flatnonzero(text[: n - length + 1] == text[length - 1 :])
    if not len(own):
        return none, none, none, none, none
    new = np.concatenate(([True], (np.diff(at[own]) != 0) | (np.diff(own) != 1)))
    lo = own[new]
    hi = own[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(own) - 1]))]
    content = Rolling(mix(items), _M2).spans(lo, hi + length)
    first = starts[text[lo]]
    return text[lo], lo - first, hi - first, least[lo].view(np.int64), content.view(np.int64)


def sliced(raws, items_of, length, size=SLICE_ITEMS):
    """(texts, offsets, items, starts) in slices of about ``size`` items.

    A longer text comes in several parts that overlap by ``length - 1`` items, so that every window is in
    exactly one of them.
    """
    items, starts = items_of(raws)
    texts, offsets, parts, held = [], [], [], 0
    for i in range(len(raws)):
        a, b = starts[i], starts[i + 1]
        for at in range(0, max(1, b - a - length + 1), size):
            part = items[a + at : min(b, a + at + size + length - 1)]
            if parts and held + len(part) > size:
                yield texts, offsets, np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
                texts, offsets, parts, held = [], [], [], 0
            texts.append(i)
            offsets.append(at)
            parts.append(part)
            held += len(part)
    if parts:
        yield texts, offsets, np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def all_runs(raws, items_of, length, gram):
    """``runs`` of a list of texts, slice by slice."""
    for texts, offsets, items, starts in sliced(raws, items_of, length):
        text, lo, hi, anchor, content = runs(items, starts, length, gram)
        off = np.array(offsets)[text]
        yield np.array(texts)[text], lo + off, hi + off, anchor, content


def covered(lo, hi, length, n):
    """Mask of ``n`` items: those in a window from lo to hi."""
    d = np.zeros(n + length + 1, dtype=np.int64)
    np.add.at(d, lo, 1)
    np.add.at(d, np.asarray(hi) + length, -1)
    return np.cumsum(d)[:n] > 0


def intervals(mask):
    """Maximal stretches of a mask as (starts, ends), ends exclusive."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
