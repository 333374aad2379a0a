"""Prediction by partial matching over the bytes of words.

The text is the byte stream " w1 w2 ... \\n".  The context of a byte is the up to
``ORDER`` bytes before it: back to the blank before its word at most, so a word's
code length does not depend on its neighbours and is computed once per distinct
word (``grams``, ``positions``), or over the blanks back to the text's start
(``stream``, ``keys``).  Escapes are estimated by method C (as many escapes as distinct symbols), and
exclude the symbols that the longer context has already offered.  What pruning
has taken from a context counts as escapes too.
"""

from __future__ import annotations

import numpy as np

ORDER = 7
BLANK = 0x20
END = b"\n"
ALPHABET = 256


def grams(words: list[bytes], longest: int = ORDER):
    """(order, context and symbol as one number, word index, longest context) of every
    byte of every word, for every order up to ``longest`` that reaches the word's blank
    at most.

    A word is coded as its bytes and a blank after it; ``END`` as itself."""
    closed = [w if w == END else w + b" " for w in words]
    size = np.array([len(w) for w in closed], np.int64)
    flat = np.frombuffer(b"".join(b" " + w for w in closed), np.uint8).astype(np.uint64)
    start = np.cumsum(size + 1) - (size + 1)                 # of the blanks in front
    owner = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(owner)) + owner + 1                  # of the coded bytes
    depth = np.minimum(at - start[owner], ORDER)            # longest context
    code = flat[at]
    yield 0, code, owner, depth
    for k in range(1, longest + 1):
        on = depth >= k
        code = code.copy()
        code[on] |= flat[at[on] - k] << np.uint64(8 * k)
        yield k, code, owner, depth


def positions(words: list[bytes], longest: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(longest context and symbol as one number, word index, its length) of every byte of every word."""
    for found in grams(words, longest):
        last = found
    return last[1:]


def count(words: list[bytes], weights: np.ndarray, longest: int = ORDER) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order: distinct (context, symbol) numbers and their counts."""
    out = []
    for k, code, owner, depth in grams(words, longest):
        on = depth >= k
        values, at = np.unique(code[on], return_inverse=True)
        out.append((values, np.bincount(at, weights[owner[on]], len(values)).astype(np.int64)))
    return out


def suffix(code: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes of the contexts."""
    return (code >> np.uint64(8)) & np.uint64((1 << (8 * n)) - 1)


def stream(tokens: list[bytes]) -> bytes:
    """The byte stream of a text of these tokens, the last of which is ``END``."""
    return b" " + b" ".join(tokens)


def keys(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(key of every byte of every stream but its first blank, their number per stream).

    A key is the byte and the up to ``ORDER`` bytes before it as one number.  ``END`` is never a
    context, so there it stands for the text's start, and nothing stands beyond it."""
    flat = np.frombuffer(END + b"".join(streams), np.uint8).astype(np.uint64)
    for k in (1, 2, 4):
        before = flat[:-k] << np.uint64(8 * k)
        flat = flat.copy() if k > 1 else flat
        flat[k:] |= before
    size = np.array([len(s) for s in streams], np.int64)
    blank = np.cumsum(size) - size + 1
    for k in range(1, ORDER - 1):       # the bytes of the text before
        at = blank[size > k] + k
        flat[at] &= np.uint64((1 << (8 * (k + 2))) - 1)
    coded = np.ones(len(flat), bool)
    coded[0] = False
    coded[blank] = False
    return flat[coded], size - 1


def opened(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(longest context and symbol as one number, its length) of every key."""
    depth = np.full(len(keys), ORDER, np.int64)
    code = keys.copy()
    for k in range(ORDER, 0, -1):
        on = ((keys >> np.uint64(8 * k)) & np.uint64(0xFF)) == np.uint64(END[0])
        depth[on] = k - 1
        code[on] = keys[on] & np.uint64((1 << (8 * k)) - 1)
    return code, depth


def _hashed(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - len(slots).bit_length())).astype(np.int64)


def slots_of(keys: np.ndarray) -> np.ndarray:
    """Hash table of distinct keys: their places in a power of two of slots, others -1."""
    slots = np.full(1 << max(1, int(2 * len(keys)).bit_length()), -1, np.int32)
    left = np.arange(len(keys), dtype=np.int32)
    slot = _hashed(keys, slots)
    while len(left):
        free = slots[slot] < 0
        slots[slot[free]] = left[free]
        over = slots[slot] != left
        left, slot = left[over], (slot[over] + 1) & (len(slots) - 1)
    return slots


def found(known: np.ndarray, slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The places of ``keys`` among ``known``, -1 for others; the last of ``known`` equals no key."""
    slot = _hashed(keys, slots)
    at = slots[slot]
    left = np.flatnonzero((known[at] != keys) & (at >= 0))
    slot = slot[left]
    while len(left):
        slot = (slot + 1) & (len(slots) - 1)
        at[left] = now = slots[slot]
        over = (known[now] != keys[left]) & (now >= 0)
        left, slot = left[over], slot[over]
    return at


def planes(values: np.ndarray) -> bytes:
    """Numbers of 8 bytes, first the lowest byte of all, at last the highest: in order they compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def longer(code: np.ndarray, depth: np.ndarray, n: np.ndarray, shortest: int, longest: int = ORDER) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order from ``shortest`` to ``longest``: distinct (context, symbol) numbers and their counts,
    of bytes that occur ``n`` times with a context of ``depth`` bytes in ``code``."""
    out = []
    for k in range(shortest, longest + 1):
        on = (depth >= k) & (n > 0)
        values, at = np.unique(code[on] & np.uint64((1 << (8 * (k + 1))) - 1), return_inverse=True)
        out.append((values, np.bincount(at, n[on], len(values)).astype(np.int64)))
    return out


class Trie:
    """Counts by order as sorted arrays, with each context's totals."""

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray]]):
        self.code, self.n = [], []
        self.context, self.total, self.kinds, self.offered, self.rare = [], [], [], [], []
        for c, n in orders:
            self._add(c, n)

    def extended(self, orders: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
        """This trie with the next longer orders after its own."""
        out = Trie.__new__(Trie)
        out.__dict__.update((name, list(arrays)) for name, arrays in vars(self).items())
        for c, n in orders:
            out._add(c, n)
        return out

    def _add(self, c: np.ndarray, n: np.ndarray) -> None:
        k = len(self.code)
        self.code.append(np.append(c, np.uint64(0xFFFFFFFFFFFFFFFF)))
        self.n.append(np.append(n, 0))
        ctx, first = np.unique(c >> np.uint64(8), return_index=True)
        cut = np.append(first, len(c))[: len(ctx) + 1]
        run = np.append(0, np.cumsum(n))
        self.context.append(np.append(ctx, np.uint64(0xFFFFFFFFFFFFFFFF)))
        self.total.append(np.append(run[cut[1:]] - run[cut[:-1]], 0) if len(ctx) else np.zeros(1, np.int64))
        self.kinds.append(np.append(np.diff(cut), 0) if len(ctx) else np.zeros(1, np.int64))
        if k:       # what the next shorter context has on the symbols offered here
            low = c & np.uint64((1 << (8 * k)) - 1)
            at = np.searchsorted(self.code[k - 1], low)
            there = np.where(self.code[k - 1][at] == low, self.n[k - 1][at], 0)
            run = np.append(0, np.cumsum(there))
            self.offered.append(np.append(run[cut[1:]] - run[cut[:-1]], 0) if len(ctx) else np.zeros(1, np.int64))
            # a context was followed as often as it was seen as a symbol in its own context
            ctx = self.context[k][:-1]
            at, there = self._find(self.code[k - 1], ctx)
            seen = np.where(there, self.n[k - 1][at], 0)
            if k == 1:
                at, there = self._find(self.code[0], np.array(list(END), np.uint64))
                seen[ctx == BLANK] += int(self.n[0][at][0])
            self.rare.append(np.append(np.maximum(seen - self.total[k][:-1], 0), 0))
        else:
            self.offered.append(np.zeros(1, np.int64))
            self.rare.append(np.zeros(len(self.total[0]), np.int64))

    @staticmethod
    def _find(keys, values):
        at = np.searchsorted(keys, values)
        return np.where(keys[at] == values, at, len(keys) - 1), keys[at] == values

    def score(self, words: list[bytes], under: int = ORDER + 1) -> np.ndarray:
        """log10 probability of every word, of its bytes with a context of less than ``under`` bytes."""
        code, owner, depth = positions(words, min(under - 1, ORDER))
        on = depth < under
        code, owner, depth = code[on], owner[on], depth[on]
        (code, reach), at = self._distinct(code, depth)
        logp = self._codes(code, reach.astype(np.int64))
        return np.bincount(owner, logp[at], len(words))

    @staticmethod
    def _distinct(full, depth):
        order = np.lexsort((depth, full))
        f, d = full[order], depth[order]
        new = np.r_[True, (f[1:] != f[:-1]) | (d[1:] != d[:-1])]
        at = np.empty(len(full), np.int64)
        at[order] = np.cumsum(new) - 1
        return np.stack([f[new], d[new].astype(np.uint64)]), at

    def _codes(self, code, reach) -> np.ndarray:
        logp = np.zeros(len(code))
        open_ = np.ones(len(code), bool)
        gone_n, gone_kinds = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        for k in range(ORDER, -1, -1):
            on = np.flatnonzero(open_ & (reach >= k))
            if not len(on):
                continue
            c = code[on] if k == ORDER else code[on] & np.uint64((1 << (8 * (k + 1))) - 1)
            if k:
                ctx, known = self._find(self.context[k], c >> np.uint64(8))
            else:
                ctx, known = np.zeros(len(c), np.int64), np.full(len(c), len(self.context[0]) > 1)
            sym, seen = self._find(self.code[k], c)
            kinds = self.kinds[k][ctx] - gone_kinds[on]
            rare = self.rare[k][ctx]
            whole = self.total[k][ctx] - gone_n[on] + rare + kinds
            use = known & (kinds > 0)
            part = np.where(seen, self.n[k][sym], kinds + rare)
            logp[on[use]] += np.log10(part[use] / whole[use])
            open_[on[use & seen]] = False
            gone_n[on] = np.where(known, self.offered[k][ctx], 0)
            gone_kinds[on] = np.where(known, self.kinds[k][ctx], 0)
        # symbols that no context has
        kinds0 = int(self.kinds[0][0]) if len(self.context[0]) > 1 else 0
        logp[open_] -= np.log10(max(ALPHABET - kinds0, 1))
        return logp
