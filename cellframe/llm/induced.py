"""External induced sorting of the suffixes of one shard, with capped common-prefix values.

Suffixes need only be in order up to ``cap`` bytes, which bounds the work on the reduced string:

* The text's S* suffixes (the local minima) are sorted first: their substrings get names, and the string of names is
  sorted in rounds, each of which orders names by pairs of the round before and so doubles the depth, until it is ``cap``.
* From them the L suffixes are induced in rising order, and from these the S suffixes in falling order. Each suffix taken out puts
  the one before it into a priority queue. The queue's keys only ever rise, so it is one first-in-first-out file per symbol
  (:class:`Spool`): what does not fit into memory lies on disk, in the order in which it is read again.
* A tuple carries its suffix and its common prefix with the tuple before it; that of an induced pair is one more than the
  least among the tuples taken out between its two sources.

Random access is to the text and to the names' ranks only; beyond ``memory`` entries both are memory-mapped files.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np

#: Never part of UTF-8: ends a string of the shard.
END = 0xFF


class Folder:
    """A task's scratch folder for what does not fit into memory; gone when the task is done with it."""

    def __init__(self, memory: int):
        self.memory, self.path, self.count = memory, None, 0

    def name(self) -> str:
        if self.path is None:
            self.path = tempfile.mkdtemp(prefix="induced-")
        self.count += 1
        return os.path.join(self.path, str(self.count))

    def array(self, n: int, dtype) -> np.ndarray:
        return np.zeros(n, dtype) if n <= self.memory else np.memmap(self.name(), dtype, "w+", shape=(n,))

    def __enter__(self):
        return self

    def __exit__(self, *_):
        if self.path is not None:
            shutil.rmtree(self.path, ignore_errors=True)


class Spool:
    """A queue of (suffix, common prefix) per symbol, read in the order of writing; the oldest tuples go to disk."""

    def __init__(self, folder: Folder):
        self.folder, self.held = folder, 0
        self.parts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(256)]
        self.on_disk, self.total = [0] * 256, [0] * 256
        self.files: dict[int, tuple[str, str]] = {}

    def append(self, symbol: int, pos: np.ndarray, link: np.ndarray) -> None:
        self.parts[symbol].append((pos, link))
        self.total[symbol] += len(pos)
        self.held += len(pos)
        if self.held > self.folder.memory:
            for s in range(256):
                if self.parts[s]:
                    if s not in self.files:
                        self.files[s] = (self.folder.name(), self.folder.name())
                    for k, name in enumerate(self.files[s]):
                        with open(name, "ab") as f:
                            for part in self.parts[s]:
                                part[k].tofile(f)
                    self.on_disk[s], self.parts[s] = self.total[s], []
            self.held = 0

    def get(self, symbol: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Tuples a to b of a symbol."""
        cut, out = self.on_disk[symbol], ([], [])
        if a < cut:
            n = min(b, cut) - a
            for k, (dtype, size) in enumerate((("<i8", 8), ("u1", 1))):
                out[k].append(np.fromfile(self.files[symbol][k], dtype, n, offset=a * size))
        if b > cut:
            if len(self.parts[symbol]) > 1:
                self.parts[symbol] = [tuple(np.concatenate(x) for x in zip(*self.parts[symbol]))]
            for k in (0, 1):
                out[k].append(self.parts[symbol][0][k][max(a - cut, 0):b - cut])
        return np.concatenate(out[0]), np.concatenate(out[1])


class Minima:
    """Least value of any range of a short array."""

    def __init__(self, x: np.ndarray):
        self.rows = [x]
        step, n = 1, len(x)
        while 2 * step <= n:
            x = np.minimum(x[:-step], x[step:])
            self.rows.append(x)
            step *= 2

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least of x[a..b], ends included, a <= b."""
        level = np.frexp((b - a + 1).astype(float))[1] - 1
        out = np.empty(len(a), np.uint8)
        for k in np.unique(level):
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[a[at]], row[b[at] - (1 << int(k)) + 1])
        return out


class _Inducer:
    """Puts the suffixes before those taken out into a spool, with their common prefixes."""

    def __init__(self, text: np.ndarray, spool: Spool, cap: int):
        self.text, self.spool, self.cap = text, spool, cap
        self.since = np.full(256, 255, np.uint8)  # least link since the last suffix put in, by symbol

    def push(self, pos: np.ndarray, link: np.ndarray, keep) -> None:
        """``keep(symbols)``: which of the suffixes before have the type that is being induced."""
        ok = pos > 0
        before = self.text[np.maximum(pos - 1, 0)]
        at = np.flatnonzero(ok & keep(before))
        whole = link.min()
        if len(at):
            low = Minima(link)
            by = at[np.argsort(before[at], kind="stable")]
            symbol = before[by]
            new = np.append(True, symbol[1:] != symbol[:-1])
            least = low.of(np.where(new, 0, np.append(0, by[:-1] + 1)), by)
            least = np.where(new, np.minimum(least, self.since[symbol]), least)
            links = np.minimum(least.astype(np.int16) + 1, self.cap).astype(np.uint8)
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(by))
            np.minimum(self.since, whole, out=self.since)
            for a, b in zip(starts.tolist(), ends.tolist()):
                s, last = int(symbol[a]), int(by[b - 1])
                if not self.spool.total[s]:
                    links[a] = 0  # the first of its symbol
                self.spool.append(s, pos[by[a:b]] - 1, links[a:b])
                self.since[s] = link[last + 1:].min() if last + 1 < len(link) else 255
        else:
            np.minimum(self.since, whole, out=self.since)


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S); the end of the text is smaller than any symbol."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    out = np.zeros(n, bool)
    if len(differs):  # a run has the type of its last symbol; one that ends the text is L
        at = np.repeat(differs, np.diff(np.append(-1, differs)))
        out[:len(at)] = text[at] < text[at + 1]
    return out


def _refine(rank: np.ndarray, open_: np.ndarray, second: np.ndarray, most: int | None = None) -> np.ndarray:
    """Orders the entries ``open_`` of equal rank by ``second``; returns those that still share a rank.

    A rank is the place of the first entry of its group, so refining one group leaves all others as they are. Entries of a group stand
    together in ``open_``. ``most`` bounds ``second`` (0 or more), if that is known: then one key does for both.
    """
    r = rank[open_]
    group = np.cumsum(np.append(0, r[1:] != r[:-1]))
    if not group[-1]:
        by = np.argsort(second)
    elif most is not None and int(group[-1]) * (most + 1) + most < 2 ** 62:
        by = np.argsort(group * (most + 1) + second)
    else:
        by = np.lexsort((second, group))
    e, s, r = open_[by], second[by], r[by]
    head = np.append(True, r[1:] != r[:-1])
    new = head | np.append(True, s[1:] != s[:-1])
    at = np.arange(len(e))
    first = np.maximum.accumulate(np.where(head, at, 0))
    rank[e] = r + (np.maximum.accumulate(np.where(new, at, 0)) - first)
    alone = new & np.append(new[1:], True)
    return e[~alone]


#: What fills a word up after its first k bytes: more than any symbol.
_FILL = np.array([(1 << 8 * (8 - k)) - 1 for k in range(9)], np.uint64)


def _sort_minima(text: np.ndarray, padded: np.ndarray, star: np.ndarray, cap: int, folder: Folder) -> tuple[np.ndarray, np.ndarray]:
    """The S* suffixes in order up to ``cap`` bytes, and the common prefix of each with the one before."""
    n = len(star)
    words = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(padded) - 7,), (1,))  # eight bytes from every place
    rank = folder.array(n, np.int64)
    open_ = np.arange(n)
    size = np.append(star[1:], len(text) - 1) - star + 1
    for depth in range(0, min(int(size.max()), cap + 8), 8):  # names: by the symbols of each substring
        word = words[np.minimum(star[open_] + depth, len(text))].byteswap()
        word |= _FILL[np.clip(size[open_] - depth, 0, 8)]  # a substring follows all that go on
        open_ = _refine(rank, open_, word)
        if not len(open_):
            break
    ahead = 1
    while len(open_) and ahead * 2 <= cap:  # a substring takes two symbols at least
        follow = open_ + ahead
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        open_ = _refine(rank, open_, second, n)
        ahead *= 2
    order = star[np.argsort(rank)]
    link = np.zeros(n, np.uint8)
    live = np.arange(1, n)
    for depth in range(0, cap, 8):
        differ = words[np.minimum(order[live - 1] + depth, len(text))] ^ words[np.minimum(order[live] + depth, len(text))]
        low = (differ & (~differ + np.uint64(1))).astype(float)  # the lowest bit set is in the first byte that differs
        same = np.where(differ == 0, 8, (np.frexp(low)[1] - 1) // 8)
        link[live] = np.minimum(depth + same, cap)
        live = live[differ == 0]
        if not len(live):
            break
    return order, link


def _leading(text: np.ndarray, pos: int, cap: int) -> int:
    """How often a suffix repeats its first symbol."""
    part = text[pos:pos + cap]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def suffixes(text: np.ndarray, cap: int, folder: Folder, block: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in falling order, in blocks of (suffix, common prefix with the one before in that order, up to ``cap``).

    ``text`` ends with END, which no string holds.
    """
    n = len(text)
    padded = np.append(text, np.zeros(16, np.uint8))
    is_s = _types(text)
    star = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    del is_s
    order, star_link = _sort_minima(text, padded, star, cap, folder) if len(star) else (star, np.zeros(0, np.uint8))
    cuts = np.searchsorted(text[order], np.arange(257))
    low = Spool(folder)
    induce = _Inducer(text, low, cap)
    induce.push(np.array([n]), np.zeros(1, np.uint8), lambda b: b >= 0)
    for c in range(256):
        at = 0
        last = None
        while at < low.total[c]:
            pos, link = low.get(c, at, min(low.total[c], at + block))
            at += len(pos)
            last = int(pos[-1])
            induce.push(pos, link, lambda b: b >= c)
        for a in range(cuts[c], cuts[c + 1], block):
            b = min(a + block, cuts[c + 1])
            link = star_link[a:b].copy()
            if a == cuts[c]:
                link[0] = 0 if last is None else min(_leading(text, last, cap), _leading(text, int(order[a]), cap))
            induce.push(order[a:b], link, lambda x: x >= c)
    high = Spool(folder)
    induce = _Inducer(text, high, cap)
    for c in range(255, -1, -1):
        at = 0
        last = None
        while at < high.total[c]:
            pos, link = high.get(c, at, min(high.total[c], at + block))
            at += len(pos)
            last = int(pos[-1])
            yield pos, link
            induce.push(pos, link, lambda b: b <= c)
        carried = None  # link of the first of the next block: that of the last one taken out to the one below it
        for b in range(low.total[c], 0, -block):
            a = max(b - block, 0)
            pos, own = low.get(c, a, b)
            pos, own = pos[::-1], own[::-1]
            link = np.append(np.uint8(0), own[:-1])
            if carried is not None:
                link[0] = carried
            elif last is not None:
                link[0] = min(_leading(text, last, cap), _leading(text, int(pos[0]), cap))
            carried = own[-1]
            yield pos, link
            induce.push(pos, link, lambda x: x < c)


def equal_classes(text: np.ndarray, cap: int, memory: int = 1 << 24, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(class, suffix) of every suffix that shares its first ``cap`` symbols with another one; a class is numbered from 0."""
    numbers, found, count, before = [], [], -1, -1
    inside = False  # the last suffix belongs to a class
    with Folder(memory) as folder:
        if len(text) > memory:
            mapped = folder.array(len(text), np.uint8)
            mapped[:] = text
            text = mapped
        for pos, link in suffixes(text, cap, folder, block):
            same = link >= cap
            previous = np.append(before, pos[:-1])
            starts = same & ~np.append(inside, same[:-1])
            number = count + np.cumsum(starts)
            numbers += [number[starts], number[same]]
            found += [previous[starts], pos[same]]
            count, before, inside = int(number[-1]), int(pos[-1]), bool(same[-1])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(numbers), np.concatenate(found)
