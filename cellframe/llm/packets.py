"""Arrays packed into binary columns, so that a shuffle moves blocks of numbers instead of a row for each.

Numbers are stored byte plane by byte plane: the upper planes of small numbers are runs of zeros, which the shuffle's own
compression removes.
"""

from __future__ import annotations

import numpy as np


def planes(x: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each number, all first bytes first."""
    raw = np.ascontiguousarray(x).astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    return raw[:, :width].T.tobytes()


def from_planes(data: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def pack_marks(doc: np.ndarray, pos: np.ndarray) -> bytes:
    """Marks (doc, pos), sorted by both: the documents once each, with the gaps between their positions."""
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    ids = doc[at]
    counts = np.diff(np.append(at, len(doc)))
    gaps = pos.astype(np.int64).copy()
    gaps[1:] -= np.where(new[1:], 0, pos[:-1])
    steps = ids.astype(np.int64).copy()
    with np.errstate(over="ignore"):
        steps[1:] -= ids[:-1]
    head = np.array([len(ids), len(doc)], "<i8").tobytes()
    return head + planes(steps.view("<u8"), 8) + planes(counts, 4) + planes(gaps, 4)


def unpack_marks(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(doc, pos) of each mark, and the length of the packed form."""
    view = memoryview(data)
    n_ids, n = (int(x) for x in np.frombuffer(view[:16], "<i8"))
    a, b, c = 16, 16 + 8 * n_ids, 16 + 12 * n_ids
    with np.errstate(over="ignore"):
        ids = np.cumsum(from_planes(view[a:b], n_ids, 8).view("<i8"))
    counts = from_planes(view[b:c], n_ids, 4).astype(np.int64)
    pos = np.cumsum(from_planes(view[c:c + 4 * n], n, 4).astype(np.int64))
    if n:
        first = np.cumsum(counts) - counts
        before = np.zeros(n_ids, np.int64)
        before[1:] = pos[first[1:] - 1]
        pos -= np.repeat(before, counts)
    return np.repeat(ids, counts), pos, c + 4 * n


def marks_by_group(doc: np.ndarray, pos: np.ndarray, group: np.ndarray):
    """(group, packed marks) for each group that has marks; the marks may come in any order."""
    order = np.lexsort((pos, doc, group))
    doc, pos, group = doc[order], pos[order], group[order]
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    for a, b in zip(cuts, np.append(cuts[1:], len(group))):
        yield int(group[a]), pack_marks(doc[a:b], pos[a:b])
