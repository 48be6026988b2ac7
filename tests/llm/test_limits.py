"""Sizes beyond those of the other tests' tables."""

import numpy as np

from cellframe.llm import suffix


def test_union_of_ranges_in_more_documents_than_fit_23_bits():
    n = (1 << 23) + 3
    doc = np.arange(n, dtype=np.int64)
    a, b = doc % 5, doc % 5 + 100
    got = suffix._union(doc, a, b)
    assert all((x == y).all() for x, y in zip(got, (doc, a, b)))


def test_union_of_ranges_in_very_long_texts():
    top = (1 << 31) - 1
    doc = np.repeat(np.arange(300_000, dtype=np.int64), 2)
    a, b = np.tile([0, top - 50], 300_000), np.tile([10, top], 300_000)
    got = suffix._union(doc, a, b)
    assert all((x == y).all() for x, y in zip(got, (doc, a, b)))
    assert [x.tolist() for x in suffix._union(np.array([7, 7, 9]), np.array([3, 0, 2]), np.array([9, 3, 5]))] == [[7, 9], [0, 2], [9, 5]]
