"""Exact repeats, near-duplicates and components against plain single-node versions."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from cellframe.llm import components, induced, neardup, packets, substring, suffix
from llm.conftest import prose


def brute_words(rows, window):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        out[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


def brute_bytes(rows, length):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(b[i:i + length])
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def collected(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_substring(docs, texts):
    assert collected(substring.digests(docs)) == brute_words(list(enumerate(texts)), 20)


def test_substring_slices_do_not_matter(docs, texts, monkeypatch):
    monkeypatch.setattr(substring, "_SLICE", 500)
    assert collected(substring.digests(docs, 5)) == brute_words(list(enumerate(texts)), 5)


def test_substring_keeps_columns_and_untouched_texts(docs, texts):
    want = brute_words(list(enumerate(texts)), 20)
    got = substring.dedup_text(docs)
    assert got.columns == docs.columns
    for r in got.collect():
        n, gone, sha = want[r["doc_id"]]
        if not gone:
            assert r["text"] == texts[r["doc_id"]]
        else:
            words = r["text"].encode().split()
            assert len(words) == n - gone and hashlib.sha256(b" ".join(words)).hexdigest() == sha
            assert r["n_chars"] == len(r["text"])


def test_repeated_rows_and_null_ids(spark, texts):
    rows = [(1, texts[6]), (1, texts[6]), (2, texts[6]), (None, None), (None, "a " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n = len(texts[6].split())
    got = sorted((tuple(r)[:3] for r in substring.digests(df).collect()), key=str)
    assert got == sorted([(1, n, 0), (1, n, 0), (2, n, n), (None, 0, 0), (None, 30, 29)], key=str)
    size = len(texts[6])
    got = sorted((tuple(r)[:3] for r in suffix.digests(df).collect()), key=str)
    assert [g for g in got if g[0] in (1, 2)] == [(1, size, 0), (1, size, 0), (2, size, size)]


def test_suffix(docs, texts):
    assert collected(suffix.digests(docs)) == brute_bytes(list(enumerate(texts)), 100)


def test_suffix_from_disk(docs, texts, monkeypatch):
    monkeypatch.setattr(suffix, "_SLICE", 800)
    assert collected(suffix.digests(docs, 40, 16, memory=500)) == brute_bytes(list(enumerate(texts)), 40)


@pytest.mark.parametrize("memory,block", [(1 << 20, 1 << 20), (64, 7)])
def test_induced_order(memory, block):
    rng = random.Random(memory)
    for _ in range(150):
        cap = rng.choice([1, 3, 8, 20, 100])
        k, n = rng.choice([1, 3, 200]), rng.randint(1, 400)
        t = [rng.randint(0, k) for _ in range(n)]
        t = (t + t[: n // 2] + t)[:500] if rng.random() < 0.5 else t
        text = np.array([*t, induced.END], np.uint8)
        raw = text.tobytes()
        with induced.Folder(memory) as folder:
            order = np.concatenate([p for p, _ in induced.suffixes(text, cap, folder, block)]).tolist()
        assert sorted(order) == list(range(len(raw)))
        keys = [raw[i:i + cap] for i in order]
        assert all(a >= b for a, b in zip(keys, keys[1:]))
        want = defaultdict(set)
        for i in range(len(raw) - cap + 1):
            want[raw[i:i + cap]].add(i)
        got = defaultdict(set)
        for c, p in zip(*induced.equal_classes(text, cap, memory, block)):
            if p + cap <= len(raw):
                got[c].add(int(p))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def brute_components(rows, percent):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def test_near_duplicates(docs, texts):
    assert collected(neardup.near_duplicates(docs)) == brute_components(list(enumerate(texts)), 85)


def test_near_duplicates_of_a_crowded_group(spark):
    """A base text, many copies that differ from it in one word and from each other in two, and a chain away from them."""
    rng = random.Random(3)
    base = prose(rng, 120).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        w = list(base)
        w[rng.randrange(len(w))] = f"edit{i}"
        rows.append((i, " ".join(w)))
    chain = list(base)
    for i in range(150, 170):
        chain = list(chain)
        chain[(i * 37) % len(chain)] = f"chain{i}"
        rows.append((i, " ".join(chain)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(neardup.near_duplicates(df)) == brute_components(rows, 85)


@pytest.mark.parametrize("block", [256, 7])
def test_near_duplicates_of_a_template(spark, monkeypatch, block):
    """Documents on one template, each at 0.86 to one other and at 0.80 to all the rest: no region tells the partners apart."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(5)
    base = prose(rng, 404).split()
    slots = range(20, 380, 40)
    rows = []
    for i in range(800):
        w = list(base)
        for k, at in enumerate(slots):
            w[at] = f"pair{i // 2}at{k}" if k < 3 else f"own{i}at{k}"
        rows.append((i, " ".join(w)))
    got = collected(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == {i: (400, i // 2 * 2, i % 2 == 0) for i in range(800)}


def test_near_duplicates_keeps_columns(docs, texts):
    want = {d for d, v in brute_components(list(enumerate(texts)), 85).items() if v[2]}
    got = neardup.keep_first(docs)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == want


def test_near_duplicate_stage_links_at_080(spark):
    """Copies at similarities from 0.70 to 0.95 of their originals, many of them from 0.80 to 0.85."""
    import corpus_pipeline

    rng = random.Random(8)
    rows = []
    for i in range(60):
        w = prose(rng, 204).split()
        rows.append((2 * i, " ".join(w)))
        for k in range(1 + i % 7):
            w[10 + 28 * k] = f"edit{i}at{k}"
        rows.append((2 * i + 1, " ".join(w)))
    want = {percent: {d for d, v in brute_components(rows, percent).items() if v[2]} for percent in (80, 85)}
    assert want[80] < want[85]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r["doc_id"] for r in got.collect()} == want[80]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(empty).count() == 0
    assert substring.digests(empty).count() == 0
    assert suffix.digests(empty).count() == 0


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(None, 3), (5, 5)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)]
    root = {}
    for a, b in edges:
        if a is not None and a != b:
            ra, rb = root.setdefault(a, {a}), root.setdefault(b, {b})
            if ra is not rb:
                ra |= rb
                for x in rb:
                    root[x] = ra
    got = collected(components.components(spark.createDataFrame(edges, "a long, b long")))
    assert got == {x: (min(s),) for x, s in root.items()}


def test_hash_is_a_polynomial():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 60, dtype=np.uint64)
    p, base = (1 << 61) - 1, 1_113_871_470_261_530_123
    for window in (1, 2, 3, 5, 7, 20, 60):
        want = [sum(int(v) * pow(base, window - 1 - k, p) for k, v in enumerate(x[i:i + window])) % p for i in range(61 - window)]
        assert substring.rabin_karp(x, window, base).tolist() == want


def test_windows_travel_with_all_hash_bits():
    x = np.arange(256, dtype=np.uint64) << np.uint64(56)
    assert packets.from_planes(memoryview(packets.planes(x, substring._HASH_BYTES)), len(x), substring._HASH_BYTES).tolist() == x.tolist()
