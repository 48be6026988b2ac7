import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from cellframe.llm import bpe, packing

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_digests_match_the_library(docs, texts):
    enc = reference()
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.digests(docs, PATH, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (t or "").encode())]
        assert got[i] == (len(ids), *sha), t


def test_offsets_cover_every_character(docs, texts):
    for r in bpe.encode(docs.drop("spans"), PATH, P.PATTERN, offsets=True).collect():
        n = len(r["text"] or "")
        covered = {c for a, b in zip(r["starts"], r["ends"]) for c in range(a, b)}
        assert covered == set(range(n)) and all(a < b for a, b in zip(r["starts"], r["ends"]))
        assert r["source"] == "src"


def test_forgetting_changes_nothing(texts, monkeypatch):
    own = bpe.Encoder(bpe.Vocabulary(PATH), P.PATTERN)
    want = [own.encode([t]) for t in texts]
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    got = [own.encode([t]) for t in texts]
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(want, got))


def test_random_texts_against_the_library():
    """White space in all places, NULs, and stretches that are known from texts in which they stood elsewhere."""
    enc, own, rng = reference(), bpe.Encoder(bpe.Vocabulary(PATH), P.PATTERN), random.Random(5)
    alphabet = " \n\t.,'a1é漢\x00\x85\x1c_"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(6000)]
    made += ["x\n", "x\n b", " x\n", "a x\n", "a x\n b", "x\n", "\x00x\n", "f b", " f b", "m  b", " m b"]
    for order in (made, made[::-1]):
        for k in range(0, len(order), 50):
            flat, counts = own.encode(order[k:k + 50])
            assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [enc.encode_ordinary(t) for t in order[k:k + 50]]


@pytest.mark.parametrize("pattern", [r"[A-Z]?[a-z]+|[A-Z]+|[^A-Za-z]", r"\s+|(\w)|[^\w\s]+"])
def test_another_pattern_is_matched_over_whole_texts(spark, texts, pattern):
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    given = [*texts, "fooBar camelCase HTTPServer", "a  b"]
    table = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    for r in bpe.encode(table, PATH, pattern).collect():
        assert r["ids"] == enc.encode_ordinary(r["text"] or "")


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(empty, PATH, P.PATTERN).count() == 0
    assert packing.pack(empty, PATH, P.PATTERN, 50_256).count() == 0


def test_packing_is_lossless_and_within_length(docs, texts):
    enc = reference()
    packed = packing.pack(docs, PATH, P.PATTERN, 50_256, length=64, batch_ids=3000).cache()
    for r in packed.collect():
        cu = r["cu_seqlens"]
        assert cu[0] == 0 and cu[-1] == r["n_tokens"] <= 64 and len(r["ids"]) == len(r["positions"]) == 4 * 64
        assert len(r["doc_ids"]) == len(r["doc_starts"]) == len(cu) - 1
        place = memoryview(r["positions"]).cast("i").tolist()
        assert place[: cu[-1]] == [k for a, b in zip(cu, cu[1:]) for k in range(b - a)]
    ids = [r["pack_id"] for r in packed.collect()]
    again = packing.pack(docs, PATH, P.PATTERN, 50_256, length=64, batch_ids=3000)
    assert sorted(ids) == sorted(r["pack_id"] for r in again.collect()) and len(set(ids)) == len(ids)
    rate = packing.fill_rate(packed).first()
    assert rate["rows"] == len(ids) and 0.9 < rate["fill"] == rate["n_tokens"] / (64 * len(ids)) <= 1
    back: dict[int, dict[int, list[int]]] = {}
    for r in packing.unpack(packed).collect():
        back.setdefault(r["doc_id"], {})[r["first"]] = r["ids"]
    for i, t in enumerate(texts):
        ids = [x for k in sorted(back[i]) for x in back[i][k]]
        assert ids == [*enc.encode_ordinary(t or ""), 50_256]


def test_best_fit_decreasing_against_a_plain_search():
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(200):
        length = int(rng.choice([1, 2, 7, 16, 64]))
        sizes = rng.integers(1, length + 1, rng.integers(0, 50))
        rows: list[list[int]] = []
        for s in np.argsort(-sizes, kind="stable"):
            free = [(length - sum(sizes[j] for j in r), k) for k, r in enumerate(rows)]
            fits = [x for x in free if x[0] >= sizes[s]]
            rows[min(fits)[1]].append(s) if fits else rows.append([s])
        got = packing.best_fit_decreasing(sizes, length)
        assert sorted(j for r in got for j in r) == list(range(len(sizes)))
        assert sorted(sum(sizes[j] for j in r) for r in got) == sorted(sum(sizes[j] for j in r) for r in rows)
