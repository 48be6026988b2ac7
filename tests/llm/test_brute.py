"""Whole queries whose results SQL cannot express, against plain computations of the same definition."""

import hashlib
import html as std
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers as P
import pytest

from cellframe.llm import common, decontaminate, html, lm
from tests.llm.conftest import messy_texts, prose
from tests.llm.test_bpe import reference
from tests.llm.test_models import brute_align, brute_counts


# main text: every contiguous region


def plain_region(found, scores):
    """The best region by trying all of them: highest score, then the earliest end, then the latest start."""
    at = [i for i, f in enumerate(found) if f[0] != "aside"]
    value = [scores[found[i][0]] * (found[i][2] or 1) for i in at]
    best, where = 0.0, None
    for z in range(len(at)):
        total = 0.0
        top = None
        for a in range(z, -1, -1):
            total += value[a]
            if top is None or total > top[0]:
                top = (total, a)
        if top[0] > best + 1e-9:
            best, where = top[0], (at[top[1]], at[z] + 1)
    return best, where


def plain_text(found, where):
    lines = [[]]
    for kind, piece, n, _ in found[slice(*where)] if where else []:
        if piece == "\n" and not n:
            lines.append([])
        elif not n or kind != "aside":
            lines[-1].append(piece)
    return "\n".join(x for x in (" ".join(std.unescape("".join(b)).split()) for b in lines) if x)


class Dyadic(dict):
    """Scores that add up without rounding: words 1/8 to 7/8, tags -1/8 to -4."""

    def __init__(self, rng):
        super().__init__()
        self.rng = rng

    def __missing__(self, kind):
        word = kind.startswith(("text", "link"))
        self[kind] = value = self.rng.randint(1, 7) / 8 if word else -self.rng.randint(1, 32) / 8
        return value


def test_region_and_its_text(spark):
    rng = random.Random(9)
    parts = ["<p>", "</p>", "<li>", "<a href=x>", "</a>", "<div class=unheard-of>", "<div class='side bar'>", "<section id=box7>", "</section>", "<div>", "</div>", "<br>", "<h2>", "</h2>"]
    ties = 0
    for _ in range(400):
        page = "".join(rng.choice(parts) if rng.random() < 0.6 else f"w{rng.randint(0, 99)} " * rng.randint(1, 5) for _ in range(30))
        scores = Dyadic(rng)
        found = html.tokens(page)
        best, where = plain_region(found, scores)
        assert html.main_text(page, scores) == plain_text(found, where), page
        ties += where is None
    assert ties < 100


def test_main_text_of_the_smallest_pages(spark, sf_small):
    from cellframe.llm.queries import QUERIES

    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{sf_small}/pages.parquet").to_pylist()}
    inside, outside = Counter(), Counter()
    for page in pages.values():  # the shares, learned by a plain loop
        found = html.tokens(page)
        if sum(k in ("tag article", "tag main") for k, *_ in found) in (1, 2):
            for kind, _, n, content in found:
                if kind != "aside":
                    (inside if content else outside)[html._known(kind)] += n or 1
    scores = html.Scores({k: (inside[k], outside[k]) for k in {*inside, *outside}})
    got = {r["page_id"]: r["text"] for r in QUERIES["op7_html_main_text"](spark, sf_small).collect()}
    assert got == {i: plain_text(found, plain_region(found, scores)[1]) for i, found in ((i, html.tokens(p)) for i, p in pages.items())}


# language model: expectation-maximisation token by token, without the histogram


def plain_weights(train, rounds=200):
    """(weights by bucket, log2 likelihood a token of weights by bucket) of leave-one-out estimates."""
    one, two = Counter(), Counter()
    for w in train:
        one.update(w)
        two.update(zip([None, *w], w))
    n, v = sum(one.values()), len(one)
    rows = {}
    for w in train:
        for a, b in zip([None, *w], w):
            context = one[a] - 1
            p = ((two[a, b] - 1) / context if context > 0 else 0.0, (one[b] - 1) / (n - 1), 1 / (v + 1))
            rows.setdefault(context.bit_length(), []).append(p)
    out = {}
    for bucket, p in rows.items():
        p, w = np.array(p), np.full(3, 1 / 3)
        for _ in range(rounds):
            share = w * p
            w = ((share / share.sum(axis=1, keepdims=True)).sum(axis=0) + 1) / (len(p) + 3)
        out[bucket] = w
    likelihood = lambda weights: sum(np.log2(np.array(p) @ weights(b)).sum() for b, p in rows.items()) / n
    return out, likelihood


def test_mixture_weights_against_plain_expectation_maximisation(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [*messy_texts()]
    for _ in range(150):  # words that follow each other
        k, words = rng.randrange(300), []
        for _ in range(80):
            words.append(vocabulary[k])
            k = (k * 7 + rng.choice([1, 1, 1, 2, rng.randrange(300)])) % 300
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = lm.train(lm._counts(docs, common.crc_fold("doc_id", 5) == 1))
    train = [[*(t or "").encode().lower().split(), None] for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    want, likelihood = plain_weights(train)
    of = lambda b: model.weights[min(b, len(model.weights) - 1)]
    assert likelihood(of) >= likelihood(lambda b: want[b]) - 0.01  # bits a token
    assert likelihood(of) > likelihood(lambda b: np.full(3, 1 / 3)) + 0.1
    big = [b for b in want if sum(1 for w in train for _ in w) and b >= 4]
    assert big and all(np.abs(of(b) - want[b]).max() < 0.06 for b in big)


# the pipeline, stage by stage, without the operators


def cut_words(text, gone):
    """The text without the marked words and the white space behind each run of them."""
    at = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)] + [len(text)]
    keep = [text[:at[0]]] if len(at) > 1 else [text]
    keep += [text[at[i]:at[i + 1]] for i in range(len(at) - 1) if not gone[i]]
    return "".join(keep)


def plain_pipeline(rows, items):
    kept = {}
    for i, t in rows:  # quality: the base rules, without labels
        n, _, _, _, repeated = brute_counts(t)
        if not (n < 10 or 100 * repeated > 20 * n):
            kept[i] = t
    sets = {}
    for i, t in kept.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    root = {i: i for i in kept}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in kept:
        for j in kept:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    kept = {i: t for i, t in kept.items() if find(i) == i}
    seen = set()
    for i in sorted(kept):
        w = kept[i].encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            key = tuple(w[k:k + 20])
            if key in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(key)
        if any(gone):
            kept[i] = cut_words(kept[i], gone)
    words = [[x.decode() for x in decontaminate.plain_words(t)] for t in items]
    clean = {}
    for i, t in kept.items():
        own = [x.decode() for x in decontaminate.plain_words(t)]
        if not any(brute_align(w, own) >= min(0.5 * len(w), 30) for w in words):
            clean[i] = t
    library = reference()
    return {i: hashlib.sha256(",".join(map(str, library.encode_ordinary(t))).encode()).hexdigest() for i, t in clean.items()}


def test_pipeline_against_plain_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    base = [prose(rng, rng.randint(60, 120)) for _ in range(30)]
    shared = prose(rng, 45)
    items = [prose(rng, rng.randint(12, 25)) for _ in range(5)]
    texts = [t for t in messy_texts(12) if t is None or len(t) < 5000]
    texts += base
    for t in base[:10]:  # near copies, at similarities around the threshold
        for many in (1, 2, 3):
            w = t.split()
            for k in rng.sample(range(len(w)), many):
                w[k] = f"new{rng.randrange(999)}"
            texts.append(" ".join(w))
    texts += [f"{prose(rng, 40)}\n{shared}  {prose(rng, 30)}" for _ in range(4)]
    for item in items:
        w = item.split()
        w[3] = "edited"
        texts += [f"{prose(rng, 30)} {item} {prose(rng, 20)}", f"{prose(rng, 25)} {' '.join(w).upper()}, {prose(rng, 20)}"]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, texts[k]) for i, k in enumerate(order)]
    root = str(tmp_path)
    names = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], names).repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    got = {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, root).collect()}
    want = plain_pipeline([(i, t or "") for i, t in rows], items)
    assert got == want and 20 < len(want) < len(rows) - 30
