"""Benchmark items too short to align, against a plain search."""

import random
from collections import Counter

import pytest

from cellframe.llm import decontaminate
from tests.llm.conftest import prose


def plain(text):
    return [w.decode() for w in decontaminate.plain_words(text)]


def test_short_items_against_a_plain_search(spark):
    rng = random.Random(8)
    items = ["quartz", "the", "the of", "Blue quartz!", "of the", "zeta eta theta iota", "the of and", "quartz", "...", None, "very unusual phrase"]
    rows = [(i, prose(rng, 300)) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate([
        "the", "The.", "the of", "of the", "the of and", "quartz", "a quartz b", "x blue QUARTZ y", "blue quartz", "zeta eta theta iota",
        f"{prose(rng, 40)} zeta, eta; theta iota {prose(rng, 40)} zeta eta theta iota", "zeta eta theta", "the of and the of and " * 50, "",
        f"a very unusual phrase {prose(rng, 900)}", None,
    ])]
    words = {i: plain(t) for i, t in rows}
    count = Counter(w for ws in words.values() for w in ws)
    total = sum(count.values())
    want, anywhere = {}, set()
    for k, item in enumerate(items):
        w = plain(item)
        chance = 1.0
        for x in w:
            chance *= max(count[x] / total, 1e-12)
        for i, ws in words.items():
            at = [a for a in range(len(ws) - len(w) + 1) if ws[a:a + len(w)] == w] if w else []
            if at and (len(ws) == len(w) or chance <= decontaminate.RATE):
                want[i, k] = (at[0], at[0] + len(w))
                anywhere |= {k} if len(ws) > len(w) else set()
    assert {5, 10} <= anywhere and 1 not in anywhere and (100, 1) in want  # both kinds occur
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for options in ({}, {"block_words": 3}):
        got = decontaminate.contaminated(docs, bench, **options).collect()
        assert {(r["doc_id"], r["item_id"]): (r["start_word"], r["end_word"]) for r in got} == want
        assert all(r["score"] == 1.0 for r in got) and len(got) == len(want)
    left = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert left == set(words) - {i for i, _ in want}


def test_a_column_of_the_result_is_not_overwritten(spark):
    docs = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, Hits int")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    with pytest.raises(ValueError):
        decontaminate.with_hits(docs, bench, "hits")
    assert decontaminate.drop_contaminated(docs, bench).columns == ["doc_id", "text", "Hits"]
