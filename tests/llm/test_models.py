"""Operators with fitted models: quality cutoffs, language, main text, language model, benchmark copies, and the pipeline."""

import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellframe.llm import common, decontaminate, html, langid, lm, quality, registry, substring
from llm.conftest import prose

SPACES = " \t\n\x0b\x0c\r"


def collected(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


# quality rules


def brute_counts(text):
    t = text or ""
    words = t.encode().split()
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if line.strip(SPACES):
            dup += line in seen
            seen.add(line)
    return (
        len(words), sum(c not in SPACES for c in t), sum(c in "#*$%&|<>" for c in t), dup, len(covered),
    )


def test_counts(docs, texts):
    got = collected(quality.add_counts(docs.select("doc_id", "text")).drop("text"))
    for i, t in enumerate(texts):
        assert got[i][:5] == brute_counts(t), t


def test_repeats_beyond_packed_keys():
    words = [str(i).encode() for i in range(7000)]
    assert quality._repeated(words) == 0
    assert quality._repeated(words + words[100:106]) == 12


def test_binomial_bound_is_exact():
    for k, n, delta in ((0, 100, 0.05), (3, 200, 0.01), (10, 40, 0.2)):
        p = quality.binomial_upper(k, n, delta)
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert tail == pytest.approx(delta, rel=1e-6)
    assert quality.binomial_upper(0, 100, 0.05) == pytest.approx(1 - 0.05 ** 0.01)
    assert quality.binomial_upper(5, 5, 0.05) == quality.binomial_upper(0, 0, 0.05) == 1.0


def quality_case(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(3000):
        bad = i % 6 == 0
        text = prose(rng, 25)
        if bad:
            text = " ".join(w + "###" for w in text.split()) if i % 4 else text.upper().replace(" ", "!! ")
        rows.append((i, text, "en" if i % 10 else None))
        labels.append((i, 0 if bad else 1))
    labels += [(None, 0), (5, None), (7, 1)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels),
    )


def test_certified_cutoffs(spark):
    docs, labels, truth = quality_case(spark)
    got = collected(quality.quality(docs, labels).select("doc_id", "kept", "base_failed"))
    assert len(got) == 3000 and not any(v[1] for v in got.values())
    in_english = [i for i in got if i % 10]
    assert np.mean([not got[i][0] for i in in_english if truth[i] == 1]) <= 0.01
    assert np.mean([not got[i][0] for i in in_english if truth[i] == 0]) > 0.95
    # too few labels in the other stratum: nothing can be certified there
    assert all(got[i][0] for i in got if not i % 10)


def test_cutoffs_match_a_plain_computation(spark):
    docs, labels, truth = quality_case(spark)
    counts = quality.add_counts(docs).drop("text")
    cut = {r["stratum"]: r for r in quality.calibrate(counts, labels, risk=0.02).collect()}
    feats = counts.select("doc_id", "lang", *(v.alias(k) for k, v in quality.features().items())).toPandas()
    feats["good"] = feats["doc_id"].map(truth).astype(float)
    feats["tuning"] = feats["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 2 == 0)
    strata = feats["lang"].fillna("-").nunique()
    for name, part in feats.groupby(feats["lang"].fillna("-")):
        tune, test = part[part["tuning"]], part[~part["tuning"] & (part["good"] > 0)]
        rules = [(f, c) for f, cs in quality.GRID.items() for c in cs]
        good = np.array([((tune[f] >= c) & (tune["good"] > 0)).sum() for f, c in rules])
        bad = np.array([((tune[f] >= c) & (tune["good"] == 0)).sum() for f, c in rules])
        order = quality.order_rules(good, bad, int((tune["good"] > 0).sum()), 0.02)
        gone, want = np.zeros(len(test), bool), {}
        for r in order:
            f, c = rules[r]
            gone |= (test[f] >= c).to_numpy()
            if quality.binomial_upper(int(gone.sum()), len(test), 0.05 / strata) > 0.02:
                break
            want[f] = min(c, want.get(f, c))
        row = cut[None if name == "-" else name]
        assert {f: row[f"cut_{f}"] for f in quality.GRID if row[f"cut_{f}"] is not None} == want


def test_quality_of_messy_rows(spark, docs, texts):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = collected(quality.quality(docs, none).select("doc_id", "base_failed", "kept"))
    for i, t in enumerate(texts):
        n, *_, again = brute_counts(t)
        assert got[i] == (n < 10 or 100 * again > 20 * n, not (n < 10 or 100 * again > 20 * n))
    kept = quality.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == sum(v[1] for v in got.values())
    assert quality.quality(docs.limit(0), none).count() == 0


# language


def test_languages(spark):
    rng = random.Random(5)
    parts = {"aa": "tha er ing ed on".split(), "bb": "sch ung keit ei über".split(), "cc": "eau que ment ré aux".split()}

    def text(lang):
        return " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(30))

    rows = [(i, text(lang := sorted(parts)[i % 3]), lang) for i in range(300)]
    rows += [(900, None, "aa"), (901, "12 34 --", "bb"), (902, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = langid.held_out()
    model = langid.fit(docs.where(~held & F.col("lang").isNotNull()))
    assert model.langs == ["aa", "bb", "cc"]
    got = {r["doc_id"]: r for r in langid.identify(docs.drop("lang"), model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[:300])
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    # unseen words are judged by their n-grams, and words come before n-grams
    assert model.score("keitungschkeitung")[0] == "bb" and model.score("éàü")[0] in model.langs
    assert model.score("tha")[0] == "aa"
    empty = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs.drop("lang"), empty).collect()} == {"und"}


def test_language_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"w{chr(97 + i % 26)}x", "aa") for i in range(2000)], "doc_id long, text string, lang string")
    model = langid.fit(docs, sample=50)
    word = sum(k[0] == "0" for k in model.rows)
    assert 1 <= word <= 26


def test_language_model_keeps_every_word_of_the_sample(spark):
    """A language of many frequent words beside one whose words are all rare, more than 150,000 words and n-grams in all."""
    rng = random.Random(6)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(9))
    rows = []
    for i in range(300):
        own = [word("abcdefghijklm") for _ in range(80)]
        rows.append((i, " ".join(own + own), "aa"))
    rows += [(1000 + i, " ".join(word("nopqrstuvwxyz") for _ in range(40)), "bb") for i in range(20)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    want = {"0" + w for _, t, _ in rows for w in t.split()}
    want |= {f"{k}{g}" for w in [w[1:] for w in want] for k in range(1, langid.LONGEST + 1) for g in langid.grams(w, k)}
    assert len(want) > 150_000 and set(model.rows) == want


def test_language_scores_match_a_plain_model(spark):
    rows = [(1, "ab ab cd", "x"), (2, "ab ce", "y"), (3, "zz", "z")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    n = {"x": {"ab": 2, "cd": 1}, "y": {"ab": 1, "ce": 1}, "z": {"zz": 1}}
    total = {x: sum(math.log((c.get(w, 0) + 0.5) / (sum(c.values()) + 0.5 * 5)) for w in ("ab", "ab", "ce")) for x, c in n.items()}
    lang, score = model.score("ab ce ab")
    assert lang == max(total, key=total.get)
    assert score == pytest.approx(1 / sum(math.exp(v - total[lang]) for v in total.values()))


def test_language_accuracy_on_held_out_documents(spark, sf_small):
    out = registry.QUERIES["op3_language_id"](spark, sf_small).join(
        spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    share = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97


# main text

PAGE = """<!DOCTYPE html><html><head><title>No &amp; no</title><style>p{}</style></head><body class="has-sidebar">
<header><a href=/>Site</a> name</header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="ad">Buy this now please buy it</div><div class="cookie-notice">We use cookies on this site</div>
<article class="post"><header><h1>The &quot;title&quot; of it</h1></header><p>First   paragraph<br>with a break, <b>bold</b>&nbsp;and
<a href="x">a link</a>.<p>Second &lt;one&gt; 5 < 6 &#233;<script>var t="</p>";</script></p><ul><li>point</li></ul>
<form><label>Mail</label><input></form><div class="ads">More to buy</div><p>Last paragraph of the article.</p>
<section id="comments"><p>Great article, thanks for it all!</p></section></article>
<aside><p>Related things that one may read as well</p></aside><footer>&copy; someone or other</footer></body></html>"""


def test_main_text():
    want = 'The "title" of it\nFirst paragraph with a break, bold and a link.\nSecond <one> 5 < 6 é\npoint\nLast paragraph of the article.'
    assert html.main_text(PAGE, html.Scores({})) == want


def test_main_text_without_semantic_tags():
    page = PAGE.replace("article", "div").replace("<aside>", '<div class="sidebar">').replace("</aside>", "</div>")
    got = html.main_text(page, html.Scores({}))
    assert got.startswith("First paragraph") and got.endswith("Last paragraph of the div.") and "cookies" not in got and "Buy" not in got


def test_messy_pages(spark):
    rows = [
        (1, None), (2, ""), (3, "plain text only"), (4, "<"), (5, "<p>open <b>never closed"), (6, "<!-- no end <p>x"),
        (7, "<script>no end"), (8, "<p a='x>y' b=\">\">quoted</p>"), (9, "<p>" + "word " * 50_000 + "</p>"), (9, PAGE),
        (None, "<article><p>a b c</article>"),
    ]
    pages = spark.createDataFrame([(i, "u", h, "old") for i, h in rows], "page_id long, url string, html string, kind string")
    got = html.extract(pages, html.learn(pages)).collect()
    texts = {(r["page_id"], r["html"]): r["text"] for r in got}
    assert all(r["n_chars"] == len(r["text"]) and r["kind"] == "old" for r in got)
    assert texts[1, None] == texts[2, ""] == texts[7, "<script>no end"] == texts[6, "<!-- no end <p>x"] == ""
    assert texts[3, "plain text only"] == "plain text only" and texts[5, rows[4][1]] == "open never closed"
    assert texts[8, rows[7][1]] == "quoted" and len(texts[9, rows[8][1]]) == 249_999
    assert html.extract(pages.limit(0), {}).count() == 0


def test_region_is_the_best_of_all():
    """The linear scan against every contiguous region."""
    rng = random.Random(8)
    for _ in range(60):
        parts = [rng.choice(["<p>", "</p>", "<li>", "<a href=x>", "</a>", "w " * rng.randint(1, 9), "<div>", "</div>"]) for _ in range(14)]
        page = "".join(parts)
        scores = html.Scores({})
        value = [0.0 if k == "aside" else scores[k] * (n or 1) for k, _, n, _ in html.tokens(page)]
        best = max([0.0, *(sum(value[a:b]) for a in range(len(value)) for b in range(a + 1, len(value) + 1))])
        words = len(html.main_text(page, scores).split())
        assert (best > 0) == (words > 0)


# language model


def brute_lm(rows, model):
    def tokens(t):
        return [*(t or "").encode().lower().split(), None]

    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    one, two = Counter(), Counter()
    for t in train:
        w = tokens(t)
        one.update(w)
        two.update(zip([None, *w], w))
    n, v = sum(one.values()), len(one)
    out = {}
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((one[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        score = 0.0
        for a, b in zip([None, *w], w):
            k = model.weights[min(one[a].bit_length(), len(model.weights) - 1)]
            score += math.log10(k[0] * two[a, b] / max(one[a], 1) + k[1] * one[b] / n + k[2] / (v + 1))
        out[i] = (zlib.crc32(str(i).encode()) % 5 == 1, len(w), sum(one[x] > 0 for x in w), n, base, score)
    return out


def test_scores(docs, texts):
    held = common.crc_fold("doc_id", 5) == 1
    model = lm.train(lm._counts(docs, held))
    assert model.weights.sum(axis=1) == pytest.approx(1) and (model.weights > 0).all()
    want, got = brute_lm(list(enumerate(texts)), model), collected(lm.scores(docs, held))
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert got[i][:4] == w[:4] and got[i][4:] == pytest.approx(w[4:], rel=1e-9)


def test_weights_follow_the_evidence():
    cells = pd.DataFrame({"bucket": [3, 3, 7, 7], "r2": [100.0, 0.0, 2.0, 0.0], "r1": [1.0, 2.0, 50.0, 50.0], "n": [900, 100, 50, 950]})
    w = lm.learn_weights(cells)
    assert w[3][0] > 0.7 and w[7][1] > 0.8 and w.shape == (8, 3)
    p = cells[cells["bucket"] == 3]

    def gain(x):
        return (p["n"] * np.log(x[0] * p["r2"] + x[1] * p["r1"] + x[2])).sum()

    grid = [(a / 50, b / 50, 1 - (a + b) / 50) for a in range(51) for b in range(51 - a) if a + b < 50]
    assert gain(w[3]) >= max(map(gain, grid)) - 3
    assert lm.learn_weights(cells.iloc[:0]) == pytest.approx(1 / 3)


def test_model_without_training_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    got = lm.scores(df, F.lit(True)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got} == {
        (1, 3, 0, 0, 0.0), (None, 1, 0, 0, 0.0)
    }
    assert lm.scores(df.limit(0), F.lit(True)).count() == 0


# benchmark copies


def brute_align(item, passage):
    best, row = 0, [0] * (len(passage) + 1)
    for x in item:
        new = [0]
        for j, y in enumerate(passage):
            new.append(max(0, row[j] + (1 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best


def test_alignment():
    rng = np.random.default_rng(3)
    for _ in range(60):
        item = rng.integers(1, 5, rng.integers(1, 15)).astype(np.uint64)
        rows = rng.integers(1, 5, (4, rng.integers(1, 30))).astype(np.uint64)
        assert decontaminate.align(item, rows)[0].tolist() == [brute_align(item, r) for r in rows]


def leak_case():
    rng = random.Random(6)
    items = [prose(rng, rng.randint(12, 45)) for _ in range(8)] + ["the of and the of and", "short one", None]
    rows = [(i, prose(rng, 80)) for i in range(40)]
    for i, item in enumerate(items[:8]):
        w = item.split()
        edited = list(w)
        edited[3], edited[-2] = "other", "Changed!"
        del edited[6]
        rows.append((100 + i, f"{prose(rng, 30)} {item} {prose(rng, 30)}"))
        rows.append((200 + i, f"{prose(rng, 500)}\n{' '.join(edited).upper()},\n{item.lower()} {prose(rng, 5)}"))
        rows.append((300 + i, " ".join(edited)))
    return rows + [(400, None), (401, ""), (402, "a b")], items


def test_benchmark_copies(spark):
    rows, items = leak_case()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, hits string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    words = {i: [w.decode() for w in decontaminate.plain_words(t)] for i, t in rows}
    want = set()
    for k, item in enumerate(items):
        w = [x.decode() for x in decontaminate.plain_words(item)]
        if len(w) >= decontaminate.LEAST_WORDS:
            want |= {(i, k) for i in words if brute_align(w, words[i]) >= min(0.5 * len(w), 30)}
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert got.keys() == want
    for i in range(8):
        assert got[100 + i, i]["score"] == 1.0 and got[200 + i, i]["score"] == 1.0 and 0.5 <= got[300 + i, i]["score"] < 1
        span = got[100 + i, i]
        assert words[100 + i][span["start_word"]:span["end_word"]] == [w.decode() for w in decontaminate.plain_words(items[i])]
    # blocks of the benchmark give the same; clean documents stay as they are
    again = decontaminate.contaminated(docs, bench, block_words=40)
    assert {(r["doc_id"], r["item_id"]) for r in again.collect()} == want
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == set(words) - {i for i, _ in want}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


# pipeline


def test_pipeline_stages(spark, sf_small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    last = {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).collect()}
    assert last == {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, sf_small).collect()}
    assert 0 < len(last) < 200


def test_pipeline_of_messy_and_empty_documents(spark, docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, frame in (("messy", docs), ("none", docs.limit(0))):
        for p in ("labels", "benchmark"):
            spark.read.parquet(str(tmp_path / f"{p}.parquet")).write.parquet(str(tmp_path / name / f"{p}.parquet"))
        frame.write.parquet(str(tmp_path / name / "documents.parquet"))
        assert (corpus_pipeline.run(spark, str(tmp_path / name)).count() > 0) == (name == "messy")


def test_every_query_runs_on_the_smallest_tables(spark, sf_small):
    from cellframe.llm.queries import QUERIES

    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    rows = {q: f(spark, sf_small).count() for q, f in QUERIES.items() if not q.startswith(("op6", "op10", "op7", "op12"))}
    assert set(rows.values()) == {200}
    assert QUERIES["op7_html_main_text"](spark, sf_small).count() == QUERIES["op12_url_filters"](spark, sf_small).count() == 50
    assert QUERIES["op6_packed_ids"](spark, sf_small).count() > 50
    assert Path(sf_small).exists() and substring.WINDOW == 20
