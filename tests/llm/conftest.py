import random
from pathlib import Path

import pytest

WORDS = "the of and ember river stone quiet lantern harbour meadow copper violet thunder willow Granite falcon".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def messy_texts(seed: int = 11) -> list[str | None]:
    """Nulls, empty and blank texts, copies, near copies, shared passages, repeated lines, odd characters, one very long text."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(30, 160)) for _ in range(12)]
    shared = prose(rng, 60)
    out: list[str | None] = [None, "", " \n\t ", "one", "two words", "a b c d e", *base, base[0], base[0], base[3], None, ""]
    for t in base[:4]:
        w = t.split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    out += [f"{base[5]}\n{shared}\n{prose(rng, 30)}", f"{shared} {prose(rng, 25)}", f"{prose(rng, 8)}  {shared}"]
    out += ["same line here\n" * 12, "ab " * 300, "x" * 700, "é漢字😀 ünïcode text   end", "A\x00B \x1c c\x85d", "  lead and trail  "]
    out.append(prose(rng, 9000) + " " + shared)
    out += [base[1].upper(), "$$$ ### " * 30, "Shout!! " * 30]
    return out


@pytest.fixture(scope="session")
def texts():
    return messy_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The messy texts with ids, a language, and columns whose names the operators use inside."""
    rows = [(i, t, "en" if i % 3 else "xx", "src", None if t is None else len(t), "keep", i) for i, t in enumerate(texts)]
    names = "doc_id long, text string, lang string, source string, n_chars long, _key string, spans int"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def sf_small() -> str:
    return str(Path("/root/testdata/sf0.001"))
