"""Main text of web pages: the maximum-scoring subsequence of words and tags.

A page is a row of tokens. A word scores the share of words of its kind that lie in main text, a tag minus ``TAG`` times
the share of tags of its kind that lie outside; both shares are learned from the pages that label themselves: those whose one
``article`` or ``main`` element marks the content. The kind of a word is the element it stands in, whether that is a link, and
whether an element around it is a menu, form, advert, comment list or the like by name (an aside): such an element is one tag, and what it holds scores
nothing. One linear scan finds the best contiguous
region, and its blocks are the text, but for those of such elements.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from cellframe.llm import common
from cellframe.llm.registry import query

#: Cost of a tag that never stands in main text, in words.
TAG = 3.25
#: Share of main text of kinds that the labelled pages hold rarely, and how many tokens that assumption is worth.
PRIOR = {"text": 0.8, "link": 0.2, "open": 0.8, "tag": 0.9}
PRIOR_INLINE = 0.95
WEIGHT = 20.0

# Element names of the HTML standard by their part here.
_RAW = "script|style|title|textarea|iframe|noembed|noframes|xmp|template|svg|math"
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_OPTIONAL_END = frozenset("p li dt dd tr td th thead tbody tfoot option html body head".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
_CONTENT = frozenset(("article", "main"))
_ASIDE_TAGS = frozenset("nav footer aside form menu dialog button select noscript head search".split())
_ASIDE_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert form menu menubar".split())
_ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain overlay "
    "pager pagination paywall popup promo promoted promotion recommended related replies respond share sharing sidebar signup "
    "skip social sponsor sponsored sponsors subscribe subscription taboola tags toc toolbar topbar widget widgets".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\s(hidden)(?=[\s=/]|\Z)""", re.I)
_NAME = re.compile(r"[a-z0-9]+")


def _is_aside(tag: str, attrs: str, in_content: bool) -> bool:
    if tag in _ASIDE_TAGS or tag == "header" and not in_content:
        return True
    if not attrs or tag in ("body", "html", "article", "main"):
        return False
    for name, value, hidden in _ATTR.findall(attrs):
        if hidden:
            return True
        parts = set(_NAME.findall(value.lower()))
        if parts & (_ASIDE_ROLES if name.lower() == "role" else _ASIDE_NAMES):
            return True
    return False


def tokens(page: str | None) -> list[tuple[str, str, int, bool]]:
    """(kind, text, words, in content) of the page's tokens in order; a tag has no words, and its text marks a new block.

    Kinds: ``tag name`` for tags, ``open name`` for one that begins an aside, ``text name`` or ``link name`` for the text within an
    element, and ``aside`` for all that an aside holds.
    """
    out: list[tuple[str, str, int, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # element, within an aside, within content
    at = 0

    def text(piece: str) -> None:
        if not piece or piece.isspace():
            if piece:
                out.append(("aside", " ", 0, False))
            return
        name, aside, content = stack[-1] if stack else ("", False, False)
        n = len(piece.split())
        link = any(s[0] == "a" for s in stack)
        kind = "aside" if aside else f"link {name}" if link else f"text {name}"
        out.append((kind, piece, n, content and not aside))

    page = page or ""
    for m in _TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            if m["raw"] and not (stack and stack[-1][1]):
                out.append((f"tag {m['raw'].lower()}", "", 0, bool(stack) and stack[-1][2]))
            continue
        tag = tag.lower()
        _, aside, content = stack[-1] if stack else ("", False, False)
        kind = "aside" if aside else f"tag {tag}"
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in _VOID and tag not in _OPTIONAL_END and not m["attrs"].rstrip().endswith("/"):
            own = tag in _CONTENT
            begins = not own and _is_aside(tag, m["attrs"], content)
            stack.append((tag, aside and not own or begins, content or own))
            kind = f"tag {tag}" if own else "aside" if aside else f"open {tag}" if begins else kind
        elif tag == "head":
            stack.append(("head", True, False))
        elif tag == "body":
            stack.clear()
        out.append((kind, "\n" if tag in _BLOCKS else " " if tag == "br" else "", 0, content and not aside))
    text(page[at:])
    return out


def learn(pages: DataFrame) -> dict[str, tuple[int, int]]:
    """Per kind how many tokens (words, for text) lie in the content of the pages that mark it, and how many outside.

    All pages with one ``article`` or ``main`` element count. Only names of the HTML standard become kinds of their own, so what
    comes back to the driver is bounded.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: Counter = Counter()
        outside: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                found = tokens(page)
                if sum(k in ("tag article", "tag main") for k, *_ in found) not in (1, 2):
                    continue
                for kind, _, n, content in found:
                    if kind != "aside":
                        (inside if content else outside)[_known(kind)] += n or 1
        kinds = sorted({*inside, *outside})
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), *(pa.array([c[k] for k in kinds], pa.int64()) for c in (inside, outside))],
            ["kind", "inside", "outside"],
        )

    rows = pages.select("html").mapInArrow(common.tidy(count), "kind string, inside bigint, outside bigint")
    sums = rows.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return {r["kind"]: (r["inside"], r["outside"]) for r in sums}


_STANDARD = _BLOCKS | _VOID | frozenset(
    "a abbr audio b big button canvas cite code em font i label mark object picture q s small span strong sub sup time tt u var video".split()
) | frozenset(_RAW.split("|"))


_STRUCTURE = _BLOCKS - frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre article main".split())


def _known(kind: str) -> str:
    group, _, name = kind.partition(" ")
    return f"{group} {name if name in _STANDARD else ''}"


class Scores(dict):
    """Score of a kind: a word's or a tag's."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        super().__init__()
        self.counts = counts

    def __missing__(self, kind: str) -> float:
        kind = _known(kind)
        inside, outside = self.counts.get(kind, (0, 0))
        group = kind.partition(" ")[0]
        prior = PRIOR_INLINE if group == "tag" and kind[4:] not in _STRUCTURE else PRIOR[group]
        share = (inside + WEIGHT * prior) / (inside + outside + WEIGHT)
        # an advert in the middle of an article is no reason to end it: an aside costs half a tag
        cost = TAG * (1 - share) / (2 if group == "open" else 1)
        self[kind] = value = share if group in ("text", "link") else -cost - 0.01
        return value


def main_text(page: str | None, scores: Scores) -> str:
    """Text of the best region; empty if there is none."""
    found = tokens(page)
    best = total = 0.0
    start = lo = hi = 0
    for i, (kind, _, n, _) in enumerate(found):
        if kind == "aside":
            continue
        value = scores[kind] * (n or 1)
        if total <= 0:
            total, start = 0.0, i
        total += value
        if total > best:
            best, lo, hi = total, start, i + 1
    blocks, parts = [], []
    for kind, piece, n, _ in found[lo:hi]:
        if piece == "\n" and not n:
            blocks.append(parts)
            parts = []
        elif not n or kind != "aside":
            parts.append(piece)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in [*blocks, parts])
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, counts: dict[str, tuple[int, int]]) -> DataFrame:
    """``pages`` with text and n_chars (code points) of ``html``; null and empty pages have an empty text. No shuffle."""

    def run(texts, scores=Scores(counts)):
        found = [main_text(t, scores) for t in texts]
        return [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]

    return common.with_columns(pages, "html", [("text", StringType()), ("n_chars", LongType())], run)


@query("op7_html_main_text")
def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages, learn(pages)).drop("html")
