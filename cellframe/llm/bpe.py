"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType, BinaryType

from cellframe.llm import common
from cellframe.llm.registry import query

#: A worker forgets its stretches of text when it knows so many, or so many characters of them; results do not depend on it.
REMEMBERED = 400_000
REMEMBERED_CHARS = 8_000_000

#: Letters in every version of Unicode, and perhaps a sign that is not white space, a letter or a number: two matches at most.
_SIGNS = ".,;:!?"
_PLAIN = re.compile(f"^[A-Za-zÀ-ÖØ-öø-ÿ]+[{_SIGNS}]?$", re.MULTILINE)
#: In front of a text's first stretch, where no blank stands, and between the matches that the library gets together.
_NUL = "\x00"


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 bytes for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """The byte strings of a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Byte strings by rank, and the byte table of the ids."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        size = max(self.ranks.values()) + 1
        self.length = np.zeros(size, np.int64)
        for t, r in self.ranks.items():
            self.length[r] = len(t)
        self.start = np.cumsum(self.length) - self.length
        self.table = np.zeros(int(self.length.sum()), np.uint8)
        for t, r in self.ranks.items():
            self.table[self.start[r]:self.start[r] + len(t)] = np.frombuffer(t, np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids; a character that was split over ids comes together again here."""
        return self.table[common.ragged(self.start[ids], self.length[ids])]

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end character of each id of one text; ids that share a split character all cover it."""
        data = self.decode(ids)
        ends = np.cumsum(self.length[ids])
        number = np.cumsum((data & 0xC0) != 0x80)  # of the character that a byte belongs to, from 1
        first = number[ends - self.length[ids]] - 1 if len(ids) else ends
        return first.astype(np.int32), (number[ends - 1] if len(ids) else ends).astype(np.int32)


class _Memory:
    """Ids of strings, by number: ``flat[start[n]:start[n] + count[n]]``."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.start, self.count, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.chars = 0

    def add(self, names: list[str], parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """``parts`` have the names' counts and ids, one after another."""
        count = np.concatenate([c for c, _ in parts]) if parts else np.zeros(0, np.int64)
        self.number.update(zip(names, range(len(self.count), len(self.count) + len(names))))
        self.chars += sum(map(len, names))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.flat = np.concatenate([self.flat, *(x for _, x in parts)])

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each has, and all of them."""
        count = self.count[numbers]
        return count, self.flat[common.ragged(self.start[numbers], count)]

    def full(self) -> bool:
        return len(self.count) > REMEMBERED or self.chars > REMEMBERED_CHARS


class Encoder:
    """The library's BPE over a vocabulary, and what it has encoded already.

    The library gets each distinct match of the pattern once, many in one call. For the public pattern texts are looked up by the
    stretches between blanks: where a single blank stands between two characters that are not white space, a match starts at the
    blank and none goes over it, so a stretch has the same ids wherever it stands. Another pattern is matched over whole texts.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import public_tokenizers
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks, char = vocabulary.ranks, _byte_alphabet()
        name = {token: "".join(char[b] for b in token) for token in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.get):
            cuts = [(token[:i], token[i:]) for i in range(1, len(token))]
            cuts = [c for c in cuts if c[0] in ranks and c[1] in ranks]
            merges += [(name[a], name[b]) for a, b in sorted(cuts, key=lambda c: (ranks[c[0]], ranks[c[1]]))]
        self.library = Tokenizer(models.BPE({name[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(_NUL, "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        ])
        self.char = dict(enumerate(char))
        self.length = vocabulary.length
        self.find = regex.compile(pattern).findall if not regex.compile(pattern).groups else None
        self.matcher = regex.compile(pattern)
        self.by_stretch = pattern == public_tokenizers.PATTERN
        self.forget()

    def forget(self) -> None:
        self.matches, self.stretches = _Memory(), _Memory()

    def _matches(self, text: str) -> list[str]:
        return self.find(text) if self.find else [m.group() for m in self.matcher.finditer(text)]

    def _library(self, joined: str, size: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of matches joined by NULs, and how many belong to each run of ``size`` bytes."""
        ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
        until = np.searchsorted(np.cumsum(self.length[ids]), np.cumsum(size)) + 1
        if until[-1] != len(ids):
            raise ValueError("the vocabulary lacks some bytes")
        return np.diff(np.append(0, until)), ids

    def _learn_matches(self, matches: list[str]) -> None:
        """Encodes matches that are not known yet."""
        together = [m for m in matches if _NUL not in m]
        parts = [
            self._library(_NUL.join(part), [len(m.encode()) for m in part]) for part in (together[a:a + 2000] for a in range(0, len(together), 2000))
        ]
        alone = [m for m in matches if _NUL in m]
        for m in alone:
            mapped = m.encode().decode("latin-1").translate(self.char)
            ids = np.array([t.id for t in self.library.model.tokenize(mapped)], np.int32)
            parts.append((np.array([len(ids)]), ids))
        self.matches.add([*together, *alone], parts)

    def _learn_plain(self, names: list[str]) -> None:
        """Encodes stretches of letters with or without a sign behind them, whose matches need no pattern to be found."""
        parts = []
        for a in range(0, len(names), 2000):
            part = names[a:a + 2000]
            joined = f" {f'{_NUL} '.join(part)}{_NUL}"
            for sign in _SIGNS:
                joined = joined.replace(f"{sign}{_NUL}", f"{_NUL}{sign}{_NUL}")
            parts.append(self._library(joined, [len(n.encode()) + 1 for n in part]))
        self.stretches.add(names, parts)

    def _ids(self, found: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each list of matches has, and all of them."""
        known = self.matches.number
        self._learn_matches([m for m in dict.fromkeys(chain.from_iterable(found)) if m not in known])
        numbers = np.fromiter(map(self.matches.number.__getitem__, chain.from_iterable(found)), np.int64)
        count, flat = self.matches.of(numbers)
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum([0, *map(len, found)])]
        return np.diff(ends), flat

    def _learn(self, names: list[str]) -> None:
        """Encodes stretches, named as ``_split`` does."""
        lines = set(_PLAIN.findall("\n".join(names)))
        self._learn_plain([n for n in names if n in lines])
        others = [n for n in names if n not in lines]
        found = []
        for name in others:
            start = name[:1]
            text = name[1:] if start == _NUL else f" {name}" if start != " " else f" {name[2:]}" if name[1] == "m" else name[2:]
            found.append(self._matches(text))
        self.stretches.add(others, [self._ids(found)])

    def _split(self, text: str) -> list[str]:
        """The names of the stretches of any text.

        A part between two blanks stands for itself and the blank in front, the first with a NUL for itself. Where a blank has white
        space beside it, parts go together; such a stretch has a blank in its name, which no part has: `` m`` in the middle, `` f``
        as the first. A text with a NUL is one stretch, `` w``.
        """
        if _NUL in text:
            return [f" w{text}"]
        parts = text.split(" ")
        out = [parts[0]]
        for x, y in zip(parts, parts[1:]):
            if x and y and not x[-1].isspace() and not y[0].isspace():
                out.append(y)
            else:
                out[-1] += f" {y}"
        odd = [" " in s or _odd(s) for s in out]
        return [f" f{out[0]}" if odd[0] else _NUL + out[0], *(f" m{s}" if o else s for s, o in zip(out[1:], odd[1:]))]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if self.matches.full() or self.stretches.full():
            self.forget()
        if not self.by_stretch:
            counts, flat = self._ids([self._matches(t) if t else [] for t in texts])
            return flat, counts
        split: list[list[str]] = []
        for t in texts:
            parts = (self._split(t) if _NUL in t else t.split(" ")) if t else []
            if parts and parts[0][:2] != " w":
                parts[0] = _NUL + parts[0]
            split.append(parts)
        known = self.stretches.number
        fresh = set(chain.from_iterable(split)).difference(known)
        odd = {p for p in fresh if not p.isalpha() and p[:1] != " " and _odd(p[1:] if p[:1] == _NUL else p)}  # never known by these names
        if odd:
            split = [parts if odd.isdisjoint(parts) else self._split(t) for t, parts in zip(texts, split)]
            fresh = set(chain.from_iterable(split)).difference(known)
        self._learn(list(fresh))
        numbers = np.fromiter(map(self.stretches.number.__getitem__, chain.from_iterable(split)), np.int64)
        count, flat = self.stretches.of(numbers)
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum([0, *map(len, split)])]
        return flat, np.diff(ends)


def _odd(part: str) -> bool:
    """Whether a part between blanks is empty or has white space at an edge, so that it can't be encoded alone."""
    return not part or part[0].isspace() or part[-1].isspace()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder; it is made once, and forgets its pieces when a task ends."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(vocabulary(path), pattern)
    return _ENCODERS[path, pattern]


def _forget() -> None:
    for e in _ENCODERS.values():
        e.forget()


common.FORGET.append(_forget)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False, ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text`` and, if asked for, the characters ``[starts[i], ends[i])`` of each id.

    ``path`` names a file of ``base64 rank`` lines that every executor can open. A null or empty text has no ids. Rows are
    independent, so repeated rows are encoded alike; no shuffle. Raises if a column of the result's names exists.
    """
    numbers = ArrayType(IntegerType(), False)
    added = [(ids, numbers), *([("starts", numbers), ("ends", numbers)] if offsets else [])]
    if clash := {n for n, _ in added} & set(df.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")

    def run(texts):
        flat, counts = encoder(path, pattern).encode(texts)
        cuts = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        out = [flat]
        if offsets:
            parts = [vocabulary(path).offsets(x) for x in np.split(flat, np.cumsum(counts)[:-1])]
            out += [np.concatenate([p[k] for p in parts]) for k in (0, 1)]
        return [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int32())) for x in out]

    return common.with_columns(df, text, added, run)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its token ids; null or empty ids give no bytes."""
    schema = StructType([*df.schema.fields, StructField(decoded, BinaryType())])

    def run(batches):
        c = vocabulary(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                col = part.column(ids)
                flat = np.asarray(col.flatten()).astype(np.int64)
                counts = np.asarray(pc.fill_null(pc.list_value_length(col), 0)).astype(np.int64)
                size = np.concatenate([[0], np.cumsum(c.length[flat])])[np.concatenate([[0], np.cumsum(counts)])]
                data = c.decode(flat).tobytes()
                out = pa.array([data[x:y] for x, y in zip(size, size[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, out], [*part.schema.names, decoded])

    return df.mapInArrow(common.tidy(run), schema)


def digest_columns() -> list[Column]:
    """n_tokens, ids_sha256 and decoded_sha256 of the columns ``ids`` and ``decoded``."""
    return [
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoding and decoding ``text``."""
    done = decode(encode(df.select("doc_id", "text"), path, pattern).drop("text"), path)
    return done.select("doc_id", *digest_columns())


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digests(common.documents(spark, sf_dir), path, public_tokenizers.PATTERN)
