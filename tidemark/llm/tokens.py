"""Token counts (whole-token shortcut) and the cached encoder behind the binary token output.

Both lean on one fact about byte-level pre-tokenisation: a token never runs from a non-space character into white
space, and a single space (or newline) between two non-space characters always starts the next piece. A text whose
white space consists of such single characters therefore splits into units ("first", " second", "\\nthird") that can be
tokenised one by one. Any other text (double spaces, tabs, added special strings, characters whose class
hasn't been proved) goes to the library whole.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import lean, small_batches

#: Entries of each of the two generations of a worker's cache of ids; counts keep half as many.
CACHE = 700_000
#: Longer units, such as text without spaces, are looked up each time and not kept, which bounds the cache in bytes too.
LONGEST = 64
#: ASCII marks that may be cut from the end of a unit: the rest ends in a letter, so the marks are a piece of their own.
MARKS = ".,;:!?"


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def layout(path: str) -> dict:
    """What the shortcut needs to know of the tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    return {
        "added": tuple(x["content"] for x in spec.get("added_tokens", [])),
        "units": bool(plain and spec.get("normalizer") is None and spec.get("truncation") is None and spec.get("padding") is None),
        "vocab": spec["model"]["vocab"] if isinstance(spec["model"].get("vocab"), dict) else {},
    }


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stays, the rest moves to U+0100 and on."""
    stay = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    moved = [b for b in range(256) if b not in set(stay)]
    return {chr(b): b for b in stay} | {chr(256 + i): b for i, b in enumerate(moved)}


def prove_whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that, as a text of their own, are one pre-token and encode as exactly their own id."""
    known, tok = layout(path), library(path)
    if not known["units"]:
        return []
    alphabet, strings = byte_alphabet(), []
    for piece, i in known["vocab"].items():
        try:
            strings.append((bytes(alphabet[c] for c in piece).decode("utf-8"), i))
        except (KeyError, UnicodeDecodeError):
            continue
    split = tok.pre_tokenizer.pre_tokenize_str
    proved = []
    for at in range(0, len(strings), 4096):
        part = strings[at : at + 4096]
        encoded = tok.encode_batch_fast([s for s, _ in part], add_special_tokens=False)
        proved += [s for (s, i), e in zip(part, encoded, strict=True) if e.ids == [i] and len(split(s)) == 1]
    return proved


class Unkept(Exception):
    """A unit that can't be looked up alone; its whole text goes to the library."""


class Units(dict):
    """Splits texts into units and remembers a value for each; a lookup of a new unit computes it.

    A unit's pre-tokens are merged by the library's BPE model one by one; the pattern that finds them is used only on characters
    that the library's own pre-tokeniser has been seen to class alike (letter, digit, space, other). Values are
    kept in two generations: when the young one is full it becomes the old one, so memory stays bounded.
    """

    total = None

    def __init__(self, path: str, most: int = CACHE):
        import public_tokenizers
        import regex

        super().__init__()
        self.tok, self.known, self.most, self.old, self.ends = library(path), layout(path), most, {}, {}
        self.model, self.find = self.tok.model, regex.compile(public_tokenizers.PATTERN).findall
        self.stand_in = {b: c for c, b in byte_alphabet().items()}
        self.proved, self.refused = set(map(chr, range(128))), set()

    def start(self) -> None:
        """The values of closing marks, once the class can give values."""
        self.ends = {m: self.piece_value(m) for m in MARKS} if self.known["units"] else {}

    def split(self, text: str) -> list[str] | None:
        """Units without their leading space (the first one marked by U+0000); None: give the text to the library."""
        if not self.known["units"] or not text or "\x00" in text or any(a in text for a in self.known["added"]):
            return None
        units = text.replace("\n", " \n").split(" ")
        # a second newline is a unit of its own; longer runs, and newlines beside spaces, are pre-tokenised together
        if "" in units or "\n " in text or "\n\n\n" in text or text.endswith("\n\n"):
            return None
        units[0] = "\x00" + units[0]
        return units

    def safe(self, unit: str) -> bool:
        """Whether the pattern is proved on all characters of the unit."""
        if unit.isascii() or self.proved.issuperset(unit):
            return True
        split = self.tok.pre_tokenizer.pre_tokenize_str
        for c in set(unit) - self.proved - self.refused:
            same = all(len(split(a + c)) == len(self.find(a + c)) for a in "a1!")
            (self.proved if same else self.refused).add(c)
        return self.proved.issuperset(unit)

    def mapped(self, piece: str) -> str:
        """The piece in the printable stand-ins for its bytes."""
        if piece.isascii() and piece.isprintable():
            return piece.replace(" ", "\u0120")
        return piece.encode().decode("latin-1").translate(self.stand_in)

    def __missing__(self, unit: str):
        value = self.old.get(unit)
        if value is None:
            if unit.isalpha():
                value = self.word_value(unit)
            else:
                base, mark = unit[:-1], unit[-1]
                if mark in MARKS and base.isalpha() and self.safe(base):
                    value = self[base] + self.ends[mark]  # after a letter, a mark at the end is a pre-token of its own
                else:
                    value = self.unit_value(unit)
        if len(unit) > LONGEST:
            return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[unit] = value
        return value

    def word_value(self, word: str):
        """A word of letters after a space is one pre-token."""
        if word.isascii():
            return self.mapped_value("\u0120" + word)
        if not self.safe(word):
            return self.library_value(" " + word)
        return self.piece_value(" " + word)

    def unit_value(self, unit: str):
        text = unit[1:] if unit[0] == "\x00" else unit if unit[0] == "\n" else " " + unit
        if len(unit.split()) > 1 or unit[-1:].isspace() and unit != "\n" or unit.lstrip("\x00\n")[:1].isspace():
            raise Unkept
        if not self.safe(unit):
            return self.library_value(text)
        return self.total([self.piece_value(p) for p in self.find(text)])

    def piece_value(self, piece: str):
        return self.mapped_value(self.mapped(piece))

    def mapped_value(self, piece: str):
        """Value of a pre-token in byte stand-ins."""
        raise NotImplementedError

    def library_value(self, text: str):
        raise NotImplementedError

    def __call__(self, texts: list[str]) -> list:
        out, get, total = [], self.__getitem__, self.total
        for text in texts:
            units = self.split(text)
            try:
                out.append(self.library_value(text) if units is None else total(map(get, units)))
            except Unkept:
                out.append(self.library_value(text))
        return out


class Encoder(Units):
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    total = staticmethod(b"".join)

    def __init__(self, path: str):
        super().__init__(path)
        self.codes = [struct.pack("<I", i) for i in range(1 + max(self.tok.get_vocab().values(), default=0))]
        self.tokenize = self.model.tokenize
        self.start()

    def mapped_value(self, piece: str) -> bytes:
        codes = self.codes
        return b"".join([codes[t.id] for t in self.tokenize(piece)])

    def library_value(self, text: str) -> bytes:
        return struct.pack(f"<{len(ids := self.tok.encode(text, add_special_tokens=False).ids)}I", *ids)


class Counter(Units):
    """Token counts: pre-tokens found in `whole` count one each, only the rest is merged."""

    total = staticmethod(sum)

    def __init__(self, path: str, whole: Iterable[str]):
        super().__init__(path)
        self.most = CACHE // 2
        self.whole, self.tokenize = frozenset(map(self.mapped, whole)), self.model.tokenize
        self.start()

    def mapped_value(self, piece: str) -> int:
        return 1 if piece in self.whole else len(self.tokenize(piece))

    def library_value(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False).ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


_counters: dict[str, Counter] = {}


def counter(path: str, whole) -> Counter:
    """One counter for each worker and file; whole: a broadcast of the proved strings."""
    if path not in _counters:
        _counters.clear()
        _counters[path] = Counter(path, whole.value)
    return _counters[path]


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """df with a bigint column `out`: tokens of the whole `text` without begin, end or other added tokens.

    Null counts as the empty text (0 tokens). Special strings inside a text count as the library's default has them.
    Other columns pass through; one already named `out` is replaced. Repeated rows stay repeated, an empty table gives
    an empty one. The broadcast is bounded by the vocabulary.
    """
    small_batches(df.sparkSession)
    base = df.drop(out)
    whole = df.sparkSession.sparkContext.broadcast(prove_whole_tokens(path))
    schema = base.withColumn(out, F.lit(0).cast("bigint")).schema

    def run(batches):
        count = counter(path, whole)
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(count(texts), pa.int64())], names=[*b.schema.names, out])

    return base.mapInArrow(lean(run), schema)


def count_report(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for every document; only the two columns it needs travel.

    Null texts are empty; null doc_ids and repeated rows keep their rows; very long texts count whole; an empty table gives an empty
    result; further columns of any name are left out.
    """
    small_batches(docs.sparkSession)
    slim = docs.select("doc_id", "text")
    schema = "doc_id long, n_bytes long, n_tokens long"
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(path))

    def run(batches):
        import pyarrow.compute as pc

        count = counter(path, whole)
        for b in batches:
            text = pc.fill_null(b.column(1), "")
            sizes = pc.cast(pc.binary_length(text), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, pa.array(count(text.to_pylist()), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    counted = slim.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
