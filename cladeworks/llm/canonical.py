"""Visually identical text with different characters: one consistent form.

Most text is stable: normalisation leaves it alone. The quick-check properties of the
characters tell where it is not; only these segments, with the character before them as
context, are normalised, and the results are spliced into the unchanged rest.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata as ud
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread, table

#: Same shapes to which the confusables data gives another prototype, because they are like two
#: letters or because the data compares fonts rather than letters.
MORE_SHAPES = {"ӏ": "l", "Ԛ": "Q", "յ": "j", "ꓲ": "I"}
#: Blocks of phonetic letters, which have Latin names but are an alphabet of their own.
PHONETIC = ((0x0250, 0x02AF), (0x1D00, 0x1DBF), (0xAB30, 0xAB6F))
#: Characters without a width that are not format characters.
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍᠏ㅤﾠ"
#: Format characters that are drawn.
DRAWN = "؀؁؂؃؄؅۝܏࢐࢑࣢\U000110bd\U000110cd"


def _invisible(c: str) -> bool:
    n = ord(c)
    kind = ud.category(c)
    return (
        kind == "Cf" and c not in DRAWN
        or c in INVISIBLE or 0xFE00 <= n <= 0xFE0F or 0xE0100 <= n <= 0xE01EF
        or kind == "Cc" and not c.isspace()
    )


def alphabet(c: str) -> str:
    n = ord(c)
    if any(a <= n <= b for a, b in PHONETIC):
        return "PHONETIC"
    return ud.name(c, "").split(" ")[0]


def _letter(c: str) -> bool:
    return ud.category(c) in ("Lu", "Ll", "Lo")


def same_shapes(prototypes: Callable[[list[str]], list[str]]) -> dict[str, str]:
    """Letters of all alphabets and the letter of another alphabet that has the same shape.

    prototypes: for each character the prototype that the Unicode confusables data (UTS #39) has for it.
    A letter goes to the ASCII letter with its prototype, of two (I and l) to the one of its case, or else to its
    prototype if that is one letter in either case. Only letters of different alphabets are brought together: I, l and
    1, O and 0, rn and m stay apart, and so do letters of one alphabet.
    """
    plain = [chr(n) for n in range(0x41, 0x7B) if chr(n).isalpha()]
    # ideographs are prototypes of letters, but no letter is a prototype of an ideograph; parts of Hangul syllables
    # must stay what they are
    other = [
        c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1)])
        if _letter(c) and not ud.name(c, "").startswith(("CJK", "HANGUL")) and ud.is_normalized("NFKD", c)
    ]
    found = prototypes([*plain, *other])
    latin: dict[str, list[str]] = {}
    for c, p in zip(plain, found):
        latin.setdefault(p, []).append(c)
    out = {}
    for c, p in zip(other, found[len(plain) :]):
        if p in latin:
            case = str.isupper if ud.category(c) == "Lu" else str.islower
            to = next(filter(case, latin[p]), latin[p][0])
        elif len(p) == 1 and _letter(p):
            to = p
        else:
            continue
        if alphabet(c) != alphabet(to) and len(to.casefold()) == 1:
            out[c] = to
    return out | MORE_SHAPES


def icu_prototypes(chars: list[str]) -> list[str]:
    """Prototypes by the confusables data in the ICU library that Spark brings along."""
    from pyspark import SparkContext

    context = SparkContext._active_spark_context
    if context is None:
        raise RuntimeError("look-alike letters are read from Spark's JVM: start a session on this driver first")
    checker = getattr(context._jvm, "com.ibm.icu.text.SpoofChecker$Builder")().build()
    return checker.getSkeleton("\n".join(chars)).split("\n")


@cache
def shapes() -> dict[str, str]:
    return same_shapes(icu_prototypes)


@cache
def tables() -> tuple[dict[int, str], str]:
    """(what single characters become after decomposition, the class of unstable characters as ranges)."""
    small = {ord(a): b for a, b in shapes().items()}
    joins = set(map(chr, [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]))
    chars = [chr(n) for n in range(sys.maxunicode + 1) if not 0xD800 <= n < 0xE000]
    for c in chars:
        if _invisible(c):
            small[ord(c)] = ""
        elif ud.category(c) == "Zs":
            small[ord(c)] = " "
        parts = ud.decomposition(c)
        if parts and parts[0] != "<" and " " in parts:
            joins.add(chr(int(parts.split()[1], 16)))
    del small[0x20]
    unstable = [
        ord(c) for c in chars
        if ord(c) in small or ud.combining(c) or c in joins or not ud.is_normalized("NFKC", c)
        or (d := ud.normalize("NFKD", c)) != c and any(ord(x) in small for x in d)
    ]
    ranges, first = [], None
    for n, after in zip(unstable, [*unstable[1:], -1]):
        first = n if first is None else first
        if after != n + 1:
            ranges.append(f"\\U{first:08x}-\\U{n:08x}")
            first = None
    return small, "".join(ranges)


def _settle(small: dict[int, str]) -> Callable[[str], str]:
    def settle(text: str) -> str:
        return ud.normalize("NFC", ud.normalize("NFKD", text).translate(small))

    return settle


class _Segments(dict):
    """The consistent form of segments, short ones remembered for a bounded number."""

    def __init__(self, made: tuple[dict[int, str], str]):
        super().__init__()
        self.settle, self.runs = _settle(made[0]), re.compile(f"[{made[1]}]+")

    def __missing__(self, segment: str) -> str:
        out, done = [], 0
        for m in self.runs.finditer(segment):
            first = max(m.start() - 1, done)
            out += segment[done:first], self.settle(segment[first : m.end()])
            done = m.end()
        made = "".join(out) + segment[done:] if done else segment
        if len(segment) <= 32:
            if len(self) >= 200_000:
                self.clear()
            self[segment] = made
        return made


#: All but ASCII, and its control characters that are no white space.
_ODD = re.compile(r"[^\x09-\x0d\x1c-\x7e]+")


def canonicaliser(made: tuple[dict[int, str], str]) -> Callable[[str], str]:
    """The function that brings a text into the consistent form.

    Compatibility forms, composed and combining accents, invisible characters, kinds of space
    and look-alike letters are made one; case, punctuation, accents, line breaks, tabs and the
    number of spaces stay. A stable character starts afresh: nothing before it can change it, so
    one stable character before an unstable run is context enough. All ASCII is stable, so unstable
    characters are looked for only in stretches of other characters, with the one before them.
    """
    segments = _Segments(made)

    def canonical(text: str) -> str:
        out, done = [], 0
        for m in _ODD.finditer(text):
            first = max(m.start() - 1, done)
            out += text[done:first], segments[text[first : m.end()]]
            done = m.end()
        return "".join(out) + text[done:] if done else text

    return canonical


def canonical_texts(documents: DataFrame) -> DataFrame:
    """(doc_id, canonical): every document's text in the consistent form; null stays null, empty stays empty.

    Rows are neither added nor lost; texts of any length are treated whole; further columns are ignored.
    """
    made = tables()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = canonicaliser(made)
        for b in batches:
            out = [t if t is None else canonical(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["doc_id", "canonical"])

    return spread(documents.select("doc_id", "text"), "doc_id").mapInArrow(run, "doc_id bigint, canonical string")


def looks(documents: DataFrame) -> DataFrame:
    """(doc_id, look, own): 128-bit digests of the consistent form and of the text itself.

    Null texts and texts without a visible character are left out.
    """
    made = tables()

    def digest(x: str) -> bytes:
        return hashlib.blake2b(x.encode(), digest_size=16).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = canonicaliser(made)
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t and (c := canonical(t)).strip():
                    own = digest(t)
                    rows.append((i, own if c == t else digest(c), own))
            cols = zip(*rows) if rows else ((), (), ())
            types = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], ["doc_id", "look", "own"])

    return spread(documents.select("doc_id", "text"), "doc_id").mapInArrow(run, "doc_id bigint, look binary, own binary")


def same_look(documents: DataFrame) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: documents that look the same but differ in characters.

    Exact copies form one class; pairs are made between classes of one look and only then
    spread over their members, so copies are never compared with each other. Rows repeated whole
    count once; null ids give nothing.
    """
    docs = cut(looks(documents.where("doc_id is not null")).distinct())
    classes = docs.select("look", "own").distinct()
    varied = classes.groupBy("look").count().where("count > 1").select("look")
    classes = cut(classes.join(varied, "look", "left_semi"))
    pairs = classes.withColumnRenamed("own", "x").join(classes.withColumnRenamed("own", "y"), "look").where("x < y")
    members = docs.join(classes, ["look", "own"], "left_semi").select("doc_id", "own")
    out = (
        pairs.select("x", "y")
        .join(members.withColumnsRenamed({"own": "x", "doc_id": "i"}), "x")
        .join(members.withColumnsRenamed({"own": "y", "doc_id": "j"}), "y")
    )
    return out.select(F.least("i", "j").alias("doc_id_a"), F.greatest("i", "j").alias("doc_id_b")).where("doc_id_a < doc_id_b")


def p8_found(spark, sf_dir):
    """Pairs of documents that look the same but differ in characters."""
    return same_look(table(spark, sf_dir, "documents"))


def p8_canonical(spark, sf_dir):
    """Every document's text in the consistent form."""
    return canonical_texts(table(spark, sf_dir, "documents"))
