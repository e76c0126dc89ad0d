"""Evaluation texts leaking into training text: greedy string tiling over running Karp-Rabin hashes.

The corpus is read once. Windows of both sides are hashed; a bit table of bounded size, built from the
items' windows, lets the corpus keep only windows that may be shared; these are joined with the items'
windows, and each pair of document and item that meets is tiled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, small, spread, table
from .canonical import canonicaliser, tables

#: Consecutive words that make a match.
WORDS = 12
#: Most bytes of the bit table; with more windows more of the corpus' windows pass it and are sorted out by the join.
TABLE_BYTES = 64 << 20
#: Bits of the table for each window of the items, and how many of them a window sets.
BITS, PROBES = 64, 4
#: Most characters of item words that are sent to the executors; beyond it pairs and items are joined by a shuffle.
SENT_CHARS = 16_000_000
#: Seeds of one pair that are held at once.
SEEDS = 4_000_000
_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PART = 1 << 16


def words(text: str, canonical: Callable[[str], str]) -> list[str]:
    """Runs of letters and digits of the consistent form, case ignored.

    The form is taken again after folding, as a capital may have no look-alike where its small letter has one.
    """
    return _WORD.findall(canonical(canonical(text).casefold()))


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes, modulo 2**64, of all windows of `width` ids."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = ids.astype(np.uint64)
    x = (x ^ (x >> np.uint64(7))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _BASE + x[k : k + n]
    return out


class _Numbers(dict):
    """A 64-bit number for each word, remembered for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        n = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return n


def window_hashes(found: list[str], numbers: _Numbers, width: int) -> np.ndarray:
    return rolling(np.array(list(map(numbers.__getitem__, found)), np.uint64), width)


def _probe(h: np.ndarray, k: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(byte, bit) of the k-th probe of each hash."""
    x = h + np.uint64(k) * ((h >> np.uint64(32)) | np.uint64(1))
    x = (x ^ (x >> np.uint64(29))) & np.uint64(bits - 1)
    return (x >> np.uint64(3)).astype(np.int64), (x & np.uint64(7)).astype(np.uint8)


def passing(h: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The places of the hashes whose bits are all set."""
    at = np.arange(len(h))
    for k in range(PROBES):
        # each probe looks only at what the probes before it let through
        byte, bit = _probe(h[at], k, len(held) * 8)
        at = at[(held[byte] >> bit) & 1 > 0]
        if not len(at):
            break
    return at


def bit_table(windows: DataFrame, n: int) -> np.ndarray:
    """The bits that the hashes (h) set, made in parts on the executors and put together in blocks."""
    bits = min(1 << max(12, (n * BITS).bit_length()), 1 << (TABLE_BYTES * 8).bit_length() - 1)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 8, np.uint8)
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(PROBES):
                byte, bit = _probe(h, k, bits)
                np.bitwise_or.at(held, byte, np.left_shift(np.uint8(1), bit))
        for k in range(0, len(held), _PART):
            if held[k : k + _PART].any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([held[k : k + _PART].tobytes()], pa.binary())], ["at", "body"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            for k, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(body, np.uint8)
                parts[k] = parts[k] | x if k in parts else x
        for k, x in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([x.tobytes()], pa.binary())], ["at", "body"])

    shape = "at bigint, body binary"
    out = np.zeros(bits // 8, np.uint8)
    for r in windows.select("h").mapInArrow(mark, shape).repartition("at").mapInArrow(join, shape).collect():
        out[r["at"] : r["at"] + len(r["body"])] = np.frombuffer(r["body"], np.uint8)
    return out


ITEM = "item_key binary, item_id bigint, words string, windows array<bigint>"
DOC = "doc_id bigint, doc_key binary, spans string, windows array<bigint>"


def _key(ident: int, text: str) -> bytes:
    return hashlib.blake2b(f"{ident} {text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _batch(rows: list[tuple], kinds: list, fields: list[str]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], fields)


_KINDS = [pa.binary(), pa.int64(), pa.string(), pa.list_(pa.int64())]


def _item_kernel(made: tuple, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical, numbers = canonicaliser(made), _Numbers()
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                found = words(t.as_py(), canonical)
                if len(found) >= width:
                    rows.append((_key(i, t.as_py()), i, " ".join(found), np.unique(window_hashes(found, numbers, width)).view(np.int64)))
            yield _batch(rows, _KINDS, ["item_key", "item_id", "words", "windows"])

    return run


def spans(at: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Stretches of words that the windows at these places cover, joined where they touch."""
    if not len(at):
        return []
    new = np.flatnonzero(np.diff(at) > width)
    return list(zip(at[np.append(0, new + 1)].tolist(), (at[np.append(new, len(at) - 1)] + width).tolist()))


def _document_kernel(made: tuple, shared, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical, numbers, held = canonicaliser(made), _Numbers(), shared.value
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                text = t.as_py()
                found = words(text, canonical)
                if len(found) < width:
                    continue
                h = window_hashes(found, numbers, width)
                at = passing(h, held)
                if len(at):
                    parts = "\n".join(" ".join(found[x:y]) for x, y in spans(at, width))
                    rows.append((i, _key(i, text), parts, np.unique(h[at]).view(np.int64)))
            yield _batch(rows, [_KINDS[1], _KINDS[0], *_KINDS[2:]], ["doc_id", "doc_key", "spans", "windows"])

    return run


def _seeds(item: np.ndarray, keys: np.ndarray, base: int, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) for each place p of the item: where in `keys` the seeds on diagonals first <= t - p < end lie.

    item: window numbers; keys: number * base + place t of the document's windows, in order; base: its windows and one.
    """
    p = np.arange(len(item))
    low = np.searchsorted(keys, item * base + np.clip(p + first, 0, base - 1))
    return low, np.searchsorted(keys, item * base + np.clip(p + end, 0, base - 1)) - low


def matches(item: np.ndarray, doc: np.ndarray, width: int, most: int = SEEDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, place in item, place in doc) of all maximal matches of at least `width` words.

    Equal windows are seeds; neighbours on a diagonal are one match. Diagonals are worked through in stretches that
    hold at most about `most` seeds at once, so a passage that repeats itself costs time but no memory.
    """
    x, y = rolling(item, width), rolling(doc, width)
    none = np.zeros(0, np.int64)
    if not len(x) or not len(y):
        return none, none, none
    both = np.unique(np.concatenate([x, y]), return_inverse=True)[1]
    a, b = both[: len(x)].astype(np.int64), both[len(x) :].astype(np.int64)
    base = len(b) + 1
    keys = np.sort(b * base + np.arange(len(b)))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    d, end, step = -(len(a) - 1), len(b), len(a) + len(b)
    while d < end:
        low, count = _seeds(a, keys, base, d, min(d + step, end))
        total = int(count.sum())
        if total > most and step > 1:
            step = max(1, min(step // 2, step * most // total))
            continue
        p = np.repeat(np.arange(len(a)), count)
        t = keys[np.arange(total) + np.repeat(low - (np.cumsum(count) - count), count)] % base
        line = np.sort((t - p + len(a)) * (base + 1) + t)
        starts = np.flatnonzero(np.diff(line, prepend=-9) != 1)
        n = np.diff(np.append(starts, total)) + width - 1
        t0 = line[starts] % (base + 1)
        out.append((n, t0 - (line[starts] // (base + 1) - len(a)), t0))
        d, step = min(d + step, end), step * 2 if total < most // 4 else step
    n, p, t = (np.concatenate(z) for z in zip(*out))
    # equal hashes are checked: a match is cut where words differ
    wrong = [k for k in range(len(n)) if not np.array_equal(item[p[k] : p[k] + n[k]], doc[t[k] : t[k] + n[k]])]
    if wrong:
        parts = [(n[k], p[k], t[k]) for k in range(len(n)) if k not in set(wrong)]
        for k in wrong:
            parts += [(z - y, p[k] + y, t[k] + y) for y, z in _stretches(item[p[k] : p[k] + n[k]] == doc[t[k] : t[k] + n[k]], width)]
        n, p, t = (np.array(z, np.int64) for z in zip(*parts)) if parts else (none, none, none)
    return n, p, t


def _stretches(good: np.ndarray, width: int) -> list[tuple[int, int]]:
    """(first, end) of the stretches of at least `width` that are true throughout."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]]).astype(np.int8)))
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= width]


def tiles(item: np.ndarray, doc: np.ndarray, width: int, most: int = SEEDS) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in doc, length), none overlapping in either.

    The longest match is marked first; of a match that a marked one covers in part the free rest is
    matched again if it is long enough. It ends when no free stretch of the item is long enough.
    """
    n, p, t = matches(item, doc, width, most)
    order = np.lexsort((t, p, -n))
    heap = list(zip((-n[order]).tolist(), p[order].tolist(), t[order].tolist()))
    in_item, in_doc, out = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    while heap:
        size, p, t = heappop(heap)
        size = -size
        free = ~(in_item[p : p + size] | in_doc[t : t + size])
        if not free.all():
            for a, b in _stretches(free, width):
                heappush(heap, (a - b, p + a, t + a))
            continue
        in_item[p : p + size] = True
        in_doc[t : t + size] = True
        out.append((p, t, size))
        if not _stretches(~in_item, width):
            break
    return out


def tile_pair(item: list[str], parts: list[list[str]], width: int) -> tuple[int, int, int]:
    """(tiles, words covered, longest tile) of an item in the given stretches of a document; zeros where none fits."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(item), 1)}
    doc: list[int] = []
    for part in parts:
        doc += [0, *(numbers.get(w, 0) for w in part)]
    x, y = np.array([numbers[w] for w in item], np.int64), np.array(doc, np.int64)
    sizes = [n for _, _, n in tiles(x, y, width)]
    return len(sizes), sum(sizes), max(sizes, default=0)


LEAKS = "doc_id bigint, item_id bigint, item_words int, n_tiles int, covered int, longest int"


def _tile_kernel(width: int, coverage: float) -> Callable:
    kinds, fields = [pa.int64(), pa.int64(), *[pa.int32()] * 4], ["doc_id", "item_id", "item_words", "n_tiles", "covered", "longest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, parts, k, item in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3)):
                item = item.as_py().split(" ")
                n, covered, longest = tile_pair(item, [x.split(" ") for x in parts.as_py().split("\n")], width)
                if n and covered >= coverage * len(item):
                    rows.append((i, k, len(item), n, covered, longest))
            yield _batch(rows, kinds, fields)

    return run


def leaks(documents: DataFrame, items: DataFrame, width: int = WORDS, coverage: float = 0.0) -> DataFrame:
    """(doc_id, item_id, item_words, n_tiles, covered, longest) of each document and test item that share text.

    A tile is a run of at least `width` equal consecutive words; tiles of a pair do not overlap and may
    stand in any order. A pair counts if its tiles cover at least `coverage` of the item's words.
    The corpus is read once, whatever the number of items. Null ids and texts on either side give nothing;
    repeated rows count once; empty tables give an empty result; further columns are ignored.
    """
    made, spark = tables(), documents.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    items = cut(items.mapInArrow(_item_kernel(made, width), ITEM))
    windows = cut(items.select("item_key", F.explode("windows").alias("h")))
    n, chars = windows.count(), items.agg(F.sum(F.length("words"))).first()[0] or 0
    shared = spark.sparkContext.broadcast(bit_table(windows, n))
    docs = spread(documents.select("doc_id", "text").where("doc_id is not null and text is not null"), "doc_id")
    hits = cut(docs.mapInArrow(_document_kernel(made, shared, width), DOC).dropDuplicates(["doc_id", "doc_key"]))
    pairs = hits.select("doc_key", F.explode("windows").alias("h")).join(small(windows), "h").select("doc_key", "item_key").distinct()
    texts = items.select("item_key", "item_id", "words")
    texts = F.broadcast(texts) if chars <= SENT_CHARS else texts
    both = hits.select("doc_id", "doc_key", "spans").join(pairs, "doc_key").join(texts, "item_key")
    return both.select("doc_id", "spans", "item_id", "words").mapInArrow(_tile_kernel(width, coverage), LEAKS).distinct()


def p7_found(spark, sf_dir):
    """Documents and the items they share at least 12 consecutive words with."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id").distinct()


def p7_covered(spark, sf_dir):
    """Documents whose tiles, in whatever order, cover at least half of an item."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), coverage=0.5)
