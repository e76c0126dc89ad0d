"""Encoding the whole corpus with a public tokenizer."""

from __future__ import annotations

import base64
import importlib.util
import os
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, table

#: Fixed value: the pattern that splits text before the merges of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where a token always ends, whatever stands around: white space after anything else (a token holds white
#: space at its start or is all white space), or a change between letters and digits.
_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")
#: Longer texts are encoded piece by piece.
LONG = 100_000


def vocabulary_path(name: str, folder: str | None = None) -> str:
    """The place of a vocabulary file: in `folder`, in $TOKENIZER_DIR, or in the installed package public_tokenizers.

    A file that isn't there is an error that names these settings.
    """
    folder = folder or os.environ.get("TOKENIZER_DIR")
    if not folder and (spec := importlib.util.find_spec("public_tokenizers")):
        folder = os.path.dirname(spec.origin)
    path = os.path.join(folder or "", name)
    if not folder or not os.path.isfile(path):
        raise FileNotFoundError(f"no vocabulary {name} in {folder or 'any known folder'}: give its folder as folder=, set TOKENIZER_DIR, or install public_tokenizers")
    return path


_LOADED: dict[str, object] = {}


def encoding(path: str):
    """The tokenizer of a rank file, loaded once per Python process."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def pieces(text: str, long: int = LONG) -> Iterator[str]:
    """Cut a text at safe boundaries into pieces of about `long` characters; a run without a boundary stays whole."""
    start = 0
    while len(text) - start > long:
        cut_at = _SAFE.search(text, start + long)
        if not cut_at:
            break
        yield text[start : cut_at.start()]
        start = cut_at.start()
    yield text[start:]


def encode(enc, text: str | None, long: int = LONG) -> list[int]:
    """Ids of a text taken as it is; [] for null and empty texts. No string in a text is a special token."""
    if not text:
        return []
    if len(text) <= long:
        return enc.encode_ordinary(text)
    return [i for p in pieces(text, long) for i in enc.encode_ordinary(p)]


def decode(enc, ids) -> bytes:
    """The bytes of the ids, without any repair of broken characters."""
    return b"".join(enc.decode_single_token_bytes(int(i)) for i in ids)


def _lists(values: list[list[int]]) -> pa.Array:
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    flat = np.fromiter((i for v in values for i in v), np.int32, int(lengths.sum()))
    return pa.ListArray.from_arrays(pa.array(np.append(0, lengths.cumsum()), pa.int32()), pa.array(flat))


#: Ids handed on at once.
IDS = 1 << 20


def _kernel(path: str, long: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for b in batches:
            start, held, ids = 0, 0, []
            for k, text in enumerate(b.column(1)):
                ids.append(encode(enc, text.as_py(), long))
                held += len(ids[-1])
                if held >= IDS or k == b.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(start, len(ids)), _lists(ids)], ["doc_id", "ids"])
                    start, held, ids = k + 1, 0, []

    return run


def token_ids(documents: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", folder: str | None = None, long: int = LONG) -> DataFrame:
    """(doc_id, ids): every document with its token ids, one row for each input row.

    Null and empty texts have the empty list; white space and text that spells a special token are ordinary
    text; texts of any length are encoded whole. Repeated rows and null ids are kept; an empty table gives
    an empty result; further columns are ignored.
    """
    docs = spread(documents.select("doc_id", "text"), "doc_id")
    return docs.mapInArrow(_kernel(vocabulary_path(vocabulary, folder), long), "doc_id bigint, ids array<int>")


def _check(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for b in batches:
            good = [decode(enc, i or ()) == (t or "").encode() for t, i in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pc.list_value_length(b.column(2)), pa.array(good)], ["doc_id", "n_ids", "same"])

    return run


def p6_ids(spark, sf_dir):
    """Ids of every document by byte_bpe_50k."""
    return token_ids(table(spark, sf_dir, "documents"))


def p6_roundtrip(spark, sf_dir, vocabulary: str = "byte_bpe_50k.tiktoken"):
    """(doc_id, n_ids, same): whether the raw bytes of the ids are the text again."""
    path = vocabulary_path(vocabulary)

    def both(batches):
        enc = encoding(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists([encode(enc, t) for t in b.column(1).to_pylist()])], ["doc_id", "text", "ids"])

    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return docs.mapInArrow(both, "doc_id bigint, text string, ids array<int>").mapInArrow(_check(path), "doc_id bigint, n_ids int, same boolean")
