"""Per-key results when a few keys hold most rows: dense accumulator arrays.

Every input split, whatever keys it holds, numbers the spellings it meets and reduces its rows into
arrays indexed by that number. The dictionary of keys is a table with dense codes; the splits' arrays are
renumbered by it, cut into blocks of codes and added up block by block. The work of a task depends on the
size of its split alone, never on a key's share of the rows, and nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..session import cut, splits, table
from .compose import positions

#: Spellings a task numbers at once; when it has met more it hands on its arrays and starts anew.
HELD = 500_000
#: Codes in a block that is shuffled as one row.
BLOCK = 4096
#: Above this number of splits blocks are reduced in two steps.
FAN_IN = 256

_MIN, _MAX = np.iinfo(np.int64).max, np.iinfo(np.int64).min


@dataclass(frozen=True)
class Measure:
    """A BIGINT expression and how it is reduced: sum, min or max. Nulls do not count."""

    name: str
    value: Column
    how: str = "sum"


def _start(how: str) -> int:
    return {"sum": 0, "min": _MIN, "max": _MAX}[how]


def _merge(how: str, into: np.ndarray, x: np.ndarray) -> None:
    {"sum": np.add, "min": np.minimum, "max": np.maximum}[how](into, x, out=into)


def _scatter(how: str, into: np.ndarray, at: np.ndarray, x: np.ndarray) -> None:
    {"sum": np.add, "min": np.minimum, "max": np.maximum}[how].at(into, at, x)


def _accumulate(n_raw: int, hows: list[str], raw: list[str], held: int) -> Callable:
    """Reduce the batches of one split: (raw columns, body), one row for each spelling it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple, int] = {}
        acc = [np.full(1024, _start(h), np.int64) for h in ["sum", *hows]]

        def hand_on() -> Iterator[pa.RecordBatch]:
            told = list(numbers)
            for first in range(0, len(told), 65_536):
                part = told[first : first + 65_536]
                cols = [pa.array([t[k] for t in part], pa.string()) for k in range(n_raw)]
                cols += [pa.array(a[first : first + len(part)]) for a in acc]
                yield pa.RecordBatch.from_arrays(cols, [*raw, *(f"a{k}" for k in range(len(acc)))])
            numbers.clear()
            for k, h in enumerate(["sum", *hows]):
                acc[k] = np.full(1024, _start(h), np.int64)

        for b in batches:
            # the batch's spellings by number: the columns' codes as one number of mixed radix
            code, words = np.zeros(b.num_rows, np.int64), []
            for k in range(n_raw):
                d = b.column(k).dictionary_encode()
                words.append([*d.dictionary.to_pylist(), None])
                at = pc.fill_null(d.indices, len(words[-1]) - 1).to_numpy(zero_copy_only=False).astype(np.int64)
                code, code_at = np.unique(code * len(words[-1]) + at, return_inverse=True)
                if k == 0:
                    parts = [code]
                else:
                    # what each number was made of, column by column
                    parts = [p[code // len(words[-1])] for p in parts] + [code % len(words[-1])]
                code = code_at
            if not b.num_rows:
                continue
            told = list(zip(*([w[i] for i in p] for w, p in zip(words, parts))))
            slot = np.fromiter((numbers.setdefault(t, len(numbers)) for t in told), np.int64, len(told))
            while len(numbers) > len(acc[0]):
                acc = [np.concatenate([a, np.full(len(a), _start(h), np.int64)]) for a, h in zip(acc, ["sum", *hows])]
            acc[0][slot] += np.bincount(code, minlength=len(told))
            for k, how in enumerate(hows, 1):
                there = b.column(n_raw + k - 1).is_valid().to_numpy(zero_copy_only=False)
                x = pc.fill_null(b.column(n_raw + k - 1), 0).to_numpy(zero_copy_only=False)[there]
                _scatter(how, acc[k], slot[code[there]], x)
            if len(numbers) > held:
                yield from hand_on()
        yield from hand_on()

    return run


def _blocks(hows: list[str]) -> Callable:
    """Coded partial results to blocks of dense arrays; code -1 takes the rows without a key and is block -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        kinds = ["sum", *hows]
        for b in batches:
            code = b.column(0).to_numpy(zero_copy_only=False)
            values = [b.column(k).to_numpy(zero_copy_only=False) for k in range(1, len(kinds) + 1)]
            block = code // BLOCK
            for one in np.unique(block).tolist():
                if one not in sums:
                    sums[one] = np.stack([np.full(BLOCK, _start(h), np.int64) for h in kinds])
                here = np.flatnonzero(block == one)
                for k, how in enumerate(kinds):
                    _scatter(how, sums[one][k], code[here] - one * BLOCK, values[k][here])
        part = TaskContext.get().partitionId()
        for one, x in sums.items():
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([one], pa.int64()), "part": pa.array([part], pa.int32()), "body": pa.array([x.tobytes()], pa.binary()),
            })

    return run


def _reduce(hows: list[str], last: bool, fields: list[str]) -> Callable:
    """Add up the blocks that arrive; in the last step write one row per code with rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for block, body in zip(b.column(0).to_pylist(), b.column("body")):
                x = np.frombuffer(body.as_buffer(), np.int64).reshape(len(hows) + 1, -1)
                if block not in sums:
                    sums[block] = x.copy()
                else:
                    for k, how in enumerate(["sum", *hows]):
                        _merge(how, sums[block][k], x[k])
        for block, x in sorted(sums.items()):
            if not last:
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()), "part": pa.array([0], pa.int32()), "body": pa.array([x.tobytes()], pa.binary()),
                })
                continue
            at = np.flatnonzero(x[0])
            cols = [pa.array(block * BLOCK + at, pa.int64()), pa.array(x[0][at])]
            for k, how in enumerate(hows, 1):
                cols.append(pa.array(x[k][at], mask=(x[k][at] == _start(how)) if how != "sum" else None))
            yield pa.RecordBatch.from_arrays(cols, fields)

    return run


def per_key(df: DataFrame, raw: list[str], keys: dict[str, Column], measures: list[Measure] = (), held: int = HELD) -> DataFrame:
    """(keys, n_rows, measures): results of each key over all rows of df, and one row of null keys for the rows without.

    raw: the columns the keys are read from. keys: canonical key columns over raw; a row counts
    as without key where one of them is null. Only the distinct spellings of raw are brought
    into canonical form. A split that meets more than `held` spellings hands on its arrays in between; the
    result is the same. An empty table gives an empty result.
    """
    measures = list(measures)
    hows, n = [m.how for m in measures], len(raw)
    texts = [F.col(c).cast("string").alias(f"r{k}") for k, c in enumerate(raw)]
    split = df.select(*texts, *(m.value.cast("bigint").alias(f"m{k}") for k, m in enumerate(measures)))
    sums = ", ".join(f"a{k} bigint" for k in range(len(hows) + 1))
    kinds = ", ".join(f"r{k} string" for k in range(n))
    partial = cut(split.mapInArrow(_accumulate(n, hows, [f"r{k}" for k in range(n)], held), f"{kinds}, {sums}"))
    # each value with its length before it, so that different values never give one spelling
    told = F.concat(*(F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (F.col(f"r{k}") for k in range(n))))
    partial = partial.withColumn("told", told)
    spelled = partial.select(*(F.col(f"r{k}").alias(c) for k, c in enumerate(raw)), "told").distinct()
    spelled = cut(spelled.select("told", *(k.alias(c) for c, k in keys.items())))
    named = positions(spelled.select(*keys).dropna().distinct(), *keys, name="code")
    codes = spelled.dropna().join(named, list(keys)).select("told", "code")
    coded = partial.join(codes, "told", "left").select(F.coalesce("code", F.lit(-1)).cast("bigint").alias("code"), *(f"a{k}" for k in range(len(hows) + 1)))
    shape = "block bigint, part int, body binary"
    blocks = coded.mapInArrow(_blocks(hows), shape)
    parts = splits(split)
    if parts > FAN_IN:
        blocks = blocks.repartition("block", F.col("part") % int(parts**0.5)).mapInArrow(_reduce(hows, False, []), shape)
    fields = ["code", "n_rows", *(m.name for m in measures)]
    dense = blocks.repartition("block").mapInArrow(_reduce(hows, True, fields), ", ".join(f"`{f}` bigint" for f in fields))
    return dense.join(named, "code", "left").select(*keys, *fields[1:])


def taxa(genomes: DataFrame, measures: list[Measure] = (), **how) -> DataFrame:
    """per_key over (genus, species) in canonical spelling and lower case."""
    keys = {"genus": names.rank_name(F.col("genus")), "species": names.species_name(F.col("species"), F.col("genus"))}
    return per_key(genomes, ["genus", "species"], keys, measures, **how)


def p3_found(spark, sf_dir):
    """The taxa that hold at least 2 percent of all rows."""
    counts = cut(taxa(table(spark, sf_dir, "genomes")))
    total = counts.agg(F.sum("n_rows")).first()[0] or 0
    return counts.where("genus is not null").where(F.col("n_rows") * 50 >= total).select("genus", "species")


def p3_taxa(spark, sf_dir):
    """Rows, outgroup rows and first and last update of every taxon."""
    def micros(c):
        return F.unix_micros(F.col(c).cast("timestamp"))

    out = taxa(table(spark, sf_dir, "genomes"), [
        Measure("n_outgroup", F.col("is_outgroup").cast("bigint")),
        Measure("n_contained", (F.lower(F.trim("derep_status")) == "contained").cast("bigint")),
        Measure("first_update", micros("updated_at"), "min"), Measure("last_update", micros("updated_at"), "max"),
    ])
    return out.where("genus is not null")
