"""Deeply nested records to flat tables by Dewey labels.

Every node of a record has an ordinal path (its Dewey label) and a schema path. Array elements
become rows of the table named by their schema path; a row's parent is found by truncating its label.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from json import decoder, scanner

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread, table

NODES = "id bigint, row bigint, path string, dewey array<int>, leaves map<string,string>"
#: Rows handed on at once.
ROWS = 20_000


class _Num(str):
    """A number as it was written."""


def _constant(name: str):
    raise ValueError(f"{name} is no JSON")


def _strict() -> tuple[Callable, Callable]:
    """Two JSON readers, the second for records nested too deeply for the first."""
    fast = json.JSONDecoder(parse_int=_Num, parse_float=_Num, parse_constant=_constant)
    deep = json.JSONDecoder(parse_int=_Num, parse_float=_Num, parse_constant=_constant)
    deep.parse_object, deep.parse_array, deep.parse_string = decoder.JSONObject, decoder.JSONArray, decoder.py_scanstring
    deep.scan_once = scanner.py_make_scanner(deep)
    return fast.decode, deep.decode


def parse(text: str | None, readers=None) -> tuple[bool, object]:
    """(readable, value); numbers as written."""
    import sys

    fast, deep = readers or _strict()
    try:
        return True, fast(text)
    except RecursionError:
        before = sys.getrecursionlimit()
        sys.setrecursionlimit(10_000_000)
        try:
            return True, deep(text)
        except (ValueError, RecursionError):
            return False, None
        finally:
            sys.setrecursionlimit(before)
    except (ValueError, TypeError):
        return False, None


_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def snake(key: str) -> str:
    return _CAMEL.sub("_", key).lower()


def _text(v: object) -> str:
    x = v if isinstance(v, str) else "true" if v is True else "false" if v is False else json.dumps(v)
    return x.encode("utf-8", "replace").decode() if not x.isascii() else str(x)


class Paths:
    """What is read of records: tables (schema paths of array elements, '' the record itself) and the leaves of each.

    lists: paths that are arrays even where their one element stands alone. leaves: the leaves to keep of each table;
    other tables and keys on no way to a kept leaf are not entered. None keeps everything. Of two spellings of a
    key the steps are the same; what a key of a path leads to is worked out once.
    """

    def __init__(self, lists=(), leaves: dict[str, set[str]] | None = None):
        self.lists, self.leaves = frozenset(lists), leaves
        self.ways = None
        if leaves is not None:
            full = [f"{t}.{x}".strip(".") if x else t for t, xs in leaves.items() for x in xs]
            self.ways = {w[:k] for w in full for k in range(len(w) + 1) if k == len(w) or w[k] in ".["} | {w[: k + 2] for w in full for k in range(len(w)) if w[k : k + 2] == "[]"}
        self._steps: dict[str, dict[str, tuple | None]] = {}

    def steps(self, path: str) -> dict[str, tuple | None]:
        """For keys met under a path: (path of the value, leaf, whether a lone value is an array of one), or None."""
        found = self._steps.get(path)
        if found is None:
            found = self._steps[path] = {}
        elif len(found) > 10_000:
            found.clear()
        return found

    def step(self, path: str, key: str) -> tuple | None:
        k = snake(key)
        at = f"{path}.{k}" if path else k
        if self.ways is not None and at not in self.ways:
            return None
        return at, at.rpartition("[]")[2].lstrip("."), at + "[]" in self.lists

    def enters(self, path: str) -> bool:
        return self.ways is None or path in self.ways


def label(value: object, paths: Paths) -> Iterator[tuple[str, tuple[int, ...], dict[str, str]]]:
    """(schema path, Dewey label, leaves) of the root and of every array element in reach.

    Leaves are the scalars an element holds directly or in objects, by dotted key; of two
    spellings of one key the first value that is not null counts.
    """
    rows = [("", (), value)]
    kept = paths.leaves
    while rows:
        path, dewey, top = rows.pop()
        wanted = None if kept is None else kept.get(path, ())
        leaves: dict[str, str] = {}
        todo = [(path, dewey, "", top)]
        while todo:
            p, d, leaf, v = todo.pop()
            if isinstance(v, dict):
                steps, below = paths.steps(p), []
                for i, (k, x) in enumerate(v.items()):
                    if x is None:
                        continue
                    try:
                        to = steps[k]
                    except KeyError:
                        to = steps[k] = paths.step(p, k)
                    if to is None:
                        continue
                    if to[2] and not isinstance(x, list):
                        x = [x]
                    below.append((to[0], (*d, i), to[1], x))
                todo += reversed(below)
            elif isinstance(v, list):
                at = p + "[]"
                if paths.enters(at):
                    rows += [(at, (*d, i), x) for i, x in enumerate(v)]
            elif v is not None and (wanted is None or leaf in wanted) and not leaves.get(leaf):
                leaves[leaf] = _text(v)
        if wanted is None or wanted:
            yield path, dewey, leaves


def _kernel(wrap: str | None, lists, leaves) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers, paths = _strict(), Paths(lists, leaves)
        fields = ["id", "row", "path", "dewey", "leaves"]
        # labels and leaves are gathered flat, with the places where each row's end
        ids, at, kinds, steps, steps_end, keys, texts, leaves_end = held = tuple([] for _ in range(8))
        row = TaskContext.get().partitionId() << 40

        def batch():
            ends = [pa.array([0, *e], pa.int32()) for e in (steps_end, leaves_end)]
            labels = pa.ListArray.from_arrays(ends[0], pa.array(steps, pa.int32()))
            found = pa.MapArray.from_arrays(ends[1], pa.array(keys, pa.string()), pa.array(texts, pa.string()))
            made = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(at, pa.int64()), pa.array(kinds, pa.string()), labels, found], fields)
            for c in held:
                c.clear()
            return made

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                row += 1
                good, value = parse(text.as_py(), readers)
                if not good or value is None:
                    continue
                if wrap and not (isinstance(value, dict) and wrap in value):
                    value = {wrap: [value]}
                for path, dewey, found in label(value, paths):
                    ids.append(i)
                    at.append(row)
                    kinds.append(path)
                    steps.extend(dewey)
                    steps_end.append(len(steps))
                    keys.extend(found)
                    texts.extend(found.values())
                    leaves_end.append(len(keys))
                    if len(ids) >= ROWS:
                        yield batch()
        if ids:
            yield batch()

    return run


def dewey_nodes(df: DataFrame, ident: str, text: str, wrap: str | None = None, lists=(), leaves: dict[str, set[str]] | None = None) -> DataFrame:
    """(id, row, path, dewey, leaves): one row per table entry of every readable record.

    row numbers the input rows of this run, so that rows with a repeated or null id stay apart; read the
    result more than once only after cut().

    Null, blank and unreadable texts give nothing; repeated rows give their entries again.
    wrap: the key of a page's array of records; a record that stands alone becomes its only element.
    lists, leaves: see Paths; a table without leaves to keep gives no rows.
    """
    rows = spread(df.select(F.col(ident).alias("id"), F.col(text).alias("text")), "id").where("text is not null")
    return rows.mapInArrow(_kernel(wrap, lists, leaves), NODES)


def parent(dewey, depth: int):
    """The label of the ancestor `depth` steps below the root."""
    return F.slice(dewey, 1, depth)


_R, _L = "reports[]", "reports[].virus.lineage[]"
_G = "reports[].annotation.genes[]"
_C = "reports[].annotation.genes[].cds[]"
#: The leaves that the tables of records and children read; lineage entries may be names themselves.
FLAT = {_R: {"virus.tax_id", "isolate.name", "isolate", "segment"}, _L: {"name", ""}, _C: {"protein_accession"}}
#: Those and what whole viral records have besides.
LEAVES = FLAT | {_R: FLAT[_R] | {"accession", "length", "completeness", "virus.organism_name"}, _L: FLAT[_L] | {"tax_id", "rank"}}


def report_nodes(reports: DataFrame, leaves: dict[str, set[str]] = LEAVES) -> DataFrame:
    return dewey_nodes(reports, "line_id", "report", wrap="reports", lists=(_R, _L, _G, _C), leaves=leaves)


def records(nodes: DataFrame) -> DataFrame:
    """(id, record, record_pos, taxid, isolate, segment); record is the label children are truncated to."""
    def leaf(k):
        return F.coalesce(F.col("leaves")[k], F.lit(""))

    return nodes.where(F.col("path") == _R).select(
        "id", "row", F.col("dewey").alias("record"), F.col("dewey")[1].alias("record_pos"), leaf("virus.tax_id").alias("taxid"),
        F.coalesce(F.col("leaves")["isolate.name"], F.col("leaves")["isolate"], F.lit("")).alias("isolate"),
        F.coalesce(F.nullif(leaf("segment"), F.lit("")), F.lit("ANONYMOUS")).alias("segment"),
    )


def children(nodes: DataFrame) -> DataFrame:
    """(id, record, child, parent_pos, child_pos, child_key) of lineage entries and coding sequences."""
    d = F.col("dewey")
    lineage = nodes.where(F.col("path") == _L).select(
        "id", "row", parent(d, 2).alias("record"), F.lit("lineage").alias("child"), F.lit(-1).alias("parent_pos"),
        d[4].alias("child_pos"), F.coalesce(F.col("leaves")["name"], F.col("leaves")[""]).alias("child_key"),
    )
    cds = nodes.where(F.col("path") == _C).select(
        "id", "row", parent(d, 2).alias("record"), F.lit("cds").alias("child"), d[4].alias("parent_pos"), d[6].alias("child_pos"),
        F.col("leaves")["protein_accession"].alias("child_key"),
    )
    return lineage.unionByName(cds).where("child_key != ''")


def p5_found(spark, sf_dir):
    """One row per lineage entry and coding sequence of every report of every readable line."""
    nodes = cut(report_nodes(table(spark, sf_dir, "virus_reports"), FLAT))
    return children(nodes).drop("id").join(records(nodes), ["row", "record"]).select(
        F.col("id").alias("line_id"), "record_pos", "taxid", "isolate", "segment", "child", "parent_pos", "child_pos", "child_key"
    )


def p5_records(spark, sf_dir):
    """The table of reports: one row per report of every readable line."""
    return records(report_nodes(table(spark, sf_dir, "virus_reports"), FLAT)).select(
        F.col("id").alias("line_id"), "record_pos", "taxid", "isolate", "segment"
    )
