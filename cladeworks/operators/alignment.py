"""Alignments: blocks projected on a reference, variable columns, distances."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import IUPAC, reverse_complement
from ..session import cut
from .compose import before, positions

#: Columns of an alignment that are reduced as one row.
BLOCK = 1 << 16
#: Rows of an alignment that are compared with as many others in one task.
ROWS = 512


def _columns(text: str) -> Column:
    """The 1-based columns of an aligned text that are no gap."""
    return F.filter(F.transform(F.split(text, ""), lambda c, i: F.when((c != "-") & (c != ""), i + 1)), lambda i: i.isNotNull())


def _pick(text: str, keep: str) -> Column:
    return F.array_join(F.transform(keep, lambda i: F.substring(text, i, F.lit(1))), "")


def _end_before(parts: Column, i: Column) -> Column:
    """Where the piece before the i-th ends; 0 before the first."""
    before = F.get(parts, i - 1)
    return F.coalesce(before["at"] + F.length(before["t"]), F.lit(0))


def _filled(rows: DataFrame, total: int) -> None:
    """A projection without any column is an error that names the labels there are, unless there are no rows at all."""
    if total == 0 and (found := [r["genome"] for r in rows.select("genome").distinct().limit(20).collect()]):
        from ..plans.registry import InputError

        raise InputError(f"no column of the reference is aligned; the rows have the labels {', '.join(map(str, sorted(found, key=str)))}")


def project_blocks(rows: DataFrame, reference: str, exclude: list[str] | None = None, by_contig: bool = False) -> DataFrame:
    """(genome, seq): every genome's aligned text on the reference's coordinates, the reference first by `ord` 0.

    rows: block, row, genome, start, text, and contig with by_contig. Columns where the reference has a gap are
    dropped, genomes absent from a block are padded with '-', blocks follow the reference's start.
    Of several rows of a genome in a block the first counts. Result: ord, genome, seq. Rows of which no column is
    left are an error; no rows give no rows.
    """
    first = rows.where(~F.col("genome").isin(list(exclude or []) or [""])).groupBy("block", "genome").agg(F.min_by(F.struct(*(c for c in rows.columns if c not in ("block", "genome"))), "row").alias("x")).select("block", "genome", "x.*")
    order = ["contig", "start", "block"] if by_contig else ["start", "block"]
    ref = first.where(F.col("genome") == reference).select(*order, _columns("text").alias("keep")).where(F.size("keep") > 0)
    ref = ref.withColumn("width", F.size("keep").cast("bigint"))
    total = ref.agg(F.sum("width")).first()[0] or 0
    _filled(first, total)
    starts = before(ref, "width", *order).select("block", "keep", "at")
    kept = first.select("block", "genome", "text").join(starts, "block")
    parts = kept.groupBy("genome").agg(F.sort_array(F.collect_list(F.struct("at", _pick("text", "keep").alias("t")))).alias("p"))
    text = F.array_join(F.transform("p", lambda x, i: F.concat(F.repeat(F.lit("-"), (x["at"] - _end_before(F.col("p"), i)).cast("int")), x["t"])), "")
    out = first.select("genome").distinct().join(parts.select("genome", text.alias("t")), "genome", "left")
    seq = F.rpad(F.coalesce("t", F.lit("")), total, "-")
    return out.select((F.col("genome") != reference).cast("int").alias("ord"), "genome", seq.alias("seq")).orderBy("ord", "genome")


_COMPLEMENT = str.maketrans(*IUPAC)
_GAPS = re.compile("-+")


def screened(reference: str, others: list[str], flank: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns to keep, whether each of them is blanked) of a block.

    Columns where the reference has a gap go. With a flank, what lies within `flank` columns of a place where columns
    went or where another row has a gap is blanked, and so are `flank` columns at both ends.
    """
    is_gap = np.frombuffer(reference.encode("utf-32-le"), np.uint32) == ord("-")
    keep = np.flatnonzero(~is_gap)
    blank = np.zeros(len(keep), bool)
    if flank > 0:
        at = np.append(0, np.cumsum(~is_gap))
        places = [(at[m.start()], at[m.start()]) for m in _GAPS.finditer(reference)]
        places += [(at[m.start()], at[m.end()]) for text in others for m in _GAPS.finditer(text)]
        edge = np.zeros(len(keep) + 1, np.int64)
        for a, b in places:
            edge[max(0, a - flank)] += 1
            edge[min(len(keep), b + flank)] -= 1
        blank = np.cumsum(edge[:-1]) > 0
        blank[:flank] = True
        blank[max(0, len(keep) - flank) :] = True
    return keep, blank


def project_xmfa(rows: DataFrame, reference: str, flank: int = 0) -> DataFrame:
    """(ord, genome, seq) on reference coordinates from blocks with 1-based places and a sign.

    rows: block, genome, p1, p2, sign, text. Columns where the reference has a gap are dropped; where its sign is -
    all rows of the block are reverse-complemented; what no block covers is '-'. Later blocks overwrite earlier ones.
    flank: see screened(). A task holds the rows of one block if there is a flank, and the pieces and the sequence of one genome.
    """
    ref = rows.where(F.col("genome") == reference)
    total = ref.agg(F.max("p2")).first()[0] or 0
    _filled(rows, total)

    def pieces(x: pd.DataFrame) -> pd.DataFrame:
        own = x[x["genome"] == reference]
        out = []
        if len(own):
            r = own.iloc[0]
            keep, blank = screened(r["text"], x.loc[x["genome"] != reference, "text"].tolist(), flank)
            for g, t in zip(x["genome"], x["text"]):
                c = np.frombuffer(t.encode("utf-32-le"), np.uint32)
                c = np.where(blank, ord("-"), np.append(c, np.full(max(0, len(r["text"]) - len(c)), ord("-"), np.uint32))[keep])
                piece = c.astype("<u4").tobytes().decode("utf-32-le")
                piece = piece[flank : len(piece) - flank]
                out.append((g, int(r["block"]), int(r["p1"]) - 1 + flank, piece if r["sign"] != "-" else piece.translate(_COMPLEMENT)[::-1]))
        return pd.DataFrame(out, columns=["genome", "block", "at", "piece"])

    def whole(x: pd.DataFrame) -> pd.DataFrame:
        line = np.full(total, ord("-"), "<u4")
        for at, piece in x.sort_values("block")[["at", "piece"]].itertuples(index=False):
            line[at : at + len(piece)] = np.frombuffer(piece.encode("utf-32-le"), np.uint32)[: max(0, total - at)]
        return pd.DataFrame({"genome": [x["genome"].iloc[0]], "seq": [line.tobytes().decode("utf-32-le")]})

    if flank > 0:
        made = rows.select("block", "genome", "p1", "p2", "sign", "text").groupBy("block").applyInPandas(pieces, "genome string, block bigint, at bigint, piece string")
    else:
        own = ref.select("block", (F.col("p1") - 1).alias("at"), F.col("sign").alias("strand"), _columns("text").alias("keep"))
        piece = _pick("text", "keep")
        made = rows.select("block", "genome", "text").join(own, "block").select(
            "genome", F.col("block").cast("bigint").alias("block"), F.col("at").cast("bigint").alias("at"),
            F.when(F.col("strand") == "-", reverse_complement(piece)).otherwise(piece).alias("piece"),
        )
    made = made.groupBy("genome").applyInPandas(whole, "genome string, seq string")
    out = rows.select("genome").distinct().join(made, "genome", "left")
    seq = F.rpad(F.coalesce("seq", F.lit("")), total, "-")
    return out.select((F.col("genome") != reference).cast("int").alias("ord"), "genome", seq.alias("seq")).orderBy("ord", "genome")


def _shortest(msa: DataFrame, seq: str) -> int:
    return msa.agg(F.min(F.length(seq))).first()[0] or 0


def _chars(text: str, width: int) -> np.ndarray:
    return np.frombuffer(text[:width].encode("utf-32-le", "surrogatepass"), np.uint32)


def variable_sites(msa: DataFrame, name: str = "name", seq: str = "seq", ignore: str = "") -> DataFrame:
    """(pos): columns, from 0 up to the shortest row, with more than one character; characters of `ignore` do not count.

    Each split keeps the least and greatest character of every column in arrays, which are reduced block by block.
    Rows without a sequence do not count.
    """
    width, skip = _shortest(msa, seq), [ord(c) for c in ignore]

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(width, 0xFFFFFFFF, np.uint32), np.zeros(width, np.uint32)
        for b in batches:
            for t in b.column(0):
                c = _chars(t.as_py(), width)
                there = ~np.isin(c, skip) if skip else slice(None)
                np.minimum(low, c, out=low, where=there if skip else True)
                np.maximum(high, c, out=high, where=there if skip else True)
        for k in range(0, width, BLOCK):
            body = np.stack([low[k : k + BLOCK], high[k : k + BLOCK]]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([body], pa.binary())], ["at", "body"])

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(body, np.uint32).reshape(2, -1)
                held[k] = np.stack([np.minimum(held[k][0], x[0]), np.maximum(held[k][1], x[1])]) if k in held else x
        for k, x in held.items():
            at = np.flatnonzero((x[0] < x[1]) & (x[0] != 0xFFFFFFFF))
            yield pa.RecordBatch.from_arrays([pa.array(at + k, pa.int32())], ["pos"])

    texts = msa.select(F.col(seq).alias("seq")).where("seq is not null")
    return texts.mapInArrow(extremes, "at int, body binary").repartition("at").mapInArrow(reduced, "pos int")


def core_alignment(msa: DataFrame, name: str = "name", seq: str = "seq", ignore: str = "") -> DataFrame:
    """(name, seq): each row's characters at the variable columns; rows without a sequence are left out.

    The columns' numbers are sent to the executors; there are no more of them than a row has characters.
    """
    sites = variable_sites(msa, name, seq, ignore)
    at = np.array(sorted(r["pos"] for r in sites.collect()), np.int64)
    shared = msa.sparkSession.sparkContext.broadcast(at)
    kind = msa.schema[name].dataType

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        width = int(at[-1]) + 1 if len(at) else 0
        for b in batches:
            texts = [_chars(t.as_py(), width)[at].tobytes().decode("utf-32-le", "surrogatepass") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["name", "seq"])

    rows = msa.select(F.col(name).alias("name"), F.col(seq).alias("seq")).where("seq is not null")
    return rows.mapInArrow(pick, f"name {kind.simpleString()}, seq string")


def _differences(x: list[str], y: list[str]) -> np.ndarray:
    a, b = (np.stack([_chars(t, len(t)) for t in z]) for z in (x, y))
    return np.stack([np.count_nonzero(b != row, axis=1) for row in a])


def hamming(msa: DataFrame, name: str = "name", seq: str = "seq") -> DataFrame:
    """(a, b, d), a < b: number of columns, up to the shortest row, in which two rows differ; 0 for equal rows.

    The result has a row for each pair, as a distance matrix does. Rows keep their variable columns only and are put in
    blocks of ROWS; a block goes to each pair of blocks it belongs to, where a task compares two blocks as arrays.
    Rows without a name or sequence are left out.
    """
    kind = msa.schema[name].dataType.simpleString()
    core = positions(core_alignment(msa.where(F.col(name).isNotNull()), name, seq), "name")
    core = cut(core.select("name", "seq", F.floor(F.col("pos") / ROWS).cast("int").alias("blk")))
    n = (core.agg(F.max("blk")).first()[0] or 0) + 1
    sent = core.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(
        "name", "seq", "blk", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j")
    )

    def compare(x: pd.DataFrame) -> pd.DataFrame:
        i, j = int(x["i"].iloc[0]), int(x["j"].iloc[0])
        p, q = x[x["blk"] == i], x[x["blk"] == j]
        d = _differences(p["seq"].tolist(), q["seq"].tolist()) if len(p) and len(q) else np.zeros((0, 0), np.int64)
        a, b = np.nonzero(np.ones_like(d, bool))
        out = pd.DataFrame({"a": p["name"].to_numpy()[a], "b": q["name"].to_numpy()[b], "d": d[a, b].astype("int64")})
        return out[out["a"] < out["b"]]

    return sent.groupBy("i", "j").applyInPandas(compare, f"a {kind}, b {kind}, d bigint")


def spread_of(genomes: DataFrame, genus: str = "genus", species: str = "species") -> DataFrame:
    """One row (genera, species): distinct lower-case genera and genus-species pairs, blank genera aside."""
    g, s = F.lower(F.col(genus)), F.lower(F.coalesce(F.col(species), F.lit("")))
    return genomes.where(F.col(genus) != "").agg(F.count_distinct(g).alias("genera"), F.count_distinct(g, s).alias("species"))


def concatenate(parts: DataFrame, reference: str) -> DataFrame:
    """Rows of several pairwise alignments in one, the reference once. parts: ord, name, seq."""
    w = W.partitionBy("name").orderBy("ord")
    ref = parts.where(F.col("name") == reference).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return ref.unionByName(parts.where(F.col("name") != reference))
