"""Stages over tables with a ledger: what ran, with which parameters, and what is stale."""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable
from dataclasses import asdict, dataclass, is_dataclass
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import manifest
from .registry import InputError

LEDGER = "stage string, params string, versions string, completed timestamp, fingerprint string"
CHAIN = ["metadata", "genome", "dereplicate", "phylo", "tree2tax"]
#: Parameters that change how fast a stage is, not what it gives.
SPEED_ONLY = ("threads", "num_processes")
log = logging.getLogger(__name__)


def fingerprint(stage: str, params: dict) -> str:
    kept = {k: v for k, v in params.items() if k not in SPEED_ONLY}
    return hashlib.sha256(json.dumps([stage, kept], sort_keys=True, default=str).encode()).hexdigest()


@dataclass
class Context:
    """A session and the folder its stage tables lie in."""

    spark: SparkSession
    base: str

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def read(self, name: str, hint: str = "") -> DataFrame:
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as e:
            raise InputError(f"there is no table {name} in {self.base}. {hint}".strip()) from e

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def ledger(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(self.path("ledger"))
        except AnalysisException:
            return self.spark.createDataFrame([], LEDGER)

    def record(self, stage: str, params: dict, versions: dict | None = None) -> None:
        row = (stage, json.dumps(params, sort_keys=True, default=str), json.dumps(versions or {}, sort_keys=True), datetime.now(UTC).replace(tzinfo=None), fingerprint(stage, params))
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(self.path("ledger"))

    def done(self, stage: str, params: dict) -> bool:
        """Whether the stage last completed with the same parameters."""
        last = self.ledger().where(F.col("stage") == stage).orderBy(F.desc("completed")).limit(1).collect()
        return bool(last) and last[0]["fingerprint"] == fingerprint(stage, params)

    def status(self, chain: list[str] = CHAIN) -> DataFrame:
        return manifest.ledger_status(self.ledger(), chain)

    def stale(self, chain: list[str] = CHAIN) -> DataFrame:
        return manifest.stale_stages(self.ledger(), chain)


def run_stage(ctx: Context, stage: str, params, work: Callable[[Context, object], object], force: bool = False, dry_run: bool = False) -> str:
    """Run a stage unless its ledger entry has the same parameters: 'ran', 'skipped' or 'planned'."""
    p = asdict(params) if is_dataclass(params) else dict(params)
    if not force and ctx.done(stage, p):
        return "skipped"
    if dry_run:
        return "planned"
    work(ctx, params)
    ctx.record(stage, p, {"spark": ctx.spark.version})
    for r in ctx.stale().collect():
        log.warning("%s is older than %s", r["stage"], r["upstream"])
    return "ran"


class RunStore:
    """Named results of a stage side by side: list, pack, unpack, delete."""

    def __init__(self, ctx: Context, name: str = "store"):
        self.ctx, self.root = ctx, ctx.path(name)

    def _fs(self, path: str):
        jvm, conf = self.ctx.spark._jvm, self.ctx.spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf), p

    def names(self) -> list[str]:
        fs, p = self._fs(self.root)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def pack(self, run: str, table: str, overwrite: bool = False) -> None:
        if "/" in run or not run:
            raise InputError(f"not a run name: {run!r}")
        if run in self.names() and not overwrite:
            raise InputError(f"there is a run {run} already")
        self.ctx.read(table).write.mode("overwrite").parquet(f"{self.root}/{run}")

    def unpack(self, run: str, table: str) -> DataFrame:
        if run not in self.names():
            raise InputError(f"there is no run {run}")
        return self.ctx.write(table, self.ctx.spark.read.parquet(f"{self.root}/{run}"))

    def delete(self, run: str) -> None:
        fs, p = self._fs(f"{self.root}/{run}")
        if not fs.delete(p, True):
            raise InputError(f"there is no run {run}")


def unpack_clusters(clusters: DataFrame, path: str, with_representative: bool = True) -> None:
    """One folder of members per representative."""
    rows = clusters if with_representative else clusters.where("representative != member")
    rows.write.mode("overwrite").partitionBy("representative").parquet(path)
