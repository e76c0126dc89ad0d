"""Command line: stages and whole runs over a work folder, single dereplications, queries, ledgers."""

from __future__ import annotations

import argparse
import sys
import typing
from dataclasses import MISSING, fields

from .plans.registry import EngineError, aligners, dereplicators, tree_builders


def _options(p: argparse.ArgumentParser, made: type, skip: tuple[str, ...] = ()) -> None:
    """An option for each field of a parameter class."""
    kinds = typing.get_type_hints(made)
    for f in fields(made):
        if f.name in skip:
            continue
        name, kind = "--" + f.name.replace("_", "-"), kinds[f.name]
        if kind is bool:
            p.add_argument(name, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            plain = next(k for k in (*typing.get_args(kind), kind) if k is not type(None))
            p.add_argument(name, type=plain, required=f.default is MISSING, default=None if f.default is MISSING else f.default)


def _given(made: type, a: argparse.Namespace):
    return made(**{f.name: getattr(a, f.name) for f in fields(made) if hasattr(a, f.name)})


def parser() -> argparse.ArgumentParser:
    from . import __version__
    from .plans import stages

    p = argparse.ArgumentParser(prog="cladeworks")
    p.add_argument("--version", action="version", version=__version__)
    sub = p.add_subparsers(dest="command", required=True)
    for name, made in (("metadata", stages.Metadata), ("genome", stages.Genome), ("dereplicate-genomes", stages.Dereplicate), ("phylo", stages.Phylo), ("tree2tax", stages.Tree2Tax)):
        s = sub.add_parser(name, help=f"the stage over a work folder: {made.__doc__.splitlines()[0]}")
        s.add_argument("folder")
        s.add_argument("--force", action="store_true")
        _options(s, made)
    r = sub.add_parser("run", help="all stages over a work folder with the tables taxa and sequences")
    r.add_argument("folder")
    r.add_argument("--dry-run", action="store_true")
    r.add_argument("--force", action="store_true")
    for made, skip in ((stages.Metadata, ()), (stages.Genome, ()), (stages.Dereplicate, ()), (stages.Phylo, ("size", "scaled")), (stages.Tree2Tax, ())):
        _options(r, made, skip)
    for name in ("dereplicate", "dereplicate-chunk"):
        d = sub.add_parser(name, help="representatives of the records of a parquet table" if name == "dereplicate" else "the same for one chunk of a larger table")
        d.add_argument("table")
        d.add_argument("out")
        d.add_argument("--id", default="doc_id")
        d.add_argument("--text", default="text")
        d.add_argument("--threshold", type=float, default=0.8)
        if name == "dereplicate":
            d.add_argument("--chunk-size", type=int)
    m = sub.add_parser("dereplicate-merge", help="the representatives of chunk results, over the table the chunks were taken from")
    m.add_argument("table")
    m.add_argument("out")
    m.add_argument("chunks", nargs="+")
    m.add_argument("--id", default="doc_id")
    m.add_argument("--text", default="text")
    m.add_argument("--threshold", type=float, default=0.8)
    q = sub.add_parser("query", help="run a query by name over a folder of tables")
    q.add_argument("name")
    q.add_argument("folder")
    q.add_argument("out")
    for name, text in (("status", "the ledger of a work folder"), ("stale", "stages that are older than one before them")):
        sub.add_parser(name, help=text).add_argument("folder")
    for name, text in (("export", "the results of a run as text tables"), ("versions", "what the stages were run with"), ("glance", "similarities of the genomes of a work folder")):
        e = sub.add_parser(name, help=text)
        e.add_argument("folder")
        e.add_argument("out")
    for name, text in (("pack", "keep a table of a work folder under a name"), ("unpack", "bring a kept table back")):
        e = sub.add_parser(name, help=text)
        e.add_argument("folder")
        e.add_argument("run")
        e.add_argument("--table", default="clusters")
    e = sub.add_parser("runs", help="kept tables; --delete removes one")
    e.add_argument("folder")
    e.add_argument("--delete")
    sub.add_parser("list-tools", help="registered strategies")
    return p


def _table(spark, a) -> int:
    """Commands over a table of records."""
    from pyspark.sql import functions as F

    from .operators import cover, sketch
    from .plans import dereplicate, stages
    from .session import cut

    df = spark.read.parquet(a.table)
    if a.command == "dereplicate-merge":
        found = cut(stages.gather(cut(stages.read_chunks(spark, a.chunks)), cut(sketch.word_sketch(df, a.id, a.text)), dereplicate.fraction(a.threshold)))
        r = dereplicate.Result(found, cover.statuses(found))
    elif getattr(a, "chunk_size", None):
        sk = cut(sketch.word_sketch(df, a.id, a.text))
        r = dereplicate.chunked(sk, df.select(F.col(a.id).alias("id")), a.chunk_size, dereplicate.fraction(a.threshold))
    else:
        r = dereplicate.by_sketch(df, a.id, a.text, a.threshold)
    r.clusters.write.mode("overwrite").parquet(f"{a.out}/clusters")
    r.status.write.mode("overwrite").parquet(f"{a.out}/status")
    return 0


def _folder(spark, a) -> int:
    """Commands over a work folder."""
    from .operators import distances
    from .plans import stages
    from .plans.pipeline import Context, RunStore, run_stage
    from .sources import sinks

    ctx = Context(spark, a.folder)
    single = {"metadata": stages.Metadata, "genome": stages.Genome, "dereplicate-genomes": stages.Dereplicate, "phylo": stages.Phylo, "tree2tax": stages.Tree2Tax}
    if a.command in single:
        name = "dereplicate" if a.command == "dereplicate-genomes" else a.command
        print(name, run_stage(ctx, name, _given(single[a.command], a), stages.STAGES[name], a.force), sep="\t")
    elif a.command == "run":
        p = stages.Run(*(_given(k, a) for k in single.values()))
        for name, what in stages.run(ctx, p, a.dry_run, a.force).items():
            print(name, what, sep="\t")
    elif a.command == "export":
        stages.export(ctx, a.out)
    elif a.command == "versions":
        sinks.versions(ctx.ledger(), a.out)
    elif a.command == "glance":
        from pyspark.sql import functions as F

        from .session import cut

        g = ctx.read("genomes")
        sk = cut(stages.sketches(ctx, g, 31, 1000))
        d = stages.sketch_distances(sk, g.select(F.col("accession").alias("id"))).where("a != b").select("a", "b", (1 - F.col("d")).alias("s"))
        distances.overview(d.unionByName(d.select(F.col("b").alias("a"), F.col("a").alias("b"), "s")), 0.0, 1.0).write.mode("overwrite").parquet(a.out)
    elif a.command in ("pack", "unpack"):
        getattr(RunStore(ctx), a.command)(a.run, a.table)
    elif a.command == "runs":
        store = RunStore(ctx)
        if a.delete:
            store.delete(a.delete)
        print("\n".join(store.names()))
    else:
        (ctx.status().orderBy("ord") if a.command == "status" else ctx.stale()).show(truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "list-tools":
        for r in (dereplicators, aligners, tree_builders):
            for n in r.names():
                c = r.capability(n)
                print(f"{r.kind}\t{n}\t{'unbounded' if c.most is None else c.most}")
        return 0
    from pyspark.sql import SparkSession

    from .session import mark, release

    spark = SparkSession.builder.appName("cladeworks").getOrCreate()
    since = mark()
    try:
        if a.command == "query":
            from .queries import catalogue

            if a.name not in catalogue.QUERIES:
                raise EngineError(f"no query named {a.name}")
            catalogue.QUERIES[a.name](spark, a.folder).write.mode("overwrite").parquet(a.out)
            return 0
        return _table(spark, a) if hasattr(a, "id") else _folder(spark, a)
    except EngineError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    finally:
        release(spark, since)


if __name__ == "__main__":
    sys.exit(main())
