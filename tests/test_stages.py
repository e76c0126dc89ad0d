import random

import pytest

from cladeworks.operators import cover
from cladeworks.plans import dereplicate, stages
from cladeworks.plans.pipeline import Context
from cladeworks.plans.registry import InputError
from cladeworks.sources import sinks
from cladeworks.session import cut


def dna(seed, n=400):
    r = random.Random(seed)
    return "".join(r.choice("ACGT") for _ in range(n))


def near(seq, seed, changes):
    r, s = random.Random(seed), list(seq)
    for k in r.sample(range(len(s)), changes):
        s[k] = "ACGT"[("ACGT".index(s[k]) + 1) % 4]
    return "".join(s)


@pytest.fixture
def folder(spark, tmp_path):
    """Three groups of near copies in two species of one genus, and an outgroup in its family."""
    ctx = Context(spark, str(tmp_path))
    taxa, seqs = [], []
    for g, species in enumerate(["una", "una", "duo"]):
        for k in range(3):
            a = f"A{g}{k}"
            taxa.append((len(taxa), a, "fam", "gen", species, k == 0))
            seqs.append((a, near(dna(g), k, k)))
    taxa += [(90, "O1", "fam", "oth", "tri", True), (91, "X1", "else", "far", "x", True), (92, "N1", "fam", "gen", "una", False)]
    seqs += [("O1", dna(50)), ("X1", dna(51)), ("A00", "")]
    ctx.write("taxa", spark.createDataFrame(taxa, "ord int, accession string, family string, genus string, species string, is_rep boolean"))
    ctx.write("sequences", spark.createDataFrame(seqs, "accession string, seq string"))
    return ctx


def test_a_whole_run(spark, folder, rows, tmp_path):
    p = stages.Run(
        stages.Metadata("genus", genus="Gen"), stages.Genome(allow_missing=True), stages.Dereplicate(0.5, size=11, scaled=1), stages.Phylo(size=11, scaled=1),
    )
    assert set(stages.run(folder, p, dry_run=True).values()) == {"planned"}
    assert set(stages.run(folder, p).values()) == {"ran"}
    assert rows(folder.read("outgroup_accession")) == [("O1",)]
    clusters = {r["member"]: r["representative"] for r in folder.read("clusters").collect()}
    assert set(clusters) == {f"A{g}{k}" for g in range(3) for k in range(3)}
    assert len(set(clusters.values())) == 3 and all(clusters[a][:2] == a[:2] for a in clusters)
    status = {r["accession"]: (r["derep_status"], r["representative"]) for r in stages.open_manifest(folder).collect()}
    assert status["O1"] == (None, None) and all(status[a] == ("representative" if clusters[a] == a else "contained", clusters[a]) for a in clusters)
    tree = folder.read("tree").first()[0]
    assert tree.count("A") >= 3 and "O1" in tree
    edges = rows(folder.read("tree2tax"))
    assert not any("O1" in a for a, _ in edges) and sum("_A" in a for a, _ in edges) == 3
    mapped = dict(rows(folder.read("genomes_map"), "accession", "leaf"))
    assert {a: leaf.split("_")[-1] for a, leaf in mapped.items()} == clusters
    # unchanged parameters run nothing; changed ones run their stage and those after it
    assert set(stages.run(folder, p).values()) == {"skipped"}
    p.phylo.all_genomes = True
    again = stages.run(folder, p)
    assert again == {"metadata": "skipped", "genome": "skipped", "dereplicate": "skipped", "phylo": "ran", "tree2tax": "ran"}
    stages.export(folder, str(tmp_path / "out"))
    lines = [x for f in (tmp_path / "out" / "clusters").glob("part*") for x in f.read_text().splitlines()]
    assert lines[0] == "representative\tmember" and len(lines) == 10
    assert [f.read_text() for f in (tmp_path / "out" / "versions").glob("part*")] == [f"spark: {spark.version}\n"]
    assert [f.read_text() for f in (tmp_path / "out" / "outgroup_accession").glob("part*")] == ["O1\n"]


def test_selection_rules(folder, rows):
    stages.metadata(folder, stages.Metadata("species", genus="gen", species="una", dataset="rep", outgroup="X1"))
    assert rows(folder.read("selection"), "accession", "is_outgroup") == [("A00", "0"), ("A10", "0"), ("X1", "1")]
    stages.metadata(folder, stages.Metadata("family", family="fam", no_outgroup=True, limit=2))
    assert rows(folder.read("selection"), "accession") == [("A00",), ("A01",)]
    with pytest.raises(InputError, match="no record has the target"):
        stages.metadata(folder, stages.Metadata("genus", genus="none"))
    with pytest.raises(InputError, match="to be the outgroup"):
        stages.metadata(folder, stages.Metadata("genus", genus="gen", outgroup="none"))
    stages.metadata(folder, stages.Metadata("genus", genus="gen"))
    with pytest.raises(InputError, match="N1"):
        stages.genome(folder, stages.Genome())


def test_validators():
    for bad in (dict(level="class", family="x"), dict(level="genus"), dict(level="species", species="x"), dict(level="genus", genus="g", dataset="some")):
        with pytest.raises(InputError):
            stages.Metadata(**bad)
    for bad in (dict(threshold=0), dict(threshold=101), dict(reduce="order"), dict(target=0), dict(target=5, chunk_size=3)):
        with pytest.raises(InputError):
            stages.Dereplicate(**bad)
    assert stages.Dereplicate(95).threshold == 0.95 and stages.release_name("214.1") == "214.1"
    with pytest.raises(InputError):
        stages.release_name("r214")


def test_manifest_layouts(spark, tmp_path):
    ctx = Context(spark, str(tmp_path))
    assert stages.open_manifest(ctx).collect() == []
    ctx.write("manifest", spark.createDataFrame([("a", "x")], "accession string, family string"))
    assert tuple(stages.open_manifest(ctx).first()) == ("a", None, "x", None, None, None, None, None)
    ctx.write("manifest", spark.createDataFrame([("a", 99)], "accession string, schema_version int"))
    with pytest.raises(InputError, match="99"):
        stages.open_manifest(ctx)


def graph(spark, seed=3, n=60):
    """Sketches of families of sets at all distances."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        own = set(range(1000 * (i // 6), 1000 * (i // 6) + 40))
        for k in r.sample(sorted(own), r.randrange(0, 8)):
            own.discard(k)
        out += [(i, h) for h in own]
    return cut(spark.createDataFrame(out, "id bigint, h bigint")), cut(spark.range(n + 1).toDF("id"))


def test_scatter_and_gather_lose_nobody(spark):
    sk, everyone = graph(spark)
    parts = cut(stages.scatter(sk, everyone, 20, 0.8))
    assert {(r["chunk"], r["member"]) for r in parts.collect()} == {(min(i // 20, 2), i) for i in range(61)}
    assert parts.join(parts.selectExpr("member as representative", "chunk as own"), "representative").where("own != chunk").count() == 0
    whole = stages.gather(parts, sk, 0.8)
    got = {r["member"]: r["representative"] for r in whole.collect()}
    assert set(got) == set(range(61)) and whole.count() == 61 and all(got[r] == r for r in got.values())
    assert {(r["representative"], r["member"]) for r in dereplicate.chunked(sk, everyone, 100, 0.8).clusters.collect()} == {
        (r["representative"], r["member"]) for r in dereplicate.cover_sketch(sk, everyone, 0.8).collect()}
    with pytest.raises(InputError):
        stages.gather(parts.limit(0), sk, 0.8)


def test_target_search_takes_the_nearest(spark):
    from cladeworks.operators import similarity

    sk, _ = graph(spark, 4, 30)
    members = cut(similarity.classes(sk))
    edges = cut(similarity.class_edges(sk, members, 0.8))

    def count(t):
        return dereplicate.cover_edges(members, cut(edges.where(f"jaccard >= {t}"))).select("representative").distinct().count()

    for want in (5, 12, 29):
        t, n, trace = dereplicate.search_target(edges, members, want)
        assert trace[0][0] == 0.89995 and len(trace) <= 12 and count(t) == n
        assert min(abs(m - want) for _, m in trace) == abs(n - want)
        assert next(x for x, m in trace if abs(m - want) == abs(n - want)) == t


def test_sketches_are_kept(spark, tmp_path):
    ctx = Context(spark, str(tmp_path))
    g = spark.createDataFrame([("a", dna(1)), ("b", "ACG")], "accession string, seq string")
    one = stages.sketches(ctx, g, 11, 1)
    assert {r["id"] for r in one.collect()} == {"a"}
    n = ctx.read("sketches-11-1").count()
    more = g.unionByName(spark.createDataFrame([("c", dna(2))], "accession string, seq string"))
    assert {r["id"] for r in stages.sketches(ctx, more, 11, 1).collect()} == {"a", "c"}
    assert stages.sketches(ctx, g, 11, 1).count() == one.count() and ctx.read("sketches-11-1").count() > n


def test_sinks(spark, rows, tmp_path):
    pairs = spark.createDataFrame([("b", "a", 3), ("a", "c", 1), ("b", "c", 2)], "a string, b string, d bigint")
    labels = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    assert [tuple(r) for r in sinks.square(pairs, labels).collect()] == [("a", 0, 3, 1), ("b", 3, 0, 2), ("c", 1, 2, 0)]
    sinks.matrix(pairs, labels, str(tmp_path / "m"))
    assert [f.read_text().split("\n")[1] for f in (tmp_path / "m").glob("part*")] == ["a\t0\t3\t1"]
    ledger = spark.createDataFrame([('{"x": "1", "y": "2"}', 1), ('{"x": "3"}', 2)], "versions string, completed int")
    assert rows(sinks.merged_versions(ledger)) == [("x", "3"), ("y", "2")]
    status = cover.statuses(pairs.selectExpr("a as representative", "b as member"))
    sinks.records(status, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
