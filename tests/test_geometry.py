import random

import pytest
from pyspark.sql import functions as F

from cladeworks.operators import alignment, distances, trees
from cladeworks.plans.registry import InputError
from cladeworks.sources import blocks


def test_maf_projection(spark, rows, tmp_path):
    p = tmp_path / "x.maf"
    p.write_text("##maf\n\na\ns ref.c1 8 4 + 12 GGGG\ns qry.c1 8 4 + 12 GGGA\n\na\ns ref.c1 0 8 + 12 ACGT-ACGT\ns qry.c1 0 9 + 12 ACGAAACGT\ns oth.c 0 1 + 1 AAAAAAAAA\n")
    got = alignment.project_blocks(blocks.maf_genomes(blocks.maf(spark, str(p))), "ref")
    assert [(r["genome"], r["seq"]) for r in got.collect()] == [("ref", "ACGTACGTGGGG"), ("oth", "AAAAAAAA----"), ("qry", "ACGAACGTGGGA")]
    got = alignment.project_blocks(blocks.maf_genomes(blocks.maf(spark, str(p))), "ref", exclude=["oth"])
    assert [r["genome"] for r in got.collect()] == ["ref", "qry"]
    with pytest.raises(InputError, match="oth, qry, ref"):
        alignment.project_blocks(blocks.maf_genomes(blocks.maf(spark, str(p))), "none")
    assert alignment.project_blocks(blocks.maf_genomes(blocks.maf(spark, str(p))).limit(0), "ref").collect() == []
    p.write_bytes(p.read_bytes().replace(b"\n", b"\r\n").replace(b"\r\n\r\na", b"\r\n\r\n\r\na"))
    again = alignment.project_blocks(blocks.maf_genomes(blocks.maf(spark, str(p))), "ref", exclude=["oth"])
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in got.collect()]


def test_xmfa_projection(spark, tmp_path):
    p = tmp_path / "x.xmfa"
    p.write_text("#Sequence1File\tref\n#Sequence2File\tq\n> 1:1-4 + ref\nAC-GT\n> 2:1-5 + q\nACCGA\n=\n> 1:7-9 - ref\nAAC\n> 2:7-9 + q\nAAT\n=\n> 2:1-3 + q\nAAA\n=\n")
    got = alignment.project_xmfa(blocks.xmfa(spark, str(p)), "ref").collect()
    assert [(r["genome"], r["seq"]) for r in got] == [("ref", "ACGT--GTT"), ("q", "ACGA--ATT")]


def test_snps(spark, rows):
    m = spark.createDataFrame([("ref", "ACGTACGT"), ("s1", "ACGAACGT"), ("s2", "ACGTACGA"), ("long", "ACGTACGTTT")], "name string, seq string")
    assert rows(alignment.variable_sites(m)) == [(3,), (7,)]
    assert rows(alignment.core_alignment(m)) == [("long", "TT"), ("ref", "TT"), ("s1", "AT"), ("s2", "TA")]
    d = {(r["a"], r["b"]): r["d"] for r in alignment.hamming(m).collect()}
    assert d[("ref", "s1")] == 1 and d[("s1", "s2")] == 2 and d[("long", "ref")] == 0
    assert rows(alignment.variable_sites(m, ignore="A")) == [] and alignment.hamming(m.limit(0)).collect() == []
    assert [r["d"] for r in alignment.hamming(m.where("name in ('ref', 'long')")).collect()] == [0]


def test_blocks_of_rows_and_columns(spark, monkeypatch):
    r = random.Random(7)
    texts = {f"n{k:02}": "".join(r.choice("ACGTé𝔸") for _ in range(40)) for k in range(23)}
    m = spark.createDataFrame([*texts.items(), (None, "A" * 40), ("none", None)], "name string, seq string").repartition(3)
    want = {(a, b): sum(x != y for x, y in zip(texts[a], texts[b])) for a in texts for b in texts if a < b}
    monkeypatch.setattr(alignment, "ROWS", 5)
    monkeypatch.setattr(alignment, "BLOCK", 7)
    assert {(x["a"], x["b"]): x["d"] for x in alignment.hamming(m).collect()} == want


def test_flanks_are_screened(spark):
    rows = [(0, "ref", 1, 10, "+", "ACGT-ACGTAC"), (0, "q", 1, 11, "+", "ACGTTAC-TAC")]
    df = spark.createDataFrame(rows, "block bigint, genome string, p1 bigint, p2 bigint, sign string, text string")
    got = {x["genome"]: x["seq"] for x in alignment.project_xmfa(df, "ref", flank=1).collect()}
    # blank: one column at each end, those beside the removed column, the gap and its neighbours
    assert got == {"ref": "-CG-----A-", "q": "-CG-----A-"}
    keep, blank = alignment.screened("AC-GTA", ["ACCGTA"], 0)
    assert keep.tolist() == [0, 1, 3, 4, 5] and not blank.any()


def test_outgroup(spark, rows):
    d = spark.createDataFrame([("a", "x", 0.1), ("b", "x", 0.9), ("a", "y", 0.8), ("b", "y", 0.85), ("a", "w", 0.2), ("b", "w", 0.3)], "s string, o string, d double")
    assert rows(distances.outgroup(d), "o") == [("y",)]
    assert distances.outgroup(d.limit(0)).collect() == []
    k = spark.createDataFrame([("a", "b", 0.951), ("b", "a", 0.8), ("a", "a", 1.0)], "a string, b string, s double")
    assert rows(distances.overview(k, 0.8, 1.0)) == [(0, 1), (75, 1)]


def additive(n, seed):
    """Distances along a random tree."""
    r = random.Random(seed)
    at = [(0.0, ())]
    paths = []
    for i in range(n):
        base = r.choice(paths) if paths else ()
        base = base[: r.randrange(len(base) + 1)]
        paths.append((*base, (f"e{i}", r.uniform(0.1, 1))))
    d = [[sum(w for e, w in set(a) ^ set(b)) for b in paths] for a in paths]
    return d, at


def leaf_distances(nodes):
    parent = {i: (p, w or 0.0) for i, p, _, w in nodes}
    leaves = {x: i for i, _, x, _ in nodes if x}

    def up(i):
        out, d = {i: 0.0}, 0.0
        while parent[i][0] >= 0:
            d += parent[i][1]
            i = parent[i][0]
            out[i] = d
        return out

    return {(a, b): min(x + up(leaves[b])[k] for k, x in up(leaves[a]).items() if k in up(leaves[b])) for a in leaves for b in leaves}


def test_neighbour_joining():
    assert trees.join_neighbours(["A"], [[0]]) == "(A:0.0);"
    assert trees.join_neighbours(["A", "B c"], [[0, 1], [1, 0]]) == "(A:0.500000,B_c:0.500000);"
    d = [[0, 5, 9, 9, 8], [5, 0, 10, 10, 9], [9, 10, 0, 8, 7], [9, 10, 8, 0, 3], [8, 9, 7, 3, 0]]
    got = leaf_distances(trees.read_newick(trees.join_neighbours(list("abcde"), d)))
    for i, a in enumerate("abcde"):
        for j, b in enumerate("abcde"):
            assert got[(a, b)] == pytest.approx(d[i][j], abs=1e-5)


def test_newick_and_reroot():
    n = trees.read_newick("((a_1:1,'b x':2)0.9:3,(c:1,d:1):1);")
    assert [x[2] for x in n if x[2]] == ["0.9", "a_1", "b x", "c", "d"]
    r = trees.reroot(n, "d")
    assert r[0][1] == -1 and r[1][2] == "d" and len({x[0] for x in r}) == len(r)
    before, after = leaf_distances(n), leaf_distances(r)
    for k in (("a_1", "d"), ("a_1", "c"), ("c", "d"), ("b x", "c")):
        assert before[k] == pytest.approx(after[k])
    assert trees.reroot(n, "none") == n


def test_tree_relations(spark, rows):
    t = spark.createDataFrame([("((1,2),(3,4));",)], "newick string")
    nodes = trees.tree_table(t)
    h12, h34 = trees.clade_hash(["1", "2"]), trees.clade_hash(["4", "3"])
    want = sorted([("1", h12), ("2", h12), ("3", h34), ("4", h34), (h12, "root"), (h34, "root")], key=repr)
    assert rows(trees.relations(nodes)) == want
    got = rows(trees.relations(trees.tree_table(t, outgroup="4"), drop_leaf="4"))
    assert ("3", trees.clade_hash(["1", "2", "3"])) not in got and not any("4" == a for a, _ in got)
    assert {"1", "2", "3"} <= {a for a, _ in got}
    named = rows(trees.clade_names(nodes, "n"))
    assert sorted(n for _, n in named) == ["n0", "n1", "root"]
    c = spark.createDataFrame([("F_g_s_A.1.fasta", "F_g_s_B.1.fasta"), ("F_g_s_A.1.fasta", "F_g_s_A.1.fasta")], "representative string, member string")
    leaves = spark.createDataFrame([("F_g_s_A.1",)], "leaf string")
    assert rows(trees.genome_map(leaves, c)) == [("A.1", "F_g_s_A.1"), ("B.1", "F_g_s_A.1")]


def test_first_pair_agrees(spark):
    d = [[0, 5, 9, 9, 8], [5, 0, 10, 10, 9], [9, 10, 0, 8, 7], [9, 10, 8, 0, 3], [8, 9, 7, 3, 0]]
    pairs = [(i, j, float(d[i][j])) for i in range(5) for j in range(5) if i != j]
    r = trees.nj_first_pair(spark.createDataFrame(pairs, "a int, b int, d double")).first()
    assert (r["a"], r["b"]) == (0, 1)
    text = trees.nj_tree(spark.createDataFrame(pairs, "a int, b int, d double").select("a", "b", F.col("d"))).first()["newick"]
    assert text.endswith(";") and text.count("(") == 4


def test_overview_counts_pairs_of_documents(spark, rows):
    from statistics import quantiles

    from cladeworks.queries.geometry import _pairs

    members = spark.createDataFrame([(1, 1), (4, 1), (5, 1), (2, 2), (6, 2), (3, 3)], "id bigint, class_id bigint")
    edges = spark.createDataFrame([(1, 2, 0.91), (2, 3, 0.83)], "a bigint, b bigint, jaccard double")
    p = _pairs(members, edges).cache()
    every = [x for x in [0.91] * 6 + [0.83] * 2 + [1.0] * 4 for _ in range(2)]
    assert rows(distances.overview(p, 0.8, 1.0, 10, "w")) == [(1, 4), (5, 12), (9, 8)]
    got = distances.five_numbers(p, 0.8, 1.0, "w").first()
    assert tuple(got) == pytest.approx((24, 0.83, *quantiles(every, n=4, method="inclusive"), 1.0))
    assert distances.five_numbers(p.limit(0), 0.8, 1.0, "w").first()["n"] == 0


@pytest.fixture(scope="module")
def glance(spark, tmp_path_factory):
    """A folder of documents: classes {1, 4}, {2, 5}, {3}, {6, 7}, the first three with edges of 26/27, 26/29 and 27/29."""
    w = [f"w{i}" for i in range(33)]
    texts = [(1, " ".join(w[:30])), (2, " ".join(w[:31])), (3, " ".join(w[:33])), (4, ", ".join(w[:30]).upper()), (5, " ".join(w[:31])),
             (6, "x1 x2 x3 x4 x5 x6"), (7, "X1 X2 X3 X4 X5 X6"), (8, "too short"), (9, None), (None, " ".join(w[:30]))]
    folder = tmp_path_factory.mktemp("glance")
    spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def by_sql(name, folder):
    from cladeworks.queries import catalogue

    c = pytest.importorskip("duckdb").connect()
    c.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    return sorted(c.execute(catalogue.ORACLES[name]).fetchall())


def test_glance_hist_is_its_sql(spark, rows, glance):
    from cladeworks.queries import geometry

    assert rows(geometry.glance_hist(spark, glance)) == [(48, 2), (65, 2), (81, 2)]
    assert by_sql("glance_hist", glance) == [(48, 2), (65, 2), (81, 2)]
    every = rows(geometry.glance_hist_documents(spark, glance))
    assert every == by_sql("glance_hist_documents", glance) == [(48, 4), (65, 4), (81, 8), (99, 6)]


def test_glance_box_is_its_sql(spark, glance):
    from statistics import quantiles

    from cladeworks.queries import geometry

    def want(values):
        return pytest.approx((len(values), min(values), *quantiles(values, n=4, method="inclusive"), max(values)), abs=1e-9)

    e, f, g = 26 / 27, 26 / 29, 27 / 29
    got = tuple(geometry.glance_box(spark, glance).first())
    assert got == want([e, f, g] * 2)
    every = tuple(geometry.glance_box_documents(spark, glance).first())
    assert every == want([e] * 8 + [f] * 4 + [g] * 4 + [1.0] * 6)
    assert by_sql("glance_box", glance) == [got] and by_sql("glance_box_documents", glance) == [every]
