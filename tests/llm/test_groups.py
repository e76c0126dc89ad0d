import random

from cladeworks.llm import groups


def components(links, names):
    up = {n: n for n in names}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if a in up and b in up and a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    by = {}
    for n in names:
        by.setdefault(top(n), []).append(n)
    return {(min(v), n) for v in by.values() if len(v) > 1 for n in v}


def run(spark, links, names):
    ls = spark.createDataFrame(links, "x string, y string")
    vs = spark.createDataFrame([(n, 1) for n in names], "name string, id bigint")
    return {tuple(r) for r in groups.groups(ls, vs).select("group_key", "name").collect()}


def test_random_graph_star_and_chain(spark):
    r = random.Random(1)
    names = [f"n{i:03}" for i in range(300)]
    links = [(r.choice(names[:120]), r.choice(names[:120])) for _ in range(90)]
    links += [("n150", names[i]) for i in range(150, 220)]  # a hub
    links += [(names[i + 1], names[i]) for i in range(230, 270)]  # a chain
    links += [(None, "n001"), ("n001", None), ("n002", "n002"), ("unknown", "n290"), ("unknown", "n291"), links[0], links[0][::-1]]
    want = components([x for x in links if None not in x], names)
    assert run(spark, links, [*names, names[0], None]) == want


def test_empty(spark):
    assert run(spark, [], ["a"]) == set()
    assert run(spark, [("a", "b")], []) == set()
    assert run(spark, [("a", "b")], ["a", "b"]) == {("a", "a"), ("a", "b")}


def test_hash_is_one_to_one(spark):
    from pyspark.sql import functions as F

    df = spark.range(20000).select(F.xxhash64("id").alias("x"))
    for k in range(3):
        assert df.select(groups._order_hash(F.col("x"), k, 0).alias("y")).distinct().count() == 20000


def test_links_read_all_name_forms(spark):
    g = spark.createDataFrame([("A.1", "F_g_s_B.1.fasta"), ("B.1", None), ("C.1", "  "), ("D.1", "RS_C.1")], "accession string, representative string")
    c = spark.createDataFrame([("genomes/F_g_s_A.1.fasta.gz ", "/x/E.1.fa"), ("representative", "member")], "representative string, member string")
    got = {tuple(r) for r in groups.genome_links(g, c).collect()}
    assert got == {("A.1", "B.1"), ("B.1", None), ("C.1", None), ("D.1", "C.1"), ("A.1", "E.1"), ("representative", "member")}


def test_rounds_on_paths_stars_and_grids(spark):
    """A quarter of the vertices is expected to go in a round; so many rounds are far beyond that."""
    path = [(i, i + 1) for i in range(2000)]
    star = [(0, i) for i in range(1, 2000)]
    grid = [(40 * i + j, 40 * i + j + 1) for i in range(40) for j in range(39)] + [(40 * i + j, 40 * (i + 1) + j) for i in range(39) for j in range(40)]
    for edges, most in ((path, 14), (star, 14), (grid, 14)):
        maps = groups.contract(spark.createDataFrame(edges, "a bigint, b bigint"), 5)
        assert len(maps) <= most, len(maps)
        n = len({v for e in edges for v in e})
        ends = groups.expand(maps).collect()
        assert len(ends) == n and len({(r["level"], r["r"]) for r in ends}) == 1
