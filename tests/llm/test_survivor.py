from datetime import datetime

from pyspark.sql import functions as F

from cladeworks.llm import survivor

I = "qc_id bigint, genome string, qc_source string, completeness string, contamination string, genome_length string, n50 string, centrality string, assessed_at timestamp, trust int"
D = [datetime(2024, 1, d) for d in range(1, 10)]


LEARNED = ("trust", "assessed_at")


def run(spark, info, members, stated=survivor.STATED):
    m = spark.createDataFrame(members, "accession string, representative string")
    s = spark.createDataFrame([("A", 9), ("b", 5), ("c", 5), ("B ", 4), (None, 99)], "qc_source string, trust int")
    out = survivor.survivors(spark.createDataFrame(info, I), m, s, stated)
    return {(r["representative"], r["field_name"]): r["qc_id"] for r in out.collect()}


def row(i, genome, source, at, comp=None, cont=None, length=None, n50=None, cent=None):
    return (i, genome, source, comp, cont, length, n50, cent, at, 0)


def test_numbers(spark):
    values = ["1", " 2.5 ", "3e1", ".5", "5.", "+1", "-1", "1e999", "nan", "inf", "", None, "98,4", "--", "1 2", "0x1", "1d", "1f"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert [r[0] for r in df.select(survivor.number(F.col("x"))).collect()] == [1.0, 2.5, 30.0, 0.5, 5.0, 1.0, -1.0, *[None] * 11]
    df = spark.createDataFrame([("0",), ("100",), ("100.1",), ("-0.1",), ("1",)], "x string")
    assert [r[0] for r in df.select(survivor.usable(F.col("x"), "completeness")).collect()] == [True, True, False, False, True]
    assert [r[0] for r in df.select(survivor.usable(F.col("x"), "centrality")).collect()] == [False, False, False, False, True]


def test_order(spark):
    members = [("G1", "R"), ("R", "R")]
    info = [
        row(1, "G1", "a", None, comp="90"), row(2, "R", " A", D[0], comp="80", cont="x"), row(3, "R", "b", D[5], comp="99", cont="1"),
        row(4, "G1", "b", D[5], cont="2"), row(5, "G1", None, D[8], cont="3", n50="10"), row(6, "G1", "zz", D[7], n50="9"), row(7, "G1", "c", D[4], n50="0"),
        row(8, "other", "a", D[8], comp="1", n50="1"), row(9, None, "a", D[8], comp="1"), row(2, "R", " A", D[0], comp="80", cont="x"),
    ]
    assert run(spark, info, members) == {("R", "completeness"): 2, ("R", "contamination"): 3, ("R", "n50"): 5}
    assert run(spark, [], members) == {} and run(spark, info, []) == {}


def test_learned_precedence_orders_undated_rows(spark):
    members = [("G", "R"), ("H", "R2")]
    # completeness goes from the sixties over the seventies to the eighties, one step in one genome each; sources don't matter
    dated = [row(10, "H", "b", D[0], comp="62"), row(11, "H", "c", D[1], comp="71"), row(12, "K", "c", D[2], comp="72"), row(13, "K", "b", D[3], comp="88")]
    undated = [row(1, "G", "c", None, comp="61", n50="5"), row(2, "G", "b", None, comp="86", n50="6"), row(3, "G", "b", None, comp="73"), row(4, "G", "c", None, comp="12")]
    info = [*undated, *dated]
    assert run(spark, info, members)[("R", "completeness")] == 1
    got = run(spark, info, members, LEARNED)
    assert got[("R", "completeness")] == 2 and got[("R", "n50")] == 1
    # without the row of the eighties the seventies are latest, and what was never seen in a step is below all
    assert run(spark, [r for r in info if r[0] != 2], members, LEARNED)[("R", "completeness")] == 3
    assert run(spark, [undated[3], *dated], members, LEARNED)[("R", "completeness")] == 4
    # time and trust come first
    assert run(spark, [*info, row(5, "G", "b", D[0], comp="1")], members, LEARNED)[("R", "completeness")] == 5
    assert run(spark, [*info, row(6, "G", "A", None, comp="1")], members, LEARNED)[("R", "completeness")] == 6


def test_bins(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (1e300,), (100.0,), (4.99,)], "x double")
    assert [r[0] for r in df.select(survivor.binned(F.col("x"), "n50")).collect()] == [1, 1, 2, 63, 7, 3]
    assert [r[0] for r in df.where("x <= 100").select(survivor.binned(F.col("x"), "completeness")).collect()] == [0, 0, 0, 20, 0]


def test_transitions_across_and_within_days(spark):
    t = [("e", "x", datetime(2024, 1, 1, 1)), ("e", "y", datetime(2024, 1, 1, 2)), ("e", "z", datetime(2024, 1, 3)), ("e", "x", datetime(2024, 1, 4)), ("e", "x", datetime(2024, 1, 5)), (None, "q", D[0]), ("f", None, D[0]), ("f", "x", None)]
    df = spark.createDataFrame(t, "k string, v string, at timestamp")
    got = {tuple(r) for r in survivor.transitions(df, "k", "v", "at").collect()}
    assert got == {("", "x", "y", 1), ("", "y", "z", 1), ("", "z", "x", 1)}
    both = df.withColumn("field", F.lit("f")).unionByName(df.withColumn("field", F.lit("g")))
    assert survivor.transitions(both, "k", "v", "at", "field").count() == 6
    steps = spark.createDataFrame([("f", "a", "b", 3), ("f", "b", "a", 1), ("f", "b", "c", 2), ("f", "a", "c", 1), ("g", "b", "a", 1)], "kind string, earlier string, later string, n bigint")
    assert {tuple(r) for r in survivor.precedence(steps).collect()} == {("f", "a", 0), ("f", "b", 1), ("f", "c", 2), ("g", "b", 0), ("g", "a", 1)}


def test_groups_follow_the_current_row(spark):
    g = spark.createDataFrame([
        ("G", 1, D[0], D[0], "contained", "R"), ("G", 2, D[3], D[3], " Contained ", "F_g_s_Q.1.fasta"), ("Q.1", 3, D[0], D[0], None, None),
        ("R", 4, D[0], D[0], "representative", None), ("S", 5, D[0], D[0], "contained", "S"), ("T", 6, D[0], D[0], "contained", "gone"), (None, 7, D[0], D[0], "contained", "R"),
    ], "accession string, row_id bigint, updated_at timestamp, ingested_at timestamp, derep_status string, representative string")
    got = {tuple(r) for r in survivor.memberships(survivor.current_rows(g)).collect()}
    assert got == {("G", "Q.1"), ("Q.1", "Q.1")}


def test_precedence_of_chains_and_cycles(spark):
    def got(edges):
        steps = spark.createDataFrame([("f", a, b, 1) for a, b in edges], "kind string, earlier string, later string, n bigint")
        return {(r["v"], r["height"]) for r in survivor.precedence(steps).collect()}

    assert got(["ab", "bc"]) == {("a", 0), ("b", 1), ("c", 2)}
    assert got(["sa", "ab", "bc", "ca", "qb", "cz"]) == {("s", 0), ("q", 0), ("a", 1), ("b", 1), ("c", 1), ("z", 2)}
    assert got([]) == set()
    long = [(i, i + 1) for i in range(5000)]
    assert survivor.heights(long) == {i: i for i in range(5001)} and set(survivor.heights([*long, (5000, 0)]).values()) == {0}
