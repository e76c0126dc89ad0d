from datetime import datetime

from cladeworks.operators import manifest, select
from cladeworks.plans.registry import Capability, Registry, UnknownStrategy


def test_targets_and_outgroup(spark, rows):
    df = spark.createDataFrame([
        (0, "x", "Fam", "Other", "sp", True), (1, "a", "Fam", "Gen", "one", True), (2, "b", "Fam", "Gen", "two", False),
        (3, "c", "Fam", "Third", "sp", True), (4, "d", "Fam2", "Gen", "one", True),
    ], "ord int, accession string, family string, genus string, species string, is_rep boolean")
    t = select.resolve_target(df, genus="gen", species="ONE")
    assert rows(t) == [("Fam", "Gen", "one")]
    sel = select.select_taxon(df, t, "genus")
    assert rows(sel, "accession") == [("a",), ("b",)]
    assert rows(select.select_taxon(df, t, "genus", 1), "accession") == [("a",)]
    assert rows(select.pick_outgroup(df, t, "genus", sel, rep=df.is_rep), "accession") == [("x",)]
    assert select.resolve_target(df, genus="none").collect() == []


def test_lengths(spark, rows):
    df = spark.createDataFrame([("a", 300, "d1", 1), ("a", 311, "d0", 0), ("b", 900, None, 2), ("b", None, "z", 3)], "k string, n bigint, d string, o int")
    assert rows(select.length_stats(df, "k", "n", "d", "o")) == [("a", 2, 300, 311, 305, 305, "d0"), ("b", 1, 900, 900, 900, 900, None)]
    assert rows(select.length_band(df, "k", "n")) == [(542, 662)]
    assert rows(select.length_band(df, "k", "n", method="all")) == [(300, 900)]
    assert rows(select.within(df, select.length_band(df, "k", "n", method="all"), "n"), "n") == [(300,), (311,), (900,)]
    assert select.within(df, select.length_band(df.limit(0), "k", "n"), "n").collect() == []


def test_matches_and_caps(spark, rows):
    df = spark.createDataFrame([("Alpha-virus", "s p", "Human x 1"), (None, "sp", None)], "genus string, species string, organism string")
    assert len(rows(df.where(select.matches({"genus": ["alphavirus"], "serotype": ["humanx"]}, df.columns)))) == 1
    assert len(rows(df.where(select.matches({"species": ["SP"]}, df.columns)))) == 2
    assert rows(df.where(select.matches({}, df.columns))) == []
    assert rows(df.where(select.matches({"custom": ["species: sp", "organism:none"]}, df.columns))) == []
    assert len(rows(df.where(select.matches({"custom": ["species: sp", "organism:none"]}, df.columns, any_custom=True)))) == 2
    c = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), (None, 5)], "k string, o int")
    assert rows(select.capped(c, "k", 2, "o")) == [("a", 1), ("a", 2), (None, 5)]


def test_segments(spark, rows):
    df = spark.createDataFrame([("A b", 5, 1, "x1", "AA"), ("A b", 9, 2, "x2", "CC"), ("A b", 9, 0, "x3", "GG"), ("solo", 1, 3, "x4", "T"), (None, 1, 4, "x5", "N"), ("", 1, 5, "x6", "M")], "iso string, l int, o int, a string, s string")
    assert rows(select.segments(df, "iso", "l", "o", "a", "s")) == [("iso-A-b", 3, "GGCCAA"), ("x4", 1, "T"), ("x5", 1, "N"), ("x6", 1, "M")]


def test_manifest(spark, rows):
    old = spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], "k string, v string, t int")
    new = spark.createDataFrame([("a", None, 2), ("a", "late", 3), ("c", "n", 1), (None, "q", 9)], "k string, v string, t int")
    assert rows(manifest.upsert(old, new, "k", "t")) == [("a", "late", 3), ("b", "y", 1), ("c", "n", 1)]
    m = spark.createDataFrame([("a", None, None), ("b", "representative", None)], "accession string, derep_status string, representative string")
    s = spark.createDataFrame([("a", "contained", "b"), ("zz", "contained", "b")], "accession string, derep_status string, representative string")
    assert rows(manifest.set_status(m, s)) == [("a", "contained", "b"), ("b", "representative", None)]
    at = [datetime(2024, 1, i) for i in range(1, 4)]
    led = spark.createDataFrame([("one", at[0]), ("one", at[2]), ("two", at[1])], "stage string, completed timestamp")
    got = rows(manifest.ledger_status(led, ["one", "two", "three"]), "stage", "next")
    assert got == [("one", False), ("three", True), ("two", False)]
    assert rows(manifest.stale_stages(led, ["one", "two", "three"])) == [("two", "one")]


def test_registry():
    r = Registry("tool")
    r.add(Capability("small", most=10), "math:sqrt")
    r.add(Capability("big"), lambda x: x)
    r.add(Capability("broken"), "no_such_module:x")
    assert r.choose(5) in ("big", "broken") and r.get("small")(4) == 2
    assert "advised" in r.warning("small", 11) and r.warning("small", 10) is None
    try:
        r.get("none")
        raise AssertionError
    except UnknownStrategy:
        pass
