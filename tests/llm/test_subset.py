import hashlib
import random
from collections import Counter, defaultdict

from cladeworks.llm import subset

G = "accession string, family string, genus string, species string, k string, n int"
T = "target_id bigint, scope_rank string, scope_name string, subset_size bigint, n int"


def make(spark, n=400, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        f = r.choice(["Fa", "Fb"])
        g, s = r.choice([("G1", "hot"), ("G1", "hot"), ("G1", "b"), ("G2", "c"), ("G3", f"s{r.randrange(9)}")])
        rows.append((f"A{r.randrange(n)}", f if g == "G3" else "Fa", g, s, "x", i))
    rows += [rows[0], ("A1", None, "G1", "zz", "x", 0), ("A2", "Fa", " ", "zz", "x", 0), (None, "Fa", "G9", "zz", "x", 0), ("A3", "fa ", "g__g1", "s__G1 HOT", "x", 0)]
    return rows


def cell(row):
    return tuple(x.lower() for x in row[1:4])


def picks(spark, rows, targets):
    out = subset.varied_subset(spark.createDataFrame(rows, G), spark.createDataFrame(targets, T))
    got = defaultdict(list)
    for r in out.collect():
        got[r["target_id"]].append(((r["family"], r["genus"], r["species"]), r["accession"], r["pick_rank"], r["n_taxa"]))
    return got


def check(got, members, k):
    """Sizes are exact and cells filled evenly."""
    have = Counter(c for c, *_ in got)
    total = sum(map(len, members.values()))
    assert len(got) == min(k, total) and len({(c, a) for c, a, *_ in got}) == len(got)
    for c, a, *_ in got:
        assert a in members[c]
    for c in members:
        if have[c] < len(members[c]):
            assert all(have[c] >= have[d] - 1 for d in members)


def test_even_cells(spark, monkeypatch):
    rows = make(spark)
    members = defaultdict(set)
    for r in rows[:-4]:
        members[cell(r)].add(r[0])
    members[("fa", "g1", "hot")].add("A3")
    targets = [(1, "all", None, 7, 0), (2, "ALL ", "x", 60, 0), (3, "family", "fb", 25, 0), (4, "genus", "g__G1", 10_000, 0), (5, "genus", None, 5, 0),
               (6, "all", None, None, 0), (7, "all", None, 0, 0), (8, "species", "hot", 9, 0), (9, "family", "none", 9, 0)]
    scopes = {1: lambda c: True, 2: lambda c: True, 3: lambda c: c[0] == "fb", 4: lambda c: c[1] == "g1"}
    whole = None
    for slice_rows in (100_000, 7):
        monkeypatch.setattr(subset, "SLICE_ROWS", slice_rows)
        got = picks(spark, rows, targets)
        # the slices change nothing, down to the last record and rank
        whole = whole or got
        assert {t: sorted(v) for t, v in got.items()} == {t: sorted(v) for t, v in whole.items()}
        for c, a, rank, _ in got[4]:
            assert rank == sorted(members[c], key=lambda x: hashlib.md5(x.encode()).hexdigest()).index(a) + 1
        assert set(got) == {1, 2, 3, 4}
        for t, inside in scopes.items():
            m = {c: a for c, a in members.items() if inside(c)}
            k = targets[t - 1][3]
            check(got[t], m, k)
            taxa = {c[1:] for c in m}
            assert {n for *_, n in got[t]} == {len(taxa)}
            if k >= len(taxa):
                assert {c[1:] for c, *_ in got[t]} == taxa


def test_few_places_go_to_families_first(spark):
    rows = [(f"a{f}{g}{s}{i}", f"F{f}", f"G{f}{g}", f"s{s}", "", 0) for f in range(3) for g in range(2) for s in range(2) for i in range(3)]
    got = picks(spark, rows, [(1, "all", None, 3, 0), (2, "all", None, 6, 0)])
    assert {c[0] for c, *_ in got[1]} == {"f0", "f1", "f2"}
    assert len({c[1] for c, *_ in got[2]}) == 6


def test_empty(spark):
    assert picks(spark, [], [(1, "all", None, 3, 0)]) == {}
    assert picks(spark, make(spark, 5), []) == {}
