import random

import pytest

from cladeworks.plans import viral
from cladeworks.plans.registry import InputError


def dna(seed, n=300):
    r = random.Random(seed)
    return "".join(r.choice("ACGT") for _ in range(n))


R = "ord int, accession string, taxid string, organism string, family string, genus string, species string, length int, segment string, isolate string"


def data(spark):
    rows, seqs = [], []
    for i in range(6):
        rows.append((i, f"K{i}", "1", "Brook virus", "Rivuviridae", "Rivuvirus", "Brook-virus", 300 + i, "S", "is 1" if i < 2 else ""))
        seqs.append((i, f"K{i}", f"K{i} brook", dna(1) if i else dna(1)[:-1] + "A"))
    for i in range(4):
        # one species is far in letters, one near
        rows.append((10 + i, f"F{i}", "2", "Ridge virus", "Montiviridae", "Montivirus", "Ridge-virus", 300, "S", ""))
        seqs.append((10 + i, f"F{i}", "far", dna(50 + i)))
        rows.append((20 + i, f"N{i}", "3", "Ford virus", "Rivuviridae", "Vaduvirus", "Ford-virus", 300, "S", ""))
        seqs.append((20 + i, f"N{i}", "near", dna(1)[:150] + dna(60)[:150]))
    rows.append((30, "K9", "1", "Brook virus", "Rivuviridae", "Rivuvirus", "Brook-virus", 900, "L", ""))
    seqs.append((30, "K9", "K9 lab tag", dna(9, 900)))
    return spark.createDataFrame(rows, R), spark.createDataFrame(seqs, "ord int, accession string, description string, seq string")


def test_records(spark, rows):
    records, seqs = data(spark)
    got = viral.select_records(records, seqs, viral.Select({"genus": ["rivu virus"]}, min_genomes=3))
    assert rows(got.genomes, "accession") == [(f"K{i}",) for i in range(6)]
    assert got.genomes.first()["filename"].startswith("Rivuviridae_Rivuvirus_Brook-virus_K")
    assert got.outgroup.first()["accession"][0] == "N" or got.outgroup.first()["accession"][0] == "F"
    none = viral.select_records(records, seqs, viral.Select({"genus": ["rivuvirus"]}, min_genomes=99))
    assert none.outgroup is None or none.outgroup.collect() == []
    every = viral.Select({"genus": ["rivuvirus"]}, length_all=True, discard=["lab tag"], no_outgroup=True)
    assert viral.select_records(records, seqs, every).genomes.count() == 6
    joined = viral.select_records(records, seqs, viral.Select({"species": ["brook-virus"]}, group_segments=True)).genomes
    assert rows(joined, "accession") == sorted([("K2",), ("K3",), ("K4",), ("K5",), ("K9",), ("iso-is-1",)], key=repr)
    for bad in ({"genus": ["none"]}, {"genus": ["rivuvirus"], "species": ["ford"]}):
        with pytest.raises(InputError, match="taxa"):
            viral.select_records(records, seqs, viral.Select(bad))
    with pytest.raises(InputError, match="length"):
        viral.select_records(records, seqs, viral.Select({"genus": ["rivuvirus"]}, length_range=(1, 2)))
    with pytest.raises(InputError, match="must be named"):
        viral.Select({"genus": []})


def test_repeated_ids(spark, rows):
    records, seqs = data(spark)
    twice = seqs.unionByName(spark.createDataFrame([(99, "K1", "later", "ACGT")], seqs.schema))
    p = viral.Select({"genus": ["rivuvirus"]}, no_outgroup=True)
    with pytest.raises(InputError, match="K1"):
        viral.select_records(records, twice, p)
    p.ignore_duplicates = True
    assert dict(rows(viral.select_records(records, twice, p).genomes, "accession", "seq"))["K1"] == "ACGT"


def test_distances(spark):
    a = spark.createDataFrame([("a", dna(1)), ("b", dna(2))], "accession string, seq string")
    d = {(r["s"], r["o"]): r["d"] for r in viral.mash_distances(a, a, 11).collect()}
    assert abs(d[("a", "a")]) < 1e-12 and d[("a", "b")] == 1.0 and len(d) == 4


def test_tagged_headers(spark, rows):
    def head(name, taxid, i):
        return f"{name} | x | {taxid}.{i}] [Brook virus | tag"

    h = [(i, head(f"b{i}", 7, i), dna(1)[: 290 + i]) for i in range(5)] + [(10 + i, head(f"o{i}", 8, i), dna(20 + i)) for i in range(5)] + [(20, head("lost", 9, 1), dna(3))]
    headers = spark.createDataFrame(h, "ord int, header string, seq string")
    base = spark.createDataFrame([("7", 5, 292), ("8", 5, 300), ("9", 1, 300)], "taxid string, num int, seq_med int")
    lineages = spark.createDataFrame([("7", "genus", "Rivuvirus", "70"), ("8", "genus", "Montivirus", "80")], "taxid string, level string, level_name string, level_taxid string")
    for wanted in ("rivuvirus", "70"):
        got = viral.select_tagged(headers, base, lineages, viral.Select({"genus": [wanted]}))
        assert rows(got.genomes, "accession") == [(f"b{i}",) for i in range(5)]
        assert got.outgroup.first()["accession"] in {f"o{i}" for i in range(4)}
    with pytest.raises(InputError, match="enough genomes"):
        viral.select_tagged(headers, base, lineages, viral.Select({"genus": ["70"]}, min_genomes=6))
    again = headers.unionByName(spark.createDataFrame([(99, head("b1", 7, 1), "ACGT" * 73)], headers.schema))
    with pytest.raises(InputError, match="b1"):
        viral.select_tagged(again, base, lineages, viral.Select({"genus": ["70"]}, no_outgroup=True))
