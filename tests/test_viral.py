import json

from cladeworks.operators import nested, viral
from cladeworks.session import cut


def test_records(spark, rows):
    def entry(name, **more):
        return {"name": name, **more}

    lines = [
        (1, json.dumps({"accession": "N1", "length": 4321, "completeness": "partial", "virus": {"organism_name": "Brook fever virus 2", "tax_id": 77, "lineage": [entry("Rivuviridae", rank="family", tax_id=1), entry("Rivuvirus", rank="genus")]}})),
        (2, json.dumps({"accession": "N2", "isolate": {"name": "I"}, "virus": {"organismName": "Montivirus arduum", "taxId": 5, "lineage": [entry("Montiviridae"), entry("Montivirus"), entry("Montivirus arduum")]}})),
        (3, "{}"),
    ]
    nodes = cut(nested.report_nodes(spark.createDataFrame(lines, "line_id bigint, report string")))
    r = viral.virus_records(nodes)
    assert rows(r, "id", "family", "genus", "species", "length", "completeness") == [
        (1, "Rivuviridae", "Rivuvirus", "Brook-fever-virus-2", 4321, "PARTIAL"),
        (2, "Montiviridae", "Montivirus", "Montivirus-arduum", 0, ""), (3, "NA", "NA", "NA", 0, ""),
    ]
    w = viral.wide_lineage(viral.lineage_entries(nodes), ["id"], ["family", "genus", "species"])
    assert rows(w) == [(1, "Rivuviridae", "Rivuvirus", "", "1", "", "")]


def test_drafts(spark, rows):
    df = spark.createDataFrame([("s", 100, "a"), ("s", 101, "b"), ("s", 102, "c"), ("s", 300, "d"), ("t", 100, "e")], "sp string, n int, accession string")
    assert rows(viral.outgroup_draft(df, "sp", "n", 100.0, each=2), "accession") == [("a",), ("b",), ("e",)]
    assert rows(viral.near_median(df, "sp", "n", 0.1), "accession") == [("a",), ("b",), ("c",), ("e",)]


def test_aliases_and_files(spark, rows):
    taxa = spark.createDataFrame([("1", ["9", "8"]), ("2", None)], "taxid string, aka array<string>")
    want = spark.createDataFrame([("9",), ("2",), ("7",)], "wanted string")
    assert rows(viral.resolve_aliases(want, taxa)) == [("2", "2"), ("7", None), ("9", "1")]
    files = spark.createDataFrame([("F_g_s_A.1.fasta",), ("F_g_s_A.10.fasta",), ("B.1.fa",)], "name string")
    acc = spark.createDataFrame([("A.1",), ("B.1",), ("C",)], "accession string")
    assert rows(viral.file_of(acc, files)) == [("A.1", "F_g_s_A.1.fasta"), ("B.1", "B.1.fa")]


def test_fetch_retries_the_missing(spark, tmp_path):
    log = str(tmp_path / "asked")

    def fetch(ids):
        import os

        out = []
        for i in ids:
            if os.path.exists(f"{log}-{i}") or i != "2":
                out.append({"taxid": i, "name": f"n{i}"})
            open(f"{log}-{i}", "w").close()
        return out

    got = viral.fetch_missing(spark.createDataFrame([("1",), ("2",)], "taxid string"), fetch, "taxid string, name string")
    assert sorted(tuple(r) for r in got.collect()) == [("1", "n1"), ("2", "n2")]
    never = viral.fetch_missing(spark.createDataFrame([("3",)], "taxid string"), lambda ids: [], "taxid string, name string")
    assert never.collect() == []
