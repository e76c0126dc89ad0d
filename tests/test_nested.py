import json

import pytest

from cladeworks.operators import nested

DOC = {"accession": "a", "isolate": {"name": "I"}, "segment": 2, "virus": {"taxId": None, "tax_id": "7", "lineage": [{"name": "A"}, {}, {"name": ""}, {"name": "B"}]},
       "annotation": {"genes": [{"cds": {"proteinAccession": "p1"}}, {}, {"cds": [{"x": 1}, {"protein_accession": "p2"}]}]}}


def found(spark, lines):
    df = spark.createDataFrame(lines, "line_id bigint, report string")
    from cladeworks.session import cut
    from pyspark.sql import functions as F

    nodes = cut(nested.report_nodes(df))
    out = nested.children(nodes).drop("id").join(nested.records(nodes), ["row", "record"])
    return sorted((tuple(r) for r in out.select(F.col("id"), "record_pos", "taxid", "isolate", "segment", "child", "parent_pos", "child_pos", "child_key").collect()), key=repr)


def test_children(spark):
    one = [("lineage", -1, 0, "A"), ("lineage", -1, 3, "B"), ("cds", 0, 0, "p1"), ("cds", 2, 1, "p2")]
    want = sorted(((1, 0, "7", "I", "2", *c) for c in one), key=repr)
    assert found(spark, [(1, json.dumps(DOC))]) == want
    page = json.dumps({"total": 2, "reports": [{"virus": {"lineage": [{"name": "Z"}]}, "isolate": "iso"}, DOC]})
    got = found(spark, [(5, page)])
    assert got == sorted([(5, 0, "", "iso", "ANONYMOUS", "lineage", -1, 0, "Z"), *((5, 1, "7", "I", "2", *c) for c in one)], key=repr)


@pytest.mark.parametrize("bad", [None, "", "  ", "{", '{"a": 1} x', '{"a": NaN}', "null", "[1, 2]", "7", '{"virus": null}', '{"reports": null}', '{"reports": [null, 3, "x"]}'])
def test_lines_that_give_nothing(spark, bad):
    assert found(spark, [(1, bad)]) == []


def test_repeated_lines_and_deep_ones(spark):
    text = json.dumps(DOC)
    assert len(found(spark, [(1, text), (1, text), (None, text)])) == 12
    deep = '{"virus": {"lineage": [{"name": "A"}]}, "x": ' + "[" * 40000 + "]" * 40000 + "}"
    assert found(spark, [(3, deep)]) == [(3, 0, "", "", "ANONYMOUS", "lineage", -1, 0, "A")]
    assert found(spark, [(4, '{"virus": {"tax_id": 12345678901234567890, "lineage": [{"name": "\\ud800"}]}}')]) == [(4, 0, "12345678901234567890", "", "ANONYMOUS", "lineage", -1, 0, "?")]
    assert found(spark, []) == []


def test_labels_truncate_to_parents():
    rows = list(nested.label({"a": [{"b": [1, 2]}, {"c": 3}]}, nested.Paths()))
    by = {(p, tuple(d)): leaves for p, d, leaves in rows}
    assert by[("a[]", (0, 1))] == {"c": "3"}
    assert by[("a[].b[]", (0, 0, 0, 1))] == {"": "2"}
    for p, d in by:
        if p == "a[].b[]":
            assert ("a[]", d[:2]) in by


def test_only_what_is_kept_is_entered():
    value = {"a": [{"b": [1, 2], "C": {"dE": 5, "x": 6}}, {"c": 3}], "z": [[1], {"y": 2}], "c": {"d_e": 9}}
    whole = {(p, d): x for p, d, x in nested.label(value, nested.Paths())}
    some = {(p, d): x for p, d, x in nested.label(value, nested.Paths(leaves={"a[]": {"c.d_e"}, "a[].b[]": {""}}))}
    assert some == {("a[]", (0, 0)): {"c.d_e": "5"}, ("a[]", (0, 1)): {}, ("a[].b[]", (0, 0, 0, 0)): {"": "1"}, ("a[].b[]", (0, 0, 0, 1)): {"": "2"}}
    assert set(some) <= set(whole) and whole[("a[]", (0, 0))] == {"c.d_e": "5", "c.x": "6"}
