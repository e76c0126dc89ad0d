import pytest
from pyspark.sql import functions as F

from cladeworks.functions import names, text


def one(spark, value, f, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(f(F.col("x")).alias("y")).first()["y"]


def test_accession_of(spark):
    for name, want in {
        "GCF_1.1": "GCF_1.1", " GCF_1.1 ": "GCF_1.1", "RS_GCF_1.1": "GCF_1.1", "GB_GCA_2.1": "GCA_2.1", "GCF_1.1.fasta.gz": "GCF_1.1",
        "Fam_Gen_spe_GCF_1.1.fasta": "GCF_1.1", "genomes/Fam_Gen_sp-Z1_GCA_1.2.fna ": "GCA_1.2", "/scratch/chunk_1/F_G_s_NC_9.1.fa": "NC_9.1",
        "F_G_s_MN908947.3.fasta": "MN908947.3", "": None, "  ": None, None: None,
    }.items():
        assert one(spark, name, names.accession_of) == want, name


def test_file_name_roundtrip(spark):
    p = one(spark, "Fam_Gen_spe_GCF_1.1.fasta", names.parse_file_name)
    assert tuple(p) == ("Fam", "Gen", "spe", "GCF_1.1")
    assert tuple(one(spark, "stray.fna", names.parse_file_name)) == ("", "", "", "stray")


def test_taxa(spark):
    df = spark.createDataFrame(
        [("g__Abc", "s__Abc sp B9"), (" ABC ", "sp_B9  "), ("abc", "SP-B9"), ("Abc", "Abcdia"), ("Abc", "s__Abc"), (None, "x"), ("", "x"), ("Abc", None)], "g string, s string"
    )
    got = [tuple(r) for r in df.select(names.rank_name(F.col("g")), names.species_name(F.col("s"), F.col("g"))).collect()]
    assert got[:5] == [("abc", "sp-b9"), ("abc", "sp-b9"), ("abc", "sp-b9"), ("abc", "abcdia"), ("abc", None)]
    assert got[5][0] is None and got[6][0] is None and got[7][1] is None


def test_lineage(spark):
    t = one(spark, "d__B;f__Fam x;g__Gen_a;s__Gen_a tula rensis", text.lineage_struct)
    assert (t["domain"], t["family"], t["genus"], t["species"], t["order"]) == ("B", "Famx", "Gen-a", "tularensis", "")
    assert one(spark, None, text.lineage_struct)["species"] == ""


def test_tokens(spark):
    assert one(spark, " Human virus_1! ", text.token) == "Human-virus-1"
    assert one(spark, "", text.token) == "NA"
    assert one(spark, "A/b c", text.isolate_token) == "iso-Ab-c"
    assert one(spark, "AAATTTGCn", text.reverse_complement) == "nGCAAATTT"
    assert one(spark, "francisella tularensis", lambda c: text.taxon_string("species", c)) == "s__Francisella tularensis"
    assert one(spark, " A, b,,C ", text.option_list) == ["a", "b", "c"]
    assert one(spark, "a=1, b = 2,a=3, ,", text.key_values) == {"a": "3", "b": "2"} and one(spark, None, text.key_values) == {}
    for bad in ("a=1,=4", "a"):
        with pytest.raises(Exception, match="key=value"):
            one(spark, bad, text.key_values)
    assert tuple(one(spark, "tool v2.10.3-beta", text.version_struct)) == (2, 10, 3)
    assert one(spark, "x" * 161, text.wrap) == "x" * 80 + "\n" + "x" * 80 + "\nx"
    assert one(spark, "x" * 80, text.wrap) == "x" * 80


def test_classify(spark):
    def c(names_, organism=""):
        df = spark.createDataFrame([(names_, organism)], "l array<string>, o string")
        return tuple(df.select(text.classify(F.col("l"), F.col("o")).alias("c")).first()["c"])

    assert c(["Viruses", "Filoviridae", "Orthomarburgvirus", "Orthomarburgvirus marburgense"]) == ("Filoviridae", "Orthomarburgvirus", "Orthomarburgvirus-marburgense")
    assert c(["Aviridae", "Bgen", "B c"], "B c") == ("Aviridae", "Bgen", "B-c")
    assert c([]) == ("NA", "NA", "NA") and c(None) == ("NA", "NA", "NA")
    header = one(spark, "acc desc | Some | 10535.7] [Species x | tag", text.header_struct)
    assert tuple(header) == ("10535.7", "10535", "Species x", "acc")


def test_lineage_of_names_with_a_prefix(spark, tmp_path):
    from cladeworks.queries.relational import lineage_parse

    given = [(1, "f__Aaceae", "g__Bus", "s__Bus cus"), (2, "Aaceae", "Bus", "cus"), (3, None, "g__Bus", "cus"), (4, "F__ Aaceae", " g__Bus", "Bus cus d_1")]
    spark.createDataFrame(given, "row_id bigint, family string, genus string, species string").write.parquet(str(tmp_path / "genomes.parquet"))
    got = {r["row_id"]: (r["family"], r["genus"], r["species"]) for r in lineage_parse(spark, str(tmp_path)).collect()}
    assert got == {1: ("Aaceae", "Bus", "cus"), 2: ("Aaceae", "Bus", "cus"), 3: ("", "Bus", "cus"), 4: ("Aaceae", "Bus", "cusd-1")}


def test_wrap_of_full_lines(spark, tmp_path):
    from cladeworks.queries.relational import sequence_wrap

    spark.createDataFrame([(1, "ABCD"), (2, "ABCDE")], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    got = {r["n_nationkey"]: r["wrapped"] for r in sequence_wrap(spark, str(tmp_path)).collect()}
    assert got == {1: "ABCD" * 20, 2: "ABCDE" * 16 + "\n" + "ABCDE" * 4}


def test_long_names_stay_whole(spark, tmp_path):
    from cladeworks.queries.relational import reverse_complements

    long = "A" + "b" * 20_000
    assert one(spark, long, lambda x: text.taxon_string("genus", x)) == "g__" + long
    assert one(spark, "g__" + long, text.lineage_struct)["genus"] == long
    spark.createDataFrame([(1, "ac" * 50)], "p_partkey int, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    assert reverse_complements(spark, str(tmp_path)).first()["rc"] == "GT" * 50
