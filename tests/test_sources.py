import pytest
from cladeworks.plans.pipeline import Context, RunStore, run_stage, unpack_clusters
from cladeworks.plans.registry import InputError
from cladeworks.sources import fasta, tables
from cladeworks.streaming import incremental


def test_fasta(spark, rows, tmp_path):
    d = tmp_path / "g"
    d.mkdir()
    (d / "F_g_s_A.1.fasta").write_text(">c1 with > sign\nAC\nGT\n>c2\nTT\n")
    (d / "F_g_s_B.1.fasta").write_text(">c3\nGG\n")
    (d / ".hidden.fasta").write_text(">x\nA\n")
    (d / "note.txt").write_text("no")
    assert [r["name"] for r in fasta.files(spark, str(d)).collect()] == ["F_g_s_A.1.fasta", "F_g_s_B.1.fasta"]
    assert fasta.files(spark, str(tmp_path / "none")).collect() == []
    r = fasta.records(spark, f"{d}/F*.fasta")
    assert rows(r, "header", "seq") == [("c1 with > sign", "ACGT"), ("c2", "TT"), ("c3", "GG")]
    assert rows(fasta.whole(r)) == [("F_g_s_A.1", "ACGTTT"), ("F_g_s_B.1", "GG")]
    assert rows(fasta.contig_map(r))[0] == ("c1", "F_g_s_A.1")
    fasta.write(r, str(tmp_path / "out"))
    assert "".join(sorted(p.read_text() for p in (tmp_path / "out").glob("part*"))).count(">") == 3


def test_tables(spark, rows, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text("accession\tgtdb_taxonomy\tgtdb_genome_representative\nRS_GCF_1.1\td__B;f__F;g__G;s__G x\tRS_GCF_1.1\nGB_GCA_2.1\td__B;f__F;g__G;s__G y\tRS_GCF_1.1\n")
    assert rows(tables.taxonomy(spark, str(p)), "accession", "is_rep", "species") == [("GCA_2.1", False, "y"), ("GCF_1.1", True, "x")]
    p = tmp_path / "ani.tsv"
    p.write_text("Ref\tQuery\tANI\tA\tB\tn\tm\n/x/memX.fa\trepA.fa\t99.5\t80\t70\t\t\nbad\nq\tr\tx\t1\t1\t\t\n")
    assert rows(tables.ani_edges(spark, str(p)), "a", "b", "score", "fb") == [("memX.fa", "repA.fa", 99.5, 70.0)]
    p = tmp_path / "m.csv"
    p.write_text("a,b\n1.0,0.5\n0.5,1.0\n")
    assert rows(tables.matrix(spark, str(p)), "a", "b", "s") == [("a", "a", 1.0), ("a", "b", 0.5), ("b", "a", 0.5), ("b", "b", 1.0)]
    p = tmp_path / "d.tsv"
    p.write_text(".\tS_a\tO_x\nS_a\t0\t0.5\nO_x\t0.5\t0\n")
    assert rows(tables.distance_matrix(spark, str(p))) == [("a", "x", 0.5)]
    p = tmp_path / "q.csv"
    p.write_text("genome,completeness,contamination,length,N50\ng1,98.5,x,100,5\n")
    assert rows(tables.quality(spark, str(p))) == [("g1", 98.5, 0.0, 100.0, 5.0, 0.0)]
    p = tmp_path / "c.csv"
    p.write_text("genome,secondary_cluster,cluster\ng1,1_1,1\ng2,,2\n")
    assert rows(tables.cluster_table(spark, str(p))) == [("g1", "1_1"), ("g2", "2")]
    p = tmp_path / "f.txt"
    p.write_text(" a \n\nb\n")
    assert rows(tables.name_list(spark, str(p))) == [("a",), ("b",)]
    p = tmp_path / "x.xml"
    p.write_text("<TaxaSet><Taxon><TaxId>10535</TaxId><ScientificName>S</ScientificName><Rank>species</Rank><AkaTaxIds><TaxId>7</TaxId></AkaTaxIds><LineageEx><Taxon><TaxId>1</TaxId><ScientificName>V</ScientificName><Rank>realm</Rank></Taxon></LineageEx></Taxon></TaxaSet>")
    r = tables.taxon_pages(spark, str(p)).first()
    assert (r["taxid"], r["aka"], r["lineage"][0]["name"]) == ("10535", ["7"], "V")
    c = spark.createDataFrame([("r", "m"), ("r", "r"), ("q", "z")], "representative string, member string")
    tables.write_tsv(tables.clusters(c).orderBy("representative", "ord", "member").drop("ord").coalesce(1), str(tmp_path / "cl"))
    assert rows(tables.read_clusters(spark, str(tmp_path / "cl"))) == [("q", "z"), ("r", "m")]


def test_pipeline(spark, tmp_path):
    ctx = Context(spark, str(tmp_path / "w"))
    done = []

    def work(c, p):
        done.append(p)
        c.write("t", spark.range(3))

    assert run_stage(ctx, "metadata", {"a": 1, "threads": 1}, work, dry_run=True) == "planned"
    assert run_stage(ctx, "metadata", {"a": 1, "threads": 1}, work) == "ran"
    assert run_stage(ctx, "metadata", {"a": 1, "threads": 9}, work) == "skipped"
    assert run_stage(ctx, "metadata", {"a": 2}, work) == "ran" and len(done) == 2
    assert [r["next"] for r in ctx.status().orderBy("ord").collect()][:2] == [False, True]
    store = RunStore(ctx)
    assert store.names() == []
    store.pack("one", "t")
    assert store.names() == ["one"]
    for bad in (lambda: store.pack("one", "t"), lambda: store.unpack("two", "t"), lambda: store.delete("two"), lambda: ctx.read("none")):
        try:
            bad()
            raise AssertionError
        except InputError:
            pass
    assert store.unpack("one", "u").count() == 3
    store.delete("one")
    assert store.names() == []
    c = spark.createDataFrame([("r", "m"), ("r", "r")], "representative string, member string")
    unpack_clusters(c, str(tmp_path / "u"), with_representative=False)
    assert spark.read.parquet(str(tmp_path / "u" / "representative=r")).count() == 1


def test_incremental(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(60))
    src, state = tmp_path / "src", tmp_path / "state"
    schema = "doc_id bigint, text string"
    for k, batch in enumerate([[(1, text), (2, "other " + " ".join(f"v{i}" for i in range(40)))], [(3, text + " tail"), (4, None), (1, text)]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(src))
        incremental.start(spark.readStream.schema(schema).parquet(str(src)), str(state)).awaitTermination()
    got = sorted((r["representative"], r["member"]) for r in spark.read.parquet(str(state / "clusters")).collect())
    assert got == [(1, 1), (1, 3), (2, 2), (4, 4)]


def test_archives(spark, rows, tmp_path):
    import gzip
    import io
    import tarfile

    body = "accession\ttaxonomy\nRS_A.1\td__x\nGB_B.1\t\n"

    def archive(name, members):
        with tarfile.open(tmp_path / name, "w:gz") as t:
            for n, data in members:
                info = tarfile.TarInfo(n)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
        return str(tmp_path / name)

    a = archive("a.tar.gz", [("README", b"x"), ("d/m.tsv", body.encode()), ("z.tsv", b"no")])
    assert rows(tables.archive_table(spark, a, ["taxonomy", "accession", "none"])) == sorted([("d__x", "RS_A.1", None), ("", "GB_B.1", None)], key=repr)
    b = archive("b.tar.gz", [("m.tsv.gz", gzip.compress(body.encode()))])
    assert tables.archive_table(spark, b, ["accession"]).count() == 2
    with pytest.raises(Exception, match="no .tsv file"):
        tables.archive_rows(spark, archive("c.tar.gz", [("x.txt", b"")])).collect()


def test_records_and_pages(spark, rows, tmp_path):
    (tmp_path / "l.json").write_text('{"a": 1}\n{"a": 2}\n')
    (tmp_path / "w.json").write_text('[\n {"a": 1},\n {"a": 2}\n]\n')
    for name in ("l.json", "w.json"):
        assert rows(tables.read_records(spark, str(tmp_path / name), "a int")) == [(1,), (2,)]
    (tmp_path / "e.xml").write_text('<?xml version="1.0"?><html><body>busy</body></html>')
    with pytest.raises(Exception, match="html"):
        tables.taxon_pages(spark, str(tmp_path / "e.xml")).collect()
