import pytest

from cladeworks.__main__ import main, parser


def test_options_follow_the_parameters():
    a = parser().parse_args(["run", "w", "--level", "genus", "--genus", "g", "--threshold", "95", "--chunk-size", "10", "--no-remove-outgroup", "--dry-run"])
    assert (a.threshold, a.chunk_size, a.remove_outgroup, a.no_outgroup, a.dry_run) == (95.0, 10, False, False, True)
    with pytest.raises(SystemExit):
        parser().parse_args(["metadata", "w"])


def test_list_tools(capsys):
    assert main(["list-tools"]) == 0
    assert "aligner\tblocks\tunbounded" in capsys.readouterr().out


def test_dereplicate_chunks_and_merge(spark, rows, tmp_path):
    text = [" ".join(f"w{g}x{k}" for k in range(30)) for g in range(4)]
    df = spark.createDataFrame([(i, text[i % 4]) for i in range(12)], "doc_id bigint, text string")
    table = str(tmp_path / "t")
    df.write.parquet(table)
    for c in range(2):
        df.where(f"doc_id div 6 = {c}").write.parquet(str(tmp_path / f"t{c}"))
        assert main(["dereplicate-chunk", str(tmp_path / f"t{c}"), str(tmp_path / f"c{c}")]) == 0
    assert main(["dereplicate-merge", table, str(tmp_path / "m"), str(tmp_path / "c0"), str(tmp_path / "c1")]) == 0
    got = rows(spark.read.parquet(str(tmp_path / "m" / "clusters")), "member", "representative")
    assert got == sorted(((i, i % 4) for i in range(12)), key=repr)


def test_errors_and_plans(spark, tmp_path, capsys):
    assert main(["metadata", str(tmp_path), "--level", "genus", "--genus", "g"]) == 1
    assert "no table taxa" in capsys.readouterr().err
    assert main(["run", str(tmp_path), "--level", "genus", "--genus", "g", "--dry-run"]) == 0
    assert capsys.readouterr().out.split() == ["metadata", "planned", "genome", "planned", "dereplicate", "planned", "phylo", "planned", "tree2tax", "planned"]
    assert main(["run", str(tmp_path), "--level", "genus"]) == 1
    assert main(["status", str(tmp_path)]) == 0
