"""The job runner command line."""

from tessera.__main__ import main


def test_list(capsys):
    assert main(["--list"]) == 0
    assert "word_count_topk" in capsys.readouterr().out.split()


def test_run_to_text_folder(spark, scratch):
    out = f"{scratch}/topk"
    assert main(["topk_share", "/root/testdata/sf0.001", "--out", out, "--format", "text"]) == 0
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == 5 and all(len(x.split("\t")) == 3 for x in lines)


def test_run_to_parquet_and_show(spark, scratch, capsys):
    out = f"{scratch}/vs"
    assert main(["value_share", "/root/testdata/sf0.001", "--out", out, "--show", "3"]) == 0
    shown = capsys.readouterr().out
    assert "event_type" in shown and "share" in shown
    assert sorted(r.event_type for r in spark.read.parquet(out).collect()) == ["click", "error", "none"]
