"""The command line lists jobs, prints oracle SQL and runs a job."""

from bizlens.__main__ import main


def test_cli(spark, capsys):
    assert main(["list"]) == 0
    assert len(capsys.readouterr().out.split()) == 96
    assert main(["sql", "top_item"]) == 0
    assert "LIMIT 1" in capsys.readouterr().out
    assert main(["run", "top_item", "--sf-dir", "/root/testdata/sf0.001", "--rows", "1"]) == 0
    assert "purchases" in capsys.readouterr().out
