import json

from usage_rollup import cli
from usage_rollup.sources.driverdata import download_log

SF = "/root/testdata/sf0.001"


def test_cli_ingest_transform_report(spark, scratch, capsys, monkeypatch):
    # keep the shared test session's settings (the cluster profile would widen its shuffles)
    monkeypatch.setenv("USAGE_ROLLUP_PROFILE", "local")
    src, raw, rollup = scratch("cli-src"), scratch("cli-raw"), scratch("cli-rollup")
    download_log(spark, SF, with_orders=False).write.parquet(src)
    assert cli.main(["ingest", "--source", src, "--target", raw, "--project", "alpha",
                     "--start", "2024-01-01", "--end", "2024-02-01"]) == 0
    loaded = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows_loaded"]
    assert loaded > 0
    assert cli.main(["transform", "--root", raw, "--target", rollup, "--mode", "incremental"]) == 0
    capsys.readouterr()
    assert cli.main(["report", "--rollup", rollup, "--days", "30", "--as-of", "2024-01-31"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["total_downloads"][0]["total_downloads"] == loaded
    assert len(out["top_versions"]) <= 10
