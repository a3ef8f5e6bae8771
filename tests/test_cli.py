import os

from basketry.__main__ import main
from basketry.sources.csv_loader import write_raw_csv
from basketry.sources.fixtures import raw_from_parquet


def test_load_build_test_report(spark, scratch, capsys):
    landing, root = os.path.join(scratch, "landing"), os.path.join(scratch, "wh")
    write_raw_csv(raw_from_parquet(spark, "/root/testdata/sf0.001"), landing)
    assert main(["load", landing, root]) == 0
    assert main(["build", root]) == 0
    out = capsys.readouterr().out
    assert "fact_order_products" in out and "customer_360" in out
    assert main(["report", root, "rpt_segments"]) == 0
    assert "Champion" in capsys.readouterr().out
    # at this scale every user has a second order, so all checks pass
    assert main(["test", root, "--now", "2024-01-01 00:00:00"]) == 0
    assert "freshness" in capsys.readouterr().out
    # a later check time is past the freshness limit
    assert main(["test", root, "--now", "2034-01-01 00:00:00"]) == 1
