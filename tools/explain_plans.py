"""Write PLANS.md: the physical plan trees of the main models and reports,
built over written inputs (as a daily run reads them), with each scan's
pushed filters and read schema.

Usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""
import os
import re
import sys
import tempfile

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
from basketry.plans.pipeline import Models, load_raw, materialize  # noqa: E402
from basketry.session import get_session  # noqa: E402

MODELS = ["customer_history", "customer_360", "product_performance", "fact_orders", "fact_order_products"]
REPORTS = ["rpt_kpi", "rpt_departments", "rpt_top_reordered", "rpt_basket_by_segment"]


def condensed(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        prefix = re.match(r"^[\s:+|-]*", line).group(0)
        rest = re.sub(r"^\*\(\d+\) ", "", line[len(prefix):])
        m = re.match(r"[A-Za-z]+", rest)
        if not m or m.group(0) in ("ColumnarToRow", "InputAdapter", "WholeStageCodegen"):
            continue
        name, extra = m.group(0), ""
        if name == "FileScan":
            pf = re.search(r"PushedFilters: \[(.*?)\]", rest)
            rs = re.search(r"ReadSchema: struct<([^>]*)", rest)
            extra = f" parquet filters=[{pf.group(1) if pf else ''}] read=<{rs.group(1) if rs else ''}>"
        elif name == "Exchange":
            part = re.search(r"(hashpartitioning|rangepartitioning)\((.*?), \d+\)|SinglePartition", rest)
            extra = f" {part.group(1)}({part.group(2)})" if part and part.group(1) else (
                " SinglePartition" if part else "")
        elif "Join" in name:
            jt = re.search(r"(Inner|LeftOuter|LeftAnti|LeftSemi|FullOuter|RightOuter)", rest)
            extra = f" {jt.group(0)}" if jt else ""
        elif name in ("HashAggregate", "ObjectHashAggregate", "SortAggregate"):
            keys = re.search(r"keys=\[([^\]]*)\]", rest)
            extra = f" keys=[{keys.group(1)}]" if keys else ""
        out.append(re.sub(r"#\d+L?", "", prefix + name + extra))
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="bk-plans-")
    spark = get_session("local[8]", shuffle_partitions=16,
                        extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                               "spark.sql.adaptive.enabled": "false",
                               "spark.sql.maxMetadataStringLength": "1000"})
    m = Models.from_fixtures(spark, sf)
    load_raw(m, os.path.join(scratch, "wh"))
    print("# Physical plans\n")
    print("Generated by `tools/explain_plans.py` over written raw tables (AQE off, so the static plan is "
          "shown; at run time AQE may turn a sort-merge join into a broadcast from measured sizes and "
          "split skewed partitions). Each model reads the tables written before it.\n")
    for name in MODELS:
        df = getattr(m, name)
        print(f"## {name}\n\n```\n{condensed(df)}\n```\n")
        materialize(m, os.path.join(scratch, "wh"), names=[name], load=False) \
            if name not in ("customer_history",) else None
    materialize(m, os.path.join(scratch, "wh"), names=["dim_users", "dim_products"], load=False)
    for name in REPORTS:
        print(f"## {name}\n\n```\n{condensed(m.report(name))}\n```\n")


if __name__ == "__main__":
    main()
