"""Scale lint over the physical plans of the registered queries.

Flags cartesian products and nested-loop joins, and checks that every
single-partition exchange is fed by an aggregate (bounded input: a global
aggregate's partials, a per-partition count table, a top-k merge) rather
than by a data-sized operator.

Usage: python tools/plan_lint.py [sf_dir] [name ...]
"""
import collections
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
from basketry.queries import REGISTRY  # noqa: E402
from basketry.session import get_session  # noqa: E402

BOUNDED_FEEDERS = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject")


def _depth(line: str) -> int:
    m = re.search(r"[+:]- ", line)
    return m.start() if m else 0


def single_partition_feeders(plan: str):
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        d = _depth(line)
        for nxt in lines[i + 1:]:
            if _depth(nxt) == d + 3 and re.search(r"[+:]- ", nxt):
                node = re.sub(r"^\*\(\d+\) ", "", nxt[d + 6:])  # whole-stage codegen marker
                yield re.sub(r"\(.*", "", node).split(" ")[0]
                break


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(REGISTRY)
    spark = get_session("local[4]")
    bad = 0
    for name in names:
        plan = REGISTRY[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        issues = []
        if "CartesianProduct" in plan:
            issues.append("cartesian product")
        if "BroadcastNestedLoopJoin" in plan:
            issues.append("nested-loop join")
        feeders = collections.Counter(single_partition_feeders(plan))
        unbounded = {k: v for k, v in feeders.items() if k not in BOUNDED_FEEDERS}
        if unbounded:
            issues.append(f"single-partition exchange over {unbounded}")
        bad += bool(issues)
        print(f"{name:34s} {'OK' if not issues else '; '.join(issues)}  single-partition feeders={dict(feeders)}")
    print(f"queries with issues: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
