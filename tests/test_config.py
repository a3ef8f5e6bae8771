import os
import subprocess
import sys

import pyspark

from basketry.plans.pipeline import DEPENDS_ON, MODEL_ORDER, build_levels
from basketry.session import MAX_SHUFFLE_PARTITIONS, cluster_conf


def test_cluster_conf_scales_and_caps():
    small = cluster_conf(10 ** 9)
    big = cluster_conf(100 * 2 ** 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS
    assert big["spark.sql.adaptive.enabled"] == "true" and big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_build_levels_respect_dependencies():
    levels = build_levels(MODEL_ORDER)
    seen = set()
    for level in levels:
        for name in level:
            assert all(d in seen for d in DEPENDS_ON[name])
        seen.update(level)
    assert seen == set(DEPENDS_ON)
    assert build_levels(["stg_orders", "customer_history"]) == []


def test_launcher_settings_win_over_defaults(tmp_path):
    script = tmp_path / "show.py"
    script.write_text("from basketry.session import get_session\n"
                      "s = get_session('local[1]')\n"
                      "print('CONF', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.adaptive.skewJoin.enabled'))\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k not in ("PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    env |= {"PYTHONPATH": root, "PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable}
    out = subprocess.run([os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit"), "--master", "local[1]", "--conf", "spark.ui.enabled=false",
                          "--conf", "spark.sql.shuffle.partitions=7", "--conf", "spark.sql.adaptive.skewJoin.enabled=false", str(script)],
                         env=env, capture_output=True, text=True, timeout=180)
    assert "CONF 7 UTC false" in out.stdout, out.stderr[-2000:]
