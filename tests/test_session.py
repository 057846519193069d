"""A submitted master and shuffle partitions are left alone."""

import os
import subprocess
import sys

CODE = """
from roaskit.session import get_spark
s = get_spark()
print(s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"))
"""


def test_launch_settings_win(tmp_path):
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[3] --conf spark.sql.shuffle.partitions=4000 --conf spark.ui.enabled=false pyspark-shell",
                        "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    out = subprocess.run([sys.executable, "-c", CODE], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[-2:] == ["local[3]", "4000"], out.stderr[-500:]
