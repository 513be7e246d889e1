import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ruleweave.session import build_session
    s = build_session("local[4]", app="ruleweave-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def logs_of(spark):
    """Build a JSON log view from Python dicts (arrival order = list order)."""
    from ruleweave.sources.logs import decode_json_logs, json_view

    def make(items):
        rows = [(i, json.dumps(x) if not isinstance(x, str) else x) for i, x in enumerate(items)]
        df = spark.createDataFrame(rows, "seq long, value string")
        good, _ = decode_json_logs(df)
        return json_view(good, order_cols=["seq"], keep=["seq"])
    return make
