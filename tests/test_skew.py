"""Hot keys: results stay exact and whole, and the plans split the work."""

from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pytest
from conftest import make_tables, ts
from pyspark.sql import functions as F

from hirelens.functions.percentile import percentile_cont
from hirelens.operators import rules as R
from hirelens.operators.stages import lifecycle

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_application_in_lifecycle(spark):
    rnd = random.Random(3)
    apps = [(f"a{i:03d}", "c", f"r{i}", ts(0), "x") for i in range(200)]
    stages = ["APPLIED", "SCREEN", "ONSITE", "OFFER", "HIRED", "REJECTED", "WITHDRAWN"]
    events = [(f"h{i}", "a000", rnd.choice(stages), ts(rnd.uniform(0, 100))) for i in range(3000)]
    events += [(f"e{i}", f"a{rnd.randrange(1, 200):03d}", rnd.choice(stages), ts(rnd.uniform(0, 100))) for i in range(6000)]
    t = make_tables(spark, apps, events)
    life = {r["application_id"]: r for r in lifecycle(t.applications, t.stage_events, t.candidates, t.requisitions).collect()}
    hot = [e for e in events if e[1] == "a000"]
    for s in stages:
        assert life["a000"][f"{s.lower()}_ts"] == max(e[3] for e in hot if e[2] == s)
    assert life["a000"]["latest_stage_ts"] == max(e[3] for e in hot)
    assert len(life) == 200


@pytest.mark.parametrize("mode", ["reference", "symmetric"])
def test_hot_duplicate_key_is_exact_and_linear(spark, skew_conf, mode):
    rnd = random.Random(5)
    apps = [(f"h{i:04d}", "hot", "req", ts(rnd.uniform(0, 60)), "x") for i in range(400)]
    apps += [(f"s{i:04d}", "hot", "req", ts(31), "x") for i in range(100)]  # one instant
    apps += [(f"o{i:04d}", f"c{i % 50}", f"r{i % 7}", ts(rnd.uniform(0, 60)), "x") for i in range(400)]
    t = make_tables(spark, apps)
    got = sorted(r["application_id"] for r in R.rule_duplicate_application(t.applications, mode=mode).collect())

    def partner(a, b):
        later = a[0] > b[0] if mode == "reference" else (a[3], a[0]) > (b[3], b[0])
        return a[0] != b[0] and a[1:3] == b[1:3] and later and b[3] <= a[3] <= b[3] + timedelta(days=30)

    assert got == sorted(a[0] for a in apps if any(partner(a, b) for b in apps))  # one row each


def test_hot_group_percentile(spark, skew_conf):
    rnd = random.Random(9)
    vals = [int(rnd.choice([rnd.uniform(0, 3e12), 7_000_000, rnd.expovariate(1e-13)])) for _ in range(20000)]
    data = [("hot", v) for v in vals] + [("cold", i) for i in range(10)]
    df = spark.createDataFrame(data, "k string, v long").repartition(8)
    out = {r["k"]: r["p"] for r in percentile_cont(df, ["k"], "v", 0.9, alias="p").collect()}
    assert out["hot"] == pytest.approx(float(np.percentile(vals, 90)), rel=1e-12)
    assert out["cold"] == pytest.approx(8.1)
