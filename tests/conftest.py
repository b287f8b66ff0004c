from __future__ import annotations

import os
import sys
import tempfile
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from hirelens.model import HiringTables  # noqa: E402
from hirelens.schemas import table_schema  # noqa: E402
from hirelens.session import build_session, set_checkpoint_dir_if_unset  # noqa: E402

T0 = datetime(2023, 1, 2, 9, 0, 0)  # a Monday


def ts(days: float = 0.0, **kw) -> datetime:
    return T0 + timedelta(days=days, **kw)


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="hirelens-tests-", dir="/tmp")
    session = build_session(
        "local[4]",
        4,
        app_name="hirelens-tests",
        extra={
            "spark.sql.warehouse.dir": scratch + "/warehouse",
            "spark.driver.memory": "4g",
        },
    )
    set_checkpoint_dir_if_unset(session, scratch + "/checkpoints")
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="hirelens-case-", dir="/tmp")


def frame(spark, name: str, rows: list[tuple]):
    return spark.createDataFrame(rows, table_schema(name))


def make_tables(
    spark,
    applications: list[tuple],
    events: list[tuple] = (),
    offers: list[tuple] = (),
    candidates: list[tuple] | None = None,
    requisitions: list[tuple] | None = None,
    hires: list[tuple] = (),
) -> HiringTables:
    """Hiring tables from hand-made rows. Applications are
    (application_id, candidate_id, req_id, apply_ts, recruiter_id); events
    (event_id, application_id, stage, stage_ts[, actor_type]); offers
    (offer_id, application_id, offer_ts[, decision, comp_band])."""
    if candidates is None:
        cids = sorted({a[1] for a in applications if a[1] is not None})
        candidates = [(c, ts(-100), "Referral", "Remote", 5, "0123456789abcdef") for c in cids]
    if requisitions is None:
        rids = sorted({a[2] for a in applications if a[2] is not None})
        requisitions = [(r, "Engineering", "Data", "IC3", ts(-200), None) for r in rids]
    ev = [e if len(e) == 5 else (*e, "System") for e in events]
    of = [o if len(o) == 5 else (*o, "ACCEPTED", "A") for o in offers]
    return HiringTables(
        candidates=frame(spark, "candidates", candidates),
        requisitions=frame(spark, "requisitions", requisitions),
        applications=frame(spark, "applications", applications),
        stage_events_raw=frame(spark, "stage_events_raw", ev),
        offers=frame(spark, "offers", of),
        hires=frame(spark, "hires", list(hires)),
    ).with_promoted_events()


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns if none given)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
