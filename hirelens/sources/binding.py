"""Bind the driver's TPC-H-shaped parquet tables to the hiring data model.

Integer arithmetic only, so an independent SQL engine derives identical
rows (the oracle in ``duckdb_oracle.py`` spells out the same mapping). Every
row of every table is used:

* candidates   <- customer joined with nation
* requisitions <- part
* applications <- orders
* stage_events_raw <- lineitem joined with orders, line number 1..7 -> stage;
  one line in 97 points at an application that doesn't exist (its order key
  negated) and so is an orphan
* offers / hires   <- the OFFER / HIRED lines, orphans included

Some columns are bound so that the declared constraints have violations to
find: negative years of experience, levels and lengths outside their domain,
requisitions closed before they open, offer ids that repeat, offers without a
band or an application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.constants import STAGES
from hirelens.model import HiringTables

# Fixed values of the binding.
BASE_DATE = "1995-01-01 00:00:00"
N_RECRUITERS = 35
ORPHAN_EVERY = 97  # (l_orderkey * 7 + l_linenumber) % 97 == 0: no such application
OFFER_DECISION = {"A": "ACCEPTED", "R": "DECLINED", "N": "EXPIRED"}
ACTOR_BY_FLAG = {"A": "Recruiter", "N": "System", "R": "Candidate"}


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _case(col, mapping: dict[str, str]):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr


def _yyyymmdd(ts):
    """Calendar date digits of a zone-less timestamp, without passing
    through the session time zone."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("string")


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bind_testdata(spark: SparkSession, sf_dir: str) -> HiringTables:
    """Hiring tables derived from the driver parquet under ``sf_dir``."""
    customer = read_driver_table(spark, sf_dir, "customer")
    nation = read_driver_table(spark, sf_dir, "nation")
    part = read_driver_table(spark, sf_dir, "part")
    orders = read_driver_table(spark, sf_dir, "orders")
    lineitem = read_driver_table(spark, sf_dir, "lineitem")

    candidates = customer.join(
        nation, customer.c_nationkey == nation.n_nationkey, "left"
    ).select(
        F.col("c_custkey").alias("candidate_id"),
        _ntz(BASE_DATE).alias("created_at"),
        F.col("c_mktsegment").alias("source"),
        F.col("n_name").alias("location"),
        F.floor(F.col("c_acctbal") / 200).cast("int").alias("years_experience"),
        F.substring(F.sha2(F.col("c_name"), 256), 1, 16).alias("email_hash"),
    )

    requisitions = part.select(
        F.col("p_partkey").alias("req_id"),
        F.col("p_type").alias("org"),
        F.col("p_brand").alias("job_family"),
        F.concat(F.lit("IC"), F.repeat((F.lit(1) + F.col("p_size") % 6).cast("string"), F.when(F.col("p_size") == 50, 9).otherwise(1))).alias("level"),
        (_ntz(BASE_DATE) + F.make_dt_interval((F.col("p_partkey") % 1000).cast("int"))).alias("open_date"),
        F.when(F.col("p_partkey") % 5 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(_ntz(BASE_DATE) + F.make_dt_interval(F.floor(F.col("p_retailprice") - 100).cast("int")))
        .alias("close_date"),
    )

    applications = orders.select(
        F.col("o_orderkey").alias("application_id"),
        F.col("o_custkey").alias("candidate_id"),
        (F.col("o_custkey") + F.col("o_orderkey") % 4).alias("req_id"),
        F.col("o_orderdate").alias("apply_ts"),
        F.when(F.col("o_orderkey") % N_RECRUITERS == 0, F.lit(None).cast("long"))
        .otherwise(F.col("o_orderkey") % N_RECRUITERS)
        .alias("recruiter_id"),
    )

    # One pass over the lines gives the events, and with them the attributes
    # that offers and hires need. What depends on a line alone is worked out
    # before the join, so that less is shuffled; the orders' keys and dates are
    # the hashed side, so that the lines need no sort.
    orders_dates = orders.select("o_orderkey", "o_orderdate").hint("shuffle_hash")
    hours = (
        F.lit(96) * (F.least(F.col("l_linenumber"), F.lit(5)) - 1)
        + F.col("l_quantity").cast("int")
        - F.when(F.col("l_discount") >= F.lit(0.09), F.lit(240)).otherwise(F.lit(0))
    ).cast("int")
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", hours.alias("_hours"))
    orphan = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % ORPHAN_EVERY == 0
    events = lines.join(orders_dates, lines.l_orderkey == orders_dates.o_orderkey, "inner").select(
        F.concat_ws(
            "-",
            F.col("l_orderkey").cast("string"),
            F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            _yyyymmdd(F.col("l_shipdate")),
        ).alias("event_id"),
        F.when(orphan, -1 - F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("application_id"),
        F.get(F.array(*[F.lit(s) for s in STAGES]), F.col("l_linenumber") - 1).alias("stage"),
        F.timestamp_add("HOUR", F.col("_hours"), F.col("o_orderdate")).alias("stage_ts"),
        _case(F.col("l_returnflag"), ACTOR_BY_FLAG).alias("actor_type"),
        "l_suppkey",
        "l_partkey",
        "l_returnflag",
    )
    # never null, as the order key was joined on. Said here, every consumer asks
    # the same of the lines, so that raw and promoted events share one shuffle
    events = events.where("application_id IS NOT NULL")
    stage_events_raw = events.select("event_id", "application_id", "stage", "stage_ts", "actor_type")
    offers = events.where(F.col("stage") == "OFFER").select(
        F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_returnflag")).alias("offer_id"),
        "application_id",
        F.when(F.col("l_partkey") % 53 == 52, F.lit(None).cast("timestamp_ntz"))
        .when(
            F.col("l_suppkey") % 10 == 0,
            F.col("stage_ts") - F.make_dt_interval(F.lit(10)),
        )
        .otherwise(F.col("stage_ts"))
        .alias("offer_ts"),
        _case(F.col("l_returnflag"), OFFER_DECISION).alias("decision"),
        F.when(F.col("l_partkey") % 31 != 30, F.get(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("l_partkey") % 3).cast("int"))).alias("comp_band"),
    )
    hires = events.where((F.col("stage") == "HIRED") & (F.col("l_returnflag") == "A")).select(
        F.col("event_id").alias("hire_id"),
        "application_id",
        F.col("stage_ts").alias("hired_ts"),
        F.date_add(F.to_date(F.col("stage_ts")), (F.lit(14) + F.col("l_suppkey") % 32).cast("int")).alias("start_date"),
    )

    return HiringTables(
        candidates=candidates,
        requisitions=requisitions,
        applications=applications,
        stage_events_raw=stage_events_raw,
        offers=offers,
        hires=hires,
    )
