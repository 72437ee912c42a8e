"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from teampulse.catalog import fixtures as X
from teampulse.catalog import moving as MV
from teampulse.catalog.base import Base
from teampulse.operators import grid
from teampulse.operators import incremental as I
from teampulse.plans import engagement as E
from teampulse.plans import exports as XP
from teampulse.plans import metrics as M
from teampulse.plans import pipeline as P
from teampulse.plans import relations as B
from teampulse.plans import reports as W
from teampulse.plans import teams as T
from teampulse.session import local_session
from teampulse.sources import tables


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    b = Base(spark, sf_dir)
    took: dict[str, float] = {}

    def timed(name: str, fn):
        start = time.perf_counter()
        out = fn()
        took[name] = round(time.perf_counter() - start, 3)
        return out

    run(b.table("nation"))  # the first job also starts the executors

    # the whole weekly run, raw tables to stored reports
    raw, root = X.raw_tables(spark, sf_dir), b.path("store")
    out = timed("weekly_run", lambda: P.run_weekly(spark, root, raw, X.AS_OF))
    exports = ("manager_list", "top_performers", "top_movers", "action_points", "pdf_blocks", "team_detail", "summary", "top3")
    timed("weekly_exports", lambda: [run(out[name]) for name in exports])
    timed("monthly_run", lambda: P.run_monthly(P.Store(spark, root), raw, X.AS_OF))

    # the grid of members by years of weeks: full build against a run with a lookback of four weeks
    keys = P.WEEKLY_KEYS
    weekly = {k: tables.replace_table(v, b.path(k), grid.WEEK, keys) for k, v in MV.large_weekly(b).items()}
    people = b.stored("people", MV.large_members(b))
    path = b.path("engagement")
    target = timed(
        "engagement_full",
        lambda: tables.replace_table(E.engagement_full(people, weekly), path, grid.WEEK, keys),
    )
    newest = I.weeks_since(target, 0)
    as_of = newest + dt.timedelta(days=8)

    known = b.stored("known_members", E.known_members(target))  # the weekly run keeps this list

    def incremental():
        changes = E.engagement_changes(people, weekly, known, newest, as_of)
        return tables.upsert(spark, path, changes, keys, grid.WEEK, keys)

    timed("engagement_incremental", incremental)
    start = grid.weeks_from_calendar(F.lit(dt.date(1995, 1, 2)), F.lit(newest))
    spread = grid.spread_weeks(people.select(grid.MEMBER), start)
    timed("engagement_star_join", lambda: run(grid.star_join(spread, weekly)))
    timed(
        "engagement_one_pass",
        lambda: run(grid.fill_grid(people.select(grid.MEMBER).withColumn("w", start), weekly, "w")),
    )

    # reports
    mapping = timed("manager_mapping", lambda: b.stored("mapping", B.manager_mapping(b.members, b.tags, b.invited, b.businesses)))
    timed("business_relationships", lambda: run(B.business_relationships(mapping, b.members, b.tags)))
    relations, engagement = b.relationships, b.engagement
    timed("team_engagement", lambda: run(W.team_engagement(relations, engagement, X.AS_OF)))
    team = b.team
    timed("manager_rankings", lambda: run(W.manager_rankings(team, relations, summary=T.team_summary(mapping, b.member_rows))))
    timed("team_detail", lambda: run(W.team_detail(team)))
    timed("manager_report_nested", lambda: run(W.manager_report_nested(team, relations)))
    rankings = b.rankings
    timed("export_action_points", lambda: run(XP.action_points(rankings)))
    timed("export_pdf_blocks", lambda: run(XP.pdf_blocks(rankings)))

    # weekly distinct counts over the largest table
    lineitem = b.table("lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    timed("weekly_lineitem", lambda: run(M.weekly_count(lineitem, "l_suppkey", "l_partkey", "l_shipdate", "parts")))

    total = round(sum(took.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
