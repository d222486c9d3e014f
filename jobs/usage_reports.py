"""Refresh the usage-cost report tables behind a dashboard.

    spark-submit jobs/usage_reports.py --sf-dir <tables> --out <root> [--as-of 2024-01-31T00:00:00] [--days 7]

Every report is written with a staged replace under <out>/reports/<name>.
The events scan is cut to the window; metering and load (per warehouse-hour)
are aggregated once and checkpointed, then shared by all reports.
"""

from __future__ import annotations

import datetime as dt

from common import parse, session

from meterwise import params as P
from meterwise.operators import dashboard as D
from meterwise.operators import reports as R
from meterwise.session import materialised, tagged
from meterwise.sources.logs import materialize_hourly, usage_logs
from meterwise.sources.sinks import staged_replace


def reports(spark, sf_dir: str, as_of: dt.datetime, days: int) -> dict:
    L = materialize_hourly(usage_logs(spark, sf_dir, max(days, 30), as_of=as_of))
    kw = {"as_of": as_of, "days": days}
    groups = materialised(R.path_groups(L.qh, L.meter, **kw), "path_groups")  # one attribution for four reports
    return {
        "hourly_utilization": R.hourly_utilization(L.meter, **kw),
        "warehouse_load": R.warehouse_load(L.load, **kw),
        "cost_by_workload_path": R.cost_by_workload_path(L.qh, L.meter, L.params, groups=groups, **kw),
        "query_performance": R.query_performance(L.qh, **kw),
        "daily_credit_trend": R.daily_credit_trend(L.meter, L.params, as_of=as_of, days=max(days, 30)),
        "dashboard_kpis": D.dashboard_kpis(L.meter, L.params, **kw),
        "workload_costs": D.workload_costs(L.qh, L.meter, L.params, groups=groups, **kw),
        "path_costs": D.path_costs(L.qh, L.meter, L.params, groups=groups, **kw),
        "cost_breakdown": D.cost_breakdown(L.qh, L.meter, L.params, groups=groups, **kw),
        "workload_perf": D.workload_perf(L.qh, **kw),
        "runtime_histogram": D.runtime_histogram(L.qh, **kw),
        "recommendations": D.recommendations(L.qh, L.meter, L.load, **kw),
        "kpi_status": D.kpi_status(L.qh, L.meter, **kw),
        "kpi_trends": D.kpi_trends(L.qh, L.meter, **kw),
        "executive_summary": R.executive_summary(L.qh, L.meter, L.params, **kw),
    }


def main() -> str:
    args = parse(__doc__, [(("--as-of",), {"default": P.AS_OF.isoformat()}),
                           (("--days",), {"type": int, "default": 7})])
    spark = session("meterwise-usage-reports")
    as_of = dt.datetime.fromisoformat(args.as_of)
    with tagged(spark, "DATA_PREP"):
        for name, df in reports(spark, args.sf_dir, as_of, args.days).items():
            staged_replace(df, f"{args.out}/reports/{name}")
    return "OK"


if __name__ == "__main__":
    print(main())
