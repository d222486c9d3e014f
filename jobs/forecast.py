"""Fit the trend model, forecast 12 weeks and replace the forecast table.

    spark-submit jobs/forecast.py --sf-dir <tables> --out <root> [--by-track] [--periods 12]
"""

from __future__ import annotations

from common import parse, session, weekly

from meterwise import params as P
from meterwise.operators.forecast import fit_trend, forecast
from meterwise.session import tagged
from meterwise.sources.sinks import replace_table


def main() -> str:
    args = parse(__doc__, [(("--by-track",), {"action": "store_true"}),
                           (("--periods",), {"type": int, "default": P.FORECAST_HORIZON})])
    spark = session("meterwise-forecast")
    data = weekly(spark, args, region="Global")
    with tagged(spark, "TRAINING", "NATIVE"):
        model = fit_trend(data, series_cols=["isrc"] if args.by_track else ())
        model = replace_table(model, f"{args.out}/trend_model")
    with tagged(spark, "INFERENCE", "NATIVE"):
        out = replace_table(forecast(model, periods=args.periods), f"{args.out}/forecast_output_trend")
        out.orderBy("series", "horizon").show(10, truncate=False)  # preview, as the script validates
    return "OK"


if __name__ == "__main__":
    print(main())
