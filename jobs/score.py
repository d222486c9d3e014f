"""Score one region with a registered model and replace the scored-output table.

    spark-submit jobs/score.py --sf-dir <tables> --out <root> [--region Global] [--version v1]
"""

from __future__ import annotations

from common import parse, session, weekly

from meterwise.operators import features as FT
from meterwise.operators.models import NO_ROWS, score_region
from meterwise.operators.registry import ModelRegistry
from meterwise.session import tagged
from meterwise.sources.sinks import staged_replace


def main() -> str:
    args = parse(__doc__, [(("--region",), {"default": "Global"}), (("--version",), {"default": "v1"})])
    spark = session("meterwise-score")
    with tagged(spark, "INFERENCE", "BOOSTED"):
        model = ModelRegistry(spark, f"{args.out}/models").get("stream_forecast", args.version)
        scored = score_region(model, FT.scoring_features(weekly(spark, args, region=args.region), region=args.region))

        class NoRows(Exception):
            pass

        def check(staged):
            if staged.isEmpty():
                raise NoRows()
            if staged.filter("is_forecast = 1 AND streams_predicted IS NULL").limit(1).count():
                raise ValueError("scored rows without a prediction")

        try:
            staged_replace(scored, f"{args.out}/forecast_output_{args.region.lower()}", validate=check)
        except NoRows:
            return NO_ROWS
    return "OK"


if __name__ == "__main__":
    print(main())
