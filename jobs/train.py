"""Train the boosted-tree model on Global features and register it (idempotent).

    spark-submit jobs/train.py --sf-dir <tables> --out <root> [--version v1] [--param max_depth=5 ...]
"""

from __future__ import annotations

from common import parse, session, weekly

from meterwise.operators import features as FT
from meterwise.operators.models import train_gbt
from meterwise.operators.registry import ModelRegistry
from meterwise.session import tagged


def main() -> str:
    args = parse(__doc__, [(("--version",), {"default": "v1"}), (("--param",), {"action": "append", "default": [], "metavar": "NAME=VALUE"})])
    spark = session("meterwise-train")
    with tagged(spark, "TRAINING", "BOOSTED"):
        feats = FT.training_features(weekly(spark, args, region="Global"))
        model = train_gbt(feats, params={k: float(v) for k, v in (p.split("=", 1) for p in args.param)})
        if isinstance(model, str):
            return model
        ModelRegistry(spark, f"{args.out}/models").log_model(model, "stream_forecast", args.version,
                                                            comment="Global forecast model (boosted trees)")
    return "MODEL_SAVED"


if __name__ == "__main__":
    print(main())
