"""``python -m tillroll SOURCE OUT``: the whole pipeline. Status 1 if validation fails."""

from __future__ import annotations

import argparse
import sys

from tillroll.operators.quality import QualityGateError
from tillroll.plans.pipeline import run
from tillroll.session import create_session


def main() -> int:
    parser = argparse.ArgumentParser(prog="tillroll", description=__doc__)
    parser.add_argument("source", help="CSV file, folder or glob")
    parser.add_argument("out", help="folder for tables and reports")
    parser.add_argument("--input-gb", type=float, default=0, help="sizes the shuffles")
    parser.add_argument("--partition-by", nargs="*", default=(), metavar="COLUMN")
    args = parser.parse_args()
    spark = create_session(input_bytes=int(args.input_gb * 2**30))
    try:
        run(spark, args.source, args.out.rstrip("/"), args.partition_by)
    except QualityGateError as error:
        print(error, file=sys.stderr)
        return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
