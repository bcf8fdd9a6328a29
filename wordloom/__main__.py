"""``python -m wordloom <input directory> <output directory>``"""

from __future__ import annotations

import sys

from wordloom.plans.pipeline import run_pipeline
from wordloom.session import builder

USAGE = "usage: python -m wordloom <input directory> <output directory>"


def main(args: list[str]) -> int:
    if len(args) != 2:
        print(USAGE, file=sys.stderr)
        return -1
    spark = builder().getOrCreate()
    for stage, path in run_pipeline(spark, *args).items():
        print(f"{stage}: {path}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
