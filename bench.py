"""Headline queries with the reference's default parameters.

Prints one JSON line.  ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and
cores; every query runs once to warm the JIT and is then timed once, end to
end (plan building, execution, full materialisation of all result columns).
The panel, which the pipeline keeps as a table, is staged once and timed on its
own as ``panel``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandspark.config import DemandConfig  # noqa: E402
from demandspark.plans.queries import END, operator  # noqa: E402
from demandspark.session import session  # noqa: E402

HEADLINE = (
    "panel",
    "target_features",
    "category_features",
    "subject_panel",
    "interval_mode",
    "abc_class",
    "patient_agg",
    "encode_categories",
    "predict_dataset",
    "train_dataset",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]")
    cfg = DemandConfig(end=END)
    names = sys.argv[1:] or HEADLINE

    def once(name: str) -> float:
        start = time.time()
        operator(name, spark, sf_dir, cfg).write.format("noop").mode("overwrite").save()
        return time.time() - start

    seconds = {}
    for name in names:
        cold = once(name)
        seconds[name] = round(once(name), 3)
        print(f"{name}: cold {cold:.1f} s, warm {seconds[name]:.1f} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
