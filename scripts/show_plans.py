"""Print the physical plans that matter at scale (used for PLANS.md):
the loan-level feed job and the post-feed chain-ladder phase."""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from runoff.config import DEFAULT  # noqa: E402
from runoff.operators import feed  # noqa: E402
from runoff.plans.book import Book  # noqa: E402
from runoff.session import build_session  # noqa: E402


def tree(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "\n".join(line for line in plan.splitlines() if "Initial Plan" not in line)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    b = Book.from_driver_tables(spark, sf_dir, DEFAULT)
    print("== feed (loan-level job) ==")
    f = feed.feed_with_disbursal(b.loans, b.perf, DEFAULT)
    f.explain("formatted")
    b.feed
    print("== triangles (post-feed, from the checkpoint) ==")
    print(tree(b.triangles))
    print("== weighted rates ==")
    print(tree(b.wavg))


if __name__ == "__main__":
    main()
