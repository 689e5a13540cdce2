import os
import sys
from datetime import date

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from runoff.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app="runoff-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def make_cells(spark, grid, rows, segment="all"):
    """Triangle cells from per-cohort rows:
    (cohort_end date, disb_uc, max_mature_mob, dpd90 list, tpos list); cells a
    cohort has not reached are given as None (their value is never read)."""
    data = []
    for cohort, disb, mm, d90, tp in rows:
        for j, mob in enumerate(grid):
            obs = mob <= mm
            data.append((segment, cohort, mob, 1, disb, mm, obs,
                         int(d90[j]) if obs else 0, int(tp[j]) if obs else 0))
    schema = ("segment string, cohort_end date, mob int, lan_cnt long, disb_uc long, "
              "max_mature_mob int, is_observed boolean, dpd90_uc long, tpos_uc long")
    return spark.createDataFrame(data, schema)


D = date
