"""Print the formatted physical plans of the central jobs (snapshot build, policy
rank, KS sweep) so scans, pushed filters, exchanges and broadcasts can be read.

    python tools/show_plans.py [/root/testdata/sf0.01]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from keepwell.config import ORDERS_PARAMS, ORDERS_SCENARIO
    from keepwell.operators import decisioning as dec
    from keepwell.operators import drift
    from keepwell.operators.normalize import normalize_transactions
    from keepwell.operators.snapshots import snapshot_candidates
    from keepwell.plans import catalog
    from keepwell.session import get_session
    from keepwell.sources.tables import orders_transactions

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 16)
    jobs = {
        "transactions (adapter joins, pruned scans)": normalize_transactions(orders_transactions(spark, sf_dir)),
        "snapshot candidates (all cutoffs, one plan)": snapshot_candidates(catalog.transactions(spark, sf_dir),
                                                                           ORDERS_PARAMS),
        "value policy rank (ordered prefix)": dec.apply_policy(catalog.cohort(spark, sf_dir), ORDERS_SCENARIO,
                                                               "expected_value", ORDERS_PARAMS.history_days)[0],
        "KS per column (grouped sweep)": drift.ks_statistic(catalog.cohort(spark, sf_dir, "train"),
                                                            catalog.cohort(spark, sf_dir, "test")),
    }
    for title, df in jobs.items():
        print("=" * 100)
        print(title)
        print("=" * 100)
        df.explain("formatted")


if __name__ == "__main__":
    main()
