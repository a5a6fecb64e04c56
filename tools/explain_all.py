"""Print the physical plan of every catalogue query (``explain("formatted")``).

    python tools/explain_all.py [sf_dir] [query ...] > plans.txt

Streaming entries run their job first (their plan is the read-back of what
the job wrote). Useful to review pushed filters, read schemas, exchanges and
code-generated stages in one place.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickpulse.plans.catalog import CATALOG  # noqa: E402
from clickpulse.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(8, 8, app="clickpulse-explain")
    for q in CATALOG:
        if only and q.name not in only:
            continue
        print(f"==================== {q.name}  (covers {', '.join(q.covers)})")
        q.build(spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
