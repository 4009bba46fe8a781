"""Write the physical plan tree of chosen queries to docs/PLANS.md."""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.plans import catalog  # noqa: E402
from stratum.session import build_session  # noqa: E402

NAMES = ["industry_dominance", "age_effect", "value_by_tier", "factor_dominance",
         "rank_correlation", "name_key", "best_per_key", "ingest_manifest", "gold_fact",
         "bgp_join"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans", "", f"Generated by `tools/plans.py` on `{sf}` (local[8]); the",
           "`explain(\"formatted\")` tree plus each scan's pushed filters and read schema.", ""]
    for name in NAMES:
        df = catalog.QUERIES[name](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        text = buf.getvalue()
        tree, _, details = text.partition("\n\n\n")
        scans = [ln for ln in details.splitlines()
                 if ln.startswith(("PushedFilters", "ReadSchema", "Location"))]
        out += [f"## {name}", "", "```", tree.strip(), "", *scans, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
