"""Write PLANS.md: the physical plans of the headline queries (explain formatted, trimmed)."""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["clean_text", "filter_nonempty_input", "corpus_stats", "dedup_exact", "license_filter", "scan_parquet", "category_texts"]
KEEP = re.compile(r"^(\S.*\(\d+\)|[ :+|-]+.*\(\d+\)|PushedFilters|ReadSchema|PartitionFilters|Functions|Keys|Join type|Join condition|Arguments)")


def main(sf_dir: str = "/root/testdata/sf0.1") -> None:
    from corpusmill.plans.registry import queries
    from corpusmill.session import local_session

    spark = local_session()
    qs = queries()
    out = ["# Physical plans (explain formatted, trimmed)", "", f"Generated by `tools/explain_plans.py` on `{sf_dir}`.", ""]
    for name in NAMES:
        df = qs[name](spark, sf_dir)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        lines = [ln[:220] for ln in buf.getvalue().splitlines() if KEEP.match(ln.strip()) or ln.startswith(("+-", "*", " ", ":"))]
        out += [f"## {name}", "", "```", *[ln for ln in lines if ln.strip()], "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
