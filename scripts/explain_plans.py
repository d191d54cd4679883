"""Write the physical plans of the headline queries to docs/PLANS.md.

usage: python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["fisher_mean_var", "fisher_mean_by_rank_split", "cov_train_test", "zscore_rows", "u_rows",
         "embedding_corr_wide"]


def main():
    from pyspark.sql import SparkSession

    from cohortmx.plans.queries import QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `scripts/explain_plans.py` on `{os.path.basename(sf.rstrip('/'))}` "
           "(`explain(\"formatted\")`, before AQE re-planning; checkpointed inputs show as `Scan ExistingRDD`).", ""]
    for name in NAMES:
        buf = io.StringIO()
        with redirect_stdout(buf):
            QUERIES[name](spark, sf).explain("formatted")
        text = re.sub(r"#\d+L?", "", buf.getvalue())
        tree = text.split("\n\n")[0]
        scans = [ln for ln in text.splitlines() if ln.startswith(("PushedFilters", "ReadSchema"))]
        out += [f"## {name}", "", "```", tree.strip(), "```", ""]
        if scans:
            out += ["Scan details:", "", "```", *sorted(set(scans)), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
