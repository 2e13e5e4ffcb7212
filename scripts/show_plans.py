"""Print the physical plan (operator tree + scan schemas/filters) of key queries.

usage: python scripts/show_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnlens.operators import features as FE  # noqa: E402
from churnlens.operators import panel as PA  # noqa: E402
from churnlens.plans import catalog as C  # noqa: E402
from churnlens.session import local_session  # noqa: E402

KEEP = re.compile(r"^(\(\d+\) Scan parquet|ReadSchema|PushedFilters|Output \[)")


def show(title, df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n")
    print(f"## {title}\n\n```\n{tree.strip()}\n")
    scans = [ln for ln in details.splitlines() if KEEP.match(ln) and not ln.startswith("Output")]
    print("\n".join(scans))
    print("```\n")


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("# Physical plans of key queries\n")
    print(f"Generated by `scripts/show_plans.py` on `{d}` (local mode, AQE initial plans).\n")
    show("client_month_panel (transactions -> conditional aggregate -> MRR fill join)",
         PA.client_month_panel(C.transactions(spark, d), C.clients_clean(spark, d)))
    show("model_ready from the panel (churn-date join, windows, static join)",
         FE.model_ready_from_panel(C.panel(spark, d), C.clients_clean(spark, d), 1))
    show("lorenz_curve (distributed prefix sum)", C.REGISTRY["lorenz_curve"].fn(spark, d))
    show("roc_auc (distinct scores -> prefix sums -> trapezoids)",
         C.REGISTRY["roc_auc"].fn(spark, d))
    show("recommendations (rules + global priority)", C.REGISTRY["recommendations"].fn(spark, d))
    show("what_if (scored once, fanned out, scored again; no self-join)", C.REGISTRY["what_if"].fn(spark, d))
    show("risk_top_k (per-task top k)", C.REGISTRY["risk_top_k"].fn(spark, d))


if __name__ == "__main__":
    main()
