"""Write PLANS.md: the physical plan of every registered query as it is planned for large inputs
(automatic broadcast off, so joins show their shuffle form), with the filters and columns that
reach each parquet scan."""

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans.queries import QUERIES  # noqa: E402
from ledgerline.session import local_session  # noqa: E402


def main(sf_dir: str = "/root/testdata/sf0.01", out: str = "PLANS.md") -> None:
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    parts = ["# Physical plans\n",
             "Generated by `tools/dump_plans.py` on the sf0.01 tables with automatic broadcast "
             "switched off, i.e. the shape a large input gets (AQE may still coalesce partitions "
             "or split skewed ones at run time). Per query: the operator tree, then for every "
             "parquet scan the pushed filters and the columns read.\n"]
    for name, fn in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        scan_lines = []
        for block in re.split(r"\n\(\d+\) ", text):
            if block.startswith("Scan parquet"):
                pushed = re.search(r"PushedFilters: (\[.*\])", block)
                schema = re.search(r"ReadSchema: (.*)", block)
                scan_lines.append(f"- pushed: `{pushed.group(1) if pushed else '[]'}`; "
                                  f"reads: `{schema.group(1) if schema else ''}`")
        ex = tree.count("Exchange")
        parts.append(f"## {name}\n\nexchanges: {ex}\n\n```\n{tree.strip()}\n```\n\n"
                     + "\n".join(scan_lines) + "\n")
    # what the registered queries do not show: the production cap, and the measured broadcast
    from ledgerline.operators import checks
    from ledgerline.plans import params as P
    from ledgerline.sources import fixtures as fx
    ev = fx.load_events(spark, sf_dir)
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    production = checks.CapRule(trigger=1)                 # the shipped limits, on
    variants = {
        "first level with the shipped caps on (10,000 an hour)": lambda: checks.first_level_unmatched(
            start, rnd, P.AS_OF, days_back=P.DAYS_BACK, caps=production),
        "first level, source measured and broadcast": lambda: checks.first_level_unmatched(
            start, rnd, P.AS_OF, days_back=P.DAYS_BACK, broadcast=checks.BroadcastRule()),
        "key level, source measured and broadcast": lambda: checks.key_level_unmatched(
            start, rnd, P.AS_OF, broadcast=checks.BroadcastRule()),
    }
    parts.append("# Variants\n\nThe shipped caps, and the plans that `BroadcastRule` gives where the measured source day "
                 "is small.\n")
    for title, make in variants.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            make().explain("formatted")
        tree = buf.getvalue().split("\n\n")[0].replace("== Physical Plan ==\n", "")
        parts.append(f"## {title}\n\nexchanges: {tree.count('Exchange')}\n\n```\n{tree.strip()}\n```\n")
    with open(out, "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
