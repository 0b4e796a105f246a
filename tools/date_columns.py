"""Regenerate stationcast/plans/date_columns.py: the DATE-typed output
columns of every catalogue query that has oracle SQL.

Usage: python tools/date_columns.py
Run after adding or changing a catalogue query; the oracle tests fail on a
stale list (a DATE column on one side, text on the other).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


def main():
    from stationcast.plans.registry import ORACLE, RAW_QUERIES, load_all
    from stationcast.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    load_all()
    out = {}
    for name in sorted(ORACLE):
        df = RAW_QUERIES[name](spark, SF)
        cols = [c for c, t in df.dtypes if t == "date"]
        if cols:
            out[name] = cols
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "stationcast", "plans", "date_columns.py")
    with open(path, "w") as f:
        f.write('"""DATE output columns of catalogue queries (generated by tools/date_columns.py)."""\n\n')
        f.write("DATE_COLUMNS = {\n")
        for k, v in out.items():
            f.write(f"    {k!r}: {v!r},\n")
        f.write("}\n")
    print(f"{len(out)} queries with date columns -> {path}")


if __name__ == "__main__":
    main()
