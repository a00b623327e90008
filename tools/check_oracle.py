"""Compare each registered Spark query with its DuckDB oracle (rows, columns,
order-insensitive values), as the driver's correctness check does.

    python tools/check_oracle.py [sf_dir] [name ...]
"""

import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, ".")
import oracle  # noqa: E402
from tidewater.plans import queries  # noqa: E402
from tidewater.session import local_session  # noqa: E402

BASES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def rows_of(records):
    return Counter(tuple("NULL" if v is None else repr(v) for v in r) for r in records)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries.QUERIES)
    spark = local_session(8)
    con = duckdb.connect()
    for b in BASES:
        con.execute(f"CREATE VIEW {b} AS SELECT * FROM read_parquet('{sf_dir}/{b}.parquet')")
    bad = 0
    for name in wanted:
        t0 = time.time()
        sdf = queries.run(name, spark, sf_dir)
        srows = [tuple(r) for r in sdf.collect()]
        t1 = time.time()
        if name not in oracle.names():
            print(f"{name:28s} spark={len(srows):7d}  (no oracle)  {t1 - t0:.1f}s")
            continue
        try:
            cur = con.execute(oracle.sql(name))
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} ORACLE ERROR {str(e)[:300]}")
            continue
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        same_cols = ocols == sdf.columns
        a, b = rows_of(srows), rows_of(orows)
        ok = same_cols and a == b
        bad += not ok
        print(f"{name:28s} spark={len(srows):7d} oracle={len(orows):7d} cols={'ok' if same_cols else 'DIFF'} "
              f"values={'ok' if a == b else 'DIFF'}  {t1 - t0:.1f}s")
        if not ok:
            if not same_cols:
                print("   spark :", sdf.columns)
                print("   oracle:", ocols)
            only_s, only_o = list((a - b).elements())[:3], list((b - a).elements())[:3]
            for r in only_s:
                print("   only spark :", r)
            for r in only_o:
                print("   only oracle:", r)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
