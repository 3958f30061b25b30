"""Skew probe (not a registered query): the listing repeated N times, a third of
all rows on one Product_ID, through the gate and the duplicate summary.

Usage: python tools/scale_probe.py [copies] [sf_dir] [--large]
  --large forces the plans chosen for large inputs (hash-first repeated keys).
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def skewed_listing(spark, sf_dir: str, copies: int):
    from pyspark.sql import functions as F

    from shelfgate.sources.fixtures import listing

    rep = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("rep")
    df = listing(spark, sf_dir).select("*", rep)
    name = F.concat_ws("#", "Product_Name", F.col("rep").cast("string"))
    hot = F.xxhash64(name) % 3 == 0
    return df.select(
        *[c for c in df.columns if c not in ("Product_Name", "Product_ID", "rep")],
        name.alias("Product_Name"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat_ws("#", "Product_ID", F.col("rep").cast("string")))
         .alias("Product_ID"))


def main() -> None:
    from shelfgate import session
    from shelfgate.operators import keys
    from shelfgate.operators.audit import duplicate_summary
    from shelfgate.operators.gate import gate
    from shelfgate.operators.rules import default_rules

    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    copies = int(args[0]) if args else 32
    sf = args[1] if len(args) > 1 else "/root/testdata/sf0.1"
    spark = session.local_session(shuffle_partitions=64)
    if "--large" in sys.argv:
        keys.MAX_BROADCAST_BYTES = -1
    df = skewed_listing(spark, sf, copies)
    t = time.time()
    n = gate(df, default_rules()).survivors().count()
    print(f"gate survivors {n} in {time.time() - t:.1f} s")
    t = time.time()
    r = duplicate_summary(df, ["Product_ID"]).first()
    print(f"duplicate summary {tuple(r)} in {time.time() - t:.1f} s")


if __name__ == "__main__":
    main()
