"""Derive a k-times larger copy of a test-data folder from its own tables (key-offset copies).

usage: python tools/make_scaled.py <src_sf_dir> <out_dir> <k>
Only the tables the feature pipeline reads are multiplied (supplier, customer, events); keys are
offset per copy so every copy is a distinct set of stations, tracts and users. The rest are copied.
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from tessera.session import local_session  # noqa: E402
from tessera.sources.tables import TABLES, read_table  # noqa: E402

OFFSETS = {"supplier": ["s_suppkey"], "customer": ["c_custkey"], "events": ["event_id", "user_id"]}


def main():
    src, out, k = sys.argv[1], sys.argv[2].rstrip("/"), int(sys.argv[3])
    spark = local_session()
    for t in TABLES:
        df = read_table(spark, src, t)
        if t in OFFSETS:
            span = {c: df.agg(F.max(c) + 1).first()[0] for c in OFFSETS[t]}
            copies = [df.select(*[(F.col(c) + F.lit(i * span[c])).cast(df.schema[c].dataType).alias(c) if c in span
                                  else F.col(c) for c in df.columns]) for i in range(k)]
            df = copies[0]
            for c in copies[1:]:
                df = df.unionByName(c)
        df.coalesce(1).write.mode("overwrite").parquet(f"{out}/{t}.parquet")  # a folder; Spark reads it as one table
    spark.stop()


if __name__ == "__main__":
    main()
