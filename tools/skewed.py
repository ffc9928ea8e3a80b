"""Write skewed tables and time queries on them: ``skewed.py <new folder> [rows] [name ...]``.

A third of the events has one code, another third one day; a third of the orders has one
customer, another third one date; a third of the line items has one order.
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tickloom.catalog import QUERIES  # noqa: E402
from tickloom.session import local_session  # noqa: E402

EVENTS = """
  id AS event_id,
  timestamp_ntz'2024-01-01' + make_dt_interval(IF(id % 3 = 0, 8, 0), 0, 0,
      CAST(IF(id % 3 = 0, pmod(hash(id), 86400), id * 2592000D / {rows}) AS DECIMAL(18, 6))) AS ts,
  CAST(IF(id % 3 = 1, 1, pmod(hash(id, 2), 15000)) AS BIGINT) AS user_id,
  IF(id % 3 = 1, 'click', element_at(array('view', 'click', 'error', 'signup', 'purchase'),
                                     CAST(pmod(hash(id, 3), 5) + 1 AS INT))) AS event_type,
  round(pmod(hash(id, 4), 10000) / 100D + 0.01D, 2) AS value,
  concat('{{"k": ', pmod(hash(id, 5), 100), '}}') AS props"""

ORDERS = """
  id AS o_orderkey, CAST(IF(id % 3 = 1, 7, pmod(hash(id, 2), 150000)) AS BIGINT) AS o_custkey,
  element_at(array('O', 'P', 'F'), CAST(pmod(hash(id), 3) + 1 AS INT)) AS o_orderstatus,
  round(pmod(hash(id, 9), 50000000) / 100D, 2) AS o_totalprice,
  timestamp_ntz'1995-01-01' + make_dt_interval(CAST(IF(id % 3 = 2, 100, pmod(hash(id, 8), 2400)) AS INT)) AS o_orderdate,
  concat(pmod(hash(id, 6), 5) + 1, '-P') AS o_orderpriority"""

LINEITEM = """
  IF(id % 3 = 0, 5, id DIV 2) AS l_orderkey, CAST(pmod(hash(id), 50) + 1 AS DOUBLE) AS l_quantity"""


def main() -> None:
    folder, rows = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 20_000_000
    spark = local_session(8, shuffle_partitions=32, memory="16g")
    tables = {"events": (rows, EVENTS.format(rows=rows)), "orders": (rows // 2, ORDERS), "lineitem": (rows, LINEITEM)}
    for name, (count, columns) in tables.items():
        path = f"{folder}/{name}.parquet"
        if not os.path.exists(path):
            spark.range(count, numPartitions=32).selectExpr(f"struct({columns}) AS r").select("r.*").write.parquet(path)
    for name in sys.argv[3:] or list(QUERIES):
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        print(f"{name} {time.perf_counter() - start:.2f}", flush=True)


if __name__ == "__main__":
    main()
