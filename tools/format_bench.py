"""CSV vs Parquet write/read time and size for the format benchmark rows.

    python tools/format_bench.py 100000 1000000
"""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from lakecraft.jobs import format_bench
    from lakecraft.session import get_session
    spark = get_session("local[8]", app="format-bench", shuffle_partitions=8)
    for n in [int(a) for a in sys.argv[1:]] or [100000, 1000000]:
        work = tempfile.mkdtemp(prefix="format-bench-")
        format_bench(spark, n, work)                # warm-up round, not reported
        print(json.dumps(format_bench(spark, n, work)))


if __name__ == "__main__":
    main()
