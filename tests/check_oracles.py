"""Manual run: python tests/check_oracles.py SF_DIR [name ...]"""

import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from tests.harness import compare, connect  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from loopweave.session import build_session  # noqa: E402


def main(sf: str, names: list[str]) -> int:
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__enabled="false",spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    oracles = contract.oracle_sql()
    for name, fn in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                n, diff = compare(df, con, oracles[name])
            else:
                n, diff = df.count(), None
        except Exception as error:  # noqa: BLE001
            n, diff = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += diff is not None
        tag = "FAIL" if diff else ("ok" if name in oracles else "rows")
        print(f"{tag:5} {name:28} {n:8} {time.time() - start:6.2f}s {diff or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
