"""Command line check: ``python tests/check.py [sf] [sql] [name ...]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tallybuy.session import build_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("sf") else "sf0.01"
    directory = f"/root/testdata/{sf}"
    spark = build_session("8")
    con = connect(directory)
    queries, checks = entry.queries(), entry.oracle_sql()
    if "sql" in args:
        args.remove("sql")
        queries = {n: q for n, q in queries.items() if n in checks}
    names = [n for n in queries if not args or any(a in n for a in args)]
    failed = []
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, directory)
            if name in checks:
                verdict = compare(df, con, checks[name])
                note = "ok" if verdict is None else verdict
            else:
                verdict, note = None, f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            verdict = note = f"{type(error).__name__}: {str(error)[:600]}"
        if verdict is not None:
            failed.append(name)
        print(f"{time.time() - start:6.2f}s {name}: {note}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} good; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
