"""Command line: run a registered query, list the queries, or take in a landing folder."""

from __future__ import annotations

import argparse
import sys

from tarazi.ops.ledger import Ledger
from tarazi.plans import feeds, marts, problems
from tarazi.session import clear_scratch, cut_lineage, local_session
from tarazi.sources import landing

QUERIES = {**marts.QUERIES, **feeds.QUERIES, **problems.QUERIES}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tarazi")
    sub = p.add_subparsers(dest="verb", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("name", choices=sorted(QUERIES))
    q.add_argument("folder")
    q.add_argument("--out")
    i = sub.add_parser("ingest")
    i.add_argument("landing")
    i.add_argument("store")
    i.add_argument("--as-of")
    a = p.parse_args(argv)
    if a.verb == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = local_session()
    if a.verb == "query":
        df = QUERIES[a.name](spark, a.folder)
        df.write.mode("errorifexists").parquet(a.out) if a.out else df.show(20, truncate=False)
        clear_scratch(spark)
        return 0
    ledger = Ledger(spark, f"{a.store}/events")
    stats = ledger.step("ingest", lambda: ingest(spark, a.landing, a.store, a.as_of))
    print(stats)
    return 0


def ingest(spark, folder: str, store: str, as_of: str | None = None) -> dict:
    """Append the records of files that the store has not seen, then their ledger rows: a run that stopped between the two is made whole by the next, without repeated records."""
    ledger_path, records_path = f"{store}/ledger", f"{store}/records"
    schema = "source string, file_sha256 string, path string, kind string, business_date date, file_bytes long"
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = jvm.Path(ledger_path)
    known = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    ledger = spark.read.schema(schema).parquet(ledger_path) if known else spark.createDataFrame([], schema)
    found = cut_lineage(landing.discover(spark, folder, as_of).drop("content"))  # names and hashes, read once
    fresh = cut_lineage(landing.unseen(found, ledger).select("source", "file_sha256", "path", "kind", "business_date", "file_bytes"))
    new = fresh.count()
    if not new:
        return {"files": 0}
    seen = landing.raw_records(landing.discover(spark, folder, as_of).join(fresh.select("path"), "path", "left_semi"))
    records_at = jvm.Path(records_path)
    if records_at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(records_at):  # a run may have stopped before its ledger rows
        old = spark.read.parquet(records_path).select("source", "file_sha256").distinct()
        seen = seen.join(old, ["source", "file_sha256"], "left_anti")
    landing.append_records(seen, records_path)
    fresh.coalesce(1).write.mode("append").parquet(ledger_path)
    return {"files": new}


if __name__ == "__main__":
    sys.exit(main())
