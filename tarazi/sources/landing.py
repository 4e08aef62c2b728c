"""Landing files as raw records with lineage, and the tables they are appended to.

A file is known by its source and the hash of its bytes, not by its path, so a corrected file
under an old name is read and a copy under a new one is not.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of landing files; stores are tried first.
STORES, PRICES = r"([A-Za-z0-9_]+?)_stores_(\d{4}-\d{2}-\d{2})\.(json)$", r"([A-Za-z0-9_]+?)_(\d{4}-\d{2}-\d{2})\.(jsonl|json|csv)$"
#: Every line break of str.splitlines.
LINE_BREAKS = re.compile("\r\n|[\n\r\v\f\x1c\x1d\x1e\x85  ]")
RECORDS = "row_num int, payload string, unparseable boolean"


def parsed_name(path: Column) -> Column:
    """source, kind, business_date and ext of a landing path; source is null for other names."""
    name = F.element_at(F.split(path, "/"), -1)
    stores = F.regexp_extract(name, "^" + STORES, 1) != ""

    def part(i: int) -> Column:
        found = F.when(stores, F.regexp_extract(name, "^" + STORES, i)).otherwise(F.regexp_extract(name, "^" + PRICES, i))
        return F.when(found != "", found)

    return F.struct(part(1).alias("source"), F.when(stores, "stores").otherwise("prices").alias("kind"), part(2).try_cast("date").alias("business_date"), part(3).alias("ext"))


def discover(spark: SparkSession, folder: str, up_to: str | None = None) -> DataFrame:
    """Landing files below a folder, up to a business date: path, source, kind, business_date, ext, content, file_sha256, file_bytes.

    Process them in the order of ``kind`` (stores first), ``business_date`` and ``source``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    named = files.select("path", "content", F.col("length").alias("file_bytes"), parsed_name(F.col("path")).alias("n")).select("path", "n.*", "content", "file_bytes")
    known = named.where(F.col("source").isNotNull() & F.col("business_date").isNotNull())
    if up_to:
        known = known.where(F.col("business_date") <= F.lit(up_to).cast("date"))
    return known.withColumn("file_sha256", F.sha2("content", 256))


def unseen(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content the ledger lacks for their source; of equal new files the first path stays."""
    fresh = files.join(ledger.select("source", "file_sha256").distinct(), ["source", "file_sha256"], "left_anti")
    first = fresh.groupBy("source", "file_sha256").agg(F.min("path").alias("path"))
    return fresh.join(first, ["source", "file_sha256", "path"], "left_semi")


def file_records(ext: str, content: bytes) -> list[tuple[str, bool]]:
    """Records of a file as JSON text, with those that cannot be read marked.

    Bytes that are no UTF-8 are replaced; what cannot be read is kept whole.  A JSON-lines file gives a record a line, blank lines
    none; a JSON file one for each element, or a single unreadable one; a CSV file one a row
    with the header's names.  A row with more fields than the header is unreadable.
    """
    text = content.decode("utf-8", errors="replace")
    out: list[tuple[str, bool]] = []
    if ext == "jsonl":
        for line in LINE_BREAKS.split(text):
            if line.strip():
                out.append(_object(line))
    elif ext == "json":
        try:
            data = json.loads(text)
        except ValueError:
            return [(text, True)]
        for x in data if isinstance(data, list) else [data]:
            out.append((json.dumps(x, sort_keys=True, ensure_ascii=False), not isinstance(x, dict)))
    else:
        for row in csv.DictReader(io.StringIO(text, newline="")):
            out.append((json.dumps({k: v for k, v in row.items() if k is not None}, sort_keys=True, ensure_ascii=False), None in row))
    return out


def _object(line: str) -> tuple[str, bool]:
    try:
        o = json.loads(line)
    except ValueError:
        return line, True
    return (json.dumps(o, sort_keys=True, ensure_ascii=False), False) if isinstance(o, dict) else (line, True)


def raw_records(files: DataFrame) -> DataFrame:
    """One row a record: source, kind, business_date, file_sha256, row_num from 1, payload, unparseable, record_hash."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s, k, d, h, e, c in zip(pdf["source"], pdf["kind"], pdf["business_date"], pdf["file_sha256"], pdf["ext"], pdf["content"]):
                got = file_records(e, bytes(c))
                yield pd.DataFrame(
                    {"source": s, "kind": k, "business_date": d, "file_sha256": h, "row_num": range(1, len(got) + 1), "payload": [p for p, _ in got], "unparseable": [u for _, u in got]}
                )

    schema = "source string, kind string, business_date date, file_sha256 string, " + RECORDS
    records = files.select("source", "kind", "business_date", "file_sha256", "ext", "content").mapInPandas(read, schema)
    return records.withColumn("record_hash", F.sha1("payload"))


def append_records(records: DataFrame, path: str) -> None:
    """Append to the record table, which is partitioned by business date; nothing is ever overwritten."""
    records.write.mode("append").partitionBy("business_date").parquet(path)


def reference_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small reference table with a header; its columns are declared, not inferred."""
    return spark.read.csv(path, header=True, schema=schema)
