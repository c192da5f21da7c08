"""Compare every registered query with its SQL: `python tests/oracle_check.py [sf_dir] [name ...]`."""

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def database(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float) and math.isnan(value):
            return "NaN"
        if isinstance(value, datetime.datetime):
            return value.replace(tzinfo=None).isoformat()
        return value

    plain = [tuple(cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, connection, sf_dir: str, name: str) -> list[str]:
    """Differences between the two engines, empty when equal."""
    frame = contract.queries()[name](spark, sf_dir)
    columns, ours = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    answer = connection.execute(contract.oracle_sql()[name])
    names = [item[0] for item in answer.description]
    expected_columns, expected = canonical(names, answer.fetchall())
    if columns != expected_columns:
        return [f"columns {columns} != {expected_columns}"]
    if not expected:
        return ["no rows to compare"]
    mine, theirs = set(map(repr, ours)), set(map(repr, expected))
    problems = [] if len(ours) == len(expected) else [f"rows {len(ours)} != {len(expected)}"]
    problems += [f"{len(mine - theirs)} rows only in Spark, e.g. {sorted(mine - theirs)[:2]}"] if mine - theirs else []
    problems += [f"{len(theirs - mine)} rows only in SQL, e.g. {sorted(theirs - mine)[:2]}"] if theirs - mine else []
    return problems


def main(arguments: list[str]) -> int:
    from candlewick.session import build_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(contract.queries())
    spark = build_session(
        "oracle-check", "local[8]",
        {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    failed = 0
    for name in names:
        began = time.time()
        try:
            problems = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the other queries
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - began:.1f}s {' / '.join(problems)}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
