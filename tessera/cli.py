"""The library on the command line.

    python -m tessera.cli list
    python -m tessera.cli run QUERY FOLDER [--out PATH]
    python -m tessera.cli sql FILE [--tables FOLDER]
    python -m tessera.cli parity REFERENCE ACTUAL --keys a,b --columns x,y [--tolerance 1e-9]
    python -m tessera.cli ingest SOURCE TARGET ENTITY...      each entity's subfolder into a merged table
    python -m tessera.cli publish SOURCE TABLE [--not-null a,b] [--key a,b]
    python -m tessera.cli history|compact|vacuum TABLE [--keep N]
    python -m tessera.cli cluster TABLE --by a,b [--files N]

Exit status: 0 done, or both sides agree; 1 they differ, a query failed or a write was refused; 2 wrong usage.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from tessera.operators.quality import CheckFailed, parity
from tessera.plans import catalogue, sqlrun
from tessera.session import session
from tessera.sources.landing import exists
from tessera.sources.versioned import VersionedTable
from tessera.streaming.merging import ingest_entities

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations "
    "clicks sales sale_lines clients client_changes vendors items stamps"
).split()


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera", description="Queries of the library over a folder of tables.")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of the registered queries")
    run = sub.add_parser("run", help="run a registered query")
    run.add_argument("query")
    run.add_argument("folder")
    run.add_argument("--out", help="write Parquet there instead of showing rows")
    sql = sub.add_parser("sql", help="run the statements of a file and show the first rows of each")
    sql.add_argument("file")
    sql.add_argument("--tables", help="a folder whose tables become views")
    par = sub.add_parser("parity", help="compare two Parquet tables by key")
    par.add_argument("reference")
    par.add_argument("actual")
    par.add_argument("--keys", required=True)
    par.add_argument("--columns", required=True)
    par.add_argument("--tolerance", type=float, default=1e-9)
    ing = sub.add_parser("ingest", help="take in new files of some entities, whatever their schemas")
    ing.add_argument("source")
    ing.add_argument("target")
    ing.add_argument("entities", nargs="+")
    pub = sub.add_parser("publish", help="write Parquet as a table's next version if it meets the constraints")
    pub.add_argument("source")
    pub.add_argument("table")
    pub.add_argument("--not-null", default="")
    pub.add_argument("--key", default="")
    for name, said in (("history", "versions of a table"), ("compact", "pack a table's small files"), ("vacuum", "delete old versions"), ("cluster", "order a table by several columns")):
        one = sub.add_parser(name, help=said)
        one.add_argument("table")
        if name == "vacuum":
            one.add_argument("--keep", type=int, default=2)
        if name == "cluster":
            one.add_argument("--by", required=True)
            one.add_argument("--files", type=int, default=64)
    return p


def _names(listed: str) -> list[str]:
    return [c for c in listed.split(",") if c]


def _versioned(a: argparse.Namespace, spark) -> int:
    """The commands of versioned tables."""
    table = VersionedTable(spark, a.table)
    if a.command == "history":
        table.history().orderBy("version").show(1000, truncate=False)
    elif a.command == "publish":
        try:
            print("version", table.write(spark.read.parquet(a.source), _names(a.not_null), _names(a.key)))
        except CheckFailed as e:
            print("refused:", e)
            return 1
    elif a.command == "cluster":
        print("version", table.cluster(_names(a.by), a.files))
    elif a.command == "compact":
        print("version", table.compact() or "as it was")
    else:
        print("deleted:", *table.vacuum(a.keep))
    return 0


def main(args: list[str] | None = None, spark=None) -> int:
    a = _parser().parse_args(args)
    known = catalogue.queries()
    if a.command == "list":
        print("\n".join(sorted(known)))
        return 0
    if a.command == "run" and a.query not in known:
        print(f"no query {a.query}", file=sys.stderr)
        return 2
    spark = spark or session("tessera")
    if a.command == "run":
        out = known[a.query](spark, a.folder)
        if a.out:
            out.write.mode("overwrite").parquet(a.out)
        else:
            out.show(sqlrun.ROWS, truncate=False)
        return 0
    if a.command == "ingest":
        for entity, rows in ingest_entities(spark, a.source, a.target, a.entities).items():
            print(entity, rows)
        return 0
    if a.command in ("publish", "history", "compact", "vacuum", "cluster"):
        return _versioned(a, spark)
    if a.command == "sql":
        for t in TABLES if a.tables else ():
            if exists(spark, f"{a.tables}/{t}.parquet"):
                spark.read.parquet(f"{a.tables}/{t}.parquet").createOrReplaceTempView(t)
        for rows in sqlrun.run_file(spark, Path(a.file).read_text()):
            for r in rows:
                print(*r, sep="\t")
            print()
        return 0
    found = parity(spark.read.parquet(a.reference), spark.read.parquet(a.actual), a.keys.split(","), a.columns.split(","), a.tolerance)
    differ = found.count()
    print(f"{differ} differences")
    if differ:
        found.orderBy("column", *a.keys.split(",")).show(sqlrun.ROWS, truncate=False)
    return int(differ > 0)


if __name__ == "__main__":
    sys.exit(main())
