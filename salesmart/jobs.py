"""Whole runs: load an extract, build a profile, compute the reports, write the results."""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from salesmart.plans import audits, reports, snowflake, star
from salesmart.schemas import (
    SNOWFLAKE_EDGES,
    SNOWFLAKE_KEYS,
    SNOWFLAKE_TABLES,
    STAR_EDGES,
    STAR_KEYS,
    STAR_TABLES,
)
from salesmart.sinks import Writer, save_all, to_database, to_folder
from salesmart.sources import (
    Database,
    Ranges,
    measured_ranges,
    read_staging_csv,
    read_table,
    read_tables,
    text_splits,
)
from salesmart.versions import Versions
from salesmart.workspace import Workspace

#: Tasks of a scan that is split by a column alone.
SCAN_TASKS = 64


def _row_names(staging: DataFrame) -> tuple[str, ...]:
    """What tells a rejected row: its id and, if known, its file, as ids repeat across files."""
    return tuple(name for name in ("id", "_source") if name in staging.columns)


def _row_counts(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    return {row["table"]: row["n"] for row in audits.table_counts(tables).collect()}


def run_snowflake(
    staging: DataFrame,
    workspace: Workspace,
    write: Writer | Workspace,
    write_audits: Writer | None = None,
    strict: bool = False,
    by_key: bool = False,
) -> dict[str, int]:
    """Build and write the twelve snowflake tables; returns rows per table, staging included.

    Given a `Workspace` to write to, the tables are stored there at once instead of being copied.
    """
    space, kept = workspace.child("snowflake"), _row_names(staging)
    keys = snowflake.number(staging, space, by_key)
    linked = snowflake.store_linked(space, staging, keys, kept)
    target = write if isinstance(write, Workspace) else None
    tables = snowflake.build(staging, space, strict, keys, linked, target)
    saved = _row_counts(tables) if target else save_all(tables, write)
    rows = {"staging_raw": staging.count(), **saved}
    if write_audits:
        rows |= save_all({
            "audit_fk": audits.fk_violations(tables, SNOWFLAKE_EDGES, SNOWFLAKE_KEYS),
            "audit_pk": audits.pk_violations(tables, SNOWFLAKE_KEYS),
            "audit_lengths": audits.length_violations(tables, SNOWFLAKE_TABLES),
            "audit_rejects": audits.snowflake_rejects(linked, kept),
        }, write_audits)
    return rows


def run_star(
    staging: DataFrame,
    workspace: Workspace,
    write: Writer | Workspace,
    write_reports: Writer | None = None,
    write_audits: Writer | None = None,
    ordered: bool = False,
    by_key: bool = False,
) -> dict[str, int]:
    """Build and write the six star tables and, if wanted, the eighteen reports on them.

    Given a `Workspace` to write to, the tables are stored there at once instead of being copied.
    """
    space, kept = workspace.child("star"), _row_names(staging)
    target = write if isinstance(write, Workspace) else None
    dims = star.dimensions(staging, space, target, by_key)
    linked = space.store("linked", star.linked(staging, dims, kept)) if write_audits else None
    tables = star.build(staging, space, target, dims, linked)
    saved = _row_counts(tables) if target else save_all(tables, write)
    rows = {"staging_data": staging.count(), **saved}
    if write_audits:
        rows |= save_all({
            "audit_fk": audits.fk_violations(tables, STAR_EDGES, STAR_KEYS),
            "audit_pk": audits.pk_violations(tables, STAR_KEYS),
            "audit_rejects": audits.star_rejects(linked, kept),
        }, write_audits)
    if write_reports:
        rows |= run_reports(tables, workspace, write_reports, ordered)
    return rows


def run_reports(
    tables: Mapping[str, DataFrame], workspace: Workspace, write: Writer, ordered: bool = False
) -> dict[str, int]:
    """Write the eighteen reports on existing star tables."""
    built = reports.build(tables, workspace.child("reports"), ordered)
    return save_all({f"report_{name}": table for name, table in built.items()}, write)


def _bound(text: str) -> int | str:
    """A whole number or, as text, a date."""
    return int(text) if text.lstrip("-").isdigit() else text


def table_ranges(text: str) -> tuple[str, Ranges | tuple[str, int]]:
    """``table:column[:tasks]`` or ``table:column:lower:upper:tasks``, how a table of a database is
    split for reading. Without bounds (column, tasks), and the database is asked for them."""
    table, column, *rest = text.split(":")
    if len(rest) < 2:
        return table, (column, int(rest[0]) if rest else SCAN_TASKS)
    lower, upper, tasks = rest
    return table, Ranges(column, _bound(lower), _bound(upper), int(tasks))


def column_tasks(text: str) -> tuple[str, int]:
    """``column[:tasks]``, how the scan of a staging table is split."""
    column, _, tasks = text.partition(":")
    return column, int(tasks or SCAN_TASKS)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        prog="salesmart", description=__doc__,
        epilog="Databases are given by SALESMART_SOURCE_*, SALESMART_TARGET_* and "
        "SALESMART_REPORTS_*: _URL and, if needed, _USER, _PASSWORD, _DRIVER.",
    )
    commands = parser.add_subparsers(dest="command", required=True)
    for profile in ("snowflake", "star"):
        command = commands.add_parser(profile, help=f"build the {profile} tables")
        source = command.add_mutually_exclusive_group(required=True)
        source.add_argument("--csv", nargs="+", help="CSV files or folders")
        source.add_argument("--parquet", help="staging as parquet")
        source.add_argument("--jdbc-table", help="staging table of the source database")
        split = command.add_mutually_exclusive_group()
        split.add_argument("--predicates", nargs="*", default=[], help="split of the JDBC scan")
        split.add_argument("--split-by", type=column_tasks, metavar="COLUMN[:TASKS]",
                           help="split of the JDBC scan at quantiles of a text column, e.g. id")
        command.add_argument("--ids", choices=["hash", "key"], default="hash",
                             help="dimension ids are ranks by the key's hash or by the key itself")
        command.add_argument("--delimiter", default=",")
        command.add_argument("--single-line", action="store_true",
                             help="no line breaks inside quotes: large CSV files can be split")
        target = command.add_mutually_exclusive_group(required=True)
        target.add_argument("--out", help="folder for the tables")
        target.add_argument("--publish", help="folder for a new version of the tables, which "
                            "readers see as a whole once all are written")
        target.add_argument("--out-jdbc", action="store_true", help="to the target database")
        command.add_argument("--audits-out", help="folder for the audits")
    commands.choices["snowflake"].add_argument(
        "--strict", action="store_true", help="raise on values that do not fit their type")
    command = commands.add_parser("reports", help="reports on existing star tables")
    source = command.add_mutually_exclusive_group(required=True)
    source.add_argument("--star", help="folder of the star tables")
    source.add_argument("--star-jdbc", action="store_true", help="from the source database")
    command.add_argument("--ranges", nargs="*", type=table_ranges, default=[],
                         metavar="TABLE:COLUMN[:LOWER:UPPER][:TASKS]",
                         help="split of the JDBC scan of a table by a number or date column, e.g. "
                         "sales_fact:sale_date; other tables are read by one task")
    for name in ("star", "reports"):
        target = commands.choices[name].add_mutually_exclusive_group(required=name == "reports")
        target.add_argument("--reports-out", help="folder for the reports")
        target.add_argument("--reports-jdbc", action="store_true",
                            help="to the report database")
        commands.choices[name].add_argument("--ordered", action="store_true",
                                            help="sort the reports that have no limit")
    for command in commands.choices.values():
        command.add_argument("--work", help="shared folder for intermediate tables, which then "
                             "stay; by default they are removed at the end")
        command.add_argument("--connections", type=int, default=8, help="of a JDBC sink")
        command.add_argument("--batch-size", type=int, default=10_000, help="of a JDBC sink")
        command.add_argument("--replace", choices=["drop", "truncate", "swap"],
                             help="what becomes of an old table in a JDBC sink")
        command.add_argument("--table-options",
                             help="appended to CREATE TABLE by a JDBC sink, e.g. a table engine")
    return parser.parse_args(argv)


def _staging(spark: SparkSession, workspace: Workspace, options: argparse.Namespace) -> DataFrame:
    """The extract as a stored table, as every later step scans some of its columns."""
    if options.parquet:
        return spark.read.parquet(options.parquet)
    if options.csv:
        rows = read_staging_csv(
            spark, options.csv, options.delimiter, multi_line=not options.single_line,
            with_source=bool(options.audits_out),
        )
    else:
        source = Database.from_environment("SALESMART_SOURCE")
        predicates = options.predicates
        if options.split_by:
            predicates = text_splits(spark, source, options.jdbc_table, *options.split_by)
        rows = read_table(spark, source, options.jdbc_table, predicates=predicates)
    return workspace.store("staging", rows)


def _star_tables(
    spark: SparkSession, workspace: Workspace, options: argparse.Namespace
) -> dict[str, DataFrame]:
    if options.star:
        return read_tables(spark, options.star, STAR_TABLES)
    source, ranges = Database.from_environment("SALESMART_SOURCE"), dict(options.ranges)

    def split(name: str) -> Ranges | None:
        found = ranges.get(name)
        return measured_ranges(spark, source, name, *found) if isinstance(found, tuple) else found

    # Copied once: the reports then neither query the database again nor guess table sizes.
    return workspace.child("copy").store_all(
        [name for name in STAR_TABLES if name != "seller_dim"],  # no report reads it
        lambda name: read_table(spark, source, name, ranges=split(name)),
    )


def main(argv: Sequence[str] | None = None) -> None:
    options = _arguments(argv)
    spark = SparkSession.builder.appName("salesmart").getOrCreate()
    workspace = Workspace(spark, options.work)
    try:
        rows = _run(spark, workspace, options)
    finally:
        if not options.work:
            workspace.remove()
    print(json.dumps(rows, indent=2))


def _run(
    spark: SparkSession, workspace: Workspace, options: argparse.Namespace
) -> dict[str, int]:
    def writer(folder: str | None, to_jdbc: bool, prefix: str) -> Writer | None:
        if to_jdbc:
            return to_database(
                Database.from_environment(prefix), connections=options.connections,
                batch_size=options.batch_size, create_table_options=options.table_options,
                **({"replace": options.replace} if options.replace else {}),
            )
        return to_folder(folder) if folder else None

    if options.command != "snowflake":
        write_reports = writer(options.reports_out, options.reports_jdbc, "SALESMART_REPORTS")
    if options.command == "reports":
        tables = _star_tables(spark, workspace, options)
        return run_reports(tables, workspace, write_reports, options.ordered)
    staging = _staging(spark, workspace, options)
    version = Versions(spark, options.publish).begin() if options.publish else None
    if version:
        write = version.workspace
    elif options.out:
        write = Workspace(spark, options.out.rstrip("/"))
    else:
        write = writer(None, options.out_jdbc, "SALESMART_TARGET")
    write_audits = writer(options.audits_out, False, "")
    by_key = options.ids == "key"
    if options.command == "star":
        rows = run_star(
            staging, workspace, write, write_reports, write_audits, options.ordered, by_key)
    else:
        rows = run_snowflake(staging, workspace, write, write_audits, options.strict, by_key)
    if version:
        tables = STAR_TABLES if options.command == "star" else SNOWFLAKE_TABLES
        version.publish({name: rows[name] for name in tables})
    return rows


if __name__ == "__main__":
    main()
