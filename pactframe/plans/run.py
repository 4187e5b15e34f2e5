"""Create and validate sets of contracted tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import cache

from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    ParseException,
    SparkRuntimeException,
)
from pyspark.sql import DataFrame, Row, SparkSession

from ..model import RunOptions, TableContract
from ..functions.conditions import first_line
from ..operators.findings import (
    CHECK,
    ERROR,
    REPORT_SCHEMA,
    ROW_COUNT,
    ROWS_FOUND,
    SCHEMA,
    SKIPPED,
    Finding,
    RuleBook,
)
from ..operators.foreign_keys import TableLookup
from ..operators.matching import BROADCAST_BYTES
from ..operators.rows import count_failures
from ..operators.schema_diff import schema_messages
from ..sources.contracts import to_tables
from ..sources.reports import write_issues, write_report
from ..sources.tables import (
    SchemaMismatch,
    TableStore,
    create_table,
    ensure_namespace,
    find_table,
    write_contract_properties,
)
from .constraints import (
    BYTES_PER_JOB,
    UNMEASURED,
    Sizes,
    TablePlan,
    count_key_set,
    count_orphans,
    measure,
    packed,
    plan_table,
    report_of,
    table_outcomes,
)
from .issues import IssueLog, mismatch_issues, violation_issues
from .schemas import actual_rows, declared_rows
from .summaries import table_summary

# Errors that the text of a rule causes; any other is the table's or the cluster's.
RULE_FAULTS = (
    AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException,
    IllegalArgumentException, NumberFormatException, ParseException, SparkRuntimeException,
)
SECTIONS = ("parse", "create", "validate", "all")


class ContractViolation(ValueError):
    """The rows of a table break its rules."""


@dataclass
class RunResult:
    """`summary` describes the contracts, `created` says what became of each table, `report`
    has a row per tested rule, `outcomes` one per validated table."""

    summary: DataFrame
    issues: DataFrame
    created: dict[str, str] = field(default_factory=dict)
    report: DataFrame | None = None
    outcomes: DataFrame | None = None


def table_lookup(spark: SparkSession, store: TableStore) -> TableLookup:
    """Finds stored tables by name, looking at storage once per table."""
    return cache(lambda name: find_table(spark, store, name))


def run(
    spark: SparkSession,
    section: str,
    contracts: Sequence[TableContract],
    store: TableStore,
    options: RunOptions | None = None,
) -> RunResult:
    """Run one section: `parse` only summarises the contracts, `create` makes or registers
    the tables, `validate` tests them, `all` does both. The issue log and the report are
    written even when a table fails."""
    section = section.strip().lower()
    if section not in SECTIONS:
        raise ValueError(f"no section {section!r}; there are {', '.join(SECTIONS)}")
    options = options or RunOptions()
    log = IssueLog(spark, contracts, store)
    for contract in contracts:
        log.unknown_types(contract)
    result = RunResult(table_summary(to_tables(spark, contracts)), log.to_df())
    if section == "parse":
        return result
    drifted: set[str] = set()
    try:
        if section in ("create", "all"):
            store, result.created = create_tables(spark, contracts, store, options, log, drifted)
        if section in ("validate", "all"):
            result.report = validate_stored_tables(spark, contracts, store, options, log, drifted)
            result.outcomes = table_outcomes(result.report, drifted)
    finally:
        result.issues = log.to_df()
        if options.issues_path and log.rows:
            write_issues(result.issues, options.issues_path, store.provider)
        if options.report_path:
            write_report(result.issues, options.report_path)
    return result


def _guarded(
    contract: TableContract, operation: str, options: RunOptions, log: IssueLog,
    action: Callable[[], object],
) -> object | None:
    """The action's result; its failure is logged and, if the run may go on, swallowed."""
    try:
        return action()
    except Exception as error:
        log.error(contract, operation, error)
        if not options.continue_on_error:
            raise
        return None


def _log_drift(
    spark: SparkSession, contracts: Sequence[TableContract], tables: dict[str, DataFrame],
    store: TableStore, options: RunOptions, log: IssueLog, drifted: set[str],
) -> None:
    """Compare all given tables with their contracts in one job and log each that differs,
    once per run."""
    fresh = {name: df for name, df in tables.items() if name not in drifted}
    if not fresh:
        return
    check_nullability = options.check_nullability
    if check_nullability is None:
        check_nullability = store.keeps_nullability
    messages = schema_messages(
        declared_rows(spark, contracts), actual_rows(spark, fresh),
        check_nullability, options.type_equivalence,
    )
    before = len(log.rows)
    log.collected(mismatch_issues(messages, log.facts))
    found = log.rows[before:]
    drifted.update(row.target_table for row in found)
    if found and options.fail_on_mismatch and not options.continue_on_error:
        texts = [f"{row.target_table} schema mismatch: {'; '.join(row.issues)}" for row in found]
        raise SchemaMismatch("; ".join(texts))


def create_tables(
    spark: SparkSession, contracts: Sequence[TableContract], store: TableStore,
    options: RunOptions, log: IssueLog, drifted: set[str],
) -> tuple[TableStore, dict[str, str]]:
    """Create or register every table. A table that was there is compared with its contract;
    its properties are left alone if it differs and mismatches count as failures."""
    try:
        store = ensure_namespace(spark, store)
    except Exception as error:  # it may be there although it cannot be made
        log.namespace_error(error)
        if not options.continue_on_error:
            raise
    mode = "replace" if options.replace_existing else "register"

    def create(contract: TableContract) -> str | None:
        return _guarded(
            contract, "create", options, log,
            lambda: create_table(spark, store, contract, mode, options.allow_data_loss),
        )

    # Listings, empty writes and catalogue calls: the cluster idles, so several run at a time.
    with ThreadPoolExecutor(options.jobs_at_once) as pool:
        states = list(pool.map(create, contracts))
    created = {c.target_name: state for c, state in zip(contracts, states) if state}
    there = {
        name: find_table(spark, store, name)
        for name, state in created.items()
        if state == "registered"
    }
    _log_drift(spark, contracts, there, store, options, log, drifted)
    if options.write_properties:
        for contract in contracts:
            unfit = options.fail_on_mismatch and contract.target_name in drifted
            if contract.target_name in created and not unfit:
                try:
                    write_contract_properties(spark, store, contract)
                except Exception as error:  # the table itself is sound
                    log.error(contract, "properties", error)
    return store, created


def validate_stored_tables(
    spark: SparkSession, contracts: Sequence[TableContract], store: TableStore,
    options: RunOptions, log: IssueLog, drifted: set[str],
) -> DataFrame:
    """Compare every stored table with its contract and count the violations of its rules.

    A table whose schema differs still has the rules tested whose columns it has.
    """
    lookup = table_lookup(spark, store)

    def present(contract: TableContract) -> DataFrame:
        table = lookup(contract.target_name)
        if table is None:
            raise LookupError(f"table {contract.target_name} was not found")
        return table

    tables = {}
    for contract in contracts:
        table = _guarded(contract, "validate", options, log, lambda: present(contract))
        if table is not None:
            tables[contract.target_name] = table
    if options.validate_schema:
        _log_drift(spark, contracts, tables, store, options, log, drifted)
    book = RuleBook()
    for contract in contracts:
        name = contract.target_name
        if name not in tables:
            book.untested(name, ROW_COUNT, ROW_COUNT, ERROR, "the table is missing or unreadable")
        elif name in drifted:
            book.untested(name, SCHEMA, SCHEMA, SKIPPED, "the schema differs from the contract")
    if not options.validate_constraints:
        return book.report(spark, [])

    by_name = {contract.target_name: contract for contract in contracts}
    plans = []
    for contract in contracts:
        if contract.target_name not in tables:
            continue
        where = options.where.get(contract.target_name)
        plan = _guarded(
            contract, "validate", options, log,
            lambda: plan_table(contract, lookup, by_name, store.overrides, where),
        )
        if plan:
            plans.append(plan)
            for skipped in plan.skipped:
                log.skipped(contract, skipped)
        else:
            book.untested(
                contract.target_name, ROW_COUNT, ROW_COUNT, ERROR, "the rules could not be planned"
            )
    rows = evaluate(plans, lookup, options, log) + book.report(spark, []).collect()
    reported = spark.createDataFrame(rows, REPORT_SCHEMA)
    before = len(log.rows)
    log.collected(violation_issues(reported, log.facts))
    broken = log.rows[before:]
    if broken and not options.continue_on_error:
        raise ContractViolation("; ".join(row.error_message for row in broken))
    return reported


def evaluate(
    plans: Sequence[TablePlan], lookup: TableLookup, options: RunOptions, log: IssueLog
) -> list[Row]:
    """Report rows of all planned tables: a few tables per job, a few jobs at a time. What
    comes back is one row per rule. A job that fails is repeated table by table, so that only the
    table at fault, or its faulty check, is lost."""
    by_name = {plan.contract.target_name: plan.contract for plan in plans}

    def unmeasured(table: str, error: Exception) -> None:
        if table in by_name:
            log.error(by_name[table], "measure", error)

    sizes = measure(plans, lookup, unmeasured)
    budget = BROADCAST_BYTES // options.jobs_at_once  # for all jobs under way together

    def evaluate_some(some: Sequence[TablePlan]) -> list[Row]:
        try:
            return report_of(some, lookup, sizes, budget).collect()
        except Exception as error:
            if len(some) == 1:
                return _evaluate_parts(some[0], lookup, sizes, options, log, error)
            return [row for plan in some for row in evaluate_some([plan])]

    jobs = packed(plans, options.scans_per_job, BYTES_PER_JOB, options.tables_per_job)
    with ThreadPoolExecutor(options.jobs_at_once) as pool:
        return [row for rows in pool.map(evaluate_some, jobs) for row in rows]


def _evaluate_parts(
    plan: TablePlan, lookup: TableLookup, sizes: Sizes, options: RunOptions, log: IssueLog,
    error: Exception,
) -> list[Row]:
    """Report rows of a table whose job failed with `error`.

    Keys and foreign keys that Spark cannot plan are found by analysis alone. The rest but the
    checks is counted in one more job if a rule can be at fault, and each check in one of its own. A rule
    that fails again has status `error`. Any other error is the table's: all its rules have that status.
    """
    table, data = plan.contract.target_name, plan.data
    spark, rows, faults = data.sparkSession, [], []

    def plannable(findings: Sequence[Finding], count: Callable[[], DataFrame]) -> bool:
        try:
            count().schema
        except Exception as fault:
            faults.extend((finding, fault) for finding in findings)
            return False
        return True

    checks = [test for test in plan.row_tests if test.finding.kind == CHECK]
    rest = replace(
        plan,
        row_tests=[test for test in plan.row_tests if test not in checks],
        key_sets=[
            keys for keys in plan.key_sets
            if plannable(keys.findings, lambda: count_key_set(plan, keys, UNMEASURED, RuleBook()))
        ],
        foreign_keys=[
            key for key in plan.foreign_keys
            if plannable([key.finding], lambda: count_orphans(plan, key, lookup, UNMEASURED, RuleBook()))
        ],
    )
    isolated = isinstance(error, RULE_FAULTS) and bool(checks or faults)
    if isolated:
        try:
            rows += report_of([rest], lookup, sizes).collect()
        except Exception as again:
            isolated, error = False, again
    if not isolated:
        log.error(plan.contract, "validate", error)
        if not options.continue_on_error:
            raise error
        faults = [(finding, error) for finding in (ROWS_FOUND, *planned_findings(plan))]
        checks = []
    for test in checks:
        book = RuleBook()
        try:
            rows += book.report(spark, [count_failures(data, table, [test], book)]).collect()
        except Exception as fault:
            faults.append((test.finding, fault))
    book = RuleBook()
    for finding, fault in faults:
        if isolated:
            log.rule_error(plan.contract, finding.kind, finding.label, fault)
            if not options.continue_on_error:
                raise fault
        book.untested(table, finding.kind, finding.label, ERROR, first_line(fault))
    return rows + book.report(spark, []).collect()


def planned_findings(plan: TablePlan) -> list[Finding]:
    return [
        *(test.finding for test in plan.row_tests),
        *(finding for keys in plan.key_sets for finding in keys.findings),
        *(key.finding for key in plan.foreign_keys),
    ]
