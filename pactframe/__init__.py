"""Table contracts on Spark: declared columns, keys and checks held as data, and DataFrame
jobs that create, load and validate the tables they describe."""

from .model import Column, Rule, RunOptions, TableContract
from .operators.conform import cast_rejects, conform
from .operators.foreign_keys import fk_orphans, orphan_rows
from .operators.keys import duplicate_key_groups, duplicate_keys, rows_with_duplicate_key
from .operators.rows import check_violations, not_null_violations, null_key_rows, row_count
from .operators.schema_diff import schema_diff, schema_messages, schema_rows
from .plans.constraints import (
    table_outcomes,
    validate_constraints,
    validate_tables,
    violating_rows,
    write_violations,
)
from .plans.incremental import validate_new_files
from .plans.run import RunResult, run, table_lookup
from .plans.schemas import validate_schemas
from .plans.summaries import contract_summary, issue_lines, issue_summary, table_summary
from .sources.contracts import from_tables, read_contracts, to_tables, write_contracts
from .sources.reports import write_issues, write_report
from .sources.tables import TableStore, create_table, load_table, read_table, register_table
from .streaming.load import start_load
