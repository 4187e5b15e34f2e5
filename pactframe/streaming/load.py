"""Load a contracted table from a stream.

Casting and row rules are projections, so a stream takes the same path as a batch load. Keys
and foreign keys are about whole tables and stay with validation of the stored table.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..model import TableContract
from ..operators.conform import CAST, check_set_aside, split_staged, stage
from ..sources.tables import TableStore, check_loadable


def start_load(
    stream: DataFrame,
    contract: TableContract,
    store: TableStore,
    checkpoint_path: str,
    set_aside: Collection[str] = (CAST,),
    set_aside_path: str | None = None,
    fill_defaults: bool = True,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Start the queries that append `stream` to its table and the rows set aside to their
    path. The table must be there and have the contract's schema. Each keeps its progress under `checkpoint_path`, so a restart neither loses nor
    repeats rows."""
    check_set_aside(set_aside, set_aside_path)
    check_loadable(stream.sparkSession, contract, store)
    fitting, rejected = split_staged(stage(stream, contract, fill_defaults), contract, set_aside)
    outputs = {"load": (fitting, store.path(contract.target_name))}
    if set_aside:
        outputs["set_aside"] = (rejected, set_aside_path)
    return [
        rows.writeStream.format(store.provider)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint_path.rstrip('/')}/{name}")
        .option("path", path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        for name, (rows, path) in outputs.items()
    ]
