"""What the operators of this subpackage share: whole texts, Arrow batches, settled tables.

Operators settle what they read more than once in the shared folder (see ``sluiceway.runtime``), which
cuts lineage and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.runtime import settle  # noqa: F401  for the operators


def whole_text(name: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def map_batches(
    df: DataFrame, change: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply ``change`` to every Arrow batch of ``df``; None stands for no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (made := change(batch)) is not None and made.num_rows:
                yield made

    return df.mapInArrow(run, schema)


def per_worker(name: str, make: Callable[[], object]):
    """One object per Python worker process and name, whichever tasks it runs.

    Functions that travel by value get their globals anew with every task; what is dear to build and
    doesn't depend on the rows is kept here instead.
    """
    import sys
    import types

    kept = sys.modules.setdefault("_kept_per_worker", types.ModuleType("_kept_per_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def by_value(module: str) -> None:
    """Let functions of ``module`` travel with their UDFs, so executors need not have the package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)
