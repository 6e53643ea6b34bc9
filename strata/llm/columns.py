"""Columns computed from one string column by an Arrow function."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.llm import text as tx


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of whole rows of about tx.CHUNK bytes of a string column;
    other columns and empty ones are one run."""
    if not len(column) or not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        yield 0, len(column)
        return
    for lo, hi, _, _ in tx.chunks(column):
        yield lo, hi - lo


def text_column(text: Column, ddl: str, make: Callable[[], Callable[[pa.Array], pa.Array]]) -> Column:
    """A column of type ``ddl``: ``make()`` runs once per task, its result once per slice of an Arrow batch.

    Only the text goes through Python; the row's other columns stay in the JVM. Each slice's result
    goes back at once, so a worker holds those of about tx.CHUNK bytes of text (or of one row),
    however many rows Spark puts into a batch.
    Marked nondeterministic so that Spark neither repeats it nor moves filters through it.
    """

    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for a in it:
            for lo, n in slices(a):
                yield work(a.slice(lo, n))

    return F.arrow_udf(run, ddl).asNondeterministic()(text)


def rows_to_struct(kind: pa.StructType, columns: dict) -> pa.Array:
    """A struct array from one list (or array) per field."""
    return pa.StructArray.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in kind],
        fields=list(kind))
