"""Whole groups handed to a helper many at a time, from a stream of sorted rows: a call for each batch, not for each group."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

_NUMBER = "_number"

#: Columns of a batch by name (arrays of arrays as Arrow has them), and its groups as (first row, row behind the last).
Columns = dict[str, np.ndarray | pa.ChunkedArray]
Groups = list[tuple[int, int]]
#: Gives the row of the batch that each row of the result is for, and the result's new columns.
Solve = Callable[[Columns, Groups], tuple[np.ndarray, dict[str, list | np.ndarray]]]


def whole_groups(batches: Iterable[pa.RecordBatch], number: str) -> Iterator[tuple[pa.Table, Groups]]:
    """Tables of whole groups from batches in which groups lie one behind the other and column ``number`` counts each group's rows from 1.

    A group that a batch leaves open waits for the next ones.
    """
    held: list[pa.Table] = []
    for batch in batches:
        part = pa.Table.from_batches([batch])
        starts = np.flatnonzero(part[number].to_numpy() == 1)
        last = int(starts[-1]) if len(starts) else 0
        if len(starts) and (held or last):
            done = pa.concat_tables([*held, part.slice(0, last)])
            held = []
            at = [*np.flatnonzero(done[number].to_numpy() == 1).tolist(), len(done)]
            yield done, list(zip(at[:-1], at[1:], strict=True))
        held.append(part.slice(last))
    if held and sum(map(len, held)):
        rest = pa.concat_tables(held)
        yield rest, [(0, len(rest))]


def solve_groups(df: DataFrame, keys: list[str], order: list[str], carried: list[str], made: dict[str, T.DataType], solve: Solve) -> DataFrame:
    """Columns: ``carried`` (of the row that a result is for) and ``made``, from the groups of equal ``keys``.

    Each group comes in ``order``, whole, so groups should be bounded, as a page is. A window deals and sorts the rows: Spark may take a
    plain repartition out, above a union for one.
    """
    schema = T.StructType([*(df.schema[c] for c in carried), *(T.StructField(k, t) for k, t in made.items())])
    types = {k: {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}[t.simpleString()] for k, t in made.items()}

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, groups in whole_groups(batches, _NUMBER):
            columns = {c: table[c] if pa.types.is_list(table[c].type) else table[c].to_numpy() for c in table.column_names}
            rows, new = solve(columns, groups)
            if len(rows):
                out = table.select(carried).take(pa.array(rows, pa.int64()))
                yield from pa.table({**{c: out[c] for c in carried}, **{k: pa.array(new[k], t) for k, t in types.items()}}).combine_chunks().to_batches()

    return df.withColumn(_NUMBER, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).mapInArrow(work, schema)
