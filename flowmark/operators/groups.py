"""Sequential work on sorted groups in Arrow batches, without one Python call per group of a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def _changes(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for k in keys:
        codes = t[k].combine_chunks().dictionary_encode().indices
        c = codes.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def map_groups(df: DataFrame, keys: list[str], order: list, work: Callable[[dict[str, np.ndarray]], dict[str, list] | None], schema: str, hold: int = 100_000) -> DataFrame:
    """work(columns of one group) for every group of df, rows in `order`; its result has the columns of schema.

    Groups must be bounded by their nature (a sensor's day, a link's periods). Many groups share a batch; a batch is held
    until at least `hold` rows are there, the last group of it is carried over.
    """
    from pyspark.sql import functions as F

    names = list(arrow_schema(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        rows = 0

        def flush(final: bool):
            t = pa.Table.from_batches(kept)
            if not t.num_rows:
                return t, None
            starts = _changes(t, keys)
            ends = np.r_[starts[1:], t.num_rows]
            if not final:
                starts, ends = starts[:-1], ends[:-1]
            cols = {c: t[c].to_numpy() for c in t.column_names}
            out: dict[str, list] = {n: [] for n in names}
            for a, b in zip(starts, ends):
                got = work({c: v[a:b] for c, v in cols.items()})
                if got:
                    for n in names:
                        out[n].extend(got[n])
            return t.slice(int(ends[-1]) if len(ends) else 0), out

        def batch(out):
            fields = arrow_schema(schema)
            clean = lambda xs: [None if isinstance(x, float) and x != x else x for x in xs]
            return pa.RecordBatch.from_arrays([pa.array(clean(out[n]), fields[n]) for n in names], names=names)

        for b in batches:
            kept.append(b)
            rows += b.num_rows
            if rows >= hold:
                rest, out = flush(False)
                kept, rows = rest.to_batches(), rest.num_rows
                if out and out[names[0]]:
                    yield batch(out)
        if kept:
            _, out = flush(True)
            if out and out[names[0]]:
                yield batch(out)

    return df.repartition(*(F.col(k) for k in keys)).sortWithinPartitions(*(F.col(k) for k in keys), *order).mapInArrow(run, schema)


_TYPES = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def arrow_schema(ddl: str) -> dict[str, pa.DataType]:
    return {n: _TYPES[t] for n, t in (part.split() for part in ddl.split(","))}
