"""Small tables that are looked up along arrays inside rows, a batch of rows at a time."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Entries of a table that tasks may hold, 12 to 16 bytes each.
HELD = 1 << 23


@dataclass
class Lookup:
    """Values by whole-number codes of their keys: ``codes`` in order, ``values`` along them.

    A key of several columns is one number. Of a whole-number column the code is its distance from the
    smallest value in the table; other columns are numbered. 0 stands for NULL.
    """

    lows: list[int | None]
    listed: list[pa.Array | None]
    sizes: list[int]
    codes: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, names: Sequence[str], value: str) -> Lookup | None:
        """None where the ranges of the columns are too wide for one number."""
        lows, listed, sizes = [], [], []
        for name in names:
            column = table.column(name).combine_chunks()
            if pa.types.is_integer(column.type):
                low, high = (pc.min_max(column)[k].as_py() for k in ("min", "max"))
                lows.append(0 if low is None else low)
                listed.append(None)
                sizes.append(1 if low is None else high - low + 2)
            else:
                distinct = pc.unique(column.drop_null().cast(pa.string()))
                lows.append(None)
                listed.append(distinct)
                sizes.append(len(distinct) + 1)
        if np.prod([float(s) for s in sizes]) >= 2**62:
            return None
        found = cls(lows, listed, sizes, np.empty(0, np.int64), np.empty(0))
        codes = found.code([table.column(n).combine_chunks() for n in names])
        order = np.argsort(codes, kind="stable")
        values = table.column(value).to_numpy()
        found.codes, found.values = codes[order], values[order]
        return found

    def code(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """The number of each entry; -1 where a value is beyond the table."""
        total = np.zeros(len(columns[0]), np.int64) if columns else np.zeros(0, np.int64)
        beyond = np.zeros(len(total), bool)
        for low, listed, size, column in zip(self.lows, self.listed, self.sizes, columns, strict=True):
            if isinstance(column, pa.DictionaryArray):
                # Few values along many entries: each is numbered once. NULL comes last.
                known = Lookup([low], [listed], [size], self.codes, self.values).code([pa.concat_arrays([column.dictionary, pa.nulls(1, column.dictionary.type)])])
                part = known[pc.fill_null(column.indices, len(known) - 1).to_numpy(zero_copy_only=False)]
                beyond |= part < 0
                total = total * size + part
                continue
            if listed is None and not column.null_count:
                part = column.to_numpy(zero_copy_only=False).astype(np.int64)
                part -= low - 1
                beyond |= (part < 1) | (part >= size)
                total *= size
                total += part
                continue
            missing = column.is_null().to_numpy(zero_copy_only=False)
            if listed is None:
                part = column.cast(pa.int64()).fill_null(low).to_numpy(zero_copy_only=False) - low + 1
            else:
                at = pc.index_in(column.cast(pa.string()), value_set=listed).fill_null(-1)
                part = at.cast(pa.int64()).to_numpy(zero_copy_only=False) + 1
                beyond |= (part == 0) & ~missing
            part = np.where(missing, 0, part)
            beyond |= (part < 0) | (part >= size)
            total = total * size + part
        return np.where(beyond, -1, total)

    def find(self, columns: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
        """Values along the columns, and whether the table has them."""
        wanted = self.code(columns)
        if not len(self.codes):
            return np.zeros(len(wanted), self.values.dtype), np.zeros(len(wanted), bool)
        places = self.codes[-1] + 1
        if places <= 4 * len(self.codes) + 1024:
            # Most places are taken: an array by place answers without a search.
            dense = np.zeros(places, self.values.dtype)
            taken = np.zeros(places, bool)
            dense[self.codes], taken[self.codes] = self.values, True
            inside = (wanted >= 0) & (wanted < places)
            at = np.where(inside, wanted, 0)
            return dense[at], taken[at] & inside
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return self.values[at], self.codes[at] == wanted


def replaced_along(
    rows: DataFrame, array: str, values: Mapping[str, Column | str], combine: Callable[[pa.Array, dict[str, pa.Array]], pa.Array]
) -> DataFrame:
    """``rows`` with the whole numbers of ``array`` replaced by ``combine`` of them and of ``values``, which run along it.

    A value given by name is a column of ``rows`` and is not sent twice; one that is no array is the same along its row.
    ``combine`` sees the entries of a whole batch of rows as one array. A NULL row stays NULL; where a value's
    array is shorter than ``array`` the rest of it is NULL. The rows go through Arrow as they are.
    """
    # Executors need not have this package: what the tasks run travels with the query.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    names = list(values)
    kept = [f"c{i}" for i in range(len(rows.columns))]
    added = [f"c{rows.columns.index(v)}" if isinstance(v, str) else f"v{i}" for i, v in enumerate(values.values())]
    target = rows.columns.index(array)
    given = rows.select(
        *[F.col(c).alias(k) for c, k in zip(rows.columns, kept, strict=True)],
        *[values[n].alias(a) for n, a in zip(names, added, strict=True) if not isinstance(values[n], str)],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(target)
            lengths = pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False)
            parts = {n: _fitted(batch.column(a), lengths) for n, a in zip(names, added, strict=True)}
            new = combine(own.flatten(), parts)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            column = pa.ListArray.from_arrays(offsets, new, mask=own.is_null() if own.null_count else None)
            yield pa.RecordBatch.from_arrays([column if i == target else batch.column(k) for i, k in enumerate(kept)], names=kept)

    schema = T.StructType(
        [
            T.StructField(k, T.ArrayType(T.IntegerType()) if i == target else f.dataType)
            for i, (k, f) in enumerate(zip(kept, rows.schema.fields, strict=True))
        ]
    )
    return given.mapInArrow(run, schema).toDF(*rows.columns)


def _fitted(column: pa.Array, lengths: np.ndarray) -> pa.Array:
    """The flat entries of lists, cut or filled up with NULL to the given lengths; of plain values each as often as its length."""
    if not (pa.types.is_list(column.type) or pa.types.is_large_list(column.type)):
        column = column.dictionary_encode()
        indices = pc.fill_null(column.indices, len(column.dictionary)).to_numpy(zero_copy_only=False)
        repeated = np.repeat(indices, lengths)
        return pa.DictionaryArray.from_arrays(pa.array(repeated, mask=repeated == len(column.dictionary)), column.dictionary)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    if np.array_equal(sizes, lengths):
        return flat
    starts = np.cumsum(sizes) - sizes
    offset = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.repeat(starts, lengths) + offset
    return flat.take(pa.array(at, pa.int64(), mask=offset >= np.repeat(sizes, lengths)))
