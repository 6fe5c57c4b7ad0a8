"""Arrow helpers inside tasks: slices of bounded text, tokens as codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a single longer text is taken alone.
SLICE = 2_000_000


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE) -> Iterator[pa.Table]:
    """The rows in order, in tables of about `limit` bytes of `column`, as large strings or binaries."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        texts = table.column(column).combine_chunks()
        wide = pa.large_binary() if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else pa.large_string()
        texts = pc.fill_null(texts.cast(wide), b"" if wide == pa.large_binary() else "")
        table = table.set_column(table.schema.get_field_index(column), column, texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < table.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield table.slice(start, stop - start)
            start = stop


def one(column: pa.ChunkedArray) -> pa.Array:
    whole = column.combine_chunks()
    return pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case words (ASCII case and white space) of all texts in order, and the number in each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    values, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(pc.binary_length(values), 0)
    values, owner = values.filter(full), owner.filter(full).to_numpy(zero_copy_only=False)
    return values, np.bincount(owner, minlength=len(texts)).astype(np.int64)


def coded(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values, and the number of its value for each row."""
    encoded = pc.dictionary_encode(values)
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def places(distinct: pa.Array, known: pa.Array) -> np.ndarray:
    """The place in `known` of each value, -1 where it isn't there."""
    return pc.fill_null(pc.index_in(distinct, value_set=known.cast(distinct.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)


class Tally:
    """Counts by value, folded from time to time; `fold` bounds the values held at once."""

    def __init__(self, fold: int = 400_000):
        self.parts, self.held, self.fold = [], 0, fold

    def add(self, values: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(pa.table({"value": values, "n": pa.array(counts.astype(np.int64))}))
        self.held += len(values)
        if self.held > self.fold:
            merged = pa.concat_tables(self.parts).group_by("value").aggregate([("n", "sum")])
            self.parts, self.held = [pa.table({"value": merged["value"], "n": merged["n_sum"]})], merged.num_rows
            if self.held > self.fold // 2:
                yield from self.take()

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            merged = pa.concat_tables(self.parts).group_by("value").aggregate([("n", "sum")])
            kind = pa.string() if pa.types.is_large_string(merged["value"].type) else merged["value"].type
            self.parts, self.held = [], 0
            for begin in range(0, merged.num_rows, 100_000):
                part = merged.slice(begin, 100_000)
                yield from pa.table({"value": part["value"].cast(kind), "n": part["n_sum"]}).combine_chunks().to_batches()


def listed(owner: np.ndarray, rows: int, fields: dict[str, pa.Array]) -> pa.Array:
    """For each of `rows`, the list of structs of those it owns; owner is in rising order."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(list(fields.values()), list(fields)))
