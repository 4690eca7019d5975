"""Helpers shared by the training-data operators.

Batch operators are ``mapInArrow`` functions over whole documents: a task streams its own rows, keeps
nothing between batches but bounded caches, and passes untouched columns through. A lost executor
costs the re-run of its tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Lower-cases A-Z and turns every ASCII character that is no letter or digit into a space; bytes of
#: other characters stay. ``bytes.split`` then gives the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
_PLAIN = bytes(
    (b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain(text: bytes) -> bytes:
    """Lower-cased, with blanks for all ASCII characters but letters and digits."""
    return text.translate(_PLAIN)


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and characters beyond ASCII."""
    return plain(text).split()


def lower_ascii(text: bytes) -> bytes:
    return text.translate(_LOWER)


def spaced_words(text: bytes) -> list[bytes]:
    """Runs of bytes other than blank, tab, line feed, vertical tab, form feed, carriage return."""
    return text.split()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, whatever the case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def blocks_of(batches: Iterable[pa.RecordBatch], measure: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Regroups rows into blocks of about ``limit`` bytes of the column ``measure``; a longer row is a block."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(measure)), 0).to_numpy(zero_copy_only=False)
        begin = 0
        for row, length in enumerate(lengths.tolist()):
            size += length
            if size >= limit:
                held.append(batch.slice(begin, row + 1 - begin))
                yield joined()
                held, size, begin = [], 0, row + 1
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if held:
        yield joined()


def add_columns(
    df: DataFrame,
    needs: Sequence[str],
    fields: Sequence[StructField],
    make: Callable[[], Callable[[pa.RecordBatch], Sequence]],
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """Appends columns that Python computes block by block; a column of the same name is replaced.

    A block holds rows with about ``block_bytes`` of the first needed column. ``make()`` is called once
    per task and returns the function of a block, which gives one sequence or Arrow array per field.
    Columns of ``df`` pass through untouched.
    """
    new = {field.name.lower() for field in fields}
    # Columns that are needed and replaced travel under a name of their own.
    kept = [c for c in df.columns if c.lower() not in new]
    inputs = {name: fresh(df, f"in_{name}") for name in needs}
    table = df.select(*kept, *[F.col(name).alias(alias) for name, alias in inputs.items()])
    schema = StructType([table.schema[c] for c in kept] + list(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        step = make()
        types = [to_arrow_type(field.dataType) for field in fields]
        for batch in blocks_of(batches, inputs[needs[0]], block_bytes):
            given = pa.RecordBatch.from_arrays([batch.column(a) for a in inputs.values()], names=list(inputs))
            made = [
                value if isinstance(value, pa.Array) else pa.array(value, kind)
                for value, kind in zip(step(given), types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + made, names=[*kept, *[f.name for f in fields]])

    return table.mapInArrow(run, schema)


def merged_runs(starts: np.ndarray, length: np.ndarray | int) -> list[tuple[int, int]]:
    """Maximal ``(start, end)`` runs covered by intervals with these starts and lengths."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    begin = np.asarray(starts, dtype=np.int64)[order]
    end = begin + (np.asarray(length, dtype=np.int64)[order] if np.ndim(length) else length)
    reach = np.maximum.accumulate(end)
    first = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(begin) - 1]])
    return list(zip(begin[first].tolist(), reach[last].tolist()))
