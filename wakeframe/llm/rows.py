"""Columns computed from whole texts, added to the rows that they come from without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from wakeframe.llm.words import BLOCK, Texts, blocks, texts_of

ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}


def annotated(
    docs: DataFrame,
    text_col: str,
    compute: Callable[[Texts, int, int], list[np.ndarray]],
    fields: list[tuple[str, str]],
    block: int = BLOCK,
) -> tuple[DataFrame, list[str]]:
    """``docs`` with one new column per field, and the names these got.

    ``compute`` takes texts and a range of rows and returns an array per field. A
    field whose name ``docs`` has already gets underscores in front.
    """
    names = []
    for name, _ in fields:
        while name in docs.columns or name in names:
            name = f"_{name}"
        names.append(name)
    at = docs.columns.index(text_col)
    every = [*docs.columns, *names]
    kinds = [ARROW[kind] for _, kind in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(at))
            for first, last in blocks(texts, block):
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *map(pa.array, compute(texts, first, last), kinds)], names=every
                )

    added = ", ".join(f"`{name}` {kind}" for name, (_, kind) in zip(names, fields, strict=True))
    schema = StructType([*docs.schema.fields, *docs.sparkSession.createDataFrame([], added).schema.fields])
    return docs.mapInArrow(run, schema), names
