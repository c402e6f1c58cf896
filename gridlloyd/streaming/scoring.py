"""Scoring and cell statistics on streaming frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..operators.cells import UNIT_BOUNDS, cell_stats
from ..operators.lloyd import assign


def score_stream(stream: DataFrame, features, centers, prediction: str = "prediction") -> DataFrame:
    """Label every row of a stream; stateless, valid in any output mode."""
    return assign(stream, features, centers, prediction)


def cell_stream(stream: DataFrame, features, depth: int, bounds=UNIT_BOUNDS) -> DataFrame:
    """Running cell statistics of a stream (``update`` or ``complete`` mode). State grows with the
    number of non-empty cells, not with the rows."""
    return cell_stats(stream, features, depth, bounds)


def write_cells(cells: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Writer handing every refreshed cell table to ``sink``."""
    return cells.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(sink)
