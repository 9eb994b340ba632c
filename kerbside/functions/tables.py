"""Table functions for SQL: rows of a table, taken key by key in order."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


@udtf
class SampledFrames:
    """Every ``step``-th frame of each recording in order, with its place among those taken and the time since the one before.

    ``sampled_frames(TABLE(t), step)``: the table has ``recording``, ``frame_idx`` and ``ts``. The function asks for its partitions and order itself, so a
    query that states none is right as well. A recording's rows come one at a time, so its length does not matter.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, step: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable or not {"recording", "frame_idx", "ts"} <= set(table.dataType.names):
            raise ValueError("sampled_frames takes a table with recording, frame_idx and ts")
        if not step.isConstantExpression or not isinstance(step.value, int) or step.value < 1:
            raise ValueError("sampled_frames takes a step of 1 or more")
        out = T.StructType([
            T.StructField("recording", table.dataType["recording"].dataType), T.StructField("frame_idx", T.LongType()), T.StructField("place", T.LongType()), T.StructField("since", T.DoubleType()),
        ])
        return AnalyzeResult(schema=out, partitionBy=[PartitioningColumn("recording")], orderBy=[OrderingColumn("frame_idx")])

    def __init__(self) -> None:
        self.seen, self.place, self.last = 0, 0, None

    def eval(self, row: Row, step: int) -> Iterator[tuple]:
        if self.seen % step == 0:
            since = None if self.last is None else row["ts"] - self.last
            yield row["recording"], row["frame_idx"], self.place, since
            self.place, self.last = self.place + 1, row["ts"]
        self.seen += 1


def register(spark: SparkSession) -> None:
    """Make the functions of this module known to SQL."""
    spark.udtf.register("sampled_frames", SampledFrames)
