"""Order-dependent folds: a state per group, rows in order, memory for one Arrow batch.

``ordered_fold`` deals rows by group, sorts them within the partition (Spark spills the sort), and streams
them through a step function; a group is never gathered. The same step functions drive the streaming
form, ``stateful_stream``, where the state lives in Spark's state store between micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..shipping import ship

Step = Callable[[Any, dict], tuple[Any, list[dict]]]


def ordered_fold(df: DataFrame, group: str, order: list[str], start: Callable[[], Any], step: Step, schema: str, finish: Callable[[Any, Any], list[dict]] | None = None) -> DataFrame:
    """Rows that ``step(state, row)`` gives, in order, for each group; ``finish(group, state)`` ends one."""
    spark = df.sparkSession
    ship(spark)
    target = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(n, group).sortWithinPartitions(group, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current, begun = None, None, False
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                if not begun or row[group] != current:
                    if begun and finish:
                        out += finish(current, state)
                    state, current, begun = start(), row[group], True
                state, made = step(state, row)
                out += made
            yield pa.RecordBatch.from_pylist(out, arrow)
        if begun and finish:
            yield pa.RecordBatch.from_pylist(finish(current, state), arrow)

    return dealt.mapInArrow(run, target)


class _Folder(StatefulProcessor):
    def __init__(self, start, step, order, fields, encode, decode, kind) -> None:
        self.start, self.step, self.order, self.fields = start, step, order, fields
        self.encode, self.decode, self.kind = encode, decode, kind

    def init(self, handle) -> None:
        self.state = handle.getValueState("state", self.kind)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.decode(self.state.get()) if self.state.exists() else self.start()
        frame = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        out: list[dict] = []
        for row in frame.to_dict("records"):
            state, made = self.step(state, row)
            out += made
        self.state.update(self.encode(state))
        yield pd.DataFrame(out, columns=self.fields)

    def close(self) -> None:
        pass


def stateful_stream(df: DataFrame, group: str, order: list[str], start, step: Step, schema: str, state_schema: str, encode, decode) -> DataFrame:
    """The fold over a streaming frame; rows of a micro-batch are taken in order, micro-batches as they come.

    ``encode`` makes the state a tuple of ``state_schema``, ``decode`` brings it back."""
    spark = df.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    fields = T._parse_datatype_string(schema).fieldNames()
    folder = _Folder(start, step, order, fields, encode, decode, state_schema)
    return df.groupBy(group).transformWithStateInPandas(folder, schema, "Append", "None")
