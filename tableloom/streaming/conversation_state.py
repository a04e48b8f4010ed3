"""Running state of each conversation, kept up to date as messages arrive.

The state lives in Spark's state store and is read from there: one row per
conversation, however many batches there were.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tableloom.operators.conversations import is_failed

_STATE = "n_messages bigint, last_turn bigint, first_question bigint, last_answer bigint"
_STATE_NAME = "conversation"
_CHANGES = (
    "conv_id bigint, n_messages bigint, last_turn bigint, question_asked boolean, "
    "question_answered boolean"
)
#: Typed state needs this state store.
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _least(a: int | None, b: int | None) -> int | None:
    return min((v for v in (a, b) if v is not None), default=None)


def _most(a: int | None, b: int | None) -> int | None:
    return max((v for v in (a, b) if v is not None), default=None)


class ConversationProcessor(StatefulProcessor):
    """Moves a conversation through silent, asked and answered.

    A conversation is asked once a user message came and answered once a good
    assistant message stands after a user message. The turns decide, not the
    arrival: a greeting before the first question answers nothing, and a message
    that comes late still finds its place.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(_STATE_NAME, _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, last, question, answer = self.state.get() if self.state.exists() else (0, None, None, None)
        for row in rows:
            n += row.n_messages
            last = _most(last, row.last_turn)
            question = _least(question, row.first_question)
            answer = _most(answer, row.last_answer)
        self.state.update((n, last, question, answer))
        answered = question is not None and answer is not None and answer > question
        yield Row(
            conv_id=key[0],
            n_messages=n,
            last_turn=last,
            question_asked=question is not None,
            question_answered=answered,
        )

    def close(self) -> None:
        pass


_COMBINED = {
    "n_messages": "sum",
    "last_turn": "max",
    "first_question": "min",
    "last_answer": "max",
}


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages of one conversation in one batch become a row before they are shuffled."""
    for batch in batches:
        grouped = pa.Table.from_batches([batch]).group_by("conv_id").aggregate(list(_COMBINED.items()))
        made = grouped.select(["conv_id", *[f"{name}_{how}" for name, how in _COMBINED.items()]])
        yield from made.rename_columns(["conv_id", *_COMBINED]).to_batches()


def conversation_state(messages: DataFrame) -> DataFrame:
    """Conversations changed by the messages of a stream, with their new state.

    A failed answer does not count as one. Messages carry no time, so there is no
    watermark and the state keeps one row for every conversation there was.
    """
    turn, role = F.col("turn"), F.col("role")
    good = (role == "assistant") & ~is_failed(F.col("text"))
    facts = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.lit(1).cast("bigint").alias("n_messages"),
        turn.cast("bigint").alias("last_turn"),
        F.when(role == "user", turn).cast("bigint").alias("first_question"),
        F.when(good, turn).cast("bigint").alias("last_answer"),
    )
    return (
        facts.mapInArrow(_combined, f"conv_id bigint, {_STATE}")
        .groupBy("conv_id")
        .transformWithState(ConversationProcessor(), _CHANGES, "Update", "None")
    )


def run_state(messages: DataFrame, checkpoint: str) -> StreamingQuery:
    """Take in all messages that arrived since the last run with this checkpoint."""
    spark = messages.sparkSession
    before = spark.conf.get(_STORE)
    # a query copies the settings of its session when it starts
    spark.conf.set(_STORE, _ROCKS)
    try:
        return (
            conversation_state(messages)
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(_STORE, before)


def current_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per conversation as of the last finished batch, from the state store."""
    stored = (
        spark.read.format("statestore").option("stateVarName", _STATE_NAME).load(checkpoint)
    ).select("key.*", "value.*")
    question, answer = F.col("first_question"), F.col("last_answer")
    return stored.select(
        "conv_id",
        "n_messages",
        "last_turn",
        question.isNotNull().alias("question_asked"),
        F.coalesce(answer > question, F.lit(False)).alias("question_answered"),
    )
