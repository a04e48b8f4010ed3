"""Streams: each file once, bad rows aside, state kept between runs."""

import random

import pytest

from tableloom.operators import first_question
from tableloom.session import scratch_path
from tableloom.streaming import (
    arrived,
    current_state,
    ingest_new_files,
    run_state,
    split_batch,
    stream_csv,
)


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


class Drop:
    """A folder that files arrive in, and the tables they go to."""

    def __init__(self, spark, tmp_path, schema):
        self.spark, self.schema = spark, schema
        self.folder = tmp_path / "drop"
        self.folder.mkdir()
        self.table, self.checkpoint = scratch_path(spark, "table"), scratch_path(spark, "checkpoint")

    def run(self):
        stream = stream_csv(self.spark, str(self.folder), self.schema)
        finish(ingest_new_files(stream, self.table, self.checkpoint))
        return sorted(map(tuple, arrived(self.spark, self.table).collect()), key=repr)

    def rejects(self):
        rows = arrived(self.spark, f"{self.table}_rejects").collect()
        return sorted((r.file.rsplit("/", 1)[1], r.line, r.reason, r.record) for r in rows)


def test_new_files_are_taken_once(spark, tmp_path):
    drop = Drop(spark, tmp_path, "a bigint, b string")
    (drop.folder / "one.csv").write_text('a,b\n1,"x\ny"\n2,NA\n')
    assert drop.run() == [(1, "x\ny"), (2, None)]
    assert len(drop.run()) == 2 and drop.rejects() == []
    (drop.folder / "two.csv").write_text("a,b\n3,z\n")
    assert len(drop.run()) == 3


def test_bad_rows_are_kept_aside(spark, tmp_path):
    drop = Drop(spark, tmp_path, "a bigint, b double, `c d` string")
    (drop.folder / "one.csv").write_text(
        'a,b,c d\n1,1.5,x\n\n2,2.5\n"3",NA,"y\nz"\n4,4,4,4\nfive,5,x\n2,2.5\n6,six,"u\nv"\n7,,\n8,8,8,\n'
    )
    (drop.folder / "two.csv").write_bytes(b"a,b,c d\r\n9,9,9\r\n2,2.5\r\n")
    good = [(1, 1.5, "x"), (3, None, "y\nz"), (7, None, None), (9, 9.0, "9")]
    bad = [
        ("one.csv", 4, "too few fields", "2,2.5"),
        ("one.csv", 7, "too many fields", "4,4,4,4"),
        ("one.csv", 8, "a: no bigint", "five,5,x"),
        ("one.csv", 9, "too few fields", "2,2.5"),
        ("one.csv", 10, "b: no double", '6,six,"u\nv"'),
        ("one.csv", 13, "too many fields", "8,8,8,"),
        ("two.csv", 3, "too few fields", "2,2.5"),
    ]
    for _ in range(2):
        assert drop.run() == good
        assert drop.rejects() == bad
    (drop.folder / "three.csv").write_text("a,b,c d\n10,1,x\n")
    assert len(drop.run()) == 5 and drop.rejects() == bad


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    drop = Drop(spark, tmp_path, "a bigint, b string")
    (drop.folder / "one.csv").write_text("a,b\n1,x\n2\n")
    seen = []

    def twice(batch, batch_id):
        for _ in range(2):
            split_batch(batch, batch_id, drop.table, f"{drop.table}_rejects")
        seen.append(batch_id)

    stream = stream_csv(spark, str(drop.folder), drop.schema)
    finish(
        stream.writeStream.foreachBatch(twice)
        .option("checkpointLocation", drop.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    assert seen == [0]
    assert drop.run() == [(1, "x")] and drop.rejects() == [("one.csv", 3, "too few fields", "2")]


SCHEMA = "conv_id bigint, turn bigint, role string, text string"
FAILED = "Error generating response: no"


@pytest.fixture
def send(spark):
    source, checkpoint = scratch_path(spark, "messages"), scratch_path(spark, "checkpoint")

    def arrive(*messages):
        spark.createDataFrame(messages, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        finish(run_state(spark.readStream.schema(SCHEMA).parquet(source), checkpoint))
        return [tuple(r) for r in current_state(spark, checkpoint).orderBy("conv_id").collect()]

    return arrive


def test_conversation_state_across_runs(send):
    assert send((1, 0, "user", "q"), (1, 1, "assistant", FAILED), (2, 0, "user", "q")) == [
        (1, 2, 1, True, False), (2, 1, 0, True, False),
    ]
    assert send((1, 2, "user", "q"), (1, 3, "assistant", "a")) == [
        (1, 4, 3, True, True), (2, 1, 0, True, False),
    ]


def test_a_greeting_answers_nothing(send):
    assert send((1, 0, "assistant", "hello"), (2, 0, "system", "s")) == [
        (1, 1, 0, False, False), (2, 1, 0, False, False),
    ]
    # an answer that overtakes its question counts once the question is there
    assert send((1, 1, "user", "q"), (2, 2, "assistant", "a")) == [
        (1, 2, 1, True, False), (2, 2, 2, False, False),
    ]
    assert send((2, 1, "user", "q")) == [(1, 2, 1, True, False), (2, 3, 2, True, True)]


def test_state_agrees_with_the_log(spark, send):
    """A conversation is answered once a further question would be a follow-up."""
    rnd = random.Random(4)
    messages = []
    for conv in range(30):
        turn = 0
        for _ in range(rnd.randint(0, 3)):
            messages.append((conv, turn, "user", "q"))
            messages.append((conv, turn + 1, "assistant", rnd.choice([FAILED, "a"])))
            turn += 2
        messages.append((conv, turn, "user", "last"))
    kinds = first_question(spark.createDataFrame(messages, SCHEMA)).where("kind = 'follow_up'")
    last = {m[0]: m[1] for m in messages}
    followed = {r.conv_id for r in kinds.collect() if r.turn == last[r.conv_id]}
    rnd.shuffle(messages)
    send(*messages[:40])
    state = send(*messages[40:])
    assert {row[0] for row in state if row[4]} == followed
    assert [(row[0], row[2]) for row in state] == sorted(last.items())
