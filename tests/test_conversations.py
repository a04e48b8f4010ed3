"""The conversation log: rules on small logs, blocked plans on the shared log."""

import pytest

from tableloom import create_analyzer
from tableloom import operators as ops
from tableloom.plans.tables import load
from tableloom.session import scratch_path

LOG = "conv_id bigint, turn bigint, role string, text string"


def log_of(spark, *messages, conv=1):
    return spark.createDataFrame([(conv, i, r, t) for i, (r, t) in enumerate(messages)], LOG)


@pytest.fixture
def log(spark):
    return log_of(
        spark,
        ("user", "q1"),
        ("user", "q2"),
        ("assistant", "Error generating response: no"),
        ("user", "q3"),
        ("assistant", "Please upload a data file first."),
        ("user", "q4"),
        ("assistant", "a4"),
        ("system", "reset"),
        ("user", "q5"),
        ("assistant", "a5"),
        ("user", "q6"),
    )


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("conv_id", "turn").collect()]


@pytest.mark.parametrize("block", [2, 65_536])
def test_first_question_means_first_answered(log, block):
    kinds = [r[0] for r in rows(ops.first_question(log, block), "kind")]
    assert kinds == ["chat", "chat", "chat", "chat", "follow_up", "follow_up"]


@pytest.mark.parametrize("block", [2, 65_536])
def test_pairs_and_unanswered(log, block):
    pairs = ops.question_answer_pairs(log, block)
    assert [r[0] for r in rows(pairs, "question")] == ["q2", "q3", "q4", "q5"]
    open_questions = ops.unanswered_questions(log, block)
    assert rows(open_questions, "question", "reason") == [
        ("q1", "no answer"),
        ("q2", "failed answer"),
        ("q3", "failed answer"),
        ("q6", "no answer"),
    ]


@pytest.mark.parametrize("block", [3, 65_536])
def test_previous_question_memory_and_context(log, block):
    previous = ops.previous_question(log, block)
    assert rows(previous, "question", "previous_question") == [
        ("q1", None), ("q2", "q1"), ("q3", "q2"), ("q4", "q3"), ("q5", "q4"), ("q6", "q5"),
    ]
    assert [r[0] for r in rows(ops.memory_last_n(log, 2), "turn")] == [9, 10]
    context = ops.context_per_question(log, 2, with_text=True, block_rows=block)
    assert rows(context, "turn", "context")[-1] == (10, "user: q5\nassistant: a5")
    assert rows(context, "turn", "n_messages")[:2] == [(0, 0), (1, 1)]


@pytest.mark.parametrize("block", [2, 65_536])
def test_token_budget(spark, block):
    log = log_of(spark, ("user", "x" * 40), ("assistant", "x" * 9), ("user", ""), ("user", "x" * 4))
    kept = ops.memory_token_budget(log, 4, block)
    assert rows(kept, "turn", "tokens", "tokens_to_end") == [(1, 3, 4), (2, 0, 1), (3, 1, 1)]


@pytest.mark.parametrize("block", [2, 65_536])
def test_epochs(log, block):
    kept = ops.session_epochs(log, block)
    assert rows(kept, "turn", "epoch") == [(7, 1), (8, 1), (9, 1), (10, 1)]


def test_epochs_without_reset(spark):
    log = log_of(spark, ("user", "q"), ("assistant", "a"))
    assert rows(ops.session_epochs(log), "turn", "epoch") == [(0, 0), (1, 0)]


BLOCKED = [
    ops.history_ordered,
    ops.first_question,
    ops.question_answer_pairs,
    ops.unanswered_questions,
    ops.previous_question,
    ops.memory_token_budget,
    ops.context_per_question,
    ops.session_epochs,
]


@pytest.mark.parametrize("operator", BLOCKED, ids=lambda f: f.__name__)
def test_blocked_plan_gives_the_same_rows(spark, folder, operator):
    log = load(spark, folder, "conversations")
    options = {"budget": 400} if operator is ops.memory_token_budget else {}
    options |= {"n": 3} if operator is ops.context_per_question else {}
    plain, blocked = operator(log, **options), operator(log, block_rows=3, **options)
    assert blocked.columns == plain.columns
    assert rows(blocked, *plain.columns) == rows(plain, *plain.columns)


def test_one_long_conversation(spark):
    turns = spark.range(20_000).selectExpr(
        "1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
        "concat('t', id) AS text",
    )
    log = turns.unionByName(turns.where("turn < 3").selectExpr("2L AS conv_id", "turn", "role", "text"))
    pairs = ops.question_answer_pairs(log, block_rows=512)
    assert pairs.count() == 10_001
    assert pairs.where("int(substr(answer, 2)) != turn + 1").count() == 0
    placed = ops.history_ordered(log, block_rows=512)
    assert placed.where("position != turn + 1").count() == 0


def test_history_by_role(log):
    counts = {r.role: r.n_messages for r in ops.history_by_role(log).collect()}
    assert counts == {"user": 6, "assistant": 4, "system": 1}


def test_append_only_log(spark):
    path = scratch_path(spark, "log")
    schema = "conv_id bigint, turn bigint, role string, type string, content string"
    ops.append_messages(path, spark.createDataFrame([(1, 0, "user", "text", "hi")], schema))
    ops.append_messages(path, spark.createDataFrame([(1, 1, "assistant", "string", "ho")], schema))
    log = spark.read.parquet(path)
    assert rows(log, "turn", "role", "type", "text") == [
        (0, "user", "text", "hi"), (1, "assistant", "string", "ho"),
    ]
    assert ops.next_turns(log).first().next_turn == 2
    by_role = ops.history_by_role(log).orderBy("role").collect()
    assert [(r.role, r.type, r.n_messages, r.mean_length) for r in by_role] == [
        ("assistant", "string", 1, 2.0), ("user", "text", 1, 2.0),
    ]


def test_prompt_and_welcome(spark, sample, customers, log):
    analyzer = create_analyzer(spark)
    analyzer.load_dataframe(sample, "one")
    assert ops.tables_prompt(log, analyzer.catalog).count() == 0
    single = ops.welcome_message(analyzer.catalog).first().message
    assert single == "Tables loaded: 1. Their names: 'one'."
    analyzer.load_dataframe(customers, "two")
    prompt = ops.tables_prompt(log, analyzer.catalog).collect()
    assert len(prompt) == 1
    assert prompt[0].text.startswith("Tables at hand (2): 'one', 'two'. Draw on ")
    welcome = ops.welcome_message(analyzer.catalog).first().message
    assert welcome.endswith("\n- 'one': 5 rows, 3 columns\n- 'two': 3 rows, 4 columns")
    assert ops.welcome_message(analyzer.catalog, log).count() == 0
    assert ops.welcome_message(analyzer.catalog, log.limit(0)).count() == 1
