"""The conversation log: ``(conv_id, turn, role, text)``.

``(conv_id, turn)`` is unique and turns give the order; messages have no time.
One conversation may hold a large share of all messages, so everything that
looks along a conversation goes through :class:`OrderedGroups`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.operators.catalog import Catalog, table_overview
from tableloom.operators.ordered_groups import BLOCK_ROWS, OrderedGroups
from tableloom.session import cut_lineage

# How a failed answer starts.
FAILED_ANSWERS = ("Error generating response", "Please upload a data file first.")
#: Our estimate of the number of characters in a token.
CHARS_PER_TOKEN = 4
MEMORY_MESSAGES = 10
MEMORY_TOKENS = 4_000

_KEY = ["conv_id"]


def _groups(log: DataFrame, block_rows: int) -> OrderedGroups:
    return OrderedGroups.measure(log, _KEY, "turn", block_rows)


def is_failed(text: Column) -> Column:
    """Whether an answer's text reports a failure."""
    failed = F.lit(False)
    for start in FAILED_ANSWERS:
        failed = failed | F.startswith(text, F.lit(start))
    return F.coalesce(failed, F.lit(False))


def append_messages(log_path: str, messages: DataFrame) -> None:
    """Append messages to a log folder; each carries its own turn.

    The log holds ``content`` as ``text``, the form that all readers take.
    """
    text = F.col("content" if "content" in messages.columns else "text").alias("text")
    messages.select("conv_id", "turn", "role", "type", text).write.mode("append").parquet(log_path)


def next_turns(log: DataFrame) -> DataFrame:
    """The turn the next message of each conversation gets."""
    return log.groupBy("conv_id").agg((F.max("turn") + 1).alias("next_turn"))


def history_ordered(log: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Messages with their 1-based position in the conversation.

    The rows of a conversation leave the scan in order; the position keeps the
    order through any later shuffle, so no global sort is added.
    """
    return _groups(log, block_rows).positions(log, "position")


def first_question(log: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``chat`` for questions asked before anything was answered, else ``follow_up``.

    Only a successful answer ends the first stage. The answer's text is needed
    for its first characters only; a flag travels instead of the text.
    """
    groups = _groups(log, block_rows)
    narrow = log.select("conv_id", "turn", "role", is_failed(F.col("text")).alias("failed"))
    answered = groups.with_neighbours(
        narrow,
        {
            "next_role": lambda w: F.lead("role").over(w),
            "next_failed": lambda w: F.lead("failed").over(w),
        },
        after=1,
    ).select(
        "conv_id",
        "turn",
        "role",
        F.coalesce(
            (F.col("role") == "user") & (F.col("next_role") == "assistant") & ~F.col("next_failed"),
            F.lit(False),
        )
        .cast("bigint")
        .alias("answered"),
    )
    if not groups.bounded:
        # Used twice below: for the sums of the blocks and for the rows.
        answered = cut_lineage(answered)
    counted = groups.running_sum(answered, F.col("answered"), "answered_up_to")
    return counted.where(F.col("role") == "user").select(
        "conv_id",
        "turn",
        F.when(F.col("answered_up_to") - F.col("answered") == 0, "chat")
        .otherwise("follow_up")
        .alias("kind"),
    )


def _with_next(log: DataFrame, block_rows: int) -> DataFrame:
    return _groups(log, block_rows).with_neighbours(
        log,
        {
            "next_role": lambda w: F.lead("role").over(w),
            "next_text": lambda w: F.lead("text").over(w),
        },
        after=1,
    )


def question_answer_pairs(log: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each question with the answer that directly follows it."""
    return (
        _with_next(log, block_rows)
        .where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
        .select(
            "conv_id",
            "turn",
            F.col("text").alias("question"),
            F.col("next_text").alias("answer"),
        )
    )


def unanswered_questions(log: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Questions followed by no answer or by a failed one."""
    groups = _groups(log, block_rows)
    flagged = log.select("conv_id", "turn", "role", "text", is_failed(F.col("text")).alias("failed"))
    followed = groups.with_neighbours(
        flagged,
        {
            "next_role": lambda w: F.lead("role").over(w),
            "next_failed": lambda w: F.lead("failed").over(w),
        },
        after=1,
    )
    silent = F.coalesce(F.col("next_role") != "assistant", F.lit(True))
    return followed.where((F.col("role") == "user") & (silent | F.col("next_failed"))).select(
        "conv_id",
        "turn",
        F.col("text").alias("question"),
        F.when(silent, "no answer").otherwise("failed answer").alias("reason"),
    )


def previous_question(log: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each question with the one asked before it in the conversation."""
    questions = log.where(F.col("role") == "user")
    return (
        _groups(questions, block_rows)
        .with_neighbours(
            questions,
            {"previous_question": lambda w: F.lag("text").over(w)},
            before=1,
        )
        .select("conv_id", "turn", F.col("text").alias("question"), "previous_question")
    )


def memory_last_n(log: DataFrame, n: int = MEMORY_MESSAGES) -> DataFrame:
    """The last ``n`` messages of each conversation.

    Every task keeps its own last ``n`` per conversation before the shuffle, so
    a long conversation is not gathered.
    """
    newest_first = Window.partitionBy(*_KEY).orderBy(F.desc("turn"))
    return (
        log.withColumn("_age", F.row_number().over(newest_first))
        .where(F.col("_age") <= n)
        .drop("_age")
    )


def memory_token_budget(
    log: DataFrame, budget: int = MEMORY_TOKENS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The newest messages of each conversation that fit into a token budget."""
    tokens = F.ceil(F.length("text") / CHARS_PER_TOKEN).cast("bigint")
    sized = log.withColumn("tokens", F.coalesce(tokens, F.lit(0)))
    return (
        _groups(log, block_rows)
        .running_sum(sized, F.col("tokens"), "tokens_to_end", descending=True)
        .where(F.col("tokens_to_end") <= budget)
    )


def context_per_question(
    log: DataFrame,
    n: int = MEMORY_MESSAGES,
    with_text: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``n`` messages before each question, oldest first.

    Without ``with_text`` a message is given as ``role:turn``, which keeps the
    texts out of the shuffle; with it, as ``role: text`` on its own line.
    """
    if with_text:
        message = F.concat(F.col("role"), F.lit(": "), F.coalesce("text", F.lit("")))
    else:
        message = F.concat(F.col("role"), F.lit(":"), F.col("turn"))
    narrow = log.select("conv_id", "turn", "role", message.alias("message"))
    separator = "\n" if with_text else ","
    return (
        _groups(log, block_rows)
        .with_neighbours(
            narrow,
            {"before": lambda w: F.collect_list("message").over(w.rowsBetween(-n, -1))},
            before=n,
        )
        .where(F.col("role") == "user")
        .select(
            "conv_id",
            "turn",
            F.size("before").cast("bigint").alias("n_messages"),
            F.array_join("before", separator).alias("context"),
        )
    )


def session_epochs(log: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Messages since the last reset, which is a system message, and its number.

    ``epoch`` counts the resets up to a message; a message is kept if no reset
    comes after it. Both are running counts, so no row has to meet a total of
    its conversation in a join on ``conv_id`` alone.
    """
    groups = _groups(log, block_rows)
    reset = F.when(F.col("role") == "system", 1).otherwise(0).cast("bigint")
    flagged = log.withColumn("_reset", reset)
    counted = groups.running_sum(flagged, F.col("_reset"), "epoch")
    to_end = groups.running_sum(
        counted, F.col("_reset"), "_to_end", descending=True, sums_of=flagged
    )
    return to_end.where(F.col("_to_end") == F.col("_reset")).drop("_reset", "_to_end")


def history_by_role(log: DataFrame) -> DataFrame:
    """Messages per role, and per type where the log has one, with their mean length."""
    keys = ["role"] + [c for c in ("type",) if c in log.columns]
    text = F.col("text") if "text" in log.columns else F.col("content")
    return log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_messages"),
        (F.sum(F.length(text)) / F.count(text)).alias("mean_length"),
    )


def _listed(overview: DataFrame, line: Column) -> Column:
    # One entry per registered table.
    entries = F.array_sort(F.collect_list(F.struct("position", line.alias("line"))))
    return F.transform(entries, lambda e: e["line"])


def tables_prompt(log: DataFrame, catalog: Catalog) -> DataFrame:
    """System message that tells each conversation which tables there are.

    One row per conversation; none if the catalog has fewer than two tables.
    The names keep their insertion order.
    """
    conversations = log.select("conv_id").distinct()
    if len(catalog) < 2:
        conversations = conversations.limit(0)
    names = F.array(*[F.lit(name) for name in catalog.names])
    listed = F.transform(names, lambda name: F.concat(F.lit("'"), name, F.lit("'")))
    return conversations.select(
        "conv_id",
        F.lit("system").alias("role"),
        F.concat(
            F.lit(f"Tables at hand ({len(catalog)}): "),
            F.array_join(listed, ", "),
            F.lit(". Draw on every table that matters and name those you drew on."),
        ).alias("text"),
    )


def welcome_message(catalog: Catalog, log: DataFrame | None = None) -> DataFrame:
    """Greeting with the size of each table; no row if the log has messages already."""
    overview = table_overview(catalog)
    quoted = F.concat(F.lit("'"), F.col("table_name"), F.lit("'"))
    line = F.concat(
        F.lit("\n- "), quoted, F.lit(": "), F.col("n_rows"), F.lit(" rows, "),
        F.col("n_columns"), F.lit(" columns"),
    )
    greeting = overview.agg(
        F.count(F.lit(1)).alias("n_tables"),
        _listed(overview, quoted).alias("names"),
        _listed(overview, line).alias("lines"),
    ).select(
        F.concat(
            F.lit("Tables loaded: "),
            F.col("n_tables"),
            F.lit(". Their names: "),
            F.array_join("names", ", "),
            F.lit("."),
            F.when(
                F.col("n_tables") > 1,
                F.concat(
                    F.lit(" A question may combine them; related rows are joined for you."),
                    F.lit("\n\nSizes:"),
                    F.array_join("lines", ""),
                ),
            ).otherwise(F.lit("")),
        ).alias("message")
    )
    if log is not None and not log.isEmpty():
        return greeting.limit(0)
    return greeting
