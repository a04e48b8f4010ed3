from tableloom.operators.answers import (
    Answer,
    answer_auto,
    answer_string,
    answer_table,
    chart_bars,
    chart_histogram,
    chart_series,
)
from tableloom.operators.catalog import Catalog, describe_catalog, list_tables, table_overview
from tableloom.operators.conversations import (
    append_messages,
    context_per_question,
    first_question,
    history_by_role,
    history_ordered,
    memory_last_n,
    memory_token_budget,
    next_turns,
    previous_question,
    question_answer_pairs,
    session_epochs,
    tables_prompt,
    unanswered_questions,
    welcome_message,
)
from tableloom.operators.ordered_groups import OrderedGroups
from tableloom.operators.profile import column_info, preview, table_stats
from tableloom.operators.questions import (
    ask_sql,
    case_insensitive_join,
    column_average,
    filtered_count,
    orders_of_customer,
    project_rows,
    rank_by_ratio,
    spend_per_customer,
    tables_used,
)
from tableloom.operators.relationships import (
    FanOutError,
    Relationship,
    auto_join,
    check_relationship,
    suggest_relationships,
)
from tableloom.operators.unique_names import unique_names

__all__ = [
    "Answer",
    "Catalog",
    "FanOutError",
    "OrderedGroups",
    "Relationship",
    "answer_auto",
    "answer_string",
    "answer_table",
    "append_messages",
    "ask_sql",
    "auto_join",
    "case_insensitive_join",
    "chart_bars",
    "chart_histogram",
    "chart_series",
    "check_relationship",
    "column_average",
    "column_info",
    "context_per_question",
    "describe_catalog",
    "filtered_count",
    "first_question",
    "history_by_role",
    "history_ordered",
    "list_tables",
    "memory_last_n",
    "memory_token_budget",
    "next_turns",
    "orders_of_customer",
    "preview",
    "previous_question",
    "project_rows",
    "question_answer_pairs",
    "rank_by_ratio",
    "session_epochs",
    "spend_per_customer",
    "suggest_relationships",
    "table_overview",
    "table_stats",
    "tables_prompt",
    "tables_used",
    "unanswered_questions",
    "unique_names",
    "welcome_message",
]
