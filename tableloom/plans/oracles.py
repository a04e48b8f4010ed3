"""The same questions as ANSI SQL, used to check the Spark results."""

from __future__ import annotations

from tableloom.plans.queries import (
    HISTOGRAM_BINS,
    KNOWN_CUSTOMER,
    LAST_MESSAGES,
    ORDERS_BY_SEGMENT,
    SALT,
    TOKEN_BUDGET,
    stored_hash,
)
from tableloom.plans.tables import DESCRIPTIONS

# Words that mean "missing" in a delimited file (public
# pandas.read_csv documentation), written out so that the check stands by itself.
MISSING_WORDS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
FAILED_STARTS = ["Error generating response", "Please upload a data file first."]
TOKEN_CHARS = 4

# Columns of the shared tables, as stated in TESTDATA.md and FIXTURES.md.
COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
        "l_tax l_returnflag l_linestatus l_shipdate"
    ),
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}

# Columns of the shared tables that share their name (after the table prefix) and type.
SHARED_COLUMNS = {
    "custkey": ("customer.c_custkey", "orders.o_custkey"),
    "orderkey": ("orders.o_orderkey", "lineitem.l_orderkey"),
    "partkey": ("part.p_partkey", "lineitem.l_partkey"),
    "suppkey": ("supplier.s_suppkey", "lineitem.l_suppkey"),
    "nationkey": ("nation.n_nationkey", "customer.c_nationkey", "supplier.s_nationkey"),
    "regionkey": ("region.r_regionkey", "nation.n_regionkey"),
    "name": ("region.r_name", "nation.n_name", "customer.c_name", "supplier.s_name", "part.p_name"),
    "acctbal": ("customer.c_acctbal", "supplier.s_acctbal"),
    "doc_id": ("documents.doc_id", "labels.doc_id"),
    "text": ("documents.text", "benchmark.text", "conversations.text"),
}


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _na(column: str) -> str:
    tokens = ", ".join(_literal(t) for t in MISSING_WORDS)
    return f"CASE WHEN {column} IN ({tokens}) THEN NULL ELSE {column} END AS {column}"


def _failed(column: str) -> str:
    tests = [f"starts_with({column}, {_literal(start)})" for start in FAILED_STARTS]
    return f"coalesce({' OR '.join(tests)}, false)"


def _money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE)"


def _overview() -> str:
    parts = [
        f"SELECT CAST({i} AS BIGINT) AS position, {_literal(name)} AS table_name, "
        f"{_literal(DESCRIPTIONS[name])} AS description, "
        f"(SELECT count(*) FROM {name}) AS n_rows, "
        f"CAST({len(COLUMNS[name].split())} AS BIGINT) AS n_columns, "
        f"{_literal(', '.join(COLUMNS[name].split()))} AS column_names"
        for i, name in enumerate(DESCRIPTIONS)
    ]
    return "overview AS (" + " UNION ALL ".join(parts) + ")"


def _relationship(link: str, child: str, child_key: str, parent: str, parent_key: str) -> str:
    return f"""
    SELECT '{link}' AS link,
      (SELECT count(*) FROM {child} WHERE {child_key} IN (SELECT {parent_key} FROM {parent}))
        AS matched_rows,
      (SELECT count(*) FROM {child} c WHERE {child_key} IS NOT NULL AND NOT EXISTS
        (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{child_key})) AS orphan_rows,
      (SELECT count(*) FROM {child} WHERE {child_key} IS NULL) AS null_rows,
      (SELECT count(DISTINCT {child_key}) FROM {child} c WHERE NOT EXISTS
        (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{child_key})) AS orphan_keys,
      (SELECT count(*) FROM (SELECT {parent_key} FROM {parent} WHERE {parent_key} IS NOT NULL
        GROUP BY 1 HAVING count(*) > 1)) AS duplicate_parent_keys,
      (SELECT count(DISTINCT {parent_key}) FROM {parent} p WHERE NOT EXISTS
        (SELECT 1 FROM {child} c WHERE c.{child_key} = p.{parent_key})) AS unused_parent_keys
    """


def _shared_values() -> str:
    parts = []
    for plain, columns in SHARED_COLUMNS.items():
        for full in columns:
            table, column = full.split(".")
            parts.append(
                f"SELECT '{plain}' AS plain, '{table}' AS tab, '{column}' AS col, "
                f"CAST({column} AS VARCHAR) AS value FROM {table} WHERE {column} IS NOT NULL"
            )
    return " UNION ALL ".join(parts)


def _hmac(column: str) -> str:
    def pad(filler: int) -> str:
        key = SALT.encode().ljust(64, b"\0")
        return "'" + "".join(f"\\x{byte ^ filler:02X}" for byte in key) + "'::BLOB"

    inner = f"sha256({pad(0x36)} || encode({column}))"
    return f"sha256({pad(0x5C)} || unhex({inner}))"


def _stats(column: str) -> str:
    quartiles = ", ".join(
        f"round(quantile_cont({column}, {q}), 6) AS q{int(q * 100)}" for q in (0.25, 0.5, 0.75)
    )
    return (
        f"SELECT '{column}' AS column_name, count({column}) AS count, "
        f"round({_money(column)} / count({column}), 6) AS mean, "
        f"round(stddev_samp({column}), 6) AS std, CAST(min({column}) AS DOUBLE) AS min, {quartiles}, "
        f"CAST(max({column}) AS DOUBLE) AS max FROM lineitem"
    )


_NEXT = f"""
    SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text,
           lead({_failed('text')}) OVER w AS next_failed
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
"""

_NATION_SALES = f"""
    sales AS (
      SELECT lower(n_name) AS sales_nation, {_money('o_totalprice')} AS revenue
      FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
    population AS (
      SELECT upper(n_name) AS nation, count(*) AS customers
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
    joined AS (
      SELECT * FROM sales JOIN population ON lower(sales_nation) = lower(nation))
"""

_TABLE_LIST = ", ".join(f"'{name}'" for name in DESCRIPTIONS)

ORACLES: dict[str, str] = {
    "file_inventory": " UNION ALL ".join(
        f"SELECT '{name}.parquet' AS file_name, '.parquet' AS extension, count(*) AS n_rows "
        f"FROM {name}"
        for name in DESCRIPTIONS
    ),
    "parquet_scan": "SELECT * FROM supplier",
    "csv_scan": (
        f"SELECT doc_id, {_na('text')}, {_na('lang')}, {_na('source')}, n_chars FROM documents"
    ),
    "csv_roundtrip": (
        "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
        "c_mktsegment FROM customer"
    ),
    "infer_types": (
        "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, "
        "p_retailprice FROM part"
    ),
    "na_normalise": (
        "SELECT o_orderkey, "
        "CASE WHEN o_orderkey % 23 < 19 THEN NULL ELSE o_orderpriority END AS o_orderpriority, "
        "CASE WHEN o_orderkey % 28 < 19 THEN NULL ELSE o_orderstatus END AS o_orderstatus "
        "FROM orders"
    ),
    "table_name": (
        "SELECT doc_id, 'Report ' || source || '.' || upper(lang) || '.CSV' AS file_name, "
        "'report_' || lower(source) || '.' || lower(lang) AS table_name FROM documents"
    ),
    "unique_table_names": """
        WITH RECURSIVE files AS (
          SELECT row_number() OVER (ORDER BY doc_id) AS i, doc_id,
                 lower(source || '_' || lang) || CASE WHEN doc_id % 50 = 7 THEN '_v1_v2'
                   WHEN doc_id % 9 = 4 THEN '_v' || (doc_id % 23 + 1) ELSE '' END AS base_name
          FROM documents),
        counted AS (
          SELECT *, count(*) OVER (PARTITION BY base_name) + 60 AS most FROM files),
        named AS (
          SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS doc_id,
                 CAST('' AS VARCHAR) AS base_name, CAST('' AS VARCHAR) AS table_name,
                 CAST([] AS VARCHAR[]) AS used
          UNION ALL
          SELECT i, doc_id, base_name, table_name, list_append(used, table_name) FROM (
            SELECT f.i, f.doc_id, f.base_name, n.used,
                   CASE WHEN NOT list_contains(n.used, f.base_name) THEN f.base_name
                     ELSE f.base_name || '_v' || list_filter(range(1, f.most), lambda number:
                       NOT list_contains(n.used, f.base_name || '_v' || number))[1] END AS table_name
            FROM named n JOIN counted f ON f.i = n.i + 1))
        SELECT doc_id, base_name, table_name FROM named WHERE i > 0
    """,
    "describe_catalog": (
        f"WITH {_overview()} SELECT position, table_name, description, n_rows, n_columns FROM overview"
    ),
    "list_tables": f"WITH {_overview()} SELECT position, table_name, n_rows > 0 AS has_data FROM overview",
    "check_relationship": (
        _relationship("orders-customer", "orders", "o_custkey", "customer", "c_custkey")
        + " UNION ALL "
        + _relationship("documents-labels", "documents", "doc_id", "labels", "doc_id")
    ),
    "suggest_relationships": f"""
        WITH vals AS ({_shared_values()}),
        parents AS (SELECT plain, tab, col FROM vals GROUP BY ALL
                    HAVING count(*) = count(DISTINCT value)),
        dist AS (SELECT DISTINCT plain, tab, col, value FROM vals),
        pairs AS (
          SELECT c.tab AS child_table, c.col AS child_column, p.tab AS parent_table,
                 p.col AS parent_column, count(*) AS child_distinct,
                 count(v.value) AS matched
          FROM dist c JOIN parents p ON c.plain = p.plain AND c.tab <> p.tab
          LEFT JOIN dist v ON v.tab = p.tab AND v.col = p.col AND v.value = c.value
          GROUP BY ALL)
        SELECT *, matched / child_distinct AS containment FROM pairs
        WHERE matched = child_distinct
    """,
    "auto_join": """
        SELECT l_orderkey, l_linenumber, l_extendedprice, p_brand, s_name, o_orderstatus,
               c_name, n.n_name, r_name, sn.n_name AS supplier_nation
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation n ON c_nationkey = n.n_nationkey
        LEFT JOIN region ON n.n_regionkey = r_regionkey
        LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    """,
    "table_overview": (
        f"WITH {_overview()} SELECT position, table_name, n_rows, n_columns, column_names FROM overview"
    ),
    "preview": "SELECT * FROM part ORDER BY p_partkey LIMIT 5",
    "column_info": " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{name}' AS column_name, '{kind}' AS data_type, "
        f"count({name}) AS non_null, count(*) - count({name}) AS nulls FROM customer"
        for i, (name, kind) in enumerate(
            [
                ("c_custkey", "bigint"),
                ("c_name", "string"),
                ("c_nationkey", "int"),
                ("c_acctbal", "double"),
                ("c_mktsegment", "string"),
            ]
        )
    ),
    "table_stats": " UNION ALL ".join(
        _stats(c)
        for c in (
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        )
    ),
    "column_average": f"SELECT {_money('c_acctbal')} / count(c_acctbal) AS average FROM customer",
    "spend_per_customer": f"""
        SELECT c_custkey, c_name, n_name, {_money('o_totalprice')} AS total_amount
        FROM customer JOIN orders ON c_custkey = o_custkey
        JOIN nation ON c_nationkey = n_nationkey
        GROUP BY c_custkey, c_name, n_name
    """,
    "orders_of_customer": f"""
        SELECT '{KNOWN_CUSTOMER}' AS customer_name, count(o_orderkey) AS n_orders
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE c_name = '{KNOWN_CUSTOMER}'
    """,
    "case_insensitive_join": f"WITH {_NATION_SALES} SELECT * FROM joined",
    "rank_by_ratio": f"""
        WITH {_NATION_SALES}
        SELECT nation, revenue, customers, revenue / customers AS ratio,
               row_number() OVER (ORDER BY revenue / customers DESC, nation) AS rank
        FROM joined QUALIFY rank <= 10
    """,
    "filtered_count": "SELECT count(*) AS n_rows FROM orders WHERE o_orderstatus = 'F'",
    "project_rows": "SELECT c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 10",
    "ask_sql": ORDERS_BY_SEGMENT,
    "tables_used": """
        SELECT * FROM (VALUES
            ('orders-by-segment', 'customer'), ('orders-by-segment', 'orders'),
            ('suppliers-of-region', 'region'), ('suppliers-of-region', 'nation'),
            ('suppliers-of-region', 'supplier'), ('renamed-documents', 'documents')
        ) AS used(answer_id, table_name)
    """,
    "answer_string": """
        SELECT c_custkey, concat_ws(', ', c_custkey, c_name, c_mktsegment) AS line FROM customer
    """,
    "answer_table": "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY 1",
    "answer_auto": """
        SELECT 'string' AS kind, CAST(count(*) AS VARCHAR) AS answer
        FROM lineitem WHERE l_returnflag = 'R'
    """,
    "chart_bars": f"""
        SELECT o_orderpriority AS category, {_money('o_totalprice')} AS measure
        FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3
    """,
    "chart_histogram": f"""
        WITH edge AS (SELECT min(o_totalprice) AS lo,
                        (max(o_totalprice) - min(o_totalprice)) / {HISTOGRAM_BINS} AS width
                      FROM orders),
        counted AS (
          SELECT CAST(least(floor((o_totalprice - lo) / width), {HISTOGRAM_BINS - 1}) + 1 AS BIGINT)
                   AS bin, count(*) AS n
          FROM orders, edge GROUP BY 1)
        SELECT CAST(b AS BIGINT) AS bin, round(lo + (b - 1) * width, 6) AS bin_start,
               round(lo + b * width, 6) AS bin_end, coalesce(n, 0) AS n_rows
        FROM range(1, {HISTOGRAM_BINS + 1}) AS bins(b), edge LEFT JOIN counted ON counted.bin = b
    """,
    "chart_series": f"""
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
               {_money('o_totalprice')} AS measure
        FROM orders GROUP BY 1
    """,
    "history_ordered": (
        "SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position "
        "FROM conversations"
    ),
    "first_question": f"""
        WITH nxt AS ({_NEXT}),
        flags AS (SELECT *, coalesce(CAST(role = 'user' AND next_role = 'assistant'
                                          AND NOT next_failed AS INT), 0) AS answered FROM nxt),
        seen AS (SELECT *, coalesce(sum(answered) OVER (PARTITION BY conv_id ORDER BY turn
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM flags)
        SELECT conv_id, turn, CASE WHEN before = 0 THEN 'chat' ELSE 'follow_up' END AS kind
        FROM seen WHERE role = 'user'
    """,
    "question_answer_pairs": f"""
        SELECT conv_id, turn, text AS question, next_text AS answer
        FROM ({_NEXT}) WHERE role = 'user' AND next_role = 'assistant'
    """,
    "unanswered_questions": f"""
        SELECT conv_id, turn, text AS question,
               CASE WHEN next_role IS DISTINCT FROM 'assistant' THEN 'no answer'
                    ELSE 'failed answer' END AS reason
        FROM ({_NEXT})
        WHERE role = 'user' AND (next_role IS DISTINCT FROM 'assistant' OR next_failed)
    """,
    "previous_question": """
        SELECT conv_id, turn, text AS question,
               lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS previous_question
        FROM conversations WHERE role = 'user'
    """,
    "memory_last_n": f"""
        SELECT * FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= {LAST_MESSAGES}
    """,
    "memory_token_budget": f"""
        SELECT *, CAST(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn DESC) AS BIGINT)
                    AS tokens_to_end
        FROM (SELECT *, CAST(coalesce(ceil(length(text) / {TOKEN_CHARS}), 0) AS BIGINT)
                          AS tokens FROM conversations)
        QUALIFY tokens_to_end <= {TOKEN_BUDGET}
    """,
    "context_per_question": f"""
        SELECT conv_id, turn, n_messages, context FROM (
          SELECT conv_id, turn, role, count(*) OVER w AS n_messages,
                 coalesce(string_agg(role || ': ' || coalesce(text, ''), chr(10)) OVER w, '')
                   AS context
          FROM conversations
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn
                       ROWS BETWEEN {LAST_MESSAGES} PRECEDING AND 1 PRECEDING))
        WHERE role = 'user'
    """,
    "session_epochs": """
        SELECT * FROM (
          SELECT *, CAST(sum(CAST(role = 'system' AS INT))
                      OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS epoch
          FROM conversations)
        QUALIFY epoch = max(epoch) OVER (PARTITION BY conv_id)
    """,
    "history_by_role": """
        SELECT role, count(*) AS n_messages,
               CAST(sum(length(text)) AS DOUBLE) / count(text) AS mean_length
        FROM conversations GROUP BY role
    """,
    "tables_prompt": f"""
        SELECT DISTINCT conv_id, 'system' AS role, {_literal(
            f"Tables at hand ({len(DESCRIPTIONS)}): {_TABLE_LIST}. Draw on every table that "
            "matters and name those you drew on."
        )} AS text FROM conversations
    """,
    "welcome_message": f"""
        WITH {_overview()}
        SELECT 'Tables loaded: ' || count(*) || '. Their names: '
            || string_agg('''' || table_name || '''', ', ' ORDER BY position) || '.'
            || ' A question may combine them; related rows are joined for you.'
            || chr(10) || chr(10) || 'Sizes:'
            || string_agg(chr(10) || '- ''' || table_name || ''': ' || n_rows || ' rows, '
                          || n_columns || ' columns', '' ORDER BY position) AS message
        FROM overview
    """,
    "keyed_hash": f"SELECT c_custkey, {_hmac('c_name')} AS name_hash FROM customer",
    "verify_hash": (
        f"SELECT c_custkey, c_name FROM customer WHERE {_hmac('c_name')} = '{stored_hash()}'"
    ),
}
