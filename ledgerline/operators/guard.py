"""Guarded ad-hoc SELECT over the marts (SQL-1..5).

Statement vetting and row capping are column expressions, so a whole table of
submitted statements is vetted in parallel. A statement runs in a session of its own
that holds temporary views of the three marts and stands in an empty database:
what else there is can only be reached by naming its database, by a file path or by a
function, and such statements are refused (databases and catalogs by their
names, functions by a list of those allowed) or do not resolve.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.quality import Result

# Keywords rejected anywhere in a statement (whole words).
FORBIDDEN_KEYWORDS = [
    "INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "CREATE", "TRUNCATE",
    "GRANT", "REVOKE", "COPY", "EXECUTE", "CALL", "DO", "SET", "RESET",
    "LOCK", "VACUUM", "ANALYZE", "CLUSTER", "REINDEX", "REFRESH",
    "BEGIN", "COMMIT", "ROLLBACK", "SAVEPOINT", "PREPARE", "DEALLOCATE",
    "LISTEN", "NOTIFY", "LOAD", "IMPORT", "EXPORT",
]

# Tables a statement may reference.
ALLOWED_TABLES = [
    "marts.mart_call_funnel", "marts.mart_revenue", "marts.mart_jobs",
    "mart_call_funnel", "mart_revenue", "mart_jobs",
]

# Rejection messages.
MSG_EMPTY = "Empty query"
MSG_SELECT_ONLY = "Only SELECT queries are allowed"
MSG_MULTI = "Multi-statement queries are not allowed"
MSG_FORBIDDEN = "Forbidden keyword: "
MSG_SCHEMA = "Access to raw, staging, pg_catalog, and information_schema is not allowed"
GENERIC_ERROR = "The query could not be run. Please try again or rephrase your question."

MAX_ROWS = 100

STATEMENT_SECONDS = 5

# Patterns. Character classes are spelled out, so that Java and RE2
# (the oracle) read them alike and letters and blanks of any script count.
WORD = r"[\p{L}\p{N}_]"
BLANK = r"[\s\p{Z}\x{85}\x{1C}-\x{1F}]"
RE_BLOCK_COMMENT = r"(?s)/\*.*?\*/"
RE_LINE_COMMENT = r"--[^\n]*"
RE_FORBIDDEN = r"(?i)(?:^|[^\p{L}\p{N}_])(" + "|".join(FORBIDDEN_KEYWORDS) + r")(?:$|[^\p{L}\p{N}_])"
RE_SCHEMA = r"(?i)(?:^|[^\p{L}\p{N}_])(raw|staging|pg_catalog|information_schema)" + BLANK + r"*\."
RE_TABLE_REF = rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:FROM|JOIN){BLANK}+({WORD}+\.{WORD}+|{WORD}+)"
RE_LIMIT = rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])LIMIT{BLANK}+(\d+)"
RE_FIRST_LIMIT = rf"(?is)^((?:.*?[^\p{{L}}\p{{N}}_])?LIMIT{BLANK}+)\d+"

# One pass over a statement: quoted names are kept, of texts one quote, of comments nothing. Line comments end at
# either line end, as in the parser; what the two read differently is shown and not hidden.
RE_QUOTED = r"""(`[^`]*`)|(')(?:[^'\\]|\\(?s:.))*'|(")(?:[^"\\]|\\(?s:.))*"|--[^\r\n]*|(?s:/\*.*?\*/)"""
RE_RAW_TEXT = r"""(?i)(?:^|[^\p{L}\p{N}_])r['"]"""
RE_CALL = r"([\p{L}\p{N}_]+|`[^`]*`)[\s\p{Z}]*\("
RE_SCRIPT = r"(?i)(?:^|[^\p{L}\p{N}_])USING[\s\p{Z}]*['\"]"
RE_CROSS = r"(?i)(?:^|[^\p{L}\p{N}_])CROSS(?:$|[^\p{L}\p{N}_])"
RE_IDENTITY = r"(?i)(?:^|[^\p{L}\p{N}_])(current_user|session_user|user|current_catalog|current_database|current_schema)(?:$|[^\p{L}\p{N}_.])"
# The marts' schema before one of them, outside of quotes and comments.
RE_MARTS = rf"({RE_QUOTED})|(?i:(^|[^\p{{L}}\p{{N}}_.`])marts[\s\p{{Z}}]*\.[\s\p{{Z}}]*(?=`?mart_))"

# Words that may stand before a bracket without being a function, and the functions that may be called.
# None of them makes rows, reads files or session state, calls code or makes a value much longer than its arguments.
BRACKET_WORDS = ("select from join on where and or not in as when then else case having by over filter exists union all except intersect distinct "
                 "using any some between like is limit partition order group within lateral decimal numeric varchar char").split()
FUNCTIONS = ("count count_if sum avg mean min max max_by min_by any_value first last first_value last_value median mode percentile percentile_approx "
             "approx_percentile approx_count_distinct stddev stddev_pop stddev_samp variance var_pop var_samp corr covar_pop covar_samp bool_and bool_or every "
             "row_number rank dense_rank percent_rank cume_dist ntile lag lead "
             "abs sign round bround floor ceil ceiling sqrt power pow exp ln log log10 mod greatest least try_divide try_add try_subtract "
             "coalesce nullif ifnull nvl nvl2 if isnull isnotnull isnan cast try_cast "
             "date to_date date_trunc trunc date_format year quarter month week weekofyear day dayofmonth dayofweek weekday dayofyear date_add date_sub datediff "
             "add_months months_between last_day extract date_part current_date make_date "
             "lower upper initcap trim ltrim rtrim length char_length substring substr left right concat concat_ws split_part position locate instr "
             "contains startswith endswith").split()
MSG_ONLY_MARTS = "Only marts tables are accessible."
#: A database without tables that guarded sessions stand in.
EMPTY_DATABASE = "guarded_session"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{BLANK}+|{BLANK}+$", "")


def vet_columns(sql: Column) -> tuple[Column, Column]:
    """(ok, reason) for a statement column; checks in the reference order."""
    stripped = _strip(F.coalesce(sql, F.lit("")))
    no_comments = _strip(F.regexp_replace(F.regexp_replace(stripped, RE_BLOCK_COMMENT, " "),
                                          RE_LINE_COMMENT, " "))
    keyword = F.upper(F.regexp_extract(no_comments, RE_FORBIDDEN, 1))
    refs = F.regexp_extract_all(no_comments, F.lit(RE_TABLE_REF), F.lit(1))
    allowed = F.array(*[F.lit(t) for t in ALLOWED_TABLES])
    bad_ref = F.try_element_at(F.filter(refs, lambda r: ~F.array_contains(allowed, F.lower(r))), F.lit(1))
    reason = (
        F.when(stripped == "", F.lit(MSG_EMPTY))
        .when(~F.upper(no_comments).startswith("SELECT"), F.lit(MSG_SELECT_ONLY))
        .when(stripped.contains(";"), F.lit(MSG_MULTI))
        .when(keyword != "", F.concat(F.lit(MSG_FORBIDDEN), keyword))
        .when(stripped.rlike(RE_SCHEMA), F.lit(MSG_SCHEMA))
        .when(bad_ref.isNotNull(),
              F.concat(F.lit("Table not allowed: "), bad_ref, F.lit(". Only marts tables are accessible.")))
        .otherwise(F.lit(""))
    )
    return reason == "", reason


def vet(df: DataFrame, col: str) -> DataFrame:
    """SQL-1: add ``ok`` and ``reason`` for every statement in ``col``."""
    ok, reason = vet_columns(F.col(col))
    return df.withColumn("reason", reason).withColumn("ok", F.col("reason") == "")


def cap_column(sql: Column, n: int = MAX_ROWS) -> Column:
    """SQL-2: first LIMIT above n lowered to n; no LIMIT -> append one."""
    found = F.regexp_extract(sql, RE_LIMIT, 1)
    too_big = (F.length(found) > 38) | (found.try_cast("decimal(38,0)") > F.lit(n))
    appended = F.concat(F.regexp_replace(F.regexp_replace(sql, r"\s+$", ""), r";+$", ""), F.lit(f" LIMIT {n}"))
    lowered = F.regexp_replace(sql, RE_FIRST_LIMIT, "$1" + str(n))
    return F.when(found == "", appended).when(too_big, lowered).otherwise(sql)


def cap(df: DataFrame, col: str, n: int = MAX_ROWS, out: str = "capped_sql") -> DataFrame:
    return df.withColumn(out, cap_column(F.col(col), n))


def statements_from_events(events: DataFrame) -> DataFrame:
    """A table of submitted statements derived from the events table: by event
    type and number, statements that pass and statements for each rejection."""
    k = F.get_json_object("props", "$.k").cast("int")
    et, turn = F.col("event_type"), F.col("event_id") % 4
    sql = (F.when(et == "purchase", F.concat(F.lit("SELECT * FROM marts.mart_revenue LIMIT "),
                                             (k * 5).cast("string")))
           .when((et == "signup") & (turn == 0), F.lit(" \u00a0\n"))
           .when(et == "signup", F.lit("SELECT count(*) FROM raw.calls"))
           .when((et == "error") & (turn == 0), F.lit("SELECT * FROM marts.mart_jobs WHERE 1 = 1 OR delete"))
           .when(et == "error", F.lit("DROP TABLE marts.mart_revenue"))
           .when((et == "click") & (turn == 0), F.lit("SELECT * FROM mart_revenue\u00e9"))
           .when(et == "click", F.lit("/* c */ SELECT * FROM marts.mart_jobs"))
           .otherwise(F.lit("SELECT 1; SELECT 2")))
    return events.select(F.col("event_id").alias("statement_id"), F.col("ts"), sql.alias("sql"))


def probes_from_events(events: DataFrame) -> DataFrame:
    """Statements that pass the text rules, by event type and number: two that may run, and for each further rule one that may not."""
    k = F.get_json_object("props", "$.k")
    et, turn = F.col("event_type"), F.col("event_id") % 4
    sql = (F.when(et == "purchase", F.concat(F.lit("SELECT sum(revenue_dollars) FROM marts.mart_revenue WHERE transaction_count > "), k))
           .when((et == "signup") & (turn == 0), F.concat(F.lit("SELECT aggregate(sequence(1, "), k, F.lit("), 0, (a, x) -> a + x) FROM mart_jobs")))
           .when(et == "signup", F.concat(F.lit("SELECT 'reflect(' || service_category, \"default.b(\" FROM mart_jobs -- range("), k, F.lit(")")))
           .when((et == "error") & (turn == 0), F.concat(F.lit("SELECT * FROM mart_jobs, `default` . t"), k))
           .when(et == "error", F.lit("SELECT r'\\', reflect('x') FROM mart_jobs"))
           .when((et == "click") & (turn == 0), F.lit("SELECT `reflect` /* ( */ ('java.lang.System', 'nanoTime') FROM mart_jobs"))
           .when(et == "click", F.lit("SELECT a.total_jobs FROM marts.mart_jobs a CROSS JOIN marts.mart_revenue"))
           .otherwise(F.concat(F.lit("SELECT current_user, "), k, F.lit(" FROM mart_jobs"))))
    return events.select(F.col("event_id").alias("statement_id"), F.col("ts"), sql.alias("sql"))


def audit_lines(vetted: DataFrame, tool: str = "query_marts") -> DataFrame:
    """SQL-5: one JSON line per request (tool, input, executed SQL or the
    rejection reason, timestamp)."""
    rec = F.struct(
        F.lit(tool).alias("tool"),
        F.col("sql").alias("input_sql"),
        F.when(F.col("ok"), F.col("capped_sql")).alias("executed_sql"),
        F.when(~F.col("ok"), F.lit(True)).alias("rejected"),
        F.when(~F.col("ok"), F.col("reason")).alias("reason"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )
    return vetted.select("statement_id", F.to_json(rec).alias("line"))


def append_audit(lines: DataFrame, path: str) -> None:
    """Append JSON lines to the audit folder (one file set per write)."""
    lines.select("line").write.mode("append").text(path)


# ---------------------------------------------------------------------------
# SQL-3: run one statement in an isolated session
# ---------------------------------------------------------------------------

def refusal(sql: Column, names: list[str]) -> Column:
    """Why a statement that passed ``vet`` may still not run ('' if it may): raw texts, functions and
    words that are not allowed, scripts, cross joins, and ``names`` (databases and catalogs) before a dot."""
    shown = F.regexp_replace(unqualified(sql), RE_QUOTED, "$1$2$3 ")
    calls = F.transform(F.regexp_extract_all(shown, F.lit(RE_CALL), F.lit(1)), lambda c: F.lower(F.regexp_replace(c, "`", "")))
    known = F.array(*[F.lit(w) for w in [*BRACKET_WORDS, *FUNCTIONS]])
    bad_call = F.try_element_at(F.filter(calls, lambda c: ~F.array_contains(known, c)), F.lit(1))
    outside = "|".join(f"\\Q{n}\\E" for n in sorted(names))
    word = F.regexp_extract(shown, RE_IDENTITY, 1)
    return (F.when(sql.rlike(RE_RAW_TEXT), F.lit("Raw texts are not allowed"))
            .when(bad_call.isNotNull(), F.concat(F.lit("Function not allowed: "), bad_call))
            .when(word != "", F.concat(F.lit("Function not allowed: "), F.lower(word)))
            .when(shown.contains("->"), F.lit("Function not allowed: ->"))
            .when(shown.rlike(RE_SCRIPT), F.lit("Function not allowed: using"))
            .when(shown.rlike(RE_CROSS), F.lit("Cross joins are not allowed"))
            .when(shown.rlike(rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])`?(?:{outside})`?[\s\p{{Z}}]*\."), F.lit(MSG_ONLY_MARTS))
            .otherwise(F.lit("")))


def unqualified(sql: Column) -> Column:
    """The statement with the marts named without their schema, as the guarded session knows them."""
    return F.regexp_replace(sql, RE_MARTS, "$1$5")


def outside_names(spark: SparkSession) -> list[str]:
    """Names that lead out of a guarded session when they stand before a dot."""
    return [d.name for d in spark.catalog.listDatabases()] + [c.name for c in spark.catalog.listCatalogs()] + ["system", "builtin", "session", "global_temp", "spark_catalog"]


def guarded_session(spark: SparkSession, database: str = "marts") -> SparkSession:
    """New session with temporary views of the marts of ``database``, in a database without tables; no SQL on files."""
    from ledgerline.functions.wire import MONTH

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {EMPTY_DATABASE}")
    gs = spark.newSession()
    for key, value in {"spark.sql.runSQLOnFiles": "false", "spark.sql.ansi.enabled": "true", "spark.sql.crossJoin.enabled": "false",
                       "spark.sql.ansi.doubleQuotedIdentifiers": "false", "spark.sql.parser.escapedStringLiterals": "false"}.items():
        gs.conf.set(key, value)
    for name in (t for t in ALLOWED_TABLES if "." not in t):
        if gs.catalog.tableExists(f"{database}.{name}"):
            gs.table(f"{database}.{name}").drop(MONTH).createOrReplaceTempView(name)
    gs.catalog.setCurrentDatabase(EMPTY_DATABASE)
    if any(not t.isTemporary for t in gs.catalog.listTables()):
        raise RuntimeError(f"database {EMPTY_DATABASE} has tables")
    return gs


def within(seconds: float, spark: SparkSession, work: Callable):
    """What ``work`` returns, in a thread of its own. After ``seconds`` its jobs are cancelled and its answer
    is not waited for: analysis, folding and evaluation on the driver count towards the limit too."""
    from pyspark import InheritableThread

    group, out = f"guarded-{uuid.uuid4().hex}", {}
    sc = spark.sparkContext

    def run() -> None:
        sc.setJobGroup(group, "guarded query", interruptOnCancel=True)
        try:
            out["value"] = work()
        except Exception as e:  # AnalysisException, ANSI runtime errors, cancelled jobs, ...
            out["error"] = e

    thread = InheritableThread(target=run, daemon=True)
    thread.start()
    thread.join(seconds)
    if thread.is_alive():
        # A job may start just after its group was cancelled, so that goes on until the statement has ended.
        def stop() -> None:
            while thread.is_alive():
                sc.cancelJobGroup(group)
                thread.join(0.5)

        threading.Thread(target=stop, daemon=True).start()
        raise TimeoutError(f"no answer within {seconds} s")
    if "error" in out:
        raise out["error"]
    return out["value"]


def vet_text(spark: SparkSession, sql: str) -> tuple[bool, str]:
    """Vet one statement with the same column expressions (one-row frame)."""
    row = vet(spark.createDataFrame([(sql,)], "sql string"), "sql").first()
    return bool(row["ok"]), row["reason"]


def cap_text(spark: SparkSession, sql: str, n: int = MAX_ROWS) -> str:
    return cap(spark.createDataFrame([(sql,)], "sql string"), "sql", n).first()["capped_sql"]


def log_request(spark: SparkSession, path: str | None, tool: str, **what) -> None:
    """One audit line of an answered or refused request (nothing without a path)."""
    if path:
        record = {"tool": tool, **what, "timestamp": dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")}
        append_audit(spark.createDataFrame([(json.dumps(record),)], "line string"), path)


def guarded_query(spark: SparkSession, sql: str, verdict: DataFrame | None = None,
                  audit_path: str | None = None, seconds: float = STATEMENT_SECONDS, database: str = "marts") -> Result:
    """Gate -> vet -> refuse -> cap -> run once in an isolated session -> envelope.

    Nothing but the marts resolves there, and nothing but the listed functions gets
    there. The capped answer (100 rows at most) is read once, so errors of any row
    surface here as the generic message. ``seconds`` hold for the statement's analysis,
    optimisation and run together; what takes longer is cancelled and not waited for. Every request is logged to
    ``audit_path`` with its row count and time, or why it was refused or failed.
    """
    start = time.time()

    def done(result: Result, **what) -> Result:
        log_request(spark, audit_path, "query_marts", input_sql=sql, **what, duration_ms=int((time.time() - start) * 1000))
        return result

    caveat = None
    if verdict is not None:
        v = verdict.first()
        if v is None or not v["fresh"]:
            message = v["message"] if v else "no verdict"
            return done(Result(error="data_stale", message=message), rejected=True, reason=message)
        caveat = v["message"] if v["warn"] else None
    one = cap(vet(spark.createDataFrame([(sql,)], "sql string"), "sql"), "sql")
    read = one.select("reason", "capped_sql", refusal(F.col("sql"), outside_names(spark)).alias("refusal"), unqualified(F.col("capped_sql")).alias("run_sql"))
    row = read.first()
    reason, capped = row["reason"] or row["refusal"], row["capped_sql"]
    if reason:
        return done(Result(error="query_rejected", message=reason), rejected=True, reason=reason)
    gs = guarded_session(spark, database)

    def answer() -> tuple[list, T.StructType]:
        df = gs.sql(row["run_sql"]).limit(MAX_ROWS)
        return df.collect(), df.schema

    try:
        rows, schema = within(seconds, spark, answer)
    except Exception as e:
        return done(Result(error="query_failed", message=GENERIC_ERROR), executed_sql=capped, error=f"{type(e).__name__}: {str(e)[:500]}")
    return done(Result(data=spark.createDataFrame(rows, schema), sql=capped, caveat=caveat, row_count=len(rows)), executed_sql=capped, row_count=len(rows))


def describe_marts(marts: dict[str, DataFrame]) -> DataFrame:
    """SQL-4: (table, table_description, column, type, description, row_count, null_count) of the marts'
    columns: types and comments from the schema, counts from one pass over each mart."""
    from ledgerline.operators.marts import with_comments
    from ledgerline.schemas import MART_DESCRIPTIONS

    out = None
    for name, df in marts.items():
        fields = with_comments(df, name).schema.fields
        counts = df.agg(F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in fields])
        rows = counts.unpivot("row_count", [f.name for f in fields], "column", "null_count")
        kind, text = (F.create_map(*[F.lit(x) for f in fields for x in (f.name, v(f))]) for v in (lambda f: f.dataType.simpleString(), lambda f: f.metadata.get("comment", "")))
        part = rows.select(F.lit(f"marts.{name}").alias("table"), F.lit(MART_DESCRIPTIONS.get(name, "")).alias("table_description"), "column",
                           F.element_at(kind, F.col("column")).alias("type"), F.element_at(text, F.col("column")).alias("description"), "row_count", "null_count")
        out = part if out is None else out.unionByName(part)
    return out
