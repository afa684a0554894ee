"""Rows of one table from a SQL dump (``INSERT INTO `t` VALUES (...),(...);``).

The dump is split into statements at ``;`` + newline by the text source
(``lineSep``), so statements are distributed over tasks like any text file;
a semicolon inside a value is kept because it is not followed by a newline
there.  Only statements inserting into the wanted table are parsed, in
batches (``mapInPandas``), once: the result is stored in the shared folder
and split into rows and errors.  Comments before a statement, ``INSERT
IGNORE``, ``REPLACE``, a column list, ``_binary'..'`` and hex literals are
read; a statement into the table that cannot be read goes, whole, to the
error output instead of stopping the job, unless ``strict``.

With ``keys`` the statements act on the table in their order, as a server
would run them: REPLACE puts its row in the place of an earlier one, INSERT
IGNORE keeps the earlier one, and a plain INSERT of a key that is there is an
error.  That needs no sequential pass: of the rows of a key the last REPLACE
stands, and without any the first row, which is one aggregate by key.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import checkpoint_dir

STATEMENT_SEP = ";\n"
#: Parsed rows that a Python worker holds before it hands them on (and those of one statement).
ROWS_A_BATCH = 5_000
_TOKEN = re.compile(
    r"\s*(?:(?P<open>\()|(?P<close>\))|(?P<comma>,)"
    r"|(?:_[A-Za-z0-9]+\s*)?'(?P<str>(?:[^'\\]|\\.|'')*)'"
    r"|(?:0x(?P<hex>[0-9A-Fa-f]*)\b|[xX]'(?P<xhex>[0-9A-Fa-f]*)')"
    r"|(?P<null>NULL\b)"
    r"|(?P<num>[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?))",
    re.S)
# MySQL string escapes.
_ESCAPES = {"0": "\0", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a"}


def _unescape(s: str) -> str:
    s = s.replace("''", "'")
    return re.sub(r"\\(.)", lambda m: _ESCAPES.get(m.group(1), m.group(1)), s, flags=re.S)


def parse_values(text: str, n_cols: int) -> list[list[str | None]]:
    """Tuples of a ``VALUES`` list as text (NULL -> None); raises on bad input."""
    rows: list[list[str | None]] = []
    pos, n = 0, len(text)
    while True:
        m = _TOKEN.match(text, pos)
        if not m or not m.group("open"):
            raise ValueError(f"expected '(' at {pos}")
        pos = m.end()
        row: list[str | None] = []
        while True:
            m = _TOKEN.match(text, pos)
            if not m:
                raise ValueError(f"bad value at {pos}")
            pos = m.end()
            if m.group("str") is not None:
                row.append(_unescape(m.group("str")))
            elif m.group("hex") is not None or m.group("xhex") is not None:
                digits = m.group("hex") if m.group("hex") is not None else m.group("xhex")
                row.append(bytes.fromhex(digits if len(digits) % 2 == 0 else "0" + digits).decode("utf-8", "replace"))
            elif m.group("null"):
                row.append(None)
            elif m.group("num") is not None:
                row.append(m.group("num"))
            else:
                raise ValueError(f"bad value at {pos}")
            m = _TOKEN.match(text, pos)
            if not m or not (m.group("comma") or m.group("close")):
                raise ValueError(f"expected ',' or ')' at {pos}")
            pos = m.end()
            if m.group("close"):
                break
        if len(row) != n_cols:
            raise ValueError(f"row has {len(row)} values, expected {n_cols}")
        rows.append(row)
        m = _TOKEN.match(text, pos)
        if m and m.group("comma"):
            pos = m.end()
            continue
        if text[pos:].strip() in ("", ";"):
            return rows
        raise ValueError(f"unexpected text at {pos}")


# A statement's start: blank lines and comments (dumps put settings into /*! ... */).
_LEAD = re.compile(r"(?:\s+|--[^\n]*(?:\n|$)|#[^\n]*(?:\n|$)|/\*.*?\*/;?)*", re.S)
_INSERT = re.compile(r"(?:INSERT|REPLACE)\b(?:\s+(?:LOW_PRIORITY|DELAYED|HIGH_PRIORITY|IGNORE))*(?:\s+INTO)?\s+(?:`?[^\s`.(]+`?\.)?`?(?P<table>[^\s`(]+)`?\s*", re.I)
_MODE = re.compile(r"(?P<replace>REPLACE)\b|INSERT\b(?:\s+(?:LOW_PRIORITY|DELAYED|HIGH_PRIORITY))*(?P<ignore>\s+IGNORE\b)?", re.I)
_COLUMNS = re.compile(r"\((?P<names>[^()']*)\)\s*(?=VALUES?\b)", re.I)
_VALUES = re.compile(r"VALUES?\s*", re.I)


def read_insert(statement: str, table: str, columns: Sequence[str]) -> list[list[str | None]] | None:
    """Rows of an INSERT into ``table`` in the order of ``columns``; None for any other statement.

    Raises ValueError if it inserts into the table and cannot be read.
    """
    m = _INSERT.match(statement, _LEAD.match(statement).end())
    if not m or m.group("table").lower() != table.lower():
        return None
    pos, names = m.end(), list(columns)
    m = _COLUMNS.match(statement, pos)
    if m:
        pos, names = m.end(), [n.strip().strip("`") for n in m.group("names").split(",")]
        unknown = [n for n in names if n not in columns]
        if unknown:
            raise ValueError(f"unknown columns {unknown}")
    m = _VALUES.match(statement, pos)
    if not m:
        raise ValueError(f"expected VALUES at {pos}")
    rows = parse_values(statement[m.end():], len(names))
    if names == list(columns):
        return rows
    at = [names.index(c) if c in names else None for c in columns]
    return [[None if i is None else r[i] for i in at] for r in rows]


_PLACE = ["_source", "_file", "_start", "_number"]


def statement_mode(statement: str) -> str:
    """``replace``, ``ignore`` or ``insert``: what a statement does with a key that is there."""
    m = _MODE.match(statement, _LEAD.match(statement).end())
    return "replace" if m and m.group("replace") else "ignore" if m and m.group("ignore") else "insert"


def _statements(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value`` and the place of a statement (``_PLACE``): file (in the order given, then by
    name), start of the split in the file, and number within the split."""
    out = None
    for i, p in enumerate(paths):
        s = spark.read.option("lineSep", STATEMENT_SEP).text(p).select(
            "value", F.lit(i).alias("_source"), F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_number"))
        out = s if out is None else out.unionByName(s)
    return out


def in_order(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(rows, duplicates)`` after the statements of ``rows`` (columns ``_mode`` and ``_at``) have run in their order.

    Rows with a NULL key part never meet another.  ``duplicates`` are the rows
    of plain INSERTs whose key was there.
    """
    keys = list(keys)
    cols = [c for c in rows.columns if c not in ("_mode", "_at")]
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    row = F.struct(*[F.col(c) for c in cols])
    replace = F.col("_mode") == "replace"
    agg = rows.where(~missing).groupBy(*keys).agg(
        F.coalesce(F.max_by(row, F.when(replace, F.col("_at"))), F.min_by(row, "_at")).alias("_row"),
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    out = agg.select(*[F.col(f"_row.{c}").alias(c) for c in cols]).unionByName(rows.where(missing).select(*cols))
    again = agg.where("_n > 1").select(*[F.col(k).alias(f"_again_{k}") for k in keys], "_first")
    cond = F.col("_at") > F.col("_first")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_again_{k}"))
    twice = rows.where(F.col("_mode") == "insert").join(again, cond, "left_semi")
    return out, twice.select(*cols)


def load_sql_dump(spark: SparkSession, path: str | list[str], table: str, columns: Sequence[str],
                  schema: StructType | None = None, strict: bool = False,
                  keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, errors)`` of ``table`` in the dump at ``path``.

    ``rows`` has ``columns`` as text, cast to ``schema`` when given; a column
    that an INSERT's column list leaves out is NULL.  ``errors`` has
    ``statement`` and ``error`` for statements into the table that could not
    be read and, with ``schema``, for rows with a value that does not fit its
    type (the row as JSON).  ``strict`` fails the job if there is any.

    With ``keys`` the statements run in order: files in the order given (those
    of a folder by name), statements and rows as they stand in a file.  A
    plain INSERT of a key that is there goes to the errors, row by row.
    """
    cols = list(columns)
    out_schema = StructType([StructField(c, StringType(), True) for c in cols]
                            + [StructField("_error", StringType(), True), StructField("_statement", StringType(), True),
                               StructField("_mode", StringType(), True), StructField("_row", LongType(), True)])
    stmts = _statements(spark, [path] if isinstance(path, str) else list(path))
    out_schema = StructType([*out_schema.fields, *(stmts.schema[c] for c in _PLACE)])

    def parse(batches: Iterator) -> Iterator:
        import pandas as pd
        names = cols + ["_error", "_statement", "_mode", "_row", *_PLACE]
        for pdf in batches:
            out = []
            for stmt, at in zip(pdf["value"], pdf[_PLACE].itertuples(index=False, name=None)):
                try:
                    mode = statement_mode(stmt or "")
                    for i, r in enumerate(read_insert(stmt or "", table, cols) or ()):
                        out.append((*r, None, None, mode, i, *at))
                except ValueError as e:
                    out.append((*[None] * len(cols), str(e), stmt, None, 0, *at))
                if len(out) >= ROWS_A_BATCH:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    stmts = stmts.where(F.col("value").rlike(r"(?i)\b(INSERT|REPLACE)\b"))
    store = f"{checkpoint_dir(spark).rstrip('/')}/sqldump-{uuid.uuid4().hex}"
    parsed = stmts.mapInPandas(parse, out_schema)
    if schema is not None:
        bad = F.array_compact(F.array(*[F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
                                        for f in schema.fields]))
        misfit = F.col("_error").isNull() & (F.size(bad) > 0)
        row = F.to_json(F.struct(*[F.col(c) for c in cols]))
        parsed = parsed.withColumns({"_error": F.when(misfit, F.concat(F.lit("does not fit: "), F.array_join(bad, ","))).otherwise(F.col("_error")),
                                     "_statement": F.when(misfit, row).otherwise(F.col("_statement"))})
    parsed.write.parquet(store)
    parsed = spark.read.parquet(store)
    errors = parsed.where(F.col("_error").isNotNull()).select(F.col("_statement").alias("statement"), F.col("_error").alias("error"))
    if strict and (first := errors.select("error").head()) is not None:
        raise ValueError(f"unreadable INSERT for {table}: {first.error}")
    typed = {f.name: F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields} if schema is not None else {}
    names = schema.names if schema is not None else cols
    rows = parsed.where(F.col("_error").isNull()).select(
        *[typed.get(c, F.col(c)) for c in names], "_mode", F.struct(*_PLACE, "_row").alias("_at"))
    if keys is None:
        return rows.drop("_mode", "_at"), errors
    rows, twice = in_order(rows, keys)
    if strict and (first := twice.head()) is not None:
        raise ValueError(f"{table}: duplicate key in INSERT: {first}")
    text = F.to_json(F.struct(*[F.col(c) for c in names]))
    return rows, errors.unionByName(twice.select(text.alias("statement"), F.lit("duplicate key").alias("error")))


def sql_literal(c) -> F.Column:
    """A column as a MySQL literal (for writing test dumps with Spark)."""
    s = c.cast("string")
    esc = F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    esc = F.replace(esc, F.lit("\n"), F.lit("\\n"))
    return F.when(s.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), esc, F.lit("'")))


def write_statements(statements: DataFrame, path: str) -> None:
    """Write one text column as statements, each closed by a semicolon."""
    statements.toDF("s").select(F.concat("s", F.lit(";")).alias("value")).write.mode("overwrite").text(path)


def write_sql_dump(df: DataFrame, path: str, table: str, rows_per_statement: int = 100, lead: str = "",
                   verb: str = "INSERT INTO", name_columns: bool = False) -> None:
    """Write ``df`` as INSERT statements (several rows each) -- a distributed
    writer used to produce dumps from tables (tests, fixtures)."""
    row_text = F.concat(F.lit("("), F.concat_ws(",", *[sql_literal(F.col(c)) for c in df.columns]), F.lit(")"))
    g = df.select(row_text.alias("r"), F.spark_partition_id().alias("_p"),
                  F.floor(F.monotonically_increasing_id() / rows_per_statement).alias("_g"))
    stm = g.groupBy("_p", "_g").agg(F.concat_ws(",", F.collect_list("r")).alias("v"))
    names = " (" + ",".join(f"`{c}`" for c in df.columns) + ")" if name_columns else ""
    write_statements(stm.select(F.concat(F.lit(f"{lead}{verb} `{table}`{names} VALUES "), F.col("v"))), path)
