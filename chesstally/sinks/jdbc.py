"""Relational databases through Spark's JDBC source.

* backend from the URL scheme (``postgres://``/``postgresql://``, ``sqlite:``, ``mysql://``,
  case-insensitive; anything else is an error), mapped to a JDBC URL and driver class;
* plain append of an aggregate table (each task writes its partition in batches);
* additive upsert: the delta is written to a staging table by Spark, then one
  ``INSERT ... SELECT ... ON CONFLICT/ON DUPLICATE KEY`` statement merges it inside the database,
  in a single transaction (Spark's JDBC writer is transactional per partition only);
* the ledger's ingested months, read with the status predicate pushed down to the database.

Untested here: no database may be started in this environment, and the drivers for these three
databases are not on this machine's classpath. The SQL text is unit-tested.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote, urlsplit, urlunsplit

from pyspark.sql import DataFrame, SparkSession

from chesstally.operators.aggregate import KEY_COLUMNS, MEASURE_COLUMNS

DRIVERS = {
    "postgres": "org.postgresql.Driver",
    "sqlite": "org.sqlite.JDBC",
    "mysql": "com.mysql.cj.jdbc.Driver",
}

# The two tables' names, columns, types and keys (the original tool's schema, so an
# existing database can be written to by either tool).
AGGREGATES_DDL = """CREATE TABLE IF NOT EXISTS aggregates (
  month        VARCHAR(7)  NOT NULL,
  eco_group    VARCHAR(16) NOT NULL,
  white_bucket INTEGER     NOT NULL,
  black_bucket INTEGER     NOT NULL,
  games        BIGINT      NOT NULL,
  white_wins   BIGINT      NOT NULL,
  black_wins   BIGINT      NOT NULL,
  draws        BIGINT      NOT NULL,
  PRIMARY KEY (month, eco_group, white_bucket, black_bucket)
)"""

INGESTIONS_DDL = """CREATE TABLE IF NOT EXISTS ingestions (
  month       VARCHAR(7)  PRIMARY KEY,
  url         TEXT        NOT NULL,
  started_at  TEXT,
  finished_at TEXT,
  games       BIGINT      DEFAULT 0,
  duration_ms BIGINT      DEFAULT 0,
  status      VARCHAR(16) NOT NULL
)"""


def detect_backend(url: str | None) -> str:
    if not url:
        raise ValueError("database URL is not set")
    lower = url.lower()
    if lower.startswith(("postgres://", "postgresql://")):
        return "postgres"
    if lower.startswith("sqlite:"):
        return "sqlite"
    if lower.startswith("mysql://"):
        return "mysql"
    raise ValueError(f"unsupported database URL scheme: {url}")


def _split_credentials(url: str) -> tuple[str, dict[str, str]]:
    """Move ``user:password@`` out of a server URL into connection properties."""
    parts = urlsplit(url)
    if not parts.username:
        return url, {}
    host = parts.hostname or ""
    if parts.port:
        host += f":{parts.port}"
    creds = {"user": unquote(parts.username)}
    if parts.password is not None:
        creds["password"] = unquote(parts.password)
    return urlunsplit((parts.scheme, host, parts.path, parts.query, parts.fragment)), creds


def jdbc_url(url: str) -> str:
    """Database URL -> JDBC URL (``postgres://u:p@h/db`` -> ``jdbc:postgresql://h/db``)."""
    backend = detect_backend(url)
    if backend == "sqlite":
        return "jdbc:sqlite:" + url.split(":", 1)[1].removeprefix("//")
    bare, _ = _split_credentials(url)
    rest = bare.split(":", 1)[1]
    return ("jdbc:postgresql:" if backend == "postgres" else "jdbc:mysql:") + rest


def jdbc_options(url: str, **extra: str) -> dict[str, str]:
    backend = detect_backend(url)
    creds = {} if backend == "sqlite" else _split_credentials(url)[1]
    return {"url": jdbc_url(url), "driver": DRIVERS[backend], **creds, **extra}


def upsert_sql(backend: str, target: str = "aggregates", staging: str = "aggregates_stage") -> str:
    """One statement merging ``staging`` into ``target``: counts of an existing key add up."""
    cols = [*KEY_COLUMNS, *MEASURE_COLUMNS]
    col_list = ", ".join(cols)
    keys = ", ".join(KEY_COLUMNS)
    head = f"INSERT INTO {target} ({col_list}) SELECT {col_list} FROM {staging}"
    if backend in ("postgres", "sqlite"):
        sets = ", ".join(f"{m} = {target}.{m} + excluded.{m}" for m in MEASURE_COLUMNS)
        # SQLite needs a WHERE to parse ON CONFLICT after INSERT ... SELECT.
        where = " WHERE true" if backend == "sqlite" else ""
        return f"{head}{where} ON CONFLICT ({keys}) DO UPDATE SET {sets}"
    if backend == "mysql":
        sets = ", ".join(f"{m} = {target}.{m} + VALUES({m})" for m in MEASURE_COLUMNS)
        return f"{head} ON DUPLICATE KEY UPDATE {sets}"
    raise ValueError(f"unknown backend {backend!r}")


def write_aggregates(df: DataFrame, url: str, table: str = "aggregates", mode: str = "append",
                     batch_rows: int = 1000, max_connections: int = 10, **props: str) -> None:
    """Plain JDBC write; rows sorted by key within each partition, ``batch_rows`` per batch,
    at most ``max_connections`` concurrent writers (Spark coalesces to that many partitions); one
    for SQLite, a single-writer file."""
    if detect_backend(url) == "sqlite":
        max_connections = 1
    opts = jdbc_options(url, dbtable=table, batchsize=str(batch_rows),
                        numPartitions=str(max_connections), **props)
    (df.select(*KEY_COLUMNS, *MEASURE_COLUMNS).sortWithinPartitions(*KEY_COLUMNS)
     .write.format("jdbc").options(**opts).mode(mode).save())


def _connect(spark: SparkSession, url: str, props: dict[str, str]):
    """A driver-side connection. The backend's class is registered first, as Spark's own JDBC source does:
    jars given to the session by ``--jars`` are not on the class path that ``DriverManager`` searches."""
    jvm = spark.sparkContext._jvm
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(DRIVERS[detect_backend(url)])
    info = jvm.java.util.Properties()
    for k, v in {**_split_credentials(url)[1], **props}.items():
        info.setProperty(k, v)
    return jvm.java.sql.DriverManager.getConnection(jdbc_url(url), info)


def _execute(spark: SparkSession, url: str, statements: list[str], props: dict[str, str]) -> None:
    """Run statements in one transaction on a driver-side JDBC connection."""
    conn = _connect(spark, url, props)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        for sql in statements:
            stmt.execute(sql)
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def upsert_aggregates(df: DataFrame, url: str, table: str = "aggregates",
                      batch_rows: int = 1000, **props: str) -> None:
    """Additive upsert of ``df`` into ``table`` (reference semantics: replay adds again).
    An empty ``df`` writes nothing."""
    if df.isEmpty():
        return
    backend = detect_backend(url)
    staging = f"{table}_stage_{uuid.uuid4().hex[:12]}"
    write_aggregates(df, url, staging, mode="overwrite", batch_rows=batch_rows, **props)
    try:
        _execute(df.sparkSession, url, [upsert_sql(backend, table, staging)], props)
    finally:
        _execute(df.sparkSession, url, [f"DROP TABLE IF EXISTS {staging}"], props)


def read_ingested_months(spark: SparkSession, url: str, table: str = "ingestions",
                         **props: str) -> DataFrame:
    """``month`` of rows with status ``success``; the filter is pushed into the database."""
    opts = jdbc_options(url, dbtable=table, **props)
    return (spark.read.format("jdbc").options(**opts).load()
            .where("status = 'success'").select("month").distinct())


def ledger_start_sql(backend: str, table: str = "ingestions") -> str:
    """Parameterised (month, url, started_at): create the month's row as ``started``, or on an
    existing row replace url/started_at/status and keep games, duration_ms and finished_at."""
    head = (f"INSERT INTO {table} (month, url, started_at, status) "
            "VALUES (?, ?, ?, 'started')")
    if backend in ("postgres", "sqlite"):
        return (f"{head} ON CONFLICT (month) DO UPDATE SET url = excluded.url, "
                "started_at = excluded.started_at, status = 'started'")
    if backend == "mysql":
        return (f"{head} ON DUPLICATE KEY UPDATE url = VALUES(url), "
                "started_at = VALUES(started_at), status = 'started'")
    raise ValueError(f"unknown backend {backend!r}")


def ledger_finish_sql(table: str = "ingestions") -> str:
    """Parameterised (games, duration_ms, status, finished_at, month); no row, no change."""
    return (f"UPDATE {table} SET games = ?, duration_ms = ?, status = ?, finished_at = ? "
            "WHERE month = ?")


def _execute_prepared(spark: SparkSession, url: str, sql: str, params: list,
                      props: dict[str, str]) -> None:
    conn = _connect(spark, url, props)
    try:
        stmt = conn.prepareStatement(sql)
        for i, value in enumerate(params, start=1):
            if isinstance(value, int):
                stmt.setLong(i, value)
            else:
                stmt.setString(i, value)
        stmt.executeUpdate()
    finally:
        conn.close()


def mark_ingestion_start(spark: SparkSession, url: str, month: str, source_url: str,
                         started_at: str, table: str = "ingestions", **props: str) -> None:
    _execute_prepared(spark, url, ledger_start_sql(detect_backend(url), table),
                      [month, source_url, started_at], props)


def mark_ingestion_finish(spark: SparkSession, url: str, month: str, games: int,
                          duration_ms: int, status: str, finished_at: str,
                          table: str = "ingestions", **props: str) -> None:
    _execute_prepared(spark, url, ledger_finish_sql(table),
                      [games, duration_ms, status, finished_at, month], props)


def create_tables(spark: SparkSession, url: str, **props: str) -> None:
    """Create the ``aggregates`` and ``ingestions`` tables if absent (the original tool's
    migrations), in one transaction before any write."""
    _execute(spark, url, [AGGREGATES_DDL, INGESTIONS_DDL], props)
