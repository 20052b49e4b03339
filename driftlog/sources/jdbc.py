"""SQL text on a JDBC database, read in parallel by the executors.

No driver-side row loop: the database result is a DataFrame, split into
``num_partitions`` range reads when a numeric ``partition_column`` is given.
``jdbc_split_query`` finds the ranges itself: the database counts the rows by
stretches of a column (pushed aggregates, a bounded number of rows come
back), crowded stretches are counted again more finely, and each task reads
about as many rows as the others however uneven the column is.
Credentials come from the caller, never from code.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "phoenix": "org.apache.phoenix.jdbc.PhoenixDriver",
    "postgresql": "org.postgresql.Driver",
}


def jdbc_options(url: str, sql: str, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000,
                 driver: str | None = None, user: str | None = None,
                 password: str | None = None) -> dict[str, str]:
    """Reader options. With a partition column the SQL runs as a subquery
    (``dbtable``), since Spark cannot split a ``query`` option."""
    opts: dict[str, str] = {"url": url, "fetchsize": str(fetch_size)}
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partition_column needs lower, upper and num_partitions")
        opts.update({"dbtable": f"({sql}) AS q", "partitionColumn": partition_column,
                     "lowerBound": str(lower), "upperBound": str(upper),
                     "numPartitions": str(num_partitions)})
    else:
        opts["query"] = sql
    if driver:
        opts["driver"] = DRIVERS.get(driver, driver)
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    return opts


def jdbc_query(spark: SparkSession, url: str, sql: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, sql, **kwargs)).load()


RunSql = Callable[[str], Sequence[Sequence]]


def bounds_sql(sql: str, column: str) -> str:
    """Least and greatest value of a whole-number column, rows and rows with a value."""
    return f"SELECT MIN({column}), MAX({column}), COUNT(*), COUNT({column}) FROM ({sql}) q"


def histogram_sql(sql: str, column: str, low: int, high: int, width: int) -> str:
    """Rows by stretch of ``width`` values from ``low``, of the values ``low`` to ``high``."""
    stretch = f"FLOOR(({column} - ({low})) / {width})"
    return (f"SELECT {stretch}, COUNT(*) FROM ({sql}) q WHERE {column} >= {low} AND {column} <= {high} "
            f"GROUP BY {stretch}")


def _stretches(run: RunSql, sql: str, column: str, low: int, high: int, share: float, buckets: int) -> list[tuple[int, int, int]]:
    """``(low, high, rows)`` in order, none with over ``share`` rows unless it is a single value."""
    width = -(-(high - low + 1) // buckets)
    out = []
    for stretch, rows in sorted((int(s), int(n)) for s, n in run(histogram_sql(sql, column, low, high, width))):
        a = low + stretch * width
        b = min(a + width - 1, high)
        if rows > share and b > a:
            out += _stretches(run, sql, column, a, b, share, buckets)
        else:
            out.append((a, b, rows))
    return out


def split_predicates(run: RunSql, sql: str, column: str, parts: int, buckets: int = 256,
                     second: str | None = None) -> list[str]:
    """WHERE conditions that deal the rows of ``sql`` to about ``parts`` reads of about equal size.

    Every row meets exactly one. ``column`` holds whole numbers; rows without a
    value are a read of their own. A single value with more than a share is
    dealt by the whole-number column ``second`` (modulo), where one is given.
    ``run`` executes an aggregate on the database; each returns at most
    ``buckets`` rows.
    """
    if parts < 1 or buckets < 2:
        raise ValueError("parts >= 1 and buckets >= 2")
    [(low, high, rows, set_)] = run(bounds_sql(sql, column))
    out = [f"{column} IS NULL"] if rows > set_ else []
    if low is None:
        return out or ["1 = 1"]
    low, high, share = int(low), int(high), max(set_ / parts, 1)
    start, held = low, 0          # the read being filled: values from start on

    def close(end: int) -> None:
        nonlocal start, held
        if end >= start and held:
            out.append(f"{column} >= {start} AND {column} <= {end}")
            start, held = end + 1, 0

    for a, b, n in _stretches(run, sql, column, low, high, share, buckets):
        if held and held + n > 1.25 * share:
            close(a - 1)
        if a == b and n > share and second:
            close(a - 1)
            k = -(-n // int(share))
            spread = f"MOD(MOD({second}, {k}) + {k}, {k})"
            out += [f"{column} = {a} AND {spread} = {i}" for i in range(k)]
            out.append(f"{column} = {a} AND {second} IS NULL")
            start = a + 1
            continue
        held += n
        if held >= share:
            close(b)
    close(high)
    return out


def jdbc_split_query(spark: SparkSession, url: str, sql: str, column: str, parts: int, second: str | None = None,
                     buckets: int = 256, **kwargs) -> DataFrame:
    """The rows of ``sql``, read by about ``parts`` tasks over ranges found in the database itself."""
    def run(aggregate: str) -> Sequence[Sequence]:
        return jdbc_query(spark, url, aggregate, **kwargs).collect()

    options = jdbc_options(url, sql, **kwargs)
    properties = {k: v for k, v in options.items() if k not in ("url", "query")}
    return spark.read.jdbc(url, f"({sql}) q", predicates=split_predicates(run, sql, column, parts, buckets, second),
                           properties=properties)
