"""Source tables as DataFrames (A1, A2) and cohort filters.

Sources are read lazily; nothing is collected.  A parquet folder is the test
and lake path; a JDBC source is read in parallel slices by a numeric column so
a large table is not pulled through one connection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F



def load_tables(spark: SparkSession, source: str | Mapping[str, str], names: Iterable[str],
                fmt: str = "parquet", options: Mapping[str, str] | None = None,
                queries: Mapping[str, str] | None = None, split: Mapping[str, Split] | None = None
                ) -> dict[str, DataFrame]:
    """Return ``{name: DataFrame}`` for ``names`` from files, a database or a
    connector.

    * files (``fmt`` parquet, csv, ...): ``source`` is a folder
      (``{source}/{name}.{fmt}``) or a mapping of name -> path;
    * ``fmt="jdbc"``: ``source`` is the url, or a mapping of name -> url;
      ``split`` names the tables read in ranges;
    * any other ``fmt`` with ``options`` (a warehouse connector): the table
      name, or its query, goes into the ``dbtable`` / ``query`` option.

    ``queries`` gives the statement sent to the database instead of the
    whole table, e.g. one with the cohort's filter in it.
    """
    out = {}
    for name in names:
        place = source[name] if isinstance(source, Mapping) else source
        statement = (queries or {}).get(name)
        if fmt == "jdbc":
            out[name] = read_jdbc(spark, place, name, statement, (split or {}).get(name), options)
        elif options is not None:
            reader = spark.read.format(fmt).options(**{**options, **({"query": statement} if statement else {"dbtable": name})})
            out[name] = reader.load()
        else:
            path = place if isinstance(source, Mapping) else f"{source}/{name}.{fmt}"
            out[name] = spark.read.format(fmt).load(path)
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Split(NamedTuple):
    """A read in ranges of ``column`` from ``lower`` to ``upper``, one task each."""
    column: str
    lower: int | str
    upper: int | str
    parts: int = 64


def jdbc_options(url: str, table: str, query: str | None = None, split: Split | None = None,
                 properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options for one table or query.  A query that is read in ranges
    becomes a derived table, as Spark does not split the ``query`` option."""
    out = {"url": url, **(properties or {})}
    if split is None:
        out |= {"query": query} if query else {"dbtable": table}
    else:
        if split.lower is None or split.upper is None:
            raise ValueError(f"{table}: a split read needs both bounds of {split.column}")
        out |= {"dbtable": f"({query}) q" if query else table, "partitionColumn": split.column,
                "lowerBound": str(split.lower), "upperBound": str(split.upper), "numPartitions": str(split.parts)}
    return out


def read_jdbc(spark: SparkSession, url: str, table: str, query: str | None = None, split: Split | None = None,
              properties: Mapping[str, str] | None = None, predicates: list[str] | None = None) -> DataFrame:
    """Read one database table (A1 operational system, A2 warehouse view), or
    a query on it.  Without ``split`` Spark uses a single connection, which is
    right for control tables and for queries that return little.

    ``split`` cuts the span of a column evenly; ``predicates`` (see
    ``range_predicates``, ``cohort_predicates``) cut it where the rows are, one
    connection and task each, so skewed ids give even slices."""
    if predicates is not None:
        if split is not None:
            raise ValueError(f"{table}: give split or predicates, not both")
        source = f"({query}) q" if query else table
        return spark.read.jdbc(url, source, predicates=predicates, properties=dict(properties or {}))
    return spark.read.format("jdbc").options(**jdbc_options(url, table, query, split, properties)).load()


def key_cuts(keys: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[int]:
    """At most ``2 * parts`` values that cut the rows of ``keys`` into slices of
    about equal size, or smaller: quantiles of the integer ``column``, one
    aggregate with a state of fixed size.  A value that fills slices by itself
    is cut off on both sides."""
    if parts < 2:
        return []
    at = F.percentile_approx(F.col(f"`{column}`").cast("bigint"), [i / parts for i in range(1, parts)], accuracy)
    found = keys.agg(at).first()[0] or []
    return sorted(set(found) | {v + 1 for v in found if found.count(v) > 1})


def range_predicates(column: str, cuts: Iterable) -> list[str]:
    """Predicates that cover every key once, one for each slice between the
    cuts; rows without a key are in the first slice."""
    cuts = list(cuts)
    if not cuts:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    inner = [f"{column} >= {a} AND {column} < {z}" for a, z in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def cohort_predicates(cohort: DataFrame, key: str, column: str, parts: int) -> list[str]:
    """At most ``parts`` range predicates that a database can answer from an
    index on ``column``; they hold every id of the cohort and leave its widest
    gaps unread.

    The ids are cut into slices of equal count, a few times ``parts``; each
    gives its smallest and largest id and its widest gap, and of the spans on
    both sides of the gaps the nearest neighbours are put together until
    ``parts`` are left.  The rows read are still to be joined with the cohort
    (``semi_join_cohort``).  An empty cohort asks for nothing."""
    ids = cohort.select(F.col(f"`{key}`").cast("bigint").alias("k")).where("k is not null").distinct()
    cuts = key_cuts(ids, "k", 8 * parts)
    number = F.size(F.filter(F.lit(cuts), lambda c: c <= F.col("k"))) if cuts else F.lit(0)
    sliced = ids.withColumn("s", number).withColumn("prior", F.lag("k").over(Window.partitionBy("s").orderBy("k")))
    gap = F.max(F.struct((F.col("k") - F.col("prior")).alias("width"), "prior", "k")).alias("gap")
    spans = []
    for r in sliced.groupBy("s").agg(F.min("k").alias("a"), F.max("k").alias("z"), gap).orderBy("s").collect():
        at = r["gap"]
        spans += [(r["a"], r["z"])] if at["prior"] is None else [(r["a"], at["prior"]), (at["k"], r["z"])]
    while len(spans) > parts:
        k = min(range(len(spans) - 1), key=lambda i: spans[i + 1][0] - spans[i][1])
        spans[k:k + 2] = [(spans[k][0], spans[k + 1][1])]
    return [f"{column} = {a}" if a == z else f"{column} BETWEEN {a} AND {z}" for a, z in spans] or ["1 = 0"]


def filter_cohort_ids(df: DataFrame, key: str | Column, ids: Iterable) -> DataFrame:
    """Keep rows whose key is in a caller's id list.

    The list is a literal ``IN`` set: it is pushed into the parquet scan as a
    filter.  An empty list gives an empty result (the SQL text ``in ()`` the
    original built would not run).
    """
    ids = list(ids)
    k = F.col(key) if isinstance(key, str) else key
    if not ids:
        return df.where(F.lit(False))
    return df.where(k.isin(ids))


def semi_join_cohort(df: DataFrame, cohort: DataFrame, on: str | list[str]) -> DataFrame:
    """Keep rows whose key appears in a cohort table.

    Duplicates in the cohort do not multiply rows (left semi).  The planner
    broadcasts the cohort if its bytes allow, else shuffles both sides.
    """
    return df.join(cohort.select(*([on] if isinstance(on, str) else on)), on=on, how="left_semi")
