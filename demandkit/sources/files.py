"""File and table sources and sinks: the raw sales CSV with a declared
schema, a primary-or-fallback source, nested results JSON, and the
prepared / insight / enriched outputs."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import row_numbers
from ..session import materialize

log = logging.getLogger(__name__)

# Raw CSV headers of the sales export and their column names.
RAW_COLUMNS = {
    "Date": "date_str",
    "Product": "product",
    "Brand": "brand",
    "Dealer": "dealer",
    "Dealer Location": "dealer_location",
    "Size": "size",
    "Unit Price (₹)": "unit_price",
    "Quantity Sold": "qty",
    "Stock Availability": "stock",
    "Margin (%)": "margin_pct",
    "Tax (GST % )": "tax_pct",
    "Profit (₹)": "profit",
    "Net Profit (₹)": "net_profit",
    "Total Revenue (₹)": "revenue",
    "Tax Amount (₹)": "tax_amount",
    "Net Tax (₹)": "net_tax",
}
RAW_TYPES = {
    "date_str": T.StringType(), "product": T.StringType(), "brand": T.StringType(),
    "dealer": T.StringType(), "dealer_location": T.StringType(), "size": T.IntegerType(),
    "unit_price": T.DoubleType(), "qty": T.DoubleType(), "stock": T.IntegerType(),
    "margin_pct": T.StringType(), "tax_pct": T.StringType(), "profit": T.DoubleType(),
    "net_profit": T.DoubleType(), "revenue": T.DoubleType(), "tax_amount": T.DoubleType(),
    "net_tax": T.DoubleType(),
}
CORRUPT, REJECT = "_corrupt_record", "reject"


def raw_schema(headers: Sequence[str] = tuple(RAW_COLUMNS)) -> T.StructType:
    fields = [T.StructField(h, RAW_TYPES[RAW_COLUMNS[h]]) for h in headers]
    return T.StructType(fields + [T.StructField(CORRUPT, T.StringType())])


class BadRows(ValueError):
    """Lines of a sales export that can't be read."""


def read_sales_csv(spark: SparkSession, path: str, headers: Sequence[str] = tuple(RAW_COLUMNS),
                   bad_rows: str = "keep") -> DataFrame:
    """Header CSV with a declared schema (no inference pass); columns renamed to
    snake_case and the date parsed. Malformed lines keep their text in
    ``_corrupt_record`` and unparsable dates are null, and ``reject`` says why a row
    can't be used (null for good ones): ``malformed line``, ``no date`` or ``unparsable date``.

    ``bad_rows="keep"`` returns all rows, ``"drop"`` the good ones (see
    :func:`split_rejects` for the others), and ``"fail"`` raises :class:`BadRows` with
    their numbers, after one pass that counts them."""
    from ..functions.exprs import parse_date_fallback
    if bad_rows not in ("keep", "drop", "fail"):
        raise ValueError(f"bad_rows must be 'keep', 'drop' or 'fail', not {bad_rows!r}")
    df = (spark.read.schema(raw_schema(headers)).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    df = df.withColumnsRenamed({h: RAW_COLUMNS[h] for h in headers}).withColumn("date", parse_date_fallback("date_str"))
    why = (F.when(F.col(CORRUPT).isNotNull(), "malformed line").when(F.col("date_str").isNull(), "no date")
           .when(F.col("date").isNull(), "unparsable date"))
    df = df.withColumn(REJECT, why)
    if bad_rows == "fail":
        counts = {r[REJECT]: r["count"] for r in reject_counts(df).collect()}  # at most three rows
        if counts:
            raise BadRows(f"{path}: " + ", ".join(f"{n} x {k}" for k, n in sorted(counts.items())))
    return df if bad_rows == "keep" else df.where(F.col(REJECT).isNull()).drop(REJECT, CORRUPT)


def reject_counts(df: DataFrame) -> DataFrame:
    """Rows by reason, of the rows that :func:`read_sales_csv` can't use."""
    return df.where(F.col(REJECT).isNotNull()).groupBy(REJECT).count()


def split_rejects(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """The good rows of :func:`read_sales_csv`, and a side table of the others, which is
    written to ``path``: reason, the line as far as it is known, and the raw date."""
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[c for c in df.columns if c not in (CORRUPT, REJECT, "date")])))
    df.where(F.col(REJECT).isNotNull()).select(REJECT, line.alias("line"), "date_str").write.mode("overwrite").parquet(path)
    return df.where(F.col(REJECT).isNull()).drop(REJECT, CORRUPT), df.sparkSession.read.parquet(path)


def resolve_source(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]) -> DataFrame:
    """The primary source (e.g. a JDBC table) when it resolves, else the
    fallback file. Resolution only analyses the plan (schema), it reads no
    data on the driver."""
    try:
        df = primary()
        df.schema  # noqa: B018  (forces analysis: missing table / bad credentials fail here)
        return df
    except (PySparkException, Py4JJavaError, OSError) as e:  # the source's errors; a bug in the caller is raised
        log.warning("primary source failed, reading the fallback: %s", str(e).splitlines()[0])
        return fallback()


def read_jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str,
                    lower: int, upper: int, partitions: int, props: Mapping[str, str]) -> DataFrame:
    """Parallel JDBC read split on a numeric column (one query per slice)."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=dict(props))


def read_results_json(spark: SparkSession, path: str) -> DataFrame:
    """A nested results document (one JSON object per file)."""
    return spark.read.option("multiLine", True).json(path)


def write_prepared(df: DataFrame, path: str, fmt: str = "parquet", salts: int = 1) -> None:
    """Prepared rows, train and test side by side, in a folder for each
    ``split`` and ``date``: readers that filter on either read the folders that match.

    Rows are dealt by ranges of (split, date, salt) and sorted by date, so a task
    writes a few neighbouring days and not a file for each day; ``salts`` cuts every day into so
    many parts, for days that are too large for a task."""
    parts = df if "split" in df.columns else df.withColumn("split", F.lit("all"))
    salt = F.pmod(F.xxhash64(*parts.columns), F.lit(max(1, salts)))
    (parts.withColumn("_salt", salt).repartitionByRange("split", "date", "_salt").sortWithinPartitions("split", "date").drop("_salt")
        .write.mode("overwrite").partitionBy("split", "date").format(fmt).option("header", True).save(path))


def read_prepared(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Prepared rows (of one split) from :func:`write_prepared` as Parquet."""
    df = spark.read.parquet(path).withColumn("date", F.col("date").cast("date"))
    return df if split is None else df.where(F.col("split") == split).drop("split")


def write_insights(tables: Mapping[str, DataFrame], path: str) -> None:
    """Each insight table as JSON lines under ``path/<name>``."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


#: Rows of one chunk of a document.
CHUNK_ROWS = 10_000


def document_chunks(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], rows: int = CHUNK_ROWS) -> DataFrame:
    """A nested document of any size as ordered chunks: section, chunk, n_rows, body (a
    JSON array of the chunk's rows). ``tables`` maps a section to its table and the
    columns that order it; a section's chunks follow its rows in that order, and an
    empty section has none. A chunk has at most ``rows`` rows."""
    out = None
    for name, (df, keys) in tables.items():
        places = row_numbers(materialize(df), list(keys), "_at")  # counted, bounded and numbered: computed once
        row = F.struct("_at", F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))
        one = places.groupBy(F.floor(F.col("_at") / rows).cast("int").alias("chunk")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sort_array(F.collect_list(row)).alias("_rows"))  # a chunk is bounded
        one = one.select("chunk", "n_rows", F.concat(F.lit("["), F.array_join(F.transform("_rows", lambda r: r["json"]), ","), F.lit("]")).alias("body"))
        one = one.select(F.lit(name).alias("section"), "chunk", "n_rows", "body")
        out = one if out is None else out.unionByName(one)
    return out


def write_document(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], path: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """The chunks of a document under ``path/chunks`` by section, then, when they are complete, the
    manifest ``path/manifest`` (section, chunks, rows, schema), which is returned."""
    document_chunks(tables, rows).write.mode("overwrite").partitionBy("section").json(f"{path}/chunks")
    spark = next(iter(tables.values()))[0].sparkSession
    written = spark.read.schema("section string, chunk int, n_rows long, body string").json(f"{path}/chunks")
    schemas = spark.createDataFrame([(n, df.schema.json()) for n, (df, _) in tables.items()], "section string, schema string")
    counts = written.groupBy("section").agg(F.count(F.lit(1)).alias("chunks"), F.sum("n_rows").alias("rows"))
    manifest = schemas.join(counts, "section", "left").select(  # a row per section
        "section", F.coalesce("chunks", F.lit(0)).alias("chunks"), F.coalesce("rows", F.lit(0)).alias("rows"), "schema")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.schema("section string, chunks long, rows long, schema string").json(f"{path}/manifest")


def read_document(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The sections of a written document as tables, with their columns' types."""
    chunks = spark.read.schema("section string, chunk int, n_rows long, body string").json(f"{path}/chunks")
    out = {}
    for r in spark.read.json(f"{path}/manifest").collect():  # a row per section
        schema = T.StructType.fromJson(json.loads(r["schema"]))
        rows = chunks.where(F.col("section") == r["section"]).select(F.explode(F.from_json("body", T.ArrayType(schema))).alias("_r"))
        out[r["section"]] = rows.select("_r.*")
    return out


def overwrite_enriched(df: DataFrame, path: str) -> None:
    """Write an enriched table to a new location (Spark cannot overwrite the
    files it is reading)."""
    df.write.mode("overwrite").parquet(path)


# Names used by the operator inventory.
read_sales_table = read_jdbc_table
read_with_fallback = resolve_source
