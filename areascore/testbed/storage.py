"""Sources and sinks: write tables to the shared folder, read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.operators.cleaning import drop_sentinels, normalize_columns
from areascore.operators.reshape import union_all
from areascore.scratch import scratch_path
from areascore.sinks import write_csv, write_dataset, write_single_file, write_with_counts
from areascore.sources import Layout, inferred_types, misfits, read_csv, read_dataset, read_inferred_csv, read_lookup_csv, read_population
from areascore.testbed.cleaning import RAW_CUSTOMERS_SQL, raw_customers
from areascore.testbed.registry import query, table


@query("csv_roundtrip", "SELECT doc_id, text, lang, n_chars FROM documents")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "documents-csv")
    write_csv(table(spark, sf_dir, "documents"), path)
    columns = {"doc_id": "bigint", "text": "string", "lang": "string", "n_chars": "bigint"}
    return read_csv(spark, path, columns)


AWKWARD_NAME = """CASE c_custkey % 4 WHEN 0 THEN concat('The "Hub", ', c_name) WHEN 1 THEN concat('  ', c_name, ' ')
  WHEN 2 THEN concat(c_name, chr(10), 'north') ELSE concat(c_name, '"') END"""


@query(
    "lookup_csv",
    f"""SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS area_code, {AWKWARD_NAME} AS area_name FROM customer""",
)
def lookup_csv(spark, sf_dir):
    """Written as the stages write their lookup, with quotes, commas, spaces and line breaks in the names."""
    path = scratch_path(spark, "lookup") + ".csv"
    lookup = table(spark, sf_dir, "customer").selectExpr(
        "lpad(CAST(c_custkey AS STRING), 12, '0') AS area_code", f"{AWKWARD_NAME} AS area_name"
    )
    write_single_file(lookup, path, "csv")
    return read_lookup_csv(spark, path)


@query(
    "csv_split_records",
    """SELECT doc_id, concat(text, chr(10), 'said "', lang, '",', chr(10), chr(10), 'end') AS text, lang, n_chars FROM documents""",
)
def csv_split_records(spark, sf_dir):
    """Files whose texts have line breaks, commas and quotes, read by as many tasks as they have ranges."""
    columns = {"doc_id": "bigint", "text": "string", "lang": "string", "n_chars": "bigint"}
    return read_csv(spark, awkward_documents(spark, sf_dir), columns, split=True)


def awkward_documents(spark, sf_dir):
    """A folder with a file for each piece of the documents: as one file, a single task would have to write them all."""
    path = scratch_path(spark, "documents-csv")
    awkward = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", """concat(text, '\n', 'said "', lang, '",', '\n\n', 'end') AS text""", "lang", "n_chars"
    )
    write_csv(awkward, path)
    return path


# Texts of orders: whole numbers, ones beyond 32 bits, prices, dates, moments, words, and mixtures of them.
RAW_ORDERS = {
    "small": "CAST(o_orderkey AS {text})",
    "large": "CAST(o_orderkey * 4000000000 AS {text})",
    "price": "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS {text})",
    "day": "substring(CAST(o_orderdate AS {text}), 1, 10)",
    "moment": "concat(substring(CAST(o_orderdate AS {text}), 1, 10), ' 12:30:00')",
    "word": "o_orderpriority",
    "numbers": "CASE WHEN o_orderkey % 5 = 0 THEN '1.5e3' WHEN o_orderkey % 5 = 1 THEN '' ELSE CAST(o_custkey AS {text}) END",
    "mixed": "CASE WHEN o_orderkey % 7 = 3 THEN '2020-01-01' ELSE CAST(o_custkey AS {text}) END",
    "mostly": "CASE WHEN o_orderkey % 50 = 3 THEN 'n/a' ELSE CAST(o_custkey AS {text}) END",
    "blank": "CASE WHEN o_orderkey % 2 = 0 THEN '  ' END",
    "no_day": "CASE WHEN o_orderkey % 9 = 1 THEN '2021-02-30' ELSE '2021-02-28' END",
}


def raw_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*[f"{x.format(text='STRING')} AS {name}" for name, x in RAW_ORDERS.items()])


FITS = {
    "int": r"regexp_matches(v, '^[+-]?[0-9]{1,38}$') AND TRY_CAST(v AS HUGEINT) BETWEEN -2147483648 AND 2147483647",
    "bigint": r"regexp_matches(v, '^[+-]?[0-9]{1,38}$') AND TRY_CAST(v AS BIGINT) IS NOT NULL",
    "double": r"regexp_matches(v, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$')",
    "timestamp": r"regexp_matches(v, '^[0-9]{4}-') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL",
}
COUNTED_SQL = "WITH raw AS (SELECT {columns} FROM orders), long AS ({each}), counted AS (SELECT k, count(v) AS n, {counts} FROM long GROUP BY k)".format(
    columns=", ".join(f"{x.format(text='VARCHAR')} AS {name}" for name, x in RAW_ORDERS.items()),
    each=" UNION ALL ".join(f"SELECT '{name}' AS k, nullif(trim({name}), '') AS v FROM raw" for name in RAW_ORDERS),
    counts=", ".join(f"count(*) FILTER ({x}) AS n_{kind}" for kind, x in FITS.items()),
)


@query(
    "csv_inferred",
    f"""{COUNTED_SQL} SELECT k AS "column", n, CASE WHEN n = 0 THEN 'string' WHEN n_int >= n * 0.95 THEN 'int'
      WHEN n_bigint >= n * 0.95 THEN 'bigint' WHEN n_double >= n * 0.95 THEN 'double'
      WHEN n_timestamp >= n * 0.95 THEN 'timestamp' ELSE 'string' END AS type,
      CASE WHEN n = 0 THEN 0 WHEN n_int >= n * 0.95 THEN n - n_int WHEN n_bigint >= n * 0.95 THEN n - n_bigint
      WHEN n_double >= n * 0.95 THEN n - n_double WHEN n_timestamp >= n * 0.95 THEN n - n_timestamp ELSE 0 END AS misfits
    FROM counted""",
)
def csv_inferred(spark, sf_dir):
    """Types of a written file's columns, of which a twentieth of the values may not fit."""
    path = scratch_path(spark, "raw-orders")
    write_csv(raw_orders(spark, sf_dir), path)
    return inferred_types(read_csv(spark, path), tolerance=0.05).select("column", "n", "type", "misfits")


DECLARED = {"small": "int", "large": "int", "price": "double", "numbers": "bigint", "mixed": "double", "mostly": "bigint", "no_day": "timestamp", "word": "string"}


@query(
    "csv_misfits",
    f"""{COUNTED_SQL} SELECT k AS "column", t AS type, n, n - CASE t WHEN 'int' THEN n_int WHEN 'bigint' THEN n_bigint
      WHEN 'double' THEN n_double WHEN 'timestamp' THEN n_timestamp ELSE n END AS misfits
    FROM counted JOIN (VALUES {", ".join(f"('{c}', '{t}')" for c, t in DECLARED.items())}) AS declared(c, t) ON c = k""",
)
def csv_misfits(spark, sf_dir):
    path = scratch_path(spark, "raw-orders")
    write_csv(raw_orders(spark, sf_dir), path)
    return misfits(read_csv(spark, path), DECLARED)


@query(
    "csv_read_inferred",
    """SELECT CAST(o_orderkey AS INTEGER) AS small, o_orderkey * 4000000000 AS large,
      CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS price, o_orderpriority AS word,
      CASE WHEN o_orderkey % 50 <> 3 THEN CAST(o_custkey AS INTEGER) END AS mostly FROM orders""",
)
def csv_read_inferred(spark, sf_dir):
    path = scratch_path(spark, "raw-orders")
    write_csv(raw_orders(spark, sf_dir), path)
    return read_inferred_csv(spark, path, tolerance=0.05).select("small", "large", "price", "word", "mostly")


@query("csv_many_files", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def csv_many_files(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    write_csv(orders.repartition(5), path)
    columns = {"o_totalprice": "double", "o_orderkey": "bigint", "o_orderpriority": "string"}
    read = read_csv(spark, path, columns, multi_line=False)
    return read.select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("dataset_parts", "SELECT c_custkey, c_mktsegment, CAST(1 AS BIGINT) AS parts FROM customer")
def dataset_parts(spark, sf_dir):
    """Any number of input pieces, one part written."""
    path = scratch_path(spark, "customers")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    write_dataset(customers.repartition(3), path, parts=1)
    written = read_dataset(spark, path)
    return written.withColumn("parts", F.lit(len(written.inputFiles())).cast("long"))


@query(
    "population_optional",
    """SELECT c_custkey AS area_key,
      CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey % 7 * 1000 AS DOUBLE) END AS population,
      false AS has_absent_file, false AS has_empty_file FROM customer""",
)
def population_optional(spark, sf_dir):
    path, empty = scratch_path(spark, "population"), scratch_path(spark, "population-empty")
    people = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS nta_code",
        "CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey % 7 * 1000 AS STRING) ELSE 'n/a' END AS population",
    )
    write_csv(people, path)
    write_csv(people.filter(F.col("nta_code") < 0), empty)
    absent = read_population(spark, scratch_path(spark, "population-absent"))
    rows = read_population(spark, path)
    return rows.select(
        F.col("nta_code").cast("long").alias("area_key"),
        "population",
        F.lit(absent is not None).alias("has_absent_file"),
        F.lit(read_population(spark, empty) is not None).alias("has_empty_file"),
    )


@query(
    "parquet_roundtrip",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
)
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    write_dataset(orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), path)
    return read_dataset(spark, path)


@query(
    "single_file_roundtrip",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, 'parquet' AS written_as FROM lineitem GROUP BY ALL
    UNION ALL
    SELECT l_returnflag, l_linestatus, count(*), 'csv' FROM lineitem GROUP BY ALL""",
)
def single_file_roundtrip(spark, sf_dir):
    counts = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parquet = scratch_path(spark, "counts") + ".parquet"
    csv = scratch_path(spark, "counts") + ".csv"
    write_single_file(counts, parquet, "parquet")
    write_single_file(counts, csv, "csv")
    columns = {"l_returnflag": "string", "l_linestatus": "string", "n": "bigint"}
    return (
        read_dataset(spark, parquet)
        .withColumn("written_as", F.lit("parquet"))
        .unionByName(read_csv(spark, csv, columns).withColumn("written_as", F.lit("csv")))
    )


@query(
    "stage_metrics",
    f"""{RAW_CUSTOMERS_SQL}
    SELECT 'customer' AS stage, (SELECT count(*) FROM raw) AS rows_in, count(*) AS rows_out,
      count(*) FILTER (c_acctbal >= 0) AS with_rent
    FROM raw WHERE upper(trim("Raw Segment")) NOT IN ('(NULL)', '')""",
)
def stage_metrics(spark, sf_dir):
    """Counts taken by the write of a cleaning stage."""
    raw = raw_customers(spark, sf_dir).withColumnRenamed("Raw Segment", "segment")
    cleaned = drop_sentinels(normalize_columns(raw, ["segment"]), {"segment": ["(NULL)", ""]})
    path = scratch_path(spark, "cleaned-customers")
    counts = write_with_counts(
        cleaned.withColumnRenamed("Area Name", "area_name"),
        path,
        with_rent=F.count_if(F.col("c_acctbal") >= 0),
    )
    rows_in = table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("rows_in"))
    return rows_in.select(
        F.lit("customer").alias("stage"),
        "rows_in",
        F.lit(counts["rows"]).cast("long").alias("rows_out"),
        F.lit(counts["with_rent"]).cast("long").alias("with_rent"),
    )


@query(
    "layout_roundtrip",
    """SELECT 'raw' AS folder, c_custkey AS key, c_name AS name FROM customer
    UNION ALL SELECT 'cleaned', s_suppkey, s_name FROM supplier
    UNION ALL SELECT 'enriched', p_partkey, p_name FROM part
    UNION ALL SELECT 'scores', c_custkey, c_mktsegment FROM customer
    UNION ALL SELECT 'analytics', p_partkey, p_type FROM part
    UNION ALL SELECT 'geo', s_suppkey, CAST(s_nationkey AS VARCHAR) FROM supplier""",
)
def layout_roundtrip(spark, sf_dir):
    """Every folder of a layout, written by path and read back by URI, with the raw feeds in a folder of their own."""
    root = scratch_path(spark, "layout")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = file_system.makeQualified(hadoop_path).toString()
    written, read = Layout(f"{root}/", f"{root}/feeds/"), Layout(uri, f"{uri}/feeds")
    contents = {
        "raw": ("customer", "c_custkey", "c_name"),
        "cleaned": ("supplier", "s_suppkey", "s_name"),
        "enriched": ("part", "p_partkey", "p_name"),
        "scores": ("customer", "c_custkey", "c_mktsegment"),
        "analytics": ("part", "p_partkey", "p_type"),
        "geo": ("supplier", "s_suppkey", "CAST(s_nationkey AS STRING)"),
    }
    parts = []
    for folder, (name, key, value) in contents.items():
        rows = table(spark, sf_dir, name).selectExpr(f"CAST({key} AS BIGINT) AS key", f"{value} AS name")
        write_dataset(rows, getattr(written, folder)(name))
        parts.append(read_dataset(spark, getattr(read, folder)(name)).select(F.lit(folder).alias("folder"), "key", "name"))
    return union_all(parts)
