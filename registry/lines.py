"""Raw log lines derived from the given tables (the rules are in FIXTURES.md).

The same expressions exist for DuckDB in `oracle.py`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblens.shared import new_shared_path, spread

ACCESS_CLOCK = "date_format(ts, 'dd/MMM/yyyy:HH:mm:ss')"

ACCESS_LINE = f"""
CASE
  WHEN event_id % 97 = 0 THEN concat('noise ', event_id)
  WHEN event_id % 89 = 0 THEN concat('10.0.0.', user_id % 256, ' - - [', {ACCESS_CLOCK},
       ' +0000] "GET /', event_type, '" 408 -')
  ELSE concat('10.0.', user_id div 256, '.', user_id % 256, ' - - [', {ACCESS_CLOCK},
       ' +0000] "', CASE event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT'
       ELSE 'GET' END, ' /', event_type, '/', event_id % 13, ' HTTP/1.1" ',
       CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 500
            WHEN event_type = 'error' THEN 404
            WHEN event_id % 11 = 0 THEN 302 ELSE 200 END,
       ' ', cast(floor(value) AS bigint))
END"""

ERROR_LINE = """
concat('[', date_format(ts, 'EEE MMM dd HH:mm:ss yyyy'), '] [',
  CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'warn'
       WHEN 'click' THEN 'crit' ELSE 'notice' END, '] user ', user_id)"""

GENERIC_LINE = """
concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' ',
  CASE event_type WHEN 'error' THEN 'FATAL' WHEN 'view' THEN 'warn' ELSE 'info' END,
  ' user=', user_id, ' ', props)"""

LINE_OF = {"access.log": ACCESS_LINE, "error.log": ERROR_LINE, "app.log": GENERIC_LINE}

# Lines of a written file.
LINES_PER_FILE = 2_500
# Streams that do not tell files apart read larger logs in larger files, as logs are rotated by
# size: a batch is a few files, so the number of batches does not grow with the log.
STREAMED_FILES = 160
MOST_LINES_PER_FILE = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_lines(spark: SparkSession, sf_dir: str, *files: str) -> DataFrame:
    """`(file_path, line_no, raw)`: one line per event for each of the named files."""
    line = F.array(
        *[
            F.struct(F.lit(f).alias("file_path"), F.expr(LINE_OF[f]).alias("raw"))
            for f in files
        ]
    )
    events = spread(table(spark, sf_dir, "events"))
    return events.select(
        (F.col("event_id") + 1).alias("line_no"), F.inline(line)
    ).select("file_path", "line_no", "raw")


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(table(spark, sf_dir, "events"))
    return events.select(
        F.lit("access.log").alias("file_path"),
        (F.col("event_id") + 1).alias("line_no"),
        F.expr(ACCESS_LINE).alias("raw"),
    )


def text_lines(
    spark: SparkSession, sf_dir: str, name: str, key: str, column: str
) -> DataFrame:
    """Every line of every text of a table, each text a file of its own."""
    texts = spread(table(spark, sf_dir, name).select(key, column))
    return texts.select(
        F.concat(F.lit(f"{name}/"), F.col(key)).alias("file_path"),
        F.posexplode(F.split(column, "\n", -1)).alias("pos", "raw"),
    ).select("file_path", (F.col("pos") + 1).cast("bigint").alias("line_no"), "raw")


def prose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = text_lines(spark, sf_dir, "documents", "doc_id", "text")
    return documents.unionByName(text_lines(spark, sf_dir, "pages", "page_id", "html"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access lines out of `lineitem`, six times as many as events; used to time jobs."""
    items = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate",
            "l_returnflag", "l_quantity",
        )
    )
    clock = "date_format(l_shipdate, 'dd/MMM/yyyy:HH:mm:ss')"
    return items.select(
        F.lit("orders.log").alias("file_path"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_no"),
        F.expr(f"""
            concat('10.', l_suppkey % 200, '.', l_partkey % 250, '.7 - - [', {clock},
              ' +0000] "GET /part/', l_partkey % 5000, ' HTTP/1.1" ',
              CASE WHEN l_returnflag = 'R' THEN 500 WHEN l_returnflag = 'A' THEN 404
                   ELSE 200 END,
              ' ', cast(l_quantity AS bigint), ' "-" "client/1.0"')""").alias("raw"),
    )


def write_log_files(
    spark: SparkSession,
    sf_dir: str,
    *files: str,
    lines_per_file: int = LINES_PER_FILE,
    compression: str = "none",
) -> str:
    """Write derived lines as text files under the shared folder, in order.

    Lands in `source=<file>/part=<n>/`, each part a run of consecutive lines written by
    one task. Returns the folder.
    """
    lines = log_lines(spark, sf_dir, *files)
    part = F.floor((F.col("line_no") - 1) / lines_per_file)
    path = new_shared_path(spark, "logs")
    (
        lines.select(F.col("file_path").alias("source"), part.alias("part"), "line_no", "raw")
        .repartition("source", "part")
        .sortWithinPartitions("source", "part", "line_no")
        .select("source", "part", "raw")
        .write.partitionBy("source", "part")
        .option("lineSep", "\n")
        .option("compression", compression)
        .text(path)
    )
    return path


def streamed_lines_per_file(lines: int) -> int:
    """Lines of a file of a streamed log of so many lines."""
    return min(max(-(-lines // STREAMED_FILES), LINES_PER_FILE), MOST_LINES_PER_FILE)


def source_name(file_path):
    """`source/part` of a written file."""
    found = F.regexp_extract(file_path, r"source=([^/]+)/part=([^/]+)/", 1)
    return F.concat(found, F.lit("/"), F.regexp_extract(file_path, r"/part=([^/]+)/", 1))
