"""Financial-statement files (SRC-3, SRC-4).

Tables, document types and years differ in layout, yet all their files are read by one
scan: rows come as arrays of fields, and each file's own header line, a row of a side
table keyed by file, says where its columns stand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuerlake.sources.seeds import LATIN, file_position, text_schema

COLUMNS = ["CD_CVM", "DT_REFER", "ORDEM_EXERC", "CD_CONTA", "DS_CONTA", "VL_CONTA"]

# How published files and filtered landing files are named, and the place of each part in the pattern.
_PUBLISHED = r"(dfp|itr)_cia_aberta_(BPA|BPP|DRE|DFC_MD|DFC_MI|DVA)_(con|ind)_([0-9]{4})\.csv$"
_LANDED = r"/(dfp|itr)/([0-9]{4})/(?:[^/]+/)*(BPA|BPP|DRE|DFC_MD|DFC_MI|DVA)_(con|ind)\.csv$"
_PUBLISHED_PARTS = {"doc_type": 1, "table": 2, "scope": 3, "year": 4}
_LANDED_PARTS = {"doc_type": 1, "year": 2, "table": 3, "scope": 4}

#: Fields of a row that are looked at; published layouts have up to 14.
WIDTH = 32
#: Files whose headers are sent to all tasks, at most; more are joined.
FILES_SENT = 10_000


def describe_files(files: DataFrame, landed: bool = False, path: str = "path") -> DataFrame:
    """``path`` with document type, table, scope and year, as a file name tells them; other files go."""
    pattern = "(?i)" + (_LANDED if landed else _PUBLISHED)
    name = F.url_decode(F.regexp_replace(path, r"\+", "%2B"))
    parts = {c: F.regexp_extract(name, pattern, k) for c, k in (_LANDED_PARTS if landed else _PUBLISHED_PARTS).items()}
    found = files.where(name.rlike(pattern)).select(F.col(path).alias("path"), *[c.alias(k) for k, c in parts.items()])
    return found.select(
        "path", F.upper("doc_type").alias("doc_type"), F.upper("table").alias("table"), F.lower("scope").alias("scope"), F.col("year").cast("int").alias("year")
    )


def preferred_files(described: DataFrame) -> DataFrame:
    """Consolidated files; individual ones only where a document type, table and year has no consolidated file."""
    key = ["doc_type", "table", "year"]
    best = F.rank().over(Window.partitionBy(*key).orderBy("scope"))  # "con" sorts before "ind"
    known = described.dropna(subset=[*key, "scope"])
    return known.withColumn("_rank", best).where("_rank = 1").select(*key, "scope", *[c for c in described.columns if c not in (*key, "scope")])


def statement_files(spark: SparkSession, path: str, landed: bool = False) -> list[str]:
    """Paths of the files to read, chosen by names alone: what is not chosen is never opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(path).select("path")
    return sorted(r["path"] for r in preferred_files(describe_files(listing, landed)).collect())


def map_columns(rows: DataFrame, file: str = "file_path", fields: str = "fields", send: bool = False) -> DataFrame:
    """Rows of many files, as arrays of fields with their header lines among them, to named columns.

    A line that holds all ``COLUMNS`` is its file's header. Rows of a file without one
    raise an error rather than shift columns; fields beyond a short row are null.
    ``send`` broadcasts the headers: for a known, bounded number of files.
    """
    is_header = F.forall(F.array(*[F.lit(c) for c in COLUMNS]), lambda c: F.coalesce(F.array_contains(fields, c), F.lit(False)))
    headers = rows.where(is_header).groupBy(F.col(file).alias("_file")).agg(
        F.min(F.struct(*[F.array_position(fields, c).cast("int").alias(c) for c in COLUMNS])).alias("_at")
    )
    joined = rows.where(~is_header).join(F.broadcast(headers) if send else headers, F.col(file) == F.col("_file"), "left")
    missing = F.raise_error(F.concat(F.lit("no header line in "), F.col(file))).cast("string")
    named = [F.when(F.col("_at").isNull(), missing).otherwise(F.try_element_at(F.col(fields), F.col(f"_at.{c}"))).alias(c) for c in COLUMNS]
    return joined.select(*named, *[c for c in rows.columns if c != fields])


def read_statements(spark: SparkSession, path: str, landed: bool = False) -> DataFrame:
    """SRC-3, SRC-4: statement rows as text with document type, table, scope, year and file position.

    ``landed`` reads the filtered landing layout (``dfp/2024/filtrado/BPA_con.csv``,
    comma, UTF-8) instead of the published one. One plan reads all tables.
    """
    files = statement_files(spark, path, landed)
    if not files:
        raise FileNotFoundError(f"no statement files under {path}")
    options = {} if landed else {k: v for k, v in LATIN.items() if k in ("sep", "encoding", "quote")}
    names = [f"_c{i}" for i in range(WIDTH)]
    scan = spark.read.options(**options).option("header", False).csv(files, schema=text_schema(*names))
    rows = map_columns(scan.select(F.array(*names).alias("fields"), *file_position()), send=len(files) <= FILES_SENT)
    pattern = "(?i)" + (_LANDED if landed else _PUBLISHED)
    part = {c: F.regexp_extract("file_path", pattern, k) for c, k in (_LANDED_PARTS if landed else _PUBLISHED_PARTS).items()}
    return rows.select(
        *COLUMNS, F.upper(part["doc_type"]).alias("doc_type"), F.upper(part["table"]).alias("table"),
        F.lower(part["scope"]).alias("scope"), part["year"].cast("int").alias("year"), "file_path", "block_start", "row_id",
    )
