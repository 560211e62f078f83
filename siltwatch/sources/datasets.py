"""Readers of labelled domain datasets."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltwatch.plans.training import preprocess

# Columns of a space-separated DNS log, and of the evaluation table.
TEXT_LOG = "timestamp string, return_code string, src_ip string, dns_server string, query string, type string, answer string, size string"
EVALUATION = (
    "query string, labels array<string>, tld string, fqdn string, secondleveldomain string, thirdleveldomain string, class int"
)
DEFAULT_USER = "testbed"


def _capped(df: DataFrame, rows: int) -> DataFrame:
    """First rows of each file, when a cap is configured.

    Row order within a file follows the block it was read from.
    """
    if rows <= 0:
        return df
    order = Window.partitionBy("_file").orderBy("_at", "_id")
    numbered = df.withColumn("_id", F.monotonically_increasing_id()).withColumn("_n", F.row_number().over(order))
    return numbered.filter(F.col("_n") <= rows).drop("_n", "_id")


def _with_file(df: DataFrame) -> DataFrame:
    return df.withColumns({"_file": F.col("_metadata.file_name"), "_at": F.col("_metadata.file_block_start")})


def read_listed_domains(spark: SparkSession, path: str, cls: str = "malicious", drop: Sequence[str] = ("DGA_family", "Type")) -> DataFrame:
    """CSV with a header: ``Domain`` becomes ``query``, one class for all rows."""
    df = spark.read.csv(path, header=True).withColumnRenamed("Domain", "query").drop(*drop)
    return df.withColumn("class", F.lit(cls))


def read_family_files(spark: SparkSession, path: str, rows_per_file: int = -1) -> DataFrame:
    """CSV without a header: first column is the query, class is the file name up to '_'. All rows, unless a cap is asked for."""
    df = _capped(_with_file(spark.read.csv(path)).select(F.col("_c0").alias("query"), "_file", "_at"), rows_per_file)
    name = F.regexp_replace(F.col("_file"), r"%20", " ")
    return df.select("query", F.substring_index(name, "_", 1).alias("class"))


def read_text_logs(spark: SparkSession, path: str, rows_per_file: int = -1) -> DataFrame:
    """Space-separated log lines of legitimate traffic; a glob may name many files."""
    df = spark.read.schema(TEXT_LOG).csv(path, sep=" ")
    df = _capped(_with_file(df), rows_per_file) if rows_per_file > 0 else df
    return df.select("query", F.lit("legit").alias("class"))


def parsed_text_logs(spark: SparkSession, path: str) -> DataFrame:
    """All eight columns with a parsed time; an unreadable time is null."""
    df = spark.read.schema(TEXT_LOG).csv(path, sep=" ")
    return df.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def read_latin1_domains(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose domains are Latin-1 bytes."""
    df = spark.read.parquet(path)
    text = F.decode(F.col("domain").cast("binary"), "ISO-8859-1")
    return df.select(text.alias("query"), *[c for c in df.columns if c not in ("domain", "__index_level_0__")])


def read_user_queries(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """CSV files with an optional ``user`` column; rows are kept as they are."""

    def one(path: str) -> DataFrame:
        df = spark.read.csv(path, header=True)
        return df if "user" in df.columns else df.withColumn("user", F.lit(DEFAULT_USER))

    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [one(p) for p in paths])
    return stacked.withColumn("user", F.coalesce("user", F.lit(DEFAULT_USER)))


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON, compressed or not."""
    return spark.read.schema(EVALUATION).json(path)


# A reader takes the session, the base folder and the dataset's place below it.
Reader = Callable[[SparkSession, str, str], DataFrame]

# Default place of each dataset below the base folder; commas separate files.
LAYOUT = {
    "dgta": "dgta/dgta-benchmark.parquet",
    "bambenek": "bambenek_dga_domain.csv",
    "dga": "360_dga_domain.csv",
    "textlogs": "textlogs/*.txt",
    "dgarchive": "dgarchive/*.csv",
    "tunnel": "tunnel/combined.csv,tunnel/extra.csv",
}
DATASETS: dict[str, Reader] = {
    "dgta": lambda s, b, p: preprocess(read_latin1_domains(s, f"{b}/{p}")),
    "bambenek": lambda s, b, p: preprocess(read_listed_domains(s, f"{b}/{p}")),
    "dga": lambda s, b, p: preprocess(read_listed_domains(s, f"{b}/{p}")),
    "textlogs": lambda s, b, p: preprocess(read_text_logs(s, f"{b}/{p}")),
    "dgarchive": lambda s, b, p: preprocess(read_family_files(s, f"{b}/{p}")),
    "tunnel": lambda s, b, p: preprocess(read_user_queries(s, [f"{b}/{f}" for f in p.split(",")]), keep_all=True),
}
# Choices of the trainer.
CHOICES: Mapping[str, Sequence[str]] = {
    "combine": ("dgta", "bambenek", "dga", "textlogs", "dgarchive"),
    "dgta": ("dgta",),
    "dgarchive": ("dgarchive",),
    "tunnel": ("tunnel",),
}


def read_dataset(spark: SparkSession, base: str, name: str, layout: Mapping[str, str] | None = None) -> DataFrame:
    """One named dataset, preprocessed; ``layout`` moves datasets to other places."""
    return DATASETS[name](spark, base, {**LAYOUT, **(layout or {})}[name])


def load_dataset(spark: SparkSession, base: str, choice: str, layout: Mapping[str, str] | None = None) -> DataFrame:
    """One choice as a single table with a ``dataset`` column."""
    if choice not in CHOICES:
        raise NotImplementedError(f"dataset {choice!r}; known: {sorted(CHOICES)}")
    parts = [read_dataset(spark, base, name, layout).withColumn("dataset", F.lit(name)) for name in CHOICES[choice]]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
