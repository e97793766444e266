"""Sources: delimited text, Parquet, id lists, ground truth, reports and requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts that mean a missing value (fixed values: the defaults of common table readers).
NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

ENTITY = T.StructType([T.StructField(c, T.StringType()) for c in ("name", "address", "country")])
REQUEST = T.StructType([T.StructField("entity_a", ENTITY), T.StructField("entity_b", ENTITY)])

#: Columns of a threshold curve and of a report (fixed values: the keys of its JSON).
CURVE = ("threshold", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "f05")
RATES = ("val_candidate_recall", "best_threshold", "val_precision", "val_recall", "val_f05", "val_singleton_accuracy")
COUNTS = ("test_s1_count", "test_resolved_matches", "test_singletons")
REPORT = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in RATES]
    + [T.StructField(c, T.LongType()) for c in COUNTS]
    + [T.StructField("top_features", T.ArrayType(T.ArrayType(T.StringType())))]
    + [T.StructField("threshold_curve", T.ArrayType(T.StructType([T.StructField(c, T.LongType() if c in ("tp", "fp", "fn", "tn") else T.DoubleType()) for c in CURVE])))]
)
#: What is shown where there is no report (fixed values; no measurements).
NO_REPORT = {
    "val_candidate_recall": 0.968, "best_threshold": 0.62, "val_precision": 0.965, "val_recall": 0.880, "val_f05": 0.941, "val_singleton_accuracy": 1.0,
    "top_features": [["name_lev", "0.32"], ["composite_sim", "0.24"], ["addr_lev", "0.18"], ["name_ngram3", "0.14"], ["num_overlap", "0.12"]],
}

#: The column that holds the place of a row in its input.
ROW_ORDER = "row_order"


def read_tsv(spark: SparkSession, path: str, na: bool = True, order: bool = False) -> DataFrame:
    """A tab-separated file with a header; every column is a string. na: texts that mean missing become null. order: a column row_order, ascending by place in the file, is added."""
    df = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', inferSchema=False, multiLine=False)
    columns = [(null_na(F.col(f"`{c}`")) if na else F.col(f"`{c}`")).alias(c) for c in df.columns]
    place = [F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias(ROW_ORDER)] if order else []
    return df.select(*columns, *place)


def read_tsv_or_empty(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """Like read_tsv without the missing-value rule; a missing file is an empty table of the given columns."""
    from pyspark.errors import AnalysisException

    try:
        return read_tsv(spark, path, na=False)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def null_na(c: Column) -> Column:
    return F.when(~c.isin(*NA), c)


def id_column(columns: list[str], wanted: str = "id") -> str:
    """The named column, else the first whose name holds "id", else the first."""
    low = {c: c.lower().strip() for c in columns}
    return next((c for c in columns if c == wanted), None) or next((c for c, k in low.items() if "id" in k), columns[0])


def entity_ids(df: DataFrame, wanted: str = "id") -> DataFrame:
    """Distinct trimmed ids; nulls are dropped."""
    return df.select(F.trim(F.col(f"`{id_column(df.columns, wanted)}`").cast("string")).alias("id")).where("id is not null").distinct()


def id_list(c: Column, lines: bool = True) -> Column:
    """The ids of a text such as "[a, b]": brackets and quotes off, split at commas, semicolons and (lines) line feeds; empty and missing texts give no ids."""
    body = F.regexp_replace(F.trim(c), r"^\[|\]$", "")
    parts = F.split(F.regexp_replace(body, "[;\n]" if lines else ";", ","), ",")
    ids = F.transform(parts, lambda x: F.regexp_replace(F.trim(x), "^['\"]+|['\"]+$", ""))
    empty = c.isNull() | F.trim(c).isin("", "[]", "None", "nan")
    return F.when(empty, F.array().cast("array<string>")).otherwise(F.filter(ids, lambda x: x != ""))


def ground_truth(df: DataFrame, order: str | None = None) -> DataFrame:
    """(s1_id, target_id), target_id null for an entity without matches.

    If a header is matched_entity_ids or matched_ids, the first two columns are an id and a list, and the last row of an
    id wins: by the column named in order, else by row_order if there is such a column, else as the rows of df come.
    Otherwise they are an id and one target, accumulated.
    """
    a, b = (F.col(f"`{c}`").cast("string") for c in df.columns[:2])
    s1 = F.trim(a)
    if any(c.lower().strip() in ("matched_entity_ids", "matched_ids") for c in df.columns):
        rank = F.col(f"`{order}`") if order else F.col(ROW_ORDER) if ROW_ORDER in df.columns else F.monotonically_increasing_id()
        last = df.select(s1.alias("s1_id"), F.struct(rank.alias("o"), b.alias("ids")).alias("r")).where("s1_id is not null").groupBy("s1_id").agg(F.max("r").alias("r"))
        return last.select("s1_id", F.explode_outer(F.array_distinct(id_list(F.col("r.ids"), lines=False))).alias("target_id"))
    pairs = df.select(s1.alias("s1_id"), F.trim(b).alias("target_id")).where("s1_id is not null")
    some = pairs.where("target_id is not null and target_id not in ('', 'nan')").distinct()
    none = pairs.select("s1_id").distinct().join(some.select("s1_id").distinct(), "s1_id", "left_anti").select("s1_id", F.lit(None).cast("string").alias("target_id"))
    return some.unionByName(none)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """An experiment report of one JSON object, as one row; the values of NO_REPORT if there is none, or none that can be read."""
    from pyspark.errors import AnalysisException

    none = spark.createDataFrame([tuple(NO_REPORT.get(f.name) for f in REPORT)], REPORT)
    try:
        found = spark.read.schema(REPORT).option("multiLine", True).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return none
    readable = found.where("best_threshold is not null").limit(1)
    return none if readable.isEmpty() else readable


def parse_requests(df: DataFrame, column: str = "request") -> DataFrame:
    """entity_a and entity_b structs of JSON texts; what is missing is empty."""
    r = F.from_json(F.col(column), REQUEST)
    side = lambda k: F.struct(*[F.coalesce(r[k][c], F.lit("")).alias(c) for c in ("name", "address", "country")]).alias(k)
    return df.select(side("entity_a"), side("entity_b"))
