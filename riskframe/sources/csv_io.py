"""CSV sources and sinks (S1-S3) with explicit schemas.

Reads never infer types (``inferSchema`` scans the data twice and guesses);
the schema is declared and ``FAILFAST`` turns a malformed row into an error
instead of silent NULLs.  Writes go to a directory of part files - one per
task - so a sink scales with the cluster; there is no single-file collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from riskframe.roles import APPLICATION_ROLES

_NUM_TYPES = {"total_price": DoubleType(), "acct_balance": DoubleType(), "n_lines": LongType(), "qty": DoubleType(),
              "max_discount": DoubleType(), "max_tax": DoubleType(), "cust_orders": LongType()}

APPLICATION_SCHEMA = StructType(
    [StructField("app_id", LongType())]
    + [StructField(c, _NUM_TYPES[c]) for c in APPLICATION_ROLES.numeric]
    + [StructField(c, StringType()) for c in APPLICATION_ROLES.categorical]
    + [StructField("class", IntegerType())])

# The raw credit-application layout, 20 features in file order, label last
# (names are ours; the source file addresses columns by position).
CREDIT_COLUMNS = [
    ("checking_status", "string"), ("duration_months", "int"), ("credit_history", "string"), ("purpose", "string"),
    ("credit_amount", "int"), ("savings", "string"), ("employment_since", "string"), ("installment_rate", "int"),
    ("personal_status", "string"), ("other_debtors", "string"), ("residence_since", "int"), ("property", "string"),
    ("age_years", "int"), ("other_plans", "string"), ("housing", "string"), ("existing_credits", "int"),
    ("job", "string"), ("dependents", "int"), ("telephone", "string"), ("foreign_worker", "string"),
    ("class", "int")]
CREDIT_SCHEMA = ", ".join(f"{n} {t}" for n, t in CREDIT_COLUMNS)


def read_csv(spark: SparkSession, path: str, schema, header: bool = True, mode: str = "FAILFAST",
             sep: str = ",") -> DataFrame:
    """Header CSV scan with a declared schema."""
    return (spark.read.schema(schema).option("header", header).option("mode", mode).option("sep", sep)
            .csv(path))


def read_credit_csv(spark: SparkSession, path: str, key: str = "row_id") -> DataFrame:
    """S1 for the raw credit file: typed columns, label last, plus a row key.

    The key is ``monotonically_increasing_id`` of the scan - unique and
    stable for a given file set, with no shuffle or global sort."""
    return read_csv(spark, path, CREDIT_SCHEMA).withColumn(key, F.monotonically_increasing_id())


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """Result table -> CSV directory with a header and no index column."""
    df.write.mode(mode).option("header", header).csv(path)


def concat_by_key(features: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """S3: features ++ target, aligned by key (positional alignment has no
    meaning on partitioned data).  Both sides are partitioned on the key by
    the join; a target side that is a key + one column is usually small
    enough for AQE to broadcast."""
    return features.join(target, key)
