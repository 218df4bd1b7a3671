"""Hospital-shaped views over the star-schema test tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.values import diagnosis_group
from wardflow.schemas import DRUGS


def source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def patients(spark: SparkSession, folder: str) -> DataFrame:
    key, low = F.col("c_custkey"), F.col("c_nationkey") % 10 * 10
    gender = F.when(key % 20 == 0, "Unknown").when(key % 2 == 0, "Female").otherwise("Male")
    return source(spark, folder, "customer").select(
        key.alias("patient_id"),
        F.concat(F.lit("["), low.cast("string"), F.lit("-"), (low + 10).cast("string"), F.lit(")")).alias("age"),
        gender.alias("gender"),
        F.when(key % 11 != 0, F.col("c_mktsegment")).alias("race"),
        (F.col("c_nationkey") % 8 + 1).cast("int").alias("admission_type"),
        (key % 28 + 1).cast("int").alias("discharge_id"),
    )


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return source(spark, folder, "orders").select(
        key.alias("encounter_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("date").alias("encounter_date"),
        (key % 14 + 1).cast("int").alias("length_of_stay"),
        F.floor(F.col("o_totalprice") / 5000).cast("int").alias("num_lab_procedures"),
        (key * 7 % 40 + 1).cast("int").alias("num_medications"),
        (F.col("o_custkey") % 9 + 1).cast("int").alias("num_diagnoses"),
        (F.col("o_orderstatus") == "F").alias("readmitted"),
    )


def diagnoses(spark: SparkSession, folder: str) -> DataFrame:
    codes = source(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("encounter_id"))
    return codes.agg(F.min("l_partkey").cast("string").alias("icd9_code")).withColumn(
        "diagnosis_group", diagnosis_group(F.col("icd9_code"))
    )


def medications(spark: SparkSession, folder: str) -> DataFrame:
    return (
        source(spark, folder, "lineitem")
        .where(F.col("l_returnflag") != "N")
        .select(
            F.col("l_orderkey").alias("encounter_id"),
            F.concat(F.lit("drug_"), F.col("l_linenumber").cast("string")).alias("drug_name"),
            (F.col("l_returnflag") == "R").alias("dosage_change"),
        )
    )


def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "patients": patients(spark, folder),
        "encounters": encounters(spark, folder),
        "diagnoses": diagnoses(spark, folder),
        "medications": medications(spark, folder),
    }


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """A label and a whole-number score with many ties; no model involved."""
    return source(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        F.floor(F.col("o_totalprice") / 500).cast("int").alias("score"),
    )


def raw_extract(spark: SparkSession, folder: str) -> DataFrame:
    """A wide text extract, one row per order, in the layout that ingest reads."""
    line = source(spark, folder, "lineitem")
    status = (
        F.when(F.col("l_returnflag") == "N", "No")
        .when(F.col("l_returnflag") == "R", F.when(F.col("l_linestatus") == "F", "Up").otherwise("Down"))
        .otherwise(F.when(F.col("l_linestatus") == "F", "Steady").otherwise("?"))
    )
    per_order = line.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_partkey").cast("string").alias("diag_1"),
        *[F.max(F.when(F.col("l_linenumber") == i + 1, status)).alias(d) for i, d in enumerate(DRUGS)],
    )
    visits = source(spark, folder, "orders").join(per_order, "o_orderkey", "left")
    rows = visits.join(
        source(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"
    )
    key = F.col("o_orderkey")
    low = key % 10 * 10
    text = {
        "encounter_id": key,
        "patient_nbr": F.col("o_custkey"),
        "age": F.concat(F.lit("["), low.cast("string"), F.lit("-"), (low + 10).cast("string"), F.lit(")")),
        "gender": F.when(key % 7 == 0, "Unknown/Invalid").when(key % 2 == 0, "Female").otherwise("Male"),
        "race": F.when(F.col("o_orderstatus") == "P", "?").otherwise(F.col("c_mktsegment")),
        "admission_type_id": key % 8 + 1,
        "discharge_disposition_id": key % 28 + 1,
        "time_in_hospital": key % 14 + 1,
        "num_lab_procedures": F.floor(F.col("o_totalprice") / 5000),
        "num_medications": key * 7 % 40 + 1,
        "number_diagnoses": F.col("o_custkey") % 9 + 1,
        "readmitted": F.when(F.col("o_orderstatus") == "F", "<30")
        .when(F.col("o_orderstatus") == "O", ">30")
        .otherwise("NO"),
        "diag_1": F.coalesce(F.col("diag_1"), F.lit("?")),
        **{d: F.coalesce(F.col(d), F.lit("No")) for d in DRUGS},
    }
    return rows.select(
        *[value.cast("string").alias(name) for name, value in text.items()],
        F.struct("o_orderdate", "o_orderkey").alias("file_order"),
    )


_GROUP_SQL = """CASE WHEN {code} IS NULL OR {code} = '?' THEN 'Unknown'
    WHEN {code} LIKE '250%' THEN 'Diabetes'
    WHEN left({code}, 2) IN ('39','40','41','42','43','44','45') THEN 'Circulatory'
    WHEN left({code}, 2) IN ('46','47','48','49','50','51') THEN 'Respiratory'
    ELSE 'Other' END"""


def group_sql(code: str) -> str:
    return _GROUP_SQL.format(code=code)


VIEWS_SQL = f"""
patients AS (SELECT c_custkey AS patient_id,
  concat('[', CAST(10*(c_nationkey % 10) AS VARCHAR), '-', CAST(10*(c_nationkey % 10)+10 AS VARCHAR), ')') AS age,
  CASE WHEN c_custkey % 20 = 0 THEN 'Unknown' WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS race,
  CAST(1 + c_nationkey % 8 AS INT) AS admission_type,
  CAST(1 + c_custkey % 28 AS INT) AS discharge_id
  FROM customer),
encounters AS (SELECT o_orderkey AS encounter_id, o_custkey AS patient_id,
  CAST(o_orderdate AS DATE) AS encounter_date,
  CAST(1 + o_orderkey % 14 AS INT) AS length_of_stay,
  CAST(floor(o_totalprice / 5000) AS INT) AS num_lab_procedures,
  CAST(1 + (o_orderkey * 7) % 40 AS INT) AS num_medications,
  CAST(1 + o_custkey % 9 AS INT) AS num_diagnoses,
  o_orderstatus = 'F' AS readmitted
  FROM orders),
codes AS (SELECT l_orderkey AS encounter_id, CAST(min(l_partkey) AS VARCHAR) AS icd9_code
  FROM lineitem GROUP BY l_orderkey),
diagnoses AS (SELECT encounter_id, icd9_code, {group_sql("icd9_code")} AS diagnosis_group FROM codes),
medications AS (SELECT l_orderkey AS encounter_id,
  concat('drug_', CAST(l_linenumber AS VARCHAR)) AS drug_name,
  l_returnflag = 'R' AS dosage_change
  FROM lineitem WHERE l_returnflag <> 'N'),
scored AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
  CAST(floor(o_totalprice / 500) AS INT) AS score
  FROM orders)
"""

_DRUG_COLUMNS_SQL = ",\n  ".join(
    f"""coalesce(max(CASE WHEN l_linenumber = {i + 1} THEN
    CASE l_returnflag WHEN 'N' THEN 'No'
      WHEN 'R' THEN CASE WHEN l_linestatus = 'F' THEN 'Up' ELSE 'Down' END
      ELSE CASE WHEN l_linestatus = 'F' THEN 'Steady' ELSE '?' END END END), 'No') AS {drug}"""
    for i, drug in enumerate(DRUGS)
)

RAW_SQL = f"""
raw AS (SELECT o.o_orderkey AS encounter_id, o.o_custkey AS patient_nbr, o.o_orderdate AS read_at,
  10 * (o.o_orderkey % 10) AS low, o.o_orderkey AS k, o.o_orderstatus AS status, o.o_totalprice AS price,
  c.c_mktsegment AS segment, l.*
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, CAST(min(l_partkey) AS VARCHAR) AS diag_1,
  {_DRUG_COLUMNS_SQL}
  FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey)
"""
