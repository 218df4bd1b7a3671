"""Table layouts: the raw extract, the four tables, the feature row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names of the raw extract and of the tables.
DRUGS = (
    "metformin",
    "repaglinide",
    "glimepiride",
    "glipizide",
    "glyburide",
    "pioglitazone",
    "rosiglitazone",
    "insulin",
)

RAW_TYPES = {
    "encounter_id": "bigint",
    "patient_nbr": "bigint",
    "age": "string",
    "gender": "string",
    "race": "string",
    "admission_type_id": "int",
    "discharge_disposition_id": "int",
    "time_in_hospital": "int",
    "num_lab_procedures": "int",
    "num_medications": "int",
    "number_diagnoses": "int",
    "readmitted": "string",
    "diag_1": "string",
    **{drug: "string" for drug in DRUGS},
}


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_LONG, _INT, _STR = T.LongType(), T.IntegerType(), T.StringType()

PATIENTS = _schema(
    ("patient_id", _LONG),
    ("age", _STR),
    ("gender", _STR),
    ("race", _STR),
    ("admission_type", _INT),
    ("discharge_id", _INT),
    ("created_at", T.TimestampType()),
)

ENCOUNTERS = _schema(
    ("encounter_id", _LONG),
    ("patient_id", _LONG),
    ("encounter_date", T.DateType()),
    ("length_of_stay", _INT),
    ("num_lab_procedures", _INT),
    ("num_medications", _INT),
    ("num_diagnoses", _INT),
    ("readmitted", T.BooleanType()),
    ("created_at", T.TimestampType()),
)

DIAGNOSES = _schema(
    ("diagnosis_id", _LONG),
    ("encounter_id", _LONG),
    ("icd9_code", _STR),
    ("diagnosis_group", _STR),
)

MEDICATIONS = _schema(
    ("medication_id", _LONG),
    ("encounter_id", _LONG),
    ("drug_name", _STR),
    ("dosage_change", T.BooleanType()),
)

FEATURES = _schema(
    ("encounter_id", _LONG),
    ("age", _STR),
    ("gender", _STR),
    ("race", _STR),
    ("admission_type", _INT),
    ("discharge_id", _INT),
    ("length_of_stay", _INT),
    ("num_lab_procedures", _INT),
    ("num_medications", _INT),
    ("num_diagnoses", _INT),
    ("total_prior_visits", _LONG),
    ("avg_stay_days", T.DoubleType()),
    ("avg_medications", T.DoubleType()),
    ("max_lab_procedures", _INT),
    ("days_since_last_visit", _INT),
    ("diag_readmission_rate", T.DoubleType()),
    ("medication_change_flag", _INT),
    ("readmitted", T.BooleanType()),
)

LABEL = "readmitted"
IDENTIFIERS = ("encounter_id",)
CATEGORICAL_FEATURES = ("age", "gender", "race")
NUMERIC_FEATURES = tuple(
    name for name in FEATURES.fieldNames() if name not in (LABEL, *IDENTIFIERS, *CATEGORICAL_FEATURES)
)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableDefinition:
    """A table with the constraints a database would enforce."""

    name: str
    schema: T.StructType
    primary_key: str
    foreign_keys: tuple[ForeignKey, ...] = ()
    max_lengths: tuple[tuple[str, int], ...] = ()

    def ddl(self, database: str | None = None, bucket_by: str | None = None, buckets: int = 0) -> str:
        """CREATE TABLE text for the Spark catalog, optionally bucketed."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        name = f"`{database}`.`{self.name}`" if database else f"`{self.name}`"
        clustered = f" CLUSTERED BY (`{bucket_by}`) INTO {buckets} BUCKETS" if bucket_by else ""
        return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{clustered}"


TABLES = {
    t.name: t
    for t in (
        TableDefinition(
            "patients", PATIENTS, "patient_id", max_lengths=(("age", 10), ("gender", 10), ("race", 20))
        ),
        TableDefinition(
            "encounters",
            ENCOUNTERS,
            "encounter_id",
            foreign_keys=(ForeignKey("patient_id", "patients", "patient_id"),),
        ),
        TableDefinition(
            "diagnoses",
            DIAGNOSES,
            "diagnosis_id",
            foreign_keys=(ForeignKey("encounter_id", "encounters", "encounter_id"),),
            max_lengths=(("icd9_code", 10), ("diagnosis_group", 50)),
        ),
        TableDefinition(
            "medications",
            MEDICATIONS,
            "medication_id",
            foreign_keys=(ForeignKey("encounter_id", "encounters", "encounter_id"),),
            max_lengths=(("drug_name", 50),),
        ),
    )
}
