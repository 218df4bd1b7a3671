"""The feature table kept up to date after appends: a batch reads and recomputes only what it touches.

A folder holds three kinds of state, published together by one manifest per batch (``sources.snapshots``):

``history``  one row per patient: snapshot columns, sums, counts and maxima of the visits, the last visit.
             All of these merge, so a batch's own aggregates are added to the stored row.
``visits``   one row per encounter and diagnosis: the encounter, its previous visit, its medication flag.
``rates``    encounters and readmissions per diagnosis group.

History and visits are stored in buckets of patients. A batch reads the history of the buckets that hold its
patients, and writes those again. Its visits are added as new parts: the previous visit of a patient's
first new visit is the stored last one. Stored visits are read only in buckets where a new
visit lies before a stored one, and there only such patients are dated anew; buckets of many
parts are written as one on that occasion.

What a batch changes in the rows of others (a patient's history on earlier visits, the rate of a group) is
joined in when the features are read, so no stored row goes stale.

Defined results: equal to ``build_features`` over all batches. A visit whose patient is not known yet is kept and
appears when the patient does; a visit without a patient counts for the rates only. The first snapshot of a patient
stays. A diagnosis or medication must come with its encounter, else the batch raises and changes nothing;
an encounter that an earlier batch brought is the loader's to refuse. A batch that is there already changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.numbers import rate_percent, ratio_half_up
from wardflow.operators.rates import diagnosis_rates, medication_flags
from wardflow.operators.skew import hot_keys, lookup_join, skew_join
from wardflow.operators.visits import previous_visit
from wardflow.plans.features import PREVIOUS, finished
from wardflow.session import _path, durable, work_tables
from wardflow.sources.snapshots import Snapshot, publish, read_batch, snapshot

BUCKETS = 256
# A bucket with so many parts of visits is written as one part when a batch touches it.
MERGE_PARTS = 16

SNAPSHOT = ("age", "gender", "race", "admission_type", "discharge_id")
HISTORY = (
    "patient_id long, snapshot struct<age: string, gender: string, race: string, admission_type: int, discharge_id: int>, "
    "visits long, stay long, stays long, drugs long, drug_counts long, most_labs int, "
    "last struct<missing: boolean, date: date, id: long>"
)
VISITS = (
    "encounter_id long, patient_id long, encounter_date date, length_of_stay int, num_lab_procedures int, "
    f"num_medications int, num_diagnoses int, readmitted boolean, {PREVIOUS} date, med_change_flag int, diagnosis_group string"
)
RATES = "diagnosis_group string, total_encounters long, readmissions long"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("patient_id"), F.lit(buckets)).cast("int")


def _place() -> Column:
    """Order of a patient's visits: by date, missing dates last, then by id."""
    date = F.col("encounter_date")
    return F.struct(date.isNull().alias("missing"), date.alias("date"), F.col("encounter_id").alias("id"))


def _read(spark: SparkSession, folder: str, state: Snapshot, kind: str, schema: str, buckets: Iterable[int] | None = None) -> DataFrame:
    """Stored rows of some buckets (default: all); other buckets' files are not opened."""
    if buckets is None:
        names = [name for name in state.parts if name.split("/")[0] == kind]
    else:
        names = [f"{kind}/{b}" for b in buckets]
    paths = [f"{folder}/{part}" for name in names for part in state.parts.get(name, [])]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _write(df: DataFrame, folder: str, part: str, buckets: int) -> dict[int, str]:
    """Write rows by bucket; a bucket that one patient fills is split over tasks. Returns the part of each bucket."""
    spread = df.withColumn("bucket", _bucket(buckets)).hint("rebalance", F.col("bucket"))
    spread.write.partitionBy("bucket").parquet(f"{folder}/{part}")
    found, system = _path(df.sparkSession, f"{folder}/{part}")
    names = [status.getPath().getName() for status in system.listStatus(found)]
    return {int(n.removeprefix("bucket=")): f"{part}/{n}" for n in names if n.startswith("bucket=")}


def _refuse_strays(tables: Mapping[str, DataFrame]) -> None:
    known = tables["encounters"].select("encounter_id")
    for name in ("diagnoses", "medications"):
        own = tables[name].select("encounter_id").distinct()
        stray = own.join(known, "encounter_id", "left_anti").limit(3).collect()
        if stray:
            raise ValueError(f"{name} of encounters outside the batch, such as {[r['encounter_id'] for r in stray]}")


def _merged_history(stored: DataFrame, encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """The stored rows of patients with the batch added."""
    seen = encounters.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("visits"),
        F.sum("length_of_stay").alias("stay"),
        F.count("length_of_stay").alias("stays"),
        F.sum("num_medications").alias("drugs"),
        F.count("num_medications").alias("drug_counts"),
        F.max("num_lab_procedures").alias("most_labs"),
        F.max(_place()).alias("last"),
    )
    known = patients.select("patient_id", F.struct(*SNAPSHOT).alias("snapshot"))
    rows = stored.withColumn("rank", F.lit(1)).unionByName(known.withColumn("rank", F.lit(0)), allowMissingColumns=True)
    rows = rows.unionByName(seen, allowMissingColumns=True)
    sums = [F.sum(c).alias(c) for c in ("visits", "stay", "stays", "drugs", "drug_counts")]
    return rows.groupBy("patient_id").agg(
        F.max_by("snapshot", F.when(F.col("snapshot").isNotNull(), F.col("rank"))).alias("snapshot"),
        *sums, F.max("most_labs").alias("most_labs"), F.max("last").alias("last"),
    )


def _batch_visits(tables: Mapping[str, DataFrame], encounters: DataFrame, turns: DataFrame) -> DataFrame:
    """The batch's rows of ``visits``, dated after the stored last visit of each patient."""
    hot = hot_keys(encounters, "patient_id")
    dated = skew_join(previous_visit(encounters, PREVIOUS, hot), turns, "patient_id", "left", hot)
    first = F.col("encounter_id") == F.col("first.id")
    dated = dated.withColumn(PREVIOUS, F.when(first, F.col("last.date")).otherwise(F.col(PREVIOUS)))
    flagged = dated.join(medication_flags(tables["medications"]), "encounter_id", "left")
    groups = tables["diagnoses"].select("encounter_id", "diagnosis_group")
    return skew_join(groups, flagged, "encounter_id", "right").to(_schema(encounters, VISITS))


def _schema(df: DataFrame, text: str):
    return df.sparkSession.createDataFrame([], text).schema


def _dated_anew(rows: DataFrame, late: DataFrame) -> DataFrame:
    """Find the previous visit again for the patients in ``late``; all other rows stay as they are."""
    marked = durable(skew_join(rows, late.withColumn("late", F.lit(True)), "patient_id", "left"), "marked")
    again = marked.where("late").drop("late")
    visits = again.select("encounter_id", "patient_id", "encounter_date").distinct()
    dates = previous_visit(visits, PREVIOUS).select("encounter_id", PREVIOUS)
    redone = skew_join(again.drop(PREVIOUS), dates, "encounter_id")
    return marked.where("late IS NULL").drop("late").unionByName(redone)


def update_features(
    spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], batch: str, buckets: int = BUCKETS
) -> Snapshot:
    """Add a batch's patients, encounters, diagnoses and medications to the state in ``folder``."""
    base = snapshot(spark, folder)
    if batch in base.batches:
        return base
    if any(rows["buckets"] != buckets for rows in base.batches.values()):
        raise ValueError(f"{folder} has another number of buckets")
    _refuse_strays(tables)
    unique, parts = f"_data/{uuid.uuid4().hex}", {n: list(p) for n, p in base.parts.items()}
    with work_tables(spark):
        everyone = tables["encounters"].drop("created_at")
        patients = tables["patients"].select("patient_id", *SNAPSHOT)
        encounters = durable(everyone.where(F.col("patient_id").isNotNull()), "encounters")
        ids = encounters.select("patient_id").unionByName(patients.select("patient_id"))
        touched = [r[0] for r in ids.select(_bucket(buckets)).distinct().collect()]  # at most ``buckets``
        stored = _read(spark, folder, base, "history", HISTORY, touched)

        firsts = encounters.groupBy("patient_id").agg(F.min(_place()).alias("first"))
        turns = durable(firsts.join(stored.select("patient_id", "last"), "patient_id", "left"), "turns")
        late = turns.where(F.col("last") > F.col("first")).select("patient_id")
        behind = {r[0] for r in late.select(_bucket(buckets)).distinct().collect()}  # at most ``buckets``
        rewritten = behind | {b for b in touched if len(parts.get(f"visits/{b}", [])) >= MERGE_PARTS}

        visits = _batch_visits(tables, encounters, turns)
        if rewritten:
            visits = visits.unionByName(_read(spark, folder, base, "visits", VISITS, sorted(rewritten)))
        if behind:
            visits = _dated_anew(durable(visits, "visits"), late)
        for bucket, part in _write(visits, folder, f"{unique}/visits", buckets).items():
            kept = [] if bucket in rewritten else parts.get(f"visits/{bucket}", [])
            parts[f"visits/{bucket}"] = [*kept, part]
        history = _merged_history(stored, encounters, patients)
        for bucket, part in _write(history, folder, f"{unique}/history", buckets).items():
            parts[f"history/{bucket}"] = [part]

        counts = diagnosis_rates(everyone, tables["diagnoses"]).drop("readmission_rate_pct")
        counts = _read(spark, folder, base, "rates", RATES).unionByName(counts)
        counts = counts.groupBy("diagnosis_group").agg(*[F.sum(c).alias(c) for c in ("total_encounters", "readmissions")])
        counts.write.parquet(f"{folder}/{unique}/rates")
        parts["rates"] = [f"{unique}/rates"]
        report = {"buckets": buckets, "touched": len(touched), "rewritten": len(rewritten)}
    state = Snapshot(base.version + 1, parts, {**base.batches, batch: report})
    publish(spark, folder, state)
    return state


def follow(spark: SparkSession, tables_folder: str, folder: str, buckets: int = BUCKETS) -> Snapshot:
    """Bring the state up to the published loads of ``tables_folder``, one batch after another.

    A job that stops goes on at the first batch that is not in the state.
    """
    done = snapshot(spark, folder)
    for batch in snapshot(spark, tables_folder).batches:
        if batch not in done.batches:
            done = update_features(spark, folder, read_batch(spark, tables_folder, batch), batch, buckets)
    return done


def current_features(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The feature table of the published state, or of an earlier version."""
    state = snapshot(spark, folder, version)
    history = _read(spark, folder, state, "history", HISTORY).where(F.col("snapshot").isNotNull())
    history = history.select(
        "patient_id",
        "snapshot.*",
        F.col("visits").alias("total_prior_visits"),
        ratio_half_up(F.col("stay"), F.col("stays")).alias("avg_stay_days"),
        ratio_half_up(F.col("drugs"), F.col("drug_counts")).alias("avg_medications"),
        F.col("most_labs").alias("max_lab_procedures"),
    )
    rows = skew_join(_read(spark, folder, state, "visits", VISITS), history, "patient_id")
    rates = _read(spark, folder, state, "rates", RATES).select(
        "diagnosis_group", rate_percent(F.col("readmissions"), F.col("total_encounters")).alias("readmission_rate_pct")
    )
    return finished(lookup_join(rows, rates, "diagnosis_group"))
