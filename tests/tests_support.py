"""The hand-made extract that several tests load."""

from __future__ import annotations

from wardflow.schemas import DRUGS, RAW_TYPES

GIVEN = [
    # encounter, patient, age, gender, race, admission, discharge, stay, labs, meds, diagnoses, readmitted, code, drugs
    (200, 1, "[10-20)", "Female", "Caucasian", 1, 1, 2, 10, 4, 3, ">30", "250.83", {"insulin": "Up"}),
    (100, 1, "[20-30)", "Female", "?", 2, 3, 5, 40, 9, 7, "<30", "41", {"metformin": "Steady"}),
    (300, 2, "[0-10)", "Unknown/Invalid", "Asian", 3, 1, 1, 5, 2, 1, "NO", "?", {"insulin": "?"}),
]


def write_extract(path, rows=GIVEN):
    lines = [",".join(["weight", *RAW_TYPES])]  # an unused column first: columns are found by name
    for row in rows:
        *fields, drugs = row
        lines.append(",".join(["?", *map(str, fields), *[drugs.get(d, "No") for d in DRUGS]]))
    path.write_text("\n".join(lines) + "\n")
    return str(path)
