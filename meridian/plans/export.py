"""Labelled tables for people: a declaration of what each table gains, applied as one projection, then CSV and SQLite."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions import terminology as term
from meridian.functions.text import lookup
from meridian.sources.storage import export_csv, export_sqlite

#: Labels of recoded columns: fixed values, with the label for everything else last.
GENDERS = ({"female": "Feminino", "male": "Masculino", "other": "Outro", "unknown": "Não Informado"}, "Não Informado")
DISPOSITIONS = ({"discharged_alive": "Alta Hospitalar com Vida", "expired": "Óbito Hospitalar"}, "Em Tratamento")
CLASSES = ({"EMER": "Urgência / Emergência", "IMP": "Internação Eletiva", "AMB": "Ambulatorial"}, "Outros")
RANKS = ({"primary": "Diagnóstico Principal", "secondary": "Comorbidade Secundária"}, "Não Informado")
DENGUE = "Dengue / Arbovirose"


def recoded(labels: tuple[dict[str, str], str]) -> Callable[[Column], Column]:
    return lambda c: lookup(c, labels[0], F.lit(labels[1]))


Labels = dict[str, tuple[tuple[str, ...], Callable[..., Column]]]

#: Table -> new column -> the columns it comes from and how. A label whose columns a table lacks is left out.
LABELS: dict[str, Labels] = {
    "dim_patients": {"municipality_name": (("municipality_code",), term.municipality_label), "gender_name": (("gender",), recoded(GENDERS))},
    "fct_encounters": {
        "hospital_name": (("organization_id",), term.hospital_label),
        "primary_diagnosis_name": (("primary_diagnosis_code", "primary_diagnosis_chapter"), term.diagnosis_label),
        "primary_procedure_name": (("primary_procedure_code",), term.procedure_label),
        "discharge_disposition_name": (("discharge_disposition",), recoded(DISPOSITIONS)),
        "encounter_class_name": (("encounter_class",), recoded(CLASSES)),
    },
    "fct_conditions": {"disease_name": (("code", "chapter_description"), term.diagnosis_label), "diagnosis_rank_name": (("diagnosis_rank",), recoded(RANKS))},
    "fct_procedures": {"procedure_name": (("code",), term.procedure_label)},
    "fct_referrals": {},
    "dim_health_plans": {},
    "cnes_estabelecimentos": {"hospital_name": (("CNES",), term.hospital_label), "municipality_name": (("CODUFMUN",), term.municipality_label)},
    "sia_ambulatorial": {"procedure_name": (("PA_PROC_ID",), term.procedure_label), "hospital_name": (("PA_CODUNI",), term.hospital_label), "municipality_name": (("PA_UFMUN",), term.municipality_label)},
    "sinan_agravos_dengue": {"disease_name": ((), lambda: F.lit(DENGUE)), "municipality_name": (("ID_MUNICIP",), term.municipality_label)},
    "sisab_atencao_primaria": {"municipality_name": (("CO_MUNICIPIO_IBGE",), term.municipality_label)},
}


def labelled(df: DataFrame, table: str) -> DataFrame:
    own = {name: make(*map(F.col, columns)) for name, (columns, make) in LABELS.get(table, {}).items() if set(columns) <= set(df.columns)}
    return df.withColumns(own) if own else df


def export(tables: dict[str, DataFrame | None], csv_folder: str | None = None, sqlite_path: str | None = None) -> dict[str, int]:
    """Writes the tables that are there with their labels; rows of each by name if SQLite is written."""
    made = {name: labelled(df, name) for name, df in tables.items() if df is not None}
    if csv_folder:
        export_csv(made, csv_folder)
    return export_sqlite(made, sqlite_path) if sqlite_path else {}
