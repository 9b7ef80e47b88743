"""A notebook of the reports: one cell of prose and one of code for each, over the exported tables."""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable

from meridian.plans import analytics

#: Title, report, and the silver tables that it takes.
REPORTS: tuple[tuple[str, Callable, tuple[str, ...]], ...] = (
    ("Key figures", analytics.global_kpis, ("encounters",)),
    ("Kinds of admission", analytics.class_share, ("encounters",)),
    ("Chapters with most admissions", analytics.top_chapters, ("encounters",)),
    ("Most lethal diagnoses", analytics.lethal_diagnoses, ("encounters",)),
    ("Costliest diagnoses", analytics.costly_diagnoses, ("encounters",)),
    ("Concentration of hospitals", analytics.hospital_concentration, ("encounters",)),
    ("Readmissions", analytics.readmissions, ("encounters",)),
    ("Patients of several hospitals", analytics.multi_hospital, ("encounters",)),
    ("Occupancy", analytics.occupancy, ("encounters", "organizations")),
    ("Avoidable admissions", analytics.avoidable, ("encounters",)),
    ("Modes of birth", analytics.birth_modes, ("encounters",)),
    ("Long stays", analytics.long_stays, ("encounters",)),
    ("Dispositions", analytics.dispositions, ("encounters",)),
)


def _cell(kind: str, text: str) -> dict:
    cell: dict = {"cell_type": kind, "metadata": {}, "source": text.splitlines(keepends=True)}
    return cell | ({"execution_count": None, "outputs": []} if kind == "code" else {})


def notebook(silver_path: str, title: str = "Hospital care") -> dict:
    """The notebook's JSON, version 4 of the format. Its code reads the silver tables and calls the report library."""
    names = {"encounters": "fct_encounters", "organizations": "dim_organizations"}
    setup = ["from pyspark.sql import SparkSession", "from meridian.plans import analytics", "", "spark = SparkSession.builder.getOrCreate()"]
    setup += [f"{name} = spark.read.parquet({f'{silver_path}/{table}'!r})" for name, table in names.items()]
    cells = [_cell("markdown", f"# {title}"), _cell("code", "\n".join(setup))]
    for heading, report, takes in REPORTS:
        told = inspect.getdoc(report)
        cells += [_cell("markdown", f"## {heading}" + (f"\n{told}" if told else "")), _cell("code", f"analytics.{report.__name__}({', '.join(takes)}).show(truncate=False)")]
    return {"cells": cells, "metadata": {"kernelspec": {"name": "python3", "display_name": "Python 3"}, "language_info": {"name": "python"}}, "nbformat": 4, "nbformat_minor": 4}


def write_notebook(path: str, silver_path: str, title: str = "Hospital care") -> int:
    """Writes it and returns its number of cells."""
    made = notebook(silver_path, title)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(made, f, ensure_ascii=False, indent=1)
    return len(made["cells"])
