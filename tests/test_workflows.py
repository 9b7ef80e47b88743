from __future__ import annotations

import pytest

from meridian.plans import workflows


def test_every_job_has_a_schedule():
    assert {w.schedule for w in workflows.WORKFLOWS.values()} <= {"@once", "@daily", "@weekly", "@monthly"}


@pytest.mark.parametrize("name, table, rows", [("regulation", "fct_referrals", 4), ("health_plans", "dim_health_plans", 5), ("fhir", "fct_conditions", 150)])
def test_jobs_reach_silver(spark, tmp_path, name, table, rows):
    out = workflows.run(spark, name, str(tmp_path), "salt")
    assert out["status"] == "success" and out["silver"][table]["rows_written"] == rows
    assert spark.read.parquet(str(tmp_path / "silver" / table)).count() == rows


def test_fallback_is_marked(spark, tmp_path):
    out = workflows.run(spark, "primary_care", str(tmp_path), "salt", path="/nowhere.csv")
    assert (out["status"], out["bronze"]["rows_written"]) == ("success_reference", 1)


def test_file_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text("CNES,CODUFMUN,LEITOS\n2001578,120040,10\n")
    out = workflows.run(spark, "facilities", str(tmp_path / "l"), "salt", path=str(tmp_path / "a.csv"))
    assert out["silver"]["dim_organizations"]["rows_written"] == 1
    with pytest.raises(FileNotFoundError):
        workflows.run(spark, "hospital", str(tmp_path / "l"), "salt", max_retries=1)
