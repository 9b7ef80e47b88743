"""Declarative validation: rows are split into valid and rejected without being looked at twice by the driver."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FHIR_TYPES = ("Patient", "Organization", "Encounter", "Condition", "Observation", "Procedure")


class Result(NamedTuple):
    valid: DataFrame
    rejected: DataFrame
    stats: dict

    def counts(self) -> dict:
        """The stats with row counts; runs the plans."""
        valid, rejected = self.valid.count(), self.rejected.count()
        if not valid + rejected:
            return {"reason": "DataFrame vazio"} | self.stats | {"total": 0, "valid": 0, "rejected": 0}
        return self.stats | {"total": valid + rejected, "valid": valid, "rejected": rejected}


@dataclass(frozen=True)
class Rules:
    """What a source must have. ``any_of``: one of these columns; ``keys``: columns that may not be null; ``allowed``:
    a column's whitelist."""

    required: tuple[str, ...] = ()
    any_of: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def missing(self, columns: list[str]) -> list[str]:
        out = [c for c in self.required if c not in columns]
        return out if not self.any_of or any(c in columns for c in self.any_of) else [*out, self.any_of[0]]

    def holds(self) -> Column:
        out = F.lit(True)
        for c in self.keys:
            out = out & F.col(c).isNotNull()
        for c, values in self.allowed.items():
            out = out & F.coalesce(F.col(c).isin(*values), F.lit(False))
        return out


RULES = {
    "datasus_sih": Rules(required=("N_AIH", "ANO_CMPT", "MES_CMPT", "PROC_REA")),
    "datasus_sia": Rules(any_of=("PA_PROC_ID", "AP_PRID", "PA_CODUNI", "PA_MES_CMPT")),
    "datasus_cnes": Rules(required=("CNES", "CODUFMUN")),
    "datasus_sinan": Rules(required=("NU_NOTIFIC", "DT_NOTIFIC", "ID_MUNICIP")),
    "datasus_sisab": Rules(required=("CO_MUNICIPIO_IBGE", "NU_COMPETENCIA")),
    "fhir_synthetic": Rules(required=("resourceType", "id"), allowed={"resourceType": FHIR_TYPES}),
    "sisreg_regulation": Rules(required=("ID_SOLICITACAO", "DT_SOLICITACAO", "STATUS_REGULACAO", "CO_MUNICIPIO_IBGE"), keys=("ID_SOLICITACAO",)),
    "ans_data": Rules(required=("CD_OPERADORA", "CD_MUNICIPIO_IBGE", "NR_BENEFICIARIOS_ATIVOS"), keys=("CD_OPERADORA",)),
}


def validate(df: DataFrame, source_type: str, rules: dict[str, Rules] = RULES) -> Result:
    """Splits df. A missing column rejects all rows; an unknown source accepts all."""
    own = rules.get(source_type, Rules())
    if missing := own.missing(df.columns):
        return Result(df.limit(0), df, {"reason": f"Missing columns: {missing}"})
    ok = own.holds()
    return Result(df.filter(ok), df.filter(~ok), {})
