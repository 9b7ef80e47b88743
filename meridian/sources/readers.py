"""File readers: all-string rows with canonical headers; file names; the source registry; literal fallback batches."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.operators.relational import ensure_columns

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Source:
    kind: str
    format: str
    directories: tuple[str, ...] = ()
    endpoint: str = ""


#: Where sources come from.
REGISTRY = {
    "datasus_sih": Source("ftp", "dbc", ("/dissemin/publicos/SIHSUS/200801_/Dados/",)),
    "datasus_sia": Source("ftp", "dbc", ("/dissemin/publicos/SIASUS/200801_/Dados/",)),
    "datasus_cnes": Source("ftp", "dbc", ("/dissemin/publicos/CNES/200508_/Dados/",)),
    "datasus_sinan": Source("ftp", "dbc", ("/dissemin/publicos/SINAN/DADOS/PRELIM/", "/dissemin/publicos/SINAN/DADOS/FINAIS/")),
    "datasus_sisab": Source("api", "json"),
    "sisreg_regulation": Source("api_or_export", "csv"),
    "ans_data": Source("http", "csv", endpoint="https://dadosabertos.ans.gov.br"),
    "fhir_synthetic": Source("api", "json"),
}


def remote_filename(subsystem: str, year: int, month: int = 1, state: str = "AC", subgroup: str = "PA", disease: str = "DENGBR") -> str:
    yy, mm = f"{year % 100:02d}", f"{month:02d}"
    names = {"SIH": f"RD{state}{yy}{mm}.dbc", "SIA": f"{subgroup}{state}{yy}{mm}.dbc", "CNES": f"ST{state}{yy}{mm}.dbc", "SINAN": f"{disease}{yy}.dbc", "SISAB": f"SISAB_{year}_{mm}.json"}
    if subsystem.upper() not in names:
        raise ValueError(f"unknown subsystem {subsystem}")
    return names[subsystem.upper()]


def fetch_first(host: str, directories: tuple[str, ...], name: str, target: str, connect: Callable | None = None, timeout: float = 30.0) -> str:
    """Fetches the file from the first directory that has it. ``connect(host, timeout)`` gives an FTP client."""
    if connect is None:
        from ftplib import FTP

        def connect(h: str, t: float):
            client = FTP(h, timeout=t)
            client.login()
            return client

    client, failures = connect(host, timeout), []
    try:
        for directory in directories:
            path = Path(target) / name
            try:
                with path.open("wb") as f:
                    client.retrbinary(f"RETR {directory}{name}", f.write)
                return str(path)
            except Exception as e:  # the next directory may have it
                path.unlink(missing_ok=True)
                failures.append(f"{directory}: {e}")
    finally:
        client.close()
    raise RuntimeError(f"{name} is in no directory: {'; '.join(failures)}")


def probe(host: str, directory: str | None = None, connect: Callable | None = None, timeout: float = 30.0) -> bool:
    """Whether the host lets us in."""
    from ftplib import FTP

    try:
        client = (connect or (lambda h, t: FTP(h, timeout=t)))(host, timeout)
        client.login()
        if directory:
            client.cwd(directory)
        client.close()
        return True
    except Exception as e:
        log.warning("%s can't be reached: %s", host, e)
        return False


def canonical_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().upper() for c in df.columns])


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """All columns as text: codes keep their leading zeros."""
    return canonical_headers(spark.read.csv(path, header=True, inferSchema=False, sep=sep, encoding=encoding))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON records, an array or one on each line, with primitive values as text."""
    return canonical_headers(spark.read.option("multiLine", True).option("primitivesAsString", True).json(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    readers = {".csv": read_csv, ".json": read_json}
    for suffix, reader in readers.items():
        if path.endswith(suffix):
            return reader(spark, path)
    raise ValueError(f"{path} is neither CSV nor JSON")


def literal(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """VALUES."""
    return spark.createDataFrame(rows, columns)


#: Sample batches for runs without a source.
PLAN_COLUMNS = "CD_OPERADORA string, CNPJ_OPERADORA string, RAZAO_SOCIAL string, MODALIDADE_OPERADORA string, CD_MUNICIPIO_IBGE string, SG_UF string, COMPETENCIA string, NR_BENEFICIARIOS_ATIVOS int, NR_BENEFICIARIOS_IDOSOS int, DESPESA_ASSISTENCIAL_TOTAL double, SINISTRALIDADE_PCT double"


def sample_plans(spark: SparkSession, year: int = 2025) -> DataFrame:
    union, insurer = ("345678", "01234567000189", "UNIMED RIO BRANCO COOPERATIVA DE TRABALHO MEDICO", "COOPERATIVA_MEDICA"), ("412345", "09876543000121", "BRADESCO SAUDE S.A.", "SEGURADORA_ESPECIALIZADA_EM_SAUDE")
    # operator, municipality, active and elderly members, expenditure, loss ratio: fixed values
    rows = [
        (union, "120040", 48500, 5200, 14200000.0, 82.4),
        (insurer, "120040", 12800, 980, 4800000.0, 79.1),
        (union, "120020", 3400, 310, 850000.0, 75.8),
        (union, "120010", 850, 75, 190000.0, 71.2),
        (union, "120060", 320, 28, 75000.0, 68.0),
    ]
    return literal(spark, PLAN_COLUMNS, [(*op, place, "AC", f"{year}01", *rest) for op, place, *rest in rows])


REFERRAL_COLUMNS = "ID_SOLICITACAO string, CNS_PACIENTE string, CPF_PACIENTE string, NM_PACIENTE string, DT_NASC string, SEXO string, CO_MUNICIPIO_IBGE string, DT_SOLICITACAO string, DT_AUTORIZACAO string, TIPO_VAGA string, PROCEDIMENTO_SOLICITADO string, COD_ESTAB_SOLICITANTE string, COD_ESTAB_EXECUTANTE string, STATUS_REGULACAO string, GRAU_PRIORIDADE string, CRM_SOLICITANTE string, CRM_REGULADOR string"


def sample_referrals(spark: SparkSession) -> DataFrame:
    rows = [  # fixed values
        ("SOL-2025-00101", "700012345678901", "12345678901", "PACIENTE REGULACAO 1", "19800510", "M", "120020", "2025-01-02 08:30:00", "2025-01-04 14:15:00", "LEITO_UTI_ADULTO", "0303010142", "2000725", "5336171", "AUTORIZADA", "VERMELHO", "CRM-AC-1234", "CRM-AC-5678"),
        ("SOL-2025-00102", "700023456789012", "23456789012", "PACIENTE REGULACAO 2", "19650822", "F", "120040", "2025-01-05 10:00:00", "2025-01-12 11:30:00", "CONSULTA_ONCOLOGIA", "0301010072", "2000733", "2001586", "AUTORIZADA", "AMARELO", "CRM-AC-2345", "CRM-AC-5678"),
        ("SOL-2025-00103", "700034567890123", "34567890123", "PACIENTE REGULACAO 3", "19921130", "M", "120010", "2025-01-10 14:00:00", "2025-01-11 09:00:00", "LEITO_CIRURGICO", "0408050080", "2002078", "5336171", "AUTORIZADA", "VERMELHO", "CRM-AC-3456", "CRM-AC-6789"),
        ("SOL-2025-00104", "700045678901234", "45678901234", "PACIENTE REGULACAO 4", "19580415", "F", "120060", "2025-01-15 16:20:00", None, "EXAME_RESSONANCIA", "0207010064", "2000296", "2001578", "AGUARDANDO_FILA", "VERDE", "CRM-AC-4567", None),
    ]
    return literal(spark, REFERRAL_COLUMNS, rows)


def sample_primary_care(spark: SparkSession, year: int = 2025, month: int = 1) -> DataFrame:
    columns = "CO_MUNICIPIO_IBGE string, NU_COMPETENCIA string, DS_TIPO_ATENDIMENTO string, QT_ATENDIMENTOS int, QT_VISITAS_DOMICILIARES int, DS_EQUIPE_TIPO string, NU_CPF_PROFISSIONAL string, CO_CNES string, CO_INE_EQUIPE string"
    return literal(spark, columns, [("120040", f"{year}{month:02d}", "CONSULTA_MEDICA_APS", 1420, 380, "ESF", "12345678900", "2000733", "0001234567")])


def plans_or_sample(spark: SparkSession, path: str | None = None, year: int = 2025) -> DataFrame:
    df = read_records(spark, path) if path else sample_plans(spark, year)
    return ensure_columns(df, {c: "string" for c in ("CD_OPERADORA", "CD_MUNICIPIO_IBGE", "NR_BENEFICIARIOS_ATIVOS")})


def referrals_or_sample(spark: SparkSession, path: str | None = None) -> DataFrame:
    df = read_records(spark, path) if path else sample_referrals(spark)
    return ensure_columns(df, {c: "string" for c in ("ID_SOLICITACAO", "DT_SOLICITACAO", "STATUS_REGULACAO", "CO_MUNICIPIO_IBGE")})


def with_fallback(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """The primary source, read far enough to know that it can be; else the literal batch, marked as such."""
    try:
        df = primary()
        df.limit(1).count()
        return df, "success"
    except Exception as e:
        log.warning("the source failed, a reference batch stands in: %s", e)
        return fallback(), "success_reference"


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, nulls kept."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
