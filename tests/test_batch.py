"""One run from files to every result."""

from decimal import Decimal as D

import pytest

from quartermark.operators import serving
from quartermark.plans.batch import run_batch
from quartermark.schemas import REGISTER_COLUMNS, REPORT_COLUMNS, STAGED_STATISTICS
from quartermark.sources.delimited import read_staged


def register_line(number, cnpj, name, uf):
    cells = [number, cnpj, name, "", "Medicina", "Rua", "1", "", "Centro", "Cidade", uf, "1234", "11", "3", "", "", "", "", "1", "2020-01-31"]
    return ";".join(cells) + "\n"


@pytest.fixture(scope="module")
def target(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("batch")
    raw, register = root / "raw" / "2025" / "1T", root / "register"
    raw.mkdir(parents=True)
    register.mkdir()
    (raw / "a.csv").write_bytes(
        "DATA;REG_ANS;DESCRICAO;VL_SALDO_FINAL\n"
        "2025-01-05;1;Despesas com Eventos;1.000,50\n"
        "2025-04-05;1;Despesas com Eventos;2.000,50\n"
        "x;2;Despesas com Eventos;-5,00\n"
        "x;3;Despesas com Eventos;10,00\n"
        "x;4;Outra despesa;10,00\n".encode("latin-1")
    )
    (register / "cadop.csv").write_bytes(
        (
            ";".join(c.upper() for c in REGISTER_COLUMNS) + "\n"
            + register_line("1", "11222333000181", "Saúde Alfa", "SP")
            + register_line("000001", "11222333000182", "Repetida", "RJ")
            + register_line("2", "9", "Beta", "RJ")
        ).encode("latin-1")
    )
    return run_batch(spark, str(root / "raw"), str(register), str(root / "out"))


def test_tables(spark, target, rows):
    assert spark.read.parquet(target.expenses).count() == 4
    register = spark.read.parquet(target.register)
    assert register.columns == list(REGISTER_COLUMNS)
    assert rows(register.select("registro_operadora", "razao_social", "cep")) == [
        ("000001", "Saúde Alfa", "00001234"), ("000002", "Beta", "00001234"),
    ]
    facts = spark.read.parquet(target.facts)
    assert rows(facts.select("registro_operadora", "ano", "trimestre", "valor_despesas")) == [
        ("000001", 2025, "1T", D("1000.50")), ("000001", 2025, "2T", D("2000.50")),
    ]


def test_exports(spark, target):
    report = spark.read.option("sep", ";").option("header", True).csv(target.report)
    assert report.columns == list(REPORT_COLUMNS) and report.count() == 4
    flags = {r["REG_ANS"]: r["FLAG_CNPJ_INVALIDO"] for r in report.collect()}
    assert flags == {"1": "false", "2": "true", "3": "true"}
    statistics = read_staged(spark, target.statistics, STAGED_STATISTICS).collect()
    assert [tuple(r) for r in statistics] == [
        ("Saúde Alfa", "SP", "3001.00", "1500.50", "707.11"),
        ("RAZAO SOCIAL NAO LOCALIZADA", "INDETERMINADO", "10.00", "10.00", "0.00"),
    ]


def test_views_read_the_stored_tables(spark, target):
    gold = spark.read.parquet(f"{target.gold}/por_operadora")
    assert tuple(serving.dashboard_totals(gold).first()) == (D("3011.00"), D("1505.50"))
    history = serving.expense_history(spark.read.parquet(target.facts), "1").collect()
    assert [r["trimestre"] for r in history] == ["2T", "1T"]


def test_archives_give_what_their_files_give(spark, tmp_path, rows):
    import zipfile

    from quartermark.plans.consolidate import write_bronze

    files = {
        "2025/1T/a.csv": "REG_ANS;DESC;VALOR\n1;despesa com evento;1,50\n2;despesa com evento;2.000,00\n",
        "2024/2T/b.txt": "CD_OPERADORA,NM_CONTA,SALDO_FINAL\n3,despesa com evento,4.25\n",
    }
    for name, text in files.items():
        plain = tmp_path / "plain" / name
        plain.parent.mkdir(parents=True)
        plain.write_bytes(text.encode("latin-1"))
        archive = tmp_path / "zipped" / f"{name.rsplit('/', 1)[0]}.zip"
        archive.parent.mkdir(parents=True)
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(name.rsplit("/", 1)[1], text.encode("latin-1"))
    (tmp_path / "zipped" / "broken.zip").write_bytes(b"no archive")
    from quartermark.plans.consolidate import consolidate

    columns = ["REG_ANS", "Ano", "Trimestre", "ValorDespesas"]
    plain = consolidate(spark, str(tmp_path / "plain")).select(*columns)
    assert rows(plain) == rows(consolidate(spark, str(tmp_path / "zipped")).select(*columns)) and plain.count() == 3
    bronze, scan = write_bronze(spark, str(tmp_path / "zipped"))
    assert [(r["source_file"].rsplit("/", 1)[1], r["motivo"]) for r in scan.skipped(bronze).collect()] == [("broken.zip", "damaged_archive")]
