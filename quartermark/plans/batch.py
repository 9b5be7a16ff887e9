"""The whole batch: raw files and register to report, statistics and tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermark.operators.aggregates import largest_first, operator_statistics
from quartermark.operators.align import align_register
from quartermark.operators.dedup import keep_largest_state
from quartermark.operators.register import keyed_register, typed_register
from quartermark.plans.consolidate import consolidate
from quartermark.plans.load import facts_of
from quartermark.plans.report import validated_report
from quartermark.schemas import EXPENSE_TABLE, REGISTER_COLUMNS
from quartermark.session import written_once
from quartermark.sources import tables
from quartermark.sources.delimited import LATIN, read_register

ARRIVAL = ["source_file", "block", "arrival"]


@dataclass(frozen=True)
class Target:
    """Where a batch run writes; each part can be read on its own."""

    root: str

    @property
    def expenses(self) -> str:
        return f"{self.root}/consolidado"

    @property
    def report(self) -> str:
        return f"{self.root}/relatorio"

    @property
    def statistics(self) -> str:
        return f"{self.root}/agregadas"

    @property
    def register(self) -> str:
        return f"{self.root}/operadoras"

    @property
    def facts(self) -> str:
        return f"{self.root}/despesas"

    @property
    def gold(self) -> str:
        return f"{self.root}/painel"


def staged_register(register: DataFrame) -> DataFrame:
    """A register under its fixed column names, whatever their order in the files.

    Files with names of their own are taken by position, if they agree on the
    columns and have as many as there should be.
    """
    names = [c for c in register.columns if c not in ARRIVAL]
    known = {n.lower(): n for n in names}
    if not set(REGISTER_COLUMNS) <= set(known):
        if len(names) != len(REGISTER_COLUMNS):
            raise ValueError(f"register has {len(names)} columns, expected {len(REGISTER_COLUMNS)}")
        known = dict(zip(REGISTER_COLUMNS, names))
    return register.select(*[F.col(f"`{known[c]}`").alias(c) for c in REGISTER_COLUMNS], *ARRIVAL)


def run_batch(
    spark: SparkSession, raw_root: str, register_path: str, target_root: str, encoding: str = LATIN
) -> Target:
    """Runs everything once. Tables that feed several results are written first."""
    target = Target(target_root)
    tables.write_table(
        consolidate(spark, raw_root, encoding).drop("source_file"),
        target.expenses,
        partitions=("Ano", "Trimestre"),
    )
    expenses = tables.read_table(spark, target.expenses, EXPENSE_TABLE)

    # Parsed once: the report's register and the dimension both read the stored rows.
    register = written_once(read_register(spark, register_path, encoding), "register-text")
    keyed = written_once(keyed_register(align_register(register, ARRIVAL), ARRIVAL), "register")
    tables.export_csv(validated_report(expenses, keyed), target.report, compressed=True)

    tables.write_table(operator_statistics(expenses, keyed), f"{target.gold}/por_estado")
    statistics = tables.read_table(spark, f"{target.gold}/por_estado")
    tables.export_csv(largest_first(statistics), target.statistics, compressed=True)
    tables.write_table(keep_largest_state(statistics), f"{target.gold}/por_operadora")

    tables.write_table(typed_register(staged_register(register), ARRIVAL), target.register)
    dimension = tables.read_table(spark, target.register)
    tables.write_table(facts_of(expenses, dimension), target.facts, partitions=("ano", "trimestre"))
    return target
