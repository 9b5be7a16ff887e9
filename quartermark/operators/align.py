"""Header alignment: many source layouts, one schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermark.schemas import HEADER_SYNONYMS


def normal_headers(headers: Sequence[str]) -> list[str]:
    return [h.strip().upper() for h in headers]


@dataclass(frozen=True)
class Layout:
    """Positions of the canonical columns in one header."""

    key: tuple[int, ...]
    date: tuple[int, ...]
    description: tuple[int, ...]
    value: tuple[int, ...]

    @property
    def problem(self) -> str | None:
        """Why files with this header cannot be used."""
        if not self.value:
            return "no_value_column"
        if not self.description:
            return "no_description_column"
        if not self.key:
            return "no_key_column"
        return None


def resolve_layout(headers: Sequence[str]) -> Layout:
    """Finds the canonical columns by name; several synonyms may be present."""
    names = normal_headers(headers)

    def positions(canonical: str) -> tuple[int, ...]:
        return tuple(names.index(s) for s in HEADER_SYNONYMS[canonical] if s in names)

    key = positions("REG_ANS")
    if not key:
        known = {s for synonyms in HEADER_SYNONYMS.values() for s in synonyms}
        coded = [i for i, n in enumerate(names) if n not in known and ("COD" in n or "CD_" in n)]
        key = tuple(coded[:1])
    return Layout(key, positions("DATA"), positions("DESC"), positions("VALOR"))


def align(df: DataFrame, layout: Layout, headers: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    """Projects one layout to ``reg_ans, data, descricao, valor`` (all text)."""

    columns = [F.col(f"`{h}`").cast("string") for h in headers]
    return df.select(*picked(layout, columns), *keep)


def picked(layout: Layout, columns: Sequence[Column]) -> list[Column]:
    """The canonical columns out of a layout's columns, by position; the first non-null one of several."""

    def pick(positions: tuple[int, ...], name: str) -> Column:
        chosen = [columns[i] for i in positions]
        return (F.coalesce(*chosen) if chosen else F.lit(None).cast("string")).alias(name)

    return [
        pick(layout.key, "reg_ans"),
        pick(layout.date, "data"),
        pick(layout.description, "descricao"),
        pick(layout.value, "valor"),
    ]


def align_frame(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Same for a table that already has named columns."""
    layout = resolve_layout([c for c in df.columns if c not in keep])
    if layout.problem:
        raise ValueError(layout.problem)
    headers = [c for c in df.columns if c not in keep]
    return align(df, layout, headers, [F.col(c) for c in keep])


def append_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# How the register file may name its columns. A name matches a rule
# if it equals one of the words, or holds all parts of one of the part lists.
REGISTER_RULES = {
    "registro_operadora": [{"equals": ["REGISTRO_OPERADORA"]}, {"parts": [["REGISTRO", "OPERADORA"]], "never": "DATA"}],
    "cnpj": [{"parts": [["CNPJ"]]}],
    "razao_social": [{"parts": [["RAZAO"], ["NOME"]]}],
    "modalidade": [{"parts": [["MODALIDADE"]]}],
    "uf": [{"equals": ["UF"], "parts": [["ESTADO"], ["SIGLA"]]}],
}


def rule_matches(name: str, rule: dict) -> bool:
    if rule.get("never") and rule["never"] in name:
        return False
    return name in rule.get("equals", ()) or any(all(p in name for p in parts) for parts in rule.get("parts", ()))


def resolve_register(headers: Sequence[str]) -> dict[str, str]:
    """Canonical name to actual header; an earlier rule wins, then the earlier column."""
    found = {}
    for canonical, rules in REGISTER_RULES.items():
        matches = [h for rule in rules for h, n in zip(headers, normal_headers(headers)) if rule_matches(n, rule)]
        if matches:
            found[canonical] = matches[0]
    if "registro_operadora" not in found:
        raise ValueError("no register number column")
    return found


def align_register(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The five register columns the report needs; absent ones become null."""
    found = resolve_register([c for c in df.columns if c not in keep])
    names = ("registro_operadora", "cnpj", "razao_social", "modalidade", "uf")
    picked = [
        (F.col(f"`{found[n]}`") if n in found else F.lit(None)).cast("string").alias(n) for n in names
    ]
    return df.select(*picked, *keep)
