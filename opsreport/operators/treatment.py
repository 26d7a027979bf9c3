"""The eight-column report that is kept per date."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsreport.sources.schema import require_columns

# Columns kept. The headings are ours; another map of the same columns can be
# given instead.
RENAME_MAP = {
    "PeriodIndex": "Data",
    "AlimentacaoPlantaReal": "Alimentação Moagem",
    "ProdutividadePlantaReal": "Produtividade",
    "TeorAlimentacaoCobreReal": "Teor Cobre",
    "TeorAlimentacaoOuroReal": "Teor Ouro",
    "RecuperacaoCobreReal": "Recuperação Cobre",
    "RecuperacaoOuroReal": "Recuperação Ouro",
    "TeorAlimentacaoPiritaReal": "Teor Pirita",
}
KEY = "PeriodIndex"
TRIGGER = "AlimentacaoPlantaReal"


def zero_row_when(df: DataFrame, trigger: str, keep: list[str]) -> DataFrame:
    """Set all columns but ``keep`` to zero in rows where the trigger is NULL or zero."""
    idle = F.col(trigger).isNull() | (F.col(trigger) == 0)

    def zeroed(name: str) -> Column:
        return F.when(idle, F.lit(0).cast(df.schema[name].dataType)).otherwise(F.col(name))

    return df.select([F.col(c) if c in keep else zeroed(c).alias(c) for c in df.columns])


def treat(
    report: DataFrame,
    strict: bool = True,
    extra: tuple[str, ...] = (),
    headings: Mapping[str, str] = RENAME_MAP,
) -> DataFrame:
    """Required columns, zeroed idle days, final names; ``extra`` columns pass through."""
    extra = tuple(c for c in extra if c in report.columns)
    require_columns(report, list(headings), strict)
    df = require_columns(report, [*extra, *headings], strict=False)
    if TRIGGER in df.columns:
        df = zero_row_when(df, TRIGGER, [*extra, KEY])
    return df.withColumnsRenamed(dict(headings))
