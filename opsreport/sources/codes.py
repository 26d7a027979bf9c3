"""Codes and labels found in the input tables."""

from __future__ import annotations

from dataclasses import dataclass

# Assay groups as (circuit code, location, analyte).
MOISTURE = (4, "Moagem", "Umidade Minério")
GRADES: dict[str, tuple[int, str, str]] = {
    "feed_cu": (8, "Alimentação Sag", "Cu"),
    "feed_au": (8, "Alimentação Sag", "Au"),
    "feed_s": (8, "Alimentação Sag", "S"),
    "conc_cu": (3, "Concentrado Coluna", "Cu"),
    "conc_au": (3, "Concentrado Coluna", "Au"),
    "tails_cu": (7, "Rejeito Final", "Cu"),
    "tails_au": (7, "Rejeito Final", "Au"),
}

# Grades that the stock factor of the month corrects, and that factor's name.
STOCK_FACTORS = {
    "feed_cu": "cu_feed",
    "feed_au": "au_feed",
    "conc_cu": "cu_col",
    "conc_au": "au_col",
}


@dataclass(frozen=True)
class Area:
    """One area: its code in rates and downtime, its plan label, its name in the report."""

    code: str
    plan: str
    label: str


# Areas. ``mmd`` and ``jaw`` together make up the combined crushers.
AREAS: dict[str, Area] = {
    "ipc": Area("310 BRITAGEM IPC", "Planejamento - Britagem IPC", "Ipc"),
    "mmd": Area("310 BRITAGEM MMD", "Planejamento - Britagem MMD", "Mmd"),
    "jaw": Area("310 BRITAGEM C160", "Planejamento - Britagem Mandíbula", "Mandibulas"),
    "mill": Area("330 MOAGEM", "Planejamento - Moagem", "Moagem"),
}

# KPI rows of the downtime table.
HOURS_TYPE = "1_TimeClassDuration"
KPI_TYPE = "3_KPI"
HOUR_ORDERS: dict[str, tuple[str, ...]] = {
    "available": ("1.1",),
    "used": ("1.1.1",),
    "stop_operation": ("1.1.2", "1.1.3"),
    "stop_scheduled": ("1.2.1",),
    "stop_maintenance": ("1.2.2",),
    "stop_external": ("1.2.3",),
}
KPI_ORDERS: dict[str, tuple[str, str]] = {
    "availability": ("9999.1", "Disponibilidade (%)"),
    "utilisation": ("9999.2", "Utilização (%)"),
}

# Only this plan version counts, and these plan types have a meaning of their own.
PLAN_VERSION = {"f1": 1, "f5": 4}
SHORT_TERM = 3
VERY_SHORT_TERM = 4


def scenarios(plan_type: int | None) -> dict[str, int | None]:
    """Scenario name to plan type. Without a budget type the budget matches nothing."""
    return {"budget": plan_type, "short": SHORT_TERM, "very_short": VERY_SHORT_TERM}
