"""The columns of the daily report, generated from a measure x area x scenario catalogue.

Input columns are those that ``report.day_facts`` assembles. Every block is a list of
(report name, expression) and ends up in one ``select``, so an expression always sees
the input column and never a column of the same report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsreport.functions import metrics as M
from opsreport.functions.clean import DEFAULT_SCHEDULED_SHARE, or_zero, ratio
from opsreport.operators.accumulate import MEASURES
from opsreport.sources.codes import AREAS

Named = list[tuple[str, Column]]

# Scenario suffixes of the report.
SCENARIO_SUFFIX = {"budget": "Orcado", "short": "CurtoPrazo", "very_short": "CurtissimoPrazo"}
ACTUAL_SUFFIX = "Real"
# Words that the report names are made of.
COMBINED = "Britagens"
METALS = {"cu": "Cobre", "au": "Ouro"}
STREAMS = {"feed": "Alimentacao", "conc": "Concentrado", "tails": "Rejeito"}
CRUSHERS = ("ipc", "mmd", "jaw")


def _label(area: str) -> str:
    return COMBINED if area == "combined" else AREAS[area].label


def _grade_name(measure: str) -> str:
    stream, metal = measure.split("_")
    return f"Teor{STREAMS[stream]}{METALS[metal]}"


def actual_columns() -> Named:
    """What the plant did: 58 columns besides the day."""
    c = F.col
    hours = c("hours")
    feed, tonnes = c("mill_feed"), {a: c(f"{a}_feed") for a in (*CRUSHERS, "mill")}
    rec = {m: M.recovery(c(f"feed_{m}"), c(f"conc_{m}"), c(f"tails_{m}")) for m in METALS}
    gold_oz = M.gold_ounces(feed, c("feed_au"), rec["au"])
    copper_t = M.copper_produced(feed, c("feed_cu"), rec["cu"])
    out: Named = [
        *[(f"Alimentacao{_label(a)}", or_zero(tonnes[a])) for a in CRUSHERS],
        (f"Alimentacao{COMBINED}", or_zero("crusher_feed")),
        ("AlimentacaoPlanta", or_zero(feed)),
        ("P80Flotacao", c("p80")),
        ("TeorAlimentacaoCobre", c("feed_cu")),
        ("TeorAlimentacaoOuro", c("feed_au")),
        ("TeorAlimentacaoPirita", M.pyrite(c("feed_s"), c("feed_cu"))),
        *[(_grade_name(m), c(m)) for m in ("conc_cu", "conc_au", "tails_cu", "tails_au")],
        *[(f"Recuperacao{METALS[m]}", rec[m] * 100.0) for m in METALS],
        ("CobreContido", M.copper_contained(feed, c("feed_cu"))),
        ("OuroContido", M.gold_contained(feed, c("feed_au"))),
        ("MassaConcentrado", c("conc_t")),
        ("ProducaoPrataOz", c("silver_oz")),
        ("ProducaoOuroOz", gold_oz),
        ("ProducaoOuroGEO", M.gold_equivalent(gold_oz, c("silver_oz"))),
        ("ProducaoCobreKLB", copper_t / M.TONNES_PER_KLB),
        ("ProducaoOuroKg", M.gold_contained(feed, c("feed_au")) * rec["au"]),
        ("ProducaoCobreTon", copper_t),
        ("DisponibilidadePlanta", c("mill_availability") * 100.0),
        ("UtilizacaoPlanta", c("mill_utilisation") * 100.0),
        ("ProdutividadePlanta", ratio(feed, c("mill_used"))),
        ("HorasParadasProgramadas", c("mill_stop_scheduled")),
        ("HorasParadasManutencao", c("mill_stop_maintenance")),
        ("HorasParadasOperacao", c("mill_stop_operation")),
        ("HorasParadasExterno", c("mill_stop_external")),
        ("HorasDisponiveisPlanta", c("mill_available")),
        ("HorasUtilizadasPlanta", c("mill_used")),
        ("OeePlanta", M.oee(feed, hours, c("mill_rate"))),
    ]
    for area in CRUSHERS:
        used, available = c(f"{area}_used"), c(f"{area}_available")
        if area == "ipc":
            # The first crusher's ratios come from its hours, the others' from KPI rows.
            availability, utilisation = ratio(available, hours), ratio(used, available)
        else:
            availability, utilisation = c(f"{area}_availability"), c(f"{area}_utilisation")
        out += _area_block(
            area,
            [
                ("HorasUtilizadas", used),
                ("HorasDisponiveis", available),
                ("Disponibilidade", availability * 100.0),
                ("Utilizacao", utilisation * 100.0),
                ("Produtividade", ratio(tonnes[area], used)),
                ("Oee", M.oee(tonnes[area], hours, c(f"{area}_rate"))),
            ],
        )
    used, available = c("mmd_used") + c("jaw_used"), c("mmd_available") + c("jaw_available")
    out += _area_block(
        "combined",
        [
            ("HorasUtilizadas", used),
            ("HorasDisponiveis", available),
            ("Disponibilidade", available * 100.0 / M.COMBINED_CRUSHER_HOURS),
            ("Utilizacao", ratio(used * 100.0, available)),
            ("Produtividade", ratio(c("crusher_feed"), used)),
            ("Oee", M.oee(tonnes["mmd"] + tonnes["jaw"], hours, c("mmd_rate") + c("jaw_rate"))),
        ],
    )
    return [(f"{name}{ACTUAL_SUFFIX}", value) for name, value in out]


def _area_block(area: str, measures: Named) -> Named:
    return [(f"{name}{_label(area)}", value) for name, value in measures]


def plan_tails(metal: str, scenario: str) -> Column:
    f, c, r = (
        F.col(f"plan_{metal}_{part}_{scenario}") for part in ("grade", "conc", "rec")
    )
    return M.tails_from_plan(f, c, r, grade_in_percent=metal == "cu")


def plan_columns(scenario: str) -> Named:
    """What one plan scenario says: 56 columns, missing values shown as zero."""
    hours = F.col("hours")

    def plan(name: str) -> Column:
        return F.col(f"plan_{name}_{scenario}")

    def area(name: str, measure: str) -> Column:
        return F.col(f"{name}_{measure}_{scenario}")

    feed = {a: area(a, "feed") for a in AREAS}
    available = {
        a: M.plan_available(hours, area(a, "availability")) for a in AREAS
    }
    used = {
        a: M.plan_used(hours, area(a, "availability"), area(a, "utilisation")) for a in AREAS
    }
    mill_up, mill_use = area("mill", "availability"), area("mill", "utilisation")
    scheduled = F.coalesce(area("mill", "scheduled"), F.lit(DEFAULT_SCHEDULED_SHARE))
    corrective, external = or_zero(area("mill", "corrective")), or_zero(area("mill", "external"))
    out: Named = [
        *[(f"Alimentacao{_label(a)}", feed[a]) for a in CRUSHERS],
        (f"Alimentacao{COMBINED}", or_zero(feed["mmd"]) + or_zero(feed["jaw"])),
        ("AlimentacaoPlanta", feed["mill"]),
        *[(f"TeorAlimentacao{METALS[m]}", plan(f"{m}_grade")) for m in METALS],
        *[(f"TeorConcentrado{METALS[m]}", plan(f"{m}_conc")) for m in METALS],
        *[(f"TeorRejeito{METALS[m]}", plan_tails(m, scenario)) for m in METALS],
        *[(f"Recuperacao{METALS[m]}", plan(f"{m}_rec")) for m in METALS],
        *[(f"{METALS[m]}Contido", plan(f"{m}_content")) for m in METALS],
        ("MassaConcentrado", plan("conc_t")),
        ("ProducaoPrataOz", plan("ag_oz")),
        ("ProducaoOuroOz", plan("au_oz")),
        ("ProducaoOuroGEO", plan("au_geo")),
        ("ProducaoCobreKLB", plan("cu_klb")),
        ("ProducaoOuroKg", plan("au_kg")),
        ("ProducaoCobreTon", plan("cu_t")),
        ("DisponibilidadePlanta", mill_up),
        ("UtilizacaoPlanta", mill_use),
        ("ProdutividadePlanta", area("mill", "productivity")),
        ("HorasParadasProgramadas", M.plan_down(hours, mill_up, scheduled)),
        ("HorasParadasManutencao", M.plan_down(hours, mill_up, corrective)),
        # External stops are a share of the corrective ones.
        ("HorasParadasExterno", M.plan_down(hours, mill_up, corrective, external)),
        ("HorasParadasOperacao", M.plan_idle(hours, mill_up, mill_use)),
        ("HorasDisponiveisPlanta", available["mill"]),
        ("HorasUtilizadasPlanta", used["mill"]),
        ("OeePlanta", M.oee(feed["mill"], hours, F.col("mill_rate"))),
    ]
    for a in CRUSHERS:
        out += _area_block(
            a,
            [
                ("HorasDisponiveis", available[a]),
                ("HorasUtilizadas", used[a]),
                ("Disponibilidade", area(a, "availability")),
                ("Utilizacao", area(a, "utilisation")),
                ("Produtividade", area(a, "productivity")),
                ("Oee", M.oee(feed[a], hours, F.col(f"{a}_rate"))),
            ],
        )
    both = {k: v["mmd"] + v["jaw"] for k, v in {"t": feed, "a": available, "u": used}.items()}
    out += _area_block(
        "combined",
        [
            ("HorasDisponiveis", both["a"]),
            ("HorasUtilizadas", both["u"]),
            ("Disponibilidade", both["a"] * 100.0 / M.COMBINED_CRUSHER_HOURS),
            ("Utilizacao", ratio(both["u"] * 100.0, both["a"])),
            ("Produtividade", ratio(both["t"], both["u"])),
            ("Oee", M.oee(both["t"], hours, F.col("mmd_rate") + F.col("jaw_rate"))),
        ],
    )
    return [(f"{name}{SCENARIO_SUFFIX[scenario]}", or_zero(value)) for name, value in out]


def _kept(value: Column, weight: Column, test: Column | None = None) -> Column:
    """Positive-weighted mean of a single row: the value itself where it weighs anything."""
    counted = F.when((value if test is None else test) > 0, weight).otherwise(0.0)
    return ratio(value * weight, counted)


def accumulated_columns() -> Named:
    """Actual, budget and projected grades: 24 columns.

    Every (report date, day) has at most one row of actuals, of mill plan and of plan
    grades, so the full joins and the grouping that define these columns reduce to
    conditions on that one row: a day without a mill plan shows nothing, and plan
    grades only count where the day has actuals. ``accumulate.accumulated_grades`` is
    the general form; a test holds the two together.
    """
    planned = F.col("mill_feed_budget").isNotNull()
    happened = F.col("mill_feed").isNotNull()
    past = F.col("past")
    blocks: dict[str, dict[str, Column]] = {"actual": {}, "budget": {}, "projected": {}}
    for m in MEASURES:
        stream, metal = m.split("_")
        grade = or_zero(F.when(past, F.col(m)))
        feed = or_zero(F.when(past, F.col("mill_feed")))

        def plan_grade(scenario: str) -> Column:
            if stream == "tails":
                value = plan_tails(metal, scenario)
            else:
                part = "grade" if stream == "feed" else "conc"
                value = F.col(f"plan_{metal}_{part}_{scenario}")
            return or_zero(F.when(happened, value))

        budget_feed = or_zero("mill_feed_budget")
        concentrate = stream == "conc"
        weight = (
            or_zero(F.when(happened, F.col("plan_conc_t_very_short")))
            if concentrate
            else or_zero("mill_feed_very_short")
        )
        plan = plan_grade("very_short")
        actual = _kept(grade, feed)
        # On past days the concentrate is tested by the feed instead of the grade.
        spliced = F.when(past, _kept(grade, feed, feed if concentrate else None)).otherwise(
            _kept(plan, weight)
        )
        for block, value in (
            ("actual", actual),
            ("budget", _kept(plan_grade("budget"), budget_feed)),
            ("projected", spliced),
        ):
            blocks[block][m] = F.when(planned, value)
    suffixes = {"actual": "RealAcumulado", "budget": "OrcadoAcumulado", "projected": "Projecao"}
    out: Named = []
    for block, suffix in suffixes.items():
        g = blocks[block]
        out += [(f"{_grade_name(m)}{suffix}", g[m]) for m in MEASURES]
        for metal, word in METALS.items():
            rec = M.recovery(g[f"feed_{metal}"], g[f"conc_{metal}"], g[f"tails_{metal}"])
            out.append((f"Recuperacao{word}{suffix}", rec * 100.0))
    return out


def report_columns() -> Named:
    """All 251 columns in report order."""
    out: Named = [("PeriodIndex", F.col("day")), *actual_columns()]
    for scenario in SCENARIO_SUFFIX:
        out += plan_columns(scenario)
    return out + accumulated_columns()
