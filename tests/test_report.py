"""The facts that define the report, each under its own name."""

from datetime import date

import pytest
from conftest import (
    ASSAY,
    GRADE,
    by_day,
    plan_row,
    plant_of,
    plant_rows,
    production_row,
    t,
    table,
)
from pyspark.sql import functions as F

from opsreport.operators.accumulate import accumulated_grades
from opsreport.operators.timeaxis import dates_frame
from opsreport.plans.columns import plan_tails, report_columns
from opsreport.plans.report import area_rates, day_facts, plant_report

DATE = date(2024, 1, 2)


def report(spark, dates=(DATE,), plan_type=2, **changes):
    rows = plant_report(spark, plant_of(spark, **changes), list(dates), plan_type).collect()
    return by_day(rows, "PeriodIndex") if len(dates) == 1 else rows


@pytest.fixture(scope="module")
def base(spark):
    return report(spark)


def test_the_report_has_its_251_columns(spark):
    names = [n for n, _ in report_columns()]
    assert len(names) == len(set(names)) == 251
    assert names[:3] == ["PeriodIndex", "AlimentacaoIpcReal", "AlimentacaoMmdReal"]
    assert names[58:60] == ["OeeBritagensReal", "AlimentacaoIpcOrcado"]
    assert names[226] == "OeeBritagensCurtissimoPrazo"
    assert names[-1] == "RecuperacaoOuroProjecao"


def test_a_report_date_covers_its_month_actuals_stop_plans_go_on(base):
    assert sorted(base) == list(range(1, 32))
    assert base[2].AlimentacaoPlantaReal == pytest.approx(900.0)
    # The third has readings, but the report is of the second.
    assert base[3].AlimentacaoPlantaReal == 0.0 and base[3].TeorAlimentacaoCobreReal is None
    assert base[3].HorasUtilizadasPlantaReal is None
    assert base[5].AlimentacaoPlantaOrcado == 2000.0 and base[6].AlimentacaoPlantaOrcado == 0.0


def test_actual_numbers_by_hand(base):
    r = base[2]
    assert (r.AlimentacaoIpcReal, r.AlimentacaoMmdReal) == pytest.approx((110.0, 220.0))
    assert r.AlimentacaoBritagensReal == pytest.approx(550.0)
    f, c, tail = 0.5, 25.0, 0.1
    rec = (f - tail) / (c - tail) * c / f
    assert r.TeorAlimentacaoOuroReal == pytest.approx(0.44)  # stock factor of 10 %
    assert r.RecuperacaoCobreReal == pytest.approx(100 * rec)
    assert r.TeorAlimentacaoPiritaReal == pytest.approx((1.5 - 0.5 / 34.63 * 34.94) / 53.45 * 100)
    assert r.CobreContidoReal == pytest.approx(4.5)
    assert r.ProducaoCobreTonReal == pytest.approx(4.5 * rec)
    assert r.ProducaoCobreKLBReal == pytest.approx(4.5 * rec / 0.453592370380378)
    assert r.ProducaoPrataOzReal == pytest.approx(10.0)
    assert r.ProducaoOuroGEOReal == pytest.approx(r.ProducaoOuroOzReal + 0.2)
    assert r.ProdutividadePlantaReal == pytest.approx(900 / 16)
    assert (r.HorasParadasOperacaoReal, r.HorasParadasExternoReal) == (4.0, 0.5)
    assert r.OeePlantaReal == pytest.approx(100 * 900 / 24 / 50)
    # The first crusher's ratios come from hours, the others' from KPI rows.
    assert r.DisponibilidadeIpcReal == pytest.approx(100 * 20 / 24)
    assert r.DisponibilidadeMmdReal == pytest.approx(83.0)
    assert r.DisponibilidadeBritagensReal == pytest.approx(100 * 40 / 48)
    assert r.OeeBritagensReal == pytest.approx(100 * 550 / 24 / 100)
    # No shipment on the first: no silver, no gold equivalent.
    assert base[1].ProducaoPrataOzReal is None and base[1].ProducaoOuroGEOReal is None


def test_plan_numbers_by_hand(base):
    r = base[4]
    assert r.HorasDisponiveisPlantaCurtoPrazo == pytest.approx(24 * 0.8)
    assert r.HorasUtilizadasPlantaCurtoPrazo == pytest.approx(24 * 0.8 * 0.9)
    assert r.HorasParadasOperacaoCurtoPrazo == pytest.approx(24 * 0.8 * 0.1)
    assert r.HorasParadasProgramadasCurtoPrazo == pytest.approx(24 * 0.2 * 0.6)
    assert r.HorasParadasManutencaoCurtoPrazo == pytest.approx(24 * 0.2 * 0.4)
    # External share: 100 - (10 + 20) + 5 + 5 = 80, a part of the corrective stops.
    assert r.HorasParadasExternoCurtoPrazo == pytest.approx(24 * 0.2 * 0.4 * 0.8)
    assert r.AlimentacaoBritagensCurtissimoPrazo == 8000.0
    assert r.DisponibilidadeBritagensCurtissimoPrazo == pytest.approx(100 * 38.4 / 48)
    f, c, rec = 0.006, 0.24, 0.85
    want = 100 * f * c * (rec - 1) / (rec * f - c)
    assert r.TeorRejeitoCobreCurtoPrazo == pytest.approx(want)
    assert r.ProducaoOuroKgCurtoPrazo == 3.0


def test_without_a_plan_type_the_budget_is_zero(spark):
    r = report(spark, plan_type=None)[2]
    budget = {n: v for n, v in r.asDict().items() if n.endswith("Orcado")}
    assert len(budget) == 56 and set(budget.values()) == {0.0}
    assert r.AlimentacaoPlantaCurtoPrazo == 3000.0
    assert r.TeorAlimentacaoCobreOrcadoAcumulado is None


@pytest.fixture(scope="module")
def special(spark):
    """A report of the third where every day has something out of the ordinary."""
    rows = plant_rows()
    plans = [
        p if p[0].day < 4 else (*p[:-1], None)  # no scheduled share from the fourth on
        for p in rows["area_plans"]
        if not (p[0].day == 2 and "Moagem" in p[1])  # no mill plan on the second
    ]
    plans.append(plan_row("2024-01-05", "Planejamento - Moagem", 3, 9e9, version=2))
    changes = {
        "area_plans": plans,
        "production_plans": [*rows["production_plans"], production_row("2024-01-05", 3, 2)],
        "daily_factor": [(t("2024-01-01"), None)],
        "shipments": [
            (t("2024-01-01"), 10.0, 31.1034768),
            (t("2024-01-01"), -999.0, 5.0),
            (t("2024-01-04"), 1.0, 1.0),
            (t("2024-01-04"), 1.0, 1.0),
        ],
        "assays": [  # zero copper in the concentrate of the third
            (ts, c, l, a, 0.0 if (ts.day, c, a) == (3, 3, "Cu") else v)
            for ts, c, l, a, v in rows["assays"]
        ],
    }
    return plant_report(spark, plant_of(spark, **changes), [date(2024, 1, 3)], 2).collect()


def test_scheduled_share_defaults_to_all(special):
    assert by_day(special, "PeriodIndex")[4].HorasParadasProgramadasOrcado == pytest.approx(4.8)


def test_other_plan_versions_do_not_count(special):
    r = by_day(special, "PeriodIndex")[5]
    assert r.AlimentacaoPlantaCurtoPrazo == 3000.0 and r.MassaConcentradoCurtoPrazo == 100.0


def test_a_day_without_scale_factor_has_no_crusher_feed(special):
    r = by_day(special, "PeriodIndex")
    assert r[1].AlimentacaoIpcReal == 100.0  # a NULL factor is 1
    assert r[2].AlimentacaoIpcReal == 0.0 and r[2].ProdutividadeIpcReal is None


def test_several_shipments_of_a_day_give_several_rows(special):
    silver = sorted(r.ProducaoPrataOzReal for r in special if r.PeriodIndex.day == 1)
    assert silver == pytest.approx([0.0, 10.0])
    # The fourth is after the report date: neither shown nor doubled.
    assert len(special) == 32


def test_a_day_without_mill_plan_loses_its_accumulated_columns(special):
    r = by_day(special, "PeriodIndex")
    assert r[2].TeorAlimentacaoCobreReal == pytest.approx(0.5)
    assert r[2].TeorAlimentacaoCobreRealAcumulado is None
    assert r[2].TeorAlimentacaoCobreProjecao is None
    assert r[1].TeorAlimentacaoCobreRealAcumulado == pytest.approx(0.5)


def test_projected_concentrate_is_tested_by_feed(special):
    r = by_day(special, "PeriodIndex")[3]
    assert r.TeorConcentradoCobreReal is None  # zero grades do not weigh
    assert r.TeorConcentradoCobreRealAcumulado is None
    assert r.TeorConcentradoCobreProjecao == 0.0  # but here the feed is what counts


def test_without_shifts_there_are_no_readings_but_plans(spark):
    r = report(spark, shifts=[])
    assert r[2].AlimentacaoPlantaReal == 0.0 and r[2].AlimentacaoIpcReal == 0.0
    assert r[2].AlimentacaoPlantaCurtoPrazo == 3000.0
    # Day length is unknown, so plan hours show as zero.
    assert r[2].HorasDisponiveisPlantaCurtoPrazo == 0.0


def test_accumulated_columns_are_per_day_not_running(base):
    assert base[1].TeorAlimentacaoCobreRealAcumulado == pytest.approx(0.5)
    assert base[2].TeorAlimentacaoCobreOrcadoAcumulado == pytest.approx(0.6)
    assert base[2].RecuperacaoCobreRealAcumulado == pytest.approx(base[2].RecuperacaoCobreReal)


def test_future_projection_is_null_although_planned(base):
    assert base[3].TeorAlimentacaoCobreCurtissimoPrazo == pytest.approx(0.6)
    assert base[3].TeorAlimentacaoCobreProjecao is None
    assert base[3].TeorConcentradoCobreProjecao is None
    assert base[2].TeorAlimentacaoCobreProjecao == pytest.approx(0.5)


def test_rates_count_from_their_date_on(spark):
    area = "330 MOAGEM"
    rates = [(area, t("2023-01-01"), 50.0), (area + " ", t("2024-01-02"), 25.0)]
    days = [date(2022, 1, 1), date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 9)]
    out = area_rates(dates_frame(spark, days), table(spark, "nominal_rates", rates)).collect()
    got = {r.report_date: (r.mill_rate, r.ipc_rate) for r in out}
    assert [got[d] for d in days] == [(None, None), (50.0, None), (25.0, None), (25.0, None)]


def test_batched_report_dates_equal_single_runs(spark):
    """Property: one job for many dates gives what one job per date gives."""
    shifts = [(t("2023-12-01"), 1, 360), (t("2024-01-01"), 1, 420)]
    assays = plant_rows()["assays"] + [(t("2023-12-20"), *ASSAY["feed_cu"], 0.9)]
    cu = [a for a in assays if a[1:3] == (8, "Alimentação Sag") and a[3] == "Cu "]
    assays = [a for a in assays if a not in cu] + [(*a[:4], -999.0) for a in cu[:1]] + cu[1:]
    changes = {"shifts": shifts, "assays": assays}
    dates = [date(2023, 12, 31), DATE]
    together = {(r.report_date, r.PeriodIndex): r for r in report(spark, dates, **changes)}
    alone = {}
    for d in dates:
        rows = plant_report(spark, plant_of(spark, **changes), [d], 2).collect()
        alone |= {(r.report_date, r.PeriodIndex): r for r in rows}
    assert len(together) == 31 + 31
    assert together == alone


def test_row_wise_accumulation_equals_the_full_joins(spark):
    """The report's shortcut against the operator with real full joins and grouping."""
    plans = [p for p in plant_rows()["area_plans"] if not (p[0].day == 1 and "Moagem" in p[1])]
    production = [p for p in plant_rows()["production_plans"] if p[0].day != 3]
    assays = [
        (*a[:4], -0.5 if a[0].day == 2 and a[3] == "Au" else a[4]) for a in plant_rows()["assays"]
    ]
    changes = {"area_plans": plans, "production_plans": production, "assays": assays}
    dates = [DATE, date(2024, 1, 4)]
    facts = day_facts(spark, plant_of(spark, **changes), dates, 2).persist()
    keys = ["report_date", "day"]
    actual = facts.where("past AND mill_feed IS NOT NULL").select(
        *keys, F.col("mill_feed").alias("feed_t"), *[g for g in GRADE if g != "feed_s"]
    )
    mill = facts.where("mill_feed_budget IS NOT NULL").select(
        *keys,
        F.col("mill_feed_budget").alias("feed_budget"),
        F.col("mill_feed_very_short").alias("feed_very_short"),
    )
    grades = facts.where("plan_conc_t_budget IS NOT NULL").select(
        *keys,
        F.col("plan_conc_t_very_short").alias("conc_t_very_short"),
        *[
            e.alias(f"{stream}_{m}_{s}")
            for s in ("budget", "very_short")
            for m in ("cu", "au")
            for stream, e in (
                ("feed", F.col(f"plan_{m}_grade_{s}")),
                ("conc", F.col(f"plan_{m}_conc_{s}")),
                ("tails", plan_tails(m, s)),
            )
        ],
    )
    past = F.to_date("day") <= F.col("report_date")
    full = accumulated_grades(actual, mill, grades, keys, past)
    want = {(r.report_date, r.day): r for r in full.collect()}
    assert (None, None) in want  # the orphans
    rows = facts.select(keys[0], *[v.alias(n) for n, v in report_columns()]).collect()
    names = {"feed": "Alimentacao", "conc": "Concentrado", "tails": "Rejeito"}
    for r in rows:
        w = want.get((r.report_date, r.PeriodIndex))
        for block, suffix in (
            ("actual", "RealAcumulado"), ("budget", "OrcadoAcumulado"), ("projected", "Projecao")
        ):
            for m, metal in (("cu", "Cobre"), ("au", "Ouro")):
                pairs = [(f"Teor{n}{metal}{suffix}", f"{s}_{m}_{block}") for s, n in names.items()]
                for ours, theirs in [*pairs, (f"Recuperacao{metal}{suffix}", f"rec_{m}_{block}")]:
                    expect = None if w is None else w[theirs]
                    got = r[ours]
                    assert got == (expect if expect is None else pytest.approx(expect)), ours
    facts.unpersist()


def test_a_run_needs_a_report_date(spark):
    with pytest.raises(ValueError):
        plant_report(spark, plant_of(spark), [])
