"""The same queries as DuckDB SQL, written the long way.

Where Spark uses a window, a pre-aggregation or a row-wise shortcut, the SQL here uses
correlated subqueries, real many-to-many joins and real full joins.
"""

from __future__ import annotations

from opsreport.sources.codes import AREAS, GRADES, HOUR_ORDERS, KPI_ORDERS, STOCK_FACTORS
from opsreport.operators.treatment import KEY, RENAME_MAP
from workload.standins import cte

REPORT_DATES = ("2024-01-10", "2024-01-20")
BUDGET = 2

Columns = dict[str, str]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def half_up(e: str, digits: int = 4) -> str:
    """The rounding of the Spark queries."""
    return f"floor(CAST({e} AS DOUBLE) * 1e{digits} + 0.5001) / 1e{digits}"


def rnd(cols: Columns, digits: int = 4) -> str:
    """A select list of rounded columns."""
    return ",\n       ".join(f"{half_up(e, digits)} AS {n}" for n, e in cols.items())


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def zero(x: str) -> str:
    return f"coalesce({x}, 0)"


def wmean(v: str, w: str) -> str:
    return div(f"sum({zero(v)} * ({w}))", f"sum(CASE WHEN {zero(v)} > 0 THEN {w} ELSE 0 END)")


def rec(f: str, c: str, t: str) -> str:
    return f"({div(f'{f} - {t}', f'{c} - {t}')} * {div(c, f)})"


# --- calendar and readings -------------------------------------------------------------

SPINE = [
    cte("shifts"),
    """offsets AS (SELECT * FROM shifts WHERE shift_order = 1)""",
    """months AS (SELECT DISTINCT date_trunc('month', CAST(ts AS DATE)) AS month FROM events)""",
    """days AS (SELECT CAST(month AS TIMESTAMP) AS month,
       unnest(generate_series(CAST(month AS TIMESTAMP),
              CAST(month AS TIMESTAMP) + INTERVAL 1 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day
     FROM months)""",
    """edges AS (SELECT day, month,
       (SELECT max_by(start_minutes, effective) FROM offsets WHERE effective < day) AS o,
       (SELECT max_by(start_minutes, effective) FROM offsets
         WHERE effective < day + INTERVAL 1 DAY) AS c,
       (SELECT max_by(start_minutes, effective) FROM offsets WHERE effective < month) AS m
     FROM days)""",
    """spine AS (SELECT day, day + INTERVAL 1 MINUTE * o AS start,
       day + INTERVAL 1 DAY + INTERVAL 1 MINUTE * c AS "end", (1440 + c - o) / 60.0 AS hours,
       month + INTERVAL 1 MINUTE * coalesce(m, 0) - INTERVAL 1 MONTH AS floor
     FROM edges)""",
]


def measure(c: str) -> str:
    return f"coalesce(nullif({c}, -999), 0)"


_LINES = {
    "ipc_feed": measure("ipc_t"),
    "mmd_feed": measure("mmd_t"),
    "jaw_feed": measure("c160_t"),
    "crusher_feed": f"{measure('mmd_t')} + {measure('c160_t')}",
}
FEED = [
    cte("scale_readings"),
    cte("daily_factor"),
    "feed AS (SELECT s.day, "
    + ", ".join(f"avg(coalesce(f.factor, 1)) * sum({e}) AS {n}" for n, e in _LINES.items())
    + """ FROM spine s JOIN scale_readings r ON r.ts >= s.start AND r.ts < s."end"
          JOIN daily_factor f ON f.day = s.day GROUP BY s.day)""",
]

_DRY = f"{measure('m.wet_t')} * (1 - coalesce(nullif(a.value, -999), 5) / 100)"
READINGS = [
    *[cte(n) for n in ("assays", "mill_readings", "particle_size", "concentrate")],
    f"""readings AS (SELECT m.ts, {_DRY} AS dry_t, {measure('c.conc_t')} AS conc_t,
        nullif(z.p80, -999) AS p80
      FROM mill_readings m JOIN particle_size z ON m.ts = z.ts JOIN concentrate c ON m.ts = c.ts
      JOIN assays a ON m.ts = a.ts
      WHERE a.circuit = 4 AND trim(a.location) = 'Moagem' AND trim(a.analyte) = 'Umidade Minério')""",
]

_GROUP = " ".join(
    f"WHEN circuit = {c} AND trim(location) = '{l}' AND trim(analyte) = '{a}' THEN '{g}'"
    for g, (c, l, a) in GRADES.items()
)


def _factor(g: str) -> str:
    f = STOCK_FACTORS.get(g)
    return f"(1 + CAST(f.{f} AS DOUBLE) / 100) * " if f else ""


GRADED = [
    cte("month_factors"),
    f"""tagged AS (SELECT ts, CASE {_GROUP} END AS g, nullif(value, -999) AS v FROM assays)""",
    """seen AS (SELECT ts, g, max(v) AS v FROM tagged WHERE g IS NOT NULL GROUP BY ts, g)""",
    """hours AS (SELECT DISTINCT m.ts, s.day, s.floor FROM mill_readings m
       JOIN spine s ON m.ts >= s.start AND m.ts < s."end")""",
    """fixed AS (SELECT h.ts, h.day, x.g, coalesce(x.v,
         (SELECT max_by(p.v, p.ts) FROM seen p WHERE p.g = x.g AND p.v IS NOT NULL
            AND p.ts < h.ts AND p.ts > h.floor)) AS v
       FROM hours h LEFT JOIN seen x ON x.ts = h.ts)""",
    "pivoted AS (SELECT ts, day, "
    + ", ".join(f"max(v) FILTER (WHERE g = '{g}') AS {g}" for g in GRADES)
    + " FROM fixed GROUP BY ts, day)",
    """factors AS (SELECT year, month, coalesce(max(au_feed), 0) AS au_feed,
         coalesce(max(cu_feed), 0) AS cu_feed, coalesce(max(cu_col), 0) AS cu_col,
         coalesce(max(au_col), 0) AS au_col FROM month_factors GROUP BY year, month)""",
    "graded AS (SELECT p.ts, p.day, "
    + ", ".join(f"{_factor(g)}p.{g} AS {g}" for g in GRADES)
    + """ FROM pivoted p LEFT JOIN factors f
         ON f.year = year(p.day) AND f.month = month(p.day))""",
]
PRODUCTION = [
    *READINGS,
    *GRADED,
    "production AS (SELECT g.day, sum(r.dry_t) AS mill_feed, sum(r.conc_t) AS conc_t, "
    + wmean("r.p80", "r.dry_t")
    + " AS p80, "
    + ", ".join(f"{wmean('g.' + g, 'r.dry_t')} AS {g}" for g in GRADES)
    + " FROM readings r JOIN graded g ON g.ts = r.ts GROUP BY g.day)",
]

# --- pivots ----------------------------------------------------------------------------


def kpi_columns() -> Columns:
    out: Columns = {}
    for area, names in AREAS.items():
        mine = f"FILTER (WHERE area = '{names.code}')"
        for name, orders in HOUR_ORDERS.items():
            if area == "mill" or not name.startswith("stop_"):
                codes = ", ".join(f"'{o}'" for o in orders)
                cond = f"kpi_type = '1_TimeClassDuration' AND kpi_order IN ({codes})"
                out[f"{area}_{name}"] = f"sum(CASE WHEN {cond} THEN kpi_value ELSE 0 END) {mine}"
        for name, (order, text) in KPI_ORDERS.items():
            cond = f"kpi_type = '3_KPI' AND kpi_order = '{order}' AND kpi_description = '{text}'"
            out[f"{area}_{name}"] = f"avg(CASE WHEN {cond} THEN kpi_value END) {mine}"
    return out


def named(cols: Columns) -> str:
    return ",\n       ".join(f"{e} AS {n}" for n, e in cols.items())


KPIS = [
    cte("downtime_kpis"),
    f"kpis AS (SELECT day, {named(kpi_columns())} FROM downtime_kpis GROUP BY day)",
]


def _types(budget: int | None) -> dict[str, str]:
    return {"budget": "NULL" if budget is None else str(budget), "short": "3", "very_short": "4"}


def area_plan_columns(budget: int | None) -> Columns:
    out: Columns = {}
    for area, names in AREAS.items():
        mine = f"FILTER (WHERE trim(plan_name) = '{names.plan}')"
        for s, t in _types(budget).items():
            is_type = f"plan_type = {t}"
            out[f"{area}_feed_{s}"] = (
                f"sum(CASE WHEN {is_type} THEN coalesce(feed_t, 0) ELSE 0 END) {mine}"
            )
            means = {m: m for m in ("availability", "utilisation", "productivity")}
            if area == "mill":
                means |= {"scheduled": "scheduled", "corrective": "corrective"}
                means["external"] = "100 - c14 - c15 + c16 + c17"
            for name, e in means.items():
                out[f"{area}_{name}_{s}"] = f"avg(CASE WHEN {is_type} THEN {e} END) {mine}"
    return out


_PLAN_MEANS = (
    "cu_grade cu_content au_grade au_content cu_rec au_rec cu_conc au_conc".split()
)
_PLAN_SUMS = "conc_t ag_oz au_oz au_geo cu_klb au_kg cu_t".split()


def production_plan_columns(budget: int | None) -> Columns:
    out: Columns = {}
    for s, t in _types(budget).items():
        for m in _PLAN_MEANS:
            out[f"plan_{m}_{s}"] = f"avg(CASE WHEN plan_type = {t} THEN {m} END)"
        for m in _PLAN_SUMS:
            out[f"plan_{m}_{s}"] = (
                f"sum(CASE WHEN plan_type = {t} THEN coalesce({m}, 0) ELSE 0 END)"
            )
    return out


def plans(budget: int | None) -> list[str]:
    labels = ", ".join(f"'{a.plan}'" for a in AREAS.values())
    return [
        cte("area_plans"),
        cte("production_plans"),
        f"""areas AS (SELECT day, {named(area_plan_columns(budget))} FROM area_plans
            WHERE f1 = 1 AND f5 = 4 AND trim(plan_name) IN ({labels}) GROUP BY day)""",
        f"""prods AS (SELECT day, {named(production_plan_columns(budget))} FROM production_plans
            WHERE f1 = 1 AND f5 = 4 GROUP BY day)""",
    ]


# --- the report ------------------------------------------------------------------------


def _rates(at: str) -> str:
    return ", ".join(
        f"(SELECT max_by(n.rate, n.effective) FROM nominal_rates n WHERE n.area = '{a.code}' "
        f"AND n.effective <= {at}) AS {name}_rate"
        for name, a in AREAS.items()
    )


def grid(dates: list[str]) -> list[str]:
    values = ", ".join(f"(TIMESTAMP '{d}')" for d in dates)
    return [
        cte("nominal_rates"),
        f"asked AS (SELECT * FROM (VALUES {values}) v(report_date))",
        f"""grid AS (SELECT a.report_date, s.day, s.hours, {_rates('a.report_date')}
            FROM asked a JOIN spine s
              ON date_trunc('month', s.day) = date_trunc('month', a.report_date))""",
    ]


_NAMES = {"ipc": "Ipc", "mmd": "Mmd", "jaw": "Mandibulas"}
_SUFFIX = {"budget": "Orcado", "short": "CurtoPrazo", "very_short": "CurtissimoPrazo"}
_OZ = "31.1034768"
_KLB = "0.453592370380378"


def oee_sql(t: str, rate: str) -> str:
    return div(div(f"100 * ({t})", "hours"), rate)


def actual_sql() -> Columns:
    cu, au = rec("feed_cu", "conc_cu", "tails_cu"), rec("feed_au", "conc_au", "tails_au")
    oz, cu_t = f"mill_feed * feed_au * {au} / {_OZ}", f"mill_feed * feed_cu / 100 * {cu}"
    out = {
        "AlimentacaoIpc": zero("ipc_feed"),
        "AlimentacaoMmd": zero("mmd_feed"),
        "AlimentacaoMandibulas": zero("jaw_feed"),
        "AlimentacaoBritagens": zero("crusher_feed"),
        "AlimentacaoPlanta": zero("mill_feed"),
        "P80Flotacao": "p80",
        "TeorAlimentacaoCobre": "feed_cu",
        "TeorAlimentacaoOuro": "feed_au",
        "TeorAlimentacaoPirita": "100 * (feed_s - 34.94 * feed_cu / 34.63) / 53.45",
        "TeorConcentradoCobre": "conc_cu",
        "TeorConcentradoOuro": "conc_au",
        "TeorRejeitoCobre": "tails_cu",
        "TeorRejeitoOuro": "tails_au",
        "RecuperacaoCobre": f"100 * {cu}",
        "RecuperacaoOuro": f"100 * {au}",
        "CobreContido": "mill_feed * feed_cu / 100",
        "OuroContido": "mill_feed * feed_au / 1000",
        "MassaConcentrado": "conc_t",
        "ProducaoPrataOz": "silver",
        "ProducaoOuroOz": oz,
        "ProducaoOuroGEO": f"{oz} + silver / 50",
        "ProducaoCobreKLB": f"{cu_t} / {_KLB}",
        "ProducaoOuroKg": f"mill_feed * feed_au * {au} / 1000",
        "ProducaoCobreTon": cu_t,
        "DisponibilidadePlanta": "100 * mill_availability",
        "UtilizacaoPlanta": "100 * mill_utilisation",
        "ProdutividadePlanta": div("mill_feed", "mill_used"),
        "HorasParadasProgramadas": "mill_stop_scheduled",
        "HorasParadasManutencao": "mill_stop_maintenance",
        "HorasParadasOperacao": "mill_stop_operation",
        "HorasParadasExterno": "mill_stop_external",
        "HorasDisponiveisPlanta": "mill_available",
        "HorasUtilizadasPlanta": "mill_used",
        "OeePlanta": oee_sql("mill_feed", "mill_rate"),
    }
    ratios = {
        "ipc": (div("ipc_available", "hours"), div("ipc_used", "ipc_available")),
        "mmd": ("mmd_availability", "mmd_utilisation"),
        "jaw": ("jaw_availability", "jaw_utilisation"),
    }
    for a, (up, use) in ratios.items():
        n = _NAMES[a]
        out |= {
            f"HorasUtilizadas{n}": f"{a}_used",
            f"HorasDisponiveis{n}": f"{a}_available",
            f"Disponibilidade{n}": f"100 * {up}",
            f"Utilizacao{n}": f"100 * {use}",
            f"Produtividade{n}": div(f"{a}_feed", f"{a}_used"),
            f"Oee{n}": oee_sql(f"{a}_feed", f"{a}_rate"),
        }
    used, ready = "mmd_used + jaw_used", "mmd_available + jaw_available"
    out |= {
        "HorasUtilizadasBritagens": used,
        "HorasDisponiveisBritagens": ready,
        "DisponibilidadeBritagens": f"100 * ({ready}) / 48",
        "UtilizacaoBritagens": div(f"100 * ({used})", ready),
        "ProdutividadeBritagens": div("crusher_feed", used),
        "OeeBritagens": oee_sql("mmd_feed + jaw_feed", "mmd_rate + jaw_rate"),
    }
    return {f"{n}Real": e for n, e in out.items()}


_SILVER = [
    cte("shipments"),
    "silver AS (SELECT day, "
    + div(f"{measure('mass')} * {measure('ag_grade')}", _OZ)
    + " AS silver FROM shipments)",
]
_ACTUAL_JOINS = "\n".join(
    f"LEFT JOIN {t} ON {t}.day = g.day AND g.day <= g.report_date"
    for t in ("feed", "production", "kpis", "silver")
)


def report_actual_sql() -> str:
    body = f"""SELECT g.report_date, g.day AS PeriodIndex, {rnd(actual_sql())}
FROM grid g
{_ACTUAL_JOINS}"""
    return with_([*SPINE, *FEED, *PRODUCTION, *KPIS, *grid(list(REPORT_DATES)), *_SILVER], body)


def tails_sql(metal: str, f: str, c: str, r: str) -> str:
    if metal == "cu":
        f, c = f"({f} / 100)", f"({c} / 100)"
    scale = "100 * " if metal == "cu" else ""
    return zero(div(f"{scale}{f} * {c} * ({r} / 100 - 1)", f"{r} / 100 * {f} - {c}"))


def plan_sql(s: str) -> Columns:
    def p(m: str) -> str:
        return f"plan_{m}_{s}"

    def a(area: str, m: str) -> str:
        return f"{area}_{m}_{s}"

    def ready(area: str) -> str:
        return f"hours * {a(area, 'availability')} / 100"

    def used(area: str) -> str:
        return f"{ready(area)} * {a(area, 'utilisation')} / 100"

    down = f"hours * (1 - {a('mill', 'availability')} / 100)"
    out = {
        "AlimentacaoIpc": a("ipc", "feed"),
        "AlimentacaoMmd": a("mmd", "feed"),
        "AlimentacaoMandibulas": a("jaw", "feed"),
        "AlimentacaoBritagens": f"{zero(a('mmd', 'feed'))} + {zero(a('jaw', 'feed'))}",
        "AlimentacaoPlanta": a("mill", "feed"),
        "TeorAlimentacaoCobre": p("cu_grade"),
        "TeorAlimentacaoOuro": p("au_grade"),
        "TeorConcentradoCobre": p("cu_conc"),
        "TeorConcentradoOuro": p("au_conc"),
        "TeorRejeitoCobre": tails_sql("cu", p("cu_grade"), p("cu_conc"), p("cu_rec")),
        "TeorRejeitoOuro": tails_sql("au", p("au_grade"), p("au_conc"), p("au_rec")),
        "RecuperacaoCobre": p("cu_rec"),
        "RecuperacaoOuro": p("au_rec"),
        "CobreContido": p("cu_content"),
        "OuroContido": p("au_content"),
        "MassaConcentrado": p("conc_t"),
        "ProducaoPrataOz": p("ag_oz"),
        "ProducaoOuroOz": p("au_oz"),
        "ProducaoOuroGEO": p("au_geo"),
        "ProducaoCobreKLB": p("cu_klb"),
        "ProducaoOuroKg": p("au_kg"),
        "ProducaoCobreTon": p("cu_t"),
        "DisponibilidadePlanta": a("mill", "availability"),
        "UtilizacaoPlanta": a("mill", "utilisation"),
        "ProdutividadePlanta": a("mill", "productivity"),
        "HorasParadasProgramadas": f"{down} * coalesce({a('mill', 'scheduled')}, 100) / 100",
        "HorasParadasManutencao": f"{down} * {zero(a('mill', 'corrective'))} / 100",
        "HorasParadasExterno": f"{down} * {zero(a('mill', 'corrective'))} / 100 "
        f"* {zero(a('mill', 'external'))} / 100",
        "HorasParadasOperacao": f"{ready('mill')} * (1 - {a('mill', 'utilisation')} / 100)",
        "HorasDisponiveisPlanta": ready("mill"),
        "HorasUtilizadasPlanta": used("mill"),
        "OeePlanta": oee_sql(a("mill", "feed"), "mill_rate"),
    }
    for area in ("ipc", "mmd", "jaw"):
        n = _NAMES[area]
        out |= {
            f"HorasDisponiveis{n}": ready(area),
            f"HorasUtilizadas{n}": used(area),
            f"Disponibilidade{n}": a(area, "availability"),
            f"Utilizacao{n}": a(area, "utilisation"),
            f"Produtividade{n}": a(area, "productivity"),
            f"Oee{n}": oee_sql(a(area, "feed"), f"{area}_rate"),
        }
    r, u = f"{ready('mmd')} + {ready('jaw')}", f"{used('mmd')} + {used('jaw')}"
    t = f"{a('mmd', 'feed')} + {a('jaw', 'feed')}"
    out |= {
        "HorasDisponiveisBritagens": r,
        "HorasUtilizadasBritagens": u,
        "DisponibilidadeBritagens": f"100 * ({r}) / 48",
        "UtilizacaoBritagens": div(f"100 * ({u})", r),
        "ProdutividadeBritagens": div(t, u),
        "OeeBritagens": oee_sql(t, "mmd_rate + jaw_rate"),
    }
    return {f"{n}{_SUFFIX[s]}": zero(e) for n, e in out.items()}


_SHIPMENT_ROWS = [
    cte("shipments"),
    """shipped AS (SELECT g.*, h.day AS ship_day FROM grid g
       LEFT JOIN shipments h ON h.day = g.day AND g.day <= g.report_date)""",
]


def report_plans_sql() -> str:
    cols: Columns = {}
    for s in _SUFFIX:
        cols |= plan_sql(s)
    body = f"""SELECT g.report_date, g.day AS PeriodIndex, {rnd(cols)}
FROM shipped g LEFT JOIN areas ON areas.day = g.day LEFT JOIN prods ON prods.day = g.day"""
    return with_([*SPINE, *grid(list(REPORT_DATES)), *_SHIPMENT_ROWS, *plans(BUDGET)], body)


_MEASURES = ("feed_cu", "feed_au", "conc_cu", "conc_au", "tails_cu", "tails_au")
_STREAM = {"feed": "Alimentacao", "conc": "Concentrado", "tails": "Rejeito"}
_METAL = {"cu": "Cobre", "au": "Ouro"}


def accumulation(past: str, feed: str = "t.feed_t") -> Columns:
    """Grades over the full joins of t (actuals), p (mill plan) and q (plan grades)."""
    out: Columns = {}
    for m in _MEASURES:
        conc = m.startswith("conc_")
        out[f"{m}_actual"] = wmean(f"t.{m}", zero(feed))
        out[f"{m}_budget"] = wmean(f"q.{m}_budget", zero("p.feed_budget"))
        plan_weight = "q.conc_t_very_short" if conc else "p.feed_very_short"

        def cut(a: str, b: str) -> str:
            return f"(CASE WHEN {past} THEN {zero(a)} ELSE {zero(b)} END)"

        value, weight = cut(f"t.{m}", f"q.{m}_very_short"), cut(feed, plan_weight)
        test = cut(feed if conc else f"t.{m}", f"q.{m}_very_short")
        out[f"{m}_projected"] = div(
            f"sum({value} * {weight})", f"sum(CASE WHEN {test} > 0 THEN {weight} ELSE 0 END)"
        )
    return out


def recoveries() -> Columns:
    out: Columns = {}
    for b in ("actual", "budget", "projected"):
        for m in _METAL:
            r = rec(f"feed_{m}_{b}", f"conc_{m}_{b}", f"tails_{m}_{b}")
            out[f"rec_{m}_{b}"] = f"100 * {r}"
    return out


def accumulated_names() -> Columns:
    names: Columns = {}
    for b, suffix in (
        ("actual", "RealAcumulado"),
        ("budget", "OrcadoAcumulado"),
        ("projected", "Projecao"),
    ):
        for m in _MEASURES:
            stream, metal = m.split("_")
            names[f"Teor{_STREAM[stream]}{_METAL[metal]}{suffix}"] = f"{m}_{b}"
        for m in _METAL:
            names[f"Recuperacao{_METAL[m]}{suffix}"] = f"rec_{m}_{b}"
    return names


def accumulated_ctes() -> list[str]:
    """From the grid, production and plans to one row of accumulated grades per date and day."""
    plan_grades: Columns = {}
    for s in ("budget", "very_short"):
        for m in _METAL:
            f, c, r = (f"plan_{m}_{x}_{s}" for x in ("grade", "conc", "rec"))
            plan_grades |= {
                f"feed_{m}_{s}": f,
                f"conc_{m}_{s}": c,
                f"tails_{m}_{s}": tails_sql(m, f, c, r),
            }
    same = "{0}.report_date = {1}.report_date AND {0}.day = {1}.day"
    return [
        """t AS (SELECT g.report_date, x.*, x.mill_feed AS feed_t FROM production x
           JOIN grid g ON g.day = x.day AND x.day <= g.report_date)""",
        """p AS (SELECT g.report_date, a.day, mill_feed_budget AS feed_budget,
             mill_feed_very_short AS feed_very_short FROM areas a JOIN grid g ON g.day = a.day
           WHERE mill_feed_budget IS NOT NULL)""",
        f"""q AS (SELECT g.report_date, a.day, plan_conc_t_very_short AS conc_t_very_short,
             {named(plan_grades)} FROM prods a JOIN grid g ON g.day = a.day)""",
        f"""acc AS (SELECT p.report_date, p.day,
             {named(accumulation('p.day < p.report_date + INTERVAL 1 DAY'))}
           FROM t FULL JOIN p ON {same.format('t', 'p')} FULL JOIN q ON {same.format('t', 'q')}
           GROUP BY p.report_date, p.day)""",
        f"accrec AS (SELECT *, {named(recoveries())} FROM acc)",
    ]


_ACCUMULATED_JOIN = (
    "LEFT JOIN accrec ON accrec.report_date = g.report_date AND accrec.day = g.day"
)


def report_accumulated_sql() -> str:
    ctes = [*SPINE, *PRODUCTION, *grid(list(REPORT_DATES)), *_SHIPMENT_ROWS, *plans(BUDGET)]
    body = f"""SELECT g.report_date, g.day AS PeriodIndex, {rnd(accumulated_names())}
FROM shipped g {_ACCUMULATED_JOIN}"""
    return with_([*ctes, *accumulated_ctes()], body)


def plant_report_sql() -> str:
    """All 251 columns at once."""
    cols = actual_sql()
    for s in _SUFFIX:
        cols |= plan_sql(s)
    cols |= accumulated_names()
    ctes = [*SPINE, *FEED, *PRODUCTION, *KPIS, *grid(list(REPORT_DATES)), *_SILVER]
    body = f"""SELECT g.report_date, g.day AS PeriodIndex, {rnd(cols)}
FROM grid g
{_ACTUAL_JOINS}
LEFT JOIN areas ON areas.day = g.day LEFT JOIN prods ON prods.day = g.day
{_ACCUMULATED_JOIN}"""
    return with_([*ctes, *plans(BUDGET), *accumulated_ctes()], body)


def multi_date_sql() -> str:
    kept = {old: new for old, new in RENAME_MAP.items() if old != KEY}
    actual = actual_sql()
    cols = {
        f'"{new}"': f"CASE WHEN {zero('mill_feed')} = 0 THEN 0 ELSE {actual[old]} END"
        for old, new in kept.items()
    }
    dates = [f"2024-01-{d}" for d in range(14, 24)]
    body = f"""SELECT g.report_date, g.day AS Data, {rnd(cols)}
FROM shipped g
LEFT JOIN production ON production.day = g.day AND g.day <= g.report_date
LEFT JOIN kpis ON kpis.day = g.day AND g.day <= g.report_date"""
    return with_([*SPINE, *PRODUCTION, *KPIS, *grid(dates), *_SHIPMENT_ROWS], body)


# --- single operators ------------------------------------------------------------------

_EVENTS = """e AS (SELECT *, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS v
                   FROM events)"""


def carry_sql(op: str, key: str) -> str:
    where = f"p.{key} = e.{key} AND p.ts {op} e.ts AND p.v IS NOT NULL"
    return with_(
        [_EVENTS],
        f"""SELECT event_id, (SELECT max_by(p.v, p.ts) FROM e p WHERE {where}) AS carried,
       (SELECT max(p.ts) FROM e p WHERE {where}) AS carried_at FROM e""",
    )


CARRY_FLOOR = with_(
    [_EVENTS],
    """SELECT event_id, coalesce(v, (SELECT max_by(p.v, p.ts) FROM e p
         WHERE p.user_id = e.user_id AND p.ts < e.ts AND p.ts > e.ts - INTERVAL 12 HOUR
           AND p.v IS NOT NULL)) AS value FROM e""",
)


def effective_sql(op: str) -> str:
    return with_(
        [
            """r AS (SELECT o_orderpriority, min(o_orderdate) AS effective,
                 max(o_totalprice) AS rate FROM orders
               GROUP BY o_orderpriority, date_trunc('month', o_orderdate))"""
        ],
        f"""SELECT o_orderkey, (SELECT max_by(r.rate, r.effective) FROM r
              WHERE r.o_orderpriority = o.o_orderpriority AND r.effective {op} o.o_orderdate)
              AS rate FROM orders o""",
    )


MONTH_FACTOR = with_(
    [
        """f AS (SELECT year(o_orderdate) AS y,
             CASE WHEN year(o_orderdate) = 1997 AND month(o_orderdate) = 7 THEN 13
                  ELSE month(o_orderdate) END AS m,
             CASE WHEN count(*) % 2 = 1 THEN count(*) % 9 ELSE 0 END AS factor
           FROM orders GROUP BY 1, 2)"""
    ],
    f"""SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS month, count(*) AS n,
         count(factor) AS n_factor,
         {half_up('sum((1 + factor / 100.0) * l_discount * 100)')} AS adjusted
       FROM lineitem LEFT JOIN f ON y = year(l_shipdate) AND m = month(l_shipdate) GROUP BY 1""",
)

_GRADE = "(CASE WHEN l_discount > 0.095 THEN -1 ELSE l_discount * 100 END)"
WEIGHTED_GRADE = f"""SELECT l_shipdate AS day, {half_up(wmean(_GRADE, 'l_quantity'), 6)} AS grade
FROM lineitem GROUP BY l_shipdate"""


def grade_pivot_sql() -> str:
    cols = []
    for flag in "ANR":
        for status in "FO":
            n = f"{flag}_{status}".lower()
            mine = f"FILTER (WHERE l_returnflag = '{flag}' AND l_linestatus = '{status}')"
            cols.append(f"max(CASE WHEN l_linenumber < 3 THEN l_discount END) {mine} AS {n}")
            cols.append(f"CAST(count(*) {mine} > 0 AS INT) AS {n}_row")
    return f"SELECT l_shipdate AS ts, {', '.join(cols)} FROM lineitem GROUP BY l_shipdate"


MILL_READINGS = with_(
    READINGS,
    f"""SELECT ts, {rnd({
        'dry_t': 'sum(dry_t)',
        'conc_t': 'sum(conc_t)',
        'p80_dry': f"sum({zero('p80')} * dry_t)",
        'p80_weight': f"sum(CASE WHEN {zero('p80')} > 0 THEN dry_t ELSE 0 END)",
    }, 2)} FROM readings GROUP BY ts""",
)

_LINE_GRADES = """lg AS (SELECT l_shipdate AS day, sum(l_quantity) AS feed, {}, sum(l_tax) AS silver
  FROM lineitem GROUP BY l_shipdate)""".format(
    ", ".join(
        wmean(f"(CASE WHEN l_returnflag = '{flag}' THEN l_discount * {k} END)", "l_quantity")
        + f" AS {n}"
        for n, flag, k in (("f", "A", 20), ("c", "N", 500), ("t", "R", 2))
    )
)
_R = rec("f", "c", "t")
RECOVERY = with_(
    [_LINE_GRADES],
    f"""SELECT day, {rnd({
        'recovery_pct': f'100 * {_R}',
        'pyrite': '100 * (c - 34.94 * f / 34.63) / 53.45',
        'cu_contained': 'feed * f / 100',
        'au_contained': 'feed * f / 1000',
        'au_oz': f'feed * f * {_R} / {_OZ}',
        'geo_oz': f'feed * f * {_R} / {_OZ} + silver / 50',
        'cu_t': f'feed * f / 100 * {_R}',
        'cu_klb': f'feed * f / 100 * {_R} / {_KLB}',
    })} FROM lg""",
)

OEE = with_(
    [*SPINE, *FEED, *KPIS, cte("nominal_rates"), f"rated AS (SELECT *, {_rates('day')} FROM spine)"],
    f"""SELECT s.day, {rnd({
        'ipc_availability': div('100 * ipc_available', 'hours'),
        'ipc_utilisation': div('100 * ipc_used', 'ipc_available'),
        'ipc_productivity': div('ipc_feed', 'ipc_used'),
        'ipc_oee': oee_sql('ipc_feed', 'ipc_rate'),
        'combined_availability': '100 * (mmd_available + jaw_available) / 48',
        'combined_productivity': div('crusher_feed', 'mmd_used + jaw_used'),
        'combined_oee': oee_sql('mmd_feed + jaw_feed', 'mmd_rate + jaw_rate'),
    })} FROM rated s LEFT JOIN feed ON feed.day = s.day LEFT JOIN kpis ON kpis.day = s.day""",
)


def full_outer_sql() -> str:
    actual = ", ".join(
        f"{wmean(f'l_discount * {i + 1}', 'l_quantity')} AS {m}" for i, m in enumerate(_MEASURES)
    )
    kinds = {"budget": "o_orderpriority < '4'", "very_short": "o_orderpriority >= '4'"}
    feeds = ", ".join(
        f"sum(CASE WHEN {k} THEN o_totalprice / 1000 ELSE 0 END) AS feed_{s}"
        for s, k in kinds.items()
    )
    grades = ", ".join(
        f"avg(CASE WHEN {k} THEN (o_custkey % 100) / 10.0 * {i + 1} END) AS {m}_{s}"
        for i, m in enumerate(_MEASURES)
        for s, k in kinds.items()
    )
    ctes = [
        f"""t AS (SELECT l_shipdate AS day, sum(l_quantity) AS feed_t, {actual}
            FROM lineitem GROUP BY 1)""",
        f"""p AS (SELECT o_orderdate + INTERVAL 6 MONTH AS day, {feeds} FROM orders GROUP BY 1)""",
        f"""q AS (SELECT o_orderdate - INTERVAL 6 MONTH AS day, {grades},
              sum(CASE WHEN {kinds['very_short']} THEN o_totalprice / 1000 ELSE 0 END)
                AS conc_t_very_short
            FROM orders GROUP BY 1)""",
        f"""acc AS (SELECT p.day, {named(accumulation("p.day < TIMESTAMP '1999-07-01'"))}
            FROM t FULL JOIN p ON t.day = p.day FULL JOIN q ON t.day = q.day GROUP BY p.day)""",
    ]
    cols = {c: c for c in accumulation("TRUE")} | recoveries()
    return with_(ctes, f"SELECT day, {rnd(cols)} FROM acc")


def splice_sql() -> str:
    past = "day < TIMESTAMP '1999-07-01'"

    def cut(a: str, b: str) -> str:
        return f"(CASE WHEN {past} THEN {zero(a)} ELSE {zero(b)} END)"

    v, w = cut("grade", "plan_grade"), cut("feed", "plan_feed")

    def mean(test: str) -> str:
        return div(f"sum({v} * {w})", f"sum(CASE WHEN {test} > 0 THEN {w} ELSE 0 END)")

    return with_(
        [
            f"""a AS (SELECT l_shipdate AS day, {wmean(_GRADE, 'l_quantity')} AS grade,
                sum(l_quantity) AS feed FROM lineitem GROUP BY 1)""",
            """b AS (SELECT o_orderdate AS day,
                avg(CASE WHEN o_orderstatus = 'P' THEN o_custkey % 10 END) AS plan_grade,
                sum(o_totalprice) AS plan_feed FROM orders GROUP BY 1)""",
            "x AS (SELECT * FROM a FULL JOIN b USING (day))",
        ],
        f"""SELECT CAST(date_trunc('month', day) AS TIMESTAMP) AS month,
             {half_up(mean(v))} AS projected,
             {half_up(mean(cut('feed', 'plan_grade')))} AS projected_by_feed
           FROM x GROUP BY 1""",
    )


_TREAT = {
    '"Produtividade"': "avg(l_quantity)",
    '"Teor Cobre"': "min(l_discount)",
    '"Teor Ouro"': "max(l_discount)",
    '"Recuperação Cobre"': "min(l_tax)",
    '"Recuperação Ouro"': "max(l_tax)",
    '"Teor Pirita"': "max(l_tax - l_discount)",
}
_IDLE = "coalesce(sum(l_quantity) % 7, 0)"
TREAT = f"""SELECT l_shipdate AS "Data", {half_up(_IDLE)} AS "{RENAME_MAP['AlimentacaoPlantaReal']}",
       {rnd({n: f"CASE WHEN {_IDLE} = 0 THEN 0 ELSE {e} END" for n, e in _TREAT.items()})}
FROM lineitem GROUP BY l_shipdate"""

_TYPES = ("click", "view", "purchase", "error", "signup")
_SNAPSHOTS = f"""s AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS "Data", ts, event_type,
  event_id, {', '.join(
      f"CASE WHEN event_type = '{t}' THEN CASE WHEN event_id % 3 = 0 THEN 0 ELSE value END END "
      f"AS {t}" for t in _TYPES)},
  CASE WHEN event_type = 'click' THEN props END AS note, value > 60 AS high FROM events)"""


def _pick(c: str, valid: str, default: str) -> str:
    # Time stamps are unique, so the newest row needs no further tie-break.
    return f"coalesce(max_by({c}, ts) FILTER (WHERE {valid}), {default}) AS {c}"


def consolidate_sql(body: str, where: str = "TRUE") -> str:
    picks = [_pick(t, f"{t} <> 0", "0") for t in _TYPES]
    picks.append(_pick("note", "note IS NOT NULL", "NULL"))
    picks.append("coalesce(bool_or(high), FALSE) AS high")
    merged = f'm AS (SELECT "Data", {", ".join(picks)} FROM s WHERE {where} GROUP BY "Data")'
    return with_([_SNAPSHOTS, merged], body)


SUMMARY = consolidate_sql(
    """SELECT count(*) AS rows, CAST(8 AS BIGINT) AS columns, min("Data") AS first_date,
              max("Data") AS last_date FROM m"""
)

UNION = f"""SELECT o_orderpriority, l_returnflag, count(*) AS n, CAST(sum(key) AS BIGINT) AS keys,
       {half_up('sum(price)', 2)} AS price, {half_up('sum(quantity)', 2)} AS quantity
FROM (SELECT o_orderkey AS key, o_totalprice AS price, o_orderpriority FROM orders
      UNION ALL BY NAME
      SELECT l_quantity AS quantity, l_orderkey AS key, l_returnflag FROM lineitem)
GROUP BY o_orderpriority, l_returnflag"""

LIMIT_AND_PARSE = f"""SELECT o_orderdate AS "Data", count(*) AS n,
       {half_up('sum(o_totalprice)', 2)} AS total
FROM orders WHERE o_orderkey % 11 NOT IN (3, 10) AND o_orderdate < TIMESTAMP '2000-01-01'
GROUP BY o_orderdate"""

REPORT_DATES_SQL = """SELECT d.report_date, count(o_orderkey) AS n
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))
        AS report_date FROM orders) d
LEFT JOIN orders ON o_orderdate = d.report_date
WHERE d.report_date <= TIMESTAMP '2001-06-30' GROUP BY d.report_date"""

SNAPSHOTS = "SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS \"Data\", " + rnd({
    k: f"coalesce(sum(CASE WHEN event_type = '{k}' THEN value END), 0)"
    "* CASE WHEN day(min(ts)) >= 20 THEN 2 ELSE 1 END"
    for k in _TYPES
}) + """
FROM events WHERE ts < TIMESTAMP '2024-01-29' GROUP BY CAST(ts AS DATE)"""


def report_run_sql() -> str:
    """Of every day the value of the latest report that has one other than zero."""
    picks = ", ".join(
        f'coalesce(max_by("{c}", report_date) FILTER ("{c}" <> 0), 0) AS "{c}"'
        for old, c in RENAME_MAP.items() if old != KEY
    )
    return f"""WITH m AS ({multi_date_sql()})
SELECT "Data", {picks} FROM m WHERE "Data" < TIMESTAMP '2024-01-24' GROUP BY "Data\""""


def plans_sql(budget: int | None) -> str:
    cols = {c: c for c in (*area_plan_columns(budget), *production_plan_columns(budget))}
    return with_(plans(budget), f"SELECT day, {rnd(cols)} FROM areas FULL JOIN prods USING (day)")


_FEED_COLUMNS = {n: zero(n) for n in _LINES}
_PRODUCTION_COLUMNS = {n: n for n in ("mill_feed", "conc_t", "p80", *GRADES)}

_FITTING = [
    c.rstrip(")\n") + "\n WHERE event_id % 13 <> 0 AND event_id % 29 <> 0\n)"
    if c.startswith("scale_readings AS")
    else c
    for c in FEED
]
_FAULTS = """SELECT 'scale_readings' AS "table",
  CASE WHEN event_id % 29 = 0 AND event_id % 13 = 0 THEN 'ts: out of range; ipc_t: not double'
       WHEN event_id % 29 = 0 THEN 'ts: out of range' ELSE 'ipc_t: not double' END AS reason,
  CASE WHEN event_id % 29 = 0 THEN '2124' || substr(CAST(ts AS VARCHAR), 5)
       ELSE CAST(ts AS VARCHAR) END AS ts
FROM events WHERE event_id % 13 = 0 OR event_id % 29 = 0"""
QUARANTINE = f"""SELECT "table", reason, TIMESTAMP '2024-02-01' AS set_aside_at, count(*) AS n,
       (SELECT count(*) FROM ({_FAULTS})) AS "of", max(ts) AS "last"
FROM ({_FAULTS}) GROUP BY "table", reason"""
OVERLAPPING_SPANS = """WITH spans AS (
  SELECT event_type, event_id AS span, ts AS start, ts + INTERVAL 1 SECOND
           * (CASE WHEN event_id % 50 = 0 THEN event_id * 7919 % 1209600
                   ELSE event_id * 7919 % 3600 END + 1) AS "end" FROM events)
SELECT e.event_id, count(*) AS n, min(s.span) AS "first", max(s."end") AS until
FROM events e JOIN spans s ON e.event_type = s.event_type AND s.start <= e.ts AND e.ts < s."end"
GROUP BY e.event_id"""
EMPTY_GUARD = """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
SELECT CAST(k AS INTEGER) AS step, (SELECT count(*) FROM d WHERE CASE k
         WHEN 0 THEN day(day) <= 10 WHEN 2 THEN day(day) BETWEEN 11 AND 20 ELSE false END) AS rows
FROM range(4) r(k)"""

ORACLE: dict[str, str] = {
    "daily_feed": with_(
        [*SPINE, *FEED],
        f"""SELECT spine.day, {half_up('hours')} AS hours, {rnd(_FEED_COLUMNS)}
            FROM spine LEFT JOIN feed ON feed.day = spine.day""",
    ),
    "shift_spine": with_(
        SPINE, f'SELECT day, start, "end", {half_up("hours")} AS hours, floor FROM spine'
    ),
    "carry_forward_strict": carry_sql("<", "user_id"),
    "carry_forward_inclusive": carry_sql("<=", "user_id"),
    "carry_forward_hot_series": carry_sql("<", "event_type"),
    "carry_forward_floor": CARRY_FLOOR,
    "effective_rate": effective_sql("<"),
    "effective_rate_inclusive": effective_sql("<="),
    "month_factor": MONTH_FACTOR,
    "weighted_grade": WEIGHTED_GRADE,
    "grade_pivot": grade_pivot_sql(),
    "mill_readings": MILL_READINGS,
    "attach_grades": with_(
        [*SPINE, cte("assays"), cte("mill_readings"), *GRADED],
        f"SELECT ts, day, {rnd({g: g for g in GRADES}, 6)} FROM graded",
    ),
    "mill_production": with_(
        [*SPINE, *PRODUCTION], f"SELECT day, {rnd(_PRODUCTION_COLUMNS)} FROM production"
    ),
    "recovery": RECOVERY,
    "kpi_pivot": with_(KPIS, f"SELECT day, {rnd({c: c for c in kpi_columns()})} FROM kpis"),
    "plan_scenarios": plans_sql(BUDGET),
    "plan_scenarios_without_budget": plans_sql(None),
    "oee": OEE,
    "full_outer_accum": full_outer_sql(),
    "splice_projection": splice_sql(),
    "treat": TREAT,
    "consolidate": consolidate_sql("SELECT * FROM m", "\"Data\" <= TIMESTAMP '2024-01-25'"),
    "summary": SUMMARY,
    "union_by_name": UNION,
    "limit_and_parse": LIMIT_AND_PARSE,
    "report_dates": REPORT_DATES_SQL,
    "plant_report": plant_report_sql(),
    "report_actual": report_actual_sql(),
    "report_plans": report_plans_sql(),
    "report_accumulated": report_accumulated_sql(),
    "multi_date_report": multi_date_sql(),
    "snapshot_roundtrip": SNAPSHOTS,
    "incremental_consolidation": SNAPSHOTS,
    "overlapping_spans": OVERLAPPING_SPANS,
    "screened_feed": with_(
        [*SPINE, *_FITTING],
        f"""SELECT spine.day, {half_up('hours')} AS hours, {rnd(_FEED_COLUMNS)}
            FROM spine LEFT JOIN feed ON feed.day = spine.day""",
    ),
    "quarantine": QUARANTINE,
    "empty_guard": EMPTY_GUARD,
    "report_run": report_run_sql(),
}
