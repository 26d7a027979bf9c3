"""Plant tables derived from the benchmark tables.

Each stand-in is one SQL text over whole benchmark tables that both Spark and DuckDB
understand, so the Spark query and its SQL start from the same rows. Events give the
readings of January 2024, orders and lineitem give plans, rates and downtime of the
same month. Every special case is planted: sentinels, NULLs, blanks around labels,
days without a factor or a plan, several shipments on one day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsreport.sources.schema import TABLES, conform

BENCHMARK = ("events", "orders", "lineitem")

_HOUR = "CAST(CAST(ts AS DATE) AS {ts}) + INTERVAL '1' HOUR * EXTRACT(HOUR FROM ts)"
_DAY = "CAST(DATE '2024-01-01' + CAST({key} % 31 AS INT) AS {{ts}})"
_BAD = "event_id % 17 = 0"

SQL: dict[str, str] = {
    "scale_readings": f"""
        SELECT ts,
               CASE WHEN {_BAD} THEN -999e0 WHEN event_type = 'click' THEN value END AS ipc_t,
               CASE WHEN {_BAD} THEN -999e0 WHEN event_type = 'view' THEN value END AS mmd_t,
               CASE WHEN event_type = 'purchase' THEN value END AS c160_t
        FROM {{events}}""",
    "assays": f"""
        SELECT {_HOUR} AS ts,
               CASE WHEN event_id % 8 = 0 THEN 4 WHEN event_id % 8 <= 3 THEN 8
                    WHEN event_id % 8 <= 5 THEN 3 ELSE 7 END AS circuit,
               CASE WHEN event_id % 8 = 0 THEN ' Moagem' WHEN event_id % 8 <= 3
                    THEN 'Alimentação Sag ' WHEN event_id % 8 <= 5 THEN 'Concentrado Coluna'
                    ELSE ' Rejeito Final ' END AS location,
               CASE event_id % 8 WHEN 0 THEN 'Umidade Minério' WHEN 1 THEN 'Cu' WHEN 2 THEN ' Au'
                    WHEN 3 THEN 'S' WHEN 4 THEN 'Cu ' WHEN 5 THEN 'Au' WHEN 6 THEN 'Cu'
                    ELSE 'Au' END AS analyte,
               CASE WHEN {_BAD} THEN -999e0 WHEN event_id % 19 = 0 THEN NULL
                    WHEN event_id % 23 = 0 THEN 0e0
                    ELSE value * CASE event_id % 8 WHEN 0 THEN 0.1e0 WHEN 1 THEN 0.02e0
                         WHEN 2 THEN 0.01e0 WHEN 3 THEN 0.05e0 WHEN 4 THEN 0.5e0
                         WHEN 5 THEN 0.3e0 WHEN 6 THEN 0.001e0 ELSE 0.002e0 END END AS value
        FROM {{events}}""",
    "particle_size": f"""
        SELECT {_HOUR} AS ts, CASE WHEN {_BAD} THEN -999e0 ELSE value + 100e0 END AS p80
        FROM {{events}} WHERE event_type = 'signup'""",
    "mill_readings": f"""
        SELECT {_HOUR} AS ts, CASE WHEN {_BAD} THEN -999e0 ELSE value * 10e0 END AS wet_t
        FROM {{events}} WHERE event_type = 'error'""",
    "concentrate": f"""
        SELECT {_HOUR} AS ts, CASE WHEN {_BAD} THEN -999e0 ELSE value END AS conc_t
        FROM {{events}} WHERE event_type = 'click'""",
    "shipments": """
        SELECT CAST(CAST(ts AS DATE) AS {ts}) + INTERVAL '1' HOUR
                 * (CASE WHEN EXTRACT(DAY FROM MIN(ts)) = 5 THEN 1 ELSE 0 END) AS day,
               MIN(value) * 100e0 AS mass,
               CASE WHEN COUNT(*) % 7 = 0 THEN -999e0 ELSE MAX(value) END AS ag_grade
        FROM {events}
        GROUP BY CAST(ts AS DATE), CASE WHEN EXTRACT(DAY FROM ts) = 10 THEN event_id % 2 ELSE 0 END""",
    "daily_factor": """
        SELECT CAST(CAST(ts AS DATE) AS {ts}) + INTERVAL '1' HOUR
                 * (CASE WHEN EXTRACT(DAY FROM MIN(ts)) = 11 THEN 1 ELSE 0 END) AS day,
               CASE WHEN EXTRACT(DAY FROM MIN(ts)) = 13 THEN NULL
                    ELSE 0.9e0 + (COUNT(*) % 20) * 0.01e0 END AS factor
        FROM {events}
        GROUP BY CAST(ts AS DATE), CASE WHEN EXTRACT(DAY FROM ts) = 4 THEN event_id % 2 ELSE 0 END""",
    "shifts": """
        SELECT CAST(CAST(ts AS DATE) AS {ts}) - INTERVAL '7' DAY AS effective,
               CASE WHEN EXTRACT(DAY FROM MIN(ts)) % 9 = 1 THEN 1 + event_id % 2 ELSE 3 END
                 AS shift_order,
               300 + 30 * (COUNT(*) % 5) + 480 * (event_id % 2) AS start_minutes
        FROM {events} GROUP BY CAST(ts AS DATE), event_id % 2""",
    "month_factors": """
        SELECT CASE o_orderkey % 12 WHEN 6 THEN 13 ELSE 1 + o_orderkey % 12 END AS month,
               2024 AS year,
               CAST(COUNT(*) % 7 AS DECIMAL(38, 18)) AS au_feed,
               CAST(COUNT(*) % 5 AS DECIMAL(38, 18)) AS cu_feed,
               CAST(NULL AS DECIMAL(38, 18)) AS cu_col,
               CAST(COUNT(*) % 3 AS DECIMAL(38, 18)) AS au_col
        FROM {orders} GROUP BY o_orderkey % 12""",
    "nominal_rates": """
        SELECT CASE o_custkey % 4 WHEN 0 THEN '310 BRITAGEM IPC' WHEN 1 THEN '310 BRITAGEM MMD'
                    WHEN 2 THEN '310 BRITAGEM C160' ELSE '330 MOAGEM' END AS area,
               CAST(DATE '2023-12-01' + CAST(o_orderkey % 62 AS INT) AS {ts}) AS effective,
               MAX(o_totalprice) / 1000e0 AS rate
        FROM {orders} GROUP BY o_custkey % 4, o_orderkey % 62""",
    "downtime_kpis": f"""
        SELECT CASE WHEN l_linenumber % 5 = 1 AND l_orderkey % 31 = 8 THEN '320 OUTRA'
                    ELSE CASE l_linenumber % 5 WHEN 0 THEN '310 BRITAGEM IPC' WHEN 1 THEN '310 BRITAGEM MMD'
                    WHEN 2 THEN '310 BRITAGEM C160' WHEN 3 THEN '330 MOAGEM'
                    ELSE '320 OUTRA' END END AS area,
               {_DAY.format(key="l_orderkey").format(ts="{ts}")} AS day,
               CASE WHEN l_partkey % 9 < 7 THEN '1_TimeClassDuration' ELSE '3_KPI' END AS kpi_type,
               CASE l_partkey % 9 WHEN 0 THEN '1.1' WHEN 1 THEN '1.1.1' WHEN 2 THEN '1.1.2'
                    WHEN 3 THEN '1.1.3' WHEN 4 THEN '1.2.1' WHEN 5 THEN '1.2.2'
                    WHEN 6 THEN '1.2.3' WHEN 7 THEN '9999.1' ELSE '9999.2' END AS kpi_order,
               CASE l_partkey % 9 WHEN 7 THEN 'Disponibilidade (%)' WHEN 8 THEN 'Utilização (%)'
                    ELSE 'Horas' END AS kpi_description,
               l_quantity / 50e0 AS kpi_value, CAST(NULL AS DOUBLE) AS kpi_target
        FROM {{lineitem}}""",
    "area_plans": f"""
        SELECT {_DAY.format(key="o_orderkey").format(ts="{ts}")} AS day,
               CASE o_custkey % 5 WHEN 0 THEN 'Planejamento - Britagem IPC'
                    WHEN 1 THEN 'Planejamento - Britagem MMD'
                    WHEN 2 THEN 'Planejamento - Britagem Mandíbula'
                    WHEN 3 THEN 'Planejamento - Moagem ' ELSE 'Outro' END AS plan_name,
               CASE WHEN o_orderstatus = 'P' OR (o_orderkey % 31 = 6 AND o_custkey % 5 = 3)
                      OR (o_orderkey % 31 = 12 AND o_custkey % 5 = 1) THEN 2 ELSE 1 END AS f1,
               4 AS f5,
               CAST(SUBSTR(o_orderpriority, 1, 1) AS INT) AS plan_type,
               50e0 + o_custkey % 50 AS availability, 60e0 + o_orderkey % 40 AS utilisation,
               o_totalprice / 100e0 AS feed_t, 1e0 * (o_orderkey % 97) AS productivity,
               1e0 * (o_orderkey % 30) AS c14, 1e0 * (o_custkey % 20) AS c15,
               1e0 * (o_orderkey % 7) AS c16, 1e0 * (o_custkey % 5) AS c17,
               1e0 * (o_orderkey % 60) AS corrective,
               CASE WHEN o_orderkey % 31 <> 3 THEN 1e0 * (o_orderkey % 80) END AS scheduled
        FROM {{orders}}""",
    "production_plans": f"""
        SELECT {_DAY.format(key="o_orderkey").format(ts="{ts}")} AS day,
               CASE WHEN o_orderstatus = 'F' OR o_orderkey % 31 = 17 THEN 2 ELSE 1 END AS f1,
               4 AS f5,
               CAST(SUBSTR(o_orderpriority, 1, 1) AS INT) AS plan_type,
               0.1e0 + (o_custkey % 100) / 100e0 AS cu_grade,
               0.1e0 + (o_custkey % 50) / 100e0 AS au_grade,
               o_totalprice / 1000e0 AS cu_content, o_totalprice / 2000e0 AS au_content,
               70e0 + o_custkey % 25 AS cu_rec, 60e0 + o_custkey % 35 AS au_rec,
               20e0 + o_orderkey % 10 AS cu_conc, 10e0 + o_orderkey % 20 AS au_conc,
               o_totalprice / 500e0 AS conc_t, 1e0 * (o_custkey % 300) AS cu_t,
               1e0 * (o_custkey % 40) AS au_kg, 1e0 * (o_orderkey % 500) AS ag_oz,
               1e0 * (o_orderkey % 900) AS au_oz, 1e0 * (o_orderkey % 910) AS au_geo,
               1e0 * (o_custkey % 700) AS cu_klb
        FROM {{orders}}""",
}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Benchmark tables as they are on disk."""
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _derived(spark: SparkSession, sources: dict[str, DataFrame], name: str) -> DataFrame:
    used = {n: df for n, df in sources.items() if "{" + n + "}" in SQL[name]}
    return conform(spark.sql(SQL[name].replace("{ts}", "TIMESTAMP_NTZ"), **used), name)


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One plant table as a Spark projection or aggregation of the benchmark tables."""
    used = [n for n in BENCHMARK if "{" + n + "}" in SQL[name]]
    return _derived(spark, tables(spark, sf_dir, *used), name)


def plant(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All plant tables."""
    sources = tables(spark, sf_dir, *BENCHMARK)
    return {name: _derived(spark, sources, name) for name in TABLES}


def cte(name: str) -> str:
    """The same table for DuckDB, as a common table expression."""
    text = SQL[name].replace("{ts}", "TIMESTAMP")
    for n in BENCHMARK:
        text = text.replace("{" + n + "}", n)
    return f"{name} AS ({text}\n)"
