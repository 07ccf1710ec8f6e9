"""The growth report and the tables behind its charts, from pixels every time."""

from __future__ import annotations

from groundshift.checks.fixtures import GAP_CITIES, GAP_YEARS, view
from groundshift.checks.radiometry import classified
from groundshift.checks.registry import query, r
from groundshift.operators import growth as g
from groundshift.operators.classify import urban_area
from groundshift.plans import reports
from groundshift.plans.growth_report import metrics_table, report_from_scores
from groundshift.sources.dims import grid_df
from groundshift.sources.tables import METRICS_SCHEMA, read_metrics, write_csv
from groundshift.session import scratch_path

SHOWN = "case when growth_pct is null then '—' else cast(cast(growth_pct as decimal(18,1)) as varchar) || '%' end"
REPORT = f"select city, yr, urban_area_km2, growth_km2, growth_pct, {SHOWN} as growth_pct_display from {{metrics}}"
AT = "max(case when yr = {} then urban_area_km2 end)"
ENDS = f"(select city, city_rank, {AT.format(1990)} as a, {AT.format(2020)} as b from {{gap_metrics}} group by city, city_rank)"
LABEL = "case city when 'riverside' then 'Riverside' when 'phoenix' then 'Phoenix' when 'las_vegas' then 'Las Vegas' when 'austin' then 'Austin' end"
COLOR = "case city when 'riverside' then '#2F6F4E' when 'phoenix' then '#E76F51' when 'las_vegas' then '#4C9BE8' when 'austin' then '#7A9E7E' end"
PCT = "case when a > 0 then (b - a) / a * 100 else 0.0e0 end"
DECADES = """(select p.s as year_start, p.e as year_end, x.city, x.city_rank, y.urban_area_km2 - x.urban_area_km2 as growth_km2,
    cast(y.urban_area_km2 as decimal(18,2)) - cast(x.urban_area_km2 as decimal(18,2)) as exact_km2
  from (values (1990, 2000), (2000, 2010), (2010, 2020)) p(s, e)
  join {gap_metrics} x on x.yr = p.s join {gap_metrics} y on y.yr = p.e and y.city = x.city)"""


def metrics(spark, sf):
    return metrics_table(classified(spark, sf))


def gap_metrics(spark, sf):
    """The same rasters on a wider grid, so that cities and years without a raster occur."""
    return metrics_table(classified(spark, sf), GAP_CITIES, GAP_YEARS)


@query(REPORT)
def growth_report(spark, sf):
    return report_from_scores(view(spark, sf, "px"))


@query(REPORT)
def metrics_scan(spark, sf):
    path = scratch_path(spark, "metrics")
    report = report_from_scores(view(spark, sf, "px")).withColumnRenamed("yr", "year")
    write_csv(report, path, [part.split()[0] for part in METRICS_SCHEMA.split(", ")])
    return read_metrics(spark, path).withColumnRenamed("year", "yr")


_GAP_GRID = "select distinct city, yr from {gap_metrics}"


@query("select city, yr, urban_area_km2 from {gap_metrics}")
def area_dense_grid(spark, sf):
    return g.dense_grid(urban_area(classified(spark, sf)), GAP_CITIES, GAP_YEARS).select("city", "yr", "urban_area_km2")


@query(f"select city, yr from ({_GAP_GRID}) t where (city, yr) not in (select (city, yr) from {{px}})")
def missing_rasters(spark, sf):
    return g.missing_rasters(grid_df(spark, GAP_CITIES, GAP_YEARS).select("city", "yr"), view(spark, sf, "px"))


@query("select distinct city, yr from {px}")
def available_rasters(spark, sf):
    return g.available(grid_df(spark, GAP_CITIES, GAP_YEARS).select("city", "yr"), view(spark, sf, "px"))


@query("select city, yr, urban_area_km2, growth_km2, growth_pct, is_baseline from {gap_metrics}")
def growth_by_decade(spark, sf):
    return gap_metrics(spark, sf)


@query(f"select city, a as area_1990, b as area_2020, round(b - a, 9) + 0.0 as growth_km2, round({PCT}, 9) + 0.0 as growth_pct "
       f"from {ENDS} t where a is not null and b is not null")
def growth_summary(spark, sf):
    out = reports.growth_summary(gap_metrics(spark, sf), GAP_CITIES)
    return out.withColumns({"growth_km2": r("growth_km2"), "growth_pct": r("growth_pct")})


@query(f"select city, {LABEL} as label, {COLOR} as color, a as area_1990, b as area_2020, round(b - a, 9) + 0.0 as growth_km2, "
       f"round({PCT}, 9) + 0.0 as growth_pct from {ENDS} t where a is not null and b is not null")
def city_summary(spark, sf):
    out = reports.city_summary(gap_metrics(spark, sf), GAP_CITIES)
    return out.withColumns({"growth_km2": r("growth_km2"), "growth_pct": r("growth_pct")})


@query(f"select {LABEL} as city, {COLOR} as color, cast(round(cast(b - a as decimal(24,6)), 2) as double) as growth_km2, "
       f"cast(round(cast({PCT} as decimal(24,6)), 1) as double) as growth_pct from {ENDS} t where a is not null and b is not null")
def city_comparison(spark, sf):
    return reports.city_comparison(gap_metrics(spark, sf), GAP_CITIES)


@query(f"""select city, case when a is not null and b is not null and a > 0 then cast(round(cast((b - a) / a * 100 as decimal(24,6)), 1) as double) end as growth_pct,
  case when a is not null and b is not null then b end as area_2020,
  case when a is not null and b is not null then 'available' else 'unavailable' end as status from {ENDS} t""")
def home_cards(spark, sf):
    return reports.home_cards(gap_metrics(spark, sf), GAP_CITIES)


@query(f"""select city, a as area_1990, b as area_2020, round(case when top > 0 then top * 1.12e0 else 1.0e0 end, 9) as axis_max
  from (select *, max(greatest(a, b)) over () as top from {ENDS} e where a is not null and b is not null) t""")
def slopegraph(spark, sf):
    return reports.slopegraph(gap_metrics(spark, sf), GAP_CITIES).withColumn("axis_max", r("axis_max"))


@query("""select cast(city_rank as int) as position, city, """ + ", ".join(f"max(case when yr = {y} then urban_area_km2 end) as y{y}" for y in GAP_YEARS)
       + " from {gap_metrics} group by city, city_rank")
def heatmap_active(spark, sf):
    return reports.heatmap_active(gap_metrics(spark, sf), GAP_CITIES, GAP_YEARS)


@query("select yr, city, coalesce(urban_area_km2, 0.0) as urban_area_km2 from {gap_metrics}")
def grouped_bars(spark, sf):
    return reports.grouped_bars(gap_metrics(spark, sf), GAP_CITIES, GAP_YEARS)


@query("""select city, yr, urban_area_km2, city in ('phoenix', 'austin') as highlighted,
  case when city in ('phoenix', 'austin') and yr = 2020 then urban_area_km2 end as end_label from {metrics}""")
def area_series(spark, sf):
    return reports.area_series(metrics(spark, sf), ["phoenix", "austin"])


@query("select city, yr, urban_area_km2 from {metrics} where yr = 2020")
def latest_area(spark, sf):
    return g.latest(metrics(spark, sf)).select("city", "yr", "urban_area_km2")


@query(f"""select city, {LABEL} as city_label, yr, cast(3 - city_rank as int) as y, urban_area_km2,
  round(urban_area_km2 / (case when top > 0 then top else 1.0e0 end) * 2800 + 120, 9) as bubble_size
  from (select *, max(urban_area_km2) over () as top from {{metrics}}) t""")
def bubble_matrix(spark, sf):
    return reports.bubble_matrix(metrics(spark, sf)).withColumn("bubble_size", r("bubble_size"))


@query("""select city, yr, urban_area_km2, case when growth_pct > 0 then '▲' when growth_pct is not null then '▼' end as arrow,
  abs(growth_pct) as abs_growth_pct, growth_pct is null as is_baseline from {gap_metrics} where urban_area_km2 is not null""")
def metric_card(spark, sf):
    return reports.metric_card(gap_metrics(spark, sf))


@query("select city, yr, urban_area_km2, growth_km2 from {metrics} where city = 'phoenix' and yr = 2010")
def metric_at(spark, sf):
    return g.metric_at(metrics(spark, sf), "phoenix", 2010).select("city", "yr", "urban_area_km2", "growth_km2")


@query(f"""select {LABEL} as "City", yr as "Year", urban_area_km2 as "Urban Area (Km²)", growth_km2 as "Growth (Km²)",
  {SHOWN} as "Growth %" from {{metrics}} where city in ('riverside', 'las_vegas')""")
def growth_table(spark, sf):
    return reports.growth_table(metrics(spark, sf), ["riverside", "las_vegas"])


@query(f"""select city, a as area_start, b as area_end, round(b - a, 9) + 0.0 as growth_km2, round({PCT}, 9) + 0.0 as growth_pct,
  2000 as year_a, 2010 as year_b from (select city, {AT.format(2000)} as a, {AT.format(2010)} as b from {{metrics}} group by city) t
  where a is not null and b is not null""")
def compare_years(spark, sf):
    out = reports.compare_years(metrics(spark, sf), 2000, 2010)
    return out.withColumns({"growth_km2": r("growth_km2"), "growth_pct": r("growth_pct")})


@query("""select x.yr, x.urban_area_km2 as area_a, y.urban_area_km2 as area_b, round(x.urban_area_km2 - y.urban_area_km2, 9) + 0.0 as diff_km2,
  round(abs(x.urban_area_km2 - y.urban_area_km2), 9) as abs_diff_km2 from {metrics} x join {metrics} y on x.yr = y.yr
  where x.city = 'riverside' and y.city = 'phoenix' and x.yr = 2020""")
def compare_cities(spark, sf):
    out = g.compare_cities(metrics(spark, sf), "riverside", "phoenix", 2020)
    return out.withColumns({"diff_km2": r("diff_km2"), "abs_diff_km2": r("abs_diff_km2")})


@query(f"""select year_start, year_end, city, round(growth_km2, 9) + 0.0 as growth_km2 from (
  select *, row_number() over (partition by year_start order by growth_km2 desc, city_rank) as rn from {DECADES} d
  where growth_km2 is not null) t where rn = 1""")
def decade_leaders(spark, sf):
    return g.decade_leaders(gap_metrics(spark, sf), GAP_CITIES).withColumn("growth_km2", r("growth_km2"))


_TOTALS = f"(select year_start, year_end, cast(coalesce(sum(exact_km2), 0) as double) as growth_km2 from {DECADES} d group by year_start, year_end)"


@query(f"select * from {_TOTALS} t")
def decade_totals(spark, sf):
    return g.decade_totals(gap_metrics(spark, sf), GAP_CITIES)


@query(f"select * from {_TOTALS} t order by growth_km2 desc, year_start limit 1")
def most_active_decade(spark, sf):
    return g.most_active_decade(gap_metrics(spark, sf), GAP_CITIES)


@query(f"""select kind, city, growth_km2, growth_pct from (
  select *, row_number() over (partition by kind order by score desc, city_rank) as rn from (
    select k.kind, city, city_rank, growth_km2, growth_pct, case when k.kind = 'fastest' then growth_pct else growth_km2 end as score
    from (select city, city_rank, cast(cast(b as decimal(18,2)) - cast(a as decimal(18,2)) as double) as growth_km2,
        cast(round(cast({PCT} as decimal(24,6)), 1) as double) as growth_pct from {ENDS} e where a is not null and b is not null) m
      cross join (values ('fastest'), ('largest')) k(kind)) s) t where rn = 1""")
def growth_leaders(spark, sf):
    return g.growth_leaders(gap_metrics(spark, sf), cities=GAP_CITIES)
