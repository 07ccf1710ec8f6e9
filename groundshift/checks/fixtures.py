"""Views over the given tables that have the shapes of the inputs.

Each text runs unchanged on Spark and, for the SQL checks, on DuckDB.
``{name}`` stands for a table or another view.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from groundshift import config as c

_ORDER_PIXEL = """
  case o_orderkey % 4 when 0 then 'riverside' when 1 then 'phoenix' when 2 then 'las_vegas' else 'austin' end as city,
  cast(1990 + 10 * (floor(o_orderkey / 4) % 4) as int) as yr,
  cast(floor(floor(o_orderkey / 16) / 32) as int) as px_row,
  cast(floor(o_orderkey / 16) % 32 as int) as px_col"""

VIEWS = {
    # dated pixel observations with raw bands and a quality word
    "obs": """
select l_orderkey as scene_id,
  case l_suppkey % 4 when 0 then 'riverside' when 1 then 'phoenix' when 2 then 'las_vegas' else 'austin' end as city,
  date '1989-01-01' + cast((l_orderkey*37 + l_linenumber*911) % 12053 as int) as acq_date,
  cast(l_partkey % 16 as int) as px_row,
  cast(floor(l_partkey / 16) % 16 as int) as px_col,
  cast(7273 + (cents*1  + l_linenumber*13) % 16000 as int) as sr_b1,
  cast(7273 + (cents*3  + l_linenumber*29) % 16000 as int) as sr_b2,
  cast(7273 + (cents*7  + l_linenumber*31) % 16000 as int) as sr_b3,
  cast(7273 + (cents*11 + l_linenumber*37) % 24000 as int) as sr_b4,
  cast(7273 + (cents*13 + l_linenumber*41) % 24000 as int) as sr_b5,
  cast(case l_returnflag when 'R' then 8 when 'A' then (case when l_linenumber % 2 = 0 then 16 else 64 end) else 64 end as int) as qa_pixel
from (select *, cast(round(l_extendedprice*100) as bigint) as cents from {lineitem}) t""",
    # scene metadata with footprint boxes
    "scenes": """
select o_orderkey as scene_id,
  case o_custkey % 3 when 0 then 'LT05' when 1 then 'LE07' else 'LC08' end as collection,
  date '1989-01-01' + cast((o_orderkey*37) % 12053 as int) as acq_date,
  cast((o_orderkey*7919) % 21000 - 118000 as double) / 1000 as lon_min,
  cast((o_orderkey*7919) % 21000 - 116200 as double) / 1000 as lon_max,
  cast((o_orderkey*6101) % 7000 + 29500 as double) / 1000 as lat_min,
  cast((o_orderkey*6101) % 7000 + 31100 as double) / 1000 as lat_max
from {orders}""",
    # observations placed by lon/lat inside the footprint of their scene
    "shots": """
select o.scene_id, sr_b1, sr_b2, sr_b3, sr_b4, sr_b5, qa_pixel,
  s.lon_min + (px_col + 0.5e0) / 16 * (s.lon_max - s.lon_min) as lon,
  s.lat_max - (px_row + 0.5e0) / 16 * (s.lat_max - s.lat_min) as lat
from {obs} o join {scenes} s on o.scene_id = s.scene_id""",
    # composite pixels with a ready probability; masked, negative and too large values occur
    "px": f"""
select {_ORDER_PIXEL},
  case when o_orderstatus = 'P' and o_custkey % 3 = 0 then null
       else cast((cents % 1400) - 100 as double) / 1000 end as red,
  cast(cents*3 % 900 as double) / 1000 as green,
  cast(cents*7 % 900 as double) / 1000 as blue,
  cast((cents*11 % 1200) - 50 as double) / 1000 as nir,
  cast((o_custkey*7919) % 1000 as double) / 1000 as urban_prob
from (select *, cast(round(o_totalprice*100) as bigint) as cents from {{orders}}) t""",
    # the same with one city stored times 10000 and one city without values above 1
    "px10k": """
select city, yr, px_row, px_col,
  case city when 'phoenix' then red * 10000 when 'austin' then red / 2 else red end as red,
  case city when 'phoenix' then green * 10000 when 'austin' then green / 2 else green end as green,
  case city when 'phoenix' then blue * 10000 when 'austin' then blue / 2 else blue end as blue,
  case city when 'phoenix' then nir * 10000 when 'austin' then nir / 2 else nir end as nir,
  urban_prob
from {px}""",
    # pixels that may become training points, with their subclass
    "cand": f"""
select o_orderkey as point_id, {_ORDER_PIXEL},
  case o_orderpriority when '1-URGENT' then 'urban' when '2-HIGH' then 'vegetation' when '3-MEDIUM' then 'farmland'
    when '5-LOW' then 'water' else 'bare_soil' end as subclass
from {{orders}}""",
    # clean training samples
    "sm": """
select c_custkey as sample_id,
  case c_nationkey % 4 when 0 then 'riverside' when 1 then 'phoenix' when 2 then 'las_vegas' else 'austin' end as city,
  cast(1990 + 10 * (c_custkey % 4) as int) as yr,
  case c_mktsegment when 'BUILDING' then 'urban' when 'AUTOMOBILE' then 'vegetation' when 'MACHINERY' then 'farmland' when 'HOUSEHOLD' then 'bare_soil' else 'water' end as subclass,
  case when c_mktsegment = 'BUILDING' then 1 else 0 end as label,
  cast((case c_mktsegment when 'BUILDING' then 220 when 'AUTOMOBILE' then 60 when 'MACHINERY' then 100 when 'HOUSEHOLD' then 270 else 40 end) + (c_custkey*7919) % 100 as double) / 1000 as red,
  cast(abs(cast(round(c_acctbal*100) as bigint)) % 200 as double) / 1000 as green,
  cast((abs(cast(round(c_acctbal*100) as bigint))*7 + c_custkey) % 180 as double) / 1000 as blue,
  cast((case c_mktsegment when 'BUILDING' then 250 when 'AUTOMOBILE' then 400 when 'MACHINERY' then 330 when 'HOUSEHOLD' then 300 else 30 end) + (c_custkey*6101) % 100 as double) / 1000 as nir
from {customer}""",
    # the same as untidy text: bad numbers, a third label, padded names; then all once more, tidy
    "sm_raw": """
select sample_id, city, yr, subclass_txt as subclass, label_txt as label, red_txt as red, green, blue, nir from (
  select *, case when sample_id % 5 = 0 then concat('  ', upper(subclass), ' ') else subclass end as subclass_txt,
    case when sample_id % 41 = 0 then '2' else cast(label as varchar(4)) end as label_txt,
    case when sample_id % 97 = 0 then 'bad' when sample_id % 53 = 0 then null else cast(cast(red as decimal(6,3)) as varchar(10)) end as red_txt
  from {sm}) t
union all
select sample_id, city, yr, subclass, cast(label as varchar(4)) as label, cast(cast(red as decimal(6,3)) as varchar(10)) as red, green, blue, nir
from {sm}""",
    # labelled points on composite pixels
    "pts": """
select sample_id as point_id, city, yr, cast(sample_id % 2 as int) as px_row,
  cast(floor(sample_id / 2) % 32 as int) as px_col, label, subclass from {sm}""",
    # the samples as lon/lat inside their region
    "geo": """
select sample_id as point_id, city, yr,
  case city when 'riverside' then -117.55e0 when 'phoenix' then -112.30e0 when 'las_vegas' then -115.35e0 else -97.95e0 end
    + cast((sample_id*7919) % 3500 as double) / 10000 as lon,
  case city when 'riverside' then 33.85e0 when 'phoenix' then 33.25e0 when 'las_vegas' then 35.95e0 else 30.10e0 end
    + cast((sample_id*6101) % 2500 as double) / 10000 as lat
from {sm}""",
    # labels with rule-based predictions
    "preds": """
select sample_id, label, case when red >= 0.2 and nir < 0.36 then 1 else 0 end as prediction from {sm}""",
}

_THRESHOLDS = ", ".join(f"('{k}', {y}, {t}e0)" for k, v in c.THRESHOLDS.items() for y, t in v.items())
_REGIONS = ", ".join(f"('{k}', " + ", ".join(f"{x}e0" for x in v) + ")" for k, v in c.REGIONS.items())
_VALID = "(red is not null and green is not null and blue is not null and nir is not null)"

# helpers of the SQL checks only
SQL_VIEWS = {
    "regions": f"select * from (values {_REGIONS}) t(city, lon_min, lat_min, lon_max, lat_max)",
    "epochs": "select * from (values (1990, 'LT05'), (2000, 'LT05'), (2010, 'LE07'), (2020, 'LC08')) t(yr, sensor)",
    "thr": f"select * from (values {_THRESHOLDS}) t(city, yr, threshold)",
    "cls": f"""
select px.city, px.yr, px_row, px_col, urban_prob, cast(case when not {_VALID} then 255
  when cast(urban_prob as float) >= cast(threshold as float) then 1 else 0 end as int) as urban_class
from {{px}} px join {{thr}} thr on px.city = thr.city and px.yr = thr.yr""",
    "dated": """
select o.*, e.yr from {obs} o join {epochs} e
  on acq_date >= make_date(cast(e.yr - 1 as bigint), 1, 1) and acq_date < make_date(cast(e.yr + 1 as bigint), 12, 31)""",
    "area": """
select city, yr, cast(sum(case when urban_class = 1 then 1 else 0 end) as bigint) as urban_pixels,
  cast(round(cast(sum(case when urban_class = 1 then 1 else 0 end) as decimal(18,0)) * 0.0009, 2) as double) as urban_area_km2
from {cls} group by city, yr""",
    "ext": "select city, yr, max(px_row) + 1 as h, max(px_col) + 1 as w from {px} group by city, yr",
    "cells": """
select city, yr, h, w, px_row, unnest(range(w)) as px_col
from (select city, yr, h, w, unnest(range(h)) as px_row from {ext}) t""",
}


def metrics_sql(cities: list[str] = c.CITIES, years: list[int] = c.YEARS) -> str:
    """The growth table over a grid of cities and years."""
    rows = ", ".join(f"('{k}', {i}, {y})" for i, k in enumerate(cities) for y in years)
    return f"""
select city, yr, city_rank, urban_area_km2,
  case when prev > 0 and urban_area_km2 is not null
    then cast(cast(urban_area_km2 as decimal(18,2)) - cast(prev as decimal(18,2)) as double) end as growth_km2,
  case when prev > 0 and urban_area_km2 is not null
    then cast(round(cast((urban_area_km2 - prev) / prev * 100 as decimal(24,6)), 1) as double) end as growth_pct,
  rn = 1 as is_baseline
from (select g.city, g.yr, g.city_rank, a.urban_area_km2,
    lag(a.urban_area_km2) over (partition by g.city order by g.yr) as prev,
    row_number() over (partition by g.city order by g.yr) as rn
  from (values {rows}) g(city, city_rank, yr) left join {{area}} a on a.city = g.city and a.yr = g.yr) t"""


GAP_CITIES = [*c.CITIES, "reno"]
GAP_YEARS = [1980, 1990, 2000, 2005, 2010, 2020]
SQL_VIEWS["metrics"] = metrics_sql()
SQL_VIEWS["gap_metrics"] = metrics_sql(GAP_CITIES, GAP_YEARS)

TABLES = "lineitem orders customer".split()
_NAME = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A fixture view as a DataFrame."""
    load = {n: partial(table, spark, sf, n) for n in TABLES}
    load |= {n: partial(view, spark, sf, n) for n in VIEWS if n != name}
    return spark.sql(VIEWS[name], **{n: load[n]() for n in set(_NAME.findall(VIEWS[name]))})


def sql(body: str) -> str:
    """A check query: the views it names, as common table expressions, and itself."""
    texts = {**VIEWS, **SQL_VIEWS}
    order: list[str] = []

    def visit(text: str) -> None:
        for n in _NAME.findall(text):
            if n in texts and n not in order:
                visit(texts[n])
                order.append(n)

    visit(body)
    plain = lambda t: _NAME.sub(r"\1", t)
    ctes = ",\n".join(f"{n} as ({plain(texts[n])})" for n in order)
    return (f"with {ctes}\n" if ctes else "") + plain(body)
