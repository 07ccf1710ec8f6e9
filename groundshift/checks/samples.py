"""Training samples: drawing, cleaning, balancing, describing."""

from __future__ import annotations

import math

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import functions as F

from groundshift import config as c
from groundshift.checks.fixtures import view
from groundshift.checks.registry import query, r, rs, sql_rs
from groundshift.functions.radiometry import normalized_difference
from groundshift.operators import sampling as s, stats
from groundshift.session import scratch_path
from groundshift.sources.tables import SAMPLE_COLUMNS, read_samples_csv, read_samples_tolerant, write_csv

ND = "case when nir >= 0 and red >= 0 then (nir - red) / nullif(nir + red, 0) end"
SM = f"(select *, {ND} as ndvi from {{sm}})"
QUOTA = "case subclass when 'urban' then 300 else 100 end"
SEED = "case subclass when 'urban' then 1 when 'vegetation' then 2 when 'farmland' then 3 when 'bare_soil' then 4 else 5 end"


def samples(spark, sf):
    return view(spark, sf, "sm").withColumn("ndvi", normalized_difference(F.col("nir"), F.col("red")))


def as_csv(df):
    return df.withColumnRenamed("yr", "year")


@query(f"select red, green, blue, nir, round(ndvi, 9) + 0.0 as ndvi, label, city, yr, subclass from {SM} t")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "samples")
    write_csv(as_csv(samples(spark, sf)), path, SAMPLE_COLUMNS)
    back = read_samples_csv(spark, path).withColumnRenamed("year", "yr")
    return back.withColumn("ndvi", r("ndvi"))


def cut_off(spark, whole, out):
    """A copy of the one gzip file of a folder without its last bytes."""
    found = spark.read.format("binaryFile").load(whole).select("content").first()  # 100 lines
    files, folder = FileSystem.from_uri(out) if ":/" in out else (LocalFileSystem(), out)
    files.create_dir(folder, recursive=True)
    with files.open_output_stream(f"{folder}/cut.csv.gz", compression=None) as to:
        to.write(bytes(found["content"])[:-12])


@query(f"select yr, subclass, red, green, blue, nir, round(ndvi, 9) + 0.0 as ndvi from {SM} t")
def tolerant_csv(spark, sf):
    """Only the sound files count: others lack a column, have ragged rows, or are cut off."""
    good, packed, short, ragged, whole, cut = (scratch_path(spark, n) for n in ("good", "packed", "short", "ragged", "whole", "cut"))
    table = as_csv(samples(spark, sf))
    write_csv(table.where("yr < 2010"), good, SAMPLE_COLUMNS)
    table.where("yr >= 2010").select(*SAMPLE_COLUMNS[::-1]).write.option("header", True).option("compression", "gzip").csv(packed)
    write_csv(table, short, [n for n in SAMPLE_COLUMNS if n != "ndvi"])
    lines = table.select(F.concat_ws(",", *SAMPLE_COLUMNS).alias("value"))
    head = spark.range(1).select(F.lit(",".join(SAMPLE_COLUMNS)).alias("value"))
    lines = head.union(lines.limit(100)).coalesce(1)
    lines.union(head.select(F.concat("value", F.lit(",more")))).coalesce(1).write.text(ragged)
    lines.write.option("compression", "gzip").text(whole)
    cut_off(spark, whole, cut)
    back = read_samples_tolerant(spark, [good, packed, short, ragged, cut]).withColumnRenamed("year", "yr")
    return s.normalise_samples(back, c.FEATURES).withColumn("ndvi", r("ndvi"))


_CAST = "try_cast(red as double) as red, try_cast(label as double) as label"
_CLEAN = f"""(select distinct sample_id, 'riverside' as city, yr, subclass, label, red, green, blue, nir from (
  select sample_id, yr, subclass, {_CAST}, green, blue, nir from {{sm_raw}}) t where red is not null and label in (0, 1))"""


@query(f"select * from {_CLEAN} t")
def clean_samples(spark, sf):
    return s.clean_samples(view(spark, sf, "sm_raw"), city="riverside", features=c.BANDS)


@query("select sample_id, city, yr, lower(trim(subclass)) as subclass, label, try_cast(red as double) as red, green, blue, nir from {sm_raw}")
def normalise_samples(spark, sf):
    return s.normalise_samples(view(spark, sf, "sm_raw"), c.BANDS)


_PICK = f"""(select * from (select *, row_number() over (partition by city, yr, subclass
    order by md5(({SEED}) || ':' || point_id), point_id) as rn from {{cand}}) t where rn <= {QUOTA})"""


@query(f"select point_id, city, yr, px_row, px_col, subclass, case when subclass = 'urban' then 1 else 0 end as label from {_PICK} p")
def training_points(spark, sf):
    return s.sample_n_per_class(view(spark, sf, "cand"))


@query(f"""select point_id, {sql_rs(['red', 'green', 'blue', 'nir', 'ndvi'])}, case when subclass = 'urban' then 1 else 0 end as label,
  city, yr, subclass from (select p.point_id, p.city, p.yr, p.subclass, x.red, x.green, x.blue, x.nir, {ND.replace('nir', 'x.nir').replace('red', 'x.red')} as ndvi
  from {_PICK} p join {{px}} x on p.city = x.city and p.yr = x.yr and p.px_row = x.px_row and p.px_col = x.px_col) t
  where red is not null and green is not null and blue is not null and nir is not null and ndvi is not null""")
def training_set(spark, sf):
    out = s.build_training_set(view(spark, sf, "px"), view(spark, sf, "cand"))
    return out.withColumns({f: r(f) for f in c.FEATURES})


@query("""select point_id, p.city, p.yr, p.px_row, p.px_col, label, subclass, red, green, blue, nir from {pts} p
  join {px} x on p.city = x.city and p.yr = x.yr and p.px_row = x.px_row and p.px_col = x.px_col
  where red is not null and green is not null and blue is not null and nir is not null""")
def sample_regions(spark, sf):
    return s.sample_points(view(spark, sf, "px").select(*c.PIXEL, *c.BANDS), view(spark, sf, "pts"))


@query("""select city, yr, round(x0 - 5000 / 111319.49e0 / cos(radians((y0 + y1) / 2)), 6) as lon_min, round(y0 - 5000 / 111319.49e0, 6) as lat_min,
  round(x1 + 5000 / 111319.49e0 / cos(radians((y0 + y1) / 2)), 6) as lon_max, round(y1 + 5000 / 111319.49e0, 6) as lat_max
  from (select city, yr, min(lon) as x0, min(lat) as y0, max(lon) as x1, max(lat) as y1 from {geo} group by city, yr) t""")
def training_extent(spark, sf):
    out = s.training_extent(view(spark, sf, "geo"))
    return out.select("city", "yr", *rs(["lon_min", "lat_min", "lon_max", "lat_max"], 6))


@query("""select sample_id, label from (select *, row_number() over (partition by label order by md5('balance-42:' || sample_id)) as rn from {sm}) t
  where rn <= (select min(n) from (select count(*) as n from {sm} group by label) k)""")
def balance_exact(spark, sf):
    return s.balance_downsample(view(spark, sf, "sm")).select("sample_id", "label")


@query("""select count(*) as n_smaller, true as near_equal, true as each_once, true as all_given from {sm}
  where label = (select label from {sm} group by label order by count(*), label limit 1)""")
def balance_bernoulli(spark, sf):
    """The smaller class whole; of the larger as many, give or take six deviations of the draw; no row twice or made up."""
    sm = view(spark, sf, "sm").select("sample_id", "label")
    small = sm.groupBy("label").agg(F.count("*").alias("n")).orderBy("n", "label").first()
    drawn = s.balance_downsample(sm, exact=False)
    rows = drawn.groupBy("sample_id", "label").agg(F.count("*").alias("times")).join(sm.withColumn("given", F.lit(1)), ["sample_id", "label"], "left")
    per = rows.groupBy("label").agg(F.sum("times").alias("n_drawn"), F.max("times").alias("most"), F.count("given").alias("n_given"))
    kept = F.when(F.col("label") == small["label"], F.col("n_drawn"))
    off = F.when(F.col("label") != small["label"], F.abs(F.col("n_drawn") - small["n"]))
    return per.agg(
        F.max(kept).alias("n_smaller"),
        (F.max(off) <= 6 * math.sqrt(small["n"]) + 1).alias("near_equal"),
        (F.max("most") == 1).alias("each_once"),
        F.bool_and(F.col("n_given") == F.col("n_drawn")).alias("all_given"),
    )


@query("select sample_id, case when md5('42:' || sample_id) < 'cccccccc' then 'train' else 'validation' end as part from {sm}")
def hash_split(spark, sf):
    return s.hash_split(view(spark, sf, "sm")).select("sample_id", "part")


@query("select count(*) as n_rows, cast(0 as bigint) as n_lost, cast(0 as bigint) as n_twice from {sm}")
def random_split(spark, sf):
    """The two parts must cover the input without overlap, whatever the draw."""
    sm = view(spark, sf, "sm").select("sample_id")
    train, validation = s.random_split(sm)
    hits = sm.join(s.union_all(train, validation).groupBy("sample_id").agg(F.count("*").alias("n")), "sample_id", "left")
    return hits.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("n").isNull()).alias("n_lost"), F.count_if(F.col("n") > 1).alias("n_twice")
    )


@query("select sample_id, yr, label from {sm} where yr < 2020 union all select sample_id, yr, label from {sm} union all select sample_id, yr, label from {sm}")
def union_samples(spark, sf):
    sm = view(spark, sf, "sm")
    legacy = sm.where("yr < 2020").select("sample_id", "yr", "label")
    return s.union_all(legacy, sm.select("label", "yr", "sample_id"), sm.select("yr", "label", "sample_id"))


@query("""select 'label' as property, cast(label as varchar) as value, count(*) as n from {sm} group by label
  union all select 'subclass', subclass, count(*) from {sm} group by subclass""")
def histogram_label_subclass(spark, sf):
    return stats.histogram(view(spark, sf, "sm"), ["label", "subclass"])


@query("select subclass as value, count(*) as n from {sm} group by subclass")
def histogram_map(spark, sf):
    return stats.histogram_map(view(spark, sf, "sm"), "subclass").select(F.explode("histogram").alias("value", "n"))


@query("select city, yr, label, count(*) as n from {sm} group by city, yr, label")
def label_distribution(spark, sf):
    return stats.label_distribution(view(spark, sf, "sm"))


@query(f"select city, yr, " + ", ".join(
    f"round(avg({f}), 6) + 0.0 as {f}_mean, round(case when count({f}) > 1 then stddev_samp({f}) end, 6) as {f}_std, "
    f"round(min({f}), 9) + 0.0 as {f}_min, round(max({f}), 9) + 0.0 as {f}_max" for f in c.FEATURES) + f" from {SM} t group by city, yr")
def feature_stats(spark, sf):
    out = stats.feature_stats(samples(spark, sf))
    return out.select("city", "yr", *[x for f in c.FEATURES for x in (*rs([f"{f}_mean", f"{f}_std"], 6), *rs([f"{f}_min", f"{f}_max"]))])


@query("""select 'all' as part, count(*) as n from {sm} union all select 'legacy', count(*) from {sm} where yr < 2020
  union all select '2020', count(*) from {sm} where yr = 2020""")
def row_counts(spark, sf):
    era = F.when(F.col("yr") == 2020, "2020").otherwise("legacy")
    return view(spark, sf, "sm").select(F.explode(F.array(F.lit("all"), era)).alias("part")).groupBy("part").agg(F.count("*").alias("n"))


@query("select distinct subclass from {sm}")
def subclass_list(spark, sf):
    return stats.subclasses(view(spark, sf, "sm"))


@query("select subclass, cast(row_number() over (order by case subclass when 'water' then 0 when 'urban' then 1 else 2 end, subclass) as int) as position from (select distinct subclass from {sm}) t")
def subclass_order(spark, sf):
    return stats.ordered_subclasses(view(spark, sf, "sm"), ["water", "snow", "urban"])


@query("select sample_id, city, yr, subclass, label, red, nir from {sm} order by sample_id limit 5")
def preview(spark, sf):
    return stats.preview(view(spark, sf, "sm"), 5, ["sample_id"]).select("sample_id", "city", "yr", "subclass", "label", "red", "nir")


_MEANS = "(select subclass, yr, " + ", ".join(f"round(avg({f}), 6) + 0.0 as {f}" for f in c.FEATURES) + f" from {SM} s group by subclass, yr)"


@query(f"select * from {_MEANS} t")
def subclass_year_means(spark, sf):
    return stats.subclass_year_means(samples(spark, sf)).select("subclass", "yr", *rs(c.FEATURES, 6))


@query(f"select * from {_MEANS} t where subclass = 'urban' and yr = 2010")
def subclass_slice(spark, sf):
    one = stats.subclass_slice(samples(spark, sf), "urban", 2010)
    return stats.subclass_year_means(one).select("subclass", "yr", *rs(c.FEATURES, 6))


@query(f"""select g.subclass, g.yr, red, green, blue, nir, ndvi from (select distinct subclass, y.yr from {{sm}}
  cross join (values (1985), (1990), (2000), (2010), (2020)) y(yr)) g left join {_MEANS} m on m.subclass = g.subclass and m.yr = g.yr""")
def spectral_fingerprint(spark, sf):
    years = [1985, *c.YEARS]
    return stats.spectral_fingerprint(samples(spark, sf), years=years).select("subclass", "yr", *rs(c.FEATURES, 6))


_CORR = " union all ".join(
    f"select subclass, '{a}' as feature_a, '{b}' as feature_b, round(case when min({a}) = max({a}) or min({b}) = max({b}) then null else corr({a}, {b}) end, 6) + 0.0 as corr from {SM} t group by subclass"
    for a in c.FEATURES for b in c.FEATURES
)


@query(_CORR)
def correlation_matrix(spark, sf):
    return stats.correlation_matrix(samples(spark, sf)).withColumn("corr", r("corr", 6))


@query(f"""select subclass, point, round(x, 6) + 0.0 as x, round(sum(exp(-0.5 * ((x - v) / h) * ((x - v) / h))) / (n * h * sqrt(2 * pi())), 6) as density,
  n, round(mean, 6) + 0.0 as mean from (
    select s.subclass, point, lo + (hi - lo) * point / 99.0e0 as x, v, h, n, mean
    from (select subclass, count(*) as n, min(ndvi) as lo, max(ndvi) as hi, avg(ndvi) as mean,
        stddev_samp(ndvi) * pow(count(*), -0.2e0) as h from {SM} a where ndvi is not null group by subclass) s
      cross join (select cast(unnest(range(100)) as int) as point) p
      join (select subclass, ndvi as v from {SM} b where ndvi is not null) d on d.subclass = s.subclass) t
  group by subclass, point, x, h, n, mean""")
def kde_by_subclass(spark, sf):
    out = stats.grouped_kde(samples(spark, sf), "subclass", "ndvi")
    return out.select("subclass", "point", r("x", 6).alias("x"), r("density", 6).alias("density"), "n", r("mean", 6).alias("mean"))


@query("select label, prediction, count(*) as n from {preds} group by label, prediction")
def confusion_matrix(spark, sf):
    return stats.confusion(view(spark, sf, "preds"))


@query("""select cast(sum(support) as bigint) as n, round(sum(tp) / sum(support), 9) as accuracy,
  round(sum(case when p + r > 0 then 2 * p * r / (p + r) else 0 end * support) / sum(support), 9) as f1,
  round(sum(p * support) / sum(support), 9) as weighted_precision, round(sum(r * support) / sum(support), 9) as weighted_recall
  from (select l.label, support, tp, coalesce(tp / nullif(guessed, 0), 0.0e0) as p, tp / support as r
    from (select label, cast(count(*) as double) as support, cast(sum(case when label = prediction then 1 else 0 end) as double) as tp from {preds} group by label) l
    left join (select prediction, cast(count(*) as double) as guessed from {preds} group by prediction) g on g.prediction = l.label) t""")
def classification_metrics(spark, sf):
    out = stats.classification_metrics(view(spark, sf, "preds"))
    return out.select("n", *rs(["accuracy", "f1", "weighted_precision", "weighted_recall"]))


@query("select subclass, red, nir from {sm}")
def pixel_cloud(spark, sf):
    return stats.pixel_cloud(view(spark, sf, "sm"))


@query("""select subclass, cast(floor(red / 0.02e0) as bigint) as red_bin, cast(floor(nir / 0.02e0) as bigint) as nir_bin, count(*) as n
  from {sm} group by all""")
def pixel_cloud_bins(spark, sf):
    return stats.pixel_cloud_bins(view(spark, sf, "sm"))
