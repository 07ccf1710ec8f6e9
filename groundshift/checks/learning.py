"""Forests: fit, evaluate, score, save."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from groundshift import config as c
from groundshift.checks.fixtures import view
from groundshift.checks.registry import query, r
from groundshift.checks.samples import SM, samples
from groundshift.operators import model as m
from groundshift.operators.classify import class_counts, classify_rasters, prepare_features
from groundshift.operators.sampling import union_all
from groundshift.plans.training import balanced_split, train_era, train_models
from groundshift.session import scratch_path


def complete(spark, sf):
    return samples(spark, sf).dropna(subset=c.FEATURES)


@query("select sample_id, " + ", ".join(f"round({f}, 9) + 0.0 as f{i}" for i, f in enumerate(c.FEATURES)) + f" from {SM} t where ndvi is not null")
def assemble(spark, sf):
    rows = m.assembler().transform(complete(spark, sf))
    array = rows.select("sample_id", vector_to_array("features").alias("v"))
    return array.select("sample_id", *[r(F.col("v")[i]).alias(f"f{i}") for i in range(len(c.FEATURES))])


_ERA = "case when yr = 2020 then '2020' else 'legacy' end"


@query(f"""select era, part, label, count(*) as n from (
  select *, case when md5('42:' || sample_id) < 'cccccccc' then 'train' else 'validation' end as part,
    row_number() over (partition by era, label order by md5('balance-42:' || sample_id)) as rn,
    least(sum(label) over (partition by era), sum(1 - label) over (partition by era)) as quota
  from (select *, {_ERA} as era from {SM} s where ndvi is not null) a) t where rn <= quota group by era, part, label""")
def era_split(spark, sf):
    """What each era's forest is fitted on and validated with."""
    rows = complete(spark, sf)
    parts = [balanced_split(rows, era).withColumn("era", F.lit(era)) for era in m.ERAS]
    return union_all(*parts).groupBy("era", "part", "label").agg(F.count("*").alias("n"))


_PARTS = f"""(select *, case when md5('42:' || sample_id) < 'cccccccc' then 'train' else 'validation' end as part from (
    select *, row_number() over (partition by era, label order by md5('balance-42:' || sample_id)) as rn,
      least(sum(label) over (partition by era), sum(1 - label) over (partition by era)) as quota
    from (select *, {_ERA} as era from {SM} s where ndvi is not null) a) b where rn <= quota)"""


def recomputed(preds):
    """The metrics from predictions once more, class by class instead of from one confusion count."""

    def share(a, b):
        return F.coalesce(F.try_divide(F.count_if(a & b).cast("double"), F.count_if(b).cast("double")), F.lit(0.0))

    parts, total = {"precision": [], "recall": [], "f1": []}, F.count("*").cast("double")
    for k in (0, 1):
        is_k, said_k = F.col("label") == k, F.col("prediction") == k
        p, rc, weight = share(is_k, said_k), share(said_k, is_k), F.count_if(is_k) / total
        parts["precision"].append(p * weight)
        parts["recall"].append(rc * weight)
        parts["f1"].append(F.coalesce(F.try_divide(p * rc * 2, p + rc), F.lit(0.0)) * weight)
    hits = F.count_if(F.col("label") == F.col("prediction")) / total
    return preds.groupBy("era").agg(
        F.count("*").alias("n_validated"),
        F.count_if(F.col("label") == 1).alias("n_urban"),
        hits.alias("accuracy_2"),
        *[(a + b).alias(f"{name}_2") for name, (a, b) in parts.items()],
    )


@query(f"""select era, count(*) as n_validated, cast(sum(label) as bigint) as n_urban, true as same_accuracy, true as same_f1,
  true as same_precision, true as same_recall, true as same_n from {_PARTS} t where part = 'validation' group by era""")
def rf_train_eval(spark, sf):
    """Both eras' validation rows, and whether every reported metric is that of the predictions."""
    done = train_models(complete(spark, sf))
    both = done.metrics.join(recomputed(done.predictions), "era")
    same = lambda a, b: F.abs(F.col(a) - F.col(b)) < 1e-9
    return both.select(
        "era",
        "n_validated",
        "n_urban",
        same("accuracy", "accuracy_2").alias("same_accuracy"),
        same("f1", "f1_2").alias("same_f1"),
        same("weighted_precision", "precision_2").alias("same_precision"),
        same("weighted_recall", "recall_2").alias("same_recall"),
        (F.col("n") == F.col("n_validated")).alias("same_n"),
    )


@query(f"""select era, cast({len(c.FEATURES)} as bigint) as n_features, true as sum_is_one, true as falls,
  count(*) as n_train from {_PARTS} t where part = 'train' group by era""")
def feature_importance(spark, sf):
    """Both eras' importances: a row per feature, falling, with sum 1."""
    rows = complete(spark, sf)
    models, parts = train_models(rows).models, []
    for era in m.ERAS:
        values = m.feature_importance(models[era])
        ranked = [r["importance"] for r in values.collect()]  # a row per feature
        falls = all(a >= b for a, b in zip(ranked, ranked[1:]))
        parts.append(values.select(F.lit(era).alias("era"), "feature", "importance", F.lit(falls).alias("falls"), F.lit(0).alias("n")))
        trained = balanced_split(rows, era).where("part = 'train'")
        none = [F.lit(None).cast(k).alias(n) for n, k in (("feature", "string"), ("importance", "double"), ("falls", "boolean"))]
        parts.append(trained.groupBy().agg(F.count("*").cast("int").alias("n")).select(F.lit(era).alias("era"), *none, "n"))
    return union_all(*parts).groupBy("era").agg(
        F.count("feature").alias("n_features"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sum_is_one"),
        F.bool_and("falls").alias("falls"),
        F.sum("n").alias("n_train"),
    )


def disagreeing(spark, sf):
    """One forest per era, the later one learned with the labels turned round, so that routing shows."""
    rows = complete(spark, sf)
    return {
        "legacy": train_era(rows, "legacy").models["legacy"],
        "2020": train_era(rows.withColumn("label", 1 - F.col("label")), "2020").models["2020"],
    }


_TOTALS = """select f.city, f.yr, count(*) as n_total, cast(sum(case when red is null then 1 else 0 end) as bigint) as n_nodata, true as adds_up{}
  from {{cells}} f left join {{px10k}} p on p.city = f.city and p.yr = f.yr and p.px_row = f.px_row and p.px_col = f.px_col group by f.city, f.yr"""


@query(_TOTALS.format(""))
def rf_score(spark, sf):
    models = train_models(complete(spark, sf)).models
    scored = classify_rasters(view(spark, sf, "px10k").drop("urban_prob"), lambda df: m.score_by_era(df, models))
    parts = F.col("urban_pixels") + F.col("nonurban_pixels") + F.col("nodata_pixels")
    return class_counts(scored).select(
        *c.RASTER,
        F.col("total_pixels").alias("n_total"),
        F.col("nodata_pixels").alias("n_nodata"),
        (parts == F.col("total_pixels")).alias("adds_up"),
    )


@query("""select city, yr, cast(sum(case when red is not null then 1 else 0 end) as bigint) as n_own, true as differ from {px10k} group by city, yr""")
def rf_routing(spark, sf):
    """Every valid pixel has the probability of its own era's forest, not of the other, which disagrees."""
    models = disagreeing(spark, sf)
    px = prepare_features(view(spark, sf, "px10k").drop("urban_prob"))
    routed = m.score_by_era(px, models)
    for era in m.ERAS:
        routed = m.score(routed.withColumnRenamed("urban_prob", "kept"), models[era]).withColumnsRenamed({"urban_prob": f"by_{era}", "kept": "urban_prob"})
    late = F.col("yr") == 2020
    own, other = F.when(late, F.col("by_2020")).otherwise(F.col("by_legacy")), F.when(late, F.col("by_legacy")).otherwise(F.col("by_2020"))
    return routed.where("valid").groupBy(*c.RASTER).agg(
        F.count_if(F.col("urban_prob") == own).alias("n_own"), (F.count_if(F.col("urban_prob") != other) > 0).alias("differ")
    )


@query("""select city, yr, count(*) as n_total, cast(sum(case when red is not null then 1 else 0 end) as bigint) as n_scored,
  cast(sum(case when red is null then 1 else 0 end) as bigint) as n_nodata from {px10k} group by city, yr""")
def rf_score_coverage(spark, sf):
    """Whatever the forests say, every valid pixel gets a probability and a class, and no other pixel does."""
    models = disagreeing(spark, sf)
    scored = classify_rasters(view(spark, sf, "px10k").drop("urban_prob"), lambda df: m.score_by_era(df, models))
    good = F.col("urban_class").isin(0, 1) & F.col("urban_prob").between(0, 1)
    return scored.groupBy(*c.RASTER).agg(
        F.count("*").alias("n_total"),
        F.count_if(good & F.col("valid")).alias("n_scored"),
        F.count_if((F.col("urban_class") == c.NODATA) & ~F.col("valid")).alias("n_nodata"),
    )


@query(f"select count(*) as n, cast(0 as bigint) as n_different from {SM} t where ndvi is not null")
def model_roundtrip(spark, sf):
    """A model read back must score every row as before."""
    rows = complete(spark, sf)
    model, path = m.train_rf(rows), scratch_path(spark, "model")
    m.save_model(model, path)
    before = m.score(rows, model).select("sample_id", F.col("urban_prob").alias("before"))
    after = m.score(rows, m.load_model(path)).select("sample_id", F.col("urban_prob").alias("after"))
    both = before.join(after, "sample_id")
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("before") != F.col("after")).alias("n_different"))
