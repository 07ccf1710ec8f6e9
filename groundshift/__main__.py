"""``python -m groundshift <job> ...``, or the same through spark-submit."""

from __future__ import annotations

import argparse

from groundshift.config import CITIES, YEARS
from groundshift.operators.growth import decade_totals, growth_leaders, most_active_decade
from groundshift.operators.model import feature_importance
from groundshift.operators.stats import confusion
from groundshift.plans import jobs
from groundshift.plans.reports import REPORTS
from groundshift.session import build_session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="groundshift")
    sub = top.add_subparsers(dest="job", required=True)
    choices = {("report", "name"): REPORTS, ("describe", "name"): jobs.DESCRIPTIONS}
    for name, args in {
        "status": ["scenes"],
        "composites": ["obs", "out"],
        "training-set": ["composites", "candidates", "out"],
        "train": ["samples", "models"],
        "classify": ["composites", "models", "out"],
        "overlay": ["composites", "classified", "out"],
        "metrics": ["classified", "out"],
        "report": ["metrics", "name"],
        "describe": ["samples", "name"],
    }.items():
        job = sub.add_parser(name)
        for arg in args:
            job.add_argument(arg, choices=sorted(choices.get((name, arg), [])) or None)
        if name == "train":
            job.add_argument("--city")
        if name in ("status", "composites"):
            job.add_argument("--cities", nargs="+", choices=CITIES, default=CITIES)
            job.add_argument("--years", nargs="+", type=int, choices=YEARS, default=YEARS)
        if name == "composites":
            job.add_argument("--scenes", help="scene table, if the observations are at lon/lat")
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = build_session(f"groundshift {a.job}")
    if a.job == "status":
        jobs.composite_status(spark, a.scenes, a.cities, a.years).orderBy("city", "yr").show()
    elif a.job == "composites":
        jobs.composites(spark, a.obs, a.out, a.cities, a.years, a.scenes).orderBy("city", "yr").show()
    elif a.job == "training-set":
        jobs.training_set(spark, a.composites, a.candidates, a.out).groupBy("city", "year", "subclass").count().show()
    elif a.job == "train":
        done = jobs.train(spark, a.samples, a.models, a.city)
        done.metrics.show()
        for era, model in done.models.items():
            confusion(done.predictions.where(done.predictions.era == era)).orderBy("label", "prediction").show()
            feature_importance(model).show()
    elif a.job == "classify":
        jobs.classify(spark, a.composites, a.models, a.out).orderBy("city", "yr").show()
    elif a.job == "overlay":
        jobs.overlay(spark, a.composites, a.classified, a.out).groupBy("city", "yr").count().orderBy("city", "yr").show()
    elif a.job == "report":
        REPORTS[a.name](jobs.stored_metrics(spark, a.metrics)).show(200, truncate=False)
    elif a.job == "describe":
        jobs.DESCRIPTIONS[a.name](jobs.stored_samples(spark, a.samples)).show(500, truncate=False)
    else:
        table = jobs.metrics(spark, a.classified, a.out)
        table.orderBy("city", "yr").show()
        growth_leaders(table).show()
        decade_totals(table).orderBy("year_start").show()
        most_active_decade(table).show()


if __name__ == "__main__":
    main()
