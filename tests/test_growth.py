import pytest

from groundshift.operators import growth as g
from groundshift.operators.classify import class_counts, urban_area
from groundshift.plans import reports
from groundshift.plans.growth_report import growth_report

AREA = "city string, yr int, urban_area_km2 double"


def table(spark, areas):
    return spark.createDataFrame([(city, yr, a) for city, by in areas.items() for yr, a in by.items()], AREA)


def grown(spark, by_year):
    out = g.growth(table(spark, {"austin": by_year})).orderBy("yr").collect()
    return [(r.growth_km2, r.growth_pct) for r in out]


def test_growth_with_gaps(spark):
    assert grown(spark, {1990: 10.0, 2000: 15.0, 2010: 12.0, 2020: 12.0}) == [(None, None), (5.0, 50.0), (-3.0, -20.0), (0.0, 0.0)]
    assert grown(spark, {1990: None, 2000: 15.0, 2010: 18.0}) == [(None, None), (None, None), (3.0, 20.0)]
    assert grown(spark, {1990: 10.0, 2000: None, 2010: 18.0}) == [(None, None)] * 3
    assert grown(spark, {1990: 10.0, 2000: 11.0, 2010: None}) == [(None, None), (1.0, 10.0), (None, None)]
    assert grown(spark, {1990: 0.0, 2000: 11.0}) == [(None, None), (None, None)]


def test_changes_add_up(spark):
    got = grown(spark, {1990: 1.1, 2000: 2.35, 2010: 7.77, 2020: 9.01})
    assert sum(k for k, _ in got[1:]) == pytest.approx(9.01 - 1.1)


def test_ties_go_to_the_earlier_city(spark):
    m = table(spark, {c: {1990: 1.0, 2000: 2.0, 2010: 3.0, 2020: 4.0} for c in ("austin", "phoenix", "riverside")})
    assert {r.city for r in g.decade_leaders(m).collect()} == {"riverside"}
    assert [(r.kind, r.city) for r in g.growth_leaders(m).orderBy("kind").collect()] == [("fastest", "riverside"), ("largest", "riverside")]
    assert g.most_active_decade(m).first().year_start == 1990


def test_totals_skip_missing_endpoints(spark):
    m = table(spark, {"austin": {1990: 1.0, 2000: 3.5, 2010: None, 2020: 9.0}, "phoenix": {1990: None, 2000: 1.0, 2010: 1.0, 2020: None}})
    got = {r.year_start: r.growth_km2 for r in g.decade_totals(m).collect()}
    assert got == {1990: 2.5, 2000: 0.0, 2010: 0.0}


def test_nodata_never_counts(pixels):
    px = pixels({("austin", 1990): [[1, 0, 255], [255, 255, 1]], ("phoenix", 1990): [[255, 255]]})
    got = {r.city: r for r in class_counts(px).collect()}
    a = got["austin"]
    assert (a.urban_pixels, a.nonurban_pixels, a.nodata_pixels, a.total_pixels) == (2, 1, 3, 6)
    assert a.urban_pct_valid == pytest.approx(200 / 3) and a.nodata_pct == 50.0
    assert got["phoenix"].urban_pct_valid is None and got["phoenix"].nodata_pct == 100.0
    assert {r.city: r.urban_pixels for r in urban_area(px).collect()} == {"austin": 2, "phoenix": 0}


def test_report_has_a_row_per_city_and_year(pixels):
    out = growth_report(pixels({("austin", 1990): [[1] * 100], ("austin", 2000): [[1] * 200]}))
    rows = {(r.city, r.yr): r for r in out.collect()}
    assert len(rows) == 16
    assert rows["austin", 2000].growth_pct_display == "100.0%" and rows["austin", 1990].growth_pct_display == "—"
    assert rows["phoenix", 2020].urban_area_km2 is None


def test_reports_with_missing_endpoints(spark):
    m = g.growth(g.dense_grid(table(spark, {"austin": {1990: 2.0, 2020: 5.0}, "phoenix": {2020: 4.0}, "riverside": {1990: 0.0, 2020: 1.0}})))
    assert sorted((r.city, r.growth_pct) for r in reports.growth_summary(m).collect()) == [("austin", 150.0), ("riverside", 0.0)]
    cards = {r.city: r.status for r in reports.home_cards(m).collect()}
    assert cards == {"austin": "available", "phoenix": "unavailable", "las_vegas": "unavailable", "riverside": "available"}
    assert reports.slopegraph(m).first().axis_max == pytest.approx(5.6)
    assert reports.slopegraph(m.where("city = 'phoenix'")).isEmpty()
    heat = reports.heatmap_active(m, ["phoenix", "austin"]).orderBy("position").collect()
    assert [(r.city, r.y1990, r.y2020) for r in heat] == [("phoenix", None, 4.0), ("austin", 2.0, 5.0)]
    assert g.compare_cities(m, "austin", "las_vegas", 2020).isEmpty()
    assert g.compare_cities(m, "phoenix", "austin", 2020).first().abs_diff_km2 == 1.0


def test_two_areas_for_one_cell_are_an_error(spark):
    m = spark.createDataFrame([("austin", 1990, 1.0), ("austin", 1990, 2.0)], AREA)
    with pytest.raises(Exception, match="more than one area"):
        reports.heatmap_active(m).collect()


def test_bubbles_without_area(spark):
    out = reports.bubble_matrix(table(spark, {"austin": {1990: 0.0, 2000: None}})).orderBy("yr").collect()
    assert [r.bubble_size for r in out] == [120.0, None] and out[0].y == 0
