"""Literal dimensions (M09, M10): fixed tables, tested here rather than registered."""

from cropflow.operators import dims


def test_dim_year(spark):
    y = {r.year: r for r in dims.dim_year(spark).collect()}
    assert len(y) == 32 and min(y) == 1991 and max(y) == 2022
    assert y[1995].decade == "1990s" and y[2010].decade == "2010s"
    assert y[2000].period_label == "1991–2000" and y[2011].period_label == "2011–2022"
    assert y[2013].decade_window.startswith("Last 10") and y[2003].decade_window.startswith("Previous")
    assert y[1995].decade_window == "Earlier Period"
    assert y[2008].is_notable_event_year and y[2009].notable_event is None
    assert y[2010].is_in_fbs_period and not y[2009].is_in_fbs_period


def test_dim_element(spark):
    e = {(r.dataset_source, r.element_code): r for r in dims.dim_element(spark).collect()}
    assert len(e) == 14
    assert e[("fbs", 664)].is_primary_kpi and e[("fbs", 664)].measurement_type == "Per Capita"
    assert e[("production", 5417)].measurement_type == "Ratio"
    assert e[("trade", 5622)].measurement_type == "Value"
    assert e[("fbs", 5301)].measurement_type == "Volume"
    assert len({r.element_key for r in e.values()}) == 14
