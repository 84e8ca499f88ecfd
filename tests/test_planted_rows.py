"""DQ-S3.bad plants its bad rows in the whole table."""

from pyspark.sql import functions as F

from cropflow.operators import dq
from cropflow.plans import catalog


def test_bad_rows_are_planted_in_the_whole_table(models, monkeypatch):
    tested = []
    real = dq.production_non_negative
    monkeypatch.setattr(dq, "production_non_negative", lambda t: tested.append(t) or real(t))
    found = catalog.DERIVED["DQ-S3.bad"](models)
    whole = models.fct_production
    assert tested[0].count() == whole.count()
    assert found.count() == whole.where("item_code % 3 = 0 AND production_tonnes > 0 AND has_production").count() > 0
    same = tested[0].where("item_code % 3 <> 0").agg(F.sum("production_tonnes")).first()
    assert same == whole.where("item_code % 3 <> 0").agg(F.sum("production_tonnes")).first()
