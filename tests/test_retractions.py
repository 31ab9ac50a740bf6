from txrisk.plans import jobs
from txrisk.plans.settings import Settings


def test_nothing_is_looked_up_where_changed_files_are_not_read_again(spark, monkeypatch):
    looked_up = []
    monkeypatch.setattr(jobs, "get_watermark", lambda *given: looked_up.append(given))
    gone, days = jobs._retracted(spark, Settings("/nowhere"), "silver")
    assert not looked_up and days == [] and gone.columns == ["source_file", "before"] and gone.isEmpty()
