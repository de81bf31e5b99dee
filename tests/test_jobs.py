import json
from datetime import date

import pytest
from conftest import at, rows

from tidemark import jobs, schemas
from tidemark.operators.quality import DataQualityError
from tidemark.sources.lake import Lake, MissingInput


def test_run_day_from_the_interval():
    args = jobs.parse(["combine", "--lake", "/x", "--start", "2026-10-07T23:30:00-02:00"])
    assert args.day == date(2026, 10, 8)
    assert jobs.parse(["combine", "--lake", "/x", "--start", "2026-10-07"]).day == date(2026, 10, 7)


@pytest.mark.parametrize("argv", [
    ["combine", "--lake", "/x"], ["nothing", "--lake", "/x", "--start", "2026-10-07"],
    ["format-entities", "--lake", "/x", "--start", "2026-10-07"], ["drain-edits", "--lake", "/x", "--start", "2026-10-07"],
])
def test_incomplete_calls_are_refused(argv):
    with pytest.raises(SystemExit):
        jobs.parse(argv)


def test_drain_then_gate(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    stamp = at("2026-10-07 10:00").timestamp()
    (tmp_path / "topic" / "1.txt").write_text(json.dumps({"timestamp": stamp, "project": "fr.wikipedia.org", "title": "A", "rev_id": 1}))
    call = ["--lake", str(tmp_path / "lake"), "--input", str(tmp_path / "topic")]
    jobs.main(["drain-edits", *call, "--start", "2026-10-07"], spark)
    with pytest.raises(MissingInput):
        jobs.main(["drain-edits", *call, "--start", "2026-10-08"], spark)
    with pytest.raises(DataQualityError, match="daily_edits"):
        jobs.main(["format-edits", *call, "--start", "2026-10-07"], spark)
    assert not Lake(str(tmp_path / "lake")).has_day(spark, "formatted", "Edits", "20261007")


def test_tsv_job(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("2026-10-07 01:00:00\tfr.wikipedia\tA\t3\n")
    lake = str(tmp_path / "lake")
    jobs.main(["format-hourly-tsv", "--lake", lake, "--start", "2026-10-07", "--input", str(tmp_path / "h.tsv")], spark)
    hourly = Lake(lake).days(spark, "formatted", "PageviewsHourly", ["20261007"], schemas.HOURLY_VIEWS)
    assert rows(hourly, "views") == [(3,)]
