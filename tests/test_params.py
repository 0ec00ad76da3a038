from datetime import date, datetime
from zoneinfo import ZoneInfo

import pytest

from memberlytics.params import RunParams, resolve_params


def test_date_gives_previous_month():
    assert resolve_params("2024-01-31") == RunParams(date(2024, 1, 31), "202312")
    assert resolve_params("2024-03-01").yyyymm == "202402"


@pytest.mark.parametrize("text", ["2024-1-5", "20240105", "2024/01/05", "2024-02-30", " 2024-01-05", "2024-01-05T00:00"])
def test_other_forms_are_errors(text):
    with pytest.raises(ValueError):
        resolve_params(text)


@pytest.mark.parametrize("text", [None, "", "  "])
def test_blank_means_today(text):
    assert resolve_params(text, today=date(2024, 5, 2)) == RunParams(date(2024, 5, 2), "202404")
    assert abs((resolve_params(text).as_of - datetime.now(ZoneInfo("Asia/Seoul")).date()).days) <= 1
