import os
import sys
from datetime import date, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("panelyard-tests")
        .config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.codegen.wholeStage", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session


def d(text: str) -> date:
    return date.fromisoformat(text)


def weekdays(start: str, count: int) -> list[date]:
    out, day = [], d(start)
    while len(out) < count:
        if day.weekday() < 5:
            out.append(day)
        day += timedelta(days=1)
    return out
