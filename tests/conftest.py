from __future__ import annotations

import json
import sys
import tempfile
from decimal import ROUND_HALF_UP, Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="lumbung-tests-")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/spark-warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


REGION_CODES = ["1100", "1200", "1300", "1400"]
REGION_NAMES = {
    "1100": "NORTH HILLS", "1200": "EAST BAY", "1300": "SOUTH PLAIN", "1400": "WEST ISLE",
}

# Invented values by region: 12 observations.
YEARLY = {
    "2020": ["40.25", "310.50", "88.75", "6.50"],
    "2021": ["44.00", "305.25", "91.50", "6.50"],
    "2022": ["47.75", "322.00", "90.25", "8.00"],
}


def growth(current, previous) -> Decimal:
    """Percentage change, rounded half away from zero to two places."""
    change = (Decimal(current) - Decimal(previous)) * 100 / Decimal(previous)
    return change.quantize(Decimal("0.01"), ROUND_HALF_UP)


def national_trend() -> list[tuple]:
    """(year, national total, growth) of the values above."""
    totals = {int(year): sum(map(Decimal, values)) for year, values in YEARLY.items()}
    return [
        (year, total, growth(total, totals[year - 1]) if year - 1 in totals else None)
        for year, total in totals.items()
    ]


def regional_growth(year: str) -> dict[str, Decimal]:
    """Growth by region name over the year before."""
    before = YEARLY[str(int(year) - 1)]
    return {
        REGION_NAMES[code]: growth(now, then)
        for code, now, then in zip(REGION_CODES, YEARLY[year], before)
    }


def wide_response(**changes) -> str:
    body = {
        "status": "200",
        "variable": [{"id": "145", "label": "Output", "description": "Constant prices"}],
        "vervar": [],
        "infotabel": {
            "tabel": {
                "id": "77", "kode": "T-7", "nama": "Output by region",
                "subjek": "Economy", "satuan": "Million credits", "periode": "Yearly",
            }
        },
        "datacontent": [[year, *values] for year, values in YEARLY.items()],
    }
    return json.dumps({**body, **changes}, indent=2)


def responses(spark, *bodies: str):
    rows = [(f"doc{i}", body) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "doc string, body string")


def rows(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
