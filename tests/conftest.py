from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfline.session import build_session  # noqa: E402

LISTING = (
    "product_id int, name string, price string, link string, image string, availability string, "
    "search_term string, scrape_time string, job_id int"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def five(spark):
    """The five listings of the integration fixture."""
    rows = [
        (1, "Product A", "$10.99", "In Stock", "books", "2024-01-01T10:00:00", 1),
        (2, "Product B", "$25.50", "Out of Stock", "books", "2024-01-01T11:00:00", 1),
        (3, "Product C", "$99.99", "In Stock", "electronics", "2024-01-01T12:00:00", 2),
        (4, "Product D", "$5.00", "In Stock", "electronics", "2024-01-01T13:00:00", 2),
        (5, "Product E", "$15.99", "In Stock", "books", "2024-01-02T10:00:00", 3),
    ]
    full = [
        (i, n, p, f"http://example.com/{i}", f"http://example.com/img{i}.jpg", a, s, t, j)
        for i, n, p, a, s, t, j in rows
    ]
    return spark.createDataFrame(full, LISTING)


@pytest.fixture(scope="session")
def mixed(spark):
    """The five listings of the unit fixture: a pound price, an empty row, one day."""
    rows = [
        (1, "Product A", "$10.99", "http://example.com/1", "In Stock", "books", "10"),
        (2, "Product B", "£25.50", "http://example.com/2", "Out of Stock", "books", "11"),
        (3, "", "", "", "In Stock", "electronics", "12"),
        (4, "Product D", "$99.99", "http://example.com/4", "", "electronics", "13"),
        (5, "Product E", "$5.00", "http://example.com/5", "In Stock", "books", "14"),
    ]
    full = [(i, n, p, k, None, a, s, f"2024-01-01T{h}:00:00", 1) for i, n, p, k, a, s, h in rows]
    return spark.createDataFrame(full, LISTING)


@pytest.fixture(scope="session")
def jobs(spark):
    rows = [
        (1, "books", "completed", "2024-01-01T09:00:00", "2024-01-01T09:30:00"),
        (2, "electronics", "completed", "2024-01-01T10:00:00", "2024-01-01T10:45:00"),
        (3, "books", "completed", "2024-01-02T09:00:00", "2024-01-02T09:25:00"),
    ]
    return spark.createDataFrame(
        rows, "job_id int, search_term string, status string, created_at string, completed_at string"
    )
