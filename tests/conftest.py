from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallymart.session import make_session  # noqa: E402

# Sample inputs of FIXTURES.md, invented: four time formats, a blank row, a missing quantity, an order of
# two lines, a product and rates without sales.
SALES_CSV = """\
ORDER_ID,CUSTOMER_ID,PRODUCT_ID,QUANTITY,PRICE,ORDER_TIMESTAMP,COUNTRY
880,kim,B-7,6,1.5,2026-05-04 18:30:00,NO
881,kim,A-1,1,40,2026-05-04 18:31:00,NO
,,,,,,
882,lou,C-3,10,0.75,5/6/2026 0:05,NO
883,mo,A-1,2,40.5,2026/05/06 12:00:00,KE
884,mo,A-2,,12,5/6/2026 13:00,KE
885,lou,A-2,3,12,05/06/2026 23:59:59,NO
886,kim,C-3,4,0.75,5/7/2026 9:15,NO
886,kim,B-7,2,2,5/7/2026 9:15,NO
"""
PRODUCTS_CSV = """\
PRODUCT_ID,PRODUCT_NAME,CATEGORY
C-3,Seeds,Garden
A-1,Kettle,Kitchen
D-9,Chair,Office
B-7,Rope,Garden
A-2,Pan,Kitchen
"""
RATES_CSV = """\
DATE,COUNTRY,CURRENCY,EXCHANGE_RATE_TO_USD
5/7/2026,KE,KES,0.125
5/7/2026,NO,NOK,0.25
5/6/2026,NO,NOK,0.5
5/6/2026,KE,KES,0.125
5/4/2026,NO,NOK,0.25
5/8/2026,NO,NOK,0.3
"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = make_session(
        {
            "spark.master": "local[8,3]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
        "tallymart-tests",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sample(tmp_path):
    """Paths of the three sample files."""
    paths = {}
    for name, text in (("sales", SALES_CSV), ("products", PRODUCTS_CSV), ("rates", RATES_CSV)):
        paths[name] = str(tmp_path / f"{name}.csv")
        Path(paths[name]).write_text(text)
    return paths


def rows(df, *order):
    """Rows as plain tuples, sorted by the given columns (or all)."""
    return [tuple(row) for row in df.orderBy(*(order or df.columns)).collect()]
