import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from order_mart import schemas  # noqa: E402
from order_mart.config import build_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="order_mart-wh-")
    s = build_session("local[4]", "order_mart_tests", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": warehouse,
        "spark.driver.memory": "4g",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


@pytest.fixture
def make_sources(spark):
    """Build the four sources from inline rows (explicit schemas)."""
    def build(customers=(), products=(), details=(), items=()):
        return {
            "customer_master": spark.createDataFrame(list(customers), schemas.CUSTOMER_MASTER),
            "product_master": spark.createDataFrame(list(products), schemas.PRODUCT_MASTER),
            "order_details": spark.createDataFrame(list(details), schemas.ORDER_DETAILS),
            "order_items": spark.createDataFrame(list(items), schemas.ORDER_ITEMS),
        }
    return build


def cust(cid, name="n", pincode=500001, ts="2023-03-01 10:00:00"):
    return (cid, name, f"{cid} street", "Pune", "Maharashtra", pincode, T(ts))


def prod(pid, rate=10, active=True):
    return (pid, f"a{pid:02d}", f"Brand{pid} Oil", "1KG", rate, active)


def lifecycle_rows(oid, cid, t0="2023-05-01 00:00:00", steps=(60, 60),
                   statuses=("Received", "InProgress", "Delivered")):
    """Status rows starting at t0, each next step `steps[i]` seconds later."""
    out, t = [], T(t0)
    for i, st in enumerate(statuses):
        if i:
            t = t + dt.timedelta(seconds=steps[i - 1])
        out.append((oid, cid, t, st))
    return out
