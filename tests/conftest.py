from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallymart.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        "4g",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "shared"),
        spark__sql__shuffle__partitions="4",
    )
    yield session
    session.stop()


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df):
    """Rows as plain tuples in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.fixture(scope="session")
def tiny(spark):
    """Hand-made bronze rows that hold every awkward case at least once."""
    from tallymart.sources.adapters import Bronze

    o = "a" * 32
    orders = spark.createDataFrame(
        [
            ("o1 ", " c1", "delivered", ts("2018-01-01"), ts("2018-01-02"), ts("2018-01-03"), ts("2018-01-10T23:00:00"), ts("2018-01-10")),
            ("o2", "c1", "delivered", ts("2018-02-01"), ts("2018-01-31"), None, None, ts("2018-02-10")),
            ("o3", "c2", None, ts("2018-02-03"), None, None, None, None),
            ("o4", "c3", "lost", ts("2018-03-01"), ts("2018-03-05"), ts("2018-03-04"), ts("2018-03-03"), ts("2018-03-02T02:00:00")),
            ("o5", "c9", "shipped", ts("2018-03-01"), ts("2018-03-01"), ts("2018-03-02"), None, ts("2018-03-09")),
            (o, "c2", "delivered", ts("2018-04-01"), ts("2018-04-01"), ts("2018-04-02"), ts("2018-04-09T23:00:00"), ts("2018-04-11")),
            (None, None, "created", None, None, None, None, None),
            ("", "c4", "created", ts("2018-05-01"), None, None, None, None),
        ],
        """order_id string, customer_id string, order_status string,
        order_purchase_timestamp timestamp, order_approved_at timestamp,
        order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp,
        order_estimated_delivery_date timestamp""",
    )
    items = spark.createDataFrame(
        [
            ("o1", 1, "p1", "s1", ts("2018-01-05"), 10.0, 0.0),
            ("o1", 2, " p2", "s2", ts("2017-12-31"), 20.5, 1.25),
            ("o2", 1, "p9", "s1", None, -1.0, 2.0),
            ("o3", 1, None, "s9", ts("2018-02-04"), None, 3.0),
            ("o9", 1, "p1", None, ts("2018-01-01"), 5.0, -0.5),
            (None, None, "p1", "s1", ts("2018-01-01"), 5.0, 1.0),
            (o, 1, "p1", "s1", ts("2018-04-03"), 100.0, 10.0),
        ],
        """order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date timestamp, price double, freight_value double""",
    )
    customers = spark.createDataFrame(
        [
            ("c1", "u1", 999, " sao paulo ", "SP"),
            ("c2", "u1", 1000, "rio", "RJ"),
            ("c3", "u2", 99999, "", ""),
            ("c4", None, 100000, None, None),
            ("c5", "u3", None, "rio", "sp"),
            (" ", "", 5000, "rio", " RJ "),
            (None, "u4", 5000, "rio", "RJ"),
        ],
        """customer_id string, customer_unique_id string, customer_zip_code_prefix int,
        customer_city string, customer_state string""",
    )
    products = spark.createDataFrame(
        [
            ("p1", "toys", 5, 50, 1, 0, 1, 1, 1),
            (" p2 ", " ", 5, 50, 1, -1, 1, 1, 1),
            ("p3", None, None, None, None, None, None, None, None),
        ],
        """product_id string, product_category_name string, product_name_lenght int,
        product_description_lenght int, product_photos_qty int, product_weight_g int,
        product_length_cm int, product_height_cm int, product_width_cm int""",
    )
    sellers = spark.createDataFrame(
        [("s1", 1000, "rio", "RJ"), (" s2", 99, "", "xx"), ("", None, None, ""), (None, 100000, "a", None)],
        "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
    )
    payments = spark.createDataFrame(
        [
            ("o1", 1, "boleto", 1, 10.0),
            ("o1", 2, "pix", 0, -1.0),
            ("o9", 1, "", None, 0.0),
            (None, None, None, 3, None),
            ("", 1, "voucher", 1, 1.0),
            ("o1 ", 1, "boleto", 1, 10.0),
        ],
        """order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value double""",
    )
    reviews = spark.createDataFrame(
        [
            ("b" * 32, o, "5", "t", "m", "2018-01-18 00:00:00", "2018-01-19 10:00:00"),
            ("b" * 32, o, "4 ", None, None, "2018-01-18 00:00:00", "2018-01-17 10:00:00"),
            ("x", "c" * 32, "0", None, None, "2018-01-18", ""),
            (None, "not an id", "x", None, None, "2018-02-30 00:00:00", None),
            ("", None, None, None, None, None, "2018-01-18 00:00:00"),
            ("d" * 32, "o1", "3", None, None, "2018-01-18 00:00:00.5", "2018-01-18 00:00:00"),
        ],
        """review_id string, order_id string, review_score string, review_comment_title string,
        review_comment_message string, review_creation_date string,
        review_answer_timestamp string""",
    )
    return Bronze(orders, items, customers, products, sellers, payments, reviews)


@pytest.fixture(scope="session")
def tiny_silver(tiny):
    from tallymart.plans.silver import SilverPlan

    return SilverPlan(tiny)


@pytest.fixture(scope="session")
def tiny_gold(tiny_silver):
    from tallymart.plans.gold import GoldPlan

    return GoldPlan(tiny_silver)
