from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyport.roles import from_frames  # noqa: E402
from tallyport.schemas import BASE_TABLES  # noqa: E402
from tallyport.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cores=8, shuffle_partitions=4)
    yield session
    session.stop()


def ts(text: str | None):
    return datetime.fromisoformat(text) if text else None


# Two items of different sellers (o1), two reviews (o1), two payments (o2), one
# person with two customer ids (c1, c2), a shipped order (o4), a delivered order
# without delivery date (o5), a late (o2) and an exactly on-time delivery (o3), a
# category without translation (p2) and none at all (p3).
ORDERS = [
    ("o1", "c1", "delivered", "2017-01-05 10:00:00", "2017-01-15 09:00:00", "2017-01-20 00:00:00"),
    ("o2", "c2", "delivered", "2017-01-25 23:59:00", "2017-02-20 08:00:00", "2017-02-10 00:00:00"),
    ("o3", "c3", "delivered", "2017-02-02 00:00:00", "2017-02-22 00:00:00", "2017-02-22 00:00:00"),
    ("o4", "c1", "shipped", "2017-02-03 00:00:00", None, "2017-02-28 00:00:00"),
    ("o5", "c3", "delivered", "2017-03-01 12:00:00", None, "2017-03-20 00:00:00"),
]
ITEMS = [
    ("o1", 1, "p1", "s1", 100.10, 10.0), ("o1", 2, "p2", "s2", 50.05, 5.5), ("o2", 1, "p1", "s1", 100.10, 12.0),
    ("o3", 1, "p3", "s2", 20.0, 3.0), ("o4", 1, "p1", "s2", 99.0, 9.0), ("o5", 1, "p2", "s1", 50.05, 6.0),
]
PRODUCTS = [("p1", "beleza_saude", 500.0), ("p2", "coisas_raras", 1200.0), ("p3", None, 60000.0)]
CUSTOMERS = [("c1", "u1", 1000, "sao paulo", "SP"), ("c2", "u1", 1001, "sao paulo", "SP"), ("c3", "u3", 2000, "rio", "RJ")]
SELLERS = [("s1", 1000, "campinas", "SP"), ("s2", 3000, "maceio", "AL")]
PAYMENTS = [
    ("o1", 1, "credit_card", 3, 150.15), ("o2", 1, "voucher", 1, 50.0), ("o2", 2, "credit_card", 2, 50.10),
    ("o3", 1, "boleto", 1, 20.0), ("o5", 1, "credit_card", 13, 50.05),
]
REVIEWS = [
    ("r1", "o1", 5, "Bom", "Produto excelente, recomendo"), ("r2", "o1", 1, "", "entrega com atraso e muita demora"),
    ("r3", "o2", 2, None, "prazo ruim, transportadora atrasou"), ("r4", "o3", None, "", "sem nota"), ("r5", "o5", 4, "", ""),
]
GEO = [(1000, -23.0, -46.0, "sp", "SP"), (1001, -24.0, -47.0, "sp", "SP"), (2000, -22.0, -43.0, "rj", "RJ")]


@pytest.fixture(scope="session")
def tables(spark):
    rows = {
        "orders": [(i, c, s, ts(b), ts(b), ts(b), ts(d), ts(e)) for i, c, s, b, d, e in ORDERS],
        "order_items": [(o, n, p, s, ts("2017-01-10 00:00:00"), price, f) for o, n, p, s, price, f in ITEMS],
        "products": [(p, cat, 10.0, 20.0, 1.0, w, 10.0, 5.0, 2.0) for p, cat, w in PRODUCTS],
        "customers": CUSTOMERS,
        "sellers": SELLERS,
        "payments": PAYMENTS,
        "order_reviews": [(r, o, s, t, m, ts("2017-03-01 00:00:00"), ts("2017-03-03 00:00:00")) for r, o, s, t, m in REVIEWS],
        "geolocation": GEO,
        "product_category_name_translation": [("beleza_saude", "beauty_health")],
    }
    return {name: spark.createDataFrame(data, BASE_TABLES[name]) for name, data in rows.items()}


@pytest.fixture(scope="session")
def shop(tables):
    return from_frames(tables)


def rows_of(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=str)
