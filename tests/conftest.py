from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import local_session  # noqa: E402
from clicktide import schemas  # noqa: E402

# Time, name, user, session, channel, order, amount, country. Copies, tied times,
# missing users, names, sessions and orders, unreadable and negative amounts.
CHANNELS = {"-": ("", "", ""), "r": ("radar", "paid", "spring"), "p": ("post", "owned", "")}
CLICKS = [
    ("2021-03-03 08:00:00", "first_visit", "ana", "a-7", "-", "", "0", "Peru"),
    ("2021-03-03 08:00:00", "page_view", "ana", "a-7", "-", "", "0", "Peru"),
    ("2021-03-03 08:05:00", "view_item", "ana", "a-7", "-", "", "", "Peru"),
    ("2021-03-03 08:06:00", "add_to_cart", "ana", "a-7", "-", "", "", "Peru"),
    ("2021-03-03 08:09:00", "begin_checkout", "ana", "a-7", "-", "", "", "Peru"),
    ("2021-03-03 08:12:00", "purchase", "ana", "a-7", "-", "o-11", "30.25", "Peru"),
    ("2021-03-03 08:12:00", "purchase", "ana", "a-7", "-", "o-11", "30.25", "Chile"),
    ("2021-03-03 21:00:00", "page_view", "bo", "b-1", "r", "", "0", "Mali"),
    ("2021-03-04 00:10:00", "view_item", "bo", "b-1", "r", "", "0", "Mali"),
    ("2021-03-04 09:00:00", "purchase", "cy", "c-2", "p", "", "12,5", ""),
    ("2021-03-04 09:00:00", "page_view", "cy", "c-2", "p", "", "", ""),
    ("2021-03-04 10:00:00", "page_view", "", "x-1", "p", "", "", "Mali"),
    ("2021-03-04 11:00:00", "", "di", "d-1", "p", "", "", "Mali"),
    ("2021-03-12 07:30:00", "page_view", "ana", "a-8", "r", "", "", "Peru"),
    ("2021-03-12 07:32:00", "purchase", "ana", "a-8", "r", "o-12", "-5", "Peru"),
    ("2021-03-12 18:00:00", "purchase", "bo", "b-2", "r", "o-13", "8.4", "Mali"),
    ("2021-03-12 18:00:00", "purchase", "bo", "b-3", "r", "o-13", "8.4", "Mali"),
    ("2021-03-20 12:00:00", "page_view", "ed", "", "-", "", "", "Oman"),
    ("2021-03-20 12:30:00", "first_visit", "fay", "f-1", "p", "", "", "Oman"),
    ("2021-03-20 12:31:00", "page_view", "fay", "f-1", "p", "", "", "Oman"),
]
# Time, user, order, id, name, brand, category, price, quantity, revenue.
BASKETS = [
    ("2021-03-03 08:12:00", "ana", "o-11", "k7", "Kettle", "Brum", "Kitchen", "15.25", "1", "15.25"),
    ("2021-03-03 08:12:00", "ana", "o-11", "k9", "Cup", "Brum", "Kitchen", "7.5", "2", "15.0"),
    ("2021-03-12 07:32:00", "ana", "o-12", "k9", "Cup", "Brum", "Kitchen", "7.5", "1", "-7.5"),
    ("2021-03-12 18:00:00", "bo", "o-13", "", "", "", "", "n/a", "two", "8.4"),
]


def event_rows() -> list[dict]:
    rows = []
    for at, name, user, session, channel, order, amount, country in CLICKS:
        source, medium, campaign = CHANNELS[channel]
        values = (at[:10], at, name, user, session, source, medium, campaign, "/shop", order, amount, "1", "phone", country)
        rows.append(dict(zip(schemas.EVENTS_CSV.names, values, strict=False)))
    return rows


def write_csv(path: Path, rows: list[dict]) -> None:
    lines = [",".join(rows[0])]
    lines += [",".join("" if v is None else f'"{v}"' if "," in str(v) else str(v) for v in row.values()) for row in rows]
    path.write_text("\n".join(lines) + "\n")


def item_rows() -> list[dict]:
    names = schemas.ITEMS.fieldNames()
    return [dict(zip(names, (row[0][:10], row[0], "purchase", *row[1:]), strict=True)) for row in BASKETS]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(8, 8)


@pytest.fixture(scope="session")
def fixture_csv(tmp_path_factory) -> str:
    folder = tmp_path_factory.mktemp("fixture")
    write_csv(folder / "events_fixture.csv", event_rows())
    write_csv(folder / "items_fixture.csv", item_rows())
    return str(folder / "events_fixture.csv")


def event(**changes) -> dict:
    """A plain cleansed event, with the given fields changed."""
    row = {
        "event_date": date(2020, 11, 2),
        "event_timestamp": datetime(2020, 11, 2, 8),
        "event_name": "page_view",
        "user_pseudo_id": "u",
        "session_id": "u-1",
        "source": "search",
        "medium": "organic",
        "campaign": "(not set)",
        "transaction_id": None,
        "purchase_revenue": 0.0,
        "device_category": "desktop",
        "country": "X",
    }
    return {**row, **changes}


def events_of(spark, rows: list[dict]):
    names = schemas.EVENTS.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schemas.EVENTS)


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def as_set(df) -> set[tuple]:
    return {tuple(r) for r in df.collect()}
