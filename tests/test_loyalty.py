"""Hand-worked expectations on a tiny restaurant fixture."""

import datetime as dt

import pytest

from bizlens.plans import loyalty
from tests.conftest import rows

D = dt.date


@pytest.fixture(scope="module")
def data(spark):
    menu = spark.createDataFrame([(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)],
                                 "product_id int, product_name string, price int")
    members = spark.createDataFrame([("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))], "customer_id string, join_date date")
    sales = spark.createDataFrame([
        ("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 7), 2), ("A", D(2021, 1, 10), 3),
        ("A", D(2021, 1, 11), 3),
        ("B", D(2021, 1, 1), 2), ("B", D(2021, 1, 2), 2), ("B", D(2021, 1, 4), 1), ("B", D(2021, 1, 11), 1),
        ("B", D(2021, 1, 16), 3),
        ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 1), 3),
    ], "customer_id string, order_date date, product_id int")
    return sales, menu, members


def test_spend_and_visits(data):
    sales, menu, _ = data
    assert rows(loyalty.spend_per_customer(sales, menu)) == [("A", 64), ("B", 62), ("C", 24)]
    assert rows(loyalty.visit_days(sales)) == [("A", 4), ("B", 5), ("C", 1)]


def test_first_top_favourite(data):
    sales, menu, _ = data
    assert rows(loyalty.first_item(sales, menu), "customer_id", "product_name") == [
        ("A", "sushi"), ("B", "curry"), ("C", "ramen")]
    assert rows(loyalty.top_item(sales, menu)) == [("ramen", 5)]
    assert rows(loyalty.favourite_item(sales, menu)) == [
        ("A", "curry", 2), ("A", "ramen", 2), ("B", "curry", 2), ("B", "sushi", 2), ("C", "ramen", 2)]


def test_membership_jobs(data):
    sales, menu, members = data
    assert rows(loyalty.first_item_as_member(sales, members, menu)) == [("A", "curry"), ("B", "sushi")]
    assert rows(loyalty.last_item_before_member(sales, members, menu)) == [
        ("A", "curry"), ("A", "sushi"), ("B", "sushi")]
    assert rows(loyalty.spend_before_member(sales, members, menu)) == [("A", 2, 25), ("B", 3, 40)]


def test_points(data):
    sales, menu, members = data
    assert rows(loyalty.points_by_item(sales, menu)) == [
        ("A", 1, 200), ("A", 2, 300), ("A", 3, 240), ("B", 1, 400), ("B", 2, 300), ("B", 3, 120), ("C", 3, 240)]
    assert rows(loyalty.points_by_item(sales, menu, by_item=False)) == [("A", 740), ("B", 820), ("C", 240)]
    got = loyalty.points_with_welcome_week(sales, members, menu, "2021-01-01", "2021-01-31")
    assert rows(got) == [("A", 1130), ("B", 820)]


def test_member_rank(data):
    sales, menu, members = data
    got = rows(loyalty.member_order_rank(sales, members, menu), "customer_id", "order_date", "member", "ranking")
    assert got == sorted([
        ("A", D(2021, 1, 1), "N", None), ("A", D(2021, 1, 1), "N", None), ("A", D(2021, 1, 7), "Y", 1),
        ("A", D(2021, 1, 10), "Y", 2), ("A", D(2021, 1, 11), "Y", 3),
        ("B", D(2021, 1, 1), "N", None), ("B", D(2021, 1, 2), "N", None), ("B", D(2021, 1, 4), "N", None),
        ("B", D(2021, 1, 11), "Y", 1), ("B", D(2021, 1, 16), "Y", 2),
    ], key=lambda t: tuple(map(str, t)))
    flags = loyalty.sales_with_member_flag(sales, members, menu)
    assert flags.count() == 12
    assert rows(flags.filter("customer_id = 'C'"), "member") == [("N",), ("N",)]
