"""Filters: every operator over every kind of column and value, against plain Python; forms and mistakes."""

from __future__ import annotations

import datetime as dt
import itertools
import json
from enum import Enum

import pytest
from pyspark.sql import functions as S

from changelake.functions import jsoncols as J
from changelake.operators.query import query
from changelake.plans.filters import OPERATORS, And, Condition, F, FilterExpression, Or, all_of, field_paths, is_local
from changelake.plans.matching import apply_filter, previous_row_matches
from changelake.sources.catalog import Catalog, Registry, Relation

COLUMNS = {"s": ["", "ab", "b", "abc", None], "n": [0, 1, 2, -5, None], "b": [True, False, None], "a": [["ab", "b"], [], None]}
VALUES = ["ab", "b", "", 1, 2.0, True, False, None]


def holds(value, operator, operand):
    """The operators on a plain value: types must fit, and null matches nothing but null."""

    def equal(x, y):
        return x is y if x is None or y is None else isinstance(x, bool) == isinstance(y, bool) and type(x) in ((str,) if isinstance(y, str) else (int, float, bool)) and x == y

    if operator == "isnull":
        return (value is None) == operand
    if operator in ("eq", "ne"):
        return equal(value, operand) == (operator == "eq")
    if operator == "in":
        return any(equal(value, x) for x in operand)
    if operator == "notin":
        return value is not None and not any(equal(value, x) for x in operand)
    if isinstance(value, list):
        return operator == "contains" and any(equal(x, operand) for x in value)
    if operator in ("startswith", "endswith", "contains"):
        parts = {"startswith": str.startswith, "endswith": str.endswith, "contains": str.__contains__}
        return isinstance(value, str) and isinstance(operand, str) and parts[operator](value, operand)
    if value is None or isinstance(value, (bool, list)) or isinstance(value, str) != isinstance(operand, str):
        return False
    return {"gt": value > operand, "gte": value >= operand, "lt": value < operand, "lte": value <= operand}[operator]


def all_conditions(field):
    for operator, (name, value) in itertools.product(OPERATORS, enumerate(VALUES)):
        operand = [value, "abc", VALUES[name - 1]] if operator in ("in", "notin") else value
        try:
            yield Condition(field, operator, operand)
        except TypeError:
            continue


@pytest.fixture(scope="module")
def plain_rows(spark):
    rows = list(itertools.islice(itertools.product(*COLUMNS.values()), 0, None, 7))
    return rows, spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, s string, n long, b boolean, a array<string>")


@pytest.mark.parametrize("column", ["s", "n", "b"])
def test_operators_on_columns(plain_rows, column):
    rows, df = plain_rows
    cat = Catalog([Registry("core.r", "r", lambda: df)])
    nodes = list(all_conditions(column))
    at = list(COLUMNS).index(column)
    flags = None
    for node in nodes:
        found = apply_filter(cat, "r", df, node).select("id", S.lit(json.dumps(node.to_dict())).alias("node"))
        flags = found if flags is None else flags.union(found)
    got: dict = {}
    for r in flags.collect():
        got.setdefault(r["node"], set()).add(r["id"])
    assert len(nodes) > 40
    for node in nodes:
        want = {i for i, r in enumerate(rows) if holds(r[at], node.operator, node.value)}
        assert got.get(json.dumps(node.to_dict()), set()) == want, node


def test_arrays_are_searched(plain_rows):
    rows, df = plain_rows
    cat = Catalog([Registry("core.r", "r", lambda: df)])
    for value in ("ab", "zz", 1):
        got = {r["id"] for r in apply_filter(cat, "r", df, F("a").contains(value)).collect()}
        assert got == {i for i, r in enumerate(rows) if holds(r[3], "contains", value)}


def test_previous_rows(spark):
    """On a logged row, a field that is missing rejects it unless the group is decided before."""
    rows = [{"s": "ab", "n": 1}, {"s": None}, {"n": 2}, {"run_id": 5}, {}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "id int, data string")
    cases = [
        ((F("s") == "ab") | (F("n") == 2), {0}), ((F("n") == 2) | (F("s") == "ab"), {0, 2}), ((F("n") == 1) & (F("s") == "ab"), {0}),
        (F("s").not_in(["b"]) & F("s").is_in(["ab", None]), {0, 1}), (F("run") == 5, {3}),
    ]
    for node, want in cases:
        assert {r["id"] for r in df.where(previous_row_matches(node, J.parsed(S.col("data")))).collect()} == want, node
    with pytest.raises(ValueError):
        previous_row_matches(F("a", "b") == 1, S.col("data"))


class Level(Enum):
    LOW = "low"


def test_forms_go_there_and_back():
    leaves = [F("x") == 1, F("r", "x") != None, F("j")["k"]["l"] < 2.5, F("r").count() >= 3, F("x").is_in({2, 1})]  # noqa: E711
    for a, b, c in itertools.permutations(leaves, 3):
        for node in ((a & b) | c, (a | b) & c, a & b & c, all_of(a, None, b)):
            again = FilterExpression.from_dict(json.loads(json.dumps(node.to_dict())))
            assert again == node and again.to_dict() == node.to_dict() and field_paths(again) == field_paths(node)
    assert len((leaves[0] & leaves[1] & leaves[2]).members) == 3 and len((leaves[0] & (leaves[1] | leaves[2])).members) == 2
    assert (F("x") == Level.LOW).value == "low" and (F("x") >= dt.date(2031, 5, 4)).value == "2031-05-04"
    assert (F("x") == None).to_dict() == {"x": {"isnull": True}}  # noqa: E711
    assert all_of() is None and all_of(None, leaves[0]) is leaves[0]
    assert isinstance(leaves[0] & leaves[1], And) and isinstance(leaves[0] | leaves[1], Or)
    assert is_local(leaves[0]) and is_local(None) and not any(map(is_local, leaves[1:4]))


@pytest.mark.parametrize(
    "mistake",
    [
        lambda: F(), lambda: F(""), lambda: F("a..b"), lambda: F("a[b]"), lambda: F("a")['x"y'], lambda: F("a")[""], lambda: F(3),
        lambda: bool(F("a") == 1), lambda: not (F("a") == 1), lambda: ~(F("a") == 1), lambda: ~F("a"), lambda: F("a") & F("b"),
        lambda: 1 < F("a") < 3, lambda: F("a") == F("b"), lambda: F("a") > True, lambda: F("a") > [1], lambda: F("a").is_in("text"),
        lambda: F("a").is_in(4), lambda: F("a").startswith(4), lambda: F("a").op("isnull", "yes"), lambda: F("a").op("like", "x"),
        lambda: F("a").count() > 1.5, lambda: F("a").count() == None, lambda: F("a")["b"].count(), lambda: F("a") == float("nan"),  # noqa: E711
        lambda: And(), lambda: Or(), lambda: And({"a": {"eq": 1}}), lambda: (F("a") == 1) & {"a": {"eq": 1}}, lambda: all_of("x"),
        lambda: FilterExpression.from_dict([]), lambda: FilterExpression.from_dict({}), lambda: FilterExpression.from_dict({"and": []}),
        lambda: FilterExpression.from_dict({"a": 1}), lambda: FilterExpression.from_dict({"a": {"eq": 1, "ne": 2}}),
        lambda: F("a") == object(),
    ],
)
def test_mistakes_are_refused(mistake):
    with pytest.raises((TypeError, ValueError)):
        mistake()


@pytest.fixture(scope="module")
def shop(spark):
    """Shops of towns, goods of shops, and which shops lend to which."""
    towns = [(1, "Ulm"), (2, "Graz"), (3, None)]
    shops = [(i, [1, 2, 3, None][i % 4], json.dumps({"open": i, "tags": ["x"] * (i % 2)})) for i in range(12)]
    goods = [(100 + i, i % 5, f"g{i % 3}") for i in range(20)]
    lends = [(a, b) for a in range(12) for b in range(12) if (a * b) % 7 == 3]
    frames = {
        "town": spark.createDataFrame(towns, "id long, name string"), "shop": spark.createDataFrame(shops, "id long, town_id long, info string"),
        "good": spark.createDataFrame(goods, "id long, shop_id long, name string"), "lend": spark.createDataFrame(lends, "a long, b long"),
    }
    relations = {
        "shop": {"town": Relation("core.town", "town_id"), "goods": Relation("core.good", "shop_id", many=True),
                 "lends": Relation("core.shop", "a", link="lend", target_column="b")},
        "good": {"shop": Relation("core.shop", "shop_id")},
    }
    json_fields = {"shop": frozenset({"info"})}
    registries = [Registry(f"core.{n}", n, lambda n=n: frames[n], relations.get(n, {}), json_fields.get(n, frozenset())) for n in ("town", "shop", "good")]
    return Catalog(registries, links={"lend": lambda: frames["lend"]}), dict(towns), shops, goods, lends


def test_relations(shop):
    cat, towns, shops, goods, lends = shop
    town = {i: towns.get(t) for i, t, _ in shops}
    own = {i: [n for _, s, n in goods if s == i] for i, *_ in shops}
    to = {i: [b for a, b in lends if a == i] for i, *_ in shops}
    cases = [
        (F("town", "name") == "Ulm", lambda i: town[i] == "Ulm"), (F("town", "name") != "Ulm", lambda i: town[i] != "Ulm"),
        (F("town", "name").is_null(), lambda i: town[i] is None), (F("goods", "name") == "g1", lambda i: "g1" in own[i]),
        ((F("goods", "name") == "g1") & (F("goods", "name") == "g2"), lambda i: {"g1", "g2"} <= set(own[i])),
        ((F("goods", "name") == "g1") | (F("town", "name") == "Graz"), lambda i: "g1" in own[i] or town[i] == "Graz"),
        (F("goods").count() >= 4, lambda i: len(own[i]) >= 4), (F("goods").count() == 0, lambda i: not own[i]),
        (F("lends", "town", "name") == "Graz", lambda i: any(town[b] == "Graz" for b in to[i])),
        (F("lends").count() != 1, lambda i: len(to[i]) != 1), (F("lends", "goods").count() > 3, lambda i: sum(len(own[b]) for b in to[i]) > 3),
        (F("info")["open"] > 6, lambda i: i > 6), (F("info")["tags"].contains("x") | (F("info")["open"] == 2), lambda i: i % 2 or i == 2),
    ]
    for node, want in cases:
        got = sorted(r["id"] for r in apply_filter(cat, "shop", cat.load("shop"), node).collect())
        assert got == [i for i, *_ in shops if want(i)], node
    for bad in (F("town") == 1, F("nope") == 1, F("nope", "x") == 1, F("town", "nope") == 1):
        with pytest.raises(ValueError):
            query(cat, "shop", bad)


def test_arguments_of_queries(shop):
    cat, _, shops, goods, _ = shop
    assert query(cat, "shop").count() == len(shops)
    assert [r["id"] for r in query(cat, "shop", order_by="-id", offset=2, limit=3).collect()] == [9, 8, 7]
    assert query(cat, "shop", limit=0).count() == 0 and query(cat, "shop", include_foreign_keys=False).columns == ["id", "info"]
    rows = query(cat, "shop", F("id") < 7, select=["id", "goods(name)"]).collect()
    want = sorted((i, n) for i in range(7) for n in ([n for _, s, n in goods if s == i] or [""]))
    assert sorted((r["id"], r["goods"]["name"] if r["goods"] else "") for r in rows) == want
    for bad in ({"limit": -1}, {"offset": -1}, {"order_by": "nope"}, {"select": ["nope"]}, {"select": ["goods(name)", "lends(id)"]}):
        with pytest.raises(ValueError):
            query(cat, "shop", **bad)
