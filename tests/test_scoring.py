import pytest
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, FEATURES
from orderlens.functions import risk
from orderlens.operators import queue
from orderlens.sources.landing import parse_order_json, rejected_order_json


def risk_of(table, p):
    return table("p double", (p,)).select(risk.risk_to_action(F.col("p")).alias("r")).select("r.*").first().asDict()


def bodies(table, *texts):
    return table("value string", *[(t,) for t in texts])


def features(table, text):
    return queue.feature_defaults(parse_order_json(bodies(table, text)))


def test_thresholds():
    assert DEFAULTS.risk_high == pytest.approx(0.20)
    assert DEFAULTS.risk_medium == pytest.approx(0.10)
    assert DEFAULTS.risk_medium < DEFAULTS.risk_high


@pytest.mark.parametrize(
    "p, level",
    [(0.0, "low"), (0.0999, "low"), (0.10, "medium"), (0.1999, "medium"), (0.20, "high"), (0.85, "high"), (1.0, "high")],
)
def test_level_of_probability(table, p, level):
    assert risk_of(table, p)["level"] == level


def test_advice_is_complete(table):
    for p in (0.05, 0.15, 0.5):
        advice = risk_of(table, p)
        assert set(advice) == {"level", "label", "color", "action"}
        assert advice["action"]


def test_bounds_belong_to_the_upper_level(table):
    assert risk_of(table, DEFAULTS.risk_medium)["level"] == "medium"
    assert risk_of(table, DEFAULTS.risk_high)["level"] == "high"


def test_level_comes_from_the_raw_probability(table):
    got = queue.describe_risk(table("order_id string, probability double", ("a", 0.19996))).first()
    assert (got.risk_proba, got.risk_pct, got.risk.level) == (0.2, 20.0, "medium")


def test_feature_order_and_one_row(table):
    df = features(table, '{"order_id": "a"}')
    assert tuple(df.columns) == ("order_id", *FEATURES)
    assert df.count() == 1


def test_feature_defaults(table):
    got = features(table, '{"orders": [{}]}').first().asDict()
    assert got == {
        "order_id": "unknown", "nb_items": 1, "nb_sellers": 1, "total_price": 0.0, "total_freight": 0.0,
        "cross_state_delivery": 0, "purchase_weekday": 1, "purchase_hour": 12, "estimated_weight_kg": 1.0,
        "max_installments": 1,
    }


@pytest.mark.parametrize("given, number", [("true", 1), ("false", 0)])
def test_boolean_becomes_number(table, given, number):
    assert features(table, f'{{"cross_state_delivery": {given}}}').first().cross_state_delivery == number


def test_given_values_pass_through(table):
    got = features(
        table,
        '{"nb_items": 3, "total_price": 250.0, "purchase_hour": 22, "estimated_weight_kg": 4.5, "max_installments": 6}',
    ).first()
    assert (got.nb_items, got.total_price, got.purchase_hour) == (3, 250.0, 22)
    assert (got.estimated_weight_kg, got.max_installments) == (4.5, 6)


def test_unknown_fields_are_dropped(table):
    assert "surprise" not in features(table, '{"surprise": 42, "nb_items": 2}').columns


def test_missing_columns_take_defaults(table):
    got = queue.feature_defaults(table("order_id string, nb_items int", ("a", None))).first()
    assert (got.nb_items, got.purchase_hour) == (1, 12)


def test_json_forms(table):
    raw = bodies(
        table,
        '{"orders": [{"order_id": "a", "nb_items": 2}, {"order_id": "b"}]}',
        '{"order_id": "c", "total_price": 1.5}',
        '{"orders": []}',
        '{"orders": [null]}',
        "{}",
        " { } ",
        "",
        "not json",
        '{"order_id": "d", "nb_items": "many"}',
        None,
    )
    assert sorted(r.order_id for r in parse_order_json(raw).collect()) == ["a", "b", "c"]
    assert rejected_order_json(raw).count() == 8


def test_short_id(table):
    got = table("order_id string", ("0123456789abcdef",), ("short",)).select(risk.short_id())
    assert [r[0] for r in got.collect()] == ["0123456789", "short"]


@pytest.mark.parametrize("pct, color", [(19.9, "warning"), (20.0, "danger"), (10.0, "warning"), (9.9, "success")])
def test_badge(table, pct, color):
    assert table("p double", (pct,)).select(risk.risk_badge(F.col("p")).alias("b")).first().b.color == color


def test_level_counts(table):
    scored = table("probability double", (0.05,), (0.1,), (0.2,), (0.9,))
    assert tuple(queue.risk_level_counts(scored).first()) == (4, 2, 1, 1)
    assert tuple(queue.risk_level_counts(scored.limit(0)).first()) == (0, 0, 0, 0)


def test_scores_of_unknown_orders_show_a_dash(table):
    scores = table("order_id string, risk_pct double", ("a", 20.0), ("b", 5.0))
    known = table("order_id string, state string, total_price double", ("a", "SP", 9.5))
    got = {r.order_id: (r.state, r.total_price) for r in queue.scores_to_orders(scores, known).collect()}
    assert got == {"a": ("SP", 9.5), "b": ("—", 0.0)}


def test_queue_is_riskiest_first(table):
    scored = table("order_id string, risk_pct double", *[(str(i), float(i % 10)) for i in range(40)])
    got = [r.risk_pct for r in queue.priority_queue(scored).collect()]
    assert len(got) == 15 and got == sorted(got, reverse=True)


ORDERS = "order_id string, order_purchase_timestamp timestamp"


def test_recent_orders_need_items(table):
    orders = table(ORDERS, *[(str(i), f"2018-01-{i:02d} 00:00:00") for i in range(1, 21)])
    items = table("order_id string", *[(str(i),) for i in range(1, 18)] * 2)
    got = queue.recent_orders(orders, items, DEFAULTS.but(recent_orders=3)).collect()
    assert sorted(r.order_id for r in got) == ["15", "16", "17"]


def test_recent_orders_without_items_are_passed_over(table):
    """The newest orders have no items: older ones fill the list."""
    orders = table(ORDERS, *[(str(i), f"2018-01-{i:02d} 00:00:00") for i in range(1, 21)])
    items = table("order_id string", ("1",), ("2",), ("3",), ("19",))
    got = queue.recent_orders(orders, items, DEFAULTS.but(recent_orders=3)).collect()
    assert [r.order_id for r in got] == ["19", "3", "2"]


def test_payload_of_chosen_orders_equals_payload_of_all(inputs):
    from orderlens.registry.inputs import SETTINGS
    from orderlens.session import staged

    latest = staged(queue.recent_orders(inputs["orders"], inputs["order_items"], SETTINGS))
    some = queue.payloads(latest, inputs.tables, SETTINGS, chosen=True)
    everything = queue.payloads(inputs["orders"], inputs.tables, SETTINGS)
    both = everything.join(latest.select("order_id"), "order_id", "left_semi").select(*some.columns)
    assert sorted(map(repr, some.collect())) == sorted(map(repr, both.collect()))
    assert some.count() == 40


@pytest.mark.parametrize(
    "risk_, value, urgency, best",
    [(0.0, 1.0, 0.5, 0), (0.2, 0.5, 0.5, 1), (0.9, 1.0, 0.5, 2), (0.16, 0.1, 0.1, 2), (0.15, 0.1, 0.1, 0), (0.16, 0.1, 0.2, 0)],
)
def test_priority(table, risk_, value, urgency, best):
    states = table("order_id string, risk double, value double, urgency double", ("a", risk_, value, urgency))
    got = queue.priority_policy(states).first()
    rewards = [risk_ * r * value * 2 - c for r, c in ((0, 0), (0.3, 0.05), (0.7, 0.15))]
    rewards[2] += 0.3 if urgency < 0.2 and risk_ > 0.15 else 0
    assert got.priority == best
    assert got.best_reward == pytest.approx(max(rewards))
