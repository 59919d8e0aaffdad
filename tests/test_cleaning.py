import json

import pytest
from pyspark.sql import functions as F

from telemill.functions import values as V
from telemill.operators import rules as R
from telemill.operators.averages import readings
from telemill.operators.clean import clean_messages, explode_ports, has_invalid_port, rule_lookup
from telemill.plans.query import device_value
from telemill.sources.messages import accepted, decode, quarantined, to_wire
from tests.helpers import RULE_TABLE, message, messages, rules, text


@pytest.fixture(scope="module")
def book(spark):
    return R.RuleBook.of(rules(spark, *RULE_TABLE))


LOOKUPS = [
    ("d1", 0, 4, 12.0, "MUL"), ("d1", 1, 30, 70.0, "SUB"), ("d1", 2, -1, 101.0, "SUB"),
    ("d2", 0, 8, 12.5, "DIV"), ("d2", 0, 0, None, "DIV"), ("d2", 1, 4, 0.25, "RVS"),
    ("d3", 0, 3, 7.25, "EXPR1"), ("d3", 1, 5, 5.0, "EXPR1"),
    ("d3", 2, 5, 5.0, None), ("d4", 0, 5, 5.0, None), ("d9", 0, 5, 5.0, None),
]


def lookup_messages(spark):
    return messages(spark, *[
        message([{"value": 1}] * pidx + [{"value": x}], id=did, dts=i, unusual=i)
        for i, (did, pidx, x, _, _) in enumerate(LOOKUPS)
    ])


def check_cleaned(frame):
    found = {(r.dtimestamp, r.pidx): (r.y, r.error) for r in explode_ports(
        frame.withColumn("errors", F.transform("values", lambda p: p["action_error"]))
    ).select("dtimestamp", "pidx", V.to_double(F.col("value")).alias("y"),
             F.get("errors", F.col("pidx")).alias("error")).collect()}
    for i, (did, pidx, x, y, _) in enumerate(LOOKUPS):
        assert found[i, pidx][0] == y, (did, pidx, x)
        assert found[i, pidx][1] == ("division_by_zero" if y is None else None)


def test_lookup_cases(spark, book):
    rows = rule_lookup(lookup_messages(spark), book).collect()
    ops = {(r.dtimestamp, r.pidx): r.rule and r.rule.op for r in rows}
    for i, (_, pidx, _, _, op) in enumerate(LOOKUPS):
        assert ops[i, pidx] == op


def test_cleaned_values(spark, book):
    check_cleaned(clean_messages(lookup_messages(spark), book))


def test_many_ports_and_formulas(spark):
    """More port rules than 4096 in a device, over 100 formulas, and messages that are alike."""
    wide = [(100 + p, "w", p, f"EXPR1:X+{p}", "MIN", 1) for p in range(4200)]
    book = R.RuleBook.of(rules(spark, *RULE_TABLE, *wide, (9, "w", -1, "NEG", None, 1)))
    twice = message([{"value": 1}] * 4201, id="w")
    found = clean_messages(messages(spark, twice, twice, message([], dts=99)), book).collect()
    assert sorted(len(r["values"]) for r in found) == [0, 4201, 4201]
    ports = explode_ports(clean_messages(messages(spark, twice), book)).select(
        "pidx", V.to_double(F.col("value")).alias("y")).collect()
    assert {r.pidx: r.y for r in ports} == {p: 1.0 + p for p in range(4200)} | {4200: -1.0}
    check_cleaned(clean_messages(lookup_messages(spark), book))


def test_the_book_is_a_snapshot(spark, tmp_path):
    table = str(tmp_path / "rules")
    rules(spark, (1, "d1", 0, "EXPR1:X+1", "MIN", 1)).write.parquet(table)
    feed = R.RuleFeed(lambda: spark.read.parquet(table))
    book = feed.current()
    assert feed.current() is book
    rules(spark, (1, "d1", 0, "EXPR1:X*10", "MIN", 1)).write.mode("overwrite").parquet(table)
    rows = messages(spark, message([{"value": 7}]))

    def value(book):
        port = F.get("values", F.lit(0))
        return clean_messages(rows, book).select(V.to_double(port["value"])).first()[0]

    assert value(book) == 8.0
    assert value(feed.current()) == 70.0


def test_failed_actions_keep_the_original(spark):
    book = R.RuleBook.of(rules(
        spark, (1, "d1", 0, "DIV:8", "MIN", 1), (2, "d1", 1, "EXPR1:5", "MIN", 1)))
    sent = message([{"value": 0, "valid": True, "z": 1}, {"value": "abc"}])
    rows = messages(spark, sent)
    wire = json.loads(to_wire(clean_messages(rows, book)).first().value)
    assert wire["values"] == [
        {"valid": True, "z": 1, "action_error": "division_by_zero", "original": 0},
        {"action_error": "not_a_number", "original": "abc"}]
    back = accepted(decode(to_wire(clean_messages(rows, book))))
    for port, valid in ((0, True), (1, False)):
        row = device_value(back, port).first()
        assert (row.value, row.valid) == (None, valid)
    assert device_value(back, 2).first().value == 0.0
    assert readings(rows, book).count() == 0


def test_cleaned_values_with_shuffled_rules(spark, monkeypatch):
    monkeypatch.setattr(R, "BROADCAST_BYTES", 0)
    book = R.RuleBook.of(rules(spark, *RULE_TABLE))
    assert not book.small
    check_cleaned(clean_messages(lookup_messages(spark), book))


def test_strict_ends_the_job(spark, book):
    rows = messages(spark, message([{"value": 0}], id="d2"))
    with pytest.raises(Exception, match="division_by_zero"):
        clean_messages(rows, book, strict=True).collect()


def test_untouched_values_keep_type_and_extra_keys(spark, book):
    sent = message([{"value": "007", "valid": True, "z": [1]}, {"value": None}, {"value": True}, {}],
                   id="d9", site={"a": 1}, desc="é")
    back = json.loads(to_wire(clean_messages(messages(spark, sent), book)).first().value)
    assert back == sent
    plain = message([{"value": 4, "valid": True}, {"value": None}], id="d1")
    wire = json.loads(to_wire(clean_messages(messages(spark, plain), book)).first().value)
    assert wire["values"] == [{"value": 12.0, "valid": True}, {"value": None}]


def test_ports_beyond_portnum_pass_through(spark, book):
    rows = messages(spark, message([{"value": 4}, {"value": 30}], portnum=1, id="d1"))
    values = clean_messages(rows, book).select(
        F.transform("values", lambda p: V.to_double(p["value"]))).first()[0]
    assert values == [12.0, 30.0]


def test_rules_by_app_and_device(spark):
    two = rules(spark, (1, "d1", 0, "ADD:1", "MIN", 1)).unionByName(
        rules(spark, (2, "d1", 0, "ADD:2", "MIN", 1)).withColumn("app", F.lit("app2")))
    rows = messages(spark, message([{"value": 1}]), message([{"value": 1}], app="app2"),
                    message([{"value": 1}], app="app3"))

    def values(key):
        cleaned = clean_messages(rows, R.RuleBook.of(two, key))
        return sorted(cleaned.select("app", V.to_double(F.get("values", F.lit(0))["value"])).collect())

    assert values(("did",)) == [("app1", 3.0), ("app2", 3.0), ("app3", 3.0)]
    assert values(("app", "did")) == [("app1", 2.0), ("app2", 3.0), ("app3", 1.0)]
    looked_up = rule_lookup(rows, R.RuleBook.of(two, ("app", "did")))
    assert sorted((r.app, r.rule and r.rule.arg) for r in looked_up.collect()) == [
        ("app1", 1.0), ("app2", 2.0), ("app3", None)]


def test_invalid_messages(spark):
    rows = messages(spark, message([{"valid": True}, {}, {"valid": False}], portnum=2, dts=1),
                    message([{"valid": False}, {"valid": True}], dts=2), message([], dts=3))
    flags = rows.select("dtimestamp", has_invalid_port(F.col("values"), F.col("portnum"))).collect()
    assert sorted(tuple(r) for r in flags) == [(1, False), (2, True), (3, False)]


GOOD = message([{"value": 1}])
REJECTED = [
    ("{bad", "not_json"), ("[1]", "not_json"), ("", "not_json"), ("null", "not_json"),
    *[(json.dumps({k: v for k, v in GOOD.items() if k != key}), f"missing_{key}") for key in GOOD],
    (json.dumps({**GOOD, "portnum": 2}), "portnum_exceeds_values"),
    (json.dumps({**GOOD, "portnum": "2"}), "portnum_exceeds_values"),
    (json.dumps({**GOOD, "portnum": "x"}), "missing_portnum"),
    (json.dumps({**GOOD, "values": [5]}), "port_not_object"),
    (json.dumps({**GOOD, "values": [None]}), "port_not_object"),
    (json.dumps({**GOOD, "values": {"a": 1}}), "missing_values"),
    (json.dumps({**GOOD, "app": None}), "missing_app"),
]
TAKEN = [
    GOOD, {**GOOD, "portnum": "1"}, {**GOOD, "portnum": 1.0}, {**GOOD, "id": 7}, {**GOOD, "portnum": -3},
    {**GOOD, "values": [{"value": 1}, 5]}, {**GOOD, "values": [{"value": 1, "valid": "false"}]},
]


def test_quarantine(spark):
    decoded = decode(text(spark, *[t for t, _ in REJECTED], *TAKEN))
    bad = {r.raw: r.reject for r in quarantined(decoded).collect()}
    assert bad == dict(REJECTED)
    assert accepted(decoded).count() == len(TAKEN)


def test_odd_messages_come_through_whole(spark):
    sent = {**GOOD, "portnum": "1", "values": [{"value": 1, "q": 2}, 5], "site": 3}
    back = json.loads(to_wire(accepted(decode(text(spark, sent)))).first().value)
    assert back == {**sent, "portnum": 1}


def test_lookup_with_shuffled_rules(spark, monkeypatch):
    monkeypatch.setattr(R, "BROADCAST_BYTES", 0)
    book = R.RuleBook.of(rules(spark, *RULE_TABLE))
    rows = rule_lookup(lookup_messages(spark), book).collect()
    assert len(rows) == sum(pidx + 1 for _, pidx, _, _, _ in LOOKUPS)
    ops = {(r.dtimestamp, r.pidx): r.rule and r.rule.op for r in rows}
    for i, (_, pidx, _, _, op) in enumerate(LOOKUPS):
        assert ops[i, pidx] == op
    check_cleaned(clean_messages(lookup_messages(spark), book))
