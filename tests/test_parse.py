"""Parse rules: one literal line per rule (malformed, missing, null, types)."""

import json
import math

from conftest import records
from wagerflow.operators import flatten as fl
from wagerflow.operators import parse as P


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("offset").collect()]


def test_key_presence_rules(spark):
    lines = ["not json", "[1]", '{"x":1}', '{"game":null}', '{"game":"football"}',
             '"game"', '{"game":5}', '{"game":"a","game":"b"}']
    got = _rows(P.parse_bet(records(spark, lines)), "game", "n")
    assert got == [("invalid", 0), ("invalid", 0), ("invalid", 0), (None, 1),
                   ("football", 1), ("invalid", 0), ("5", 1), ("b", 1)]


def test_status_and_user_rules(spark):
    lines = ['{"status":"win"}', '{"status":null}', '{}', 'oops', '{"user_id":"invalid"}']
    assert _rows(P.parse_status(records(spark, lines)), "status", "n") == [
        ("win", 1), (None, 1), ("invalid", 0), ("invalid", 0), ("invalid", 0)]
    assert _rows(P.parse_user(records(spark, lines)), "user_id", "n")[4] == ("invalid", 1)


def test_amount_reads_like_float(spark):
    lines = ['{"amount":12.5}', '{"amount":"12.5"}', '{"amount":" 7 "}', '{"amount":"nan"}',
             '{"amount":true}', '{}', '{"amount":null}', '{"amount":"abc"}', "[", '{"amount":1e400}']
    got = _rows(P.parse_amount(records(spark, lines)), "n", "amount")
    assert got[:3] == [(1, 12.5), (1, 12.5), (1, 7.0)]
    assert got[3][0] == 1 and math.isnan(got[3][1])
    assert got[4] == (1, 1.0)
    assert got[5:9] == [(0, 0.0)] * 4
    assert got[9] == (1, float("inf"))


def test_event_time_fallback(spark):
    lines = ['{"game":"a","timestamp":"2024-01-01T00:00:30"}', '{"game":"a"}',
             '{"game":"a","timestamp":"yesterday"}',
             '{"game":"a","timestamp":"2024-01-01T03:00:30+03:00"}',
             '{"game":"a","timestamp":"2024-01-01T00:00:30Z"}']
    df = P.parse_bet(records(spark, lines, start="2024-01-01 00:10:00"))
    ts = [r[0].strftime("%H:%M:%S") for r in _rows(df, "event_time")]
    assert ts == ["00:00:30", "00:10:01", "00:10:02", "00:00:30", "00:00:30"]


def _event(**over):
    e = {"bet_id": "6F9619FF-8B86-D011-B42D-00CF4FC964FF",
         "user": {"user_id": "00000000-0000-0000-0000-000000000001", "country": "KZ",
                  "age": 30, "device": "mobile", "ip_address": "192.168.0.1"},
         "event": {"sport": "football", "league": "NBA", "match": "A vs B",
                   "start_time": "2024-01-01T10:00:00", "selection": "A wins", "odds": 2.345},
         "bet": {"amount": 10, "currency": "USD", "status": "win", "payout": 23.45,
                 "timestamp": "2024-01-01T00:00:00Z"},
         "metadata": {"source": "web", "session_id": "{00000000000000000000000000000002}",
                      "created_at": "2024-01-01T03:00:00+03:00"}}
    for path, v in over.items():
        node = e
        *parents, leaf = path.split(".")
        for p in parents:
            node = node[p]
        if v is KeyError:
            node.pop(leaf)
        else:
            node[leaf] = v
    return json.dumps(e)


def test_flatten_valid_row_is_typed(spark):
    valid, bad = fl.flatten_bets(records(spark, [_event()]))
    assert bad.count() == 0
    r = valid.first()
    assert r.bet_id == "6f9619ff-8b86-d011-b42d-00cf4fc964ff"
    assert r.session_id == "00000000-0000-0000-0000-000000000002"
    assert str(r.odds) == "2.35" and str(r.amount) == "10.00" and str(r.payout) == "23.45"
    assert r.bet_timestamp == r.created_at
    assert r.exported is False and r.age == 30


def test_flatten_rejections(spark):
    cases = {
        "not json": ["malformed_json"],
        "[1]": ["not_object"],
        _event(bet_id=KeyError): ["missing:bet_id"],
        _event(bet_id="abc"): ["bad_uuid:bet_id"],
        _event(**{"user.user_id": None}): ["bad_uuid:user.user_id"],
        _event(**{"event.odds": 12345.67}): ["bad_decimal:odds"],
        _event(**{"bet.amount": None}): ["bad_decimal:amount"],
        _event(**{"bet.amount": "nan"}): ["bad_decimal:amount"],
        _event(**{"bet.amount": True}): ["bad_decimal:amount"],
        _event(**{"user.country": "ABCDEF"}): ["too_long:country"],
        _event(**{"bet.timestamp": "yesterday"}): ["bad_timestamp:bet.timestamp"],
        _event(user="x"): ["not_object:user"],
        _event(metadata=KeyError): ["missing:metadata"],
    }
    ann = fl.annotate_bets(records(spark, list(cases)))
    got = [r.reasons for r in ann.orderBy("offset").collect()]
    assert got == list(cases.values())


def test_flatten_defaults(spark):
    line = _event(**{"bet.amount": KeyError, "event.odds": KeyError, "bet.payout": KeyError,
                     "user.age": None, "user.country": KeyError, "bet.amount2": 1})
    valid, bad = fl.flatten_bets(records(spark, [line, _event(**{"bet.amount": "12.5"})]))
    assert bad.count() == 0
    rows = valid.orderBy("src_offset").collect()
    assert (str(rows[0].amount), str(rows[0].odds), str(rows[0].payout)) == ("0.00", "0.00", "0.00")
    assert rows[0].age is None and rows[0].country is None
    assert str(rows[1].amount) == "12.50"


def test_top_games_rows(spark):
    lines = ['{"event":{"sport":"tennis","league":"ATP"},"bet":{"amount":5}}', '{"x":1}',
             '{"event":{"sport":null}}', '{"bet":{"amount":null}}', '[1]', "not json",
             '{"event":"str"}']
    rows, bad = fl.flatten_top_games(records(spark, lines))
    got = [(r.sport, r.league, None if r.total_amount is None else str(r.total_amount))
           for r in rows.collect()]
    assert sorted(got, key=str) == sorted([("tennis", "ATP", "5.00"), ("unknown", None, "0.00"),
                                           ("unknown", None, None)], key=str)
    assert sorted(r.reasons[0] for r in bad.collect()) == [
        "malformed_json", "not_object", "not_object:event", "null:event.sport"]


def test_legacy_rows(spark):
    ok = {"bet_id": "00000000-0000-0000-0000-000000000001",
          "user_id": "00000000-0000-0000-0000-000000000002", "game": "g", "amount": "3.456",
          "status": "win"}
    lines = [json.dumps(ok), json.dumps({**ok, "game": None}), json.dumps({**ok, "amount": True})]
    valid, bad = fl.flatten_legacy_bets(records(spark, lines))
    v = valid.collect()
    assert len(v) == 1 and str(v[0].amount) == "3.46" and v[0].timestamp is not None
    assert sorted(r.reasons[0] for r in bad.collect()) == ["invalid:amount", "invalid:game"]
