"""The coercion rules, one case per kind of value."""

import json

import pytest

from vidstrata.operators import normalize as n

BASE = {"_id": "a", "object": {"id": 1}}
EPOCH_ISO = "1970-01-01T00:00:00"


def with_top(**top):
    return json.dumps({**BASE, **top})


def run(spark, lines, dialect="daily"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    rows = n.normalize(df, dialect).orderBy("i").collect()
    return [(row["reason"], row["document"].asDict(True)) for row in rows]


def check_field(spark, cases, name, dialect="daily"):
    """Cases: JSON value text or None for absent -> expected value, or REFUSED."""
    lines = []
    for form, _ in cases:
        body = '"id": 1' + ("" if form is None else f', "{name}": {form}')
        lines.append(f'{{"_id": "a", "object": {{{body}}}}}')
    for (form, want), (reason, document) in zip(cases, run(spark, lines, dialect)):
        if want == REFUSED:
            assert reason == name, form
        else:
            assert reason is None, (form, reason)
            assert document["object"][name] == want, form


REFUSED = object()

TEXT_CASES = [
    (None, ""), ("null", "None"), ('""', ""), ('"x"', "x"), ("12", "12"), ("true", "True"),
    ("false", "False"), ('"true"', "true"), ('"null"', "null"), ('"a\\"b\\\\ \\u00e9\\n"', 'a"b\\ é\n'),
    ('"[]"', "[]"),
]
NUMBER_CASES = [
    (None, 0), ("null", 0), ('""', 0), ("false", 0), ("[]", 0), ("{}", 0), ("0.0", 0), ("12", 12),
    ('"12"', 12), ('" 12 "', 12), ("-3.9", -3), ("3.9", 3), ("1e3", 1000), ("true", 1),
    ('"12.7"', REFUSED), ('"x"', REFUSED), ("[1]", REFUSED), ('{"a": 1}', REFUSED),
    ('"false"', REFUSED), ("1e40", REFUSED), ("99999999999999999999", REFUSED),
]
TRUTH_CASES = [
    (None, False), ("null", False), ('""', False), ("0", False), ("0.0", False), ("false", False),
    ("[]", False), ("{}", False), ("true", True), ('"false"', True), ('"0"', True), ("2", True),
    ("[0]", True),
]


@pytest.mark.parametrize("dialect", n.DIALECTS)
def test_text(spark, dialect):
    check_field(spark, TEXT_CASES, "title", dialect)


def test_tags_differ_between_dialects(spark):
    check_field(spark, [(None, ""), ("null", "None"), ('""', ""), ('"a,b"', "a,b")], "tags")
    extended = [(None, "None"), ("null", "None"), ('""', "None"), ("0", "None"), ('"a,b"', "a,b")]
    check_field(spark, extended, "tags", "extended")


@pytest.mark.parametrize("dialect", n.DIALECTS)
def test_numbers(spark, dialect):
    check_field(spark, NUMBER_CASES, "visit_count", dialect)


def test_small_numbers_refuse_what_does_not_fit(spark):
    check_field(spark, [("2147483647", 2147483647), ("2147483648", REFUSED)], "duration")


@pytest.mark.parametrize("dialect", n.DIALECTS)
def test_truth(spark, dialect):
    check_field(spark, TRUTH_CASES, "is_deleted", dialect)


def test_comments(spark):
    shared = [
        (None, 0), ("null", 0), ('""', 0), ('"a"', 1), ('"a - b"', 2), ('"a - b - "', 3),
        ('"a-b"', 1), ("5", REFUSED),
    ]
    check_field(spark, shared + [("0", REFUSED), ("false", REFUSED)], "comments")
    check_field(spark, shared + [("0", 0), ("false", 0)], "comments", "extended")


def test_like_count(spark):
    check_field(spark, [(None, 0), ("null", None), ("7", 7), ('"7"', 7), ('"x"', None)], "like_count")
    wrapped = '{"$numberInt": "7"}'
    check_field(
        spark, [(None, None), ("null", None), ("7", 7), (wrapped, 7)], "like_count", "extended"
    )


def test_posted_timestamp(spark):
    daily = [
        (None, EPOCH_ISO), ("0", EPOCH_ISO), ("86400", "1970-01-02T00:00:00"),
        ('"86400"', "1970-01-02T00:00:00"), ("86400.9", "1970-01-02T00:00:00"),
        ("-1", "1969-12-31T23:59:59"), ("null", REFUSED), ('""', REFUSED), ('"x"', REFUSED),
        ("99999999999999", REFUSED),
    ]
    check_field(spark, daily, "posted_timestamp")
    extended = [
        (None, EPOCH_ISO), ("null", EPOCH_ISO), ('""', EPOCH_ISO), ('"86400"', REFUSED),
        ('{"$numberLong": "86400"}', "1970-01-02T00:00:00"),
    ]
    check_field(spark, extended, "posted_timestamp", "extended")


def test_posted_date_default(spark):
    check_field(spark, [(None, "1970-01-01"), ("null", "None")], "posted_date")
    check_field(spark, [(None, "1970-01-01 00:00:00")], "posted_date", "extended")


def test_wrapped_numbers(spark):
    cases = [
        ('{"$numberInt": "5"}', 5), ('{"$numberLong": "5"}', 5), ('{"$numberInt": 5}', 5),
        ('{"$date": {"$numberLong": "5"}}', 5), ('{"$numberInt": "x"}', REFUSED),
        ('{"$numberInt": null}', REFUSED), ('{"$date": "2020"}', REFUSED), ('{"a": 1}', REFUSED),
    ]
    check_field(spark, cases, "visit_count", "extended")


def test_ids(spark):
    lines = ['{"object": {"id": 1}}', '{"_id": null, "object": {"id": 1}}', '{"_id": "a"}',
             '{"_id": "a", "object": {}}', '{"_id": "a", "object": null}',
             '{"_id": "a", "object": "x"}', '{"_id": "a", "object": {"id": null}}',
             '{"_id": 5, "object": {"id": "q"}}']
    daily = run(spark, lines)
    assert [reason for reason, _ in daily[:4]] == ["_id", "_id", "object", "object.id"]
    assert all(reason is not None for reason, _ in daily[4:6])
    assert daily[6][0] is None and daily[6][1]["object"]["id"] is None
    assert daily[7][0] is None and daily[7][1]["_id"] == "5"
    extended = run(spark, lines, "extended")
    assert [reason for reason, _ in extended[:2]] == ["_id", "_id"]
    assert [doc["object"]["id"] for reason, doc in extended[2:4] if reason is None] == ["0", "0"]
    assert all(reason is not None for reason, _ in extended[4:6])


def test_broken_lines(spark):
    lines = ['{"_id": "a"', "", "[1]", "5", '{"_id": "a", "object": {"id": 1}} extra',
             '{"_id": "a", "object": {"id": 1}}, {"_id": "b"}',
             '{"_id": "a", "object": {"id": 1}}, "x": 2', '{"_id": "a", "object": {"id": 1}}], [1',
             "{'_id': 'a'}", '{"_id": NaN}']
    reasons = [reason for reason, _ in run(spark, lines)]
    assert all(reason is not None for reason in reasons)
    assert reasons[0] == reasons[1] == reasons[4] == "bad json"
    assert reasons[2] == reasons[3] == "not an object"


def test_last_of_repeated_keys_wins(spark):
    line = '{"_id": "a", "_id": "b", "object": {"id": 1, "title": "x", "title": "y"}}'
    (reason, document), = run(spark, [line])
    assert reason is None and document["_id"] == "b" and document["object"]["title"] == "y"


def test_blank_lines_are_skipped_by_the_extended_dialect(spark):
    assert run(spark, ["", "  "], "extended") == []


def test_created_at(spark):
    forms = ["2023-10-01T12:34:56Z", "2023-10-01 12:34:56", "2023-10-01T12:34:56+02:00", "x", 5, None]
    got = run(spark, [with_top(created_at=form) for form in forms] + [json.dumps(BASE)])
    times = [str(doc["created_at"]) if reason is None else reason for reason, doc in got]
    assert times == ["2023-10-01 12:34:56", "2023-10-01 12:34:56", "2023-10-01 10:34:56",
                     "created_at", "created_at", "None", "None"]
    wrapped = [{"$date": {"$numberLong": "1500"}}, 1500, None, "1500", ""]
    got = run(spark, [with_top(created_at=form) for form in wrapped], "extended")
    times = [str(doc["created_at"]) if reason is None else reason for reason, doc in got]
    assert times == ["1970-01-01 00:00:01.500000"] * 2 + [
        "1970-01-01 00:00:00", "created_at", "1970-01-01 00:00:00"]


def test_flatten_fills_gaps(spark):
    df = spark.createDataFrame([(json.dumps(BASE),)], "value string")
    row = n.flatten(n.accepted(n.normalize(df))).first().asDict()
    assert row["id"] == "a" and row["visit_count"] == 0 and row["tags"] == ""
    assert str(row["created_at"]) == "1970-01-01 00:00:00" and row["update_count"] == 0


def test_refused_lines_are_written_nowhere_else(spark):
    df = spark.createDataFrame([("{",), (json.dumps(BASE),)], "value string")
    done = n.normalize(df)
    assert n.accepted(done).count() == 1
    assert [tuple(r) for r in n.rejected(done).collect()] == [(None, "{", "bad json")]
