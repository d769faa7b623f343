"""Nested JSON: digests as Python's json module gives them, schemas against hand-made verdicts."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from sievework.functions import nested


def _value(r, depth):
    pick = r.random()
    if depth and pick < 0.35:
        return {r.choice(["b", "a", "é", "Z", "한", "a\"", "\U0001f600", "￮"]) + str(r.randrange(9)): _value(r, depth - 1) for _ in range(r.randrange(5))}
    if depth and pick < 0.6:
        return [_value(r, depth - 1) for _ in range(r.randrange(4))]
    return r.choice([None, True, False, 0, -7, 10**17, 12345678901234567890, 1.5, -0.001, 1e16, 1e-5, 123456.789, 1e22, 2.5e-300, 0.1, 1e15, 100.0, "", "plain", 'q"uo\\te', "tab\tnew\nline\r\b\f\x01\x1f\x7f", "가나다 é", "</a>"])


def test_digests_are_those_of_sorted_compact_json(spark):
    r = random.Random(6)
    values = [_value(r, 5) for _ in range(400)] + [{"b": 1, "a": {"d": [], "c": {}}}, [], {}, None, [[[[1]]]]]
    rows = [(i, json.dumps(v, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 2]))) for i, v in enumerate(values)] + [(9000, None), (9001, "{broken")]
    got = spark.createDataFrame(rows, "id long, json string").select("id", nested.canonical_json(F.try_parse_json("json")).alias("text"), nested.digest(F.try_parse_json("json")).alias("d")).collect()
    for x in got:
        want = json.dumps(values[x["id"]], ensure_ascii=False, sort_keys=True, separators=(",", ":")) if x["id"] < 9000 else None
        assert x["text"] == want and x["d"] == (want and hashlib.sha256(want.encode()).hexdigest())


def test_too_deep_values_are_refused(spark):
    df = spark.createDataFrame([("[" * 4 + "]" * 4,)], "json string")
    assert df.select(nested.canonical_json(F.parse_json("json"), depth=4)).first()[0] == "[[[[]]]]"
    with pytest.raises(Exception, match="nested deeper than 2"):
        df.select(nested.canonical_json(F.parse_json("json"), depth=2)).collect()


SCHEMA = {
    "type": "object",
    "properties": {
        "id": {"type": "string", "pattern": "E[1-9][0-9]*"},
        "n": {"type": ["integer", "null"]},
        "grade": {"type": ["string", "null"], "enum": ["top", "low", None]},
        "xs": {"type": "array", "items": {"anyOf": [{"type": "integer"}, {"type": "object", "properties": {"k": {"type": "boolean"}}}]}, "minItems": 1, "maxItems": 3},
    },
}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('{"id":"E1","n":3,"grade":"top","xs":[1,{"k":true}]}', []),
        ('{"xs":[1],"grade":null,"n":null,"id":"E20"}', []),
        ('{"id":"E1\\n","n":3,"grade":"top","xs":[1]}', ["SCHEMA_PATTERN $.id"]),
        ('{"id":"E0","n":1.5,"grade":"mid","xs":[]}', ["SCHEMA_PATTERN $.id", "SCHEMA_TYPE $.n", "SCHEMA_TYPE $.grade", "SCHEMA_ARRAY_LENGTH $.xs"]),
        ('{"id":7,"n":true,"grade":"low","xs":[1,2,3,"x"]}', ["SCHEMA_TYPE $.id", "SCHEMA_TYPE $.n", "SCHEMA_ARRAY_LENGTH $.xs", "SCHEMA_ANY_OF $.xs[3]"]),
        ('{"id":"E1","n":1,"grade":"low","xs":[{"k":1},{"k":false,"j":1}]}', ["SCHEMA_ANY_OF $.xs[0]", "SCHEMA_ANY_OF $.xs[1]"]),
        ('{"id":"E1","n":1,"grade":"low"}', ["SCHEMA_KEYS $"]),
        ('{"id":"E1","n":1,"grade":"low","xs":[1],"more":1}', ["SCHEMA_KEYS $"]),
        ("[]", ["SCHEMA_TYPE $"]),
        ("null", ["SCHEMA_TYPE $"]),
        ("{", ["SCHEMA_JSON $"]),
        (None, ["SCHEMA_JSON $"]),
    ],
)
def test_schemas(spark, text, want):
    df = spark.createDataFrame([(text,)], "json string")
    assert df.select(nested.violations(F.try_parse_json("json"), SCHEMA)).first()[0] == want
