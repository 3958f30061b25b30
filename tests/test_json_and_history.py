"""JSON structure and key history against plain Python."""

from __future__ import annotations

import json
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfgate.operators import json_structure as J
from shelfgate.operators.key_history import KeyHistory


def _paths(value, path="$"):
    kind = ("OBJECT" if isinstance(value, dict) else "ARRAY" if isinstance(value, list) else "BOOLEAN" if isinstance(value, bool)
            else "BIGINT" if isinstance(value, int) else "DECIMAL" if isinstance(value, Decimal) else "STRING" if isinstance(value, str)
            else "VOID")
    yield path, kind
    for k, v in value.items() if isinstance(value, dict) else ():
        yield from _paths(v, path + (f".{k}" if k.isidentifier() and k.isascii() else f"[{json.dumps(k, ensure_ascii=False)}]"))
    for v in value if isinstance(value, list) else ():
        yield from _paths(v, path + "[*]")


def _value(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 5)
    if kind == 5:
        return [_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind > 5:
        return {rng.choice(["a", "b_1", "c d", "é", 'q"x', "", "9"]): _value(rng, depth + 1) for _ in range(rng.randrange(4))}
    return [rng.randrange(-5, 10**12), rng.choice(["", "x", "null"]), None, rng.random() < .5, 1.5][kind]


def test_paths_equal_a_plain_walk(spark):
    rng = random.Random(7)
    texts = [(json.dumps(_value(rng)), rng.choice(["{bad", "", None, json.dumps({"k": _value(rng)})])) for _ in range(150)]
    expected = Counter()
    for row in texts:
        for name, text in zip("st", row):
            if text is not None:
                try:
                    value = json.loads(text, parse_float=Decimal)
                except ValueError:
                    expected[name, "$", "INVALID"] += 1
                    continue
                expected.update((name, p, k) for p, k in _paths(value))
    df = spark.createDataFrame(texts, "s string, t string")
    got = {(r["column"], r["path"], r["type"]): r["n_values"] for r in J.json_paths(df, ["s", "t"]).collect()}
    assert got == expected


def test_every_scalar_path_becomes_a_column(spark):
    rows = ['{"a": {"b c": 1, "d": [1, "x"]}, "m": 1}', '{"a": 2, "z.y": "q", "m": 2.5}', "bad", None, '{"n": null, "m": 1}',
            '{"mix": true, "a": {"b c": 3}}', '{"mix": "t"}']
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(rows)], "id int, `j.s` string, `j.s.m` string").drop("j.s.m")
    out = J.extract_json(df, ["j.s"]).orderBy("id")
    assert out.columns == ["id", "j.s", "j.s.a", 'j.s.a["b c"]', "j.s.m", "j.s.mix", "j.s.z.y"]
    got = [tuple(r)[2:] for r in out.collect()]
    assert got == [(None, 1, 1.0, None, None), (2, None, 2.5, None, "q"), (None,) * 5, (None,) * 5, (None, None, 1.0, None, None),
                   (None, 3, None, "true", None), (None, None, None, "t", None)]
    with pytest.raises(ValueError):
        J.scalar_columns(J.json_paths(df, ["j.s"]), max_columns=2)
    assert J.extract_json(df.where("false"), ["j.s"]).columns == ["id", "j.s"]


def test_history_counts_exactly(spark, tmp_path):
    rng = random.Random(2)
    weeks = [[(rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, 1, 2, 3])) for _ in range(n)] for n in (20, 30, 25)]
    frames = [spark.createDataFrame(w, "`k.1` string, m int") for w in weeks]
    history = KeyHistory(spark, str(tmp_path / "h"), {"k.1": "string", "m": "int"}, buckets=8)
    assert Counter(tuple(r) for r in history.lookup(frames[0]).collect()) == Counter((*k, c, 0) for k, c in Counter(weeks[0]).items())
    with pytest.raises(ValueError):
        KeyHistory(spark, str(tmp_path / "h"), {"n": "int"})
    assert history.batches() == []
    assert history.add(frames[0], "w1") and not history.add(frames[0], "w1") and history.add(frames[1], "w2")
    # another session finds the same history by its path
    again = KeyHistory(spark.newSession(), str(tmp_path / "h"), {"k.1": "string", "m": "int"}, buckets=8)
    assert again.batches() == ["w1", "w2"]
    past = Counter(weeks[0] + weeks[1])
    week = Counter(weeks[2])
    out = history.lookup(frames[2])
    assert out.columns == ["k.1", "m", "n", "n_before"]
    assert Counter(tuple(r) for r in out.collect()) == Counter((*k, c, past.get(k, 0)) for k, c in week.items())
    r = history.summary(frames[2]).first()
    known = sum(k in past for k in week)
    assert tuple(r) == (25, len(week), sum(c > 1 for c in week.values()), known, 25 - (len(week) - known))


def test_history_does_not_move(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "h"), {"id": "bigint"}, buckets=16)
    for week in range(3):
        history.add(spark.range(week * 50, week * 50 + 100), f"w{week}")
    plan = history.lookup(spark.range(80, 400))._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("p_kh", plan.index("Sort", plan.index("Exchange"))):]
    assert "Bucketed: true" in side and "Exchange" not in side.split("\n", 1)[1]
    assert history.summary(spark.range(80, 400)).first()["known"] == 120
    assert history.lookup(spark.range(0)).count() == 0


def test_colliding_hashes_are_told_apart(spark, tmp_path, monkeypatch):
    from shelfgate.operators import key_history

    monkeypatch.setattr(key_history, "key_hash", lambda df, keys: F.lit(1).cast("long"))
    history = KeyHistory(spark, str(tmp_path / "h"), {"id": "bigint"}, buckets=4)
    history.add(spark.range(10), "w")
    got = {r["id"]: r["n_before"] for r in history.lookup(spark.range(5, 15)).collect()}
    assert got == {i: int(i < 10) for i in range(5, 15)}
