"""FLT-1 against Python's strict ``json`` parser on generated texts.

Seeded random texts, in one DataFrame: token soup over JSON punctuation,
and real objects mutated by doubling, trailing ``]`` garbage, inserted
tokens and dropped characters. Non-finite numbers and control characters
are left out (both parsers take them differently by design).
"""

import json
import random

from pyspark.sql import functions as F

from driftlog.functions.json import is_json_object

TOKENS = ['{', '}', '[', ']', ',', ':', '"a"', '"b"', '1', ' ', '"]"', '"}"', 'true', 'null',
          '{}', '[]', '"x,y"']


def _reference(s):
    if s is None or not s.startswith("{") or not s.endswith("}"):
        return False
    try:
        return isinstance(json.loads(s), dict)
    except ValueError:
        return False


def _texts(seed=7, n=1500):
    rnd = random.Random(seed)

    def value(depth=0):
        r = rnd.random()
        if depth > 3 or r < 0.3:
            return rnd.choice([1, "s", None, True, "]", "},{", 2.5])
        if r < 0.65:
            return {rnd.choice("abc"): value(depth + 1) for _ in range(rnd.randint(0, 3))}
        return [value(depth + 1) for _ in range(rnd.randint(0, 3))]

    out = {"".join(rnd.choice(TOKENS) for _ in range(rnd.randint(1, 9))) for _ in range(n)}
    for _ in range(n):
        v = json.dumps({"k": value()}, separators=(",", ":") if rnd.random() < .5 else (", ", ": "))
        m = rnd.random()
        if m < 0.2:
            v = v + rnd.choice(TOKENS) + v
        elif m < 0.4:
            v = v + " ] " + rnd.choice(TOKENS) + " {}"
        elif m < 0.6:
            i = rnd.randint(0, len(v))
            v = v[:i] + rnd.choice(TOKENS) + v[i:]
        elif m < 0.75:
            i = rnd.randint(1, len(v) - 1)
            v = v[:i] + v[i + 1:]
        out.add(v)
    return sorted(out)


def test_strict_object_check_agrees_with_json_module(spark):
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    got = {r.i: r.o for r in df.select("i", is_json_object(F.col("v")).alias("o")).collect()}
    want = {i: _reference(t) for i, t in enumerate(texts)}
    assert sum(want.values()) > 200 and len(texts) - sum(want.values()) > 200
    wrong = [(texts[i], got[i]) for i in want if got[i] != want[i]]
    assert not wrong, wrong[:10]
