"""Native forms beside the helpers they spare: JSON redaction by pattern, and running sizes by blocks."""

import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit.functions import redaction
from lakeaudit.operators import nested

TEXTS = [
    '{"password":"a","n":1}', '{"Password" :  "a\\"b","x":{"API_KEY":12.5e3,"token":null}}', '[{"secret":true},{"authorization":"Bearer x"}]',
    '{"note":"\\"password\\": \\"kept\\"","password":""}', '{"password":["a","b"],"token":"t"}', '{"token":{"inner":"x"},"password":"p"}', '{"pass\\u0077ord":"x"}',
    '{"password":"a"} trailing', '{"password":"a"},{"password":"b"}', '{"password":"a"}] [1', "not json \"password\": \"x\"", '{"password":"a","password":"b"}', '{"password":}',
    '{"xpassword":"a","passwords":"b"}', "", "{}", None, '"password"', '["password", "x"]', '{"a":"password","b":"password\\\\","token":"\\\\"}', ' {"token" : -1 } ',
    '{"password":"line\\nbreak","é":"ü","token":"日本"}', "[" * 2000 + '{"password":"deep"}' + "]" * 2000, '1,{"password":"a"},0', '{"password":"a"}, 0',
]


def test_patterns_redact_what_the_walk_redacts(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, t string")
    got = {r.k: r.out for r in df.select("k", redaction.redact_json(F.col("t")).alias("out")).collect()}
    assert got == {k: None if t is None else redaction._redact_one(t) for k, t in enumerate(TEXTS)}


def test_random_documents(spark):
    rng = random.Random(1)
    keys = [*redaction.SENSITIVE_KEYS, "a", "b", "note"]

    def value(depth):
        kind = rng.randint(0, 6 if depth else 3)
        if kind > 3:
            return {rng.choice(keys): value(depth - 1) for _ in range(3)} if kind > 4 else [value(depth - 1) for _ in range(2)]
        return [rng.randint(-5, 5), rng.choice(["", 'q"x', "\\", "password", "a, b}"]), None, 1.5][kind]

    rows = [(k, json.dumps(value(4), ensure_ascii=False, indent=rng.choice([None, 1]))) for k in range(300)]
    got = {r.k: r.out for r in spark.createDataFrame(rows, "k int, t string").select("k", redaction.redact_json(F.col("t")).alias("out")).collect()}
    assert got == {k: redaction._redact_one(t) for k, t in rows}


def test_running_sizes_of_any_length(spark):
    rng = random.Random(2)
    lists = [["x" * rng.randint(0, 9) for _ in range(n)] for n in (0, 1, 2, 31, 32, 33, 64, 65, 500)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(lists)] + [(99, None)], "k int, v array<string>")
    got = {r.k: r.s for r in df.select("k", nested._running_sizes(F.col("v"), T.StringType()).alias("s")).collect()}
    for k, own in enumerate(lists):
        sums = [0]
        for x in own:
            sums.append(sums[-1] + len(x) + 2)
        assert got[k] == sums
    assert got[99] is None
