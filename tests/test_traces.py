"""Traces as Arrow columns: the line-by-line rules on odd texts, no Python object per line."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusmill.functions import calculator as C
from corpusmill.functions import traces as T
from corpusmill.functions.calculator import evaluate
from corpusmill.plans.q_tools import lines_text, two_decimals

CALL = re.compile(r'CALL\s+([a-zA-Z0-9_\-]+):\s*"(.*)"\s*')
PARTS = ["CALL", "CALL ", "calculator", "Scratchpad", ":", '"', '""', " ", "\t", " ", "\x1c", "\r\n", "\x0b", " ",
         "1+1", "a: b", "::", "RESULT:", "  RESULT:  7 ", "é", 'CALL calculator: "1+2"', 'CALL scratchpad: "a: b"',
         'CALL scratchpad: "z:"', 'CALL scratchpad: ": y"', 'CALL scratchpad: " "', 'CALL calculator:"1/0"  ',
         'CALL foo_1-x:"q"', 'CALL scratchpad: "RESULT: q"', 'CALL calculator: "a"b"']


def injected(text):
    out, notes = [], []
    for line in text.removesuffix("\n").split("\n"):
        out.append(line)
        call = CALL.fullmatch(line)
        if call and call[1].lower() == "calculator":
            out.append("RESULT: " + evaluate(call[2]))
        elif call and call[1].lower() == "scratchpad":
            notes.append(T.note_of(call[2]))
            out.append("RESULT: " + "\n".join(notes[-8:]))
        elif call:
            out.append("RESULT: ERROR:UNKNOWN_TOOL")
    return "\n".join(out)


def results(text):
    return [x.split("RESULT:", 1)[1].strip() for x in text.splitlines() if x.strip().startswith("RESULT:")]


def test_columns_follow_the_line_rules():
    rng = random.Random(4)
    texts = ["", "\n", "\n\n"]
    texts += ["".join(rng.choice(PARTS) + rng.choice(["\n", "", "\n"]) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    column = pa.array([*texts, None])
    assert T.inject(column).to_pylist() == [*map(injected, texts), None]
    assert T.inject(column.slice(5, 7)).to_pylist() == [injected(t) for t in texts[5:12]]
    actual, expected = T.audit(column)
    assert actual.to_pylist() == [*map(results, texts), None]
    bare = ["\n".join(x for x in t.splitlines() if not x.strip().startswith("RESULT:")) for t in texts]
    assert expected.to_pylist() == [*(results(injected(b)) for b in bare), None]
    assert T.inject(pa.array([], pa.string())).to_pylist() == [] and T.inject(pa.nulls(2, pa.string())).to_pylist() == [None, None]


def test_two_decimals_are_those_of_the_format(spark):
    k = F.col("id")
    x = F.when(k % 4 == 0, k / 1000).when(k % 4 == 1, F.rand(3) * 1e5).when(k % 4 == 2, -k / 1000).otherwise(F.exp(F.rand(5) * 60 - 20))
    odd = spark.createDataFrame([(v,) for v in (None, 0.0, -0.0, 1e14, 1e300, float("nan"), float("inf"), 0.005, 0.0049999, 2.675)], "x double")
    rows = spark.range(200_000).select(x.alias("x")).unionByName(odd)
    assert rows.filter(~two_decimals("x").eqNullSafe(F.format_string("%.2f", "x"))).limit(5).collect() == []


def test_plain_expressions_are_evaluated_as_columns(monkeypatch):
    """A division by zero is known without Python's arithmetic, numbers are cut as bytes."""
    alone = []
    one, many = C.Shape.one, C.evaluate_many
    monkeypatch.setattr(C.Shape, "one", lambda self, numbers: alone.append(1) or one(self, numbers))
    monkeypatch.setattr(C, "evaluate_many", lambda x: alone.extend(x) or many(x))
    forms = ["{a}*{b}", "{b}/({a}-{a})", "{a} % 0", "sqrt({a}) ** 2", "{a} // 2", "__import__({k})", "floor({b}) % 13", "1/0*{a}"]
    rows = [{"a": f"{k / 8:.2f}", "b": str(k), "k": k} for k in range(500)]
    texts = ["\n".join(f'CALL calculator: "{f.format(**r)}"' for f in forms) for r in rows]
    got = T.inject(pa.array(texts)).to_pylist()
    assert len(alone) < 40
    assert got == [injected(t) for t in texts]


def test_results_as_columns_are_those_of_one_expression():
    rng = random.Random(6)
    number = lambda: rng.choice([str(rng.randint(0, 60)), f"{rng.random() * 100:.2f}", "0", "0.0", "1e3", ".5", "5.", "007", "1e308", "9007199254740993"])
    forms = ["{}*{}", "{}/({}-{})", "-{} ** {} % {}", "{} ** {} % ({}/{})", "sqrt(-{})/{}", "log({})+{}/{}", "({}-{})**({}-{})", "-ceil({}/3)*0",
             "floor({}/{})/{}", "sqrt({},{})", "{}/-0.0", "e*{}", "x1e+{}", "é{}", '"{}"', "{}\t+1", "{}#{}", "", "{} {}"]
    found = [rng.choice(forms) for _ in range(8000)]
    expressions = [f.format(*[number() for _ in range(f.count("{}"))]) for f in found]
    results, place = C.evaluate_column(pa.array(expressions, pa.large_string()))
    assert results.take(pa.array(place)).to_pylist() == [C.evaluate_alone(e) for e in expressions]


def test_twelve_digits_are_those_of_the_format():
    rng = np.random.default_rng(8)
    tens = 10.0 ** np.arange(-20, 20)
    x = np.concatenate([rng.random(50_000) * 10.0 ** rng.integers(-8, 14, 50_000), (rng.integers(0, 10**12, 50_000) + 0.5) / 10.0 ** rng.integers(0, 12, 50_000),
                        tens, np.nextafter(tens, 0), [0.0, -0.0, 5e-324, 1e308, 9999999999.99999, 99999.99999995, 9.999999999995]])
    x = np.concatenate([x, -x])
    assert C.formatted(x).to_pylist() == [C.RESULT_FORMAT.format(v) for v in x.tolist()]


def test_large_batches_are_cut_in_halves(monkeypatch):
    texts = [f'CALL scratchpad: "a: {"x" * k}"\nCALL calculator: "{k}+1"' for k in range(60)]
    column, whole = pa.array([*texts, None, ""]), [*map(injected, texts), None, ""]
    assert T.inject(column).to_pylist() == whole
    monkeypatch.setattr(T, "BYTES_AT_ONCE", 200)
    assert T.inject(column).to_pylist() == whole


def test_trace_lines_with_nulls_are_left_out(spark):
    df = spark.createDataFrame([("1", "2"), (None, "2"), ("1", None), (None, None)], "a string, b string")
    text = lines_text([["a=", F.col("a")], ["-", F.col("b"), "+", F.col("b")], ["end\n"]])
    assert [r.t for r in df.select(text.alias("t")).collect()] == ["a=1\n-2+2\nend\n", "-2+2\nend\n", "a=1\nend\n", "end\n"]
