import random

import pytest
from pyspark.sql import functions as F

from ratemill.functions.text import (
    has_name_clash,
    header_names,
    is_blank,
    split_fields,
    trim_fields,
)

def expected(line: str) -> list[str]:
    """Cut at the commas that an even number of quotes follows, then trim."""
    fields = [""]
    for i, char in enumerate(line):
        if char == "," and line.count('"', i) % 2 == 0:
            fields.append("")
        else:
            fields[-1] += char
    return [f.strip(' "') for f in fields]


def parsed(spark, lines: list[str]) -> dict[str, list[str]]:
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    rows = df.select("line", trim_fields(split_fields(F.col("line"))).alias("f")).collect()
    return {r.line: r.f for r in rows}


@pytest.mark.parametrize(
    "line, fields",
    [
        ('a,"1,000",b,,', ["a", "1,000", "b", "", ""]),
        ('"say ""hi""",x', ['say ""hi', "x"]),
        ('a,b"c,d,e', ['a,b"c', "d", "e"]),
        ("\ta\t, b ", ["\ta\t", "b"]),
        ('""', [""]),
        ("x", ["x"]),
    ],
)
def test_split_cases(spark, line, fields):
    assert expected(line) == fields
    assert parsed(spark, [line])[line] == fields


def test_split_equals_pattern_on_random_lines(spark):
    rng = random.Random(7)
    lines = {"".join(rng.choices('ab, "\t', k=rng.randint(1, 24))) for _ in range(4000)}
    got = parsed(spark, sorted(lines))
    assert got == {x: expected(x) for x in lines}


def test_split_of_a_very_long_line_is_linear(spark):
    n = 60_000
    line = ",".join(f'"{i},{i}"' for i in range(n))
    df = spark.createDataFrame([(line,)], "line string")
    fields = trim_fields(split_fields(F.col("line"))).alias("f")
    row = df.select(fields).select(F.size("f"), F.get("f", F.lit(n - 1))).first()
    assert tuple(row) == (n, f"{n - 1},{n - 1}")


@pytest.mark.parametrize(
    "fields, names, clash",
    [
        (["A", "", "a", "A"], ["A", "Column_2", "a_2", "A_3"], False),
        (["A_2", "A", "A"], ["A_2", "A", "A_2"], True),
        (["Column_2", " \t", "x"], ["Column_2", "Column_2_1", "x"], False),
    ],
)
def test_header_names(spark, fields, names, clash):
    got = header_names(F.lit(fields) if not fields else F.array(*[F.lit(f) for f in fields]))
    row = spark.range(1).select(got.alias("n"), has_name_clash(got).alias("c")).first()
    assert row.n == names and row.c == clash


def test_is_blank(spark):
    texts = [None, "", "  ", "\t\x0b", "  　\u0085", "x", " . "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", is_blank(F.col("t")).alias("b")).orderBy("i").collect()
    assert [r.b for r in rows] == [True, True, True, True, True, False, False]
