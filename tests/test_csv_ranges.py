"""CSV read in byte ranges against the reader that takes a file as one task."""

from __future__ import annotations

import random

import pytest

from tidemill.sources.csv_ranges import ends_inside, read_csv_ranges
from tidemill.sources.files import read_csv

SCHEMA = "id int, a string, b string"


@pytest.fixture
def ranges(spark):
    settings = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}

    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        for key, value in settings.items():
            if value:
                spark.conf.set(key, value)

    yield of
    for key in settings:
        spark.conf.unset(key)


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def file_of(folder, name, end, seed, rows=40):
    draw = random.Random(seed)
    lines = ["id,a,b"]
    for i in range(rows):
        value = "".join(draw.choice(['x', 'é', '"', ',', '\n', '\n\n', ' ', 'yz']) for _ in range(draw.randint(1, 30)))
        lines.append(f"{i},{quoted('v' + value + 'v')},{draw.choice(['plain', 'it 5&quot; is', quoted('q'), ''])}")
        if draw.random() < 0.1:
            lines.append("")
    lines.append(f"{rows},{quoted('long' + 'line' * 20 + chr(10) * 30 + 'end')},x")
    with open(f"{folder}/{name}", "wb") as out:
        out.write((end.join(lines) + draw.choice(["", end])).encode("ISO-8859-1"))
    return len("\n".join(lines))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [7, 64, 301, 1 << 20])
def test_equals_one_task(spark, tmp_path, ranges, end, size):
    for i in range(2):
        file_of(tmp_path, f"f{i}.csv", end, i)
    expected = sorted(map(tuple, read_csv(spark, str(tmp_path), SCHEMA, line_sep=end).collect()), key=str)
    assert len(expected) == 82
    ranges(size)
    found = read_csv_ranges(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_breaks_at_every_edge(spark, tmp_path, ranges):
    text = 'id,a,b\n1,"a""\n,""",x\n2,"\n",y\n3,"""",z\n4,plain,"\n\n"\n'
    with open(tmp_path / "f.csv", "w") as out:
        out.write(text)
    expected = [(1, 'a"\n,"', "x"), (2, "\n", "y"), (3, '"', "z"), (4, "plain", "\n\n")]
    for size in range(1, 22, 3):
        ranges(size)
        assert sorted(map(tuple, read_csv_ranges(spark, str(tmp_path), SCHEMA, "UTF-8").collect())) == expected


def test_one_large_file_is_many_tasks(spark, tmp_path, ranges):
    size = file_of(tmp_path, "f.csv", "\n", 5, rows=400)
    ranges(size // 8)
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() >= 8
    assert read_csv_ranges(spark, str(tmp_path), SCHEMA).count() == 401


def test_quotes_inside_plain_values_and_empty_files(spark, tmp_path):
    assert not ends_inside(b'1,5" pipe,"x"', False)
    assert ends_inside(b'1,5" pipe,"x', False)
    assert not ends_inside(b'x"', True) and ends_inside(b'x""', True) and ends_inside(b"", True)
    (tmp_path / "none.csv").write_text("id,a,b\n")
    (tmp_path / "empty.csv").write_text("")
    assert read_csv_ranges(spark, str(tmp_path), SCHEMA).collect() == []
