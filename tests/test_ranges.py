import csv
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lexispark.sources import corpus, ranges

PARTS = ["a", "word", ",", '"', '""', "\n", "\r\n", "\n\n", " ", "é漢", "5\" disk", "'", ";", "\t", "x" * 50]


def by_lines(text, state):
    """States after every line, walked one character at a time."""
    inside, start, out = state, not state, []
    for line in text.split("\n"):
        i = 0
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"':
                    if line[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        inside = False
            elif c == '"' and start:
                inside = True
            start = not inside and c == "," if inside is False else False
            i += 1
        out.append(inside)
        start = not inside
    return out


def test_states_of_lines():
    random.seed(1)
    for _ in range(3000):
        text = "".join(random.choice(["a", ",", '"', '""', "\n", ",\"", "\","]) for _ in range(random.randint(0, 25)))
        for state in (False, True):
            inside, got = state, []
            for line in text.split("\n"):
                inside = ranges.leaves(line, inside)
                got.append(inside)
            assert got == by_lines(text, state), (text, state)


def written(path, rows, header=("text", "label", "dataset"), end="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end, quoting=quoting)
        w.writerow(header)
        w.writerows(rows)


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "97")
    spark.conf.set(names[1], "1")
    yield spark
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def table(df, columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_in_many_tasks_equals_one_task(small_ranges, tmp_path, end):
    spark = small_ranges
    random.seed(2)
    rows = [("".join(random.choice(PARTS) for _ in range(random.randint(0, 12))), str(i % 3), random.choice(["s", "", "p,q"])) for i in range(300)]
    rows[40] = ("line\n" * 100 + '"', "0", "long")
    path = f"{tmp_path}/x.csv"
    written(path, rows, end=end)
    got = ranges.read_csv_ranges(spark, path)
    columns = ["text", "label", "dataset"]
    assert ranges._lines(spark, path).rdd.getNumPartitions() > 50
    assert got.select("_row").distinct().count() == got.count() == 300
    want = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    # the other reader turns CRLF inside quotes into LF where lines end in CRLF
    unix = lambda rows: [r.replace("\\r\\n", "\\n") for r in rows] if end == "\r\n" else rows
    assert sorted(unix(table(got, columns))) == sorted(unix(table(want, columns)))
    assert [r.text or "" for r in got.collect() if r.dataset == "long"] == [rows[40][0]]
    plain = duckdb.sql(f"SELECT * FROM read_csv('{path}', header = true, all_varchar = true, quote = '\"', escape = '\"', delim = ',', auto_detect = false, columns = {{'text': 'VARCHAR', 'label': 'VARCHAR', 'dataset': 'VARCHAR'}})").fetchall()
    blank = lambda rows: sorted(tuple(v or "" for v in r) for r in rows)
    assert blank(tuple(r) for r in got.select(*columns).collect()) == blank(plain) == sorted(rows)


def test_many_states_forget_and_flip(spark):
    random.seed(3)
    ends = [(f, i * 10, 10, *random.choice([(0, 1), (1, 0), (0, 0), (1, 1)])) for f in ("a", "b") for i in range(60)]
    states = {(r._file, r._start): r._inside for r in ranges.range_states(spark.createDataFrame(ends, "_file string, _start bigint, _length bigint, e0 bigint, e1 bigint")).collect()}
    for f in ("a", "b"):
        state = 0
        for file, start, _, e0, e1 in ends:
            if file == f:
                assert states[f, start] == bool(state)
                state = (e0, e1)[state]


def test_several_files_types_and_odd_files(spark, tmp_path):
    written(f"{tmp_path}/a.csv", [("x\ny", 1, "d"), ("", 2, "")])
    written(f"{tmp_path}/b.csv", [("z", 3, "d")], quoting=csv.QUOTE_ALL)
    open(f"{tmp_path}/c.csv", "w").close()
    (tmp_path / "d.csv").write_text("﻿text,label,dataset\n\n\nq,4,\n\"never closed,5\n", encoding="utf-8")
    schema = corpus.corpus_schema(label_type="int", extra={"dataset": "string"})
    got = ranges.read_csv_ranges(spark, str(tmp_path), schema)
    assert got.schema["label"].dataType.typeName() == "integer"
    assert table(got, ["text", "label"]) == sorted(map(repr, [("x\ny", 1), (None, 2), ("z", 3), ("q", 4), ("never closed,5", None)]))
    written(f"{tmp_path}/e.csv", [("x", 1)], header=("text", "etiket"))
    with pytest.raises(Exception, match="header"):
        ranges.read_csv_ranges(spark, str(tmp_path), schema).count()


def test_ranges_that_change_are_an_error(spark, tmp_path):
    written(f"{tmp_path}/a.csv", [("x\ny", 1, "d")])
    lines = ranges._lines(spark, f"{tmp_path}/a.csv")
    states = ranges.range_states(ranges.range_ends(lines)).withColumn("_length", F.col("_length") + 1)
    with pytest.raises(Exception, match="ranges of a file changed"):
        ranges._records(ranges._with_states(lines, states), ["text", "label", "dataset"]).count()
