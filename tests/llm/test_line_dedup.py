import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from lexispark.llm.line_dedup import dedup_lines, first_occurrences, keep_bitmaps, line_hashes, lost_lines

from .helpers import LINE, fold, frame, odd_rows, rows


def brute(data, least=5):
    key = lambda line: fold(line.strip(" \t\n\x0b\f\r"))
    holders = defaultdict(set)
    for r in data:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(r[0])
    last = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= least}
    out = []
    for r in data:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == r[0]]
        out.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def digests(df):
    got = df.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("h"))
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_equals_brute_force(spark):
    other = "Another line that several of the texts share, in Capitals or not."
    data = odd_rows() + rows([f"{LINE}\nOwn {i}\n\n  {other.upper() if i % 2 else other}\n{LINE}" for i in range(9)], 100)
    assert digests(dedup_lines(frame(spark, data))) == brute(data)


def test_few_holders_keep_their_lines(spark):
    data = rows([LINE] * 4)
    assert digests(dedup_lines(frame(spark, data))) == brute(data)
    assert all(r[2] == 0 for r in brute(data))


def test_bitmap_runs(spark):
    data = rows([f"{LINE}\n{LINE}\nown\n{LINE}"] * 5)
    got = {r._id: [(x.first, x.last) for x in r.dropped] for r in keep_bitmaps(frame(spark, data)).collect()}
    assert got == {i: [(0, 1), (3, 3)] for i in range(4)}


def test_empty_table(spark):
    assert dedup_lines(frame(spark, [])).count() == 0


def test_no_python_on_the_executors(spark):
    plan = dedup_lines(frame(spark, rows(["a"])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_stream_lines_in_order(spark):
    """The sort by document and position is part of what runs, and nothing is shuffled between the ranges and the stream."""
    lines = line_hashes(frame(spark, rows([f"{LINE}\n{LINE}"] * 9)))
    plan = executed(first_occurrences(lines))
    assert "Window" in plan and plan.count("rangepartitioning") >= 1 and "hashpartitioning" not in plan
    order = plan[plan.index("Sort [") :].split("]")[0]
    assert [c.split("#")[0] for c in order[6:].split(", ")] == [f"{c}" for c in ("_h", "_g", "_s", "_id", "_pos")]
    assert first_occurrences(lines).where("_first").count() == 9


def test_frequent_lines_stay_where_they_are(spark):
    """A key with a partition's share of the lines is broadcast, one with fewer is shuffled; together they are all lost lines."""
    texts = [f"{LINE}\nThis line is held by few of them only, group {i // 6}." for i in range(60)]
    lines = line_hashes(frame(spark, rows(texts)))
    held = first_occurrences(lines).groupBy("_h", "_g").agg(F.count("*").alias("rows"), F.max("_id").alias("_last"))
    assert sorted(r.rows for r in held.collect()) == [6] * 10 + [60]
    assert lost_lines(lines, held).count() == 59 + 50
    assert digests(dedup_lines(frame(spark, rows(texts)))) == brute(rows(texts))


def test_clashing_names(spark):
    data = rows([f"{LINE}\nOwn {i}" for i in range(6)])
    df = frame(spark, data)
    for c in ("_id", "_x", "_row", "_ROW_b", "_dropped", "_lines", "N_LINES", "Kept_Text", "dropped"):
        df = df.withColumn(c, F.lit("z"))
    got = dedup_lines(df)
    assert digests(got) == brute(data) and {"_id", "_x", "_row", "_ROW_b", "_dropped", "_lines", "dropped"} < set(got.columns)
    assert sum(c.lower() in ("n_lines", "kept_text") for c in got.columns) == 2
