"""Quoted CSV cells: the splittable scan against Python's csv module, pandas and DuckDB."""

import csv
import io as stdio
import random

import duckdb
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.plans.jobs import split_job
from shopflow.sources import io, quoted_csv

SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("a", T.StringType()),
                       T.StructField("b", T.StringType()), T.StructField("k", T.LongType())])
CELLS = ["x", "", 'He said "hi"', "a,b", "two\nlines", "cr\r\nlf", '"', '""', "\n", '",\n"', "é\n\n", "  pad ", "end\\", 'q"mid', "one\rcr"]


def write(path, rows, header=("a", "b", "k"), end="\n"):
    text = stdio.StringIO(newline="")
    w = csv.writer(text, lineterminator=end)
    w.writerow(header)
    w.writerows(rows)
    path.write_text(text.getvalue(), newline="", encoding="utf-8")


def blank(v):
    return v if v != "" else None


@pytest.fixture
def small_splits(spark):
    """Files are cut every few bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "331", "spark.sql.files.openCostInBytes": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_cells_of_files_cut_inside_quotes(spark, tmp_path, small_splits, end):
    rnd = random.Random(5)
    want = []
    for f in range(3):
        rows = [(rnd.choice(CELLS), "long " * 60 + "\n" + "cell " * 30 if i % 9 == 0 else rnd.choice(CELLS), 1000 * f + i) for i in range(40)]
        write(tmp_path / f"part-{f}.csv", rows, end=end)
        want += rows
    assert len(spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().collect()) > 20
    got = io.load_behavior(spark, str(tmp_path), schema=SCHEMA, strict=True).orderBy("row_id").collect()
    assert [(r.row_id, r.a, r.b, r.k) for r in got] == [(i, blank(a), blank(b), k) for i, (a, b, k) in enumerate(want)]
    assert {r.column: r.bad for r in io.bad_cells(spark, str(tmp_path), SCHEMA).collect()} == {"k": 0}
    # DuckDB and pandas read the same
    for f in range(3):
        path = tmp_path / f"part-{f}.csv"
        here = [(blank(a), blank(b), k) for a, b, k in want if k // 1000 == f]
        frame = pd.read_csv(path, keep_default_na=False, lineterminator=None)
        assert [(blank(a), blank(b), k) for a, b, k in frame.itertuples(index=False)] == here
        if end == "\n":
            duck = duckdb.execute(f"select * from read_csv('{path}', header=true, quote='\"', escape='\"', delim=',', all_varchar=true)").fetchall()
            assert [(blank(a or ""), blank(b or ""), int(k)) for a, b, k in duck] == here


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(CELLS), min_size=2, max_size=3), min_size=1, max_size=6), st.booleans())
def test_line_functions_equal_a_reader(rows, all_quoted):
    """The automaton, said in Python: a line leaves a cell open exactly where a reader goes on to the next line."""
    text = stdio.StringIO(newline="")
    csv.writer(text, lineterminator="\n", quoting=csv.QUOTE_ALL if all_quoted else csv.QUOTE_MINIMAL).writerows(rows)
    lines = text.getvalue().split("\n")[:-1]
    state, records = False, 0
    for line in lines:
        state = plain_state(line, state)
        records += not state
    assert not state and records == len(rows)


def plain_state(line, inside):
    state = "in" if inside else "begin"
    for c in line:
        if c == '"':
            state = {"begin": "in", "in": "quote", "quote": "in", "cell": "cell"}[state]
        elif state != "in":
            state = "begin" if c == "," else "cell"
    return state == "in"


def test_line_states_native(spark):
    rnd = random.Random(1)
    lines = ["".join(rnd.choice(['"', '"', ",", "a", " "]) for _ in range(rnd.randint(0, 12))) for _ in range(1500)]
    df = quoted_csv.line_states(spark.createDataFrame([(x,) for x in lines], "value string"))
    for r in df.collect():
        assert (r.f0, r.f1) == (plain_state(r.value, False), plain_state(r.value, True)), r.value


def test_split_states_follow_the_lines(spark):
    """The state at the start of a split, from composed functions of any kind."""
    rnd = random.Random(3)
    functions = [(f, 100 * i, *rnd.choice([(False, True), (True, False), (False, False), (True, True)])) for f in "ab" for i in range(40)]
    df = spark.createDataFrame(functions, "_file string, _start long, g0 boolean, g1 boolean")
    want = {}
    for f in "ab":
        state = False
        for _, start, g0, g1 in [x for x in functions if x[0] == f]:
            if state:
                want.setdefault(f, set()).add(start)
            state = g1 if state else g0
    assert {k: set(v) for k, v in quoted_csv._begins_inside(df).items()} == want


def test_records_of_one_line_need_no_python(spark, tmp_path):
    write(tmp_path / "a.csv", [('He said "hi", ok', "X", 1), ("plain", 'q"mid', 2), (" pad ", "", 3)])
    df = io.load_behavior(spark, str(tmp_path), schema=SCHEMA)
    assert [(r.a, r.b, r.k) for r in df.orderBy("row_id").collect()] == [('He said "hi", ok', "X", 1), ("plain", 'q"mid', 2), (" pad ", None, 3)]
    assert "Python" not in df._jdf.queryExecution().toString() and "MapInArrow" not in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("multiline", [False, True])
def test_wrong_number_of_cells(spark, tmp_path, multiline):
    tail = '"x\ny",b,3\n' if multiline else "x,b,3\n"
    (tmp_path / "a.csv").write_text("a,b,k\n1,2\n\n3,4,5,6\np,q,7\n" + tail)
    got = io.load_behavior(spark, str(tmp_path), schema=SCHEMA).orderBy("row_id").collect()
    assert [(r.row_id, r.a, r.b, r.k) for r in got] == [(0, "1", "2", None), (1, "3", "4", 5), (2, "p", "q", 7),
                                                        (3, "x\ny" if multiline else "x", "b", 3)]
    assert {r.column: r.bad for r in io.bad_cells(spark, str(tmp_path), SCHEMA).collect()} == {"k": 0, "_bad_record": 2}
    with pytest.raises(Exception, match="wrong number of cells"):
        io.load_behavior(spark, str(tmp_path), schema=SCHEMA, strict=True).select("a").collect()


def test_unclosed_cell_and_differing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,k\n1,"2,3\n4,5,6\n')
    with pytest.raises(Exception, match="wrong number of cells"):
        io.load_behavior(spark, str(tmp_path), schema=SCHEMA, strict=True).collect()
    (tmp_path / "a.csv").write_text('a,b,k\n1,"2\n3",4\n')
    (tmp_path / "b.csv").write_text('a,k,b\n1,2,3\n')
    with pytest.raises(Exception, match="header differs"):
        io.load_behavior(spark, str(tmp_path), schema=SCHEMA).collect()


def test_csv_split_handoff_with_line_feeds(spark, tmp_path):
    rows = [(i, f"u{i % 5}", i, "2024-01-02 03:04:05", 1 + i % 5, 'b "q"\nline', 1, "c,t", 1, 1.0, 20.0, 1, 1, "p", "x\r\ny", "z")
            for i in range(60)]
    from shopflow.schema import BEHAVIOR_SCHEMA
    names = [f.name for f in BEHAVIOR_SCHEMA.fields]
    write(tmp_path / "log.csv", rows, header=names)
    split_job(spark, str(tmp_path / "log.csv"), str(tmp_path / "out"), fmt="csv", out_fmt="csv")
    back = io.read_splits(spark, str(tmp_path / "out"), fmt="csv")
    assert back.count() == 60 and {(r.brand_code, r.city) for r in back.select("brand_code", "city").distinct().collect()} == {
        ('b "q"\nline', "x\r\ny")}
    assert {r.split for r in back.select("split").distinct().collect()} == {"train", "test", "val"}
    assert io.read_split(spark, str(tmp_path / "out"), "val", fmt="csv").count() == back.where(F.col("split") == "val").count()
