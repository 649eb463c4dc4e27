"""Large CSV files with line breaks in quotes, in splits of a few bytes."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opsframe.functions.shapes import BIGINT, DOUBLE, TEXT, shape
from opsframe.sources import quoted, tables

TABLE = shape(id=BIGINT, note=TEXT, size=DOUBLE, more=TEXT)


def written_file(path, rng, rows, end="\n", header=("id", "size", "note", "more")):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(header)
    for i in range(rows):
        note = rng.choice(
            ["plain", "a,b", "", 'say ""hi""', f"line one{end}line two", f"{end}{end}", '"', f'x"{end}"y, "z"{end}', "w" * 90]
        )
        more = rng.choice(["m", f"p{end}q", 'in "the" middle'])
        writer.writerow([i, rng.choice(["1.5", "", "bad"]), note, more])
        if rng.random() < 0.05:
            out.write(end)
    path.write_text(out.getvalue(), newline="")


@pytest.fixture
def tiny_splits(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")

    def set_size(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)

    yield set_size
    for key, value in saved.items():
        spark.conf.set(key, value)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("size, end", [("100", "\n"), ("700", "\r\n"), ("37", "\n")])
def test_many_splits_equal_one_task(spark, tmp_path, tiny_splits, size, end):
    for i in range(2):
        written_file(tmp_path / f"f{i}.csv", random.Random(i), 40, end)
    with (tmp_path / "f0.csv").open("a", newline="") as file:
        file.write(f"900,1.0{end}901,1.0,a,b,c,d{end}")  # too few and too many cells
    path = str(tmp_path)
    one = rows_of(tables.load_table(spark, path, TABLE)), rows_of(tables.rejected_rows(spark, path, TABLE))
    tiny_splits(size)
    frame = tables.load_table(spark, path, TABLE)
    assert "MapInArrow" in frame._jdf.queryExecution().executedPlan().toString()
    scans = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
    assert scans > 4
    assert rows_of(frame) == one[0]
    assert rows_of(tables.rejected_rows(spark, path, TABLE)) == one[1]


def test_another_header_and_other_splits_fail(spark, tmp_path, tiny_splits):
    written_file(tmp_path / "a.csv", random.Random(1), 20)
    written_file(tmp_path / "b.csv", random.Random(2), 20, header=("size", "id", "note", "more"))
    tiny_splits("90")
    with pytest.raises(Exception, match="another header|header"):
        tables.load_table(spark, str(tmp_path), TABLE).collect()
    frame = tables.load_table(spark, str(tmp_path / "a.csv"), TABLE)
    tiny_splits("60")
    with pytest.raises(Exception, match="load it again"):
        frame.collect()


def test_small_files_and_other_options_are_one_task(spark, tmp_path, tiny_splits):
    written_file(tmp_path / "a.csv", random.Random(1), 20)
    path = str(tmp_path / "a.csv")
    plain = tables.load_table(spark, path, TABLE)
    assert "MapInArrow" not in plain._jdf.queryExecution().executedPlan().toString()
    tiny_splits("100")
    other = tables.load_table(spark, path, TABLE, options={"comment": "#"})
    assert "MapInArrow" not in other._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text('a",\n;', max_size=6), min_size=2, max_size=3), max_size=5), st.data())
def test_ends_compose_along_any_split(rows, data):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    lines = out.getvalue().split("\n")
    inside, open_after = False, []
    for line in lines:
        inside = quoted.ends_inside(line, inside, ",")
        open_after.append(inside)
    # Lines that end outside of quotes end the records that Python's reader finds.
    assert not inside
    records = sum(not x for x in open_after[:-1])
    assert records == len(rows)
    cut = data.draw(st.integers(0, len(lines)))
    state = [False, True]
    for line in lines[:cut]:
        state = [quoted.ends_inside(line, x, ",") for x in state]
    assert state[0] == (open_after[cut - 1] if cut else False)
