import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opsframe.functions.text import WHITESPACE, strip
from opsframe.operators import drift


def pairs(frame):
    return {(r.col_a, r.col_b): r for r in frame.collect()}


@pytest.fixture(scope="module")
def two_versions(spark):
    chooser = random.Random(11)
    rows = [
        (
            i,
            "hot" if i % 3 == 0 else f"name {chooser.randint(0, 60)}",
            float(chooser.randint(0, 400)),
            chooser.choice([None, 1.5, 2.25, -0.0]),
            datetime.date(2100, 1, 1 + i % 28),
        )
        for i in range(300)
    ]
    a = spark.createDataFrame(rows, "id long, name string, tonnes double, odd double, day date")
    b = drift.project_drift(
        a,
        [
            drift.Change("id", "key", "double"),
            drift.Change("name", "label", "string"),
            drift.Change("tonnes", "kilos", "double", 1000.0),
            drift.Change("odd", "odd2", "double"),
            drift.Change("day", "since", "date"),
        ],
    )
    return rows, a, b


def test_match_against_brute_force(two_versions):
    rows, a, b = two_versions

    def canon(value):
        if isinstance(value, float) and value == int(value):
            return str(int(value))
        return None if value is None else str(value)

    left = {n: {canon(r[i]) for r in rows} - {None} for i, n in enumerate(a.columns)}
    scaled = [tuple(x * 1000 if j == 2 else x for j, x in enumerate(r)) for r in rows]
    right = {n: {canon(r[i]) for r in scaled} - {None} for i, n in enumerate(b.columns)}
    got = pairs(drift.match_columns(a, b))
    expected = {(x, y) for x in left for y in right if left[x] & right[y]}
    assert set(got) == expected
    for x, y in expected:
        both = len(left[x] & right[y])
        assert (got[x, y].n_a, got[x, y].n_b, got[x, y].n_common) == (len(left[x]), len(right[y]), both)
        assert got[x, y].score == pytest.approx(both / len(left[x] | right[y]))
    assert got["id", "key"].score == got["name", "label"].score == got["day", "since"].score == 1.0


def test_match_with_more_columns_than_mask_bits(spark):
    wide = spark.range(3).select(*[(F.col("id") + 10 * i).alias(f"c{i}") for i in range(70)])
    got = pairs(drift.match_columns(wide, wide.select(*[F.col(c).alias(f"x{c}") for c in wide.columns])))
    assert set(got) == {(f"c{i}", f"xc{i}") for i in range(70)}


def test_match_texts_of_any_length(spark):
    import hashlib

    digest = hashlib.sha256(("x" * 500).encode()).hexdigest()
    a = spark.createDataFrame([("x" * 500,), ("y" * 500,), ("x" * 64,)], "t string")
    b = spark.createDataFrame([("x" * 500,), ("x" * 499,), (digest,), (digest[:32],)], "u string")
    assert drift.match_columns(a, b).first().n_common == 1


def test_match_large_whole_numbers_of_different_types(spark):
    a = spark.createDataFrame([(9_100_000_000_000_000,), (5,), (-3,)], "n long")
    b = a.select(F.col("n").cast("double").alias("x"), F.col("n").cast("decimal(30,4)").alias("d"))
    got = pairs(drift.match_columns(a, b))
    assert {pair: row.n_common for pair, row in got.items()} == {("n", "x"): 3, ("n", "d"): 3}


def test_sketches_agree_with_exact_counts(two_versions):
    _, a, b = two_versions
    exact = pairs(drift.match_columns(a, b, 0.5))
    estimated = pairs(drift.match_columns_sketched(a, b, 0.5))
    assert set(exact) == set(estimated)
    for pair, row in exact.items():
        assert estimated[pair].n_common == pytest.approx(row.n_common, rel=0.05)


@pytest.mark.parametrize("factor", [1000.0, 0.45359237, -2.0, 1.0])
def test_unit_drift_recovers_the_factor(spark, factor):
    a = spark.createDataFrame([(i, float(i % 50)) for i in range(400)] + [(None, 3.0), (900, None)], "k int, x double")
    b = a.select(F.col("k").alias("id"), (F.col("x") * F.lit(factor)).alias("y"))
    row = drift.unit_drift(a, b.unionAll(b), ("k", "id"), [("x", "y")]).first()
    assert row.n_keys == 392 and row.n_conflicts == 0 and row.constant
    assert row.min_ratio == pytest.approx(factor) and row.changed == (factor != 1.0)


def test_unit_drift_conflicts_and_varying_ratios(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 4.0), (3, 5.0)], "k int, x double")
    b = spark.createDataFrame([(1, 10.0), (2, 40.0), (3, 51.0)], "k int, y double")
    row = drift.unit_drift(a, b, ("k", "k"), [("x", "y")]).first()
    assert (row.n_keys, row.n_conflicts, row.constant, row.changed) == (2, 1, False, False)


@pytest.mark.parametrize("factor, offset", [(1.8, 32.0), (-0.25, 1e6), (1000.0, 0.0), (1.0, -273.15), (1.0, 0.0)])
def test_affine_drift_recovers_factor_and_offset(spark, factor, offset):
    rows = [(i, float(i * 37 % 101) - 40) for i in range(400)] + [(None, 3.0), (900, None), (901, float("nan"))]
    a = spark.createDataFrame(rows, "k int, x double")
    b = a.select(F.col("k").alias("id"), (F.col("x") * F.lit(factor) + F.lit(offset)).alias("y"))
    row = drift.lines.affine_drift(a, b.unionAll(b), ("k", "id"), [("x", "y")]).first()
    assert (row.n_keys, row.n_conflicts, row.constant) == (400, 0, True)
    assert row.factor == pytest.approx(factor) and row.offset == pytest.approx(offset, abs=1e-6)
    assert row.changed == ((factor, offset) != (1.0, 0.0))


def test_affine_drift_of_what_is_no_line(spark):
    rows = [(i, float(i), float(i * i), 7.0, float(i % 2)) for i in range(50)]
    a = spark.createDataFrame(rows, "k int, x double, square double, flat double, two double")
    pairs = [("x", "square"), ("x", "flat"), ("flat", "x"), ("flat", "flat"), ("x", "x")]
    found = {(r.col_a, r.col_b): r for r in drift.lines.affine_drift(a, a, ("k", "k"), pairs).collect()}
    assert [found[p].constant for p in pairs] == [False, False, False, False, True]
    split = a.unionAll(spark.createDataFrame([(3, 99.0, 9.0, 7.0, 1.0)], a.schema))
    row = drift.lines.affine_drift(a, split, ("k", "k"), [("x", "x")]).first()
    assert (row.n_keys, row.n_conflicts, row.constant) == (49, 1, False)
    few = drift.lines.affine_drift(a.where("k < 2"), a, ("k", "k"), [("x", "x")]).first()
    assert few.n_keys == 2 and not few.constant


def test_compatibility_finds_celsius_and_fahrenheit(spark):
    rows = [(i, float(i * 37 % 101) / 8 - 20, float(i % 13), None if i % 3 else float(i)) for i in range(700)]
    a = spark.createDataFrame(rows, "k int, celsius double, odd double, thin double")
    b = a.select(
        F.col("k").alias("id"), (F.col("celsius") * 1.8 + 32).alias("heat"), (F.col("odd") * F.col("odd")).alias("square"),
        (F.lit(5.0) - F.col("thin") * 2).alias("turned"),
    ).where("id % 10 < 9")
    found = {(r.kind, r.col_a, r.col_b): r.detail for r in drift.compatibility_findings(a, b, ("k", "id")).collect()}
    assert found["unit_changed", "celsius", "heat"] == "factor 1.800000 offset 32.000000"
    assert found["unit_changed", "thin", "turned"] == "factor -2.000000 offset 5.000000"
    assert ("missing", "odd", None) in found and ("extra", None, "square") in found
    same = a.withColumn("celsius", F.col("celsius") + 273.15)
    shifted = drift.compatibility_findings(a, same, ("k", "k")).collect()
    assert [(r.kind, r.col_a, r.detail) for r in shifted] == [("unit_changed", "celsius", "factor 1.000000 offset 273.150000")]


def test_lines_of_many_columns(spark):
    """Pairs are proposed from what is as small as the schema, and none is an expression of a plan."""
    import numpy as np

    chooser = np.random.default_rng(4)
    values = np.round(chooser.normal(size=(300, 90)) * 100, 3)
    order = chooser.permutation(90)
    factors = np.round(chooser.uniform(0.5, 3, 90), 2) * np.where(np.arange(90) % 2, 1, -1)
    keys = np.arange(300)
    import pandas as pd

    left = pd.DataFrame(values, columns=[f"a{i}" for i in range(90)]).assign(k=keys)
    right = pd.DataFrame(values[:, order] * factors + 7, columns=[f"b{j}" for j in range(90)]).assign(k=keys)
    a, b = spark.createDataFrame(left), spark.createDataFrame(right)
    names = [[f"a{i}" for i in range(90)], [f"b{j}" for j in range(90)]]
    per_key = drift.written(drift.lines.keyed_values(a, b, ("k", "k"), names), "wide")
    pairs = drift.lines.proposed(per_key, names, np.ones((90, 90), bool))
    assert set(pairs) == {(f"a{i}", f"b{j}") for j, i in enumerate(order)}


def test_banded_matches_keep_similar_columns(spark):
    """Of pairs that share over half of their values at least nine in ten are found, among 300 columns."""
    import numpy as np
    import pandas as pd

    chooser = np.random.default_rng(5)
    base = [chooser.choice(10**9, 150, replace=False) for _ in range(60)]
    cells = {f"a{i}": base[i] for i in range(60)}
    for i in range(60, 300):
        kept = chooser.random(150) < chooser.uniform(0.5, 1)
        cells[f"a{i}"] = np.where(kept, base[i % 60], chooser.choice(10**9, 150))
    a = spark.createDataFrame(pd.DataFrame(cells))
    b = spark.createDataFrame(pd.DataFrame({f"b{i}": base[i] for i in range(60)}))
    sets = {n: set(x.tolist()) for n, x in cells.items()}
    true = {
        (n, f"b{i}") for n in cells for i in range(60)
        if len(sets[n] & sets[f"a{i}"]) / len(sets[n] | sets[f"a{i}"]) > 0.5
    }
    frame = drift.match_columns_sketched(a, b, 0.4)
    found = {(r.col_a, r.col_b) for r in frame.collect()}
    assert len(true) > 100 and len(true & found) >= 0.9 * len(true)
    assert not any(int(x[1:]) % 60 != int(y[1:]) for x, y in found)


def test_compatibility(spark, two_versions):
    _, a, b = two_versions
    found = {(r.kind, r.col_a, r.col_b): r for r in drift.compatibility_findings(a, b, ("id", "key")).collect()}
    assert set(found) == {
        ("renamed", "id", "key"),
        ("renamed", "name", "label"),
        ("renamed", "odd", "odd2"),
        ("renamed", "day", "since"),
        ("unit_changed", "tonnes", "kilos"),
        ("type_changed", "id", "key"),
    }
    assert found["type_changed", "id", "key"].action == "cast id from bigint to double into key"
    rough = drift.compatibility_findings(a, b, ("id", "key"), sketched=True)
    assert {(r.kind, r.col_a, r.col_b) for r in rough.collect()} == set(found)
    assert found["unit_changed", "tonnes", "kilos"].detail == "factor 1000.000000"
    report = drift.compatibility_report(a, b, ("id", "key")).first()
    assert not report.compatible and len(report.mismatches) == len(report.suggested_actions) == 6
    same = drift.compatibility_report(a, a, ("id", "id")).first()
    assert same.compatible and same.mismatches == [] and same.suggested_actions == []


def test_compatibility_missing_extra_and_types(spark):
    a = spark.createDataFrame([(1, "x", 5.0, "p")], "id int, name string, w double, only string")
    b = spark.createDataFrame([(1, "x", 10.0, "zz")], "id long, name string, w double, fresh string")
    findings = drift.compatibility_findings(a, b, ("id", "id")).collect()
    # One shared key is too little to call the weight a unit change.
    assert {(r.kind, r.col_a, r.col_b) for r in findings} == {
        ("type_changed", "id", "id"),
        ("missing", "only", None),
        ("extra", None, "fresh"),
    }


def test_strip_equals_python(spark):
    cells = [c + "a" + WHITESPACE + "b" + c for c in [WHITESPACE, "", "\n\t", "　", "."]] + [WHITESPACE, ""]
    frame = spark.createDataFrame([(c,) for c in cells], "c string")
    assert [r[0] for r in frame.select(strip(F.col("c"))).collect()] == [c.strip() for c in cells]


def test_diff_keyed(spark):
    shape = "k int, name string, n int, tags array<string>"
    a = spark.createDataFrame(
        [(1, "x", 1, ["t"]), (2, "y", None, []), (3, "z", 3, None), (4, "w", 4, []), (None, "q", 0, []), (6, "d", 1, []), (6, "d", 1, [])],
        shape,
    )
    b = spark.createDataFrame(
        [(1, " x\n", 1, ["t"]), (2, "y", None, []), (3, "zz", 4, None), (5, "v", 5, []), (None, "q", 1, []), (6, "d", 1, []), (7, "e", 1, []), (7, "e", 2, [])],
        shape,
    )
    got = {r.k: (r.status, r.changed_columns) for r in drift.diff_tables(a, b, ["k"]).collect()}
    assert got == {
        3: ("changed", "name,n"),
        4: ("removed", ""),
        5: ("added", ""),
        6: ("copies", ""),
        7: ("ambiguous", ""),
        None: ("changed", "n"),
    }
    assert drift.diff_tables(a, a, ["k"]).count() == 0
    skipped = drift.diff_tables(a, None, ["k"])
    assert skipped.count() == 0 and skipped.columns == ["k", "status", "changed_columns"]


def test_diff_needs_the_same_columns(spark):
    a, b = spark.range(1), spark.range(1).withColumnRenamed("id", "x")
    for diff in (lambda: drift.diff_tables(a, b, ["id"]), lambda: drift.diff_rows(a, b)):
        with pytest.raises(ValueError, match="different columns"):
            diff()


def test_diff_rows_counts_surplus_copies(spark):
    chooser = random.Random(2)
    left = [(chooser.choice(["hot", "hot", "a", "b", None]), chooser.randint(0, 4)) for _ in range(900)]
    right = [(chooser.choice(["hot", "a", "c", None]), chooser.randint(0, 4)) for _ in range(700)]
    shape = "s string, n int"
    got = drift.diff_rows(spark.createDataFrame(left, shape), spark.createDataFrame(right, shape))
    counts_l, counts_r = Counter(left), Counter(right)
    expected = {k: (counts_l[k], counts_r[k]) for k in counts_l | counts_r if counts_l[k] != counts_r[k]}
    assert {(r.s, r.n): (r.n_left, r.n_right) for r in got.collect()} == expected
    same = spark.createDataFrame(left, shape)
    assert drift.diff_rows(same, same).count() == 0
    assert drift.diff_rows(same, None).count() == 0


def test_profile(spark):
    frame = spark.createDataFrame(
        [(1, "b", -0.0, True), (2, "a", 2.5, None), (2, None, 0.0, True)], "i int, s string, d double, f boolean"
    ).withColumn("nested", F.array("i"))
    expected = {
        ("i", "int", 3, 0, 2, "1", "2"),
        ("s", "string", 3, 1, 2, "a", "b"),
        ("d", "double", 3, 0, 2, "0.0", "2.5"),
        ("f", "boolean", 3, 1, 1, "true", "true"),
    }
    for exact in (True, False):
        assert {tuple(r) for r in drift.profile(frame, exact=exact).collect()} == expected
    for exact in (True, False):
        empty = drift.profile(frame.limit(0), exact=exact).collect()
        assert {(r.n_rows, r.n_nulls, r.n_distinct, r.min_value) for r in empty} == {(0, 0, 0, None)}
    large = spark.range(50_000, numPartitions=9).select((F.col("id") % 20_000).alias("id"))
    estimated = drift.profile(large, exact=False).first()
    assert estimated.n_rows == 50_000 and estimated.n_distinct == pytest.approx(20_000, rel=0.06)


def test_match_without_comparable_columns(spark):
    lists = spark.createDataFrame([([1],)], "x array<int>")
    for match in (drift.match_columns, drift.match_columns_sketched):
        assert match(lists, spark.range(2)).count() == 0
