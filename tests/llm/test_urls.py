import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opsframe.llm import queries, urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:at], rest[at:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        (len(h + p), h + p, v) for v, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


AWKWARD = [
    None, "", "no scheme", "://", "http://", "http://Example.ORG", "http://example.org/", "http://EXAMPLE.org/es/x",
    "http://a.example.org/en/12?x=/es/", "http://badexample.org/es/1", "https://x.com/de/#a", "https://x.com/fr/?q",
    "https://com/de/x", "https://x.com?u=http://y.org/", "http://x.org#/es/", "a://b://c.org/d", "http://ÜN.org/é/ñ",
    "http://x.net/" + "a1" * 5_000, "http://x\n.org/a\nb", "http://user@host.com:80/de/x", "HTTP://Q.com/FR/",
]


def test_rules_against_plain_code(spark):
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(AWKWARD)], "page_id long, url string")
    out = {r.page_id: r for r in urls.judged(frame.unionByName(frame)).collect()}
    for i, url in enumerate(AWKWARD):
        host, path, rule, verdict = plain(url)
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule), url
        assert out[i].verdict == verdict or verdict is None and out[i].verdict in ("allow", "block")


@pytest.mark.parametrize("text", ["", "aaaa", "abcd", "http://x.org/a1?b=c", "ñandú", "a.b|c$d\\"])
def test_entropy(spark, text):
    counts = Counter(text).values()
    expected = -sum(n / len(text) * math.log2(n / len(text)) for n in counts)
    got = spark.createDataFrame([(text,)], "t string").select(urls.entropy(F.col("t"))).first()[0]
    assert got == pytest.approx(expected, abs=1e-9)


def test_trees_learn_from_rule_labels(spark):
    """Blocked URLs are long and full of digits: the trees carry that to hosts without a rule."""
    good = [f"https://site{i % 7}.org/en/page{i % 9}" for i in range(120)]
    bad = [f"https://x{i}.com/de/{i * 7919}{i * 104729}/{i * 31}?a={i}&b={i}&c={i}" for i in range(120)]
    rest = [f"https://y{i}.net/en/page{i}" for i in range(10)]
    rest += [f"https://z{i}.net/q/{i * 7919}{i * 104729}/{i * 37}?a={i}&b={i}&c={i}" for i in range(10, 20)]
    frame = spark.createDataFrame(list(enumerate(good + bad + rest)), "page_id long, url string")
    out = {r.url: r for r in urls.judged(frame).collect()}
    assert [out[u].verdict for u in rest] == ["allow"] * 10 + ["block"] * 10
    assert all(out[u].rule is None for u in rest)


def test_rows_of_one_url_are_drawn_each_by_itself(spark, monkeypatch):
    """A URL of a third of the rows is about a third of the rows that trees learn from."""
    monkeypatch.setattr(urls, "TRAIN_ROWS", 60)
    written = urls.written
    for letter in "hkm":
        seen = {}
        monkeypatch.setattr(urls, "written", lambda df, name, to=seen: to.setdefault(name, written(df, name)))
        some = [f"https://site{i % 7}.org/en/page{i}" for i in range(100)]
        some += [f"https://x{i}.com/de/{i * 7919}" for i in range(100)]
        some += ["https://hot.org/en/" + letter * 90] * 100
        urls.judged(spark.createDataFrame(list(enumerate(some)), "page_id long, url string"))
        assert seen["urls"].count() == 60
        assert 8 <= seen["urls"].where("length > 100").count() <= 32


def test_no_rules_and_one_class(spark):
    frame = spark.createDataFrame([(1, "http://x.org/a"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urls.judged(frame, rules=()).collect()} == {"allow"}
    assert {r.verdict for r in urls.judged(frame).collect()} == {"allow"}
    only = urls.judged(frame, rules=(urls.Rule("block", "org", "/"),)).collect()
    assert {r.page_id: (r.score, r.verdict) for r in only} == {1: (1.0, "block"), 2: (1.0, "block")}


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame(
        [("http://x.org/", "h", "r", 1, 2)], "url string, host string, rule string, label int, features int"
    )
    row = urls.judged(frame).first()
    assert (row.host, row.rule, row.label, row.features) == ("x.org", "org/", 1, 2)
    assert urls.judged(frame.limit(0)).count() == 0


def test_query_rules_and_no_python(spark):
    folder = "/root/testdata/sf0.01"
    out = queries.op9_urls(spark, folder)
    pages = {r.page_id: r.url for r in queries.table(spark, folder, "pages").collect()}
    found = {r.page_id: r for r in out.collect()}
    assert found.keys() == pages.keys()
    for i, url in pages.items():
        host, path, rule, verdict = plain(url)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert verdict is None or found[i].verdict == verdict
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def mixed_suffixes():
    """Verdicts follow the host's suffix alone; one suffix has a single URL."""
    found = [f"https://site{i}.com/fr/{i % 13}" for i in range(150)]
    found += [f"https://site{i}.example.org/es/{i % 13}" for i in range(150)]
    return found + ["https://only.com/de/x"] * 40


def test_statistics_leave_out_the_rows_own_fold(spark):
    """Against counts by hand: no copy of a URL is in the statistics that it learns from."""
    frame = spark.createDataFrame(
        [(u, u.split("/")[2].rsplit(".", 1)[1], float("/fr/" not in u)) for u in mixed_suffixes()],
        "url string, suffix string, label double",
    ).withColumn("fold", urls.fold_of(F.col("url")))
    rows = frame.collect()
    out = urls.SuffixStatistics(frame).joined_apart(frame).collect()
    assert len(out) == len(rows)
    for row in out:
        rest = [r for r in rows if r.fold != row.fold]
        same = [r for r in rest if r.suffix == row.suffix]
        usual = sum(r.label for r in rest) / len(rest)
        assert row.suffix_rate == pytest.approx((sum(r.label for r in same) + 10 * usual) / (len(same) + 10))
        assert row.suffix_share == pytest.approx(len(same) / len(rest))


def test_held_out_urls_are_told_apart(spark):
    """Every labelled URL of the fold is counted once, most of them rightly."""
    frame = spark.createDataFrame([(u,) for u in mixed_suffixes()], "url string")
    in_fold = frame.where(urls.fold_of(F.col("url")) == 1)
    got = {(r.label, r.predicted): r.n for r in urls.held_out(frame, fold=1).collect()}
    assert sum(got.values()) == in_fold.count()
    assert got.get((0, 0), 0) + got.get((1, 1), 0) >= 0.7 * sum(got.values())
    assert urls.held_out(frame, rules=()).count() == 0
    assert urls.held_out(frame.limit(0)).count() == 0
