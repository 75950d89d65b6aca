import datetime as dt
import random

from pyspark.sql import functions as F

from siltstone.llm import url_filter
from siltstone.llm.queries import oracle_sql, queries
from siltstone.llm.tables import load
from tests.oracle_compare import compare, connect

SF = "/root/testdata/sf0.01"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_against_plain_loops(spark):
    draw = random.Random(2)
    hosts = ["a.x.org", "b.x.org", "x.org", "y.com", "localhost"]
    urls = [f"http://{h}/{p}" for h in hosts for p in ("", "p", "q?r=1")]
    keys = [("host", h) for h in hosts] + [("domain", d) for d in ("x.org", "y.com")]
    keys += [("url", u.removeprefix("http://").removesuffix("/")) for u in urls]
    entries = [
        (*draw.choice(keys), day(draw.randint(0, 30)), draw.choice(["block", "allow", "remove", None]))
        for _ in range(150)
    ]
    entries += entries[:20]
    captures = [(i, draw.choice(urls), day(draw.randint(-2, 32))) for i in range(400)]

    def in_force(level, key, at):
        known = {}
        for lv, k, t, action in entries:
            if (lv, k) == (level, key) and t <= at:
                known.setdefault(t, []).append(action or "remove")
        if not known or min(known[max(known)]) == "remove":
            return None
        return (level, key, min(known[max(known)]), max(known))

    want = {}
    for i, url, at in captures:
        host = url.split("/")[2]
        names = [("url", url.removeprefix("http://").removesuffix("/")), ("host", host)]
        names.append(("domain", ".".join(host.split(".")[-2:])))
        found = [e for n in names if (e := in_force(*n, at))]
        want[i] = found[0] if found else (None,) * 4
    got = url_filter.filter_captures(
        spark.createDataFrame(captures, "key long, url string, fetched timestamp_ntz"),
        spark.createDataFrame(entries, "level string, key string, at timestamp_ntz, action string"),
    )
    rows = got.collect()
    assert len(rows) == len(captures)
    for r in rows:
        assert (r.level, r.listed, r.action, r.valid_from) == want[r.key]
        assert r.allowed == (r.action != "block")


def test_odd_rows_and_empty_tables(spark):
    captures = spark.createDataFrame(
        [(1, None, day(1)), (2, "http://A.x.org/", None), (None, "HTTP://u@A.X.org:80/#f", day(1)),
         (3, "no address", day(1)), (3, "no address", day(1)), (4, "", day(1))],
        "key long, url string, fetched timestamp_ntz",
    ).withColumn("level", F.lit(1)).withColumn("action", F.lit(2))
    entries = spark.createDataFrame(
        [("host", "a.x.org", day(0), "block"), ("host", None, day(0), "block"),
         (None, "x", day(0), "block"), ("url", "no address", None, "block"),
         ("url", "", day(0), "block")],
        "level string, key string, at timestamp_ntz, action string",
    )
    rows = url_filter.filter_captures(captures, entries).collect()
    assert len(rows) == 6
    blocked = [r for r in rows if not r.allowed]
    assert sorted(str(r.url) for r in blocked) == ["", "HTTP://u@A.X.org:80/#f"]
    assert url_filter.filter_captures(captures.limit(0), entries).collect() == []
    assert all(r.allowed for r in url_filter.filter_captures(captures, entries.limit(0)).collect())


def test_query_against_sql(spark):
    name = "op10_url_filters"
    assert compare(queries()[name](spark, SF), connect(SF), oracle_sql()[name]) == []


def test_only_built_in_expressions(spark):
    plan = queries()["op10_url_filters"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_some_captures_are_blocked_and_some_are_not(spark):
    rows = queries()["op10_url_filters"](spark, SF)
    assert rows.count() == load(spark, SF, "pages").count()
    assert rows.select("allowed").distinct().count() == 2
