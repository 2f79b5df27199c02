import duckdb
import numpy as np

from baflow.llm import url_filter
from baflow.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import SMALL


def test_cascade_is_exact():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 62, 30000, dtype="u8"))
    for n, m in ((0, 10), (10, 0), (1, 1), (5, 1000), (3000, 20000), (9000, 500)):
        a, b = keys[:n], keys[n:n + m]
        c = url_filter._unpack(url_filter._pack(url_filter.build_cascade(a, b)))
        assert url_filter.in_cascade(c, a).all() and not url_filter.in_cascade(c, b).any()


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    want = sorted(con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLES['op9_bloom_cascade']})").fetchall(), key=str)
    got = sorted((tuple(r) for r in QUERIES["op9_bloom_cascade"](spark, SMALL).collect()), key=str)
    assert got == want


def test_odd_urls(spark):
    rows = [(1, None), (2, "foo"), (3, "HTTP://WWW.Example.COM"), (4, "http://x.net/es/a?b#c"), (None, "https://www.example.com/en/"),
            (6, "://"), (7, "a://net/fr/"), (8, "http://spam.org?x=1"), (9, "http://.com/"), (10, "http://e.com/" + "p/" * 5000),
            (11, "http://myexample.com/en/x"), (11, "http://myexample.com/en/x")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, rule string")
    got = url_filter.judge(pages, listed_hosts=url_filter.hosts_with_words(pages)).collect()
    by = {(r["page_id"], r["rule"], r["verdict"]) for r in got}
    assert len(got) == len(rows)
    assert {(1, None, "allow"), (2, None, "allow"), (3, None, "allow"), (4, "net/es/", "block"), (None, "www.example.com/en/", "allow"),
            (7, "net/fr/", "block"), (8, None, "block"), (9, "com/", "allow"), (11, "com/", "allow")} <= by
    assert url_filter.judge(pages.where("false")).count() == 0
    assert url_filter.judge(pages, rules=()).where("rule is not null").count() == 0


def test_cascades_too_large_to_send(spark):
    keys = spark.range(1000).selectExpr("xxhash64(id) AS key", "id % 7 = 0 AS listed")
    c = url_filter.cascades(keys, shard_keys=100, send_bytes=10)
    assert c.sent is None
    got = c.member_by_shard(spark.range(1000).selectExpr("id", "xxhash64(id) AS key"), "id").collect()
    assert sorted(r["id"] for r in got) == list(range(0, 1000, 7))
