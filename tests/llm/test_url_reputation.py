from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from blotter.llm import url_reputation
from checks import compare

URLS = [
    ("http://A.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://example.net", "example.net", "", None, None),
    ("https://example.net/", "example.net", "/", "net/", "block"),
    ("https://example.net/EN/", "example.net", "/EN/", "net/", "block"),
    ("https://notexample.com/de/", "notexample.com", "/de/", None, None),
    ("https://b.example.com/de/1", "b.example.com", "/de/1", "example.com/de/", "block"),
    ("ftp://x.org/fr/?q=://y", "x.org", "/fr/", "org/fr/", "allow"),
    ("x.org/fr/", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("http://?a", "", "", None, None),
    ("redirect?to=http://k.org/fr/a", "k.org", "/fr/a", "org/fr/", "allow"),
    ("http://h.net:80/", "h.net:80", "/", None, None),
]


def pages(spark, urls):
    return spark.createDataFrame(
        [(n, u, -1, -1) for n, u in enumerate(urls)], "page_id long, url string, n long, host long"
    )


def labels(spark, rows):
    return spark.createDataFrame(rows, "page_id long, good int")


def test_hosts_paths_and_rules(spark):
    judged = url_reputation.judge_pages(pages(spark, [u[0] for u in URLS]), labels(spark, []))
    got = {r.page_id: r for r in judged.collect()}
    for n, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[n].host, got[n].path, got[n].rule) == (host, path, rule)
        assert got[n].verdict == (verdict or "allow")


def test_reputation_shrinks_to_the_parents(spark):
    good = [f"http://g{h}.good.com/{i}" for h in range(6) for i in range(40)]
    bad = [f"http://b{h}.bad.com/{i}" for h in range(6) for i in range(40)]
    urls = [*good, *bad, "http://new.good.com/", "http://new.bad.com/", "http://other.org/"]
    outcomes = [(n, int(n < 240)) for n in range(480)] + [(3, None), (None, 1), (10**6, 0)]
    judged = url_reputation.judge_pages(pages(spark, urls), labels(spark, outcomes), rules=())
    rows = {r.page_id: r for r in judged.collect()}
    assert all(rows[n].verdict == "allow" for n in range(240))
    assert all(rows[n].verdict == "block" for n in range(240, 480))
    assert rows[480].mean > 0.6 > 0.4 > rows[481].mean
    assert all(0 <= r.mean <= r.bound <= 1 for r in rows.values())


def test_hosts_far_below_the_rest_are_blocked(spark):
    """Where nearly all is good, a host with two good pages of three is not."""
    hosts = {f"h{h}.site{h}.org": 0.97 for h in range(40)} | {f"m{h}.mixed{h}.org": 0.6 for h in range(4)}
    urls, outcomes = [], []
    for host, rate in hosts.items():
        for n in range(200):
            outcomes.append((len(urls), int(n < 200 * rate)))
            urls.append(f"http://{host}/{n}")
    judged = url_reputation.judge_pages(pages(spark, urls), labels(spark, outcomes), rules=())
    verdicts = {(r.host, r.verdict) for r in judged.collect()}
    assert verdicts == {(h, "block" if h.startswith("m") else "allow") for h in hosts}


@pytest.mark.parametrize(
    ("host", "domain", "suffix"),
    [
        ("a.b.co.uk", "b.co.uk", "co.uk"), ("b.co.uk:8080", "b.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"),
        ("x.y.com", "y.com", "com"), ("localhost", "localhost", "localhost"), ("", "", ""),
        ("10.0.0.1:80", "10.0.0.1", ""), ("1.2.3.4.5", "4.5", "5"),
    ],
)
def test_domains_and_suffixes(spark, host, domain, suffix):
    row = spark.createDataFrame([(host,)], "h string").select(
        url_reputation.registered_domain(F.col("h")).alias("d")
    ).select("d", url_reputation.suffix(F.col("d")).alias("s")).first()
    assert (row.d, row.s) == (domain, suffix)


def test_query_equals_sql_where_hosts_differ(spark, tmp_path):
    """The registered query and its SQL on a table in which reputation decides."""
    rng = random.Random(8)
    rows, outcomes = [], []
    for n in range(3000):
        h = rng.randrange(30)
        host = f"h{h}.{'bad' if h % 5 == 0 else f'd{h % 7}'}.{rng.choice(['com', 'co.uk', 'net', 'org'])}"
        rows.append((n, rng.choice([f"https://{host}/{'fr' if n % 3 else 'de'}/{n}", None]) if n % 50 == 0 else f"https://{host}/x{n}"))
        if n % 2:
            outcomes.append((n, int(rng.random() < (0.2 if h % 5 == 0 else 0.9))))
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(outcomes, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    ours = contract.queries()["op5_url_filters"](spark, str(tmp_path)).toPandas()
    connection = duckdb.connect()
    for table in ("pages", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    theirs = connection.sql(contract.oracle_sql()["op5_url_filters"]).df()
    assert compare.differences(ours, theirs) == []
    learned = ours[ours.rule.isna()]
    assert 100 < (learned.verdict == "block").sum() < len(learned)


@pytest.mark.parametrize("hosts", [0, 10**6])
def test_the_join_gives_the_same_either_way(spark, monkeypatch, hosts):
    small = url_reputation.small_enough
    monkeypatch.setattr(url_reputation, "small_enough", lambda table: small(table, hosts))
    urls = ["http://hot.com/a"] * 300 + [f"http://h{n}.com/a" for n in range(30)]
    judged = url_reputation.judge_pages(pages(spark, urls), labels(spark, [(n, 0) for n in range(300)]))
    verdicts = {(r.host, r.verdict) for r in judged.collect()}
    assert ("hot.com", "block") in verdicts and judged.count() == 330


def test_empty_tables(spark):
    empty = pages(spark, ["a"]).limit(0)
    assert url_reputation.judge_pages(empty, labels(spark, [(1, 1)])).collect() == []
