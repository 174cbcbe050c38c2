from __future__ import annotations

import random

import duckdb
import numpy as np
from conftest import SF_SMALL

from eventide.llm import queries, url_filter
from eventide.llm.common import table
from pyspark.sql import functions as F

RULES = queries.URL_RULES


def brute(url, rules, otherwise="allow"):
    at = -1 if url is None else url.find("://")
    rest = "" if at < 0 else url[at + 3:]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, otherwise
    best = max(f[:3] for f in fits)
    return host, path, best[2], "block" if (*best, "block") in fits else "allow"


def frame(spark, urls):
    return spark.createDataFrame([(k, u, "h", "p", 1, "x") for k, u in enumerate(urls)],
                                 "page_id long, url string, host string, path string, hit int, "
                                 "rule string")


def got(spark, urls, rules, **kw):
    listed = spark.createDataFrame(rules, "verdict string, host string, path string")
    out = url_filter.verdicts(frame(spark, urls), listed, **kw)
    return sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect())


def want(urls, rules, **kw):
    return [(k, *brute(u, rules, **kw)) for k, u in enumerate(urls)]


ODD = [None, "", "no scheme.com/en/", "http://", "://com/", "http://com/", "http://COM/x", "http://com",
       "http://example.com/en/1", "http://a.b.Example.com/en/?q=://www.example.com/en/",
       "http://www.example.com/en/", "http://x.www.example.com/en/#a", "http://wwww.example.com/en/1",
       "http://notexample.com/en/", "http://example.com/EN/", "http://a.net/es/", "http://net/fr/x",
       "http://net/de/", "http://a..net/es/", "http://.net/fr/", "http://net./fr/", "http://net:80/fr/",
       "http://é.com/ü/", "http://a.net?x=/es/", "http://com/" + "y" * 200000, "x" * 100000 + "://a.com/",
       "http://" + "a." * 20000 + "net/es/", "http://com/", "http://com/"]


def test_rules_match_brute_force(spark):
    assert got(spark, ODD, RULES) == want(ODD, RULES)
    assert got(spark, ODD, RULES, otherwise="block") == want(ODD, RULES, otherwise="block")


def test_given_table_matches_sql(spark):
    out = queries.op13_url_cascade(spark, SF_SMALL)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    sql = con.sql(queries.SQL["op13_url_cascade"]).fetchall()
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, sql))
    pages = table(spark, SF_SMALL, "pages").collect()
    assert [tuple(r) for r in out.orderBy("page_id").collect()] == [
        (r.page_id, *brute(r.url, RULES)) for r in sorted(pages, key=lambda r: r.page_id)]


def test_no_rows_and_no_rules(spark):
    assert got(spark, [], RULES) == []
    assert got(spark, ODD[:6], []) == want(ODD[:6], [])
    assert got(spark, ODD[:8], [("block", None, None), ("allow", "com", "")]) == want(
        ODD[:8], [("block", "", ""), ("allow", "com", "")])


def test_many_rules_in_parts(spark):
    r = random.Random(5)
    hosts = [f"h{k}.{r.choice(['com', 'net', 'org'])}" for k in range(400)]
    rules = [(r.choice(["allow", "block"]), h, r.choice(["/", "/a/", "/a/b"]))
             for h in hosts for _ in range(2)] + [("block", "h1.com", "/"), ("allow", "h1.com", "/")]
    urls = [f"https://{r.choice(['', 'www.', 'x.y.'])}{r.choice(hosts)}"
            f"{r.choice(['', '/', '/a/', '/a/bc', '/b', '/a'])}" for _ in range(3000)]
    assert got(spark, urls, rules) == want(urls, rules)
    assert got(spark, urls, rules, filter_bytes=256) == want(urls, rules)      # several parts


def test_cascade_is_exact_on_its_universe(spark):
    keys = spark.range(4000).select(*url_filter._hashes(F.col("id").cast("string")), "id")
    listed = keys.where("id % 3 = 0").select("h1", "h2")
    cascade = url_filter.build_cascade(listed, keys.select("h1", "h2"))
    rows = keys.orderBy("id").toPandas()
    has = cascade.has(rows.h1.to_numpy().view(np.uint64), rows.h2.to_numpy().view(np.uint64))
    assert (has == (rows.id.to_numpy() % 3 == 0)).all()
    assert len(cascade.levels) > 4 and cascade.size_bytes < 4 * 4000 // 3
