import math
import random
import re

import pytest

from kinveil.llm import url_filter as uf


def brute(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url[url.index("://") + 3 :]
        k = re.search(r"[/?#]|$", rest).start()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), rest[:k])
        path = re.split(r"[?#]", rest[k:])[0]
    best = None
    for says, h, p in uf.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, says)
    return host, path, best


def test_urls_and_rules(spark):
    urls = [None, "", "no scheme", "http://", "http:///x", "http://A.É.Com", "http://a.com/", "http://com/", "http://xcom/", "http://a.com?x=/en/", "http://WWW.example.com/en/a?b#c", "http://m.example.com/en/", "http://www.example.com/EN/", "http://x.www.example.com/en/1", "http://example.com/en", "x://a.net/es/1", "x://net/fr/#f", "x://a.net#/es/", "a://b://c/d", "http://a.net/fr/?q=://", "http://u:p@h.com:80/x"]
    pages = spark.createDataFrame([(i, u, i % 2, "h") for i, u in enumerate(urls)], "page_id long, url string, bad int, a string")
    got = {r.page_id: r for r in uf.judge(pages.drop("a")).collect()}
    for i, u in enumerate(urls):
        host, path, best = brute(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best and best[0]), u
        assert best is None or got[i].verdict == best[1]


def test_reputation(spark):
    rows = [(f"http://bad.org/{i}", 1) for i in range(40)] + [(f"http://good{i % 9}.org/{i}", int(i % 10 == 0)) for i in range(300)]
    rows += [("http://new.bad.org/", None), ("http://one.org/", 1), (None, None)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, bad int")
    got = {r.url: r for r in uf.judge(pages).collect()}
    assert got["http://bad.org/1"].verdict == "block" and got["http://good1.org/1"].verdict == "allow"
    assert got["http://one.org/"].bound < got["http://bad.org/1"].bound  # one page says little
    assert got["http://new.bad.org/"].bound > got["http://good1.org/1"].bound  # its domain speaks for it
    none = uf.judge(pages.withColumn("bad", uf.F.lit(None).cast("int"))).select("verdict").distinct().collect()
    assert [r.verdict for r in none] == ["allow"]
    assert uf.judge(pages.limit(0)).count() == 0


def test_domains(spark):
    want = {"a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.com": ("y.com", "com"), "y.com:80": ("y.com", "com"), "u@y.com.": ("y.com", "com"), "com": ("com", "com"), "1.2.3.4": ("1.2.3.4", "1.2.3.4"), "3.4": ("3.4", "4"), "x.3.4": ("3.4", "4"), "[::1]:8": ("[::1]", "[::1]"), "": ("", ""), "m.t.example.net": ("t.example.net", "example.net")}
    df = spark.createDataFrame([(h,) for h in want], "host string")
    got = {r.host: (r.d, r.s) for r in df.select("host", *(c.alias(n) for c, n in zip(uf.levels(uf.F.col("host")), "ds", strict=True))).collect()}
    assert got == want


def posterior(rows):
    """host to bound, by loops over (host, domain, suffix, bad) of labelled pages."""
    hosts = {}
    for h, d, s, bad in rows:
        n, k = hosts.get((h, d, s), (0, 0))
        hosts[h, d, s] = (n + (bad is not None), k + (bad or 0))
    fold = lambda cut: {key: tuple(map(sum, zip(*(v for k, v in hosts.items() if cut(k) == key), strict=True))) for key in map(cut, hosts)}

    def shrink(sums, prior):
        some = [(n, k, prior(key)) for key, (n, k) in sums.items() if n > 1]
        over, under = sum((k - n * p) ** 2 - n * p * (1 - p) for n, k, p in some), sum(n * (n - 1) * p * (1 - p) for n, _, p in some)
        rho = over / under if under else 0
        w = min(max(1 / rho - 1, 1.0), 1000.0) if rho > 0 else 1000.0
        return {key: (k + prior(key) * w, n - k + (1 - prior(key)) * w) for key, (n, k) in sums.items()}

    mean = lambda ab: ab[0] / sum(ab)
    n, k = map(sum, zip(*hosts.values(), strict=True))
    top = shrink(fold(lambda x: x[2]), lambda _: (k + 0.1) / (n + 1))
    middle = shrink(fold(lambda x: x[1:]), lambda x: mean(top[x[1]]))
    low = shrink(hosts, lambda x: mean(middle[x[1:]]))
    return {x[0]: mean(ab) - 1.645 * (ab[0] * ab[1] / (sum(ab) ** 2 * (sum(ab) + 1))) ** 0.5 for x, ab in low.items()}


def test_posterior_equals_loops(spark):
    rng = random.Random(3)
    rows = []
    for s in ("com", "co.uk", "org"):
        for d in range(5):
            for h in range(4):
                rate = rng.random() ** 2
                rows += [(f"h{h}.d{d}.{s}", f"d{d}.{s}", s, rng.choice([None, int(rng.random() < rate), int(rng.random() < rate)])) for _ in range(rng.randrange(1, 30))]
    rows += [("3.4", "3.4", "4", 1), ("x.3.4", "3.4", "4", 0), ("1.2.3.4", "1.2.3.4", "1.2.3.4", 1)]
    pages = spark.createDataFrame([(i, f"http://{h}/{i}", bad) for i, (h, _, _, bad) in enumerate(rows)], "page_id long, url string, bad int")
    got, want = uf.judge(pages, rules=()).collect(), posterior(rows)
    assert len(got) == len(rows)
    for r in got:
        assert math.isclose(r.bound, want[r.host], rel_tol=1e-9) and r.verdict == ("block" if want[r.host] > 0.3 else "allow")


def test_clashing_columns_and_repeated_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/7", 1, "x", "p", 0.5), (1, "http://a.com/7", 1, "x", "p", 0.5), (2, None, 0, None, None, None)], "page_id long, url string, bad int, Host string, path string, bound double")
    got = uf.judge(pages)
    assert got.columns == ["page_id", "url", "bad", *uf.OUT] and got.count() == 3
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (8, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    both = uf.outcomes(pages, labels)
    assert both.columns == ["page_id", "url", "Host", "path", "bound", "bad"] and sorted(str(r.bad) for r in both.collect()) == ["1", "1", "None"]


def test_outcomes(spark):
    urls = {"http://a.com/en/7": 1, "http://a.com/en/8.html?x=7": 0, "http://a.com/9/#7": 1, "http://a.com/x10": None, "http://a.com/11": None, "http://a.com/99999999999999999999": None, None: None}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(7, 0, 0), (8, 1, 0), (9, 1, 1), (10, 0, 0), (12, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r.url: r.bad for r in uf.outcomes(pages, labels).collect()} == urls


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"create view {t} as select * from '/root/testdata/{sf}/{t}.parquet'")
    cur = con.execute(uf.OP6_SQL)
    names = [d[0] for d in cur.description]
    want = sorted(cur.fetchall(), key=str)
    got = uf.op6_url_filter(spark, f"/root/testdata/{sf}")
    assert got.columns == names and sorted((tuple(r) for r in got.collect()), key=str) == want
