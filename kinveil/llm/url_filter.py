"""URL filters by empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are summed by host. A host's bad rate has a beta prior centred on
its registered domain's estimate, the domain's prior is centred on its suffix's, the suffix's on the
rate of all pages; the weight of each prior (in pages) is fitted by moments of the beta-binomial over
all children of a level, between MIN_WEIGHT and MAX_WEIGHT. A page is blocked when the lower posterior
bound of its host's bad rate (mean less z standard deviations) is above `limit`. Explicit rules come
before that; the longest that fits a url decides.

All of it is DataFrame aggregation: sums combine before the shuffle, so a host with a third of all
pages is one row after it, and the join back to pages is one that AQE can split or broadcast by size.
The rate of all pages and the three weights are single numbers; the driver reads and passes them on.

Edge cases: a null url, or one without ://, has empty host and path, fits no rule and is judged as the
host "" among the others; pages without an outcome only get a verdict; no outcomes at all allow every
page; a repeated page counts as often as it stands there, and comes back as often; user names, ports and
a last dot say nothing of a host's domain; hosts of one label, addresses of numbers and hosts that are
a suffix are their own domain and suffix; other columns pass through, but for those that have an
output's name, which the output replaces. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinveil.llm._text import replaced
from kinveil.operators.staging import stage

#: Fixed values: (verdict, host, start of path) of the rules op6 is asked for.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MIN_WEIGHT, MAX_WEIGHT = 1.0, 1000.0
#: What one page beforehand is taken to say of all pages.
START_RATE = 0.1
#: Suffixes of more than one label under which names are registered, after the public
#: suffix list (a choice of it; pass the whole list as `suffixes` where it is at hand), and the three
#: under which the tables put their sites.
SUFFIXES = (
    "example.com", "example.net", "example.org",
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "nhs.uk", "org.uk", "plc.uk", "sch.uk",
    "com.au", "edu.au", "gov.au", "id.au", "net.au", "org.au",
    "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz",
    "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp",
    "ac.kr", "co.kr", "go.kr", "or.kr",
    "com.br", "edu.br", "gov.br", "net.br", "org.br",
    "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn",
    "ac.in", "co.in", "gov.in", "net.in", "org.in",
    "ac.za", "co.za", "gov.za", "org.za",
    "ac.il", "co.il", "org.il",
    "com.ar", "com.hk", "com.mx", "com.my", "com.ph", "com.pl", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn",
    "ac.id", "co.id", "go.id", "or.id", "ac.th", "co.th", "go.th",
)
OUT = ("host", "path", "rule", "verdict", "bound")


def parsed(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """pages with `host` and `path`."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    upto = lambda text, *signs: upto(F.substring_index(text, signs[0], 1), *signs[1:]) if signs else text
    raw = upto(rest, "/", "?", "#")
    path = upto(F.substring(rest, F.length(raw) + 1, F.length(rest)), "?", "#")
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select(*replaced(pages.columns, ("host", "path")), host.alias("host"), path.alias("path"))


def ruled(rules=RULES) -> tuple[Column, Column]:
    """(rule's text, rule's verdict) by the longest rule that fits host and path; null without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, at, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == at) | F.col("host").endswith("." + at)) & F.col("path").startswith(start)
        text, verdict = F.when(fits, at + start).otherwise(text), F.when(fits, says).otherwise(verdict)
    return text, verdict


def levels(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host. The suffix is the longest of `suffixes` that the host ends
    with, else its last label; the domain has one label more."""
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$|\.$", "")
    labels = F.size(F.split(name, r"\."))
    n = F.lit(1)
    for k in sorted({x.count(".") + 1 for x in suffixes}):
        n = F.when(
            F.substring_index(name, ".", -k).isin([x for x in suffixes if x.count(".") + 1 == k]), k
        ).otherwise(n)
    own = name.rlike(r"^([0-9]+(\.[0-9]+){3}|\[.*)$") | (labels <= n)
    last = lambda k: F.array_join(F.slice(F.split(name, r"\."), labels - k + 1, k), ".")
    return F.when(own, name).otherwise(last(n + 1)), F.when(own, name).otherwise(last(n))


def _weight(children: DataFrame) -> float:
    """The prior's weight, from children (n, bad, prior). Over children with n > 1,
    E[(bad - n p)^2] = n p (1 - p) (1 + (n - 1) rho), and the weight is 1 / rho - 1."""
    n, bad, p = F.col("n"), F.col("bad"), F.col("prior")
    spread = F.sum((bad - n * p) * (bad - n * p) - n * p * (1 - p))
    scale = F.sum(n * (n - 1) * p * (1 - p))
    r = children.where("n > 1").agg(spread.alias("spread"), scale.alias("scale")).first()
    rho = r.spread / r.scale if r.scale else 0.0
    return min(max(1 / rho - 1, MIN_WEIGHT), MAX_WEIGHT) if rho > 0 else MAX_WEIGHT


def _shrunk(children: DataFrame) -> DataFrame:
    """children (.., n, bad, prior) with posterior a and b."""
    w = F.lit(float(_weight(children)))
    a = F.col("bad") + F.col("prior") * w
    return children.withColumn("a", a).withColumn(
        "b", F.col("n") - F.col("bad") + (1 - F.col("prior")) * w
    ).drop("prior")


def reputation(pages: DataFrame, bad_col: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """host, n, bad, a, b: every host's labelled pages and posterior, one row a host; pages: host, and
    bad_col 0/1 or null."""
    domain, suffix = levels(F.col("host"), suffixes)
    hosts = pages.groupBy("host").agg(
        F.count(bad_col).alias("n"), F.coalesce(F.sum(bad_col), F.lit(0)).cast("long").alias("bad")
    )
    # One row a host, written: every level below reads these sums, none the pages again.
    hosts = stage(hosts.withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    sums = lambda *key: hosts.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    all_ = hosts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    ).first()
    mean = (F.col("a") / (F.col("a") + F.col("b"))).alias("prior")
    top = _shrunk(sums("suffix").withColumn("prior", F.lit((all_.bad + START_RATE) / (all_.n + 1))))
    # A domain may be a host's own suffix and lie under another: both name it.
    middle = _shrunk(sums("domain", "suffix").join(top.select("suffix", mean), "suffix"))
    return _shrunk(
        hosts.join(middle.select("domain", "suffix", mean), ["domain", "suffix"])
    ).select("host", "n", "bad", "a", "b")


def judge(
    pages: DataFrame,
    bad_col: str = "bad",
    url_col: str = "url",
    rules=RULES,
    limit: float = 0.3,
    z: float = 1.645,
    suffixes: tuple[str, ...] = SUFFIXES,
) -> DataFrame:
    """pages with `host`, `path`, `rule`, `verdict`, and `bound`, the lower posterior bound of the bad rate."""
    others = replaced(pages.columns, OUT)
    work = pages.select(*others, F.col(url_col).alias("__u_url"), F.col(bad_col).alias("__u_bad"))
    work = parsed(work, "__u_url")
    a, b = F.col("a"), F.col("b")
    bound = a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    known = reputation(work.select("host", "__u_bad"), "__u_bad", suffixes).select("host", bound.alias("bound"))
    rule, says = ruled(rules)
    out = work.join(known, "host", "left").withColumn("rule", rule)
    out = out.withColumn("verdict", F.coalesce(says, F.when(F.col("bound") > limit, "block").otherwise("allow")))
    return out.select(*others, *OUT)


def outcomes(pages: DataFrame, labels: DataFrame, url_col: str = "url", out: str = "bad") -> DataFrame:
    """pages with `bad`: 1 where the document that the page shows is labelled toxic or of no quality, 0 where
    it is labelled otherwise, null where it has no label. A page shows the document whose number ends its
    path; of several labels of a document the worst counts."""
    worst = labels.groupBy(F.col("doc_id").cast("long").alias("__u_doc")).agg(
        F.max(
            F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
                F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0
            )
        ).alias("__u_bad")
    )
    number = F.expr("try_cast(nullif(regexp_extract(path, '/([0-9]+)([.]html?)?/?$', 1), '') as bigint)")
    others = replaced(pages.columns, (out,))
    work = parsed(
        pages.select(*(F.col(c).alias(f"__u_{k}") for k, c in enumerate(others)), F.col(url_col).alias("__u_url")),
        "__u_url",
    )
    both = work.withColumn("__u_doc", number).join(worst, "__u_doc", "left")
    return both.select(*(F.col(f"__u_{k}").alias(c) for k, c in enumerate(others)), F.col("__u_bad").alias(out))


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(outcomes(pages, labels)).select(
        "page_id", "host", "path", "rule", "verdict", F.round("bound", 6).alias("bound")
    )


def _sql() -> str:
    """The same in SQL; labels and suffixes as above."""
    few = ", ".join(f"'{x}'" for x in SUFFIXES)
    fits = [
        f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h + p}'"
        for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    ]
    says = " ".join(f"when '{h + p}' then '{v}'" for v, h, p in RULES)
    weight = lambda t: f"""(select coalesce(case when x > 0 then least(greatest(1 / x - 1, {MIN_WEIGHT}), {MAX_WEIGHT}) end, {MAX_WEIGHT}) from
  (select sum((bad - n * p) * (bad - n * p) - n * p * (1 - p)) / nullif(sum(n * (n - 1) * p * (1 - p)), 0) x from {t} where n > 1))"""  # noqa: E731
    return rf"""
with r as (select page_id, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
h as (select page_id, regexp_extract(rest, '^[^/?#]*') raw, rest from r),
u as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
      regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') path from h),
l as (select doc_id, max(case when quality = 0 or toxic = 1 then 1 when quality is not null or toxic is not null then 0 end) bad from labels group by 1),
o as (select u.*, l.bad from u left join l on l.doc_id = try_cast(regexp_extract(path, '/([0-9]+)([.]html?)?/?$', 1) as bigint)),
s as (select host, count(bad) n, coalesce(sum(bad), 0) bad, string_split(regexp_replace(host, '^.*@|:[0-9]*$|[.]$', '', 'g'), '.') x from o group by host),
k as (select *, case when array_to_string(x[-2:], '.') in ({few}) then 2 else 1 end m, array_to_string(x, '.') name from s),
w as (select *, len(x) <= m or regexp_matches(name, '^([0-9]+([.][0-9]+){{3}}|\[.*)$') own from k),
hosts as (select host, n, bad, case when own then name else array_to_string(x[-(m + 1):], '.') end dom,
          case when own then name else array_to_string(x[-m:], '.') end suf from w),
root as (select (sum(bad) + {START_RATE}) / (sum(n) + 1) p from hosts),
t0 as (select suf, sum(n) n, sum(bad) bad, any_value(p) p from hosts, root group by suf),
t1 as (select suf, (bad + p * w) / (bad + p * w + (n - bad + (1 - p) * w)) p from t0, (select {weight("t0")} w)),
m0 as (select dom, suf, sum(n) n, sum(bad) bad, any_value(p) p from hosts join t1 using (suf) group by dom, suf),
m1 as (select dom, suf, (bad + p * w) / (bad + p * w + (n - bad + (1 - p) * w)) p from m0, (select {weight("m0")} w)),
h0 as (select host, n, bad, p from hosts join m1 using (dom, suf)),
h1 as (select host, bad + p * w a, n - bad + (1 - p) * w b from h0, (select {weight("h0")} w)),
v as (select host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) bound from h1),
q as (select page_id, host, path, case {" ".join(fits)} end rule, bound from u join v using (host))
select page_id, host, path, rule, coalesce(case rule {says} end, case when bound > 0.3 then 'block' else 'allow' end) verdict, round(bound, 6) bound from q
"""


OP6_SQL = _sql()
