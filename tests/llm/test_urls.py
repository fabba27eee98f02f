import itertools
import math
import re

from pyspark.sql import functions as F

from basketry.llm import queries, url_rules

from .helpers import LARGE, MIDDLE, rows

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def split(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    if not m:
        return "", ""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def explicit(host, path):
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


def tokens(url):
    host, path = split(url)
    query = re.search(r"://[^?#]*\?([^#]*)", url or "", re.S)
    keys = [x.split("=")[0] for x in (query[1] if query else "").split("&")]
    return frozenset([f"host:{x}" for x in host.split(".") if x] + [f"path:{x}" for x in re.sub("[0-9]+", "#", path).split("/") if x] + [f"key:{x}" for x in keys if x])


def brute(urls, support, confidence):
    """Verdicts with every combination of tokens counted."""
    judged = [(u, *split(u), explicit(*split(u)), tokens(u)) for u in urls]
    baskets = [(t, r[2] if r else None) for _, _, _, r, t in judged if t]
    least = support * len(baskets)
    counts = {}
    for t, label in baskets:
        for n in range(1, len(t) + 1):
            for c in itertools.combinations(sorted(t), n):
                every, blocked = counts.get(c, (0, 0))
                counts[c] = (every + 1, blocked + (label == "block"))
    mined = [set(c) for c, (n, b) in counts.items() if b >= least and b >= 1 and b / n >= confidence]
    return [(h, p, r[0] + r[1] if r else None, r[2] if r else "block" if any(m <= t for m in mined) else "allow") for _, h, p, r, t in judged]


def test_against_brute_force(spark):
    pages = spark.read.parquet(f"{MIDDLE}/pages.parquet")
    for support, confidence in ((url_rules.SUPPORT * 10, 0.9), (0.02, 0.55)):
        got = url_rules.judge(pages, queries.URL_RULES, support=support, confidence=confidence).collect()
        urls = {r.page_id: r.url for r in pages.collect()}
        keys = sorted(urls)
        want = dict(zip(keys, brute([urls[k] for k in keys], support, confidence)))
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == want


def test_mined_rules_judge_other_urls(spark):
    urls = [f"http://spam.example.net/x/{k}" for k in range(40)] + ["http://spam.example.info/x/7", "http://fine.example.info/y/7"] + [f"http://s{k}.example.org/en/{k}" for k in range(20)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.url: (r.rule, r.verdict) for r in url_rules.judge(pages, queries.URL_RULES, support=0.1, confidence=0.9).join(pages, "page_id").collect()}
    assert got["http://spam.example.info/x/7"] == (None, "block")
    assert got["http://fine.example.info/y/7"] == (None, "allow")


def test_mined_rules_of_the_query_block_urls_without_a_rule(spark):
    pages = spark.read.parquet(f"{LARGE}/pages.parquet")
    got = queries.op9_url_rules(spark, LARGE).where("rule is null").collect()
    blocked = sum(r.verdict == "block" for r in got)
    assert 0 < blocked < 0.25 * len(got)  # neither a constant nor whatever no label speaks of
    rows = pages.select("url").withColumn("host", url_rules.host_of(F.col("url"))).withColumn("path", url_rules.path_of(F.col("url")))
    rows = rows.withColumn("label", url_rules.explicit(F.col("host"), F.col("path"), queries.URL_RULES, "verdict")) \
        .withColumn("tokens", url_rules.tokens(F.col("url"), F.col("host"), F.col("path")))
    held_out = F.crc32(F.col("url").cast("binary")) % 4 == 2
    mined = [set(r.antecedent) for r in url_rules.mine(rows.where(~held_out), among_labelled=True).collect()]
    hits = [r.label for r in rows.where(held_out & F.col("label").isNotNull()).collect() if any(m <= set(r.tokens) for m in mined)]
    assert len(hits) > 50 and hits.count("block") >= 0.95 * len(hits)


def test_rules_among_labelled_urls_by_brute_force(spark):
    pages = spark.read.parquet(f"{MIDDLE}/pages.parquet")
    urls = {r.page_id: r.url for r in pages.collect()}
    known = [(tokens(u), explicit(*split(u))) for u in urls.values()]
    labelled = [(t, r[2] == "block") for t, r in known if t and r]
    base, least = sum(b for _, b in labelled) / len(labelled), url_rules.SUPPORT * 10 * sum(bool(t) for t, _ in known)
    found = {}
    for c in {c for t, _ in labelled for n in range(1, len(t) + 1) for c in itertools.combinations(sorted(t), n)}:
        has = [(t, b) for t, b in labelled if set(c) <= t]
        n, k = len(has), sum(b for _, b in has)
        if k >= least and k / n >= 0.9:
            surprise = k * math.log(k / (n * base)) + ((n - k) * math.log((n - k) / (n * (1 - base))) if n > k else 0)
            found[c] = (k / n >= url_rules.LIFT * base, surprise, frozenset.intersection(*(t for t, _ in has)))
    bar = math.log(max(2, len(found))) + url_rules.MARGIN
    rules = [whole for lifts, surprise, whole in found.values() if lifts and surprise >= bar]
    want = {k: r[2] if (r := explicit(*split(u))) else "block" if any(w <= tokens(u) for w in rules) else "allow" for k, u in urls.items()}
    got = url_rules.judge(pages, queries.URL_RULES, support=url_rules.SUPPORT * 10, among_labelled=True).collect()
    assert rules and {r.page_id: r.verdict for r in got} == want
    assert rows(url_rules.judge(pages.limit(0), queries.URL_RULES, among_labelled=True)) == []
    nothing = spark.createDataFrame([(1, None), (2, "x://h.example.info/a")], "page_id long, url string")
    assert {r.verdict for r in url_rules.judge(nothing, queries.URL_RULES, among_labelled=True).collect()} == {"allow"}


def test_edge_cases(spark):
    urls = [None, "", "no scheme", "://", "HTTP://WWW.Example.NET", "a://b.NET/", "a://net/x?y#z", "a://xnet/", "x://h.example.net/en/1", "x://example.com/de", "x://É.org/fr/ü?k=1&k=2&=3",
            "a://b?c://net/", "a://u\nv.net/p\nq#r"]
    pages = spark.createDataFrame([(k % 4 or None, u, "clash", "clash") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = sorted(rows(url_rules.judge(pages, queries.URL_RULES).drop("mined")), key=str)
    want = sorted(((k % 4 or None, *w) for k, w in enumerate(brute(urls, url_rules.SUPPORT, 0.9))), key=str)
    assert got == want
    assert rows(url_rules.judge(pages.limit(0), queries.URL_RULES)) == []
