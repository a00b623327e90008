"""URL rules against a plain version, mined rules against counting."""

import itertools
import random
import re

from tidewater.llm import url_rules as U

PAGES, LABELS = "page_id long, url string, host string, VERDICT int", "doc_id long, quality int, toxic int, url string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S).group()
    path = re.match(r"[^?#]*", rest[len(host):], re.S).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def given(host, path):
    fits = [(len(r), r, v) for v, r in U.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "https://Example.ORG/es/1", "https://example.org/en/123?q=1", "https://example.org/en", "http://x.com/fr/", "http://com/de/a#b",
        "http://xcom/de/a", "http://a.b.example.org/en/1", "http://notexample.org/es/", "http://ÉX.com/DE/", "ftp://h.com:80/de/x", "http://h.net?x=/es/", "http://h.org", "http://a.com/de/\nx"]


def test_hosts_paths_and_given_rules(spark):
    rows = [(i, u, "clash", 1) for i, u in enumerate(URLS)] + [(None, URLS[4], None, None), (4, URLS[4], "clash", 1)]
    out = U.judge_urls(spark.createDataFrame(rows, PAGES), spark.createDataFrame([], LABELS)).collect()
    got = sorted((str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in out)
    want = sorted((str(i), *split(u), *((rule, verdict) if (r := given(*split(u))) and (rule := r[0]) and (verdict := r[1]) else (None, "allow"))) for i, u, *_ in rows)
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert U.judge_urls(spark.createDataFrame([], PAGES), spark.createDataFrame([], LABELS)).collect() == []


def test_mined_rules_against_counting(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        host, lang, query = rng.choice(["good.example.net", "spam.example.net", "mixed.example.net"]), rng.choice(["en", "it"]), rng.choice(["", "?ref=x", "?p=1&ref=y"])
        rows.append((i, f"http://{host}/{lang}/{rng.randint(1, 999)}{query}", "x", 1))
        bad = host.startswith("spam") and rng.random() < 0.9 or host.startswith("mixed") and lang == "it" and rng.random() < 0.8 or rng.random() < 0.05
        if i % 3:
            labels.append((i, int(not bad), 0, "x"))
    labels += [(None, 0, 0, "x"), (0, None, None, "x"), (1, 1, 1, "x"), (1, 1, 1, "x")]
    pages = spark.createDataFrame(rows, PAGES)
    mining = dict(min_support=0.05, min_count=8, min_confidence=0.6, min_lift=1.5)
    out = {r.page_id: r for r in U.judge_urls(pages, spark.createDataFrame(labels, LABELS), rules=((U.ALLOW, "good.example.net/en/"),), **mining).collect()}
    url = pages.select("page_id", "url", U.host_of(pages.url).alias("h"), U.path_of(pages.url).alias("p"))
    tokens = {r.page_id: frozenset(r.t) for r in url.select("page_id", U.url_tokens(url.url, url.h, url.p).alias("t")).collect()}
    bad = {}
    for i, q, t, _ in labels:
        if i is not None and (q is not None or t is not None):
            bad[i] = bad.get(i, False) or q == 0 or t == 1
    n, base = len(bad), sum(bad.values()) / len(bad)
    seen, hits = {}, {}
    for i, b in bad.items():
        for k in range(1, len(tokens[i]) + 1):
            for combo in itertools.combinations(sorted(tokens[i]), k):
                seen[combo] = seen.get(combo, 0) + 1
                hits[combo] = hits.get(combo, 0) + b
    rules = {c: hits[c] / seen[c] for c in seen if hits[c] >= max(0.05 * n, 8) and hits[c] / seen[c] >= 0.6 and hits[c] / seen[c] / base >= 1.5}
    assert rules
    for i, t in tokens.items():
        best = max((v for c, v in rules.items() if t.issuperset(c)), default=None)
        ruled = rows[i][1].startswith("http://good.example.net/en/")
        assert out[i].verdict == ("allow" if ruled or best is None else "block")
        assert ruled or (out[i].confidence is None) == (best is None) and (best is None or abs(out[i].confidence - best) < 1e-9)


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.net/b", "x", 1)], PAGES)
    plan = U.judge_urls(pages, spark.createDataFrame([(1, 0, 0, "x")], LABELS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
