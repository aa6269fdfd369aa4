import math
import re

from pyspark.sql import functions as F

from pagelens.llm import url_filter as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = [(-len(h + p), {"block": 0, "allow": 1}[v], h + p, v) for h, p, v in U.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(fits)[2:] if fits else (None, None)


def shape(seg):
    m = re.match(r"^(.*?)(\.[A-Za-z]{1,5})?$", seg)
    stem, ext = m[1], (m[2] or "").lower()
    kind = "{n}" if re.fullmatch("[0-9]+", stem) else "{x}" if re.fullmatch(r"(?=.*[0-9])[0-9a-fA-F-]{8,}", stem) \
        else "{m}" if re.search("[0-9]", stem) else "{s}"
    return kind + ext


def brute(urls):
    """{url: (host, path, rule, verdict, template, examples)} by walking each host's tree."""
    seen = []
    for u in urls:
        h, p = parts(u)
        r, v = rule(h, p)
        segs = [s for s in p.split("/") if s]
        if len(segs) >= U.DEPTH:
            segs = segs[:U.DEPTH - 1] + ["/".join(segs[U.DEPTH - 1:])]
        seen.append([u, h, p, r, v, segs, ""])
    for level in range(U.DEPTH):
        nodes = {}
        for _, h, _, _, v, segs, t in seen:
            if level < len(segs):
                n = nodes.setdefault((h, t, segs[level]), [0, 0, 0])
                n[0] += 1
                n[1] += v is not None
                n[2] += v == "block"
        hosts = {}
        for x in seen:
            hosts[x[1]] = hosts.get(x[1], 0) + 1
        big = {k: n for k, n in nodes.items() if n[0] >= U.LEAST_URLS and n[0] >= hosts[k[0]] * U.LEAST_SHARE}
        name = {k: k[2] for k in big}
        for parent in {k[:2] for k in big}:
            sib = sorted((n[2] / n[1], k[2], n) for k, n in big.items() if k[:2] == parent and n[1] >= U.LEAST_EXAMPLES)
            groups = []
            for p, s, n in sib:
                if groups:
                    q, _, m = groups[-1][-1]
                    mean = (n[2] + m[2]) / (n[1] + m[1])
                    if p - q <= U.ALIKE * math.sqrt(mean * (1 - mean) * (1 / n[1] + 1 / m[1])):
                        groups[-1].append((p, s, n))
                        continue
                groups.append([(p, s, n)])
            for g in groups:
                for _, s, _ in g:
                    name[(*parent, s)] = "|".join(sorted(x[1] for x in g))
        for x in seen:
            if level < len(x[5]):
                x[6] += "/" + name.get((x[1], x[6], x[5][level]), shape(x[5][level]))
    prior = sum(x[4] == "block" for x in seen) / max(1, sum(x[4] is not None for x in seen))
    stat = {}
    for x in seen:
        s = stat.setdefault((x[1], x[6]), [0, 0])
        s[0] += x[4] is not None
        s[1] += x[4] == "block"
    out = {}
    for u, h, p, r, v, _, t in seen:
        e, b = stat[h, t]
        purity = (b + U.PSEUDO * prior) / (e + U.PSEUDO)
        own = "block" if e >= U.LEAST_EXAMPLES and purity >= U.PURITY else "allow"
        out[u] = (h, p, r, v or own, t, e)
    return out


def test_against_a_walk_over_each_tree(spark):
    urls = [r["url"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url").collect()]
    urls += [f"http://a.example.com/{lang}/{k}/{i}.html" for lang in ("de", "DE", "xx") for k in ("p", "q") for i in range(12)]
    urls += [f"http://b.example.net/en/x/{i:08x}/y/z/{i}" for i in range(20)] + [f"http://c.org/fr/{i}" for i in range(20)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"], r["template"], r["examples"]) for r in U.judge(df).collect()}
    want = brute(urls)
    assert {u for u in want if got[u] != want[u]} == set()


def test_a_pure_template_rejects_its_other_urls(spark):
    """Urls of example.com/de/ are blocked by rule; on a host where all of the wildcard's
    examples are blocked, a url beside them falls."""
    rules = (("h.org", "/a1/", "block"), ("h.org", "/a2/", "block"), ("k.org", "/", "allow"))
    urls = [f"http://h.org/a{i % 2 + 1}/{j}/{i}" for i in range(4) for j in "rs"] * 30 + ["http://h.org/a9/r/4"] + \
           [f"http://k.org/{i}" for i in range(10)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r["url"]: r["verdict"] for r in U.judge(df, rules=rules).collect()}
    assert got["http://h.org/a1/r/0"] == "block" and got["http://k.org/3"] == "allow"


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.Net/en/x", "x://net/", "x://net", "x://net?/", "a://b.net/c://d.com/de/",
            "http://deep.example.com/" + "/".join(map(str, range(3000))), "http://é.example.net/en/é", "x://\nnet/\n"]
    df = spark.createDataFrame([(u, "mine", 1) for u in urls * 2], "url string, host string, n long")
    out = U.judge(df)
    rows = out.collect()
    assert len(rows) == 2 * len(urls) and out.columns[:2] == ["url", "n"]
    for r in rows:
        h, p = parts(r["url"])
        assert (r["host"], r["path"]) == (h, p) and r["rule"] == rule(h, p)[0]
    assert U.judge(df.limit(0)).count() == 0
    assert U.judge(df, rules=()).agg(F.count("rule")).first()[0] == 0
