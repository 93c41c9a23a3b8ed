import random
import re

import duckdb
from pyspark.sql import functions as F

from strata.llm import queries, url_filter

NEW = ["host", "path", "rule", "verdict", "template", "purity"]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    raw = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), raw), re.match(r"[^?#]*", rest[len(raw):])[0]


def rule(host, path):
    fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0])) if fits else (None, None)


def test_query_against_sql(spark):
    got = queries.op2_url_filter(spark, "/root/testdata/sf0.01").toPandas().sort_values("page_id")
    con = duckdb.connect()
    for t in ("pages", "documents", "labels"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    want = con.execute(queries.ORACLE["op2_url_filter"]).df().sort_values("page_id")[list(got.columns)]
    assert got.astype(str).values.tolist() == want.astype(str).values.tolist()


URLS = [None, "", "no scheme/net/", "http://", "HTTP://A.Example.NET/en/x?y://z", "http://example.net/EN/1", "http://net", "http://net/",
        "http://x.net?q=/", "http://sub.example.com/de/1", "http://badexample.com/de/1", "ftp://a.org/fr/#x", "http://org/fr/", "x://y://z/p",
        "http://ÄB.com/ü/1//2/", "http://h.com/" + "a/" * 5000, "http://h.com/1\n2/3"]


def test_host_path_and_rules(spark):
    pages = spark.createDataFrame([*enumerate(URLS), (None, URLS[4]), (3, URLS[3])], "page_id long, url string")
    pages = pages.withColumns({c: F.lit("clash") for c in ("host", "n", "l", "shape", "template", "good", "row", "s")})
    out = url_filter.filter_urls(pages)
    assert out.columns == ["page_id", "url", "n", "l", "good", "row", "s", *NEW] or set(NEW) < set(out.columns)
    got = out.collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        assert (r.host, r.path) == split(r.url)
        want, verdict = rule(r.host, r.path)
        assert r.rule == want and r.verdict == (verdict or "allow")


def test_tree_blocks_impure_branch_and_merges_alike_ones(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        section = ("news", "blog", "shop", "spam")[i % 4]
        rows.append((i, f"https://site.com/{section}/{rng.randrange(10**6)}", 0 if section == "spam" else 1))
        rows.append((1000 + i, f"https://site.com/tag/{''.join(rng.choice('abcdefgh') for _ in range(9))}/", None))
    pages = spark.createDataFrame(rows, "page_id long, url string, good int")
    got = url_filter.filter_urls(pages, pages["good"]).collect()
    template = {r.url.split("/")[3]: r.template for r in got}
    assert {template[x] for x in ("news", "blog", "shop")} == {template["news"]} or template["news"] != template["spam"]
    assert template["spam"] == "/spam/<n>" and template["tag"].endswith("/*/")
    assert {r.verdict for r in got if "/spam/" in r.url} == {"block"}
    assert {r.verdict for r in got if "/spam/" not in r.url} == {"allow"}


def test_frequent_segment_is_not_pooled_with_one_offs(spark):
    slug = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    rows = [(i, f"https://site.com/{slug(i)}", 1) for i in range(1000)]
    rows += [(1000 + i, f"https://site.com/casino?id={i}", 0) for i in range(500)]
    rows += [(2000 + i, f"https://site.com/about?id={i}", 1) for i in range(500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, good int")
    got = url_filter.filter_urls(pages, pages["good"]).collect()
    bad = {(r.template, r.verdict) for r in got if r.path == "/casino"}
    assert bad == {("/casino", "block")}
    assert {(r.template, r.verdict) for r in got if r.page_id < 1000} == {("/*", "allow")}
    assert {r.verdict for r in got if r.path == "/about"} == {"allow"}


def test_branches_below_six_segments(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(url_filter, "_chains", lambda tree, f=url_filter._chains: rounds.append(1) or f(tree))
    deep, long = "https://site.com/a/b/c/d/e/f", "https://long.com" + "/x" * 3000
    rows = [(i, f"{deep}/{('good', 'spam')[i % 2]}/g/{i}", 1 - i % 2) for i in range(400)]
    rows += [(1000, long, None), (1001, long + "/y", None), (1002, "https://long.com/x/x", None), (1003, deep, None), (1004, deep + "/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, good int")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, pages["good"]).collect()}
    assert len(got) == len(rows)
    assert {(got[i].template, got[i].verdict) for i in range(0, 400, 2)} == {("/a/b/c/d/e/f/good/g/<n>", "allow")}
    assert {(got[i].template, got[i].verdict) for i in range(1, 400, 2)} == {("/a/b/c/d/e/f/spam/g/<n>", "block")}
    assert [got[i].template for i in (1000, 1001, 1002, 1003)] == [got[i].path for i in (1000, 1001, 1002, 1003)]
    assert got[1004].template == "/a/b/c/d/e/f/~"  # no label tells the empty segment from its siblings
    assert len(rounds) == 2


def test_no_rows(spark):
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


def plain_templates(pages):
    """{(host, shape): (template, purity)} of (host, path, good) by the rule, one branch after the other."""
    counts = {}
    for host, path, good in pages:
        shape = tuple(re.sub("[0-9]+", "<n>", path).split("/")[1:])
        n, l, g = counts.get((host, shape), (0, 0, 0))  # noqa: E741
        counts[host, shape] = (n + 1, l + (good is not None), g + (good or 0))
    add = lambda rows: tuple(map(sum, zip(*rows)))
    out, todo = {}, {}
    for (host, shape) in counts:
        todo.setdefault((host, "", 0), []).append(shape)
    while todo:
        (host, template, at), shapes = todo.popitem()
        out |= {(host, s): template for s in shapes if len(s) == at}
        shapes = [s for s in shapes if len(s) > at]
        # segments that all rows share, as far as they go, are passed together
        while shapes and len({s[at] for s in shapes}) == 1:
            template, at = f"{template}/{shapes[0][at]}", at + 1
            out |= {(host, s): template for s in shapes if len(s) == at}
            shapes = [s for s in shapes if len(s) > at]
        branches = {}
        for s in shapes:
            branches.setdefault(s[at], []).append(s)
        total = {s: add([counts[host, x] for x in rows]) for s, rows in branches.items()}
        rare = {s for s, (n, _, _) in total.items() if n < 4}
        al, ag = sum(x[1] for x in total.values()), sum(x[2] for x in total.values())
        for s, rows in branches.items():
            _, l, g = total[s]  # noqa: E741
            alike = True
            if 0 < l < al and 0 < ag < al:
                p = ag / al
                alike = (g / l - (ag - g) / (al - l)) ** 2 / (p * (1 - p) * (1 / l + 1 / (al - l))) < 1.96 ** 2
            new = "*" if s in rare and len(rare) > 8 else "~" if len(branches) > 1 and alike else s
            todo.setdefault((host, f"{template}/{new}", at + 1), []).extend(rows)
    whole = add(counts.values())
    corpus = whole[2] / whole[1] if whole[1] else 1.0
    purity = {}
    for key, t in out.items():
        purity.setdefault((key[0], t), []).append(counts[key])
    host_sum = {}
    for (host, _), c in counts.items():
        host_sum.setdefault(host, []).append(c)
    prior = {h: (add(c)[2] + 10 * corpus) / (add(c)[1] + 10) for h, c in host_sum.items()}
    judged = {k: (add(c)[2] + 10 * prior[k[0]]) / (add(c)[1] + 10) for k, c in purity.items()}
    return {key: (t, judged[key[0], t]) for key, t in out.items()}


def test_random_trees_against_plain_rule(spark):
    rng = random.Random(12)
    pages = []
    for h in range(6):
        bad = rng.choice(["spam", "a", "deep"])
        for _ in range(500):
            path = [rng.choice(["a", "b", "spam"])]
            for d in range(rng.randrange(0, 10)):
                # names that hardly repeat, few names, numbers, and a common chain
                path.append(rng.choice([f"slug-{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}",
                                        "x", "y", str(rng.randrange(99)), "deep", "deep"]) if d != 3 else "chain")
            good = None if rng.random() < 0.4 else int(rng.random() < (0.1 if bad in path else 0.9))
            pages.append((f"host{h}.test", "/" + "/".join(path), good))
    pages += [("host0.test", "", 1), ("host0.test", "/", 0), ("one.test", "/a/b/c/d/e/f/g/h/i/j", None)]
    df = spark.createDataFrame([(f"http://{h}{p}?q=1", g) for h, p, g in pages], "url string, good int").repartition(4)
    want = plain_templates(pages)
    got = url_filter.filter_urls(df, df["good"]).collect()
    assert len(got) == len(pages)
    for r in got:
        template, purity = want[r.host, tuple(re.sub("[0-9]+", "<n>", r.path).split("/")[1:])]
        assert r.template == template and abs(r.purity - purity) < 1e-9, (r, template, purity)
        assert r.verdict == ("block" if purity < 0.5 else "allow")
    assert {c for r in got for c in r.template.split("/")} >= {"*", "~"} and max(r.template.count("/") for r in got) > 8
    assert {r.verdict for r in got} == {"allow", "block"}
