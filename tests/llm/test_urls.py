"""URL filters: parsing and rules against a plain version, templates and purity on a small tree."""

import math
import re
from collections import Counter, defaultdict

from kitchenlens.llm import urls as uf


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def plain_rule(host, path):
    fits = [(h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


URLS = ["http://A.Example.ORG/es/1?x=1", "https://example.org/en/12#t", "https://sub.example.org/en/2/3", "http://x.com/fr/1", "http://x.com/de/1.html", "http://com/de/",
        "http://forg/x", "http://org", "http://x.org?y", "no url", None, "", "a://b://c/d", "http://É.com/fr/é", "http://x.com:80/fr/", "ftp://x.net", "http://x.com/fr\n/a", "://", "http:///a"]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)] + [(0, URLS[0], "z")], "page_id long, url string, host string")
    got = uf.judge_urls(pages).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = plain(URLS[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert uf.judge_urls(pages.limit(0)).count() == 0


def test_templates_learn_from_the_rules(spark):
    rules = [("block", "a.com", "/ads/"), ("allow", "a.com", "/news/")]
    rows = [f"http://a.com/{kind}/{i}" for kind in ("ads", "news") for i in range(60)] + [f"http://b.com/{kind}/{i}" for kind in ("ads", "news") for i in range(40)]
    rows += [f"http://b.com/page-{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}/x" for i in range(100)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = uf.judge_urls(pages, rules=rules).collect()
    assert {r.template for r in got if r.host == "a.com"} == {"/ads/{number}", "/news/{number}"}
    assert {r.verdict for r in got if r.host == "b.com" and r.path.startswith("/ads/")} == {"block"}
    assert {r.verdict for r in got if r.host == "b.com" and r.path.startswith("/news/")} == {"allow"}
    assert {r.template for r in got if r.path.startswith("/page-")} == {"/*/x"}
    assert all(0 <= r.purity <= 1 for r in got)


def shape(seg):
    stem = re.sub(r"\.[A-Za-z]{1,5}$", "", seg)
    if not stem:
        return ""
    if re.fullmatch(r"\d+", stem):
        return "{number}"
    if re.fullmatch(r"(?i)(?=.*\d)[0-9a-f]{8,}", stem):
        return "{hex}"
    if re.fullmatch(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", stem):
        return "{uuid}"
    return "{mixed}" if re.search(r"\d{4}", stem) or len(stem) > 40 else None


def plain_tree(rows, depth=0, leaf="", template=""):
    """(template, leaf) of each (segments, blocked, labelled) of one node, by recursion over the tree."""
    out, under = {}, defaultdict(list)
    for i, (segs, _, _) in rows:
        if len(segs) == depth:
            out[i] = (template, leaf)
    rows = [r for r in rows if len(r[1][0]) > depth]
    count, blocked, labelled = Counter(), Counter(), Counter()
    for _, (segs, b, m) in rows:
        if shape(segs[depth]) is None and depth < uf.MAX_DEPTH:
            count[segs[depth]] += 1
            blocked[segs[depth]] += b
            labelled[segs[depth]] += m
    mean = sum(count.values()) / max(1, len(count))
    kept = {x for x, n in count.items() if n >= mean * (uf.VARIABLE_ROWS if mean < uf.VARIABLE_ROWS else uf.LEAST_SHARE)}
    all_b, all_m, sides = sum(blocked[x] for x in kept), sum(labelled[x] for x in kept), {}
    for x in kept:
        b, m = blocked[x], labelled[x]
        if m and all_m - m:
            error = math.sqrt(all_b / all_m * (1 - all_b / all_m) * (1 / m + 1 / (all_m - m)))
            apart = b / m - (all_b - b) / (all_m - m)
            sides[x] = "{+}" if apart > uf.SIMILAR_Z * error else "{-}" if apart < -uf.SIMILAR_Z * error else "{=}"
    members = Counter(sides.values())
    for i, row in rows:
        x = row[0][depth]
        form = shape(x)
        label = form if form is not None else x if x in kept else "*"
        branch = sides[x] if x in sides and form is None and members[sides[x]] > 1 else label
        under[branch, label].append((i, row))
    merged = defaultdict(list)
    for (branch, label), found in under.items():
        merged[branch] += [(i, row, label) for i, row in found]
    for branch, found in merged.items():
        sub = plain_tree([(i, row) for i, row, _ in found], depth + 1, f"{leaf}/{branch}", None)
        for i, _, label in found:
            out[i] = (f"{template or ''}/{label}{sub[i][0] or ''}", sub[i][1])
    return out


def plain_verdicts(urls, rules):
    """Tree, merging and smoothing written out with dictionaries."""
    def rule(host, path):
        fits = [(len(h + p), v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1] if fits else None

    parts, hosts = [plain(u) for u in urls], defaultdict(list)
    verdict = [rule(h, p) for h, p in parts]
    for i, (host, path) in enumerate(parts):
        hosts[host].append((i, (re.sub(r"^/|/$", "", path).split("/"), int(verdict[i] == "block"), int(verdict[i] is not None))))
    place = {}
    for host, rows in hosts.items():
        place.update({i: (host, *found) for i, found in plain_tree(rows).items()})
    own, shared = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for i, v in enumerate(verdict):
        host, template, leaf = place[i]
        for box in (own[host, leaf], shared[template]):
            box[0] += v == "block"
            box[1] += v is not None
    overall = (sum(v == "block" for v in verdict) + 0.5) / (sum(v is not None for v in verdict) + 1)
    out = []
    for i, v in enumerate(verdict):
        host, template, leaf = place[i]
        prior = (shared[template][0] + uf.PRIOR_ROWS * overall) / (shared[template][1] + uf.PRIOR_ROWS)
        purity = (own[host, leaf][0] + uf.PRIOR_ROWS * prior) / (own[host, leaf][1] + uf.PRIOR_ROWS)
        out.append((v or ("block" if purity > 0.5 else "allow"), template, round(purity, 9)))
    return out


def test_whole_table_against_plain(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    extra = spark.createDataFrame([(10_000 + i, u) for i, u in enumerate(URLS)] + [(20_000 + i, f"https://a.example.com/{k}/x{i % 3}/{i}.html") for i in range(90) for k in ("fr", "de")],
                                  "page_id long, url string")
    pages = pages.unionByName(extra)
    rows = sorted(map(tuple, pages.collect()), key=str)
    want = sorted((i, *v) for (i, _), v in zip(rows, plain_verdicts([u for _, u in rows], uf.RULES)))
    got = sorted((r.page_id, r.verdict, r.template, round(r.purity, 9)) for r in uf.judge_urls(pages).collect())
    assert got == want


def test_verdicts_do_not_depend_on_the_size_of_the_host(spark):
    """Sections of four pages on a host are judged like sections of forty."""
    rules = [("block", h, "/de/") for h in ("a.com", "b.com", "c.com")] + [("allow", h, "/fr/") for h in ("a.com", "b.com", "c.com")]

    def verdicts(each):
        urls = [f"http://{h}/{k}/{i}" for h in ("a.com", "b.com", "c.com", "t.net") for k in ("fr", "de") for i in range(each)]
        pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        return {(r.host, r.path): (r.template, r.verdict) for r in uf.judge_urls(pages, rules=rules).collect()}

    small, large = verdicts(4), verdicts(40)
    assert {k: large[k] for k in small} == small
    assert small["t.net", "/de/1"] == ("/de/{number}", "block") and small["t.net", "/fr/1"] == ("/fr/{number}", "allow")


def test_siblings_are_those_of_one_parent(spark):
    """/forum/spam and /forum/ham keep their templates beside 200 other sections, and equal words elsewhere change nothing."""
    rules = [("block", "a.com", "/forum/spam/"), ("allow", "a.com", "/forum/ham/"), ("allow", "a.com", "/s")]
    urls = [f"http://a.com/forum/{kind}/{i}" for kind in ("spam", "ham") for i in range(40)]
    urls += [f"http://a.com/s{'abcdefghijklmnopqrst'[k // 10]}{'abcdefghij'[k % 10]}/{x}/{i}" for k in range(200) for i in range(10) for x in ("ham", "top")]
    urls += [f"http://b.com/forum/{kind}/{i}" for kind in ("spam", "ham") for i in range(3)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {(r.host, r.path): r for r in uf.judge_urls(pages, rules=rules).collect()}
    assert got["a.com", "/forum/spam/1"].template == "/forum/spam/{number}" and got["a.com", "/forum/ham/1"].template == "/forum/ham/{number}"
    assert got["a.com", "/forum/spam/1"].purity > 0.6 > 0.4 > got["a.com", "/forum/ham/1"].purity
    assert got["b.com", "/forum/spam/1"].verdict == "block" and got["b.com", "/forum/ham/1"].verdict == "allow"
    assert got["a.com", "/saa/top/3"].template == "/saa/top/{number}"
    rows = sorted((r.page_id, r.verdict, r.template, round(r.purity, 9)) for r in got.values())
    assert rows == sorted((i, *v) for i, v in enumerate(plain_verdicts(urls, rules)))


def test_similar_branches_are_merged_at_every_depth(spark):
    """Ten sections alike in their labels are one branch, so what lies below them is judged together."""
    rules = [("allow", "a.com", f"/{c}x/news/") for c in "abcdefghij"] + [("block", "a.com", f"/{c}x/ads/") for c in "abcdefghij"] + [("block", "a.com", "/bad/")]
    urls = [f"http://a.com/{c}x/{kind}/{k}{i}" for c in "abcdefghij" for kind in ("news", "ads") for k in ("", "q") for i in range(3)]
    urls += [f"http://a.com/bad/{kind}/{i}" for kind in ("news", "ads") for i in range(30)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    distinct = uf.with_templates(pages.select("page_id", *[c.alias(n) for c, n in zip(uf.host_and_path(uf.F.col("url")), ("host", "path"))])
                                 .withColumn("judged", uf._rule(rules, uf.F.col("host"), uf.F.col("path"))).withColumn("n", uf.F.lit(1)))
    leaves = {r.path: r.leaf for r in distinct.collect()}
    assert leaves["/ax/news/1"] == leaves["/jx/news/2"] == "/{=}/news/{number}" and leaves["/cx/ads/0"] == "/{=}/ads/{number}"
    assert leaves["/bad/news/1"].startswith("/bad/")
    rows = sorted((r.page_id, r.verdict, r.template, round(r.purity, 9)) for r in uf.judge_urls(pages, rules=rules).collect())
    assert rows == sorted((i, *v) for i, v in enumerate(plain_verdicts(urls, rules)))


def test_deep_paths(spark):
    """Segments below the tree's last level generalise by their form alone."""
    urls = ["http://a.com" + "/x" * k + "/7" for k in (1, 11, 12, 13, 400)] * 2 + ["http://a.com/" + "/" * 20]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in uf.judge_urls(pages).collect()}
    assert got[4].template == "/x" * uf.MAX_DEPTH + "/*" * (400 - uf.MAX_DEPTH) + "/{number}" and got[1].template == "/x" * 11 + "/{number}"
    assert [(r.verdict, r.template) for _, r in sorted(got.items())] == [v[:2] for v in plain_verdicts(urls, uf.RULES)]


def test_contract(spark):
    got = uf.op9_url_filter(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) | {"purity": "double"} == {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string", "template": "string", "purity": "double"}
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
