import itertools
import random
import re
from collections import Counter, defaultdict

from txrisk.llm import url_filter

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def lower(s):
    return s.translate({c: c + 32 for c in range(65, 91)})


def parse(url):
    if "://" not in (url or ""):
        return "", "", "", ""
    scheme, rest = url.split("://", 1)
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    return scheme, lower(host), path, rest[len(host) + len(path):]


def given(host, path):
    fits = [(len(name), name, verdict) for name, verdict in RULES for h, p in [name.split("/", 1)]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def tokens(url):
    scheme, host, path, tail = parse(url)
    labels, parts = host.split("."), lower(path).split("/")
    word = lambda s: re.split("[^a-z0-9\x80-\U0010ffff]+", s)
    ext = re.search(r"\.([^.]*)$", parts[-1])
    query = re.match(r"\?([^#]*)", lower(tail))
    fragment = re.search("(?s)#(.*)", lower(tail))
    out = {("scheme", lower(scheme)), ("tld", labels[-1]), ("host", host), *[("word", w) for w in word(".".join(labels[:-1]))],
           *[("dir", d) for d in parts[:-1]], ("ext", ext[1] if ext else ""), ("fragment", fragment[1] if fragment else ""),
           *[("leaf", w) for w in word(re.sub("[0-9]+", "0", re.sub(r"\.[^.]*$", "", parts[-1])))],
           *[("query", p.split("=")[0]) for p in (query[1] if query else "").split("&")]}
    if len(labels) > 1:
        out.add(("domain", ".".join(labels[-2:])))
    return frozenset(f"{k}:{v}" for k, v in out if v)


def brute(urls):
    """Verdicts of the contract's rules and of rules found by trying all sets."""
    rows = [(*parse(u)[1:3], *given(*parse(u)[1:3]), tokens(u)) for u in urls]
    labelled = [(t, v) for _, _, rule, v, t in rows if rule]
    n = len(labelled)
    where = defaultdict(list)
    for i, (t, _) in enumerate(labelled):
        for x in t:
            where[x].append(i)
    classes = defaultdict(list)
    for x, at in where.items():
        if len(at) < n and len(at) >= url_filter.MIN_SUPPORT * n:
            classes[tuple(at)].append(x)
    stands = {x: min(xs, key=lambda x: (url_filter.KINDS.index(x.split(":")[0]), x)) for xs in classes.values() for x in xs}
    rows = [(*r[:4], {stands[x] for x in r[4] if x in stands}) for r in rows]
    labelled = [(t, v) for _, _, rule, v, t in rows if rule]
    every, of = Counter(), Counter()
    for t, v in labelled:
        mine = sorted(t)
        for k in range(1, len(mine) + 1):
            for s in itertools.combinations(mine, k):
                every[s] += 1
                of[s, v] += 1
    enough = {(s, v): c for (s, v), c in of.items() if c >= url_filter.MIN_SUPPORT * n}
    share = Counter(v for _, v in labelled)
    good = {}
    for (s, v), c in enough.items():
        conf = c / every[s]
        less = [s[:i] + s[i + 1:] for i in range(len(s))] if len(s) > 1 else []
        if conf >= url_filter.MIN_CONFIDENCE and conf > share[v] / n \
                and not any(enough.get((x, v), 0) / every[x] >= conf for x in less):
            good[s, v] = (conf, c)
    out = []
    for host, path, rule, verdict, t in rows:
        if not rule:
            fits = [(conf, c, list(s), v) for (s, v), (conf, c) in good.items() if set(s) <= t]
            verdict = max(fits)[3] if fits else "allow"
        out.append((host, path, rule, verdict))
    return out


def made(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y", 0) for i, u in enumerate(urls)],
                                 "page_id long, url string, html string, items string, given int")


def verdicts(spark, urls):
    got = url_filter.url_verdicts(made(spark, urls)).orderBy("page_id").collect()
    assert [r.page_id for r in got] == list(range(len(urls)))
    return [(r.host, r.path, r.rule, r.verdict) for r in got]


def invented(n, seed):
    rng = random.Random(seed)
    pick = rng.choice
    return [f"{pick(['http', 'https'])}://{pick(['', 'blog.', 'm.casino-win.'])}{pick(['a', 'b', 'shop'])}.example.{pick(['com', 'org', 'net'])}"
            f"/{pick(['en', 'de', 'fr', 'es'])}/{pick(['x', 'news', str(rng.randrange(9999))])}{pick(['', '.html', '/'])}"
            f"{pick(['', '?ref=x&page=2', '#top'])}" for _ in range(n)]


def test_equals_brute_force(spark):
    urls = invented(400, 1)
    got = verdicts(spark, urls)
    assert got == brute(urls)
    assert {v for _, _, rule, v in got if rule is None} == {"allow", "block"}


def test_given_rules_and_odd_urls(spark):
    urls = ["http://NET/", "http://net", "http://a.Example.NET/en/x", "http://a.example.net/EN/", "http://badexample.com/de/x",
            "http://www.example.com/de/x?y=://z", "http://org/fr/", "x://?q", "http://a.org/fr?b/", "", None, "no scheme",
            "mailto:a@b", "://", "http://a.net/" + "p/" * 5000, "http://é.org/fr/漢#😀", "http://a.net?x", "http://com/de/\n/x"]
    urls += urls[:3]
    assert verdicts(spark, urls) == brute(urls)


def test_a_common_url_of_many_tokens_is_not_mined_by_subsets(spark):
    long = "http://h.net/" + "/".join(f"d{i}" for i in range(60)) + "/x"
    urls = [long] * 50 + [f"http://w{i}.example.net/en/{i}" for i in range(50)] + ["http://a.com/d7/x", "http://a.com/en/1"]
    got = verdicts(spark, urls)
    assert [v for *_, v in got[-2:]] == ["block", "allow"]


def test_labels_of_another_table(spark):
    pages = made(spark, ["http://pills.example.com/a", "http://news.example.com/a", "http://a.net/"])
    labels = spark.createDataFrame([(i, f"http://{'pills' if i % 2 else 'news'}.site{i}.info/x", "block" if i % 2 else "allow", 5)
                                    for i in range(40)] + [(99, "http://z.com", None, 5)],
                                   "page_id long, url string, label string, host int")
    got = url_filter.url_verdicts(pages, labels=labels).orderBy("page_id").collect()
    assert [(r.rule, r.verdict, r.learned) for r in got] == [(None, "block", "word:pills"), (None, "allow", "word:news"),
                                                             ("net/", "block", None)]


def test_nothing_to_learn_from(spark):
    assert verdicts(spark, ["http://a.com/x", None]) == [("a.com", "/x", None, "allow"), ("", "", None, "allow")]
    assert url_filter.url_verdicts(made(spark, ["x"]).where("false")).collect() == []
