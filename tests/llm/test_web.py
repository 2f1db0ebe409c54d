import gzip
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tramline.llm import site_style_tree as tree
from tramline.llm import url_filter, warc
from tramline.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, host string, low string, score string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], PAGES)


def test_url_parts_and_rules(spark):
    urls = {
        1: ("http://WWW.Example.COM/en/7?x#y", "www.example.com", "/en/7", "example.com/en/7", "allow"), 2: ("https://a.com/en/", "a.com", "/en/", "com/en/", "block"), 3: ("x://example.net/de/8", "example.net", "/de/8", "example.net/de/8", "block"),
        4: ("x://bexample.net/de/8", "bexample.net", "/de/8", "net/de/", "allow"), 5: ("x://net/de/", "net", "/de/", "net/de/", "allow"), 6: ("x://h.org?/es/", "h.org", "", None, None), 7: (None, "", "", None, None), 8: ("no mark", "", "", None, None),
        9: ("x://É.org/es/a?b", "É.org", "/es/a", "org/es/", "block"), 10: ("x://a.org\n.b/p\nq#f", "a.org\n.b", "/p\nq", None, None), 11: ("", "", "", None, None),
    }
    rows = [(i, u[0], None) for i, u in urls.items()] + [(7, None, None)]
    got = url_filter.judge(pages(spark, rows), URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        _, host, path, rule, verdict = urls[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
        assert (r.host, r.path) == url_filter.split_url(urls[r.page_id][0])
    assert url_filter.judge(pages(spark, []), URL_RULES).count() == 0


def test_rules_against_a_loop(spark):
    """Every URL of the test tables: host, path and rule by a loop over characters and rules, verdicts of the rest by the score."""

    def parts(url):
        at = (url or "").find("://")
        if at < 0:
            return "", ""
        host, path, inside, past = "", "", True, False
        for c in url[at + 3 :]:
            inside = inside and c not in "/?#"
            past = past or not inside and c in "?#"
            if inside:
                host += c.lower() if "A" <= c <= "Z" else c
            elif not past:
                path += c
        return host, path

    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    urls = {r.page_id: r.url for r in df.select("page_id", "url").collect()}
    got = url_filter.judge(df, URL_RULES).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = parts(urls[r.page_id])
        fitting = [(len(rule), rule, what) for rule, what in URL_RULES for own, _, start in [rule.partition("/")] if (host == own or host.endswith("." + own)) and path.startswith("/" + start)]
        _, rule, what = max(fitting, default=(0, None, "block" if r.score >= 0.7 else "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, what)


def test_url_model(spark):
    """Held-out hosts share no word with those of training; the verdict favours precision."""
    table, right, wrong = url_filter.labelled_urls(), 0, 0
    for k in range(5):
        weights, bias = url_filter.fit([x for i, x in enumerate(table) if i % 5 != k])
        score = lambda u, w=weights, b=bias: 1 / (1 + math.exp(-w[g := url_filter.grams(*url_filter.split_url(u))].sum() / max(1, len(g)) ** 0.5 - b))
        right += sum((score(u) > 0.5) == y for u, y in table[k::5])
        wrong += sum(score(u) >= 0.7 and not y for u, y in table[k::5])
    assert right >= 0.78 * len(table) and wrong <= 3
    own = spark.createDataFrame([("http://bad.example/x", 1), ("http://good.example/x", 0), (None, 0)], "url string, label int")
    got = {r.page_id: r for r in url_filter.judge(pages(spark, [(1, "http://bad.example/x", None), (2, "http://good.example/x", None)]), [], own).collect()}
    assert got[1].score > got[2].score and url_filter.fit([])[1] < 0


def test_large_labelled_table_is_sampled(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_LABELLED", 100)
    table = [(f"http://good{i}.example/read", 0) for i in range(200)] + [(f"https://zbad{i}.example/casino", 1) for i in range(200)]
    for labelled in (table, spark.createDataFrame(table, "url string, label int")):
        got = {r.page_id: r.score for r in url_filter.judge(pages(spark, [(1, "https://zbad999.example/casino", None), (2, "http://good999.example/read", None)]), [], labelled).collect()}
        assert got[1] > 0.5 > got[2]


def test_extraction(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">We use cookies</div>
    <div class=ad>Buy</div><article><h1>One &amp; two</h1><p><b>First  <i>part</i>.<br>More<p>Second &#233;&nbsp;x<ul><li>a<li>b</ul><!-- <p>no</p> --><form><p>Name</p></form>
    <script>var t = "</p>";</script><aside>Side</aside><pre>c\n d</pre><div id="comments"><p>Reader says</p></div></article><div class="sidebar"><p>More</p></div><footer>Foot</footer>"""
    rows = [(1, "http://a.b/", page), (2, None, None), (3, "x://h/", ""), (4, "x://h/", "<p>plain &lt;text&gt;"), (5, "x://h/", "just text"), (5, "x://h/", "just text"), (6, "x://h/", "<div class='x' <p>broken"), (7, "x://h/", "<p>" + "long word " * 30_000)]
    got = {r.page_id: r for r in tree.extract(pages(spark, rows)).collect()}
    assert got[1].text == "One & two\nFirst part. More\nSecond é x\na\nb\nc d" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[2].n_chars == 0 and got[4].text == "plain <text>" and got[5].text == "just text"
    assert got[7].n_chars == 300_000 - 1
    assert tree.extract(pages(spark, rows)).count() == len(rows) and tree.extract(pages(spark, [])).count() == 0


def test_style_tree_removes_templates(spark):
    """What reads alike on the pages of a host goes, inside an explicit article too, and what differs stays."""
    for tag in ("div", "article"):
        body = lambda i, tag=tag: f"<body><{tag} class=text><div class=top><p>Welcome to our site</p></div><p>Story {i} of many that we have to tell</p><p>It goes on {i * 7} times and more</p><p>Write to us at any time</p><div class=end><span>Call us</span></div></{tag}></body>"
        rows = [(i, f"http://one.org/{i}", body(i)) for i in range(12)] + [(100, "http://two.org/", body(100))]
        got = {r.page_id: r for r in tree.extract(pages(spark, rows)).collect()}
        assert got[3].text == "Story 3 of many that we have to tell\nIt goes on 21 times and more" and got[3].n_removed == 3
        assert got[100].text.startswith("Welcome") and got[100].n_removed == 0  # one page tells nothing about its host
        off = {r.page_id: r for r in tree.extract(pages(spark, rows), min_importance=0.0).collect()}
        assert off[3].text.count("\n") == 4 and off[3].n_removed == 0


def test_near_copies_are_no_templates(spark):
    """A host with many near copies of one article: all branches are alike, so nothing is less important than the rest."""
    body = lambda i: "<article><h1>The one story</h1>" + "".join(f"<p>Paragraph {k} of the story{' changed ' + str(i) if k == i % 6 else ''}</p>" for k in range(6)) + "</article>"
    rows = [(i, f"http://one.org/{i}", body(i)) for i in range(30)]
    assert tree.extract(pages(spark, rows)).filter("n_removed > 0").count() == 0


def test_style_tree_against_brute_force(spark):
    """Random sites of nested div elements, each text at a path of its own; counts, importance and removal by plain loops."""
    rng = random.Random(12)

    def make(depth):
        return [("p", rng.choice(["notice one", "notice two", f"own {rng.random()} text of some length"])) if depth == 0 or rng.random() < 0.5 else ("div", rng.choice("abc"), make(depth - 1)) for _ in range(rng.randrange(1, 4))]

    def write(node):
        return f"<p>{node[1]}</p>" if node[0] == "p" else f"<div class={node[1]}>{''.join(map(write, node[2]))}</div>"

    sites = {i: ("h%d" % (i % 2), ("div", "root", make(2))) for i in range(40)}
    texts, shown, of_path = Counter(), defaultdict(Counter), Counter()

    def walk(node, path, leaves, inner):
        """Leaves (path, text) and the child tags of every inner node, a leaf's paragraph being one without children."""
        path = (*path, node[0] if node[0] == "p" else node[:2])
        if node[0] == "p":
            leaves.append((path, node[1]))
            inner.append((path, ()))
        else:
            inner.append((path, tuple(x[0] for x in node[2])))
            for x in node[2]:
                walk(x, path, leaves, inner)

    parts = {}
    for i, (host, node) in sites.items():
        parts[i] = leaves, inner = [], []
        walk(node, (), leaves, inner)
        inner.append(((), ("div",)))
        texts.update((host, *x) for x in set(leaves))
        of_path.update((host, p) for p in {x[0] for x in leaves})
        for p, kids in inner:
            shown[host, p][kids] += 1

    def presentation(host, path):
        counts = shown[host, path].values()
        m = sum(counts)
        entropy = -sum(c / m * math.log(c / m, m) for c in counts) if m > 1 else 1.0
        return (m * entropy + 4) / (m + 4)

    def value(host, node, path):
        """Importance and length of a branch."""
        path = (*path, node[0] if node[0] == "p" else node[:2])
        if node[0] == "p":
            n = texts[host, path, node[1]]
            kids = [(1 - math.log(n) / math.log(of_path[host, path] + 4) if n > 1 else 1.0, len(node[1]))]
        else:
            kids = [value(host, x, path) for x in node[2]]
        return 0.1 * presentation(host, path) + 0.9 * sum(v * n for v, n in kids) / sum(n for _, n in kids), sum(n for _, n in kids)

    def kept(host, node, path, bound):
        if value(host, node, path)[0] < bound:
            return []
        path = (*path, node[0] if node[0] == "p" else node[:2])
        if node[0] == "p":
            n = texts[host, path, node[1]]
            return [] if (1 - math.log(n) / math.log(of_path[host, path] + 4) if n > 1 else 1.0) < bound else [node[1]]
        return [t for x in node[2] for t in kept(host, x, path, bound)]

    expected = {}
    for i, (host, node) in sites.items():
        spread = sorted(v for p, t in parts[i][0] for v in [1 - math.log(texts[host, p, t]) / math.log(of_path[host, p] + 4) if texts[host, p, t] > 1 else 1.0] * len(t))
        expected[i] = "\n".join(kept(host, node, (), 0.5 * spread[(len(spread) + 1) // 2 - 1]))
    rows = [(i, f"http://{host}.org/{i}", f"<body>{write(node)}</body>".replace("<body>", "").replace("</body>", "")) for i, (host, node) in sites.items()]
    reads = {(sites[i][0], tuple(parts[i][0])) for i in sites}
    assert len(reads) == len(sites)  # no copies, which would count once
    got = {r.page_id: (r.text, r.n_removed) for r in tree.extract(pages(spark, rows), min_importance=0.5).collect()}
    assert {i: t for i, (t, _) in got.items()} == expected and sum(n > 0 for _, n in got.values()) >= 5


def test_markup_is_read_as_far_as_it_goes(spark):
    cases = {
        "<article><p><b it's>one</b> two</p></article>": "one two", "<article><p class='related-work'>kept</p><p class='related'>gone</p><div class='ad-slot-3'>gone</div></article>": "kept",
        "<article><p>x <math><mi>a</mi><mo>+</mo></math></p><object>y</object><svg><text>z</text></svg><noscript>n</noscript><select><option>o</select></article>": "x a+\ny\nz\nn",
        "<article><p title=\"a > b\">t</p><p>u<a href": "t\nu", "<main><h1 class='notice-of-appeal'>Notice</h1><div class='site-notice'>gone</div>": "Notice",
    }
    got = {r.page_id: r.text for r in tree.extract(pages(spark, [(i, None, h) for i, h in enumerate(cases)])).collect()}
    assert got == dict(enumerate(cases.values()))


def test_copies_are_no_templates(spark):
    """Copies of a page without an article element keep their text, and so do the different pages of that host and pages without one."""
    body = lambda i: f"<body><div class=text><p>Story {i} of many</p><p>It goes on {i * 7}</p></div></body>"
    rows = [(i, f"http://one.org/{i}", body(0)) for i in range(40)] + [(100 + i, f"http://one.org/{100 + i}", body(i)) for i in range(1, 6)]
    rows += [(200 + i, None, f"<body><p>No host</p><!-- {i} --></body>") for i in range(8)]
    got = {r.page_id: (r.text, r.n_removed) for r in tree.extract(pages(spark, rows)).collect()}
    assert all(got[i] == ("Story 0 of many\nIt goes on 0", 0) for i in range(40))
    assert all(got[100 + i] == (f"Story {i} of many\nIt goes on {i * 7}", 0) for i in range(1, 6))
    assert all(got[200 + i] == ("No host", 0) for i in range(8))


def test_warc_records(spark):
    http = b"HTTP/1.1 200 OK\r\nETag: \"a\"\r\nX-Long: one\r\n two\r\n\r\nbody\r\nmore"
    one = warc.write_record("response", {"WARC-Record-ID": "<1>", "WARC-Target-URI": "http://a/", "WARC-Date": "2024-01-01T00:00:00Z", "Content-Type": "application/http; msgtype=response"}, http)
    two = warc.write_record("revisit", {"WARC-Record-ID": "<2>", "WARC-Target-URI": "http://a/"})
    found = list(warc.read_records(one + two))
    assert [r["record_id"] for r in found] == ["<1>", "<2>"] and found[0]["body"] == b"body\r\nmore" and dict(found[0]["headers"]) == {":status": "200", "etag": '"a"', "x-long": "one two"}
    assert list(warc.read_records(gzip.decompress(one) + gzip.decompress(two))) == found
    assert list(warc.read_records(None)) == [] and [r["status"] for r in warc.read_records(one[:40])] == ["damaged"]
    df = warc.records(spark.createDataFrame([(one + two,), (None,)], "content binary"))
    assert sorted(r.warc_type for r in df.collect()) == ["response", "revisit"]


def test_damaged_warc_files(spark):
    """A flipped byte anywhere in the first member loses that record only; wrong lengths are told."""
    made = [warc.write_record("response", {"WARC-Record-ID": f"<{i}>", "Content-Type": "application/http"}, b"HTTP/1.1 200 OK\r\n\r\n" + bytes(range(256)) * i) for i in (1, 2, 3)]
    for at in range(len(made[0])):
        bad = bytearray(b"".join(made))
        bad[at] ^= 0xFF
        found = [r for r in warc.read_records(bytes(bad)) if r["status"] == "ok" and r["record_id"] in ("<2>", "<3>")]
        if at > 1:  # without its first two bytes it isn't known as a gzip file
            assert [r["record_id"] for r in found] == ["<2>", "<3>"] and len(found[1]["body"]) == 768, at
    plain = b"".join(map(gzip.decompress, made))
    for wrong in (b"x", b"-4", b"99999999"):
        rows = list(warc.read_records(plain.replace(b"Content-Length: 275", b"Content-Length: " + wrong)))
        assert [r["status"] for r in rows] == ["wrong length", "ok", "ok"] and rows[0]["record_id"] == "<1>"
    df = warc.records(spark.createDataFrame([(made[0][:50] + made[1],)], "content binary"))
    assert sorted((r.status, r.record_id) for r in df.collect()) == [("damaged", None), ("ok", "<2>")]


def test_canonical_url(spark):
    same = ["http://www.A.com/x/?b=2&a=1&utm_source=q#f", "https://a.com:443/x?a=1&b=2", "a.com/x/?a=1&ref=z&b=2"]
    df = spark.createDataFrame([(u,) for u in same], "u string").select(warc.canonical_url(F.col("u")).alias("c"))
    assert {r.c for r in df.collect()} == {"a.com/x?a=1&b=2"}


CAPTURES = "record_id string, warc_type string, url string, date timestamp, headers map<string,string>, near string"


def captures(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "record_id string, warc_type string, url string, d string, headers map<string,string>, near string").withColumn("date", F.col("d").cast("timestamp"))


def test_resolve(spark):
    full = {"etag": '"1"', "last-modified": "mon", "content-length": "9", "a": "old"}
    rows = [
        ("f1", "response", "http://a/x", "2024-01-01 00:00:00", full), ("f2", "response", "http://a/x", "2024-03-01 00:00:00", full | {"etag": '"2"'}),
        ("r1", "revisit", "https://a/x#q", "2024-01-01 00:00:10", {"etag": 'W/"1"', "a": "new", "content-length": "0"}), ("r2", "revisit", "http://a/x", "2024-02-20 00:00:00", {"etag": '"2"'}),
        ("r3", "revisit", "http://a/x", "2024-03-01 00:00:00", {"last-modified": "mon"}), ("r4", "revisit", "http://a/x", "2024-04-01 00:00:00", {}), ("r5", "revisit", "http://a/y", "2024-04-01 00:00:00", {"etag": '"1"'}),
        ("r6", "revisit", None, "2024-04-01 00:00:00", {"etag": '"1"'}), ("r7", "revisit", "http://a/x", None, None), ("m1", "metadata", "http://a/x", "2024-03-02 00:00:00", {}), ("r4", "revisit", "http://a/x", "2024-04-01 00:00:00", {}),
    ]
    got = [(r.record_id, r.refers_to, r.verdict) for r in warc.resolve(captures(spark, rows)).collect()]
    assert sorted(got) == [("r1", "f1", "resolved"), ("r2", "f1", "mismatch"), ("r3", "f1", "resolved"), ("r4", "f2", "unverified"), ("r4", "f2", "unverified"), ("r5", None, "missing"), ("r6", None, "missing"), ("r7", None, "missing")]
    heads = {r.record_id: r.headers for r in warc.resolve(captures(spark, rows)).collect()}
    assert heads["r4"] == {}  # nothing was checked against a response that has validators
    bare = [("f1", "response", "http://b/", "2024-01-01 00:00:00", {"a": "old", "b": "kept"}), ("r1", "revisit", "http://b/", "2024-01-02 00:00:00", {"a": "new"})]
    assert warc.resolve(captures(spark, bare)).first().headers == {"a": "new", "b": "kept"}
    assert heads["r1"] == full | {"etag": 'W/"1"', "a": "new"} and heads["r2"] == {"etag": '"2"'}
    assert warc.resolve(captures(spark, rows[:0])).count() == 0
