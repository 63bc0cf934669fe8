"""Source divergence, spelling variants and URL filters against plain versions."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from shelfline.llm import divergence, spelling, urls
from shelfline.llm.sql import ORACLES
from tests.llm.brute import UPPER

# 11: divergence


def divergence_rows(docs, least=10, top=10):
    """docs: (lang, source, text)."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(UPPER))) for lang, source, t in docs]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        holders = Counter(w for _, _, ws in own for w in set(ws))
        kept = {w for w, n in holders.items() if n >= least}
        counts = defaultdict(Counter)
        for _, source, ws in own:
            counts[source].update(w for w in ws if w in kept)
        whole = sum(counts.values(), Counter())

        def p(c, kept=kept):
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (c.total() + 2 * len(kept)) for t in kept}

        ps, q = {s: p(c) for s, c in counts.items()}, p(whole)

        def f(x, y):
            return (x - y) * (x - y) // (x + y)

        for s in counts:
            pairs = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            terms = [(-f(ps[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and ps[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)]
    return Counter(out)


def _diverged(docs, **more):
    return Counter(tuple(r) for r in divergence.divergence(docs, **more).select("lang", "source", "part", "item", "value", "rank").collect())


def _told(docs):
    return [(r.lang, r.source, r.text) for r in docs.select("lang", "source", "text").collect()]


def test_divergence_over_many_cells(documents):
    expected = divergence_rows(_told(documents), 3)
    assert any(r[2] == "pair" and r[4] > 0 for r in expected)
    assert _diverged(documents, least_docs=3, group_block=3, term_block=16) == expected
    assert _diverged(documents, least_docs=3) == expected


@pytest.mark.parametrize("least", [1, 2, 10])
def test_divergence_of_odd_rows(odd, none, least):
    assert _diverged(odd, least_docs=least, group_block=1, term_block=4) == divergence_rows(_told(odd), least)
    assert divergence.divergence(none).count() == 0


def test_divergence_splits_long_texts_and_keeps_counts_bounded(spark, monkeypatch):
    long = ("alpha beta ganz " * 90_000) + "x" * 3_000_000 + " alpha"
    docs = spark.createDataFrame([("en", "a", long), ("en", "b", "alpha gamma"), (None, None, None), ("", "", "beta")], "lang string, source string, text string")
    assert _diverged(docs, least_docs=1) == divergence_rows(_told(docs), 1)


def test_smoothed_probabilities_are_exact_beyond_longs(spark):
    row = spark.createDataFrame([(40_000_000_000, 90_000_000_007, 3)], "c long, n long, v long")
    from pyspark.sql import functions as F

    got = row.select(divergence._smoothed(F.col("c"), F.col("n"), F.col("v"))).first()[0]
    assert got == 1 + 1_000_000_000 * 40_000_000_002 // 90_000_000_013


# 12: spelling


def edits_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_rows(docs, every=97, least=3, times=2):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= least and len(w) >= 5}
    near = {w: [v for v in words if edits_one(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= times * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return Counter(out)


def _spelled(docs, **more):
    return Counter(tuple(r) for r in spelling.spelling_variants(docs, **more).select("word", "form", "root", "n", "n_near", "form_n").collect())


SPELLED = [
    "colour " * 40 + "color " * 18 + "colr " * 9 + "colourr " * 20 + "colouur " * 3,
    "\u00e9t\u00e9s\u00e9 " * 9 + "\u00e9t\u00eas\u00e9 " * 4 + "\u00c9t\u00e9s\u00e9 " * 3 + "\u00e9t\u00e9s\u00e9s " * 3,
    "aaaaa " * 7 + "aaaaaa " * 3 + "aaaaaaa " * 30 + "aaaab " * 3 + "baaaa " * 4 + "aabaaa " * 3,
    "abcdef " * 3 + "bcdef " * 3 + "abcdefg " * 3 + "abcde " * 3 + "xabcde " * 3 + "abcxdef " * 7,
]


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_spelling_of_all_kinds_of_edits(spark, block):
    docs = spark.createDataFrame([*enumerate(SPELLED), (None, SPELLED[0]), (7, None), (7, ""), (2, SPELLED[2])], "doc_id long, text string")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    expected = spelling_rows(pairs, every=5)
    assert sum(r[1] is not None for r in expected) > 5
    assert _spelled(docs, every=5, block=block) == expected
    assert _spelled(docs, block=block) == spelling_rows(pairs)


def test_spelling_of_documents_and_odd_rows(documents, odd, none):
    some = documents.where("length(text) < 3000")
    assert _spelled(some) == spelling_rows([(r.doc_id, r.text) for r in some.select("doc_id", "text").collect()])
    assert _spelled(odd, least=1) == spelling_rows([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()], least=1)
    assert spelling.spelling_variants(none).count() == 0


def test_a_third_of_the_words_in_one_key(spark):
    # All words share their first half, and every word has a near one.
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"shared{x}{y}{z}end" for x in letters[:12] for y in letters[:12] for z in letters[:4]]
    docs = spark.createDataFrame([(1, " ".join(words * 3))], "doc_id long, text string")
    got = spelling.spelling_variants(docs, every=10**9 + 7, block=32)
    assert got.count() == len(words)
    assert {r.n_near for r in got.collect()} == {11 + 11 + 3}


def test_roots_follow_long_chains(spark):
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(45)], "word string, up string")
    assert {r.up for r in spelling.roots(chain).collect()} == {"45"}


# 13: URL filters

PAGES = [
    (1, "http://a.example.net/en/1", '<a href="http://x.org/y">'), (2, "https://a.example.net/de/1", "<a href='//b.example.com/'>"),
    (3, "HTTP://A.Example.NET/en", None), (4, "x://example.net/en/", "<A class=x HREF = https://b.example.com/fr/>b</A>"),
    (5, "http://b.example.com/de/9?x=://c", '<area href="http://a.example.net/">'), (6, "http://b.example.com/fr/?q", '<a title="a>b" href="/in">'),
    (7, "http://x.org/fr/1", '<a href="http://b.example.com/">' * 3), (8, "http://x.org", '<a\nhref="http://bad.net/#z">'),
    (9, "http://bad.net/", '<link href="http://none.org/"><a href="http://y.io">'), (10, "http://y.io/a", '<a href="http://bad.net">'),
    (11, None, '<a href="http://bad.net">'), (12, "", ""), (13, "no scheme/at.all", None), (14, "://", None), (15, "http:///path", '<a href="http://bad.net">'),
    (16, "http://evilnet/x", None), (17, "http://notexample.net/en/", None), (18, "http://example.net:80/en/", None), (10, "http://y.io/a", '<a href="http://bad.net">'),
    (None, "http://example.com/de/#a?b", None), (19, "ftp://x.org/fr/\u00e9?\n", "x" * 500_000 + '<a href="http://y.io/?a=1&amp;b">'),
    (20, "http://z.io/1", '<a href="http://y.io/">'), (21, "http://z.io/2", '<a href="http://x.org/">'),
]


@pytest.fixture(scope="module")
def linked(spark):
    return spark.createDataFrame([(*p, "h", 1) for p in PAGES], "page_id long, url string, html string, host string, trust int")


def verdict_rows(pages, damping=0.85, rounds=20):
    def split(url):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.DOTALL)
        return (m[1].translate(UPPER), m[2]) if m else ("", "")

    judged, n_pages, trust, distrust, links = [], Counter(), Counter(), Counter(), Counter()
    for i, url, html in pages:
        host, path = split(url)
        fits = [r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        rule = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
        judged.append((i, host, path, rule))
        if host:
            n_pages[host] += 1
            if rule:
                (trust if rule[2] == "allow" else distrust)[host] += urls.UNIT
            for to in re.findall(urls.LINK, html or ""):
                dst = split("http:" + to if to.startswith("//") else to)[0]
                if dst and dst != host:
                    links[host, dst] += 1
    out, into = Counter(), Counter()
    for (a, b), n in links.items():
        out[a] += n
        into[b] += n
    t, d = trust.copy(), distrust.copy()
    for _ in range(rounds):
        nt, nd = Counter(), Counter()
        for (a, b), n in links.items():
            nt[b] += int(t[a] * damping * n / out[a])
            nd[a] += int(d[b] * damping * n / into[b])
        t, d = nt, nd
        trust.update(t)
        distrust.update(d)
    bad = {h for h, n in n_pages.items() if distrust[h] - trust[h] > n * urls.UNIT * urls.THRESHOLD}
    return Counter(
        (i, host, path, rule and rule[0] + rule[1], rule[2] if rule else "block" if host in bad else "allow") for i, host, path, rule in judged
    ), bad


URL_COLUMNS = "page_id host path rule verdict".split()


def test_verdicts_equal_plain_propagation(linked):
    expected, bad = verdict_rows(PAGES)
    assert "z.io" in bad and "x.org" not in bad
    assert Counter(tuple(r) for r in urls.url_verdicts(linked).select(URL_COLUMNS).collect()) == expected


def test_verdicts_equal_sql(linked):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    sql = con.sql(ORACLES["op13_url_filter"]).select(", ".join(URL_COLUMNS)).fetchall()
    assert Counter(sql) == Counter(tuple(r) for r in urls.url_verdicts(linked).select(URL_COLUMNS).collect())


def test_longest_rule_wins_and_empty_tables(linked, spark):
    rules = [("io", "/", "block"), ("y.io", "/a", "allow"), ("y.io", "/", "block")]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.url_verdicts(linked, rules).where("host IN ('y.io', 'z.io')").collect()}
    assert got[10] == ("y.io/a", "allow") and got[20] == ("io/", "block")
    assert urls.url_verdicts(linked.where("1 = 0")).count() == 0
    assert {r.verdict for r in urls.url_verdicts(linked, []).collect()} == {"allow"}


def test_a_chain_of_links_longer_than_a_stride(spark):
    links = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(12)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("h0", 1_000_000, 0), ("h12", 0, 1_000_000), ("alone", 5, 7)], "host string, trust long, distrust long")
    got = {r.host: (r.trust, r.distrust) for r in urls.propagated(links, seeds).collect()}
    mass = [1_000_000]
    for _ in range(12):
        mass.append(int(mass[-1] * 0.85))
    assert [got[f"h{i}"][0] for i in range(13)] == mass and [got[f"h{12 - i}"][1] for i in range(13)] == mass
    assert got["alone"] == (5, 7)
