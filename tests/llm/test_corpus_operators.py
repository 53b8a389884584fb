"""Operators over a whole table: decontamination, near-duplicates, URLs, wrappers, top-k."""

import html as entities
import re
import time
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from subledger.llm import decontaminate, html, simhash, topk, urls

from conftest import SF_SMALL
from test_text_operators import LONG, empty_documents, odd_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").encode().lower().decode())


# -------------------------------------------------------- decontamination


def brute_contamination(docs, items, window):
    wins = defaultdict(set)
    for i, t in items:
        ws = words_of(t)
        for s in range(max(1, len(ws) - window + 1) if ws else 0):
            wins[tuple(ws[s : s + window])].add(i)
    out = []
    for i, t in docs:
        ws, hit, ids = words_of(t), set(), set()
        for w, who in wins.items():
            for s in range(len(ws) - len(w) + 1):
                if tuple(ws[s : s + len(w)]) == w:
                    hit.update(range(s, s + len(w)))
                    ids |= who
        out.append((i, len(ws), len(hit), sorted(str(x) for x in ids if x is not None)))
    return out


def test_contamination_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "the"]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, text(int(rng.integers(3, 14)))) for i in range(25)] + [(90, None), (91, " ,. "), (None, "only here once"), (92, "Tiny!"), (0, text(8))]
    docs = []
    for i in range(120):
        parts = [text(20)]
        if i % 3 == 0:
            parts.append(items[i % 25][1].upper().replace(" ", ", "))
        docs.append((i % 100, " ".join([*parts, text(10)])))
    docs += [(200, None), (201, ""), (202, "tiny tiny"), (None, "only here once"), (203, items[4][1])]
    docs += [docs[0], docs[0]]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("r", "h", "did", "w", "cands", "pos")})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(0))
    got = decontaminate.contamination(frame, bench, window=6).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got], key=key) == sorted(brute_contamination(docs, items, 6), key=key)
    assert all(r.n_items == len(r.item_ids) and (r.n_hit > 0) == bool(r.spans) for r in got)


def test_contamination_odd_tables(spark):
    bench = spark.createDataFrame([(1, "some text"), (2, "prose here plain words")], "item_id long, text string")
    odd = odd_documents(spark)
    got = {r.doc_id: r for r in decontaminate.contamination(odd, bench).collect()}
    assert got[1].n_hit == 2 and got[2].n_words == 0 and got[None].n_hit == 0
    assert got[4].n_words == 200_000 and got[4].n_hit == 4 * 39_999
    empty_bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(odd, empty_bench).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(empty_documents(spark), bench).count() == 0
    kept = decontaminate.clean_documents(odd, bench)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 5]


def test_contamination_by_a_long_item(spark):
    words = [f"w{i * i % 997}" for i in range(20_000)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = [(1, " ".join(["lead", *words[5000:15_000]])), (2, " ".join(words[300:309])), (3, " ".join(words[300:311]))]
    got = {r.doc_id: (r.n_hit, r.item_ids) for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {1: (10_000, ["1"]), 2: (0, []), 3: (11, ["1"])}


def test_proximity_matches(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "alpha beta gamma delta"), (2, "alpha beta and gamma delta"), (3, "alpha x x x x x x x beta gamma y delta z"), (4, "alpha")],
        "doc_id long, text string",
    )
    near = lambda slop: {r.doc_id for r in decontaminate.proximity_matches(docs, bench, slop).collect()}
    assert 1 in near(0) and 4 not in near(5)
    assert near(0) <= near(1) <= near(8)


def brute_near(words, items, window, slop):
    out = set()
    for item, t in items:
        ws = words_of(t)
        for s in range(max(1, len(ws) - window + 1) if ws else 0):
            win = ws[s : s + window]
            for x in range(-len(win) - slop, len(words) + 1):
                met = sum(any(0 <= x + i + d < len(words) and words[x + i + d] == w for d in range(slop + 1)) for i, w in enumerate(win))
                if met >= len(win) - len(win) // 5:
                    out.add(item)
                    break
    return sorted(str(i) for i in out if i is not None)


@pytest.mark.parametrize(("window", "slop"), [(10, 0), (10, 2), (6, 1), (11, 3)])
def test_proximity_against_brute_force(spark, window, slop):
    rng = np.random.default_rng(window + slop)
    vocabulary = [f"v{i}" for i in range(25)]
    pick = lambda n: list(rng.choice(vocabulary, n))
    items = [(i, " ".join([*pick(int(rng.integers(1, 16))), f"absent{i}"] if i % 3 == 0 else pick(int(rng.integers(1, 16))))) for i in range(20)]
    items += [(50, None), (None, "v1 v2 v3 v4"), (51, "never here at all")]
    docs = []
    for i in range(60):
        words = items[i % 20][1].split()
        for _ in range(int(rng.integers(0, 4))):
            k = int(rng.integers(0, len(words) + 1))
            words[k : k + int(rng.integers(0, 2))] = pick(int(rng.integers(0, 2)))
        docs.append((i, " ".join(pick(int(rng.integers(0, 8))) + words + pick(int(rng.integers(0, 8))))))
    docs += [(100, None), (101, ""), (None, "v1 v2 x v3 v4"), (5, docs[7][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("cell", "near", "need", "at")})
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame, bench, window, slop=slop).select("doc_id", "near_ids").collect()
    want = [(i, brute_near(words_of(t), items, window, slop)) for i, t in docs]
    assert sorted((str(r.doc_id), r.near_ids) for r in got) == sorted((str(i), n) for i, n in want)
    assert any(n for _, n in want) and not all(n for _, n in want)


def test_decontamination_plan_has_no_python(spark):
    docs, bench = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontaminate.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|NestedLoop|Cartesian", plan)


# ---------------------------------------------------------------- SimHash


def brute_fingerprint(text, shingle=3, seed=42):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    parts = [b" ".join(ws[i : i + shingle]) for i in range(len(ws) - shingle + 1)] or [b" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(p, seed) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius):
    nodes = sorted(set(fps))
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    return {x: find(x) for x in nodes}


@pytest.mark.parametrize("text", [None, "", "  ", "One", "one TWO", "a b c", "É é a b\u00a0c d\x0be", "x " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3, 42) == brute_fingerprint(text)


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97} é{i}" for i in range(500))
    monkeypatch.setattr(simhash, "CHUNK", 50)
    assert simhash.fingerprint(text, 3, 42) == brute_fingerprint(text)


@pytest.mark.parametrize("tile", [4096, 3])
def test_links_and_components_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "CELLS", 64)
    rng = np.random.default_rng(4)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    for k in range(200):  # chains and a dense group
        base = fps[int(rng.integers(0, len(fps)))] if k < 120 else fps[0]
        fps.append(base ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))))
    fps += [0, (1 << 64) - 1, (1 << 64) - 2, 3]
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in set(fps)]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = simhash.links(frame, 2)
    got = defaultdict(set)
    for r in simhash.components(edges).collect():
        got[r.root % (1 << 64)].add(r.node % (1 << 64))
    want = defaultdict(set)
    for x, root in brute_components(fps, 2).items():
        want[root].add(x)
    found = {frozenset(v | {k}) for k, v in got.items()}
    assert found == {frozenset(v) for v in want.values() if len(v) > 1}
    assert edges.count() < len(set(fps)) * 3  # spanning, not every pair of the dense group


def test_near_duplicates_and_representatives(spark):
    odd = odd_documents(spark, [(8, "SOME  text"), (None, "some text"), (None, None)])
    got = simhash.near_duplicates(odd).collect()
    fps = [(r[0], brute_fingerprint(r[1])) for r in odd.select("doc_id", "text").collect()]
    root = brute_components([f for _, f in fps], 2)
    smallest = {}
    for i, f in fps:
        if i is not None:
            smallest[root[f]] = min(i, smallest.get(root[f], i))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got], key=key) == sorted(
        [(i, f, smallest.get(root[f])) for i, f in fps], key=key
    )
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(root.values()))
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(smallest.values())
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0 and simhash.representatives(empty_documents(spark)).count() == 0


# ------------------------------------------------------------------- URLs

RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


def brute_rule(url):
    url = url or ""
    rest = url[url.index("://") + 3 :] if "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = host.encode().lower().decode()
    fits = [(len(r.name), r.name, r.verdict) for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


ODD_URLS = [
    None, "", "no scheme/x", "http://", "HTTP://WWW.Example.ORG/es/x?y=/z#t", "a://b://c/d", "http://example.org", "http://notexample.org/es/",
    "http://x.com/de/?a=1&b=2", "http://com/fr/", "http://É.org/é%20", "http://x.net/" + "a/" * 20_000, "http://x.org?q=/en/1", "x://y.example.org/en/1\n2",
]


def test_url_rules_against_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(ODD_URLS)] + [(0, None), (None, "http://x.org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("q") for c in ("host", "rule", "verdict", "f_length", "y")})
    got = urls.filter_urls(pages, RULES).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for i, u in rows:
        host, path, name, verdict = brute_rule(u)
        assert (by_id[i].host, by_id[i].path, by_id[i].rule) == (host, path, name), u
        assert by_id[i].verdict == verdict if verdict else by_id[i].verdict in ("allow", "block")
    assert urls.filter_urls(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages.where("url like 'http://x.net%'"), RULES).collect()} == {"allow"}


def test_url_trees_learn_and_stay_native(spark):
    rows = [(i, f"http://h{i % 7}.{'org/a' if i % 2 else 'com/de/x'}/{i}?" + ("q=1&r=2&s=3" if i % 2 == 0 else "")) for i in range(400)]
    pages = spark.createDataFrame(rows + [(900, "http://z.net/x/1?q=1&r=2&s=3"), (901, "http://z.net/a/1")], "page_id long, url string")
    found = urls.filter_urls(pages, RULES)
    got = {r.page_id: r.block_probability for r in found.collect()}
    assert got[900] > got[901] and all((got[i] > 0.5) == (i % 2 == 0) for i, _ in rows)
    assert not re.search("Python|Arrow|Pandas", found._jdf.queryExecution().executedPlan().toString())


def test_url_features(spark):
    rates = spark.createDataFrame([("", 0.25), ("net", 0.75)], "suffix string, rate double")
    page = spark.createDataFrame([("https://a-b.x.net/p/qq/7?x=1&y=%20#t",)], "url string")
    r = urls.with_features(urls.parsed(page), rates).first()
    assert (r.f_depth, r.f_parameters, r.f_labels, r.f_digits, r.f_longest_part) == (3, 2, 3, 4, 2)
    assert (r.f_tld_rate, r.f_suffix_rate) == (0.75, 0.25)
    counts = np.unique(list("https://a-b.x.net/p/qq/7?x=1&y=%20#t"), return_counts=True)[1] / r.f_length
    assert r.f_entropy == pytest.approx(-(counts * np.log2(counts)).sum())


# ------------------------------------------------------------------- HTML


def page(body, title="T"):
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
        f"<header class=site>Site name</header><nav><ul><li><a href='/a'>Menu</a></li></ul></nav>{body}"
        "<footer>&copy; foot</footer></body></html>"
    )


CASES = [
    ("<article><h1>A &amp; B</h1><p><b>One\n two<br><p>Three&nbsp;x</p></article>", "A & B\n\nOne two\n\nThree x"),
    ("<main><p>Text</p><aside>Side</aside><div class='ad-banner'>Buy</div><form>Mail <input></form><p>More</main>", "Text\n\nMore"),
    ("<article><p>Body</p><section id='comments'><p>First!</p></section><div class=\"cookie notice\">We use</div></article>", "Body"),
    ("<article><header><h1>Head</h1></header><p>a<!-- x --><i>b</i>c</p><ul><li>one<li>two</ul></article>", "Head\n\nabc\n\none\n\ntwo"),
    ("<article><p>1 &lt; 2 &am &#8364;&copy</p><table><tr><td>x<td>y</table></article>", "1 < 2 &am €©\n\nx\n\ny"),
]


def test_html_cases(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.org/x", page(b)) for i, (b, _) in enumerate(CASES)], "page_id long, url string, html string")
    got = {r.page_id: r for r in html.extract(pages.withColumns({c: F.lit(0) for c in ("host", "path", "text", "salt")})).collect()}
    for i, (_, text) in enumerate(CASES):
        assert (got[i].text, got[i].n_chars) == (text, len(text))


@pytest.mark.parametrize(
    "body",
    [
        "<article><p>One</p><svg class=icon/><math/><p>Two</p></article>",
        "<article><p>One</p><title-bar></title-bar><p>Two</p></article>",
        "<article><p>One</p><select-menu></select-menu><object-x></object-x><p>Two</p></article>",
        "<article><p>One</p><template><svg viewBox='0 0'><object data=x><p>Two</p></article>",
        "<div class='content has-sidebar'><article class='post no-comments'><p>One</p><p>Two</p></article></div>",
        "<main class='with-menu'><p>One</p><div data-id=sidebar><p>Two</p></div><div class=social-share>Tell</div></main>",
    ],
)
def test_html_loses_no_text_to_icons_custom_tags_and_class_words(body):
    assert html.main_text(page(body), "") == "One\n\nTwo"


def test_wrapper_finds_the_container_without_article(spark):
    body = lambda i: f"<div id=top>Welcome</div><div class=col><div class=story><p>Story {i} begins here and goes on {i}.</p><p>End {i}</p></div></div><div class=sidebar><p>Links {i}</p></div>"
    pages = spark.createDataFrame([(i, "http://one.net/x", page(body(i))) for i in range(6)], "page_id long, url string, html string")
    paths = {r.host: r.path for r in html.infer_wrappers(html.hosts(pages)).collect()}
    assert paths["one.net"].endswith("div[class=story]")
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got == {i: f"Story {i} begins here and goes on {i}.\n\nEnd {i}" for i in range(6)}


STORY = "The story of page {0} tells of {0} things at some length, and of {0} more that follow it here."
TEASERS = "<article class=card><p>Teaser {0}</p></article><article class=card><p>Read {0}</p></article>"
PLACED = {
    "varying.org": ("<article class='post tag-{1}' id=post-{1}><p>" + STORY + "</p></article>" + TEASERS, [STORY]),
    "slugs.org": (TEASERS + "<div class=cat-{1}><article id=x{1}><p>" + STORY + "</p></article></div>", [STORY]),
    "main.org": ("<main><p>" + STORY + "</p></main><section>" + TEASERS + "</section>", [STORY]),
    "two.org": ("<article class=news><p>" + STORY + "</p></article><article class=report><p>And " + STORY + "</p></article>", [STORY, "And " + STORY]),
    "list.org": ("<main><article><p>" + STORY + "</p></article><article><p>And " + STORY + "</p></article></main>", [STORY, "And " + STORY]),
    "teasers.org": ("<div class=story><h2>" + STORY + "</h2><p>" + STORY * 9 + "</p></div>" + TEASERS, [STORY, STORY * 9]),
}


def test_main_text_is_placed_by_what_slots_hold(spark):
    rows, want = [], {}
    for host, (body, blocks) in PLACED.items():
        for i in range(12):
            slug = "abcdefghijkl"[i] * 3
            rows.append((len(rows), f"http://{host}/{i}", page(body.format(i, slug))))
            want[len(want)] = "\n\n".join(blocks).format(i, slug)
    rows.append((len(rows), "http://alone.org/", page(PLACED["main.org"][0].format(1, "x"))))
    want[len(want)] = STORY.format(1)
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_a_wide_wrapper_forgets_no_text():
    # Odd children first, all on one page each: the article is the last of too many.
    pages = ["".join(f"<x-{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}{'klm'[k // 100]}>{k}</x-{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}{'klm'[k // 100]}>" for k in range(300)) + f"<article class=c{i}><p>{STORY.format(i)}</p></article>" for i in "pq"]
    wrapper = html.align(html.page_wrapper(pages[0]), html.page_wrapper(pages[1]))
    assert "article" in html.main_path(wrapper)


def test_wrapper_alignment():
    a, b = html.page_wrapper("<div><h1>x</h1><p>a</p><p>b</p></div>"), html.page_wrapper("<div><h1>y</h1><img><p>a</p></div>")
    [div] = html.align(a, b)
    assert [(c[0], c[1]) for c in div[3]] == [("h1", "1"), ("img", "?"), ("p", "+")]
    assert div[3][0][3][0][1] is None  # a slot: the headings differ
    terms = html.page_wrapper("<dl>" + "<dt>k</dt><dd>v</dd>" * 3 + "</dl>")[0][3]
    assert [(c[0], c[1]) for c in terms] == [("dt", "+"), ("dd", "+")]


def test_html_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (2, "http://x.org", ""), (3, "bad", "just text"), (None, "http://x.org", page("<article>z</article>")), (4, "http://x.org", "<p>unclosed <b"), (5, "http://x.org", page("<article><p>" + LONG + "</article>")), (6, "http://x.org", "<a href=\"q" + " x" * 2000)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == 8 and text[1] == "" and text[2] == "" and text[3] == "just text" and text[None] == "z"
    assert text[5] == " ".join(LONG.split()) and text[4].startswith("unclosed")
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_on_the_pages_table(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    for r in pages.collect():
        article = re.search("(?s)<article>(.*?)</article>", r.html)[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_html_of_any_depth_and_unclosed_tags(spark):
    deep = page("<article>" + "<div>" * 5000 + "<p>Deep</p>" + "</div>" * 5000 + "<p>after</p></article>")
    other = page("<article>" + "<div>" * 4000 + "<p>Deeper</p></article>")
    open_ = page("<article><p>One</p>" + "<svg>" * 100_000 + "<p>Two</p>" + "<svg " * 100_000 + "</article>")
    rows = [(1, "http://d.org/1", deep), (2, "http://d.org/2", other), (3, "http://d.org/3", page("<article><p>Flat</p></article>")), (4, "http://u.org/", open_)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "Deep\n\nafter", 2: "Deeper", 3: "Flat", 4: "One\n\nTwo"}


@pytest.mark.parametrize("junk", ["<a href='", "<!-", "<p>" + "</i>", "<b><p>", "<a \"'", "<", "<script"])
def test_html_takes_linear_time(junk):
    started = time.monotonic()
    html.main_text("<body><p>x" + junk * 30_000, "")
    assert time.monotonic() - started < 20


def test_a_wrapper_survives_its_text_form():
    wrapper = html.align(html.page_wrapper(page(CASES[0][0])), html.page_wrapper(page(CASES[2][0])))
    assert html.loads(html.dumps(wrapper)) == wrapper and html.loads(html.dumps([])) == []


def words(n, i):
    return " ".join(f"w{k * (i + 3) % 101}n{i}" for k in range(n))


def test_main_text_does_not_depend_on_lengths(spark):
    hosts = {
        # Two articles of different class, one short; a long main text beside a short one.
        "pair.org": lambda i: ("<article class=story><p>" + words(400, i) + "</p></article><article class=brief><p>" + words(6, i) + "</p></article>", [words(400, i), words(6, i)]),
        # A list page of one class: all of them, with the heading that varies.
        "index.org": lambda i: (f"<main><h1>Page {i}</h1>" + "".join(f"<article><h2>{words(3, i + k)}</h2><p>{words(9 * k + 2, i)}</p></article>" for k in range(3)) + "</main>", [f"Page {i}"] + [t for k in range(3) for t in (words(3, i + k), words(9 * k + 2, i))]),
        # Teasers longer than the article.
        "loud.org": lambda i: ("<article class=post><p>" + words(5, i) + "</p></article>" + ("<article class=teaser><p>" + words(90, i) + "</p></article>") * 3, [words(5, i)]),
        # No article: paragraphs in two containers, the second one short.
        "plain.org": lambda i: ("<div class=body><div class=first><p>" + words(200, i) + "</p></div><div class=second><p>" + words(4, i) + "</p></div></div>", [words(200, i), words(4, i)]),
    }
    rows, want = [], {}
    for host, make in hosts.items():
        for i in range(6):
            body, blocks = make(i)
            want[len(rows)] = "\n\n".join(blocks)
            rows.append((len(rows), f"http://{host}/{i}", page(body)))
    # Pages without a host share no wrapper.
    for body, text in (("<article><p>alpha</p></article>", "alpha"), ("<div><p>beta</p></div>", "beta"), ("<main><p>gamma</p></main>", "gamma")):
        want[len(rows)] = text
        rows.append((len(rows), None, page(body)))
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


# ------------------------------------------------------------------ top-k


def brute_top(rows, k, every, scale=256):
    good = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % every == 0:
            found = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v)))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize(("blocks", "size"), [((4096, 2048), 1.0), ((3, 7), 1.0), ((3, 7), 1e6), ((4, 9), 1e3)])
def test_top_k_against_brute_force(spark, monkeypatch, blocks, size):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
    monkeypatch.setattr(topk, "FEW", 0.0)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in np.float32(rng.normal(0, size, 8))]) for i in range(90)]
    rows += [(200 + i, rows[5][1]) for i in range(6)]  # ties
    rows += [(300, None), (301, []), (302, [None] * 8), (303, [float("nan")] * 8), (304, [float("inf")] + [0.0] * 7), (None, rows[0][1])]
    rows += [(310, [1.0, 2.0]), (311, [0.5, -1.0]), (320, [0.25])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("row", "v", "rank", "gq")})
    got = topk.top_k(frame, F.col("vec_id") % 10 == 0, 5)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute_top(rows, 5, 10)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 10 == 0, 5).count() == 0


def test_top_k_beyond_a_long(spark):
    frame = spark.createDataFrame([(0, [1e12]), (1, [1e12]), (2, [-1e12]), (3, [1e300])], "vec_id long, embedding array<double>")
    got = topk.top_k(frame, F.col("vec_id") == 0, 5).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 2**63 - 1), (3, 2**63 - 1), (2, 1 - 2**63)]


def test_bounds_enclose_the_scores():
    rng = np.random.default_rng(8)
    c, q = rng.integers(-50, 50, (200, 16)).astype(np.float64), rng.integers(-50, 50, (9, 16)).astype(np.float64)
    lists = topk.Lists(c)
    for i in range(len(topk.DEPTHS)):
        lower, upper = lists.bounds(q, i)
        assert (lower <= q @ c.T + 1e-9).all() and (upper >= q @ c.T - 1e-9).all()


