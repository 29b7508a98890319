"""Sharding, URL filter, quality rules and HTML extraction on edge cases, against plain versions."""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ROWS, tuples
from zonelake.llm import html_text, quality, sharding, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- sharding


def test_lpt_counts_is_the_plain_heap():
    for shards, sizes in [(3, [9, 7, 7, 5, 5, 5, 1, 1, 1, 1]), (8, [1000] + [10] * 500 + [1] * 77), (2, []), (1, [4, 4, 2]), (4, [3])]:
        heap, plain = [(0, s) for s in range(shards)], [0] * shards
        for size in sizes:
            load, s = heapq.heappop(heap)
            plain[s] = load + size
            heapq.heappush(heap, (load + size, s))
        classes = sorted(Counter(sizes).items(), reverse=True)
        loads = [sum(size * c[s] for (size, _), c in zip(classes, sharding.lpt_counts(classes, shards))) for s in range(shards)]
        assert sorted(loads) == sorted(plain)


def check_shards(frame, rows, shards):
    got = frame.collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=str
    )
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {r.law for r in got} <= {"bytes"} and {r.grown_shard for r in got} <= {None}
    homes = {}
    for r in got:
        assert homes.setdefault((r["size"], r.text_crc32), r.shard) == r.shard
    return [sum(r["size"] for r in got if r.shard == s) for s in range(shards)]


def test_shards_edge(edge, none):
    check_shards(sharding.shard_documents(edge, 3), ROWS, 3)
    assert sharding.shard_documents(none, 3).collect() == []


def test_shards_near_equal(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    loads = check_shards(sharding.shard_documents(docs, 4), rows, 4)
    assert max(loads) - min(loads) <= max(len(t.encode()) + 1 for _, t in rows)


# --- URLs


def plain_verdict(host, path, rules):
    fits = [(len(h) + len(p), len(h), a == "block", h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else (None, "allow")


def test_trie_is_the_plain_scan():
    rules = [*urls.RULES, ("block", "a.org", "/x/y"), ("allow", "a.org", "/x/y/z/"), ("block", "org", "/x"), ("allow", "b.a.org", "/"), ("block", "b.a.org", "/")]
    trie = urls.build_trie(rules)
    for host in ("org", "a.org", "b.a.org", "xorg", "example.org", "m.example.org", "x.com", "com", "", ".org", "org."):
        for path in ("", "/", "/x", "/xy", "/x/y", "/x/yy", "/x/y/z", "/x/y/z/", "/es/", "/es", "/en/1", "/en/12/3", "/en/2", "/fr/q", "/de/", "//", "/x//"):
            assert (urls.match(trie, host, path) or (None, "allow")) == plain_verdict(host, path, rules), (host, path)


def test_split_url():
    for url, parts in {
        None: ("", ""), "": ("", ""), "no scheme/x": ("", ""), "HTTP://ExÄmple.Org/A?b#c": ("exÄmple.org", "/A"), "x://h": ("h", ""), "x://h?q/": ("h", ""),
        "x://h#f": ("h", ""), "x://": ("", ""), "a://b://c/d": ("b:", "//c/d"), "x://h/p#q?r": ("h", "/p"), "x://h:80/": ("h:80", "/"),
    }.items():
        assert urls.split_url(url) == parts, url


def test_urls_edge(spark):
    rows = [(1, None), (1, "http://example.org/es/1"), (1, "http://example.org/es/1"), (None, "http://A.com/de/"), (2, "x"), (3, "http://" + "a." * 5000 + "org/" + "x/" * 5000)]
    pages = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in rows], "page_id long, url string, host string, rule string, _j string")
    got = urls.filter_urls(pages).collect()
    want = []
    for i, u in rows:
        host, path = urls.split_url(u)
        want.append((i, host, path, *plain_verdict(host, path, urls.RULES)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert urls.filter_urls(pages.limit(0)).collect() == []
    assert {r.verdict for r in urls.filter_urls(pages, [], "block").collect()} == {"block"}
    with pytest.raises(ValueError):
        urls.build_trie([("maybe", "org", "/")])


# --- quality


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {p for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    kept = [line for line in (text or "").split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(kept) - len(set(kept)), len(covered)


def test_counts_edge(edge, none, spark):
    labels = spark.createDataFrame([(0, 1, 0), (None, 1, 0), (99, None, None)], "doc_id long, quality int, toxic int")
    got = tuples(quality.judge_quality(edge, labels), "doc_id", *quality.COUNTS, "base_failed", "kept")
    want = []
    for i, t in ROWS:
        c = plain_counts(t)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        want.append((i, *c, failed, not failed))  # too few labels for any cutoff
    assert got == sorted(want, key=lambda t: tuple((v is not None, v) for v in t))
    assert quality.judge_quality(none, labels).collect() == []
    assert quality.judge_quality(edge, labels.limit(0)).count() == len(ROWS)
    kept = quality.judge_quality(edge, labels, keep={"_row": F.struct("source", "n_words")})
    assert kept.count() == len(ROWS) and "_row" in kept.columns


def tail(k, n, p):
    """P(X <= k), X binomial."""
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))


def test_cutoffs_are_the_exact_test(spark):
    """Symbols per word of 0 to 199 hundredths in two strata; the cutoffs follow from the binomial tail."""
    n, risk, delta = 4000, 0.08, 0.05
    rows = [(s * n + i, f"s{s}", 100, 500, ((i * 7919) % 1000) // 5 if i % 40 < (2, 1)[s] else 0, 0, 0, 10, 0) for s in (0, 1) for i in range(n)]
    counts = spark.createDataFrame(rows, "_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long")
    labels = counts.select("_id", F.lit(True).alias("good"))
    got = {(r.stratum, r.rule): r.cutoff for r in quality.calibrate(counts, labels, risk, delta).collect()}
    rules = quality.RULES
    for s in ("s0", "s1"):
        for rule, (num, den, cutoffs) in rules.items():
            best = None
            for c in cutoffs:
                at = {"n_symbols": 4, "n_dup_lines": 5, "n_repeat_words": 6, "n_capitals": 8, "n_words": 2, "n_lines": 7, "word_chars": 3}
                k = sum(100 * r[at[num]] > c * r[at[den]] for r in rows if r[1] == s)
                if tail(k, n, risk / len(rules)) > delta / (2 * len(rules)):
                    break
                best = c
            assert got.get((s, rule)) == best, (s, rule)
    assert got[("s0", "symbols")] > got[("s1", "symbols")] > 10  # the test decides, not the end of the list


def test_joint_cutoffs(spark):
    """437 good documents suffice for a stratum of four; smaller strata (one without labels) take the pooled vector; one that fails its own test has none."""
    base = (100, 500, 0, 0, 0, 10, 0)
    sizes = {"a": 437, "b": 436, "c": 1000, "d": 0}
    rows = [(f"{s}{i}", s, *base) for s, n in sizes.items() for i in range(max(n, 1))]
    rows += [(f"short{i}", "a", 10, 50, 40, 0, 0, 10, 0) for i in range(300)]  # fail the base rule, so prove nothing
    rows = [(i, s, 100, 500, 300, 0, 0, 10, 0) if s == "c" and int(i[1:]) < 60 else (i, s, *r) for i, s, *r in rows]
    counts = spark.createDataFrame(rows, "_id string, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long")
    labels = counts.filter("stratum <> 'd'").select("_id", F.lit(True).alias("good"))
    strict, at = {rule: cutoffs[-1] for rule, (_, _, cutoffs) in quality.RULES.items()}, lambda got, s: {r.rule: r.cutoff for r in got if r.stratum == s}
    assert quality.JOINT[-1] == strict and all(a[rule] >= b[rule] for a, b in zip(quality.JOINT, quality.JOINT[1:]) for rule in strict)
    got = quality.calibrate_jointly(counts, labels).collect()
    assert at(got, "a") == strict and not at(got, "c")
    assert not at(got, "b") and not at(got, "d")  # 60 of 1,873 pooled fail every vector
    got = quality.calibrate_jointly(counts.filter("stratum <> 'c' OR n_symbols = 0"), labels).collect()
    assert all(at(got, s) == strict for s in sizes)
    assert quality.calibrate_jointly(counts.filter("stratum = 'b'").limit(200), labels).collect() == []


def test_quality_stage_drops_junk_of_small_strata(spark, tmp_path):
    """The pipeline's stage drops symbol junk in a middling stratum and in one of few labels."""
    import corpus_pipeline

    text = lambda i, mark: " ".join(f"w{i}x{k}{mark if k % 2 else ''}" for k in range(60))
    rows = [(i, text(i, ""), "en" if i % 50 else "es") for i in range(600)] + [(1000 + i, text(i, "#"), "en" if i % 2 else "es") for i in range(20)]
    docs = spark.createDataFrame([(i, t, s, "x", len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, 1, 0) for i in range(600)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(600))


# --- HTML


PAGE = (
    "<!DOCTYPE html><html><head><title>T&amp;x</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>a{0}</a><li><a>b</a></ul></nav>"
    "<!-- ad --><div class='ad'>buy {0}</div><article><h1>Head {0}</h1><p><b>One &lt;two&gt;.<br><p>  three\n four &amp;&nbsp;five </p>{1}"
    "<div class='comments'><p>me too</p></div></article><aside>side</aside><form>f <input></form><footer>&copy; {0}</footer>"
)


def test_html_wrapper():
    pages = [PAGE.format(i, "<p>more</p>" * i) for i in range(5)]
    wrapper = html_text.infer(pages)
    text = html_text.expression(wrapper)
    assert "( <li>" in text and ")+" in text and "#TEXT" in text
    how = html_text.plan(wrapper, 5)
    assert how["main"] == "html/body/article"
    for i, page in enumerate(pages):
        assert html_text.extract(page, how) == "\n\n".join([f"Head {i}", "One <two>.", "three four & five", *["more"] * i])
    assert html_text.extract("<p>other</p>", how) == "other"


def test_html_template_outside_articles():
    """Without an article: menus by links and texts that no page changes go, the rest stays."""
    pages = [f"<body><ul class=x><li><a href=1>one</a><li><a>two{i}</a></ul><div>Always the same</div><div class=t><p>text {i} of the page</p><p>and {i * i}</p></div></body>" for i in range(4)]
    how = html_text.plan(html_text.infer(pages), 4)
    assert html_text.extract(pages[2], how) == "text 2 of the page\n\nand 4"
    assert "Always" in html_text.extract(pages[2], html_text.plan(html_text.infer(pages[:2]), 2))  # two pages prove nothing


def test_html_odd_input():
    for page in ("", None, "<", "<p", "</", "<>", "<!--", "<p a='", "<a" * 1000, "<div>" * 3000 + "deep", "&#xffffffff; &bad; &am", "<script>x", "\x00"):
        assert isinstance(html_text.extract(page, None), str)
    assert html_text.extract("<div>" * 3000 + "deep", None) == "deep"
    assert html_text.extract("a<br>b <p>c<p>d", None) == "a b\n\nc\n\nd"


def test_html_edge(spark):
    rows = [(1, "http://h.org/1", PAGE.format(1, "")), (1, "http://h.org/1", PAGE.format(1, "")), (2, None, PAGE.format(2, "")), (None, "http://h.org/3", None), (3, "bad", ""), (4, "http://H.org/x", "<p>" + "long " * 200_000)]
    frame = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, host string, pick int")
    got = tuples(html_text.main_text(frame), "page_id", "url", "n_chars")
    size = {1: len("Head 1\n\nOne <two>.\n\nthree four & five"), 4: 5 * 200_000 - 1, 2: len("Head 2\n\nOne <two>.\n\nthree four & five")}
    assert got == sorted([(i, u, size.get(i, 0)) for i, u, _ in rows], key=lambda t: tuple((v is not None, v) for v in t))
    assert html_text.main_text(frame.limit(0)).collect() == []


def test_html_joined_plans(spark, sf, monkeypatch):
    """Plans too many to broadcast are joined; the texts are the same."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = tuples(html_text.main_text(pages), "page_id", "text")
    monkeypatch.setattr(html_text, "MAX_PLANS", -1)
    assert tuples(html_text.main_text(pages), "page_id", "text") == want
    assert all(text for _, text in want)


def test_html_every_page_counts(spark):
    """A rare second template of a large host is known, and its pages have a main path of their own."""
    teaser = "<body><article><p>short {0}</p></article><div class=post><p>long text {0} " + "of the post " * 30 + "</p></div><div class=end>Rare notice</div></body>"
    plain = "<body><div class=a><p>page {0} has a text</p></div><div class=end>Usual notice</div></body>"
    other = "<body><div class=a><p>page {0} has a text</p><h2>part {0}</h2></div><section class=z><p>Rare line</p></section></body>"
    rows = [(i, f"http://big.org/{i}", (teaser if i % 50 == 7 else other if i % 50 == 9 else plain).format(i)) for i in range(500)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    for i, _, _ in rows:
        post = f"long text {i} " + "of the post " * 30
        assert got[i] == (post.strip() if i % 50 == 7 else f"page {i} has a text" + f"\n\npart {i}" * (i % 50 == 9)), i


def test_html_copies_prove_nothing(spark):
    page = "<body><div class=a><p>the same words</p></div><div class=b>and these</div></body>"
    frame = spark.createDataFrame([(i, f"http://h.org/{i}", page) for i in range(20)], "page_id long, url string, html string").repartition(4)
    assert {r.text for r in html_text.main_text(frame).collect()} == {"the same words\n\nand these"}


def test_html_marks_do_not_decide_alone():
    """A marked element around the page's article, or most of its text, is read; other marked ones are not."""
    article = "<article><h1>Head</h1><p>main text of the page</p></article>"
    comments = "<div class='comments'><article class='comment'><p>a much longer comment than the text of the page itself is</p></article></div>"
    for mark in ("layout has-sidebar", "with-banner", "menu-open", "social-history", "no-comments"):
        assert html_text.extract(f"<body><div class='{mark}'>{article}<div class='share'>share</div>{comments}</div></body>", None) == "Head\n\nmain text of the page", mark
    titled = f"<body><main><h1>T</h1><div class='layout has-sidebar'>{article.replace('main text', 'main text ' * 9)}</div></main></body>"
    assert "main text of the page" in html_text.extract(titled, None)
    assert html_text.extract(f"<body>{article}{comments}</body>", None) == "Head\n\nmain text of the page"
    assert html_text.extract("<body><div class='menu-open'><p>all of the text is in here</p></div><div class='share'>share</div></body>", None) == "all of the text is in here"
    assert html_text.extract("<body><p>the text of this page</p><div class='comments'><p>me too</p></div></body>", None) == "the text of this page"


def test_html_template_in_articles(spark):
    """A line that stands in the article of every page of a host goes, a line of some pages stays."""
    page = "<body><article><h1>Head {0}</h1><p>text {0}</p>{1}<p>Subscribe to our letter</p><section class=discussion><p>Join in</p></section></article></body>"
    rows = [(i, f"http://h.org/{i}", page.format(i, "<p>rare line</p>" * (i % 5 == 0))) for i in range(20)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {i: f"Head {i}\n\ntext {i}" + "\n\nrare line" * (i % 5 == 0) for i in range(20)}


def _made_up_pages() -> list[tuple[int, str, str, str]]:
    """(page_id, url, html, main text) of two hosts: template lines in articles, a second layout, comments of readers, a forum."""
    who = ["Ann", "Bo", "Cy", "Di", "Ed"]

    def comments(i: int, n: int, member: str) -> str:
        return "".join(member.format(who=who[(i + k) % 5], at=f"{(i + k) % 24}:0{k % 9}", say=f"I say {i} and {k} " * (1 + k % 3)) for k in range(n))

    listed = "<li><span class=author>{who}</span> <time>{at}</time><p>{say}</p></li>"
    nested = "<article><footer><p class=byline>{who}</p></footer><p>{say}</p></article>"
    post = "<div class=post><b class=user>{who}</b> <time>{at}</time><p>{say}</p></div>"
    out = []
    for i in range(60):
        url = f"http://{'news' if i % 2 else 'blog'}.org/{i}"
        n = i % 5
        words = f"the text of article {i} " + "goes on " * (5 + i % 7)
        text = f"Head {i}\n\n{words.strip()}"
        head = f"<h1>Head {i}</h1><p>{words}</p>"
        if i % 2:  # a line of every page, comments in a list (none, one or several)
            more = f"<section class=discussion><h2>{n} answers</h2><ol class=x>{comments(i, n, listed)}</ol></section>" if n else ""
            page = f"<body><div class=top>News of the day</div><article>{head}<p>Read our letter</p>{more}</article></body>"
        elif i % 10 != 4:  # nested articles beside the article of a main element
            more = f"<div class=responses>{comments(i, n + 1, nested)}</div>"
            page = f"<body><main><article>{head}</article>{more}</main></body>"
        else:  # a second layout: a forum, whose members are the main text
            page = f"<body><main><h1>Thread {i}</h1>{comments(i, 3, post)}</main></body>"
            text = f"Thread {i}\n\n" + "\n\n".join(f"{who[(i + k) % 5]} {(i + k) % 24}:0{k}\n\n" + (f"I say {i} and {k} " * (1 + k % 3)).strip() for k in range(3))
        out.append((i, url, page, text))
    return out


def test_html_wrapper_decides_on_made_up_hosts(spark):
    """Every text is the page's own main text; 37 of the 60 pages, read alone, give another one (all 30 with the template line, 7 with longer answers than text)."""
    pages = _made_up_pages()
    frame = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in html_text.main_text(frame).collect()}
    assert got == {i: text for i, _, _, text in pages}
    assert sum(html_text.extract(page, None) != text for _, _, page, text in pages) == 37


def test_html_comments_need_persons_and_dates():
    """Lists of an article without persons or dates of their own are main text; so is a page of nothing but such groups."""
    item = "<li><b>{0}</b> <time>{0}:00</time><p>news {0}</p></li>"
    live = "<article><p>all day long the news of this day</p><ul>" + "".join(map(item.format, range(4))) + "</ul></article>"
    assert "news 3" in html_text.extract(f"<body>{live}</body>", None)
    signed = live.replace("<b>", "<b class=author>")
    assert html_text.extract(f"<body>{signed}</body>", None) == "all day long the news of this day"
    assert "news 3" in html_text.extract(f"<body>{signed.replace('<p>all day long the news of this day</p>', '')}</body>", None)
    for mark in ("commentlist", "user-comments", "commentarea"):
        assert html_text.extract(f"<body><article><p>text of it</p><ol class='{mark}'><li>me</li></ol></article></body>", None) == "text of it"
    assert html_text.extract("<body><article><p>text of it</p><div class=commentary>and more</div></article></body>", None) == "text of it\n\nand more"
