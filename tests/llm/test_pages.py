"""URL rules, page text, languages and licences on odd inputs and against brute force."""

import html
import math
import random
import re
import time
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telemill.llm import html_text, language, licenses, url_filter
from telemill.llm.queries import QUERIES
from tests.oracle import DATA

URLS = [
    None, "", "no scheme", "http://", "://", "http://com", "http://com/", "http://example.com/en/x",
    "HTTP://WWW.Example.COM/en/x?y#z", "http://www.example.com/en", "http://xexample.com/en/a",
    "http://a.b.example.com/en/", "http://net/es/", "http://q.net/fr/?a://b", "http://q.net/frx",
    "http://com?://net/es/", "a://b://c", "http://example.com#/en/", "http://É.com/É", "http://a,b.com/",
    "http://.com/", "http://com./", "http://a..com/", "http://example.com/en/é\nx",
]
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"), ("a,b.com", "", "block"),
    ("com", "/", "block"), ("com", "/en/ex", "block"), (None, "/", "block"), ("b.example.com", "", "deny"),
]


def judged(url, rules, default="allow"):
    rest = (url or "").partition("://")[2]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h) + len(p), len(h), h + p, v) for h, p, v in rules
        if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, default
    best = max(fits, key=lambda f: f[:2])
    verdict = min(f[3] for f in fits if f[:3] == best[:3])
    return host, path, best[2], verdict


def test_rules_on_odd_urls(spark):
    urls = URLS * 30  # repeated rows, spread over many ranges
    rows = [(i, url, "clash", 1) for i, url in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, key string, range int")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = {row[0]: tuple(row)[1:] for row in url_filter.judge_urls(pages, rules).collect()}
    assert found == {i: judged(url, RULES) for i, url in enumerate(urls)}
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert url_filter.judge_urls(pages, rules.limit(0)).filter("rule IS NULL").count() == len(urls)


LABELS = st.sampled_from(["a", "b", "ab", "c"])
HOSTS = st.lists(LABELS, min_size=1, max_size=4).map(".".join)
PATHS = st.sampled_from(["", "/", "/a", "/a/", "/a/b", "/b"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(HOSTS, PATHS), max_size=80), st.lists(st.tuples(HOSTS, PATHS), max_size=25))
def test_rules_against_brute_force(spark, urls, rules):
    given_rules = [(h, p, "block") for h, p in rules]
    pages = spark.createDataFrame(
        [(i, f"x://{h}{p}") for i, (h, p) in enumerate(urls)], "page_id bigint, url string"
    )
    frame = spark.createDataFrame(given_rules, "host string, path string, verdict string")
    for row in url_filter.judge_urls(pages, frame).collect():
        host, path, rule, verdict = judged(f"x://{urls[row[0]][0]}{urls[row[0]][1]}", given_rules)
        # Equally long rules may differ in their host.
        assert (row["host"], row["path"], row["verdict"]) == (host, path, verdict)
        assert (row["rule"] and len(row["rule"])) == (rule and len(rule))


def article_of(page):
    """What a page of the given template says, by its markers."""
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    blocks = re.split("</?p>|</?h1>", inner)
    texts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", block)).split()) for block in blocks]
    return "\n".join(text for text in texts if text)


def test_page_text_query(spark):
    pages = {p["page_id"]: p for p in pq.read_table(f"{DATA}/pages.parquet").to_pylist()}
    rows = QUERIES["op8_html_extraction"](spark, DATA).collect()
    assert len(rows) == len(pages)
    for row in rows:
        page = pages[row["page_id"]]
        assert row["text"] == article_of(page["html"])
        assert (row["url"], row["n_chars"]) == (page["url"], len(row["text"]))


LONG = "A sentence that is long enough to be the text of a page, and then some more. " * 4
ODD_PAGES = {
    "": "",
    "<p>": "",
    "plain &amp text &lt;b&gt; &#233;": "plain & text <b> é",
    f"<body><div class='sidebar'>{LONG}{LONG}</div><div id=main><p>{LONG}<p>b<br>c</div>":
        f"{LONG.strip()}\nb c",
    f"<div class='wrap has-sidebar'><p>{LONG}</p><form>f</form><div class=comments>x</div></div>":
        LONG.strip(),
    f"<main><header>h</header><ul><li>{LONG}<li>two</ul><table><tr><td>x<td>y</table></main>":
        f"{LONG.strip()}\ntwo\nx\ny",
    f"<script>var a='<p>no</p>'</script><p>{LONG}<script>open": LONG.strip(),
    f"<p title=\"a>b\">{LONG}</p><!-- no <p> --><p role=alert>no</p>": LONG.strip(),
    "<nav>only a menu</nav>": "",
    "<" * 500 + "a": "<" * 500 + "a",
    "<div>" * 2000 + "deep": "deep",
}


def test_odd_pages(spark):
    rows = [(i, f"http://h{i}.org/", page, "x") for i, page in enumerate(ODD_PAGES)]
    rows += [(100, None, None, "x"), (101, "no host", f"<p>{LONG}", "x"), (102, None, "<p>x", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    found = {row["page_id"]: row["text"] for row in html_text.main_text(pages).collect()}
    expected = dict(enumerate(ODD_PAGES.values())) | {100: "", 101: LONG.strip(), 102: "x"}
    assert found == expected
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_a_host_agrees_on_a_path(spark):
    """A page whose longest part is no text follows the other pages of its host."""
    page = "<body><div class='c{}'><p>{}</p></div><div class='x'>{}</div></body>"
    rows = [(i, "http://h/", page.format(i, LONG, "short")) for i in range(9)]
    rows.append((9, "http://h/", page.format(9, "A brief note.", LONG)))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {row["page_id"]: row["text"] for row in html_text.main_text(pages).collect()}
    assert found[9] == "A brief note." and found[0] == LONG.strip()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<p>", "</p>", "<div>", "</div>", "<a href=x>", "</a>", "x", " ", "<", ">", "&", "&lt", "<!--",
     "-->", "<script>", "</script>", "<br/>", "<td", "'", '"', "<li>", "</ul>", "é"]), max_size=30))
def test_any_markup_is_read(parts):
    blocks = html_text.blocks_of("".join(parts))
    assert all(block.text == " ".join(block.text.split()) != "" for block in blocks)


def test_language_query(spark):
    docs = {d["doc_id"]: d for d in pq.read_table(f"{DATA}/documents.parquet").to_pylist()}
    rows = QUERIES["op9_language_id"](spark, DATA).collect()
    assert len(rows) == len(docs)
    right = total = 0
    for row in rows:
        doc = docs[row["doc_id"]]
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
        if row["held_out"] and doc["lang"]:
            total += 1
            right += row["lang_pred"] == doc["lang"]
    assert total > 30 and right >= 0.98 * total


def test_languages_of_odd_texts(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"),
            (4, "", "de"), (5, "12 34 !?", "en"), (6, "the dog", None), (7, "die Katze " * 100_000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.train(docs)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, model).collect()}
    assert {k: v[0] for k, v in found.items()} == {
        1: "en", 2: "de", 3: "und", 4: "und", 5: "und", 6: "en", 7: "de"}
    assert found[3][1] == 0 and 0.5 < found[1][1] <= 1
    untaught = language.train(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, untaught).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_counts_of_the_model_are_those_of_all_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("text", "lang")
    model = language.train(docs.repartition(7))
    again = language.train(docs.coalesce(1))
    assert model.languages == again.languages
    assert (model.weights == again.weights).all() and (model.priors == again.priors).all()


def test_stretches_hold_all_ngrams(monkeypatch):
    text = "abcdefghij" * 5
    whole = sum(len(found) for found, _ in language.features([text, "", "x"]))
    assert whole == 3 * (52 + 2 + 3) - 3 * 3
    monkeypatch.setattr(language, "STRETCH", 10)
    parts = list(language.features([text, "", "x"]))
    assert {int(o) for _, owners in parts for o in owners} == {0, 1, 2}
    # A seam adds no n-gram and loses none.
    assert sum(len(found) for found, _ in parts) == whole


def grams_of(text):
    """Buckets of a text's n-grams, one by one."""
    points = [32 if 9 <= ord(c) <= 13 else ord(c) for c in f" {text.lower()} "]
    for order in (1, 2, 3):
        for k in range(len(points) - order + 1):
            h = 0
            for point in points[k : k + order]:
                h = (h * 0x9E3779B97F4A7C15 + point) % 2**64
            h = (h + order) * 0xBF58476D1CE4E5B9 % 2**64
            h ^= h >> 29
            yield (h * 0x9E3779B97F4A7C15 % 2**64 >> 40) % language.BUCKETS


@pytest.mark.parametrize("stretch", [1 << 19, 7])
def test_ngrams_one_by_one(monkeypatch, stretch):
    monkeypatch.setattr(language, "STRETCH", stretch)
    texts = ["", "a", "Straße İstanbul ΣΑΣ", "x\ty\nz", "one two three four", "é" * 30]
    found = {i: [] for i in range(len(texts))}
    for buckets, owners in language.features(texts):
        for bucket, owner in zip(buckets.tolist(), owners.tolist()):
            found[owner].append(bucket)
    assert {i: sorted(own) for i, own in found.items()} == {
        i: sorted(grams_of(text)) for i, text in enumerate(texts)}


def test_language_by_force(spark):
    """Predictions and scores from counts in plain dictionaries."""
    docs = [d for d in pq.read_table(f"{DATA}/documents.parquet").to_pylist() if len(d["text"]) < 3000]
    learned, asked = docs[::2], docs[1::2]
    counts, n = {}, Counter(d["lang"] for d in learned)
    for d in learned:
        counts.setdefault(d["lang"], Counter()).update(grams_of(d["text"]))
    totals = {lang: sum(own.values()) + language.BUCKETS for lang, own in counts.items()}
    prior = {lang: math.log(n[lang] / len(learned)) for lang in counts}
    schema = "doc_id bigint, text string, lang string"
    frame = lambda rows: spark.createDataFrame([(d["doc_id"], d["text"], d["lang"]) for d in rows], schema)
    rows = language.identify(frame(asked), language.train(frame(learned))).collect()
    found = {row["doc_id"]: (row["lang_pred"], row["score"]) for row in rows}
    for d in asked:
        grams = list(grams_of(d["text"]))
        sums = {lang: sum(math.log((own[g] + 1) / totals[lang]) for g in grams) for lang, own in counts.items()}
        scaled = {lang: sums[lang] * min(1, 100 / len(grams)) + prior[lang] for lang in sums}
        best = max(sorted(sums), key=lambda lang: sums[lang] + prior[lang])
        top = max(scaled.values())
        score = math.exp(scaled[best] - top) / sum(math.exp(x - top) for x in scaled.values())
        assert found[d["doc_id"]][0] == best
        assert found[d["doc_id"]][1] == pytest.approx(score, abs=1e-3)


def dice_by_force(text):
    units = {text, *re.split(r"\n[ \t]*\n", text), *text.split("\n")}
    best, n = None, set()
    for name, body in licenses.TEMPLATES:
        b = licenses.bigrams(body)
        for unit in units:
            a = licenses.bigrams(unit)
            dice = 2 * len(a & b) / (len(a) + len(b))
            if dice >= 0.8:
                n.add(unit)
                best = min(best or (0, ""), (-dice, name))
    return (best[1], -best[0], len(n)) if best else (None, None, 0)


def test_licences_of_odd_texts(spark):
    mit, isc = licenses.TEXTS["MIT"], licenses.TEXTS["ISC"]
    texts = [None, "", "MIT", "prose\nReleased under the MIT License.\nprose", mit, mit.upper(),
             mit.replace("any person", "each body"), f"{isc}\n\n{mit}", "Licensed under CC BY 4.0!",
             "x " * 50_000, "licensed under " * 200, "released UNDER the mit licence",
             "Released under the MIT License.", "a b\n\n \n\nLicensed under\nCC BY-SA 4.0"]
    rows = [(i, text, "clash", 0.0) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, license string, dice double")
    for row in licenses.scan_licenses(docs).collect():
        name, dice, n = dice_by_force(texts[row["doc_id"]] or "")
        assert (row["license"], row["n_units"]) == (name, n)
        assert row["dice"] == (pytest.approx(dice) if dice else None)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    assert licenses.scan_licenses(docs, []).filter("license IS NULL").count() == len(texts)


def test_licences_inside_larger_texts(spark):
    """Texts in their usual layout and notices within a line, with other text around them."""
    prose = " ".join(f"Some word{i} of a story{i} that goes{i} on." for i in range(200))
    mit, isc = licenses.TEXTS["MIT"], licenses.TEXTS["ISC"]
    laid_out = mit.replace("The above", "\n\nThe above").replace("THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    apache = licenses.TEXTS["Apache-2.0"].replace("You may obtain", "\n\nYou may obtain").replace(
        "Unless", "\n\nUnless")
    bsd = "\n\n".join(licenses.BSD)
    expected = {
        f"{prose}\n\n{laid_out}\n\n{prose}": ("MIT", 1.0, 1),
        f"{prose}\n\n{apache}\n\n{prose}": ("Apache-2.0", 1.0, 1),
        f"{prose}\n\n{bsd}\n\n{prose}": ("BSD-3-Clause", 1.0, 1),
        f"{prose}{isc} {prose}": ("ISC", 1.0, 1),
        f"{prose}{isc.replace('any purpose', 'any such odd purpose')} {prose}{mit}{prose}": ("MIT", 1.0, 2),
        "Copyright (c) 2020 Jane Doe. Released under the MIT License.": ("MIT", 1.0, 1),
        f"{prose}Distributed under the BSD 3-Clause License. {prose}": ("BSD-3-Clause", 1.0, 1),
        f"# SPDX-License-Identifier: LGPL-3.0\n{prose}": ("LGPL-3.0", 1.0, 1),
        f"{prose}This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        f"International License. {prose}": ("CC-BY-SA-4.0", 1.0, 1),
        f"Released under the MIT License.\n{prose} Licensed under CC BY 4.0. {prose}": ("CC-BY-4.0", 1.0, 2),
        # In a line that reaches the threshold, there is no further unit.
        f"{prose}\nReleased under the MIT License!\n{prose}": ("MIT", 1.0, 1),
        f"{prose} released under the new license of the MIT {prose}": (None, None, 0),
    }
    docs = spark.createDataFrame(list(enumerate(expected)), "doc_id bigint, text string")
    found = {row["doc_id"]: tuple(row)[1:] for row in licenses.scan_licenses(docs).collect()}
    assert found == dict(enumerate(expected.values()))


def own_text(page):
    return html_text.text_at(html_text.blocks_of(page), []).split("\n")


def test_nested_sections_belong_to_their_text():
    def part(n, name="p"):
        return f"<div class={name}><p>{'w' * n}</p></div>"

    lead = f"<h1>Title</h1><p>{'l' * 100}</p>"
    noise = "<div class=x><p>short note</p></div>"
    sections = ["w" * n for n in (100, 300, 100)]
    parts = "".join(part(n, name) for n, name in zip((100, 300, 100), ("a", "b", "c")))
    for name in ("article", "main", "div class=post"):
        end = name.split()[0]
        page = f"<body><{name}>{lead}{part(400)}{part(400)}</{end}>{noise}</body>"
        assert own_text(page) == ["Title", "l" * 100, "w" * 400, "w" * 400]
        assert own_text(f"<body><{name}>{parts}</{end}>{noise}</body>") == sections
    # A large cell of a table within an article.
    table = f"<table><tr><td>{'t' * 900}<td>side</table>"
    page = f"<body><article>{lead}{table}<p>end</article>{noise}"
    assert own_text(page) == ["Title", "l" * 100, "t" * 900, "side", "end"]
    # Sections of an article that differ, and articles that do.
    page = "<body><main><article class=a>{}</article><article class=b>{}</article></main>{}".format(
        part(300), part(200), part(250, "rest"))
    assert own_text(page) == ["w" * 300, "w" * 200]
    # Lists of links add nothing.
    links = "<div class=y>" + "<p><a href=x>some other page</a></p>" * 30 + "</div>"
    assert own_text(f"<body><div class=t><p>{'w' * 300}</p></div>{links}</body>") == ["w" * 300]


def test_a_host_keeps_sections_of_articles(spark):
    page = "<body><article><h1>T{0}</h1><div class=a><p>{0} lead</p></div><div class=b>{1}</div></article>"
    rows = [(i, "http://h/", page.format(i, LONG * (i % 3 + 1))) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for row in html_text.main_text(pages).collect():
        i = row["page_id"]
        assert row["text"] == "\n".join([f"T{i}", f"{i} lead", (LONG * (i % 3 + 1)).strip()])


def test_class_words_do_not_drop_the_page():
    side = "<div class=sidebar>side</div>"
    body = f"<p>{'w' * 300}</p>"
    wrapped = [
        f"<div class=content-sidebar-wrap><main>{body}</main>{side}</div><div>skip</div>",
        f"<div id=page class=sidebar-right><div>{body}</div>{side}</div><p>skip</p>",
        f"<div class='post comment-open'>{body}{side}</div>",
        f"<div class=comment-open><article>{body}</article></div><div><p>{'o' * 150}</p></div>{side}",
        f"<div class=sidebar><div class=widget>{body}</div></div>",
    ]
    for page in wrapped:
        assert "w" * 300 in own_text(f"<body>{page}</body>")
        assert "side" not in own_text(f"<body>{page}</body>")
    # Long comments after a short article are comments.
    answer = f"<article class=comment-body>{body * 9}</article>"
    page = f"<body><article><p>short</p></article><div class=comments-area>{answer}</div></body>"
    assert own_text(page) == ["short"]
    # Each page is read in the same time, however deep its parts are.
    assert own_text("<div class=ad>" * 20_000 + "deep") == ["deep"]


def test_long_attributes():
    markup = "<p>no</p> class='ad' > " * 5000
    for quote, value in (('"', markup), ("'", markup.replace("'", '"'))):
        page = f"<div data-x={quote}{value}{quote} class=ad>not this</div><div><p>{'w' * 300}</p></div>"
        assert own_text(page) == ["w" * 300]
        # What looks like a class within a value is none.
        assert own_text(f"<div data-x = {quote}{value}{quote}>{'w' * 300}</div><nav>no") == ["w" * 300]
    # A quote that is never closed, or that begins no value, ends with its tag.
    assert own_text("<p title=\"open>one</p><p title=it's>two</p><p '>three</p>it's") == [
        "one", "two", "three", "it's"]
    assert own_text("<p title='open>one</p>" + '<p title="a>b">x</p>' * 3) == ["one", "x", "x", "x"]
    assert own_text('<p a="' * 2001 + "end>last")[-1] == "last"


@pytest.mark.parametrize("page", [
    "<x" * 50_000, "<p a='" * 17_000, '<p a="' * 17_000 + ">", "<p a='>' " * 12_000, "<!" * 50_000,
    "<!--" * 25_000, "<script>" * 12_000, "<script" * 14_000, "</script   " * 9_000, "<" * 100_000,
    "<style></style" + " " * 90_000, "<p a=" + "=" * 90_000, "<div>x" * 16_000, "<li>x<div>" * 10_000,
    "<div class='a'>" * 7_000 + "</p>" * 20_000, "<td>x" * 20_000, "&" * 100_000, "<a><div>" * 12_000,
])
def test_long_markup_is_read_in_little_time(page):
    begin = time.perf_counter()
    html_text.text_at(html_text.blocks_of(page), [1, 2])
    assert time.perf_counter() - begin < 3


def test_unfinished_tags_are_text_or_end_at_the_first_end():
    assert own_text("<p>one</p><p>two <b") == ["one", "two <b"]
    assert own_text("<p>one</p><p a='>'>two</p><p b='>three</p>") == ["one", "two", "three"]
    assert own_text("<article><p>x < y</p><script>a</script><!-- b --><p>c</p></article>") == ["x < y", "c"]


def test_names_in_camel_case():
    text = "long enough to be the text of the page " * 5
    for name in ("siteFooter", "mainNav", "cookieBanner", "adSlot", "commentList", "pageHEADER", "relatedNews"):
        page = f"<body><div class='story'><p>{text}</p></div><div class='{name}'><p>not this</p></div></body>"
        assert own_text(page) == [text.strip()], name
    for name in ("hasSidebar", "noSidebar", "navy", "loadsOfText", "shared"):
        assert own_text(f"<body><div class='{name}'><p>{text}</p></div></body>") == [text.strip()], name


def test_links_around_blocks():
    teaser = "<a href='x'><div class='t'><p>A teaser with a sentence of its own, about as long.</p></div></a>"
    text = "The article tells what happened and why it matters to all of its readers. " * 3
    page = f"<body><div class='story'><p>{text}</p></div><div class='more'>{teaser * 8}</div></body>"
    assert own_text(page) == [text.strip()]
    # A link that is never closed ends with the element around it.
    page = f"<body><div class='nav2'><p><a href='x'>open</p></div><div class='story'><p>{text}</p></div></body>"
    assert own_text(page) == [text.strip()]


def test_headers_within_the_text_stay():
    page = ("<body><header>site</header><main><header><h1>Title</h1><p>Lead</p></header>"
            "<article><div class='entry-header'><h2>Part</h2></div><p>Body of the text.</p>"
            "<footer>tags</footer></article></main><div class='page-header'>site</div></body>")
    assert own_text(page) == ["Title", "Lead", "Part", "Body of the text."]


def test_generated_pages_with_known_text():
    """Articles in layouts of all kinds, with what is around them drawn at random."""
    rng = random.Random(8)
    sentence = lambda n: " ".join(rng.choice("the a river house old new runs over under stone".split()) for _ in range(n))
    around = [
        lambda: f"<nav><ul>{''.join(f'<li><a href=x>{sentence(2)}</a></li>' for _ in range(6))}</ul></nav>",
        lambda: f"<header><a href=/>{sentence(3)}</a></header>", lambda: f"<footer>{sentence(12)}</footer>",
        lambda: f"<aside>{sentence(30)}</aside>", lambda: f"<div class='sidebar-2'><p>{sentence(25)}</p></div>",
        lambda: f"<div id=cookieNotice>{sentence(20)}</div>", lambda: f"<form>{sentence(5)}<input></form>",
        lambda: f"<div class='comments'><div>{sentence(40)}</div><div>{sentence(30)}</div></div>",
        lambda: f"<script>{sentence(50)}</script><style>{sentence(9)}</style><!-- {sentence(9)} -->",
        lambda: "".join(f"<a href=x><div><h3>{sentence(4)}</h3><p>{sentence(9)}</p></div></a>" for _ in range(4)),
    ]
    for _ in range(150):
        lines, body = [], []
        for _ in range(rng.randint(3, 8)):
            kind, line = rng.choice(["p", "p", "p", "h2", "li", "td", "blockquote", "div"]), sentence(rng.randint(8, 60))
            lines.append(line)
            inner = line.replace(" river ", " <b>river</b> ").replace(" old ", " <a href=y>old</a> ")
            open_, close = {"li": ("<ul><li>", "</li></ul>"), "td": ("<table><tr><td>", "</table>")}.get(kind, (f"<{kind}>", f"</{kind}>"))
            body.append(open_ + inner.replace(" new ", "  new\n") + close)
        holder = rng.choice(["article", "main", "div class='story'", "div id=c1", "section"])
        article = f"<{holder}>{''.join(body)}</{holder.split()[0]}>"
        before, after = ("".join(rng.choice(around)() for _ in range(rng.randint(0, 4))) for _ in range(2))
        wrap = rng.choice(["{}", "<div>{}</div>", "<div class='page'><div class=row>{}</div></div>"])
        page = f"<html><head><title>t</title></head><body>{before}{wrap.format(article)}{after}</body></html>"
        assert own_text(page) == lines, page
