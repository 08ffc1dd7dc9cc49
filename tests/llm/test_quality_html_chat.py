"""Quality rules, page extraction, chat formatting and the pipeline."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest

from slicewise.llm import chat, html_text, quality

SCHEMA = "doc_id long, text string, lang string, digest string, n_words int"


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    counts = collections.Counter(zip(words, words[1:], words[2:]))
    hit = [False] * len(words)
    for i in range(len(words) - 2):
        if counts[tuple(words[i : i + 3])] > 1:
            hit[i] = hit[i + 1] = hit[i + 2] = True
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(hit)


def prose(rng, n, letters):
    common = [letters[i] + letters[-i - 1] for i in range(6)]
    return " ".join(rng.choice(common) if rng.random() < 0.6 else "".join(rng.choice(letters) for _ in range(rng.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(60, 300), "abcdefgh"), "xx", "s", 0) for i in range(400)]
    rows += [(1000 + i, "".join(rng.choice("stuvwxyz#*$") for _ in range(rng.randint(500, 900))).replace("s", " "), "xx", "s", 0) for i in range(8)]
    rows += [(2000 + i, prose(rng, 120, "klmnopqr"), None, "s", 0) for i in range(60)]
    rows += [(3000, None, "xx", "s", 0), (3001, "", "xx", "s", 0), (3002, "same line\n" * 80 + "\n \n", "xx", "s", 0), (3003, "é漢 a | b\x0b\x1c" * 40, "xx", "s", 0)]
    rows += [(3004, "w " * 40000, "xx", "s", 0), (None, rows[0][1], "xx", "s", 0), (0, rows[0][1], "xx", "s", 0)]
    return rows


def test_base_statistics_and_bands(spark, documents):
    docs = spark.createDataFrame(documents, SCHEMA)
    got = quality.quality(docs, bucket_bytes=20_000).collect()
    assert len(got) == len(documents)
    expected = sorted((str(r[0]), *base(r[1])) for r in documents)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == expected
    fair = {}
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.perplexity <= r.upper and (r.perplexity >= r.lower or r.copied > 0.25))
        if not r.base_failed and r.copied <= 0.25:
            fair.setdefault(r.lang, {})[r.digest] = np.log(r.perplexity)
    for r in got:  # the edges are three interquartile ranges outside the quartiles
        one, three = (np.quantile(list(fair[r.lang].values()), q, method="inverted_cdf") for q in (0.25, 0.75))
        reach = 3 * max(0.3, three - one)
        assert (r.lower, r.upper) == pytest.approx((np.exp(one - reach), np.exp(three + reach)), rel=1e-3)
    kept = {r.doc_id for r in got if r.kept}
    assert len([i for i in range(400) if i in kept]) >= 395 and len([i for i in range(2000, 2060) if i in kept]) >= 58
    assert not any(i in kept for i in range(1000, 1008))
    left = quality.keep_good(docs, bucket_bytes=20_000)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def test_quality_of_nothing(spark):
    assert quality.quality(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_lower_edge_rejects_text_that_is_too_easy_but_not_copies(spark):
    """Spun text of a few stock words is rejected below; a text and its near copies in both halves stay."""
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(3000)]
    stock = ["stock%d" % i for i in range(12)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(80, 200)))) for i in range(500)]
    rows += [(1000 + i, " ".join(rng.choice(stock) for _ in range(150))) for i in range(12)]
    whole = rows[0][1].split()
    for i in range(30):
        near = list(whole)
        near[rng.randrange(len(near))] = "edited%d" % i
        rows.append((2000 + i, " ".join(near)))
    docs = spark.createDataFrame([(i, t, "xx", "s", 0) for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in quality.quality(docs, bucket_bytes=20_000).collect()}
    assert not any(got[i].base_failed for i in range(1000, 1012))
    assert not any(got[i].kept for i in range(1000, 1012)) and all(got[i].perplexity < got[i].lower for i in range(1000, 1012))
    assert sum(got[i].kept for i in range(500)) >= 497
    assert all(got[i].kept and got[i].copied > 0.25 for i in range(2000, 2030)) and any(got[i].perplexity < got[i].lower for i in range(2000, 2030))


def kneser_ney(train):
    """log p(word | word before) of an interpolated modified Kneser-Ney bigram model, straight from its definition."""
    pairs = collections.Counter(p for w in train for p in zip(["<s>", *w], w))
    types = collections.Counter(b for _, b in pairs)
    context = collections.Counter()
    for (a, _), n in pairs.items():
        context[a] += n

    def cuts(counts):
        n = [sum(v == k for v in counts) for k in range(5)]
        if min(n[1:4]) == 0:
            return [0, 0.5, 0.75, 0.9]
        y = n[1] / (n[1] + 2 * n[2])
        found = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
        return [0, *(min(max(x, 0.05), top) for x, top in zip(found, (0.95, 1.95, 2.95)))]

    high, low, total = cuts(pairs.values()), cuts(types.values()), sum(types.values())
    freed = collections.Counter()
    for (a, _), n in pairs.items():
        freed[a] += high[min(n, 3)]
    spread = sum(low[min(n, 3)] for n in types.values()) / total / (len(types) + 1)

    def log_p(a, b):
        unigram = max(types[b] - low[min(types[b], 3)], 0) / total + spread
        if not context[a]:
            return np.log(unigram)
        return np.log(max(pairs[a, b] - high[min(pairs[a, b], 3)], 0) / context[a] + freed[a] / context[a] * unigram)

    vocabulary = set(types) | {"<unknown>"}
    for a in ["<s>", *list(types)[:3]]:  # it is a distribution
        assert sum(np.exp(log_p(a, b)) for b in vocabulary) == pytest.approx(1)
    return log_p


@pytest.mark.parametrize("bucket_bytes,vocabulary", [(16 << 20, 1 << 18), (5_000, 1 << 18), (5_000, 8), (16 << 20, 8), (5_000, 300)])
def test_scores_are_the_other_halfs_kneser_ney_model(spark, documents, bucket_bytes, vocabulary):
    """In one or many buckets, and with any number of short ids, down to a model of rare words alone."""
    docs = spark.createDataFrame(documents, SCHEMA)
    got = quality.quality(docs, bucket_bytes=bucket_bytes, vocabulary=vocabulary).collect()
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    digest = {r.text: r.d for r in docs.selectExpr("text", "xxhash64(text) d").collect()}
    models = [kneser_ney([split(t) for _, t, *_ in documents if digest[t] & 1 != f]) for f in (0, 1)]
    text_of = {d: t for t, d in digest.items()}
    for r in got:
        words = split(text_of[r.digest])
        if words:
            log_p = sum(models[r.digest & 1](a, b) for a, b in zip(["<s>", *words], words))
            assert r.perplexity == pytest.approx(np.exp(-log_p / len(words)), rel=1e-4)
        else:
            assert r.perplexity is None


def packed(groups, buckets):
    return {b: sum(map(len, columns)) for b, columns in quality._dealt(groups, buckets)}


def test_sorted_columns_stay_dense_in_many_buckets():
    rng = np.random.default_rng(5)
    h = np.unique(rng.integers(0, 1 << quality.WORD_BITS, 50_000, dtype=np.uint64))
    group = [(h, [(h, quality.P.squeezed_sorted)])]
    one, many = packed(group, 1), packed(group, 64)
    assert len(many) == 64 and max(many.values()) < 1.3 * np.mean(list(many.values()))
    assert sum(many.values()) < 1.12 * one[0]  # gaps that were 64 times as wide took 1.18


def test_bigrams_of_one_hot_word_are_spread_over_the_buckets():
    tokens = 1_000_000 // np.arange(1, 2001)  # the first word has an eighth of all tokens
    model = quality.Model(np.arange(2000, dtype=np.uint64) << np.uint64(37), np.arange(2000), tokens)
    rng = np.random.default_rng(6)
    first, second = (rng.choice(2000, 200_000, p=tokens / tokens.sum()).astype(np.uint64) for _ in range(2))
    first[::50] = quality.BEGIN
    key = np.unique((first << np.uint64(quality.ID_BITS)) | second)
    place = model.places(key)
    assert (np.diff(place.astype(np.int64)) >= 0).all() and place.max() < 1 << quality.WORD_BITS
    assert (model.places(key[::3]) == place[::3]).all()  # whatever else is in the batch
    sizes = [len(x) for _, (x,) in quality._dealt([(place, [(key, lambda v: v)])], 32)]
    assert sum(sizes) == len(key) and max(sizes) < 1.3 * np.mean(sizes)
    assert len(quality.Model(key[:0], key[:0], key[:0]).places(key[:0])) == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p><p>x.";</script></head><body>
<header class="top"><h1>Site name</h1></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice">We use cookies, and more cookies, for you. Accept, please.</div><!-- <p>no</p> --><div class="ad">Buy now, it is cheap, so cheap!</div>
<article><h1>Head &amp; tail</h1><p><b>First,  with&nbsp;space. <i>Inline</i>text<br>next line.<br><p title="a>b">Second &lt;b&gt; caf&eacute; &#233;; 1 < 2.
<ul><li>one<li>two</ul><aside>Related things, many of them.</aside><div class="comments"><p>First comment, a long one, with words and marks!</p></div></article>
<div class="sidebar"><p>Side text, rather long, with commas, and more.</p></div><form><p>Your name, please.</p></form><footer>&copy; us</footer></body></html>"""


def test_main_text_of_pages(spark):
    expected = "Head & tail\nFirst, with space. Inlinetext next line.\nSecond <b> café é; 1 < 2.\none\ntwo"
    assert html_text.main_text(PAGE) == expected
    plain = "<body><div id=nav><a href=x>Home</a></div><div><p>Some words, here. And more, of them.</p><p>Short</p></div></body>"
    assert html_text.main_text(plain) == "Some words, here. And more, of them.\nShort"
    post = (
        "<body class='no-sidebar'><div class='header'><h1>Site</h1></div><div class='page has-sidebar'><div class='post'><div class='title'><h1>The title</h1></div>"
        "<div class='body'><p>A first paragraph, with some words in it. It goes on, and on.</p><h2>Part</h2><p>A second one; it is long enough, too.</p></div>"
        "<div hidden><p>Not shown, not at all, to anyone.</p></div><ol class='commentlist'><li>I disagree, strongly, with all of it!</li></ol></div></div></body>"
    )
    assert html_text.main_text(post) == "The title\nA first paragraph, with some words in it. It goes on, and on.\nPart\nA second one; it is long enough, too."
    wrapped = "<div class='layout sidebar'><main><header><h1>T</h1></header><p>Text, here.</p></main><aside>No.</aside></div>"
    assert html_text.main_text(wrapped) == "T\nText, here."
    deep = "<div>" * 3000 + "x" + "</p>" * 10
    rows = [(1, "u", PAGE, 5), (2, "u", None, 5), (3, "u", "", 5), (4, "u", "<p>", 5), (5, None, deep, 5), (None, "u", PAGE, 5), (6, "u", "just text", 5), (7, "u", "<a title='x" * 500, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = html_text.extracted(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = {r.page_id: r for r in got.collect()}
    assert found[1].text == found[None].text == expected and found[1].n_chars == len(expected)
    assert [found[i].text for i in (2, 3, 4)] == ["", "", ""] and found[6].text == "just text" and found[5].text == "x"
    assert html_text.extracted(spark.createDataFrame([], pages.schema)).count() == 0


LONG = "".join(f"<p>Paragraph {i} of the text, with some words in it; it goes on, and on, for a while.</p>" for i in range(8))
PLAIN = "\n".join(f"Paragraph {i} of the text, with some words in it; it goes on, and on, for a while." for i in range(8))


@pytest.mark.parametrize("page", [
    f"<body><div class=post>{LONG}</div><article><p>A teaser, short.</p></article></body>",
    f"<body><div class=post>{LONG}</div><div class=related><article><p>A teaser, short.</p></article></div></body>",
    f"<body><article>{LONG}</article><section class=comments><article class=comment-body><p>I disagree, strongly, with it!</p></article></section></body>",
    f"<body><main>{LONG}<article class=comment-body><p>I disagree, strongly, with it!</p></article></main></body>",
])
def test_teasers_and_comments_in_article_elements_are_not_the_text(page):
    assert html_text.main_text(page) == PLAIN


@pytest.mark.parametrize("tag", ["section id=discussion", "section id=web-search", "div id=immune-responses"])
def test_anchors_and_attribute_values_drop_nothing(tag):
    page = f"<body><article data-title='The hidden cost, display:none'><h2 id=related-work>Related work</h2><{tag}>{LONG}</{tag.split()[0]}></article></body>"
    assert html_text.main_text(page) == "Related work\n" + PLAIN
    assert html_text.main_text(page.replace("<article", "<article hidden")) == ""


def brute_article(page):
    """The tag-path method on a well-formed page, by the standard library's parser and path strings."""
    from html.parser import HTMLParser

    parts = "h1 h2 h3 h4 h5 h6 p ul ol li section blockquote".split()
    found = []  # (path, container, link letters, text)

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.open, self.link = [], 0

        def handle_starttag(self, tag, attrs):
            self.link += tag == "a"
            if tag != "a":
                self.open.append(tag + "." + dict(attrs).get("class", ""))

        def handle_endtag(self, tag):
            self.link -= tag == "a"
            if tag != "a":
                self.open.pop()

        def handle_data(self, data):
            if data.strip() and "nav." not in self.open:
                home = max(i for i, t in enumerate(self.open) if t.split(".")[0] not in parts)
                found.append((tuple(self.open), tuple(self.open[: home + 1]), len(data) * (self.link > 0), data.strip()))

    Reader().feed(page)
    of = {p: [x for x in found if x[0] == p] for p, *_ in found}
    length = {p: sum(len(t) - min(k, len(t)) for *_, k, t in x) / len(x) for p, x in of.items()}
    marks = {p: sum(len(re.findall("[.,;:!?]", t)) for *_, t in x) / len(x) for p, x in of.items()}

    def smooth(ratio, path):
        values = []
        for i, x in enumerate(found):
            if x[0] == path:
                near = [found[j][0] for j in (i - 1, i + 1) if 0 <= j < len(found) and found[j][1] == x[1]]
                values.append((4 * ratio[path] + sum(ratio[n] for n in near)) / (4 + len(near)))
        return sum(values) / len(values)

    fused = {p: smooth(length, p) * (1 + smooth(marks, p)) for p in of}
    chars = {p: length[p] * len(x) for p, x in of.items()}
    least = 0.1 * sum(fused[p] * chars[p] for p in of) / sum(chars.values())
    homes = {of[p][0][1] for p in of if fused[p] >= least}
    keep = [fused[p] >= least or home in homes and sum(x[2] for x in of[p]) * 2 <= sum(len(x[3]) for x in of[p]) for p, home, *_ in found]
    for i in range(len(found) - 2, -1, -1):
        tag = found[i][0][-1].split(".")[0]
        if not keep[i] and keep[i + 1] and tag in parts and not found[i][2]:
            keep[i] = tag[0] == "h" or i > 0 and keep[i - 1]
    return "\n".join(x[3] for x, k in zip(found, keep) if k)


def test_the_ratios_choose_the_paths():
    """On pages without article or main, against a brute-force version of the method; the ratios decide."""
    rng, words = random.Random(11), "some words of a text that goes on for long".split()
    say = lambda n, end: " ".join(rng.choice(words) for _ in range(n)) + end
    for _ in range(60):
        menu = "".join(f"<li><a>{say(2, '')}</a></li>" for _ in range(rng.randint(2, 6)))
        junk = "".join(f"<div class='k{rng.randrange(3)}'>{say(rng.randint(1, 3), '')}</div>" for _ in range(rng.randint(1, 4)))
        body = "".join(rng.choice([f"<p>{say(rng.randint(15, 60), ', ') + say(9, '.')}</p>", f"<h2>{say(3, '')}</h2>", f"<ul><li>{say(2, '')}</li><li>{say(3, '')}</li></ul>"]) for _ in range(12))
        first, last = (f"<p>{say(40, ', ')}{say(9, '.')}</p>" for _ in range(2))
        page = f"<html><body><nav>{say(40, '.')}</nav><ul>{menu}</ul><div class='t'><h1>{say(4, '')}</h1></div><div class='b'>{first}{body}<div class='x'><div class='y'>junk</div></div>{last}</div>{junk}</body></html>"
        got = html_text.main_text(page)
        assert got == brute_article(page)
        assert "junk" not in got and got.count("\n") >= 2
        without = "\n".join(x[2] for p, found in [html_text.blocks(page)] for x in found if p.state[x[0]] != html_text.OUT)
        assert got != without


def test_adverts_in_inline_elements_and_junk_in_articles_go():
    page = f"<body><span class='share'>Share it</span><article>{LONG}<div class=zz><div class=qq>junk</div></div><p>It ends <span class='advert'>BUY NOW</span> <span style='display: none'>HID</span>here.</p></article></body>"
    assert html_text.main_text(page) == PLAIN + "\nIt ends here."
    assert html_text.main_text("<p>Kept, <span class=ad>a <span>b</span> c</span>too.<p>And <i hidden>not</i> <b>this</b>.") == "Kept, too.\nAnd this."


def said(n, size):
    """A paragraph of ``size`` characters, two sentences."""
    text = f"Number {n} says something, at some length. " + "words and words " * 40
    return text[: size - 1] + "."


ARTICLE = ["The title", said(1, 120), said(2, 120), said(3, 120)]


@pytest.mark.parametrize("wrap", ["<main>{}{}</main>", "<div>{}{}</div>", "<main>{}</main>{}"])
@pytest.mark.parametrize("size", [60, 100, 400, 2000])
@pytest.mark.parametrize("n", [0, 1, 2, 4, 10, 50])
def test_an_article_comes_before_any_number_of_comments(n, size, wrap):
    article = "<article><h1>{}</h1><p>{}</p><p>{}</p><p>{}</p></article>".format(*ARTICLE)
    comments = "".join(f"<p>{said(100 + i, size)}</p>" for i in range(n))
    for thread in (f"<div class=thread>{comments}</div>", f"<section><ul>{comments.replace('<p>', '<li><p>')}</ul></section>"):
        assert html_text.main_text("<body><nav>Go, there.</nav>" + wrap.format(article, thread) + "</body>") == "\n".join(ARTICLE)


@pytest.mark.parametrize("n", [1, 2, 8])
@pytest.mark.parametrize("outer", ["<div class=post>{}</div>", "<main><div>{}</div></main>", "<section id=text>{}</section>"])
def test_teasers_in_article_elements_lose_to_the_text(n, outer):
    body = "".join(f"<p>{said(i, 300)}</p>" for i in range(4))
    teasers = "".join(f"<article><h3><a href=x>Other {i}</a></h3><p>{said(50 + i, 90)}</p></article>" for i in range(n))
    expected = "\n".join(said(i, 300) for i in range(4))
    assert html_text.main_text(f"<body>{outer.format(body)}<div>{teasers}</div></body>") == expected
    article = "<article><h1>{}</h1><p>{}</p><p>{}</p><p>{}</p></article>".format(*ARTICLE)
    assert html_text.main_text(f"<body><main>{article}<section>{teasers}</section></main></body>") == "\n".join(ARTICLE)


def test_several_articles_are_all_the_text():
    both = "".join(f"<article><h2>Post {k}</h2><p>{said(k, 200)}</p><p>{said(k + 5, 150)}</p></article>" for k in (1, 2))
    assert html_text.main_text(f"<body><p>Home, sweet.</p>{both}</body>") == "\n".join(x for k in (1, 2) for x in (f"Post {k}", said(k, 200), said(k + 5, 150)))


def test_class_words_inside_a_sentence_drop_nothing():
    line = "Open the <span class='menu'>File</span> menu, find <mark class='search'>term</mark> and <a class='nav-link'>this page</a>; it is <em class='alert'>urgent</em>."
    text = "Open the File menu, find term and this page; it is urgent."
    assert html_text.main_text(f"<article>{LONG}<p>{line}</p></article>") == f"{PLAIN}\n{text}"
    assert html_text.main_text(f"<article>{LONG}<p><a class=share>Share</a> <a class=share>it</a></p></article>") == PLAIN
    assert html_text.main_text(f"<article>{LONG}<p>Not <i role=alert>this</i> <b hidden>one</b>.</p></article>") == f"{PLAIN}\nNot ."


def test_what_is_out_stays_out_however_deep():
    deep = "<section>" * 600
    page = f"<body><article>{LONG}{deep}<nav>Go, there, now.<section>And, there.</section></nav><p>Some more text, down here.</p><div hidden><div>No, no.</div>No.</div>{'</section>' * 600}<p>The end, of it.</p></article></body>"
    assert html_text.main_text(page) == f"{PLAIN}\nSome more text, down here.\nThe end, of it."


@pytest.mark.parametrize("page", ["<div>x" * 100_000, "<p>hello " + "<a " * 200_000, "<center><li>x" * 50_000, "<!" * 200_000, "<a b='" * 50_000 + '<a c="' * 50_000, "<center>" * 2000 + "</x>" * 50_000])
def test_hostile_pages_take_linear_time(page):
    import time

    start = time.time()
    html_text.main_text(page)
    assert time.time() - start < 10


def test_articles_of_the_small_table(spark):
    from slicewise.llm import queries

    d = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    import html

    for r in queries.op2_html_extraction(spark, d).collect():
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside))
        assert r.text == "\n".join(x for x in parts if x)


def test_snapshots_collapse(spark):
    def turns(conv, *texts):
        return [(conv, k, "user" if k % 2 == 0 else "assistant", t, 1) for k, t in enumerate(texts)]

    rows = turns(1, "a", "b") + turns(2, "a", "b", "c") + turns(3, "a", "b", "c", "d") + turns(4, "a", "x") + turns(5, "a", "x") + turns(6, "a") + turns(7, "", None) + turns(8, None, "")
    rows += [(None, 0, "user", "lost", 1), (9, None, "user", "later", 1), (9, 0, None, "first", 1), (10, 0, "user", "q" * 200_000, 1), (11, 1, "user", "two", 1), (11, 1, "user", "two", 1)]
    data = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")
    got = {r.conv_id: r for r in chat.formatted(data).collect()}
    assert set(got) == {3, 4, 7, 8, 9, 10, 11}
    assert got[3].text == "<|user|>\na\n<|assistant|>\nb\n<|user|>\nc\n<|assistant|>\nd\n" and got[3].n_snapshots == 4
    assert got[4].n_snapshots == 3 and got[9].text == "<||>\nfirst\n<|user|>\nlater\n" and got[11].n_turns == 2
    con = duckdb.connect()
    frame = data.toPandas()
    con.register("conversations", frame)
    con.execute("create view c2 as select conv_id::bigint conv_id, turn::bigint turn, role, text from conversations")
    sql = chat.SQL.replace("from conversations", "from c2")
    assert sorted(con.sql(sql).fetchall()) == sorted((r.conv_id, r.n_turns, r.n_snapshots, r.text) for r in got.values())
    assert chat.formatted(spark.createDataFrame([], data.schema)).count() == 0


def test_pipeline_keeps_its_promises(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    text = [prose(rng, 200, "abcdefgh") for _ in range(80)]
    shared = prose(rng, 60, "abcdefgh")
    rows = [(i, t, "xx", "s", len(t)) for i, t in enumerate(text)]
    rows += [(100, text[0], "xx", "s", 9), (101, text[1] + " zz", "xx", "s", 9), (102, "too short", "xx", "s", 9), (103, "again and again " * 50, "xx", "s", 9), (104, None, None, None, None)]
    a, b = prose(rng, 150, "abcdefgh"), prose(rng, 150, "abcdefgh")
    rows += [(200, f"{a} {shared}", "xx", "s", 9), (201, f"{shared} {b}", "xx", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert new.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        new.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {102, 103, 104} & kept["quality_rules"] == set() and set(range(80)) <= kept["quality_rules"]
    assert kept["near_dedup"] == kept["quality_rules"] - {100, 101}
    cut = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/substring_dedup").collect()}
    assert cut[200].text == f"{a} {shared}" and cut[201].text == b and cut[201].n_chars == len(b) and cut[5].text == text[5]
    assert kept["packing"] == kept["substring_dedup"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_the_pipelines_last_table_has_the_token_ids(spark):
    import zlib

    import corpus_pipeline

    docs = spark.createDataFrame([(i, "some words to pack " * (i + 1), "en", "s", 9) for i in range(5)], "doc_id long, text string, lang string, source string, n_chars long")
    for r in corpus_pipeline.pack(spark, docs, "").collect():
        assert len(r.ids) == 4 * r.length > 0 and zlib.crc32(bytes(r.ids)) == r.ids_crc32


def test_stages_lose_no_rows_for_their_ids_and_keep_clashing_columns(spark):
    import corpus_pipeline

    rng = random.Random(21)
    text = [prose(rng, 120, "abcdefgh") for _ in range(60)]
    near = " ".join(text[0].split()[:-1] + ["changed"])
    rows = [(i, t) for i, t in enumerate(text)] + [(7, text[0]), (7, near), (7, prose(rng, 120, "abcdefgh")), (None, prose(rng, 120, "abcdefgh")), (None, text[3]), (70, near), (70, near)]
    own = ["n_words", "n_removed", "kept_text", "removed", "digest", "first", "node", "batch", "good_digest", "c0", "column3"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in own)
    docs = spark.createDataFrame([(i, t, "xx", "s", len(t), *range(700, 700 + len(own))) for i, t in rows], schema)
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, "")
    assert good.columns == docs.columns and sorted(map(str, good.collect())) == sorted(map(str, docs.collect()))
    once = stages["near_dedup"](spark, docs, "")
    assert once.columns == docs.columns
    lost = [(7, text[0]), (7, near), (None, text[3]), (70, near), (70, near)]
    assert sorted((str(r.doc_id), r.text) for r in once.collect()) == sorted((str(i), t) for i, t in rows if (i, t) not in lost)
    cut = stages["substring_dedup"](spark, docs, "")
    assert cut.columns == docs.columns
    assert all(tuple(r)[5:] == tuple(range(700, 700 + len(own))) for df in (once, cut) for r in df.collect())
    whole = {(str(r.doc_id), r.text) for r in cut.collect()}
    assert {(str(i), t) for i, t in rows[:60]} <= whole and ("None", text[3]) not in whole
    for name, stage in stages.items():
        if name != "packing":
            assert stage(spark, docs.limit(0), "").count() == 0
    empty = spark.createDataFrame([(1, None), (2, ""), (None, None), (3, " ")], "doc_id long, text string").selectExpr("*", "'xx' lang", "'s' source", "0L n_chars")
    assert stages["quality_rules"](spark, empty, "").count() == 0
    assert [r.doc_id for r in stages["near_dedup"](spark, empty, "").collect()] == [1]
    assert stages["substring_dedup"](spark, empty, "").count() == 4
    assert stages["packing"](spark, empty, "").count() == 4 and stages["packing"](spark, empty.limit(0), "").count() == 0
