"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A tag, comment or declaration. A quote opens a value only after "="; one that never ends runs to the page's end.
TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|"""
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+)(>|\Z)""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Fixed values of HTML: elements without an end tag, whose content isn't markup, and that don't end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr img br".split()
)
#: An open element of the value's set ends when the key begins, up to one of STOP.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "body": {"head"},
}
STOP = frozenset("table ul ol dl select div section article main body html".split())
# Elements, roles and words of class and id that mark what isn't the article.
ASIDE = frozenset(
    "head nav footer aside form button select menu script style textarea title noscript template iframe svg canvas object dialog "
    "input fieldset datalist audio video map".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
ASIDE_WORD = re.compile(
    r"(?:^|[^a-z])(?<!has-)(?<!with-)(?<!no-)(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|notification\w*|alert|popup|modal|overlay|"
    r"newsletter|subscribe\w*|subscription|signup|sidebar|widget\w*|menu|nav|navbar|navigation|breadcrumbs?|comments?|commentlist|disqus|repl(?:y|ies)|"
    r"respond|responses|discussion|share|sharing|social|related|recommend\w*|footer|masthead|login|search|pagination|pager|toolbar|tags|copyright)(?:$|[^a-z])"
)
#: Inline text with such a class word goes even inside a sentence; with others only where all of its block has one.
ADVERT_WORD = re.compile(r"(?:^|[^a-z])(?<!no-)(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*)(?:$|[^a-z])")
#: Marks the page's header, but an article's own header has its title.
HEADER_WORD = re.compile(r"(?:^|[^a-z])(?<!has-)(?<!with-)(?<!no-)header(?:$|[^a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
#: Class words of wrappers around a page's columns, where a word such as ``sidebar`` says what the page has.
LAYOUT = re.compile(r"(?:^|[^a-z])(?:page|site|layout|wrap(?:per)?|container|content|main|row|grid|columns?|root|app)(?:$|[^a-z])")
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ANCHORED = frozenset("section div article li dt dd table figure blockquote".split())
#: Elements that are parts of a text: a path through them belongs to the container around them.
PART = HEADING | frozenset("p ul ol dl li dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption section header hgroup address center".split())
#: Class words of an article element that is the page's own, whatever its tags are called.
POST = frozenset("post hentry entry page".split())
MARKS = re.compile(r"[.,;:!?¡¿…。、，！？；：]")

#: States of a path: plain, marked by a word of class or id, and not part of any article.
PLAIN, MARKED, OUT = 0, 1, 2
#: What a marked path's ratio counts, and the share of the mean ratio that a content path has at least.
MARKED_WEIGHT, LEAST_SHARE = 0.02, 0.1
#: Elements that may be open at a time; deeper ones don't nest, as in browsers.
DEPTH = 512
#: Where a path lies, and unlinked characters of a block, with a mark among them, that make it a paragraph of an article.
OUTSIDE, MAIN, ARTICLE = 0, 1, 2
PARAGRAPH = 40


class Paths:
    """The tag paths of a page as a trie: a path is its parent's number, its label and its state."""

    def __init__(self):
        self.number: dict[tuple[int, str, int], int] = {}
        self.tag, self.state, self.container, self.level = [""], [PLAIN], [0], [OUTSIDE]

    def under(self, parent: int, tag: str, label: str, state: int) -> int:
        key = parent, label, state
        if key not in self.number:
            n = self.number[key] = len(self.tag)
            self.tag.append(tag)
            self.state.append(state)
            self.container.append(self.container[parent] if tag in PART else n)
            self.level.append(max(self.level[parent], {"article": ARTICLE, "main": MAIN}.get(tag, OUTSIDE)))
        return self.number[key]


class Open:
    """An open block element: its path, its own state, and whether that is only by a layout wrapper's word."""

    __slots__ = ("tag", "path", "own", "worded")

    def __init__(self, tag: str, path: int, own: int, worded: bool):
        self.tag, self.path, self.own, self.worded = tag, path, own, worded


def attributes(text: str) -> dict[str, str]:
    """Lower-cased values by name; the first of a name holds."""
    return {k.lower(): (a or b or c).lower() for k, a, b, c in reversed(ATTRIBUTE.findall(text))} if text else {}


def out_of_sight(kept: dict[str, str]) -> bool:
    return "hidden" in kept or kept.get("role", "") in ROLES or HIDDEN.search(kept.get("style", "")) is not None


def own_state(tag: str, kept: dict[str, str], inside: bool) -> tuple[int, bool]:
    """The state that an element gives its path, and whether only the word of a layout wrapper says so."""
    if tag in ASIDE or tag == "header" and not inside or out_of_sight(kept):
        return OUT, False
    own = kept.get("class", "")
    if tag == "article":
        words = own.split()
        return (MARKED if not POST.intersection(words) and any(ASIDE_WORD.match(x) for x in words) else PLAIN), False
    name = f"{own} {kept.get('id', '')}".strip()
    if not name or tag in ("main", "html", "body") or inside and (tag in HEADING or tag == "p"):
        return PLAIN, False
    # ids of sections in an article are anchors made of their titles
    said = own if inside and tag in ANCHORED else name
    if ASIDE_WORD.search(said) or not inside and HEADER_WORD.search(said):
        return MARKED, LAYOUT.search(name) is not None
    return PLAIN, False


def blocks(page: str) -> tuple[Paths, list[tuple[int, int, str, int]]]:
    """The page's tag paths, and (path, characters inside links, text, article) of each block with text, in page order.

    A path holds the open block elements with their class words; inline elements are left out of it. The text of
    hidden ones and of adverts is dropped; that of inline elements with other words of ASIDE_WORD only where the whole
    block is such text. ``article`` numbers the outermost article elements from 1; 0 is outside. Unclosed p, li, dt, dd
    and table cells end where HTML ends them; stray end tags do nothing. Elements beyond DEPTH don't nest, but what
    isn't in sight there takes its text out too. Time and memory are linear in the page.
    """
    paths, stack = Paths(), []
    open_tags: Counter[str] = Counter()
    out: list[tuple[int, list[int], list[str], int]] = []
    parts, linked = None, [0, 0]  # of the block that is being read: its text, characters in links and outside worded inline elements
    at = links = articles = 0
    skip, skip_tag, skip_base = 0, "", 0  # depth inside an inline element whose text is dropped
    word, word_tag = 0, ""  # depth inside an inline element with a class word
    beyond: Counter[str] = Counter()  # open elements past DEPTH
    gone = None  # the first of them whose text is dropped: its tag, and how many were open then

    def add(raw: str) -> None:
        nonlocal parts, linked
        if not raw or skip or gone or parts is None and raw.isspace():
            return
        if parts is None:
            parts, linked = [], [0, 0]
            out.append((stack[-1].path if stack else 0, linked, parts, articles if open_tags["article"] else 0))
        parts.append(raw)
        if links:
            linked[0] += len(raw)
        if not word and not raw.isspace():
            linked[1] += len(raw)

    def close(i: int) -> None:
        nonlocal skip, gone
        for e in stack[i:]:
            open_tags[e.tag] -= 1
        del stack[i:]
        if skip and len(stack) < skip_base:
            skip = 0
        beyond.clear()
        gone = None

    while True:
        m = TAG.search(page, at)
        add(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if not m[4]:  # the page ends within a tag
            break
        tag, ends = m[2].lower(), bool(m[1])
        if tag in RAW:
            if not ends:
                end = re.compile(f"</{tag}", re.I).search(page, at)
                at = end.start() if end else len(page)
                parts = parts if tag == "script" or tag == "style" else None
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if ends else 1))
            elif tag == "br" and parts is not None:
                parts.append(" ")
            if tag in VOID:
                continue
            if skip:
                skip += (-1 if ends else 1) if tag == skip_tag else 0
                continue
            if word and tag == word_tag:
                word += -1 if ends else 1
            if not ends and m[3] and not m[3].isspace():
                kept = attributes(m[3])
                if out_of_sight(kept) or ADVERT_WORD.search(kept.get("class", "")):
                    skip, skip_tag, skip_base = 1, tag, len(stack)
                elif not word and ASIDE_WORD.search(kept.get("class", "")):
                    word, word_tag = 1, tag
            continue
        parts, word = None, 0
        if ends and beyond[tag]:
            gone = None if gone == (tag, beyond[tag]) else gone
            beyond[tag] -= 1
            continue
        if ends:
            if open_tags[tag]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        links = 0
        if stack and stack[-1].tag == "p":
            close(len(stack) - 1)
        if any(open_tags[t] for t in ENDS.get(tag, ())):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in ENDS[tag]:
                    close(i)
                elif stack[i].tag in STOP:
                    break
        if tag in VOID:
            continue
        kept = attributes(m[3])
        inside = open_tags["article"] > 0 or open_tags["main"] > 0
        own, worded = own_state(tag, kept, inside)
        if len(stack) >= DEPTH:
            beyond[tag] += 1
            if own == OUT and not gone:
                gone = tag, beyond[tag]
            continue
        articles += tag == "article" and not open_tags["article"]
        if tag in ("article", "main"):  # what a class word says of the layout around the article can't hold
            state = max([own, *(e.own for e in stack if not e.worded)])
            for e in stack:
                e.own, e.worded = (PLAIN if e.worded else e.own), False
        else:
            state = max(own, paths.state[stack[-1].path] if stack else PLAIN)
        label = f"{tag}.{'.'.join(kept['class'].split())}" if kept.get("class") else tag
        stack.append(Open(tag, paths.under(stack[-1].path if stack else 0, tag, label, OUT if skip else state), own, worded))
        open_tags[tag] += 1
    texts = ((path, linked[0], " ".join(entities.unescape("".join(parts)).split()), article) for path, linked, parts, article in out if linked[1])
    return paths, [x for x in texts if x[2]]


def path_scores(paths: Paths, found: list[tuple[int, int, str, int]]) -> dict[int, tuple[float, int]]:
    """(fused ratio, unlinked characters) of each tag path that isn't out.

    Unlinked text length and punctuation are added up over a path's blocks and divided by their number.
    Both ratios are smoothed along the page: each block takes its own path's ratio four times and that of
    the blocks beside it in the same container once, and a path takes the mean of its blocks. Fused they
    are length * (1 + punctuation), and MARKED_WEIGHT of that where class words mark the path.
    """
    sums: dict[int, list[float]] = {}
    for path, linked, text, _ in found:
        s = sums.setdefault(path, [0, 0, 0])
        for i, v in enumerate((max(0, len(text) - linked), len(MARKS.findall(text)), 1)):
            s[i] += v
    ratio = {p: (chars / n, marks / n) for p, (chars, marks, n) in sums.items()}
    smooth = {p: [0.0, 0.0] for p in sums}
    for i, (path, *_) in enumerate(found):
        near = [found[j][0] for j in (i - 1, i + 1) if 0 <= j < len(found) and paths.container[found[j][0]] == paths.container[path]]
        for k in (0, 1):
            smooth[path][k] += (4 * ratio[path][k] + sum(ratio[p][k] for p in near)) / (4 + len(near))
    scores = {}
    for p, (chars, _, n) in sums.items():
        length, marks = (x / n for x in smooth[p])
        scores[p] = length * (1 + marks) * (MARKED_WEIGHT if paths.state[p] == MARKED else 1), chars
    return scores


def home(paths: Paths, found: list[tuple[int, int, str, int]]) -> list[bool]:
    """Which blocks lie where the article is: in article elements, in main outside of them, or outside of both.

    Article elements are it, however much text lies outside, if one of them has two paragraphs (PARAGRAPH) that no class word
    marks, or as many unlinked characters as any container elsewhere; then those with two paragraphs, or at least half of the
    text of the longest, are taken. A teaser has neither. Next main is it if it has two paragraphs, or its strongest
    path's ratio (``path_scores``) is as large as any outside; else what lies outside. Where articles
    and main fail, the stronger ratio decides.
    """
    size, paragraphs, elsewhere = Counter(), Counter(), Counter()
    for p, linked, text, article in found:
        if paths.state[p] == PLAIN:
            alone = max(0, len(text) - linked)
            place = article if paths.level[p] == ARTICLE else -paths.level[p]
            size[place] += alone
            paragraphs[place] += alone >= PARAGRAPH and MARKS.search(text) is not None and paths.tag[p] not in HEADING
            if place <= 0:
                elsewhere[paths.container[p]] += alone
    longest = max((n for place, n in size.items() if place > 0), default=0)
    taken = {place for place in size if place > 0 and (paragraphs[place] > 1 or 2 * size[place] >= longest)}
    if any(paragraphs[place] > 1 for place in taken) or longest and longest >= max(elsewhere.values(), default=0):
        return [article in taken for *_, article in found]
    scores = path_scores(paths, found)
    best = {level: max((s for p, (s, _) in scores.items() if paths.level[p] == level), default=0) for level in (OUTSIDE, MAIN, ARTICLE)}
    if paragraphs[-MAIN] > 1 and best[MAIN] >= best[ARTICLE]:
        level = MAIN
    else:
        level = max((ARTICLE, MAIN, OUTSIDE), key=best.get)
    return [paths.level[p] == level for p, *_ in found]


def content(paths: Paths, found: list[tuple[int, int, str, int]]) -> list[bool]:
    """Which of the blocks, all of them from one ``home`` and none of them out, are the article.

    Paths whose fused ratio (``path_scores``) is LEAST_SHARE of the mean or more hold content, the mean
    being over characters (those of marked paths count by MARKED_WEIGHT), and so does the strongest by ratio times
    characters. Headings, list items and other parts of a text with low ratios come
    back if their container holds a content path; so do a heading right before content, and parts
    between two blocks of content. Marked paths and those that are mostly links don't come back.
    """
    if not found:
        return []
    scores = path_scores(paths, found)
    best = max(scores, key=lambda p: scores[p][0] * (1 + scores[p][1]))
    weight = {p: c * (MARKED_WEIGHT if paths.state[p] == MARKED else 1) for p, (_, c) in scores.items()}
    least = LEAST_SHARE * sum(s * weight[p] for p, (s, _) in scores.items()) / (sum(weight.values()) or 1)
    chosen = {p for p, (s, _) in scores.items() if s >= least} | {best}
    total, linked = Counter(), Counter()
    for p, n, text, _ in found:
        total[p] += len(text)
        linked[p] += n
    part = {p for p in scores if (paths.tag[p] in PART or p == paths.container[p]) and 2 * linked[p] <= total[p]}
    part = {p for p in part if paths.state[p] == paths.state[best] or paths.state[p] == PLAIN}
    homes = {paths.container[p] for p in chosen}
    kept = [p in chosen or p in part and paths.container[p] in homes for p, *_ in found]
    for i in range(len(found) - 2, -1, -1):
        p = found[i][0]
        if not kept[i] and p in part and paths.tag[p] in PART and kept[i + 1]:
            kept[i] = paths.tag[p] in HEADING or i > 0 and kept[i - 1]
    return kept


def main_text(page: str | None) -> str:
    """The article's blocks joined by newlines; empty for a null or empty page or one without text."""
    paths, found = blocks(page) if page else (None, [])
    found = [x for x in found if paths.state[x[0]] != OUT]
    found = [x for x, there in zip(found, home(paths, found)) if there]
    return "\n".join(text for (_, _, text, _), keep in zip(found, content(paths, found)) if keep)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars``, its code points. One pass, no shuffle.

    Pages are whole; a null, empty or textless page gives empty text. Time and memory are linear in a page,
    however deep, long or broken its markup; a page that ends within a tag ends there. Rows, repeats and
    other columns stay, but for columns of the two names, which are replaced.
    """
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    inner = [f"c{i}" for i in range(len(kept))]

    def work(batches):
        for b in batches:
            texts = [main_text(x.as_py()) for x in b["html"]]
            made = [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), *made], names=[*inner, "text", "n_chars"])

    schema = T.StructType([*(T.StructField(n, pages.schema[c].dataType) for n, c in zip(inner, kept)), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    found = pages.select(*(F.col(c).alias(n) for c, n in zip(kept, inner)), F.col(html).alias("html")).mapInArrow(work, schema)
    return found.toDF(*kept, "text", "n_chars")


#: The query in DuckDB for pages of the given tables, whose text is all in one article element.
SQL = r"""
with articles as (select page_id, url, regexp_extract(html, '<article>(.*)</article>', 1, 's') article from pages),
blocks as (select page_id, url, list_transform(regexp_split_to_array(article, '</?(?:p|h1)>'), lambda b:
  trim(regexp_replace(replace(replace(replace(replace(regexp_replace(b, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))) b from articles),
texts as (select page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), chr(10)) as text from blocks)
select *, length(text) as n_chars from texts
"""
