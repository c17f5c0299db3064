"""Main-text extraction by a linear-chain conditional random field.

A page is read into its leaf blocks: runs of text between block-level tags,
in page order, with the path of open tags above them (a lenient reading:
unclosed and stray tags, comments, raw script and style text, pages that
break off).  Each block has features of its ancestor tags, of the words in
their class, id and role attributes, and of its text; neighbouring labels
are tied by transition weights.  The two labels are main text and the rest;
the best label sequence of a page is found by Viterbi.

Training: pages that mark their article (``article``, ``main`` or
``itemprop=articleBody``) are labelled by it, blocks inside being main text
unless a menu, header, footer, sidebar, notice, advert, form or comment
section holds them.  So that the model does not lean on one tag, each
training page is also read in rewritten forms: its article's tag is
replaced by plain containers with other names, and blocks of other kinds
are put around and into it.  The likelihood is maximised by full-batch
gradient steps, forward and backward over all pages at once.

Fitting uses at most ``pages`` labelled pages in hash order (a documented
bound); extraction covers every page and its whole html.

Defined results: null html is empty; a page without main text gives the
empty text; character references are decoded, white space within a block
becomes one space, blocks are joined by one space; script, style, template,
head, the annotations of formulas and the like never are text; repeated rows
get equal texts; without labelled pages a fixed model of the same features (the tag names' usual
roles) is used; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orrery.llm.base import carried
from orrery.llm.sampling import keyed, rows_in_hash_order, texts_of

PAGES = 240

#: fixed values: HTML elements by their role in a page
BLOCK = set("""address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt
 fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu
 nav noscript ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr
 ul br""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("script style template head title noscript svg object iframe audio video canvas select textarea button".split())
ANNOTATION = set("annotation annotation-xml".split())  # of formulas; never shown
SKIPPED |= ANNOTATION
#: elements that may stand in a head; any other start tag, or text, ends one that is open
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
#: elements that a new start tag closes, up to the nearest container
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = set("""address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5
 h6 header hr main menu nav ol p pre section table ul""".split())
BOILERPLATE = set("nav header footer aside form dialog menu".split())
BOXES = set("div section article main aside nav header footer form td body details dialog".split())
#: words of class, id and role attributes that name what is not the article
NOT_MAIN = set("""ad ads advert advertisement banner sponsor sponsored promo promoted cookie cookies consent gdpr notice notices
 alert popup modal overlay newsletter subscribe signup login register menu nav navbar navigation breadcrumb breadcrumbs
 pagination pager sidebar side rail widget related recommended share sharing social footer foot header masthead topbar
 toolbar search form comment comments reply replies respond discussion disqus feedback legal copyright skip hidden
 contentinfo complementary banner""".split())
#: passages that mark a notice
NOTICES = ("©", "(c)", "all rights reserved", "privacy", "subscribe", "sign in", "log in", "newsletter", "advertis", "sponsored", "accept all",
           "terms of", "share this", "read more", "related", "comment", "reply")


#: containers that a stray end of an inline element does not reach across
CONTAINERS = set("article main body table section div nav aside header footer".split())
ARTICLE = set("article main".split())
OUTER = set("nav footer aside form".split())  # an article in one of these is none


def tokens():
    """The reader: html -> list of (text, (place, is a link)).  A place is what
    the open tags amount to: block names, attribute words, the innermost
    block and container, and whether they are in a marked article or in a part
    that is tagged or named as something else.  It is kept by counting tags as
    they open and end, so a block costs the same at any depth; blocks share
    their place until a tag changes it.  ``known`` limits the attribute words
    that are kept to those."""
    import re
    from html import unescape
    part = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]+)?)*)>?", re.S)
    named = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
    word = re.compile(r"[a-z]+")
    none = frozenset()

    def attribute_words(attrs):
        if "=" not in attrs:
            return none
        found = " ".join(a or b or c for a, b, c in named.findall(attrs))
        return frozenset(word.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", found).lower()))

    class Place:
        __slots__ = ("names", "words", "leaf", "box", "not_main", "article", "marked", "aside", "before", "features")

    class Open:
        """An open tag and what it adds."""
        __slots__ = ("name", "open", "containers", "at", "block", "told", "words", "not_main", "article", "marked", "level")

    def read(html, known=None):
        blocks, path, blocks_open, text, at = [], [], [], [], 0
        count, inline = {}, {}  # open elements by name; the inline ones themselves
        names, words = {}, {}  # open block elements by name, open elements by attribute word
        bad, befores = [0], [False]  # by open article: parts of another kind below it; whether it lies in one
        not_main = article = marked = outer = 0  # open elements of these kinds
        boxes, place = [], None
        skip = 0  # how many open elements hold no text
        linked = 0  # characters of ``text`` inside links

        def flush():
            nonlocal text, linked
            if text:
                s = "".join(text)
                link = 2 * linked > len(s)
                s = " ".join(unescape(s).split())
                if s:  # a block counts as a link if most of it is one
                    blocks.append((s, (here(), link)))
                text, linked = [], 0

        def here():
            nonlocal place
            if place is None:
                place = Place()
                place.names, place.words, place.features = frozenset(names), frozenset(words), None
                place.leaf, place.box = path[blocks_open[-1]].name if blocks_open else "none", boxes[-1].at if boxes else -1
                place.not_main, place.article, place.marked = not_main > 0, article > 0, marked > 0
                place.aside, place.before = bad[-1] > 0, befores[-1]
            return place

        def tally(x, d):
            """Counts what a tag adds (d = 1) or takes away (-1)."""
            nonlocal skip, not_main, article, marked, outer, place
            count[x.name] = count.get(x.name, 0) + d
            skip += d * (x.name in SKIPPED)
            if x.name == "a":  # links count by the block, not by the path
                return
            place = None
            if x.block:
                c = names[x.name] = names.get(x.name, 0) + d
                if not c:
                    del names[x.name]
                outer += d * (x.name in OUTER)
            if x.told:
                not_main += d * x.not_main
                article += d * x.article
                marked += d * x.marked
                for w in x.words:
                    c = words[w] = words.get(w, 0) + d
                    if not c:
                        del words[w]
            if x.level is not None:
                bad[x.level] += d

        def start(name, ws):
            x = Open()
            x.name, x.open, x.at = name, True, at
            x.containers = (path[-1].containers if path else 0) + (name in CONTAINERS)
            x.block, x.told = name in BLOCK, bool(ws) or name in ARTICLE
            x.words, x.not_main, x.article = ws if known is None else ws & known, bool(ws & NOT_MAIN), "articlebody" in ws
            x.marked = name in ARTICLE or x.article or {"article", "body"} <= ws
            if name in ARTICLE:
                bad.append(0)
                befores.append(outer > 0)
                x.level = None
            else:
                x.level = len(bad) - 1 if path and (name in BOILERPLATE or x.not_main) else None
            if name in BOXES:
                boxes.append(x)
            if x.block:
                blocks_open.append(len(path))
            else:
                inline.setdefault(name, []).append(x)
            path.append(x)
            tally(x, 1)

        def shut(x):
            if x.open:
                x.open = False
                tally(x, -1)
                if x.name in ARTICLE:
                    bad.pop()
                    befores.pop()
                if boxes and boxes[-1] is x:
                    boxes.pop()

        def close(i):
            while len(path) > i:
                shut(path.pop())
            while blocks_open and blocks_open[-1] >= i:
                blocks_open.pop()

        def pop(i):
            flush()
            close(i)

        def last(name):
            """Place on the path of the innermost open ``name``."""
            return next(i for i in range(len(path) - 1, -1, -1) if path[i].name == name and path[i].open)

        n = len(html)
        while at < n:
            m = part.search(html, at)
            stop = m.start() if m else n
            if path and path[-1].name == "head" and not html[at:stop].isspace() and stop > at:
                pop(len(path) - 1)
            if stop > at and not skip:
                text.append(html[at:stop])
                if count.get("a"):
                    linked += stop - at
            if not m or m.end() == n and html[-1] != ">":  # a tag that the page breaks off in
                break
            at = m.end() if m.end() > m.start() else m.start() + 1
            name = (m.group(2) or "").lower()
            if not name:
                continue
            if m.group(1):
                if name == "br" or name == "p" and not count.get("p"):
                    flush()
                if not count.get(name):
                    continue
                if name in ANNOTATION or name == "math":  # ends what is open in it; the line goes on
                    if name in BLOCK or path[-1].containers == path[last(name)].containers:
                        close(last(name))
                elif name in BLOCK:
                    pop(last(name))
                else:
                    held = inline[name]
                    while not held[-1].open:
                        held.pop()
                    x = held[-1]
                    if path[-1].containers != x.containers:
                        continue  # a stray end of an inline element
                    if name in SKIPPED:
                        pop(last(name))
                        continue
                    shut(x)
                    while path and not path[-1].open:
                        path.pop()
                continue
            if name in BLOCK:
                flush()
            for i in reversed(blocks_open):
                x = path[i].name
                if x in CLOSES.get(name, ()) or x == "p" and name in ENDS_P:
                    pop(i)
                    break
                if x != "p" and x not in CLOSES.get(name, ()):
                    break
            if path and path[-1].name == "head" and name not in IN_HEAD:
                pop(len(path) - 1)
            elif (name == "body" or name == "article") and count.get("head"):  # a head that was never closed ends here
                pop(next(i for i, x in enumerate(path) if x.name == "head"))
            if name in VOID or m.group(3).rstrip().endswith("/") and name not in BLOCK:
                continue
            if name in ("script", "style"):  # raw text up to its end tag
                end = re.compile(r"</" + name + r"[\s/>]", re.I).search(html, at)
                if end is None:
                    break
                at = html.find(">", end.start()) + 1 or n
                continue
            start(name, attribute_words(m.group(3)))
        flush()
        return blocks
    return read


def block_features():
    """Function: blocks of a page -> for each the features of its place, as
    [names, weight or None] shared by all blocks of such places, and a list of
    the names of its own features."""
    import re
    link_only = re.compile(r"[^\w]*$")
    cookie = re.compile(r"cookies?\b")

    def notice(text):
        low = text.lower()
        return any([x in low for x in NOTICES]) or "cookie" in low and cookie.search(low) is not None

    seen = {}

    def above(place):
        """Features of the open tags, made once for all places alike."""
        key = place.leaf, place.names, place.words, place.not_main
        held = seen.get(key)
        if held is None:
            f = ["bias", "leaf=" + place.leaf, *("in=" + x for x in place.names if x not in ("html", "body", "p")),
                 *("word=" + w for w in place.words)]
            if place.not_main:
                f.append("named-not-main")
            if BOILERPLATE & place.names:
                f.append("in-boilerplate")
            if len(seen) > 20_000:
                seen.clear()
            held = seen[key] = [f, None]
        return held

    def of(blocks):
        out, n = [], len(blocks)
        chars, linked = {}, {}  # text and link text of each innermost container
        for text, (place, link) in blocks:
            chars[place.box] = chars.get(place.box, 0) + len(text)
            if link:
                linked[place.box] = linked.get(place.box, 0) + len(text)
        for i, (text, (place, link)) in enumerate(blocks):
            if place.features is None:
                place.features = above(place)
            c = chars[place.box]
            f = ["in-link"] if link else []
            k = len(text)
            f.append("chars=%d" % (0 if k < 12 else 1 if k < 40 else 2 if k < 120 else 3 if k < 400 else 4))
            f.append("ends=" + (text[-1] if text[-1] in ".!?:|,;" else "letter" if text[-1].isalpha() else "other"))
            box = 0 if c < 60 else 1 if c < 200 else 2 if c < 600 else 3
            f.append("box=%d" % box)
            if not (place.not_main or BOILERPLATE & place.names or link):
                f += ["clean", "clean,box=%d" % box, "clean,leaf=" + place.leaf]
                if "article" in place.names or "main" in place.names or place.article:
                    f.append("clean,article")
            if linked.get(place.box, 0) > c / 2:
                f.append("box-of-links")
            if notice(text):
                f.append("notice")
            if link_only.match(text):
                f.append("no-words")
            f.append("at=" + ("first" if i == 0 else "last" if i == n - 1 else "middle"))
            out.append((place.features, f))
        return out
    return of


def silver(blocks):
    """Labels of a page that marks its article, else None."""
    if not any(place.marked for _, (place, _) in blocks):
        return None
    return [int(place.marked and not place.aside and not place.before) for _, (place, _) in blocks]


def rewritten(blocks, labels, rng) -> list[tuple]:
    """The page in other clothes: its main blocks in containers of other
    names, passages of it as menus, notices, sidebars, forms, comments.
    Gives (parts as (html, label), opening tags, closing tags)."""
    import re
    from html import escape
    main = [t for (t, _), y in zip(blocks, labels) if y]
    rest = [t for (t, _), y in zip(blocks, labels) if not y] or ["Home", "About us"]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]

    def some(a, b):
        """Short passages in the manner of the page: from either kind of block."""
        made = []
        for _ in range(int(rng.integers(a, b))):
            w = pick(main + rest).split() if main else pick(rest).split()
            i = int(rng.integers(max(1, len(w))))
            made.append(escape(" ".join(w[i:i + int(rng.integers(2, 30))])))
        return made

    def para(xs):
        return "".join(f"<p>{x}</p>" for x in xs)

    def items(xs, link=True):
        return "<ul>" + "".join(f"<li><a href='#'>{x}</a></li>" if link else f"<li>{x}</li>" for x in xs) + "</ul>"

    kinds = [
        lambda: f"<nav>{items(some(2, 7))}</nav>", lambda: f"<div class='{pick(['menu', 'navbar', 'nav-main'])}'>{items(some(2, 7))}</div>",
        lambda: f"<header><div class='site-title'>{pick(some(1, 2))}</div>{items(some(1, 4))}</header>",
        lambda: f"<aside>{para(some(1, 4))}</aside>", lambda: f"<div class='{pick(['sidebar', 'side widget', 'related'])}'><h3>Related</h3>{items(some(1, 6))}</div>",
        lambda: f"<div class='{pick(['ad', 'advert', 'banner-ad', 'sponsored', 'promo'])}'>{pick([para(some(1, 2)), pick(some(1, 2))])}</div>",
        lambda: f"<div id='{pick(['cookie-notice', 'consent', 'gdpr-banner', 'notice'])}'>{para(some(1, 2))}<button>OK</button></div>",
        lambda: f"<form><label>{pick(some(1, 2))}</label><input><p>{pick(some(1, 2))}</p></form>",
        lambda: f"<section class='{pick(['comments', 'comment-list', 'replies'])}'><h2>Comments</h2>{''.join(f'<div class=comment><p>{x}</p></div>' for x in some(1, 5))}</section>",
        lambda: f"<ul class='{pick(['breadcrumb', 'pagination', 'share social'])}'>{''.join(f'<li>{x}</li>' for x in some(1, 4))}</ul>",
        lambda: f"<footer>{para(some(1, 3))}</footer>", lambda: f"<div class='{pick(['footer', 'copyright', 'legal'])}'>&copy; {pick(some(1, 2))}</div>"]
    shells = [("<article>", "</article>"), ("<main>", "</main>"), ("<div class='content'>", "</div>"), ("<div id='post'>", "</div>"),
              ("<div>", "</div>"), ("<main><article>", "</article></main>"), ("<section class='story-text'>", "</section>"),
              ("<div class='entry'><article>", "</article></div>")]
    names = re.compile(r" (?:class|id)='?[\w -]+'?")

    def other(some_kinds):
        """One of the kinds; lists of links also without telling names."""
        html = pick(some_kinds)()
        return names.sub("", html) if "<a " in html and rng.random() < 0.4 else html

    out = []
    for _ in range(2):
        parts = [("<html><body>" + "".join(other(kinds[:7]) for _ in range(int(rng.integers(0, 4)))), 0)]
        opened, closed = pick(shells)
        kept = main[:int(rng.integers(1, 4))] if rng.random() < 0.3 else main  # short articles too
        short = 0.08 if len(kept) > 1 else 0.6  # and short blocks
        for i, t in enumerate(kept):
            form = pick(["<p>%s</p>"] * 6 + ["<h2>%s</h2>", "<blockquote><p>%s</p></blockquote>", "<ul><li>%s</li></ul>",
                                             "<div>%s</div>"]) if i else "<h1>%s</h1>"
            if rng.random() < (0.5 if form[1] in "hu" else short):
                t = " ".join(t.split()[:int(rng.integers(1, 5))])
            parts.append((form.replace("%s", escape(t)), 1))
            if rng.random() < 0.08:
                parts.append((other(kinds[3:9]), 0))
        parts.append(("".join(other(kinds[3:]) for _ in range(int(rng.integers(0, 4)))) + "</body></html>", 0))
        out.append((parts, opened, closed))
    return out


def fit(pages: list[str], steps: int = 200, rate: float = 0.2, ridge: float = 3e-5, seed: int = 9, min_pages: int = 2):
    """{feature: weight of main text over the rest} and transition weights
    from whole pages."""
    import numpy as np
    rng = np.random.default_rng(seed)
    read, of = tokens(), block_features()
    chains = []
    for html in pages:
        blocks = read(html)
        labels = silver(blocks) if blocks else None
        if labels is None:
            continue
        chains.append((of(blocks), labels))
        for parts, opened, closed in rewritten(blocks, labels, rng):
            html = [x for x, _ in parts]
            got = read(html[0] + opened + "".join(html[1:-1]) + closed + html[-1])
            want = [y for x, y in parts for _ in read(x)]
            if len(got) == len(want):
                chains.append((of(got), want))
    if not chains:
        return None
    seen = {}
    for fs, _ in chains:
        for f in {x for held, own in fs for x in (*held[0], *own)}:
            seen[f] = seen.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, c in seen.items() if c >= min_pages))}
    longest, n = max(len(y) for _, y in chains), len(chains)
    rows, cols, y, mask = [], [], np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for c, (fs, labels) in enumerate(chains):
        y[c, :len(labels)], mask[c, :len(labels)] = labels, True
        for i, (held, own) in enumerate(fs):
            k = [index[x] for x in (*held[0], *own) if x in index]
            rows += [c * longest + i] * len(k)
            cols += k
    rows, cols = np.array(rows), np.array(cols)
    w, trans, start = np.zeros(len(index)), np.zeros((2, 2)), np.zeros(2)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, trans, start)]
    total = mask.sum()
    for t in range(1, steps + 1):
        e = np.zeros((n, longest, 2))
        e[:, :, 1] = np.bincount(rows, w[cols], n * longest).reshape(n, longest)
        a, b = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        a[:, 0] = e[:, 0] + start
        for i in range(1, longest):
            step = np.logaddexp.reduce(a[:, i - 1, :, None] + trans, axis=1) + e[:, i]
            a[:, i] = np.where(mask[:, i, None], step, a[:, i - 1])
        for i in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(trans + (e[:, i + 1] + b[:, i + 1])[:, None, :], axis=2)
            b[:, i] = np.where(mask[:, i + 1, None], step, 0)
        z = np.logaddexp.reduce(a[:, -1], axis=1)
        node = np.exp(np.clip(a + b - z[:, None, None], -50, 0)) * mask[:, :, None]
        edge = np.exp(np.clip(a[:, :-1, :, None] + trans + (e + b)[:, 1:, None, :] - z[:, None, None, None], -50, 0)) * mask[:, 1:, None, None]
        real = np.zeros((2, 2))
        np.add.at(real, (y[:, :-1][mask[:, 1:]], y[:, 1:][mask[:, 1:]]), 1)
        grads = [np.bincount(cols, (node[:, :, 1] - y * mask).ravel()[rows], len(w)) / total + ridge * w,
                 (edge.sum((0, 1)) - real) / total + ridge * trans,
                 (node[:, 0].sum(0) - np.bincount(y[:, 0], minlength=2)) / total + ridge * start]
        for x, g, s in zip((w, trans, start), grads, state):
            s[0], s[1] = 0.9 * s[0] + 0.1 * g, 0.99 * s[1] + 0.01 * g * g
            x -= rate * (s[0] / (1 - 0.9 ** t)) / (np.sqrt(s[1] / (1 - 0.99 ** t)) + 1e-8)
    return {f: float(w[i]) for f, i in index.items()}, trans.tolist(), start.tolist()


#: used when no page marks its article: the elements' usual roles
FIXED = ({"bias": 0.5, "in-boilerplate": -9.0, "named-not-main": -9.0, "in-link": -1.0, "notice": -1.0, "in=article": 4.0,
          "in=main": 3.0, "leaf=p": 1.0, "leaf=li": -0.5, "chars=0": -1.0, "chars=3": 1.0, "chars=4": 1.0},
         [[0.5, 0.0], [0.0, 0.5]], [0.0, 0.0])


def viterbi(scores, trans, start) -> list[int]:
    """Best labels for emission scores of label 1 (label 0 scores 0)."""
    (t00, t01), (t10, t11) = trans
    a, b, back = start[0], start[1] + scores[0], []
    for s in scores[1:]:
        stay, leave = a + t00 >= b + t10, a + t01 > b + t11
        back.append((0 if stay else 1, 0 if leave else 1))
        a, b = max(a + t00, b + t10), max(a + t01, b + t11) + s
    y = [0 if a >= b else 1]
    for k in reversed(back):
        y.append(k[y[-1]])
    return y[::-1]


def extractor(model):
    """Function: html -> main text."""
    weights, trans, start = model
    read, of = tokens(), block_features()
    known = frozenset(f[5:] for f in weights if f.startswith("word="))

    def emission(held, own):
        if held[1] is None:
            held[1] = sum([weights.get(f, 0.0) for f in held[0]])
        return held[1] + sum([weights[f] for f in own if f in weights])

    def main_text(html):
        blocks = read(html or "", known)
        if not blocks:
            return ""
        labels = viterbi([emission(held, own) for held, own in of(blocks)], trans, start)
        return " ".join(t for (t, _), y in zip(blocks, labels) if y)
    return main_text


def train(pages: DataFrame, n: int = PAGES, seed: int = 9, max_chars: int = 20_000_000):
    """Model from at most ``n`` pages (page_id, html) that mark an article,
    in hash order, and at most ``max_chars`` characters of them."""
    labelled = pages.filter(F.lower("html").rlike(r"<(article|main)\b|articlebody"))
    rows = keyed(labelled, "page_id", "html")  # repeated rows teach once
    chosen, used = [], 0
    for r in rows_in_hash_order(rows, n, seed, "page"):
        if used + r["n"] <= max_chars:
            used += r["n"]
            chosen.append((r["id"], r["t"], True))
    if not chosen:
        return FIXED
    return fit([r["text"] for r in texts_of(rows, chosen, "chosen boolean").orderBy("id", "t").collect()], seed=seed) or FIXED


def _extract_kernel(model):
    def run(batches):
        import pyarrow as pa
        main_text = extractor(model)
        for b in batches:
            texts = [main_text(h) for h in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string())], names=["row", "text"])
    return run


def extract(pages: DataFrame, model) -> DataFrame:
    """``pages`` without html, with ``text``: the main text of every page."""
    rows, names = carried(pages.drop("text"), "html")
    schema = StructType([rows.schema["row"], StructField("text", StringType())])
    return rows.mapInArrow(_extract_kernel(model), schema).select(*[F.col("row")[c].alias(c) for c in names], "text")
