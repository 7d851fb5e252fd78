"""Main-text extraction by equivalence-class template deduction.

1. Every page becomes tokens: its container elements, told apart by their path,
   and its blocks of text, told apart by path and content.
2. Over all pages of a host, a token's occurrence vector says how often it
   occurs on each page. It is folded into one number, the exclusive-or of the
   hashes of (page, count), which aggregates before the shuffle, so a host may
   hold any share of all pages. Tokens with equal vectors form a class. A class
   is valid if it has several tokens and enough pages, and its tokens' parents
   belong to valid classes too: the classes nest as the paths do and make up
   the host's template.
3. What lies between template tokens are slots. Texts that the template repeats
   on every page, and slots whose elements are menus, headers, footers,
   sidebars, notices, adverts, forms or comments, are not content. An element's
   class, id or role is evidence of that, not a verdict: it does not count on
   the page's own html, body, article and main elements, on an element that
   holds most of the articles' text, or, where it is weak (a listed word beside
   others), on one that holds most of its article or page. The main
   slots are those in the template's article or main elements; a host without
   them has as main slots the others that hold text and not mostly links. A
   container that the template does not know (an optional list, a rare layout)
   belongs to the slot around it; outside all slots with text of their own it
   is content unless it is mostly links on its page.
   Inside articles, a text that every page with an article holds in the same
   place is the template's too, unless such texts are more than ``SAME_SHARE``
   of all article text of the host: then its pages are equal, not templated.

A page is then read again with its host's template, and the blocks of its main
slots are its text. On a page outside the template (a host with few pages, say),
the same marks are taken from the page itself.

Defined cases: null html is empty; a page without content has an empty text;
unclosed elements end with their parent, an unclosed comment or script with the
page; a null or malformed URL belongs to the host named by the empty string;
rows that share a ``page_id`` are pages of their own if they differ in html, and
get equal results if not; an empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, ship

MIN_PAGES = 3           # pages a class must occur on
MIN_SHARE = 0.05        # and their least share of the host's pages
SAME_SHARE = 0.5        # of a host's article text that may be template text
LINK_SHARE = 0.5        # of a slot's text that may be links, where no element marks the article
HOLDS = 0.5             # of the articles' (or the page's) text: an element with so much is not set aside by its names
BROADCAST_ROWS = 50_000

# Elements and names by their role in HTML.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "button", "head"}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "nav", "header", "footer", "aside", "form", "ul", "ol",
              "dl", "table", "figure", "details", "dialog", "menu", "fieldset", "center"}
BLOCKS = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "caption", "blockquote",
                       "pre", "figcaption", "address", "summary", "hr", "tbody", "thead", "tfoot", "hgroup"}
MAIN = {"article", "main"}
ASIDE = {"nav", "footer", "aside", "dialog", "menu"}
ASIDE_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "cookie", "cookies",
               "consent", "notice", "alert", "popup", "modal", "overlay", "comment", "comments", "disqus", "replies", "sidebar",
               "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "share",
               "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login",
               "search", "toolbar", "pagination", "pager", "widget", "skip"}
COMMENT_NAMES = {"comment", "comments", "disqus", "replies"}
# words beside a listed one that leave its meaning, and words that say the state of something else
NEUTRAL_NAMES = {"area", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "group", "icon", "icons",
                 "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "page", "panel", "post", "posts",
                 "primary", "respond", "right", "secondary", "section", "site", "text", "thread", "top", "wrap", "wrapper"}
STATE_NAMES = {"has", "with", "no", "is", "not", "js", "open", "closed", "enabled", "disabled"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "alert", "dialog"}
HEADERS = {"header"}    # a page's own header; inside an article it holds the headline

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>""")
OPEN = re.compile(r"<(?=[A-Za-z/!?])")
ATTRIBUTE = re.compile(r"""([A-Za-z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
NAME = re.compile(r"[a-z]+")
HOST = re.compile(r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)")


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


def _marks(name: str, rest: str) -> tuple[str, int, bool]:
    """An element's signature (its name with its classes and id, without digits), how strongly they set it aside (2, 1
    or 0), and whether they name comments."""
    said = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(rest)} if "=" in rest else {}
    names, level = [], 2 * (said.get("role") in ASIDE_ROLES or "hidden" in rest.lower().split())
    for token in (t for k in ("class", "id") for t in said.get(k, "").split()):
        words = NAME.findall(token)
        names += words
        listed = [w for w in words if w in ASIDE_NAMES]
        if listed and not any(w in STATE_NAMES for w in words):
            level = max(level, 2 if all(w in ASIDE_NAMES or w in NEUTRAL_NAMES for w in words) else 1)
    return ".".join([name, *names]), max(level, int(name == "form")), any(x in COMMENT_NAMES for x in names)


def blocks(html: str):
    """Yields ``(kind, path, parent, in_main, aside, text, link)`` of a page, in order.

    Kind 0 is a container that opens; kind 1 a block of text with ``link`` of its characters in links.
    A path is one number, made from the parent's path and the element's signature.
    """
    elements, items = [("", 0, 0, "", 0, False)], []       # name, parent, path, signature, level, comments
    for kind, at, name, rest, text, link in _parsed(html):
        if kind == 0:
            signature, level, comments = _marks(name, rest)
            elements.append((name, at, _path(signature, elements[at][2]), signature, level, comments))
            items.append((0, len(elements) - 1, "", 0))
        else:
            items.append((1, at, text, link))

    # text below each element, and of it what lies in the outermost articles
    chars, article = [0] * len(elements), [0] * len(elements)
    for kind, at, text, _ in items:
        chars[at] += len(text)
    outer = [0] * len(elements)                 # the outermost article or main element that an element lies in, or is
    barred = [False] * len(elements)            # set aside by its tag
    for i, (name, up, *_) in enumerate(elements[1:], 1):
        outer[i] = outer[up] or (i if name in MAIN else 0)
        barred[i] = barred[up] or name in ASIDE or (name in HEADERS and not outer[i])
    for i in range(len(elements) - 1, 0, -1):
        if outer[i] == i and not barred[i]:
            article[i] = chars[i]
        up = elements[i][1]
        chars[up] += chars[i]
        article[up] += article[i]
    aside = list(barred)
    for i, (name, up, _, _, level, comments) in enumerate(elements[1:], 1):
        if level and name not in MAIN and name not in ("html", "body"):
            if outer[i]:
                whole = level == 1 and chars[i] >= HOLDS * chars[outer[i]]
            elif article[0]:
                whole = not comments and article[i] > 0 and article[i] >= HOLDS * article[0]
            else:
                whole = level == 1 and chars[i] >= HOLDS * chars[0]
            aside[i] = aside[i] or not whole
        aside[i] = aside[i] or aside[up]
    for kind, at, text, link in items:
        _, up, path, *_ = elements[at]
        yield (kind, path, elements[up][2] if kind == 0 else path, bool(outer[at]), aside[at], text, link)


def _path(signature: str, parent: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(signature, parent) >> 1


def _parsed(html: str):
    """Yields ``(0, parent, name, attributes, "", 0)`` for a container that opens and ``(1, container, "", "", text, link)``
    for a block of text; containers are numbered as they open, from 1, and 0 is the page."""
    from html import unescape

    # name and number of the open containers
    stack, opened, text, at, link, linked = [("", 0)], 0, [], 0, 0, False
    lost: set[str] = set()
    last = html.rfind(">")

    def block():
        nonlocal text, link
        said = " ".join(unescape("".join(text)).split())
        linked_chars, text, link = link, [], 0
        return (1, stack[-1][1], "", "", said, min(linked_chars, len(said))) if said else None

    def said(piece):
        nonlocal link
        text.append(piece)
        if linked:
            link += len(piece.strip())

    while at < len(html):
        m = OPEN.search(html, at) if at <= last else None
        if not m:
            said(html[at:].split("<!--")[0])
            break
        if m.start() > at:
            said(html[at:m.start()])
        at = m.start()
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            at = len(html) if end < 0 else end + 3
            continue
        if html[at + 1] in "!?":
            end = html.find(">", at)
            at = len(html) if end < 0 else end + 1
            continue
        m = TAG.match(html, at) if at <= last else None
        if not m:
            said(html[at])
            at += 1
            continue
        at = m.end()
        closing, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        name = name.lower()
        if name in RAW and not closing and not rest.endswith("/"):
            # the whole element is skipped; looked for once where it never ends
            end = -1 if name in lost else _closing(html, name, at)
            if end >= 0:
                at = end
            elif name in ("head", "button", "svg", "noscript", "iframe"):
                lost.add(name)
            else:
                at = len(html)
            continue
        if name == "a":
            linked = not closing
        if name == "br":
            text.append(" ")
        if name not in BLOCKS:
            continue
        if (b := block()):
            yield b
        if name not in CONTAINERS:
            continue
        if closing:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if k:
                del stack[k:]
                linked = False
        elif not rest.endswith("/"):
            yield 0, stack[-1][1], name, rest, "", 0
            opened += 1
            stack.append((name, opened))
    if (b := block()):
        yield b


_CLOSERS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


def _closing(html: str, name: str, at: int) -> int:
    m = _CLOSERS[name].search(html, at)
    return m.end() if m else -1


def _text_token(path: int, text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), path) >> 1


def _tokens(batches):
    """Pages to tokens: how often each occurs on a page, and the text directly in it; the page itself holds its article text."""
    import pyarrow as pa
    import xxhash

    names = ["host", "page", "token", "parent", "n", "kind", "main", "aside", "chars", "links", "article"]
    kinds = [pa.string(), *[pa.int64()] * 4, pa.int32(), pa.bool_(), pa.bool_(), *[pa.int64()] * 3]
    for b in batches:
        for k in range(0, b.num_rows, 256):
            part, rows = b.slice(k, 256), []
            for page_id, url, html in zip(*part.columns):
                html, host = html.as_py() or "", host_of(url.as_py())
                page = xxhash.xxh64_intdigest(f"{page_id.as_py()} {html}".encode("utf-8", "surrogatepass")) >> 1
                found: dict = {0: [0, 1, 0, False, False, 0, 0, 0]}     # the page itself
                for kind, path, parent, main, aside, text, link in blocks(html):
                    if kind == 0:
                        found.setdefault(path, [parent, 0, 0, main, aside, 0, 0, 0])[1] += 1
                    else:
                        slot = found.setdefault(path, [parent, 0, 0, main, aside, 0, 0, 0])
                        slot[5] += len(text)
                        slot[6] += link
                        if not aside:
                            said = found.setdefault(_text_token(path, text), [path, 0, 1, main, aside, 0, 0, 0])
                            said[1] += 1
                            said[7] += len(text) if main else 0
                            found[0][7] += len(text) if main else 0
                rows += [(host, page, t, *x) for t, x in found.items()]
            cols = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)


def templates(pages: DataFrame) -> DataFrame:
    """``(host, slots, linked, bare, repeated)``: each host's slots of text, its slots that are mostly links, its containers
    without text of their own, and the texts its template repeats."""
    ship(pages.sparkSession)
    tokens = pages.select("page_id", "url", "html").mapInArrow(
        _tokens, "host string, page long, token long, parent long, n long, kind int, main boolean, aside boolean, "
        "chars long, links long, article long")
    each = tokens.groupBy("host", "token").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count(F.lit(1)).alias("pages"), F.min("parent").alias("parent"),
        F.min("kind").alias("kind"), F.max("main").alias("main"), F.max("aside").alias("aside"),
        F.sum("chars").alias("chars"), F.sum("links").alias("links"),
        F.sum("article").alias("article"), F.count_if(F.col("article") > 0).alias("articles"))
    each = materialize(each.where(F.col("pages") >= MIN_PAGES), "html-tokens")
    whole = each.where("token = 0").select("host", F.col("pages").alias("of"), F.col("vector").alias("every"),
                                          F.col("article").alias("all_article"), F.col("articles").alias("of_articles"))
    enough = each.join(whole, "host").where(F.col("pages") >= MIN_SHARE * F.col("of"))
    classes = enough.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    valid = materialize(enough.join(classes, ["host", "vector"]).drop("size"), "html-valid")
    # nested: the parent is a token of a valid class as well
    up = valid.where("kind = 0").select("host", F.col("token").alias("parent"))
    nested = valid.where("token <> 0").join(up, ["host", "parent"], "left_semi")
    slots = nested.groupBy("host").agg(
        F.collect_set(F.expr(f"CASE WHEN kind = 0 AND NOT aside AND chars > 0 AND links <= {LINK_SHARE} * chars THEN token END"
                             )).alias("slots"),
        F.collect_set(F.expr(f"CASE WHEN kind = 0 AND NOT aside AND links > {LINK_SHARE} * chars THEN token END")).alias("linked"),
        F.collect_set(F.expr("CASE WHEN kind = 0 AND NOT aside AND chars = 0 THEN token END")).alias("bare"),
        F.collect_set(F.expr("CASE WHEN kind = 1 AND NOT main AND vector = every THEN token END")).alias("repeated"))
    # inside articles: what all pages with an article hold, on a host whose articles differ otherwise
    same = each.join(whole, "host").where("kind = 1 AND main AND articles = of_articles").groupBy("host").agg(
        F.collect_set("token").alias("same"), F.sum("article").alias("article"), F.max("all_article").alias("all_article"))
    same = same.where(F.col("article") <= SAME_SHARE * F.col("all_article")).select("host", "same")
    none = F.array().cast("array<bigint>")
    found = slots.join(same, "host", "full_outer")
    return materialize(found.select("host", *[F.coalesce(c, none).alias(c) for c in ("slots", "linked", "bare")], F.concat(
        F.coalesce("repeated", none), F.coalesce("same", none)).alias("repeated")), "html-templates")


def main_text(html: str | None, template=None) -> str:
    """The blocks of a page's main slots, joined by an empty line."""
    read = list(blocks(html or ""))
    found = [b for b in read if b[0] == 1 and not b[4]]
    marked = any(b[3] for b in found)
    if template is not None:
        slots, linked, bare, repeated = template
        if repeated:
            found = [b for b in found if _text_token(b[1], b[5]) not in repeated]
    if marked:
        # article blocks in containers that the template does not know still belong to the article
        return "\n\n".join(b[5] for b in found if b[3])
    if template is None:
        return "\n\n".join(b[5] for b in found if b[6] <= LINK_SHARE * len(b[5]))
    parents = {b[1]: b[2] for b in read if b[0] == 0}
    within: dict = {}        # by container: the slot it belongs to, or its outermost container outside all slots
    shares: dict = {}        # of the latter, characters and those in links

    def place(path):
        at, top = path, path
        while at and at not in slots and at not in linked and at not in bare:
            at, top = parents.get(at, 0), at
        return at if at in slots or at in linked else top

    for b in found:
        at = within[b[1]] if b[1] in within else within.setdefault(b[1], place(b[1]))
        share = shares.setdefault(at, [0, 0])
        share[0] += len(b[5])
        share[1] += b[6]
    return "\n\n".join(b[5] for b in found if (at := within[b[1]]) in slots or (
        at not in linked and shares[at][1] <= LINK_SHARE * shares[at][0]))


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``."""
    found = templates(pages)
    if found.count() <= BROADCAST_ROWS:      # a template has at most some hundred tokens
        found = F.broadcast(found)

    def hosts(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([host_of(u.as_py()) for u in b.column(1)], pa.string())],
                                             ["page_id", "url", "html", "host"])

    def run(batches):
        import pyarrow as pa

        known: dict = {}
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part, texts = b.slice(k, 256), []
                for html, host, *template in zip(*part.columns[2:]):
                    host = host.as_py()
                    if host not in known:
                        if len(known) > 1000:
                            known.clear()
                        known[host] = None if template[0].as_py() is None else [set(x.as_py()) for x in template]
                    texts.append(main_text(html.as_py(), known[host]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    placed = pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        hosts, "page_id long, url string, html string, host string")
    return placed.join(found, "host", "left").select("page_id", "url", "html", "host", "slots", "linked", "bare", "repeated").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
