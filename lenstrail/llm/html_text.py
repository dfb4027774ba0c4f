"""Main text of web pages by tag path ratios.

A page is read once into text nodes with their root-to-leaf paths of block tags.  Per path,
text length and punctuation are summed over its nodes; the two ratios (text per node and
punctuation per node) are smoothed over neighbouring nodes in page order and fused by
multiplication.  Paths whose fused value reaches a share of the page's spread are content.
The article is the deepest element that holds all content blocks, or an article or main element
around most of the content text: all content is kept, and the headings and short lines of the
article.  Parts that HTML or their class and id names mark as furniture (menus, adverts, forms,
comments and so on) never count.  A name is furniture as a whole token (`sidebar`, not
`with-sidebar`) or in a common pair (`cookie-notice`), and not on an element that holds most of
the page's text.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lenstrail.llm.common import short_batches, slices

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>?", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I | re.S)
_WORD = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?。，；：！？、]")

# Tag names of the HTML standard and common names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
FURNITURE_TAGS = frozenset("nav footer aside form head menu dialog button select option fieldset datalist canvas audio video map".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar comment comments commentlist respond "
    "reply replies discussion disqus cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations widget "
    "pagination pager copyright skip hidden form search".split()
)
# Words that say nothing beside a furniture word: `site-footer` is furniture, `search-result` is not.
LAYOUT_NAMES = frozenset(
    "site main page global primary secondary left right top bottom area list box wrapper wrap container block section inner outer bar "
    "button buttons link links post posts item items widget header text".split()
)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol table dl body html article section div main blockquote".split())


NAMED, SURE = 1, 2  # furniture by its class or id only, or in any case


def _furniture(tag: str, attributes: str, in_article: bool) -> int:
    if tag in FURNITURE_TAGS:
        return SURE
    if tag == "header" and not in_article:
        return SURE
    found = 0
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            for token in value.split():
                words = set(_WORD.findall(token))
                if not FURNITURE_NAMES.isdisjoint(words) and words <= FURNITURE_NAMES | LAYOUT_NAMES:
                    found = NAMED
        elif name == "role" and value in FURNITURE_ROLES:
            return SURE
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return SURE
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return SURE
    return found


def _without_named(out: list, named: set[int]) -> list:
    """Blocks outside elements named as furniture, but for those that hold most of the page.

    These have more than half of the text with the page's heading or main element, or nearly all.
    """
    if not named:
        return out
    total = sum(len(t) for _, _, t in out)
    for e in sorted(named):
        held = [(p, t) for elements, p, t in out if e in elements]
        n = sum(len(t) for _, t in held)
        if 2 * n > total and (n > 0.9 * total or any(re.search(r"/(h1|main)(/|$)", p) for p, _ in held)):
            named = named - {e}
    return [b for b in out if named.isdisjoint(b[0])]


def blocks(page: str) -> list[tuple[tuple[int, ...], str, str]]:
    """(element numbers from the root, tag path, text) of every block outside furniture."""
    out: list = []
    stack: list[tuple[str, int, str, bool]] = [("", 0, "", False)]  # tag, element, path, furniture
    text: list[str] = []
    named: set[int] = set()
    count = 0

    def flush():
        if text:
            words = html.unescape("".join(text)).split()
            text.clear()
            if words and not stack[-1][3]:
                out.append((tuple(s[1] for s in stack), stack[-1][2], " ".join(words)))

    def close(k):
        del stack[k:]

    end = 0
    skip_to = None
    for m in _TOKEN.finditer(page):
        if skip_to is not None:
            if not (m[1] and m[2].lower() == skip_to):
                continue
            skip_to, end = None, m.end()
            continue
        if m.start() > end and not stack[-1][3]:
            text.append(page[end : m.start()])
        end = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in RAW:
            if not m[1] and not m[3].endswith("/"):
                # the end is searched as text: quotes and tags inside do not count
                found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, end)
                if not found:
                    end = len(page)
                    break
                skip_to = tag
                end = found.end()
            continue
        if tag == "br":
            text.append(" ")
            continue
        inline = tag in INLINE
        if m[1]:
            if inline:
                k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
                if k:  # furniture held in an inline element
                    flush()
                    close(k)
                continue
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            flush()
            if k:
                close(k)
            continue
        in_article = any(s[0] in ("article", "main") for s in stack)
        kind = SURE if stack[-1][3] else _furniture(tag, m[3], in_article)
        if inline:
            if kind and not stack[-1][3] and tag not in VOID:
                flush()
                count += 1
                stack.append((tag, count, f"{stack[-1][2]}/{tag}", kind == SURE))
                if kind == NAMED:
                    named.add(count)
            continue
        flush()
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in SCOPE:
                    break
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in SAME.get(tag, ()):
                close(k)
                break
            if stack[k][0] in SCOPE:
                break
        if tag in VOID or m[3].endswith("/"):
            continue
        count += 1
        stack.append((tag, count, f"{stack[-1][2]}/{tag}", stack[-1][3] or kind == SURE))
        if kind == NAMED:
            named.add(count)
    if end < len(page) and skip_to is None:
        tail = page[end:]
        cut = tail.rfind("<")  # a tag that the page's end cuts off
        if cut >= 0 and re.match(r"</?[a-zA-Z!]?[^>]*\Z", tail[cut:]):
            tail = tail[:cut]
        text.append(tail)
    flush()
    return _without_named(out, named)


def main_text(page: str | None, *, share: float = 0.35, reach: int = 1) -> str:
    """The article's blocks, one per line.  Empty for a page without text or NULL.

    `share` is the part of the standard deviation of fused ratios that content reaches,
    `reach` the nodes on either side that smooth a ratio.
    """
    found = blocks(page) if page else []
    if not found:
        return ""
    paths = {p: k for k, p in enumerate(dict.fromkeys(p for _, p, _ in found))}
    of = np.array([paths[p] for _, p, _ in found])
    length = np.array([len(t) for _, _, t in found], float)
    points = np.array([len(_PUNCTUATION.findall(t)) for _, _, t in found], float)
    nodes = np.bincount(of)
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / 2.0)

    def smoothed(per_path):
        x = np.convolve(per_path[of], kernel)[reach : reach + len(of)]
        weight = np.convolve(np.ones(len(of)), kernel)[reach : reach + len(of)]
        return np.bincount(of, x / weight) / nodes  # back to one value per path

    fused = smoothed(np.bincount(of, length) / nodes) * smoothed(1 + np.bincount(of, points) / nodes)
    content = fused >= min(share * (np.std(fused[of]) + np.mean(fused[of])), fused.max())
    held: dict[int, float] = {}
    for (elements, _, _), k, n in zip(found, of, length, strict=True):
        if content[k]:
            for e in elements:
                held[e] = held.get(e, 0.0) + n
    whole = held[0]
    tags = {e: t for elements, p, _ in found for e, t in zip(elements, p.split("/"), strict=True)}
    above = {e: up for elements, _, _ in found for up, e in zip(elements, elements[1:], strict=False)}
    # The outermost article or main element around most of the content, else the deepest around all.
    marked = [e for e, n in held.items() if n >= 0.5 * whole and tags[e] in ("article", "main")]
    chosen = min(marked) if marked else max(e for e, n in held.items() if n >= whole)
    # Short paragraphs and headings beside the content's element belong to it.
    beside = {elements[-2] for elements, p, _ in found if re.search(r"/(p|h[1-6])$", p)}
    while not marked and above.get(chosen) in beside and tags[above[chosen]] not in ("", "html", "body"):
        chosen = above[chosen]
    single = [i for i, (elements, _, _) in enumerate(found) if elements[-1] == chosen]
    if len(single) == 1 and len([1 for e, _, _ in found if chosen in e]) == 1:
        # one long block holds it all: its parent is the article
        elements = found[single[0]][0]
        chosen = elements[-2] if len(elements) > 1 else elements[-1]
    whole_page = found[0][0][:1] == (chosen,) or any(
        p.rsplit("/", 1)[-1] in ("html", "body") and e[-1] == chosen for e, p, _ in found
    )
    kept = [
        t
        for (elements, p, t), k in zip(found, of, strict=True)
        if content[k] or chosen in elements and (not whole_page or re.search(r"/h[1-6]$", p))
    ]
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of `pages` (page_id, url, html).

    Row by row, without a shuffle.  NULL or empty html gives an empty text; equal rows give
    equal rows; page_id and url pass through, NULL too; other columns are ignored.
    """

    def run(batches):
        for part in slices(batches, 4 << 20, "html"):
            texts = [main_text(p) for p in part.column("html").to_pylist()]
            yield from part.drop_columns(["html"]).append_column("text", pa.array(texts, pa.string())).append_column(
                "n_chars", pa.array([len(t) for t in texts], pa.int64())
            ).to_batches()

    columns = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    types = dict(columns.dtypes)
    return short_batches(columns).mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
