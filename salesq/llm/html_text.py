"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags. A word scores +1; a tag scores minus its
weight, learned from labelled pages (those that mark their content with
``article`` or ``main``): the log-odds of the tag standing outside the content, at
least ``LEAST``, so that a one-word paragraph still pays for its own tags. One linear scan
finds the contiguous stretch of the largest sum; blocks that overlap it are the
text. Elements that never hold content (scripts, menus, adverts, reader comments
and so on, by element or by a word of their class, id or role) are cut out before:
they give no words, and cost no more than a plain tag, as content may go on after
them. An element that encloses the content is not cut, whatever its names, and a
header inside an article is left to the scan.

Comments and notices are also found without names: an article inside another that
is at most as long as what the outer one says itself is a comment (the standard's
meaning of nested articles), together with an element that holds mostly such
articles; a short element with a button or an input, but no heading, picture, table
or code, is a notice.

Tag counts over all labelled pages are one Spark aggregate of at most a row an
HTML element, so the weights sent to the tasks are bounded.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

LEAST, MOST, OTHER, CUT, CUT_INLINE = 0.05, 20.0, "#other", "#cut", "#cut inline"
# Element names of the HTML standard, by their part on a page.
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas select xmp noembed noframes".split())
ASIDE = frozenset("head nav footer aside form dialog menu button header".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                  "optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr br".split())
# Words of class, id or role that mark what is not content.
ASIDE_WORDS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                        "consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation "
                        "newsletter notice notices pagination pager popup promo promoted promotion recommended related "
                        "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
# Elements that are never wrappers of the content, and the share of the words of a page
# without article or main from which any other element counts as one.
# Elements round a group of comments; what a notice is made of and what it never holds.
GROUPS = frozenset("section div ul ol dl details".split())
ASKS, NOTICE_OF = frozenset("button input".split()), frozenset("div section p".split())
SHOWS, NOTICE = frozenset("article main h1 h2 h3 pre table figure img picture video ul ol".split()), 60
NO_WRAPPER, MOSTLY = frozenset("head nav footer aside menu dialog button".split()), 0.75
# a quoted value counts only right after its "="; nothing is tried twice
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


def _aside(name: str, attributes: str, inside: bool = False) -> bool:
    """True for an element that never holds content; ``inside`` an article or main,
    a header may hold its title."""
    if name in ASIDE and not (inside and name == "header"):
        return True
    if not attributes or name in ("article", "main", "body", "html"):
        return False
    return any(w in ASIDE_WORDS and not (inside and w == "header")
               for m in _NAMES.findall(attributes) for w in _SPLIT.split("".join(m).lower()))


def tokens(page: str) -> list[tuple[str, str, str]]:
    """The page as (kind, name or text, attributes): kinds ``text``, ``open``, ``close``."""
    out, at, n = [], 0, len(page)
    endless: set[str] = set()       # raw elements without an end tag from here on
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            out.append(("text", page[at:], ""))
            break
        if lt > at:
            out.append(("text", page[at:lt], ""))
        m = _TOKEN.match(page, lt) or _LOOSE.match(page, lt)
        if not m:  # a lone "<" is text
            out.append(("text", "<", ""))
            at = lt + 1
            continue
        at = m.end()
        if m.lastindex is None or m.group(2) is None:
            continue
        name = m.group(2).lower()
        out.append(("close" if m.group(1) else "open", name, m.group(3)))
        if name in RAW and name not in endless and not m.group(1) and not m.group(3).endswith("/"):
            end = re.compile(f"</{name}", re.I).search(page, at)
            if end:
                at = end.start()
            else:                   # without an end only the tag itself goes
                endless.add(name)
    return out


def _comments(seq: list, end_of: dict[int, int], articles: list[int], words: list[int]) -> set[int]:
    """Places where elements of reader comments open: nested articles at most as long
    as the outer one's own words, or the widest element round them that holds fewer
    words of its own than of theirs."""
    closed = [k for k in articles if k in end_of]
    found: set[int] = set()
    outer = -1
    for place, k in enumerate(closed):      # an outermost article with those right inside it
        if k < outer:
            continue
        outer = end_of[k]
        nested, last = [], k
        for at in range(place + 1, len(closed)):
            j = closed[at]
            if j > outer:
                break
            if j > last:
                nested.append(j)
                last = end_of[j]
        if not nested:
            continue
        size = {j: words[end_of[j]] - words[j] for j in nested}
        own = words[outer] - words[k] - sum(size.values())
        comments = [j for j in nested if size[j] <= own]
        found.update(comments)
        if not comments:
            continue
        before = list(accumulate((size[j] for j in comments), initial=0))
        for j in range(k + 1, outer):       # elements round the comments that hold little else
            if seq[j][0] == "open" and seq[j][1] in GROUPS and j in end_of and end_of[j] < outer:
                theirs = before[bisect(comments, end_of[j])] - before[bisect(comments, j)]
                if 0 < words[end_of[j]] - words[j] < 2 * theirs:
                    found.add(j)
    return found


def _notices(seq: list, end_of: dict[int, int], words: list[int]) -> set[int]:
    """Places where short elements open that ask for something and show nothing."""
    asking = [k for k, e in enumerate(seq) if e[0] == "open" and e[1] in ASKS]
    showing = [k for k, e in enumerate(seq) if e[0] == "open" and e[1] in SHOWS]

    def holds(places, k):
        return bisect(places, end_of[k]) > bisect(places, k)
    return {k for k, e in enumerate(seq) if e[0] == "open" and e[1] in NOTICE_OF and k in end_of and holds(asking, k)
            and words[end_of[k]] - words[k] <= NOTICE and not holds(showing, k)}


def events(page: str) -> list[tuple[str, str]]:
    """(``tag``, name) and (``text``, decoded text) outside asides. An aside ends at
    its own end tag; one that never ends cuts out nothing but its tags. Wrappers are
    not cut: what encloses ``main``, or an article and is in neither itself; on pages
    without both, what holds ``MOSTLY`` all words."""
    seq = tokens(page)
    opens: dict[str, list[int]] = {}
    end_of: dict[int, int] = {}
    for k, (kind, name, _) in enumerate(seq):
        if kind == "open" and name not in VOID:
            opens.setdefault(name, []).append(k)
        elif kind == "close" and opens.get(name):
            end_of[opens[name].pop()] = k
    marks = {n: [k for k, e in enumerate(seq) if e[:2] == ("open", n)] for n in ("main", "article")}
    marked = bool(marks["main"] or marks["article"])
    asks = any(e[0] == "open" and e[1] in ASKS for e in seq)
    words = list(accumulate((len(html.unescape(e[1]).split()) if e[0] == "text" else 0 for e in seq), initial=0)) \
        if asks or not marked or len(marks["article"]) > 1 else []
    unnamed = _comments(seq, end_of, marks["article"], words) | (_notices(seq, end_of, words) if asks else set())

    def wraps(k: int, name: str, inside: bool) -> bool:
        def has(n):
            return bisect(marks[n], end_of[k]) > bisect(marks[n], k)
        if name in NO_WRAPPER:
            return False
        return has("main") or (not inside and has("article")) if marked else words[end_of[k]] - words[k] >= MOSTLY * words[-1] > 0

    out, k, content_end = [], 0, -1
    while k < len(seq):
        kind, name, attributes = seq[k]
        if kind == "open" and name in ("article", "main"):
            content_end = max(content_end, end_of.get(k, -1))
        if kind == "text":
            out.append(("text", html.unescape(name)))
        else:
            inside = k < content_end
            if k in unnamed or (kind == "open" and k in end_of and _aside(name, attributes, inside) and not wraps(k, name, inside)):
                k, name = end_of[k], CUT if name in BLOCK else CUT_INLINE
            out.append(("tag", name))
        k += 1
    return out


def content_counts(page: str | None) -> list[tuple[str, int, int]]:
    """Of a labelled page: (tag, times inside, times outside the content); nothing
    for a page without ``article`` or ``main``."""
    seq = events(page or "")
    marks = [k for k, e in enumerate(seq) if e[0] == "tag" and e[1] in ("article", "main")]
    if len(marks) < 2:
        return []
    counts: dict[str, list[int]] = {}
    for k, (kind, name) in enumerate(seq):
        if kind == "tag" and name not in ("article", "main", CUT, CUT_INLINE):
            known = name in BLOCK or name in INLINE or name in VOID or name in RAW or name in ASIDE
            inside = marks[0] < k < marks[-1]
            counts.setdefault(name if known else OTHER, [0, 0])[not inside] += 1
    return [(n, a, b) for n, (a, b) in counts.items()]


def tag_weights(pages: DataFrame, column: str = "html") -> dict[str, float]:
    """Learned penalties of tags; without a labelled page all are ``LEAST``."""
    @pandas_udf("array<struct<tag:string,inside:long,outside:long>>")
    def count(rows: pd.Series) -> pd.Series:
        return pd.Series([content_counts(r) for r in rows], dtype=object)

    seen = {r.tag: (r.inside, r.outside) for r in pages.select(F.explode(count(F.col(column))).alias("c"))
            .groupBy("c.tag").agg(F.sum("c.inside").alias("inside"), F.sum("c.outside").alias("outside")).collect()}
    return {t: min(MOST, max(LEAST, math.log((b + 1) / (a + 1)))) for t, (a, b) in seen.items()}


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """Blocks of the best stretch, joined by one newline."""
    blocks: list[list] = [[0.0, []]]  # penalty of its tags, pieces of text
    for kind, value in events(page or ""):
        if kind == "text":
            blocks[-1][1].append(value)
        elif value in BLOCK or value == CUT:
            blocks.append([0.0 if value in ("article", "main") else LEAST if value == CUT else weights.get(value, LEAST), []])
        else:
            blocks[-1][0] += LEAST if value == CUT_INLINE else weights.get(value, LEAST)
            if value == "br":
                blocks[-1][1].append(" ")
    # Kadane's scan over blocks: a block adds its words, entering it costs its tags
    best, best_span, run, start = 0.0, None, 0.0, 0
    texts = []
    for k, (cost, parts) in enumerate(blocks):
        words = "".join(parts).split()
        texts.append(" ".join(words))
        if run - cost <= 0:
            run, start = 0.0, k
        else:
            run -= cost
        run += len(words)
        if run > best:
            best, best_span = run, (start, k)
    if best_span is None:
        return ""
    return "\n".join(t for t in texts[best_span[0]:best_span[1] + 1] if t)


def extract(pages: DataFrame, weights: dict[str, float] | None = None, page_id: str = "page_id", url: str = "url",
            column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row. ``weights`` are learned from
    ``pages`` if none are given. NULL or empty pages have empty texts; repeated rows
    and NULL ids keep their rows; an empty table gives an empty result; other
    columns are not read. Whole pages of any length."""
    weights = tag_weights(pages, column) if weights is None else weights

    @pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        return pd.Series([main_text(r, weights) for r in rows], dtype=object)

    out = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), text(F.col(column)).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
