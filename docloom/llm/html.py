"""HTML extraction: the maximum-scoring contiguous run of a page's words and tags.

A page becomes a sequence of events: runs of words, each with the kind of element that holds it, and start and end tags.
Words in content count for, tags count against, words of menus, footers and the like count against too.  The weights are
log odds of each kind of event inside and outside the article, counted over the labelled pages of the table: those that
mark their content with exactly one ``article`` or ``main`` element.  One linear scan finds the best region; inside it,
elements that are never article text (scripts, forms, adverts, reader comments, ...) are left out.

Words in class, id or role hint at such elements, but also stand on wrappers of the whole article.  A hint is passed over on
an element that holds an article or main, unless others stand elsewhere and it is small; without any it only lowers the
score of its words if they are more than ``SMALL`` of the page's, or of the article's that holds it.  On text elements
(headings, paragraphs, ...) all words of a class, id or role must be hints.

Blocks are the stretches between block-level tags and line breaks.  Character references are decoded, white space inside a
block becomes one space, empty blocks are dropped, blocks are joined by a line feed.

Defined cases: a null or empty page, or one without a word that scores, has the empty text; without labelled pages the
built-in odds hold; broken markup is read as browsers do: a comment or script without end takes the rest of the page, an
unfinished tag is text.  Repeated rows each give a row.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: element kinds of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
SKIPPED = frozenset("script style title textarea iframe noembed noframes xmp head noscript template svg math object canvas audio video select button input".split())
BOILERPLATE = frozenset("nav aside footer form dialog menu fieldset".split())
CLOSES = {"li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
#: Words in class, id or role that name something other than the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar widget related recommended "
    "share sharing social comment comments commentlist respond replies disqus cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login "
    "form search footer toolbar pagination pager copyright legal complementary contentinfo".split()
)
#: Largest share of the words around it that a hint alone takes out, and what it takes off each word's score otherwise.
SMALL, LOWER = 0.3, 0.3
#: Elements whose ids and classes often name what the text is about.
_TEXTUAL = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption caption".split())
_HEADER = frozenset(("header", "masthead"))
_token = re.compile(r"<!--|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
#: The same without regard to quotes: a tag ends at the first >.
_loose = re.compile(r"<!--|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
#: Tags of a page whose quotes never close; behind them quotes count for nothing, or every tag would be read to the end of the page.
UNCLOSED = 100
_named = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_piece = re.compile("[a-z]+")

#: Odds a kind has before any page is counted, as many words or tags in and out.
_PRIOR = {True: (2.0, 20.0), False: (15.0, 5.0)}


def _hint(name: str, attributes: str) -> str | None:
    if not attributes or name in ("html", "body", "article", "main"):
        return None
    for found in _named.findall(attributes):
        pieces = _piece.findall("".join(found).lower())
        if name in _TEXTUAL and not any(t and set(_piece.findall(t)) <= HINTS | _HEADER for t in "".join(found).lower().split()):
            continue
        for p in pieces:
            if p in HINTS or p in _HEADER:
                return p
    return None


def events(html: str) -> list[tuple[str, int, str | None, bool, bool, bool]]:
    """Kind, words, text (None for tags), block break, left out, inside a labelled article; in page order."""
    hints: list[list[int]] = []
    out = _read(html, {}, hints)
    *_, total, marks = hints.pop()
    passed = {}
    for at, words, held, around, above in hints:
        outside = marks - held - above
        large = words > SMALL * max(1, around if above else total)
        if held and (not outside or large):
            passed[at] = False
        elif large and (above or not marks):
            passed[at] = True
    return _read(html, passed, []) if passed else out


def _read(html: str, passed: dict[int, bool], hints: list[list[int]]) -> list[tuple]:
    """The events; hints at the places ``passed`` only lower the score, or not even that.

    ``hints`` gets place, words, articles inside, words of the innermost article around and articles around of every hinted
    element, and at last the words and articles of the page.
    """
    out: list = []
    said, marks = 0, 0
    # open articles: words in front and, once closed, inside
    articles: list[list[int]] = []
    owners: list[tuple[list[int], list[int]]] = []
    # open elements: name, kind of the nearest element that is not content, block, link, skipped, labelled
    stack: list[tuple] = [("#root", None, "body", False, False, False, None, False)]
    open_names: Counter = Counter()
    at, size = 0, len(html)

    def say(text: str) -> None:
        nonlocal said
        words = len(text.split())
        _, other, block, link, skipped, labelled, _, low = stack[-1]
        if skipped:
            return
        said += words
        kind = "w:" + (other or ("low." if low else "") + ("a:" + block if link else block))
        if words or text:
            out.append((kind, words, text, False, other is not None, labelled))

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            name, other, _, _, skipped, labelled, hinted, _ = stack.pop()
            open_names[name] -= 1
            if hinted is not None:
                hinted[1], hinted[2] = said - hinted[1], marks - hinted[2]
            if name in ("article", "main") and articles:
                articles[-1][0] = said - articles[-1][0]
                articles.pop()
            if not stack[-1][4]:
                out.append(("/" + (other or name), 0, None, name not in INLINE, other is not None or skipped, stack[-1][5]))

    # behind the last > only a comment can begin
    last, unclosed = html.rfind(">"), 0
    while at < size:
        start, found = html.find("<", at), None
        while start >= 0:
            if start < last:
                found = (_token if unclosed < UNCLOSED else _loose).match(html, start)
            elif html.startswith("<!--", start):
                found = _loose.match(html, start)
            else:
                start = html.find("<!--", start)
                continue
            if found is not None:
                break
            start = html.find("<", start + 1)
        if start < 0:
            say(html[at:])
            break
        if start > at:
            say(html[at:start])
        at = found.end()
        slash, name, attributes = found.groups()[-3:] if found[2] is None else found.groups()[:3]
        unclosed += found[2] is None and name is not None
        name = (name or "").lower()
        if not name:
            if found[0] == "<!--":
                end = html.find("-->", at)
                at = size if end < 0 else end + 3
            continue
        if slash:
            if open_names[name] > 0:
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    depth -= 1
                close_to(depth)
            elif name not in INLINE and not stack[-1][4]:
                out.append(("/" + name, 0, None, True, stack[-1][1] is not None, stack[-1][5]))
            continue
        if name not in INLINE and open_names["p"] > 0 and name != "br":
            depth = len(stack) - 1
            while stack[depth][0] in INLINE:
                depth -= 1
            if stack[depth][0] == "p":
                close_to(depth)
        if (ends := CLOSES.get(name)) is not None:
            depth = len(stack) - 1
            while stack[depth][0] in INLINE or stack[depth][0] == "p":
                depth -= 1
            if stack[depth][0] in ends:
                close_to(depth)
        _, other, block, link, skipped, labelled, _, low = stack[-1]
        hint, hinted = _hint(name, attributes), None
        if name in ("article", "main"):
            marks += 1
            # a form around the page is no form of the article
            other = None if other == "form" else other
        if hint is not None and hint not in _HEADER and name not in BOILERPLATE:
            hinted = [found.start(), said, marks, 0, len(articles)]
        if other is None:
            if name in BOILERPLATE:
                other = name
            elif name == "header" or hint in _HEADER:
                other = None if open_names["article"] + open_names["main"] > 0 else "header"
            elif hinted is not None and hinted[0] in passed:
                low = low or passed[hinted[0]]
            elif hint is not None:
                other = "hint." + hint
        inside = labelled or name in ("article", "main")
        skipped = skipped or name in SKIPPED
        if not skipped or name not in RAW:
            if not stack[-1][4]:
                out.append((other or name, 0, None, name not in INLINE or name == "br", other is not None or skipped, labelled and inside))
        if name in VOID or attributes.endswith("/") and name not in RAW:
            continue
        if name in RAW:
            end = re.compile(f"</{name}(?![a-zA-Z0-9])[^>]*>?", re.I).search(html, at)
            at = size if end is None else end.end()
            continue
        if hinted is not None:
            hints.append(hinted)
            if articles:
                owners.append((hinted, articles[-1]))
        if name in ("article", "main"):
            articles.append([said])
        stack.append((name, other, block if name in INLINE else name, link or name == "a", skipped, inside, hinted, low))
        open_names[name] += 1
    close_to(1)
    for hinted, article in owners:
        hinted[3] = article[0]
    hints.append([said, marks])
    return out


def is_labelled(html: str, found: list) -> bool:
    """Whether exactly one element marks the content."""
    marks = [e for e in found if e[2] is None and e[0] in ("article", "main")]
    return len(marks) == 1 or (len(marks) == 2 and {m[0] for m in marks} == {"article", "main"})


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Score of each kind of event from how often it was inside and outside: at most 1 for a word, negative for a tag."""
    total_in = sum(v[0] for k, v in counts.items() if k.startswith("w:")) or 1
    total_out = sum(v[1] for k, v in counts.items() if k.startswith("w:")) or 1
    tags_in = sum(v[0] for k, v in counts.items() if not k.startswith("w:")) or 1
    tags_out = sum(v[1] for k, v in counts.items() if not k.startswith("w:")) or 1
    out = {}
    for kind, (inside, outside) in counts.items():
        word = kind.startswith("w:")
        base_in, base_out = (total_in, total_out) if word else (tags_in, tags_out)
        plain = (20.0, 20.0) if not word else _PRIOR[_boilerplate(kind)]
        odds = log((inside / base_in * 1000 + plain[0]) / (outside / base_out * 1000 + plain[1]))
        out[kind] = max(-2.0, min(1.0, 0.4 + odds)) if word else -0.08 - max(0.0, min(5.0, -odds))
    return out


def _boilerplate(kind: str) -> bool:
    name = kind[2:]
    return name in BOILERPLATE or name == "header" or name.startswith(("hint.", "a:li", "a:nav", "a:body", "a:div"))


def _default(kind: str) -> float:
    if not kind.startswith("w:"):
        return -0.08
    return -0.5 if _boilerplate(kind) else 1.0


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest positive sum, the first of equals; empty if there is none."""
    best, region, running, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if running <= 0:
            running, start = 0.0, i
        running += s
        if running > best:
            best, region = running, (start, i + 1)
    return region


def extract(html: str | None, weight: dict[str, float]) -> str:
    """The article's text."""
    if not html:
        return ""
    found = events(html)
    scores = []
    for kind, words, text, _, left_out, _ in found:
        low = kind.startswith("w:low.")
        kind = kind.replace("low.", "", 1) if low else kind
        value = weight.get(kind)
        if value is None:
            value = _default(kind)
        value -= LOWER * low
        if text is None:
            scores.append(value)
        else:
            # what is left out anyway must not cut an article in two
            scores.append(words * max(value, -0.1) if left_out else words * value)
            if left_out:
                scores[-1] = min(scores[-1], 0.0)
    start, end = best_region(scores)
    blocks, parts = [], []

    def flush() -> None:
        block = " ".join("".join(parts).split())
        if block:
            blocks.append(block)
        parts.clear()

    for _, _, text, breaks, left_out, _ in found[start:end]:
        if breaks:
            flush()
        if text is not None and not left_out:
            parts.append(unescape(text))
    flush()
    return "\n".join(blocks)


def learn(pages: DataFrame, html: str = "html") -> dict[str, float]:
    """Weights from all labelled pages.  Kinds are element names and hint words, so their number is bounded."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for page in batch["html"]:
                found = events(page or "")
                if not is_labelled(page or "", found):
                    continue
                for kind, words, text, _, _, labelled in found:
                    known = kind.removeprefix("w:").removeprefix("/").removeprefix("a:")
                    if known.startswith("hint.") or known in _KNOWN:
                        held[kind][0 if labelled else 1] += 1 if text is None else words
        yield pd.DataFrame([(k, a, b) for k, (a, b) in held.items()], columns=["kind", "inside", "outside"]).astype({"kind": object, "inside": "int64", "outside": "int64"})

    rows = pages.select(F.col(html).alias("html")).mapInPandas(count, "kind string, inside bigint, outside bigint")
    sums = rows.groupBy("kind").agg(F.sum("inside").alias("a"), F.sum("outside").alias("b")).collect()
    return weights({r["kind"]: (r["a"], r["b"]) for r in sums})


#: Element names that get weights of their own.
_KNOWN = (
    VOID | INLINE | SKIPPED | BOILERPLATE
    | frozenset("html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption pre blockquote article main section header figure figcaption details summary address hgroup center".split())
)


def add_text(pages: DataFrame, weight: dict[str, float], html: str = "html", name: str = "text") -> DataFrame:
    """Append the extracted text as column ``name``, in place of one of that name; all other columns are kept."""

    @F.pandas_udf("string")
    def work(column: pd.Series) -> pd.Series:
        return pd.Series([extract(h, weight) for h in column.fillna("")], dtype=object)

    return pages.withColumn(name, work(F.col(html)))
