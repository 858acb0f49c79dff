"""Main text of web pages: the maximum-scoring run of tokens, words for and tags against.

The weights of words and tags come from pages whose markup itself names the article: how much more
often a kind of token stands inside it than outside.  One linear scan then finds the best run on any page.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import textkit as tk

#: About this many labelled pages (with an article or main element) give the weights, drawn by a hash of the id.
LABELLED_PAGES = 2000

# Element names of the HTML standard by their role here.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FRAMES = frozenset(
    "html body article main section nav footer header aside form div ul ol dl table figure details dialog menu"
    " select button head template svg fieldset object video audio canvas".split()
)
_LEFT_OUT = frozenset(
    "head nav footer header aside form menu dialog select button template svg fieldset object video audio canvas"
    " script style textarea title noscript iframe xmp noembed noframes".split()
)
_ARTICLE = frozenset(("article", "main"))
_KNOWN = _INLINE | _RAW | _VOID | _FRAMES | frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th tr dt dd".split())
# Words in the class, id or role of an element that is not part of the article.
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side|nav\w*|menu|breadcrumbs?|footer|header|masthead"
    r"|cookies?|consent|notice|popup|modal|overlay|comment\w*|feedback|respond|responses?|discussion|replies|disqus|share|sharing|social|related"
    r"|recommend\w*|newsletter|subscribe|signup|login|search|widget|toolbar|contentinfo|complementary|navigation)(?:$|[\s_-])",
    re.I,
)
# Compounds that say whether a page has such a part, on its wrapper: has-sidebar, no-sidebar, with-ads.
_ABOUT = re.compile(r"(?<!\S)(?:\S*[_-])?(?:has|have|no|with|without)[_-]\S*", re.I)
# Inside an article these mark its own head.
_OWN_HEAD = re.compile(r"(?<![^\s_-])(?:header|masthead)(?![^\s_-])", re.I)
# Marks that a layout around the whole page may carry; comments, adverts, notices and the like never do.
_LAYOUT = re.compile(r"(?<![^\s_-])(?:sidebar|side|nav\w*|menu|header|masthead|footer|modal|overlay|popup|widget|toolbar|search|login|complementary)(?![^\s_-])", re.I)
#: Share of a page's words from which a frame with such a mark, or a form, is the page's wrapper.
WRAPPER = 0.8
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|</?[A-Za-z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S,
)
_ROLE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


class Token(NamedTuple):
    kind: str  # "tag:name" or "word:block", with "out:" before the block in parts left out
    text: str  # raw characters of a text run
    block: int  # text runs of one block share it, and the tag that opens it
    kept: bool  # in no part that is left out
    inside: bool  # of an article or main element
    link: bool  # of an anchor


def _count(text: str) -> int:
    return len(text.split())


class _Frame(NamedTuple):
    name: str
    out: bool  # left out here
    inside: bool  # of the article
    hard: bool  # left out by element or hidden, so never a wrapper
    marked: tuple[int, ...]  # numbers of the open frames that are marked as noise
    article: int  # number of an article or main element below a marked frame, or -1


class _Held:
    """Words of a page: in all, of articles outside marked frames, of each marked frame and each article below one."""

    def __init__(self) -> None:
        self.all, self.articles, self.marked, self.below, self.never = 0, 0, Counter(), Counter(), set()

    def add(self, frame: _Frame, n: int) -> None:
        if frame.hard:
            return
        self.all += n
        for k in frame.marked:
            self.marked[k] += n
        if frame.article >= 0:
            self.below[frame.article] += n
        elif frame.inside and not frame.marked:
            self.articles += n

    def lifted(self) -> set[int]:
        """Frames to keep: articles below marked frames if they hold more than those outside; without any article
        the frames around most of the page that are marked like a layout."""
        if sum(self.below.values()) > self.articles:
            return set(self.below)
        if self.articles:
            return set()
        return {k for k, n in self.marked.items() if n and n >= WRAPPER * self.all and k not in self.never}


def tokens(page: str) -> list[Token]:
    """Tags and text runs of a page in order; text of scripts and styles is left out."""
    held = _Held()
    found = list(_tokens(page, set(), held))
    lifted = held.lifted()
    return list(_tokens(page, lifted, _Held())) if lifted else found


def _marks(name: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether a frame is marked as no part of the article, and whether it may still be the page's wrapper."""
    if name == "form":
        return True, True
    roles = [_ABOUT.sub("", x.strip("\"'")) for x in _ROLE.findall(attributes)]
    if inside:
        roles = [_OWN_HEAD.sub("", x) for x in roles]
    marked = any(_NOISE.search(x) for x in roles)
    return marked, marked and not any(_NOISE.search(_LAYOUT.sub("", x)) for x in roles)


def _tokens(page: str, lifted: set[int], held: _Held) -> Iterator[Token]:
    open_frames = [_Frame("", False, False, False, (), -1)]
    at, block, own, number, link = 0, 0, "body", 0, False
    while at < len(page):
        m = _MARKUP.search(page, at)
        stop = m.start() if m else len(page)
        top = open_frames[-1]
        if stop > at:
            text = page[at:stop]
            held.add(top, _count(text))
            yield Token(f"word:out:{own}" if top.out else f"word:{own}", text, block, not top.out, top.inside, link)
        if not m:
            return
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        closing = m[1] == "/"
        if name not in _INLINE:
            block += 1
            own = ("body" if closing else name) if name in _KNOWN and name not in _VOID else own
        yield Token(f"tag:{name if name in _KNOWN else 'other'}", "", block, not top.out, top.inside, link)
        if name == "a":
            link = not closing
        if name in _FRAMES:
            if not closing:
                number += 1
                own_head = name == "header" and top.inside
                hard = top.hard or (name in _LEFT_OUT and name != "form" and not own_head) or bool(_HIDDEN.search(m[3]))
                marked, wraps = _marks(name, m[3], top.inside) if name not in ("html", "body") else (False, False)
                noise = marked and name not in _ARTICLE and number not in lifted
                below = name in _ARTICLE and bool(top.marked) and not marked and top.article < 0
                out = hard or noise or (top.out and number not in lifted)
                inside = (top.inside or name in _ARTICLE) and not hard and not noise
                frames, article = top.marked, number if below else top.article
                if marked and name not in _ARTICLE:
                    frames, article = (*top.marked, number), -1
                    if not wraps:
                        held.never.add(number)
                open_frames.append(_Frame(name, out, inside, hard, frames, article))
            elif any(x.name == name for x in open_frames):
                while open_frames.pop().name != name:
                    pass
        elif name in _RAW and not closing:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)


#: Weights of kinds not seen on a labelled page.  Words of parts that are left out cost no more than this,
#: so that an advert between two paragraphs does not cut an article.
WORD_IN, WORD_OUT, TAG = 1.0, -0.5, -0.5
_LEAST = 0.1
#: A tag among words that are kept costs less than the least of them, so that a table or list is no end of an article.
KEPT_TAG = -0.02
#: A block with more than this share of its words in links is no text.
LINKED = 0.5


def weights_from(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log ratio of a kind's share inside to its share outside; words of kept blocks stay above zero, the rest below."""
    total_in = sum(x for x, _ in counts.values()) + 1
    total_out = sum(x for _, x in counts.values()) + 1
    out = {}
    for kind, (n_in, n_out) in counts.items():
        ratio = math.log((n_in + 1) / total_in) - math.log((n_out + 1) / total_out)
        if kind.startswith("word:out:"):
            out[kind] = min(-_LEAST, max(WORD_OUT, ratio))
        elif kind.startswith("word:"):
            out[kind] = max(_LEAST, min(3.0, ratio))
        else:
            out[kind] = min(-_LEAST, max(-3.0, ratio))
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the maximum-scoring subsequence, the first of equals; (0, 0) without a positive score."""
    best, low, high, total, start = 0.0, 0, 0, 0.0, 0
    for k, x in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += x
        if total > best:
            best, low, high = total, start, k + 1
    return low, high


def scored(parts: list[Token], weights: dict[str, float]) -> list[float]:
    """The score of each token.

    Words outside the article of a page that has one score against, and so do blocks of links on other pages.  A tag
    is scored by what it opens: it costs hardly anything where words are kept.
    """
    counts = [_count(t.text) for t in parts]
    own = any(n and t.kept and t.inside for t, n in zip(parts, counts, strict=True))
    words, linked = Counter(), Counter()
    for t, n in zip(parts, counts, strict=True):
        words[t.block] += n
        linked[t.block] += n if t.link else 0

    def wanted(t: Token) -> bool:
        return t.kept and (t.inside if own else linked[t.block] <= LINKED * words[t.block])

    out = []
    for t, n in zip(parts, counts, strict=True):
        if t.text:
            out.append(n * (weights.get(t.kind, WORD_IN) if wanted(t) else WORD_OUT if t.kept else weights.get(t.kind, WORD_OUT)) if n else 0.0)
        else:
            out.append(KEPT_TAG if wanted(t) else weights.get(t.kind, TAG))
    return out


def main_text(page: str, weights: dict[str, float]) -> str:
    """Text of the best run: references decoded, white space in a block made one space, blocks joined by one."""
    parts = tokens(page)
    scores = scored(parts, weights)
    low, high = best_run(scores)
    blocks: dict[int, list[str]] = {}
    for t in parts[low:high]:
        if t.text and t.kept:
            blocks.setdefault(t.block, []).append(t.text)
    texts = (" ".join(entities.unescape("".join(x)).split()) for x in blocks.values())
    return " ".join(x for x in texts if x)


def page_weights(pages: DataFrame, sample: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights from about ``sample`` labelled pages.  One row for each kind of token comes back."""
    labelled = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]")).select("page_id", "html")
    share = max(1, -(-labelled.count() // sample))
    drawn = labelled.where(F.pmod(F.xxhash64("page_id", F.md5("html")), F.lit(share)) == 0)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: Counter = Counter()
        outside: Counter = Counter()
        for part in tk.slices(batches, "html"):
            for page in part.column("html").to_pylist():
                for t in tokens(page):
                    (inside if t.inside else outside)[t.kind] += _count(t.text) if t.text else 1
        kinds = sorted(inside.keys() | outside.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), *(pa.array([c[k] for k in kinds], pa.int64()) for c in (inside, outside))],
            names=["kind", "n_in", "n_out"],
        )

    rows = drawn.select("html").mapInArrow(counted, "kind string, n_in long, n_out long")
    table = rows.groupBy("kind").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out")).collect()
    return weights_from({r["kind"]: (r["n_in"], r["n_out"]) for r in table})


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """page_id, url, text and n_chars (code points), one row for each row of pages.

    A NULL or empty page has an empty text.
    """

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches, "html"):
            texts = [main_text(page or "", weights) for page in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
