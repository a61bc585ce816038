"""Main text of web pages by the maximum-scoring run of tokens.

A page is read once into tokens. Words score positive and tags negative; the
weights come from labelled pages: those of a bounded sample that mark their
article (``article`` or ``main``). A word's weight is one; a tag's weight grows
with the share of its occurrences that lie outside the marked articles. One
linear scan then finds the run of tokens with the highest sum. Elements that
never hold article text (scripts, menus, forms, ...) are left out before. So
are elements with a class or id made of noise names alone (``ad``,
``cookie-notice``), or of noise names and names of mere boxes (``ad-slot``,
``comments-area``), inside articles too; where a noise name is only a part of another name (``has-sidebar``,
``entry-header``) or a general one (``widget``), the words inside stay but score
less. An element that holds most words of the page, or of the article it
lies in, is never held against them.

Defined results: a null page counts as an empty one; a page without words
gives an empty text; a marked article bounds the run if it holds any words;
unclosed tags end at the page's end or at the next article; repeated rows are
read each for itself; null ids and urls are carried along; an empty table
gives an empty result; columns other than id, url and html are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import map_rows

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style noscript template textarea iframe noframes noembed xmp title svg math object canvas".split())
NOISE = frozenset(
    "nav aside footer form button select option label input menu dialog head fieldset legend audio video map".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset("article main".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
# Words in class names and ids that mark what is not the article.
NOISE_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie "
    "cookies consent copyright disclaimer disqus footer gdpr header masthead menu modal nav navbar navigation newsletter "
    "notice notices notification alert pagination pager popup promo promoted promotion related replies reply respond "
    "share sharing sidebar sidebars signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets "
    "adsbygoogle adslot adunit adcontainer adwrapper".split()
)
# Names of boxes, which say nothing about what they hold.
BOX_NAMES = frozenset(
    "area bar block body bottom box button buttons card container content group holder inline inner item items link links list "
    "panel placeholder post posts row section slot strip thread top unit wrap wrapper zone".split()
)
# Of these, names that articles use for their own parts as well.
WEAK_NAMES = frozenset("alert header masthead notice notices widget widgets".split())

#: A quote opens a value only after an equals sign; anywhere else it is a character like others.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=(?!\s*[\"']))*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>][^\s>]*)))?")
NAME_PARTS = re.compile(r"[a-z]+|[0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
BLANK = re.compile(r"\s+")


def attributes_of(text: str) -> list[tuple[str, str]]:
    """Names, in small letters, and values of a tag's attributes; one without a value has an empty one."""
    return [(match[1].lower(), match[2] or match[3] or match[4] or "") for match in ATTRIBUTE.finditer(text)]


def called(name: str, attributes: list[tuple[str, str]]) -> str:
    """``noise`` for an element with a class or id of noise and box names, ``light`` for one with a part of it, else nothing."""
    found = ""
    if name in ("html", "body", "article", "main"):
        return found
    for key, values in attributes:
        if key in ("class", "id"):
            for value in values.split():
                parts = NAME_PARTS.findall(CAMEL.sub("-", value).lower())
                known = [part for part in parts if part in NOISE_NAMES]
                if known and not WEAK_NAMES.issuperset(known) and BOX_NAMES.issuperset(
                    part for part in parts if part not in NOISE_NAMES and not part.isdigit()
                ):
                    return "noise"
                if known:
                    found = "light"
    return found


class Called:
    """The open elements that ``called`` names, the words in each of them, and which of them count."""

    def __init__(self):
        self.kinds, self.above, self.inside, self.words = [""], [0], [False], [0]
        self.stack: list[tuple[int, str, Counter]] = []
        self.opened: Counter = Counter()

    @property
    def now(self) -> int:
        return self.stack[-1][0] if self.stack else 0

    def begin(self, name: str, kind: str, inside: bool) -> None:
        self.kinds.append(kind)
        self.above.append(self.now)
        self.inside.append(inside)
        self.words.append(0)
        self.stack.append((len(self.kinds) - 1, name, Counter()))

    def open(self, name: str) -> None:
        if self.stack:
            self.stack[-1][2][name] += 1
            self.opened[name] += 1

    def close(self, name: str) -> None:
        while self.stack and self.opened[name]:
            _, own, opened = self.stack[-1]
            if opened[name]:
                opened[name] -= 1
                self.opened[name] -= 1
                if name == own and not opened[name]:
                    self.end()
                return
            self.end()

    def end(self) -> None:
        self.opened.subtract(self.stack.pop()[2])

    def clear(self) -> None:
        self.stack.clear()
        self.opened.clear()

    def settle(self, total: int, in_articles: int) -> list[str]:
        """By element: ``noise`` or ``light`` if it or one around it is so and doesn't hold most of the words."""
        for number in range(len(self.kinds) - 1, 0, -1):
            self.words[self.above[number]] += self.words[number]
        found = [""]
        for number in range(1, len(self.kinds)):
            most = self.words[number] * 2 > (in_articles if self.inside[number] else total)
            around, own = found[self.above[number]], "" if most else self.kinds[number]
            found.append("noise" if "noise" in (around, own) else around or own)
        return found


def noisy(name: str, attributes: list[tuple[str, str]], inside: bool) -> bool:
    """Whether an element, by its name, role or state, holds no article text."""
    if name in NOISE or name == "header" and not inside:
        return True
    for key, value in attributes:
        if key == "role" and value.lower() in NOISE_ROLES or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "hidden" and name not in ("html", "body"):
            return True
    return False


def tokens(page: str | None) -> list[tuple[str, str, bool, bool, bool]]:
    """Tags and texts in page order: (tag name or "", text, in an article, in noise, light).

    Closing tags start with ``/``. Raw elements, comments and declarations are dropped.
    """
    page = page or ""
    found: list[tuple[str, str, bool, bool, int]] = []
    names, total, in_articles = Called(), 0, 0
    articles: list[str] = []
    noise, depth, place, end = "", 0, 0, len(page)

    def words(piece: str) -> None:
        nonlocal total, in_articles
        if piece:
            if not noise and (n := count_words(piece)):
                names.words[names.now] += n
                total += n
                in_articles += n if articles else 0
            found.append(("", piece, bool(articles), bool(noise), names.now))

    while place < end:
        match = TOKEN.search(page, place)
        if match is None:
            words(page[place:])
            break
        words(page[place : match.start()])
        place = match.end()
        if match[2] is None:
            if match[0].startswith("<![CDATA["):
                words(match[0][9:].removesuffix("]]>"))
            continue
        name, closing, attributes = match[2].lower(), bool(match[1]), match[3]
        if not closing and name in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, place)
            if name in ("script", "style", "textarea", "title", "xmp", "iframe") or close:
                place = close.end() if close else end if name in ("script", "style") else place
            continue
        if names.stack and (
            not closing and name in ARTICLE and not articles or closing and articles and name == articles[-1]
        ):
            names.clear()
        if names.stack and names.stack[-1][1] == "p" and not closing and name in BLOCKS:
            names.end()
        if noise:
            if not closing and name in ARTICLE and not articles:
                noise, depth = "", 0
            elif name == noise:
                depth += -1 if closing else 1
                if depth == 0:
                    noise = ""
                    found.append((("/" if closing else "") + name, "", bool(articles), True, names.now))
                    if closing:
                        names.close(name)
                    continue
            elif closing and articles and name == articles[-1]:
                noise, depth = "", 0
            elif noise == "p" and name in BLOCKS:
                noise, depth = "", 0
        named = attributes_of(attributes) if attributes and not closing else []
        if not noise and not closing and name not in VOID and not attributes.endswith("/") and noisy(name, named, bool(articles)):
            noise, depth = name, 1
        elif not noise and name in ARTICLE:
            if closing:
                if name in articles:
                    del articles[len(articles) - 1 - articles[::-1].index(name) :]
            else:
                articles.append(name)
        opens = not closing and name not in VOID and not attributes.endswith("/")
        if opens and named and not noise and (kind := called(name, named)):
            names.begin(name, kind, bool(articles))
        if opens:
            names.open(name)
        found.append((("/" if closing else "") + name, "", bool(articles), bool(noise), names.now))
        if closing:
            names.close(name)
    kinds = names.settle(total, in_articles)
    return [(name, text, inside, noise or kinds[n] == "noise", kinds[n] == "light") for name, text, inside, noise, n in found]


def count_words(piece: str) -> int:
    return len(piece.split())


def tag_counts(page: str | None) -> dict[str, tuple[int, int]]:
    """Per tag name of a labelled page: occurrences inside and outside its article; a page without one gives none."""
    rows = tokens(page)
    if not any(inside and not noise and piece.strip() for _, piece, inside, noise, _ in rows):
        return {}
    inner, outer = Counter(), Counter()
    for name, _, inside, noise, _ in rows:
        if name:
            (inner if inside and not noise else outer)[name.lstrip("/")] += 1
    return {name: (inner[name], outer[name]) for name in inner.keys() | outer.keys()}


#: Weight of a tag that is never, and of one that is only, found outside the articles; tags never seen lie between.
TAG_LEAST, TAG_MOST, TAG_UNSEEN = -0.02, -3.0, -0.5
#: Weight of a word in an element that a part of its class or id speaks against.
LIGHT = 0.3


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Negative weights by tag name from its counts inside and outside labelled articles."""
    return {name: TAG_LEAST + (TAG_MOST - TAG_LEAST) * (out + 0.01) / (into + out + 0.02) for name, (into, out) in counts.items()}


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the first run with the highest positive sum; (0, 0) if there is none."""
    best, best_run_at = 0.0, (0, 0)
    total, start = 0.0, 0
    for place, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, place
        total += score
        if total > best:
            best, best_run_at = total, (start, place + 1)
    return best_run_at


def main_text(page: str | None, tag_weights: dict[str, float]) -> str:
    """Blocks of the best run, without noise, joined by line breaks."""
    rows = tokens(page)
    marked = any(inside and not noise and piece.strip() for _, piece, inside, noise, _ in rows)
    scores = []
    for name, piece, inside, noise, light in rows:
        if name:
            scores.append(tag_weights.get(name.lstrip("/"), TAG_UNSEEN) if not (marked and inside) else TAG_LEAST)
        else:
            n = count_words(piece)
            scores.append(-1.0 * n if noise else -2.0 * n if marked and not inside else n * LIGHT if light and not marked else float(n))
    if marked:  # tags of an article must not cut it
        low = min(i for i, row in enumerate(rows) if row[2] and not row[3] and row[1].strip())
        high = max(i for i, row in enumerate(rows) if row[2] and not row[3] and row[1].strip())
        scores = [s if low <= i <= high else min(s, -1.0) for i, s in enumerate(scores)]
        scores = [max(s, TAG_LEAST / 10) if low <= i <= high else s for i, s in enumerate(scores)]
    start, stop = best_run(scores)
    if stop:  # a block belongs to the article as a whole
        while start and not (rows[start - 1][0].lstrip("/") in BLOCKS or rows[start - 1][3]):
            start -= 1
        while stop < len(rows) and not (rows[stop][0].lstrip("/") in BLOCKS or rows[stop][3]):
            stop += 1
    blocks, line = [], []
    for name, piece, inside, noise, _ in rows[start:stop]:
        bare = name.lstrip("/")
        if name and bare in BLOCKS:
            blocks.append("".join(line))
            line = []
        elif name == "br":
            line.append(" ")
        elif not name and not noise and (inside or not marked):
            line.append(piece)
    blocks.append("".join(line))
    lines = (BLANK.sub(" ", entities.unescape(block)).strip() for block in blocks)
    return "\n".join(line for line in lines if line)


def learn(
    pages: DataFrame, *, key: str = "page_id", html: str = "html", max_pages: int = 400, max_names: int = 500
) -> dict[str, float]:
    """Tag weights from the ``max_pages`` pages whose ids have the smallest hashes.

    Only the ``max_names`` most frequent tag names of them get a weight of their own; all others have `TAG_UNSEEN`.
    """
    sample = (
        pages.select(F.xxhash64(F.col(key)).alias("_order"), F.col(key).alias("_key"), F.col(html).alias("_html"))
        .where(F.lower("_html").rlike("<(article|main)[\\s>]"))
    )
    ids = sample.select("_order", "_key").orderBy("_order", "_key").limit(max_pages)
    chosen = sample.join(F.broadcast(ids.distinct()), ["_order", "_key"])  # at most max_pages rows

    def row(page):
        return ([{"name": n, "inner": a, "outer": b} for n, (a, b) in sorted(tag_counts(page).items())],)

    counted = map_rows(chosen, ["_html"], row, "tags array<struct<name:string,inner:long,outer:long>>")
    sums = counted.select(F.inline("tags")).groupBy("name").agg(F.sum("inner").alias("inner"), F.sum("outer").alias("outer"))
    rows = sums.orderBy(F.desc(F.col("inner") + F.col("outer")), "name").limit(max_names).collect()
    return weights({r["name"]: (r["inner"], r["outer"]) for r in rows})


def extract(
    pages: DataFrame, tag_weights: dict[str, float], *, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Per page: key, url, ``text``, ``n_chars``."""
    kind = pages.schema[key].dataType.simpleString()

    def row(k, u, page):
        text = main_text(page, tag_weights)
        return k, u, text, len(text)

    return map_rows(pages, [key, url, html], row, f"`{key}` {kind}, `{url}` string, text string, n_chars long")
