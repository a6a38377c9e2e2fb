"""Main text of web pages by tag-path ratios.

A page is read once into blocks: runs of text between block tags, each with the path of tags from the
root to it. For every path the ratio of its text to its number of blocks, and the punctuation in them,
are aggregated over the page, smoothed over neighbouring blocks in page order and fused into one score.
Paths above a threshold that the page's own scores set hold content. Class and id words that name other
parts of a page are one more term of the score. The smallest element that holds all
content is the article, or the article, main or other element around it that directly holds headings or
paragraphs beside it; everything in it that is not marked up as something else is its text.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tariffscope.session import package_on_workers

# Element names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i kbd label mark q s samp small span strike strong sub sup time tt u var ins del wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math select option".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
_SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
_LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}

#: The term of the score for paths in elements whose class or id names another part of a page.
NAMED = 0.5

# Elements, roles and class or id words that mark what is not the article.
_NOT_TEXT = frozenset("nav footer aside form button dialog menu head".split())
_NOT_ROLE = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
_NOT_WORD = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar aside rail widget widgets ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments disqus respond reply replies pagination pager toc skip copyright legal".split()
)
# Words that say no more about what such a word marks, words of answers, words of an article's own header.
_NEUTRAL = frozenset("area bar block bottom box button buttons container content entry form group icon icons inner item items js left link links list main page post posts right section site text title top user wrap wrapper".split())
_ANSWERS = frozenset("comment comments disqus respond reply replies".split())
_OWN = frozenset("article content entry page post section story title".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ARTICLE = frozenset("article main".split())
_CONTAINER = frozenset("html body article main div section center td th form fieldset".split())
_PART = frozenset("h1 h2 h3 h4 h5 h6 hgroup p section article blockquote pre table dl figure details".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)|<([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I | re.S)
_WORD = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？¿¡]")


def _unwanted(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _NOT_TEXT or (tag == "header" and not in_article):
        return True
    if not attributes:
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value.strip() in _NOT_ROLE:
            return True
    return False


def _level(tag: str, attributes: str, in_article: bool) -> int:
    """What class and id words say: 1 a listed word among others, 2 a name of another part, 3 of answers, else 0."""
    level = 0
    if not attributes or tag in ("html", "body", "article", "main"):
        return level
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() not in ("class", "id"):
            continue
        for token in (a or b or c).lower().split():
            words = set(_WORD.findall(token))
            listed = words & _NOT_WORD
            if in_article or tag in _HEADINGS or words & _OWN:
                listed.discard("header")
            if not listed:
                continue
            if words <= listed | _NEUTRAL:
                level = max(level, 3 if listed & _ANSWERS and tag not in _HEADINGS and tag != "p" else 2)
            elif tag not in _INLINE:
                level = max(level, 1)
    return level


class _Open:
    __slots__ = ("article", "key", "marks", "path", "tag", "unwanted")

    def __init__(self, tag: str, path: tuple, key: tuple, unwanted: bool, article: bool, marks: tuple = ()):
        self.tag, self.path, self.key, self.unwanted, self.article, self.marks = tag, path, key, unwanted, article, marks


class Text:
    """A block: its text, tag path, the elements around it (numbered), whether markup excludes it and which
    of those elements have words of other parts (element, level, within an article)."""

    __slots__ = ("inside", "marks", "path", "text", "unwanted")

    def __init__(self, text: str, at: _Open):
        self.text, self.path, self.inside, self.unwanted, self.marks = text, at.path, at.key, at.unwanted, at.marks

    @property
    def kind(self) -> tuple:
        """The path, apart for text in elements named as other parts."""
        return (*self.path, "*") if any(level > 1 for _, level, _ in self.marks) else self.path


def text_blocks(page: str) -> list[Text]:
    """Blocks of a page in their order, from markup of any quality."""
    stack = [_Open("", (), (), False, False)]
    out: list[Text] = []
    parts: list[str] = []
    holder: list[_Open] = []
    around: list[tuple] = []
    count = 0

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Text(text, holder[0]))
            parts.clear()
            holder.clear()

    def say(text: str) -> None:
        if text:
            if not parts:
                top = len(stack) - 1
                while top and stack[top].tag in _INLINE and not stack[top].unwanted and not stack[top].marks:
                    top -= 1
                holder.append(stack[top])
            parts.append(text)

    def close_to(level: int) -> None:
        below = stack[level - 1]
        if any(e.tag not in _INLINE or e.unwanted != below.unwanted or e.marks != below.marks for e in stack[level:]):
            flush()
        del stack[level:]

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        closing, tag = found[1], found[2]
        if closing:
            closing = closing.lower()
            level = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == closing), 0)
            if level:
                if closing not in _INLINE or all(e.tag in _INLINE for e in stack[level:]):
                    close_to(level)
            elif closing not in _INLINE:
                flush()
            continue
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            say(" ")
            continue
        if tag in _VOID:
            if tag not in ("img", "wbr", "input"):
                flush()
            continue
        if tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at) if not found[3].rstrip().endswith("/") else None
            if tag not in ("select", "option", "svg", "math") or stop:
                at = stop.end() if stop else (at if found[3].rstrip().endswith("/") else end)
            continue
        if tag not in _INLINE:
            flush()
            if tag in _CLOSES_P:
                level = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
                if level and all(e.tag == "p" or e.tag in _INLINE for e in stack[level:]):
                    del stack[level:]
            if tag in _SELF_CLOSING:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in _SELF_CLOSING[tag]:
                        del stack[i:]
                        break
                    if stack[i].tag in _LIMITS.get(tag, ()):
                        break
        elif tag == "a":
            level = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "a"), 0)
            if level and all(e.tag in _INLINE for e in stack[level:]):
                del stack[level:]
        if found[3].rstrip().endswith("/") and tag in _INLINE:
            continue
        up = stack[-1]
        count += 1
        article = up.article or tag in _ARTICLE
        unwanted = up.unwanted or _unwanted(tag, found[3], up.article)
        level = 0 if unwanted else _level(tag, found[3], up.article)
        if unwanted != up.unwanted or level:
            flush()
        path, key = ((up.path, up.key) if tag in _INLINE and not unwanted and not level else ((*up.path, tag), (*up.key, count)))
        stack.append(_Open(tag, path, key, unwanted, article, (*up.marks, (count, level, up.article)) if level else up.marks))
        if tag in _ARTICLE and not unwanted:
            around.append(stack[-1].marks)
    flush()
    # words say nothing against the elements around the article
    few = min(map(len, around), default=0)
    freed = {m for marks in around if len(marks) == few for m in marks if m[1] < 3}
    if freed:
        for b in out:
            b.marks = tuple(m for m in b.marks if m not in freed)
    return out


def content_paths(blocks: list[Text], width: int = 1) -> set[tuple]:
    """Tag paths whose smoothed, fused ratio is above the page's threshold."""
    length: dict[tuple, int] = defaultdict(int)
    marks: dict[tuple, int] = defaultdict(int)
    count: dict[tuple, int] = defaultdict(int)
    for b in blocks:
        length[b.kind] += len(b.text)
        marks[b.kind] += len(_PUNCTUATION.findall(b.text))
        count[b.kind] += 1
    ratio = [length[b.kind] / count[b.kind] for b in blocks]
    dots = [marks[b.kind] / count[b.kind] for b in blocks]
    kernel = [0.25, 0.5, 0.25] if width else [1.0]
    reach = len(kernel) // 2

    def smooth(values: list[float]) -> list[float]:
        n = len(values)
        return [sum(w * values[min(n - 1, max(0, i + k - reach))] for k, w in enumerate(kernel)) for i in range(n)]

    # the score of a path named as another part counts for less
    term = [1.0 if b.kind is b.path else NAMED for b in blocks]
    fused = [r * (1 + d) for r, d in zip(smooth(ratio), smooth(dots), strict=True)]
    mean = sum(fused) / len(fused)
    spread = (sum((f - mean) ** 2 for f in fused) / len(fused)) ** 0.5
    best: dict[tuple, float] = defaultdict(float)
    for b, f, t in zip(blocks, fused, term, strict=True):
        best[b.kind] += t * f / count[b.kind]
    return {p for p, s in best.items() if s >= min(spread, mean)} or set(best)


def _article(content: list[Text], blocks: list[Text]) -> tuple:
    """The smallest element that holds all content, and what stands directly beside it as part of the same text."""
    key, path = content[0].inside, content[0].path
    for b in content:
        same = 0
        while same < len(key) and same < len(b.inside) and key[same] == b.inside[same]:
            same += 1
        key, path = key[:same], path[:same]
    # a paragraph, list or table is no article by itself: its neighbours belong to it
    size = len(key)
    while size and path[size - 1] not in _CONTAINER:
        size -= 1
    size = next((i + 1 for i in range(size - 1, -1, -1) if path[i] in _ARTICLE), size)
    beside = [len(b.inside) for b in blocks if len(b.inside) < size and b.inside == key[: len(b.inside)]]
    for b in blocks:
        same = 0
        while same < size and same < len(b.inside) and key[same] == b.inside[same]:
            same += 1
        if same < size and same < len(b.inside) and b.path[same] in _PART:
            beside.append(same)
    return key[: min([size, *beside])]


def _unmarked(blocks: list[Text]) -> list[Text]:
    """The blocks without those of other parts, as their words say and their paths do not deny.

    Elements that hold most of the content are no other part. What is named as another part outside the
    article is one; within it, and for a listed word among others, the path decides.
    """
    if not any(b.marks for b in blocks):
        return blocks
    paths = {p[:-1] if p and p[-1] == "*" else p for p in content_paths(blocks)}
    whole = sum(len(b.text) for b in blocks if b.path in paths)
    weight: dict[tuple, int] = defaultdict(int)
    for b in blocks:
        if b.path in paths:
            for m in b.marks:
                weight[m] += len(b.text)
    beside = any(tag in _ARTICLE for b in blocks for tag in b.path)
    for b in blocks:
        b.marks = tuple(m for m in b.marks if m[1] == 3 or 2 * weight[m] <= whole or (m[1] == 2 and beside and not m[2]))
    left = [b for b in blocks if not any(level == 3 or (level == 2 and not inner) for _, level, inner in b.marks)]
    if not left:
        return left
    paths = content_paths(left)
    return [b for b in left if not b.marks or b.kind in paths]


def main_text(page: str | None) -> str:
    """The article of a page: blocks in page order, one space between them; empty if there is none."""
    blocks = [b for b in text_blocks(page or "") if not b.unwanted]
    if not blocks:
        return ""
    blocks = _unmarked(blocks)
    if not blocks:
        return ""
    paths = content_paths(blocks)
    content = [b for b in blocks if b.kind in paths]
    article = _article(content, blocks)
    return " ".join(b.text for b in blocks if b.inside[: len(article)] == article)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null or empty page, and one without an article, has an empty text. Broken markup is read as far as
    it goes: open elements end with the page. Repeated rows give repeated results, ids and urls may be
    null, and other columns are ignored. A page is the unit of work, however long it is.
    """
    package_on_workers(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    chosen = pages.select(id_col, url_col, html_col)
    kinds = [f.dataType.simpleString() for f in chosen.schema.fields]
    return chosen.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
