"""Main text of web pages by composite text density (Sun, Song, Liao 2011).

Every node of the page's tree gets its characters per tag, weighted down by the share of link text;
the node whose children's densities sum highest is the content's core. The smallest density on its
path to the body is the threshold: the core grows to an enclosing ancestor as long as the
ancestor's other text also reaches it, and always to the article element around it. Menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are cut out first,
by element, role and class name. A name or a form is no proof: what holds the page's main or only
article element stays, and so does a form, or an element whose name only contains a marked word, with
more than half of the page's text. All text of the chosen subtree is returned.

Defined cases: a null or empty page, or one without text, gives an empty text and 0; markup that never
ends is text up to where it breaks; repeated rows are extracted each; null keys are carried; other
columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import slices, table

# Names of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td"
    " tfoot th thead tr ul".split()
)
BOILERPLATE = frozenset(
    "aside button canvas dialog footer form head header iframe input menu nav noscript object script select style"
    " svg template textarea title".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words of a class name or id that mark what isn't the article.
MARKED = re.compile(
    r"(?<![a-z])(ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disclaimer|disqus|footer|header|masthead"
    r"|menu|modal|nav|navbar|navigation|newsletter|notice|notification|pagination|popup|promo\w*|related|replies|reply"
    r"|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?![a-z])"
)
#: Of these, what readers wrote: never kept for its length.
READERS = re.compile(r"(?<![a-z])(comments?|disqus|replies|reply|respond)(?![a-z])")
#: A first part that turns a name into a remark on the layout, as in "has-sidebar".
REMARKS = frozenset("has hide no not show with without".split())
#: A start tag of the key ends an open element of these names.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
_CLOSING_SCOPE = frozenset("ul ol dl table body article".split())
_ATTRIBUTES = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>|</[^>]*>", re.S
)
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "noscript")}
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


# How sure a mark is: the name contains a marked word, is one, or the element can't be text.
LOOSE, FIRM, SURE = 1, 2, 3


def mark_of(tag: str, attributes: str) -> tuple[int, bool]:
    """(how sure the element is boilerplate, whether it is named after readers' words)."""
    if tag in BOILERPLATE and tag != "form":
        return SURE, False
    mark, readers = LOOSE if tag == "form" else 0, False
    for name, *values in _NAMED.findall(attributes) if attributes.strip() else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            return SURE, False
        if name in ("class", "id") and MARKED.search(value) and tag not in ("body", "html", "article", "main"):
            for word in value.split():
                if MARKED.search(word) and re.split("[^a-z]", word)[0] not in REMARKS:
                    mark = max(mark, FIRM if MARKED.fullmatch(word) else LOOSE)
                    readers = readers or READERS.search(word) is not None
    return mark, readers


class Page:
    """Nodes in document order, so that a subtree is a range; and the text between them."""

    def __init__(self, source: str):
        self.tag, self.parent, self.cut, self.end = ["html"], [0], [False], [0]
        self.mark, self.readers = [0], [False]
        self.texts: list[tuple[int, str | None]] = []  # (node, text), None where a block begins or ends
        self._parse(source)
        self.end = [len(self.tag)] * len(self.tag)
        last = len(self.tag)
        ends = [k + 1 for k in range(last)]
        for k in range(last - 1, 0, -1):
            ends[self.parent[k]] = max(ends[self.parent[k]], ends[k])
        self.end = ends
        if any(self.mark):
            self._cut_marked()

    def _cut_marked(self) -> None:
        """Cut what is marked, unless it holds the page."""
        n = len(self.tag)
        own = [0] * n  # characters of the subtree outside marked elements in it
        for k, text in self.texts:
            if text:
                own[k] += len("".join(text.split()))
        holds = {tag: [k for k in range(1, n) if self.tag[k] == tag and not self.cut[k]] for tag in ("main", "article")}
        by_readers = [False] * n
        for k in range(1, n):
            by_readers[k] = self.readers[k] or by_readers[self.parent[k]]
        text = sum(x for x, skip in zip(own, by_readers) if not skip)
        for k in range(n - 1, 0, -1):
            if not self.mark[k]:
                own[self.parent[k]] += own[k]
        for k in range(1, n):
            cut = self.cut[self.parent[k]] or self.cut[k]
            if self.mark[k] and not cut:
                inside = [bisect_left(at, self.end[k]) - bisect_left(at, k) for at in holds.values()]
                page = inside[0] > 0 or 0 < inside[1] == len(holds["article"])
                if self.mark[k] == LOOSE and not self.readers[k]:
                    page = page or 2 * own[k] > text
                elif self.readers[k]:
                    page = inside[0] > 0
                cut = not page
            self.cut[k] = cut

    def _parse(self, source: str) -> None:
        stack, at, size = [0], 0, len(source)
        limit = source.rfind(">") + 1
        while at < size:
            found = _TOKEN.search(source, at, limit) if at < limit else None
            stop = found.start() if found else size
            if stop > at and not self.cut[stack[-1]]:
                self.texts.append((stack[-1], html.unescape(source[at:stop])))
            if not found:
                break
            at = found.end()
            name = found[2] or found[5]
            if not name:
                continue
            tag, attributes = name.lower(), found[3] or found[6] or ""
            if found[1] or found[4]:
                self._close(stack, tag)
                continue
            self._open(stack, tag, attributes)
            if tag in _RAW_END:
                ended = _RAW_END[tag].search(source, at)
                at = ended.end() if ended else size
                stack.pop()
            elif tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
                stack.pop()

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if self.tag[stack[k]] == "p":
                    del stack[k:]
                    break
                if self.tag[stack[k]] in BLOCKS:
                    break
        if tag in CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if self.tag[stack[k]] in _CLOSING_SCOPE:
                    break
                if self.tag[stack[k]] in CLOSES[tag]:
                    del stack[k:]
                    break
        parent = stack[-1]
        self.tag.append(tag)
        self.parent.append(parent)
        mark, readers = mark_of(tag, attributes)
        self.cut.append(self.cut[parent] or mark == SURE)
        self.mark.append(mark % SURE)
        self.readers.append(readers)
        node = len(self.tag) - 1
        stack.append(node)
        if tag in BLOCKS:
            self.texts.append((node, None))
        elif tag == "br":
            self.texts.append((node, " "))

    def _close(self, stack: list[int], tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] == tag:
                del stack[k:]
                if tag in BLOCKS:
                    self.texts.append((stack[-1], None))
                return

    def densities(self) -> tuple[list[float], list[float], list[int]]:
        """Per node: density, sum of the children's densities, characters; cut nodes have none."""
        n = len(self.tag)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        linked = [False] * n
        for k in range(1, n):
            linked[k] = self.tag[k] == "a" or linked[self.parent[k]]
        for k, text in self.texts:
            if text and not self.cut[k]:
                size = len("".join(text.split()))
                chars[k] += size
                link_chars[k] += size * linked[k]
        for k in range(n - 1, 0, -1):
            if not self.cut[k]:
                p = self.parent[k]
                chars[p] += chars[k]
                link_chars[p] += link_chars[k]
                tags[p] += tags[k] + 1
                link_tags[p] += link_tags[k] + linked[k]
        share = link_chars[0] / max(1, chars[0])
        density, sums = [0.0] * n, [0.0] * n
        for k in range(n - 1, -1, -1):
            c, t, lc, lt = chars[k], max(1, tags[k]), max(1, link_chars[k]), max(1, link_tags[k])
            if c:
                base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
                density[k] = c / t * max(0.0, math.log(max(1.0, c / lc * t / lt))) / max(1e-9, math.log(base))
            if k:
                sums[self.parent[k]] += density[k]
        for k in range(n):
            sums[k] = max(sums[k], density[k]) if self.end[k] == k + 1 else sums[k]
        return density, sums, chars

    def main(self) -> tuple[int, int]:
        """Range of the chosen subtree."""
        density, sums, chars = self.densities()
        core = max(range(len(sums)), key=lambda k: (sums[k], -k))
        path = [core]
        while path[-1]:
            path.append(self.parent[path[-1]])
        least = min(density[k] for k in path)
        chosen = core
        for k in path[1:]:
            inside = range(k + 1, self.end[k])
            others = [x for x in inside if self.parent[x] == k and chars[x] and not x <= chosen < self.end[x]]
            if all(density[x] >= least for x in others):
                chosen = k
            else:
                break
        around = [k for k in path if self.tag[k] in ("article", "main")]
        if around:
            chosen = min(chosen, around[-1])
        return chosen, self.end[chosen]

    def text(self) -> str:
        first, stop = self.main()
        blocks, open_block = [], []
        for k, text in [*self.texts, (first, None)]:
            if text is None:
                block = " ".join("".join(open_block).split())
                if block:
                    blocks.append(block)
                open_block = []
            elif first <= k < stop and not self.cut[k]:
                open_block.append(text)
        return "\n".join(blocks)


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for part in slices(batch.column(2)) for x in part.to_pylist()]
            sizes = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
            )

    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op6_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, folder, "pages", "page_id", "url", "html"))
