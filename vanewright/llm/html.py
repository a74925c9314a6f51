"""Main-text extraction by consensus host paths.

Pass one scores each page's containers: the length of the text in their own blocks, less what stands in links, with half
of it for the parent. Every page votes for the generalised path (tag and class names, digits as #) of its best container.
Spark sums the votes by host. Pass two extracts from the host's winning path where the page has it, and from the page's
own best container where not. Boilerplate inside the container is left out in both.

Elements that are boilerplate by tag, role or as hidden are left out as they are read. Forms, and blocks whose class or id
marks boilerplate, are suspects: they are left out unless they wrap the page, see ``_wrappers``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.llm.common import append, materialise

# Fixed values, from the public HTML standard: elements without content, elements whose content is no text of the page,
# block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article main section div td body blockquote center html".split())
# Elements that are no main text, class and id names that mark such, words that may stand beside those in a
# compound name, and roles.
ASIDE = frozenset("nav aside footer header form menu dialog button select head".split())
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising alert alerts banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies
    disqus footer footnav gdpr header masthead menu menus nav navbar navigation newsletter notice notices pagination pager popup promo promos promoted recommended
    related replies respond share sharing sidebar sidebars signup social sponsor sponsored subscribe subscription toolbar widget widgets""".split()
)
BESIDE = frozenset("aside area bar block box bottom buttons container content global inner item items left links list main outer page panel primary post posts right secondary section site slot thread top unit user wrap wrapper".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# Their classes tell of parts they have, as in <body class="has-sidebar">.
WHOLE = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|</\s*([a-zA-Z][a-zA-Z0-9:-]*)[^>]*>?|<([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_ENDS = {tag: re.compile(f"</{tag}[\\s>/]", re.I) for tag in RAW}
_CLOSES_P = BLOCK - {"li", "td", "th", "tr", "dd", "dt", "option", "body", "html", "head", "tbody", "thead", "tfoot"}
# What a page's main text stands in or under, and what a form around a whole page holds besides.
_CORE = frozenset("article main h1".split())
_FURNITURE = frozenset("nav header footer aside".split())
_HEADING = re.compile("<(h[1-6])[\\s>]|</header", re.I)
#: Elements that a closing tag of something inside does not close.
_KEEPS_OPEN = frozenset("article main section div td nav footer aside header".split())


def marked_name(name: str) -> bool:
    """Whether a class or id name marks boilerplate: the whole name, or a compound of marks and words that may stand beside.

    A header or footer is the page's own only when named so, or by site, page, main, global, top or bottom.
    """
    parts = [p for p in re.split(r"[^a-z]+", name) if p]
    marks = MARKS.intersection(parts)
    if not marks or not all(p in MARKS or p in BESIDE for p in parts):
        return False
    if marks <= {"header", "footer"}:
        return all(p in marks or p in ("site", "page", "main", "global", "top", "bottom") for p in parts)
    return True


def _attributes(text: str) -> tuple[str, bool, bool]:
    """Class names, whether class or id mark boilerplate, and whether role marks it or the element is hidden."""
    names, marked, hidden = "", False, False
    for key, value in _ATTRIBUTE.findall(text):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "class":
            names = value
        if key in ("class", "id") and any(map(marked_name, value.split())):
            marked = True
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    return names, marked, hidden


class Page:
    """Blocks of a page in order: (number of the container, text), and the containers with parents and scores.

    A path is a number; ``steps`` has each path's parent and last label, so that depth costs no memory twice.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[int, str]] = []
        # Of each block its suspect and what it is worth; of each suspect (0: none) the one around it, whether it is a form,
        # and how many core elements and how much furniture stand in it but in no other suspect.
        self.held: list[tuple[int, int]] = []
        self.around: list[int] = [0]
        self.form: list[bool] = [False]
        self.core: list[int] = [0]
        self.furniture: list[int] = [0]
        self.steps: list[tuple[int, str]] = [(-1, "")]
        self.numbers: dict[tuple[int, str], int] = {}
        self.paths: list[int] = [0]
        self.parents: list[int] = [-1]
        self.scores: list[float] = [0.0]
        self._read(source)
        self._weigh(self._wrappers())

    def _wrappers(self) -> list[bool]:
        """Of each suspect, whether it and those around it wrap the page: while no core element (article, main, h1) stands
        outside of suspects, one that holds such, or furniture where it is a form, and over half of the page's text."""
        size, core, furniture = [0] * len(self.around), self.core.copy(), self.furniture.copy()
        for (_, text), (suspect, _) in zip(self.blocks, self.held, strict=True):
            size[suspect] += len(text)
        total = sum(size)
        for k in range(len(size) - 1, 0, -1):
            for sums in (size, core, furniture):
                sums[self.around[k]] += sums[k]
        clear, out = self.core[0], [True]
        for k in range(1, len(size)):
            holds = core[k] or self.form[k] and furniture[k]
            out.append(bool(out[self.around[k]] and not clear and holds and 2 * size[k] > total))
            clear += self.core[k] if out[k] else 0
        return out

    def _weigh(self, wrappers: list[bool]) -> None:
        """Drop the blocks of other suspects, and give the others' worth to their containers, half of it to each parent."""
        kept = [k for k, (suspect, _) in enumerate(self.held) if wrappers[suspect]]
        for k in kept:
            at, worth = self.blocks[k][0], float(self.held[k][1])
            while at >= 0 and worth >= 1:
                self.scores[at] += worth
                at, worth = self.parents[at], worth / 2
        self.blocks = [self.blocks[k] for k in kept]

    def _path(self, parent: int, label: str) -> int:
        if (parent, label) not in self.numbers:
            self.numbers[parent, label] = len(self.steps)
            self.steps.append((parent, label))
        return self.numbers[parent, label]

    def _read(self, source: str) -> None:
        # An open element: (tag, container it is in or is, in boilerplate, path, suspect it is in or is).
        stack: list[tuple[str, int, bool, int, int]] = [("", 0, False, 0, 0)]
        depth: dict[str, int] = {}  # how many of a tag are open
        text: list[str] = []
        linked = in_link = articles = 0
        ahead = _HEADING.search(source)  # the next heading or end of a header: an article's or main's header with a heading is its own

        def flush() -> None:
            nonlocal linked
            if text:
                joined = " ".join(html.unescape("".join(text)).split())
                text.clear()
                if joined:
                    self.blocks.append((stack[-1][1], joined))
                    self.held.append((stack[-1][4], max(0, len(joined) - 2 * linked)))
            linked = 0

        def close_from(k: int) -> None:
            nonlocal articles
            for tag, *_ in stack[k:]:
                depth[tag] -= 1
                articles -= tag in ("article", "main")
            del stack[k:]

        pos, end = 0, len(source)
        while pos < end:
            m = _TOKEN.match(source, pos)
            pos = m.end()
            close, tag = m.group(1), m.group(2)
            if tag:
                tag = tag.lower()
                raw = m.group(3)
                if tag in BLOCK:
                    flush()
                    if stack[-1][0] == "p" and tag in _CLOSES_P:
                        close_from(len(stack) - 1)
                elif tag == "br":
                    text.append(" ")
                if tag in VOID or raw.endswith("/") and tag not in BLOCK:
                    continue
                if tag in RAW:
                    at = _ENDS[tag].search(source, pos)
                    if at:
                        pos = source.find(">", at.start()) + 1 or end
                    elif tag in ("script", "style"):
                        pos = end
                    continue
                names, marked, hidden = _attributes(raw) if raw else ("", False, False)
                _, at, off, path, suspect = stack[-1]
                own = False
                if tag == "header" and articles:
                    if ahead is not None and ahead.start() < pos:
                        ahead = _HEADING.search(source, pos)
                    own = ahead is not None and ahead.group(1) is not None
                marked = marked and tag not in WHOLE and not own or tag == "form"
                gone = hidden or not own and tag in ASIDE and tag != "form" or marked and tag not in BLOCK
                if not off and tag in _FURNITURE and not own:
                    self.furniture[suspect] += 1
                if not off and not gone and marked:
                    self.around.append(suspect)
                    self.form.append(tag == "form")
                    self.core.append(0)
                    self.furniture.append(0)
                    suspect = len(self.around) - 1
                if not off and not gone and tag in _CORE:
                    self.core[suspect] += 1
                if tag not in BLOCK and tag != "a" and not gone and not off:
                    continue  # inline and open text: nothing changes
                if tag == "a":
                    in_link += 1
                off = off or gone
                if tag in BLOCK:
                    path = self._path(path, ".".join([tag, *sorted(re.sub(r"[0-9]+", "#", names).split())]))
                if tag in CONTAINER and not off:
                    self.paths.append(path)
                    self.parents.append(at)
                    self.scores.append(0.0)
                    at = len(self.paths) - 1
                articles += tag in ("article", "main")
                depth[tag] = depth.get(tag, 0) + 1
                stack.append((tag, at, off, path, suspect))
            elif close:
                close = close.lower()
                if close in BLOCK:
                    flush()
                if close == "a" and in_link:
                    in_link -= 1
                if depth.get(close):
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == close:
                            close_from(k)
                            break
                        if stack[k][0] in _KEEPS_OPEN and close not in _KEEPS_OPEN and close not in ("ul", "ol", "table", "body", "html", "form", "dialog", "menu", "blockquote"):
                            break
            elif not stack[-1][2]:
                t = m.group()
                if t[0] != "<" or t == "<":
                    text.append(t)
                    if in_link:
                        linked += len(t)
        flush()

    def path(self, container: int) -> str:
        """Labels from the root, joined by >."""
        out, at = [], self.paths[container]
        while at > 0:
            at, label = self.steps[at]
            out.append(label)
        return ">".join(reversed(out))

    def best(self) -> int:
        """The container with the highest score; article and main elements count double, the first on ties."""
        bonus = lambda p: 2 if self.steps[p][1].split(".")[0] in ("article", "main") else 1
        return max(range(len(self.paths)), key=lambda k: (self.scores[k] * bonus(self.paths[k]), -k))

    def text(self, inside: set[int]) -> str:
        """The blocks in the given containers or below them."""
        held = [False] * len(self.paths)
        for k in range(len(self.paths)):
            held[k] = k in inside or self.parents[k] >= 0 and held[self.parents[k]]
        return "\n".join(t for at, t in self.blocks if held[at])

    def extract(self, path: str | None) -> str:
        found = ""
        if path is not None:
            at: int | None = 0
            for label in path.split(">") if path else []:
                at = self.numbers.get((at, label))
                if at is None:
                    break
            found = self.text({k for k, p in enumerate(self.paths) if p == at}) if at is not None else ""
        return found or self.text({self.best()})


#: Parts that the pages of a host are dealt into where the table of hosts is too large to broadcast.
DEALT = 16


def host(url: str) -> Column:
    """Host in lower case; null or unreadable urls share the empty one."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def winning_paths(pages: DataFrame, source: str = "html", url: str = "url") -> DataFrame:
    """(host, path): by number of pages that vote for it, then by their score, then by name."""

    def start() -> Callable:
        def work(pages: list) -> list:
            paths, scores = [], []
            for p in pages:
                page = Page(p or "")
                best = page.best()
                paths.append(page.path(best) if page.scores[best] > 0 else None)
                scores.append(page.scores[best])
            return [paths, scores]

        return work

    votes = append(pages.select(host(url).alias("host"), F.col(source).alias("html")), "html", [("path", "string"), ("score", "double")], start)
    sums = votes.where("path is not null").groupBy("host", "path").agg(F.count("*").alias("pages"), F.sum("score").alias("score"))
    return sums.groupBy("host").agg(F.min_by("path", F.struct(-F.col("pages"), -F.round("score", 3), "path")).alias("path"))


def extract(pages: DataFrame, source: str = "html", url: str = "url") -> DataFrame:
    """Replace the source column by text and n_chars. Null or empty pages, and pages without main text, give the empty text.
    Repeated pages vote and come out each; on ties the path first by name wins. Input columns with the names of results
    are replaced. An empty table gives an empty one. Pages of any length are read whole, in linear time and memory.

    The table of hosts is broadcast while Spark measures it under its threshold; beyond it, pages are dealt by host and a
    salt, so that the pages of one host meet in many tasks.
    """
    paths = materialise(winning_paths(pages, source, url), "html-paths").withColumnsRenamed({"host": "_host", "path": "_path"})
    keep = [c for c in pages.columns if c not in ("text", "n_chars", "_host", "_path", "_deal")]
    rows = pages.select(*[F.col(f"`{c}`") for c in keep]).withColumn("_host", host(url))
    others = [F.col(f"`{c}`") for c in keep if c != source] or [F.lit(0)]
    rows = rows.withColumn("_deal", F.pmod(F.xxhash64(*others), F.lit(DEALT)).cast("int"))
    copies = paths.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    joined = rows.join(copies, ["_host", "_deal"], "left")
    return _extracted(joined, source).drop("_host", "_path", "_deal")


def _extracted(joined: DataFrame, source: str) -> DataFrame:
    at, path = joined.columns.index(source), joined.columns.index("_path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(h or "").extract(p) for h, p in zip(batch.column(at).to_pylist(), batch.column(path).to_pylist(), strict=True)]
            more = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            kept = [k for k in range(batch.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], *more], names=[*[batch.schema.names[k] for k in kept], "text", "n_chars"])

    fields = [f for k, f in enumerate(joined.schema.fields) if k != at]
    return joined.mapInArrow(run, T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))


def op9(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
