"""Reducing web pages to clean archival fragments.

The steps are data: a table of rules (step, selector, action) that an interpreter over a small element tree follows in
order. Whole pages are handled one by one in an Arrow-fed function; what regular expressions can say is also there as native
expressions. Images are resolved against an asset manifest by joins.
"""

from __future__ import annotations

import html as _html
import re
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import urls as U
from colophon.operators.images import Manifest, embed

# Elements that go with their content, elements that go without it, attributes that go, void elements.
FORBIDDEN = ["script", "style", "link", "iframe", "template", "object", "embed", "canvas", "video", "audio", "form", "input", "button", "select", "textarea", "nav", "search"]
UNWRAPPED = ["noscript", "source"]
STRIPPED = ["class", "style", "srcset", "sizes", "loading", "decoding"]
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
LINK_ATTRIBUTES = ("href", "src", "action", "formaction")

# What is noise on a page, as (selector, action); alternatives are separated by commas.
NOISE = [
    "[data-testid=SmallButtonDetails]", "[id^=libkey-nomad-]", "[role=navigation][aria-label=Table of contents]", ".FiguresOutlineWrapper",
    ".ArticleMetrics", ".AnnouncementCard", "[content-id][id^=fig]", ".fig-modal", "#article-popup", "section#Figures", ".html-fig_show",
    ".c-article-recommendations", ".app-explore-related-subjects", "#figure-carousel-section", "#Toolbar img", "#issueInfo-OUP_IssueInfo_Article",
    "table[aria-hidden=true]", "#section-cited-by", "#usercomments", "#divCommentModal", "#Toolbar", "#article_Pop", "#sections_Pop",
    "#recommended-articles", "#cited-by", "#metrics", "nav[aria-label=Article navigation and tools]", ".article-row-right", ".artmet-wrapper",
    ".article-article-cited-by", ".vt-widget-alerts", ".vt-related-content", ".widget-ArticleDataSupplements", "#figures-tables-wrap",
    "#supplimentary-materials-wrap", "#resultsanddiscussion-wrap", "#citedby-wrap", ".ref-tooltip", "article[class*=frontend-filesViewer]",
    "[class*=gen-ai__settings]", "img[alt~*=orcid]", "img[alt~*=crossmark]", "img[src*=unknown-user.png]", "img[alt~=plos]", "img[alt~=elsevier]",
    "a.citation--logo img", "a.pdf-download img", "img[alt~^=cover image]", "img[alt~=issue cover]", "img[alt~=arrow]", "img[alt~=pnas logo]",
    "img[src*=-cov150h.]", "img[src*=/pb-assets/journal-banners/]", ".PeopleList img", "a[aria-label^=Homepage for ] img",
    "img[alt^=The cover image for ]", "img[alt^=Creative Common License - ]", "a[title^=Go to ][title*= on ScienceDirect] img",
    "img[src*=silverchair-cdn.com][src*=/bio/]", "img[src*=silverchair-cdn.com][src*=_bio.]",
    "img[alt=Processing...]", "img[alt=Advertisement]", "img[alt=Account]", "img[alt=Facebook icon]", "img[alt=X icon]", "img[alt=LinkedIn icon]",
    "img[alt=Corresponding address]", "img[alt=Popup Image]", "img[alt=Plum X logo]", "img[alt=PlumX Metrics Logo]", "img[alt=Supplementary material: PDF]",
    "img.license-icon", "#core-collateral-figures", "#collapsible-figures_content",
]
# Navigation that is known by a link in it.
NOISE_BY_LINK = [("nav", "a[href=#cited-by]"), ("nav", "a[href=#metrics]")]
# Articles whose parts stand apart, as (part, what it needs inside) in order; a part may be left out if optional.
JOINED = [
    [("div.col-md-18", ".global-article-title", False), ("#article-overiew-abstract-wrap", "", False)],
    [("div.doi-isbn", "", True), ("div.pdfView", "#articleAbstractView", False)],
]
# Where the article is, tried in order; each narrows the root found so far. longest: the one with most text.
ROOTS_BEFORE = [("article", ["#abstracts", "#body"], "longest")]
ROOTS_AFTER = [
    ("div.content-inner-wrap", [".article-body"], "first"),
    ("#ContentColumn", ["h1", "#references"], "longest"),
    ("#ContentColumn", ["h1", "text:references"], "longest"),
    ("article", [".article__body"], "longest"),
    ("main.ArticleDetailsV4__main", [], "first"),
]
# What becomes a figure: wrapper, what it must hold, where its number stands, the pattern of the number, its id.
# "figure?" is a figure without an id; "@id" is the wrapper's own.
FIGURES = [
    ("div.fig.fig-section", "img[path-from-xml]", "img@alt", r"^(?:Figure|Fig\.)\s+(\d+)", "figure-{}"),
    ("div.fig.fig-section", "img[path-from-xml]", "img@alt", r"^Scheme\s+(\d+)", "scheme-{}"),
    ("div.graphical-abstract", "img[path-from-xml]", "", "", "visual-abstract"),
    ("div.table-wrap", ".fig-graphic img[path-from-xml]", "span.title-label@text", r"^Table\s+(\d+)", "table-{}"),
    ("div[id^=figure]", "img[src^=./Graphics/figure]", "@id", r"^figure(\d+)$", "figure-{}"),
    ("div[id^=F]", "img[src^=./Graphics/F]", "@id", r"(?i)^F(\d+)$", "figure-{}"),
    ("figure?", "img[src*=-toc-]", "", "", "visual-abstract"),
    ("figure?", "img", "a@href", r"(?i)-fig-0*(\d+)([a-z]*)-", "figure-{}{}"),
    ("figure?", "img", "img@src", r"(?i)-fx(\d+)\.(?:sml|jpg|jpeg|png)$", "equation-{}"),
    ("figure?", "img", "img@data-src", r"(?i)-fx(\d+)\.(?:sml|jpg|jpeg|png)$", "equation-{}"),
    ("figure?", "[id]", "[id]@id", r"(?i)^Fig(\d+)$", "figure-{}"),
    ("figure?", "img[src*=graphical-abstract]", "", "", "visual-abstract"),
    ("figure?", "img", "figcaption@text", r"(?i)^Figure\s+(\d+)\s*:", "figure-{}"),
    ("figure?", "img", "figcaption@text", r"(?i)^Scheme\s+(\d+)\s*:", "scheme-{}"),
    ("div.html-fig-wrap", "img", "", "", ""),
    ("p", "img[data-alt^=Figure ]", "img@data-alt", r"^Figure\s+(\d+)$", "figure-{}"),
    ("div[id^=f]", "img", "@id", r"(?i)^f(\d+)-", "figure-{}"),
    ("div.OncoFigure", "img", "div@id", r"(?i)^F(\d+)$", "figure-{}"),
    ("div.figure", "img", "a@href", r"/figure/(\d+)(?:[/?#]|$)", "figure-{}"),
    ("div.figure", "img", "a@href", r"\.g(\d+)(?:\D|$)", "figure-{}"),
    ("div.figure", "img", "a@href", r"\.t(\d+)(?:\D|$)", "table-{}"),
    ("div.ArticleFigure[id^=F]", "img[src*=/files/Articles/]", "@id", r"(?i)^F(\d+)$", "figure-{}"),
    ("div.fig", "img", "img@src", r"(?i)(?:fig|f)0*(\d+)[a-z]?\.jpe?g(?:[?&#]|$)", "figure-{}"),
    ("div.fig", "img", "img@data-src", r"(?i)(?:fig|f)0*(\d+)[a-z]?\.jpe?g(?:[?&#]|$)", "figure-{}"),
    ("div.article-section-wrapper", "img[path-from-xml]", "img@path-from-xml", r"(?i)-f0*(\d+)\.tiff?$", "figure-{}"),
]
# Controls that hold content, as (where, control, what it becomes).
KEPT_CONTROLS = [("#author-group", "button", "span"), (".ArticleFigure", "button", "div"), ("figure", "button", "div")]
# How the id or file name of a figure shows its number.
FIGURE_NUMBER = [r"(?i)^(?:fig(?:ure)?|f)[-_.]?0*(\d+)", r"(?i)-fig-0*(\d+)", r"(?i)\bfig(?:ure)?\.?\s*0*(\d+)", r"(?i)\.g0*(\d+)\b", r"(?i)fig0*(\d+)\.(?:jpe?g|png|gif|webp)"]

COUNTERS = ["source_bytes", "output_bytes", "removed_elements", "removed_attributes", "embedded_images", "embedded_large_figures", "unique_embedded_assets", "omitted_images", "duplicate_images_removed"]
STATS = ", ".join(f"{c} long" for c in COUNTERS)
#: An asset of a page as its manifest lists it, with its content; figure is the number of a large figure, else null.
ASSET = "struct<kind:string,url:string,path:string,width:int,height:int,bytes:long,content_type:string,figure:int,content:binary>"
CLEANED = f"html string, {STATS}, problems array<string>"


@dataclass(eq=False)
class Node:
    """An element; children are elements and strings in order."""

    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)
    parent: Node | None = None

    def elements(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def drop(self) -> None:
        self.parent.children[:] = [c for c in self.parent.children if c is not self]

    def unwrap(self) -> None:
        at = next(i for i, c in enumerate(self.parent.children) if c is self)
        for c in self.children:
            if isinstance(c, Node):
                c.parent = self.parent
        self.parent.children[at : at + 1] = self.children


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.top = Node("#root")
        self.doctype = False

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, [], self.top)
        self.top.children.append(node)
        if tag not in VOID:
            self.top = node

    def handle_startendtag(self, tag, attrs):
        self.top.children.append(Node(tag, {k: v or "" for k, v in attrs}, [], self.top))

    def handle_endtag(self, tag):
        node = self.top
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:
            self.top = node.parent

    def handle_data(self, data):
        self.top.children.append(data)


def parse(page: str) -> Node:
    """The element tree of a page without comments; noscript tags are taken off before, so their content is seen."""
    builder = _Builder()
    builder.feed(re.sub(r"(?i)</?noscript\b[^>]*>", "", page))
    builder.close()
    return builder.root


_STEP = re.compile(r"([a-z0-9*]+)?((?:[#.][\w-]+|\[[^\]]*\])*)", re.I)


@lru_cache(maxsize=4096)
def _tests(simple: str) -> tuple[str, tuple] | None:
    """Tag and conditions of one step of a selector, each (attribute, way to compare, value, without case); None if it is no step."""
    m = _STEP.fullmatch(simple)
    if not m:
        return None
    tests = []
    for part in re.findall(r"[#.][\w-]+|\[[^\]]*\]", m.group(2)):
        if part[0] == "#":
            tests.append(("id", "", part[1:], False))
        elif part[0] == ".":
            tests.append(("class", ".", part[1:], False))
        else:
            name, fold, op, value = re.fullmatch(r"\[([\w-]+)(?:(~)?([\^*$]?)=(.*))?\]", part).groups()
            tests.append((name, "?" if value is None else op, value, bool(fold)))
    return (m.group(1) or "").lower(), tuple(tests)


# How a value that an attribute has compares with the one that is asked for.
COMPARED = {
    "": lambda have, value: have == value,
    "?": lambda have, value: True,
    ".": lambda have, value: value in have.split(),
    "^": lambda have, value: have.startswith(value),
    "$": lambda have, value: have.endswith(value),
    "*": lambda have, value: value in have,
}


def _matches(node: Node, simple: str) -> bool:
    asked = _tests(simple)
    if asked is None or asked[0] not in ("", "*", node.tag):
        return False
    for name, how, value, fold in asked[1]:
        have = node.attrs.get(name)
        if have is None or not COMPARED[how](have.lower() if fold else have, value):
            return False
    return True


@lru_cache(maxsize=4096)
def _steps(selector: str) -> tuple[str, ...]:
    return tuple(re.findall(r"(?:[^\s\[\]]|\[[^\]]*\])+", selector))


def select(root: Node, selector: str) -> list[Node]:
    """Elements below the root that match a selector of steps (tag, #id, .class, [attribute…]) with 'inside' between them."""
    steps = _steps(selector)
    found = []
    for node in root.elements():
        if node is root or not _matches(node, steps[-1]):
            continue
        at, rest = node.parent, steps[:-1]
        while rest and at is not None:
            if _matches(at, rest[-1]):
                rest = rest[:-1]
            at = at.parent
        if not rest:
            found.append(node)
    return found


def _holds(node: Node, need: str) -> bool:
    if not need:
        return True
    if need.startswith("text:"):
        return need[5:] in node.text().lower()
    return bool(select(node, need))


def _narrow(root: Node, rules: list[tuple[str, list[str], str]]) -> Node:
    for selector, needs, which in rules:
        fits = [n for n in select(root, selector) if all(_holds(n, s) for s in needs)]
        if fits:
            root = max(fits, key=lambda n: len(n.text())) if which == "longest" else fits[0]
    return root


def article_root(root: Node) -> Node:
    """The part of the page that is the article; parts that stand apart are joined under a new element."""
    root = _narrow(root, ROOTS_BEFORE)
    for parts in JOINED:
        found = [(next((n for n in select(root, selector) if _holds(n, need)), None), optional) for selector, need, optional in parts]
        if all(n is not None or optional for n, optional in found):
            whole = Node("div")
            for n, _ in found:
                if n is not None:
                    n.drop()
                    n.parent = whole
                    whole.children.append(n)
            root = whole
    return _narrow(root, ROOTS_AFTER)


def _readings(node: Node, where: str) -> list[str]:
    selector, _, name = where.rpartition("@")
    nodes = [node] if not selector else select(node, selector)
    return [n.text().strip() if name == "text" else n.attrs.get(name, "").strip() for n in nodes]


def promote_figures(root: Node) -> None:
    """Turns wrappers of scientific images into figures with a stable id, rule by rule."""
    for wrapper, holds, where, pattern, new_id in FIGURES:
        for node in select(root, wrapper.rstrip("?")):
            if wrapper.endswith("?") and node.attrs.get("id") or not _holds(node, holds):
                continue
            if where:
                m = next((m for text in _readings(node, where) if (m := re.search(pattern, text))), None)
                if m is None:
                    continue
                groups = [str(int(g)) if g.isdigit() else g.lower() for g in m.groups()]
                node.attrs["id"] = new_id.format(*groups)
            elif new_id:
                node.attrs["id"] = new_id
            node.tag = "figure"
    for where, control, tag in KEPT_CONTROLS:
        for node in select(root, f"{where} {control}"):
            if tag == "span" and node.text().strip() or tag == "div" and select(node, "img"):
                node.tag = tag


def render(node: Node | str) -> str:
    if isinstance(node, str):
        return _html.escape(node, quote=False)
    inner = "".join(render(c) for c in node.children)
    if node.tag == "#root":
        return inner
    attrs = "".join(f' {k}="{_html.escape(v)}"' for k, v in node.attrs.items())
    return f"<{node.tag}{attrs}>" + ("" if node.tag in VOID else f"{inner}</{node.tag}>")


def problems(fragment: str) -> list[str]:
    """What a fragment must not hold: doctype, html or head, none or several bodies, forbidden elements."""
    found = []
    if re.search(r"(?i)<!doctype", fragment):
        found.append("doctype")
    if re.search(r"(?i)<(?:html|head)\b", fragment):
        found.append("document")
    if len(re.findall(r"(?i)<body\b", fragment)) != 1:
        found.append("body")
    found += [f"forbidden:{t}" for t in FORBIDDEN if re.search(rf"(?i)<{t}\b", fragment)]
    return found


def _remove(nodes: list[Node]) -> int:
    """Takes elements out of the tree, once each; the text around them stays."""
    n = 0
    for node in nodes:
        if node.parent is not None:
            node.drop()
            node.parent = None
            n += 1
    return n


def clean(page: str, base_url: str = "", assets: Manifest | None = None) -> dict:
    """A page as ``<body>`` fragment, with counts. ``assets`` has the images that may be embedded; without it images stay as they
    are. Text around a removed element stays."""
    tree = parse(page)
    count = dict.fromkeys(COUNTERS, 0)
    root = article_root(tree)
    noise = [n for s in NOISE for n in select(root, s)] + [n for s, link in NOISE_BY_LINK for n in select(root, s) if select(n, link)]
    count["removed_elements"] += _remove(noise)
    promote_figures(root)
    count["removed_elements"] += _remove([n for s in FORBIDDEN for n in select(root, s)])
    if assets is not None:  # before the elements around them are unwrapped, which hold some of their addresses
        made = embed([n for n in root.elements() if n.tag == "img"], base_url, assets, lambda text, parent: Node("span", {}, [text], parent))
        count |= made.counts()
    for tag in UNWRAPPED + ["body", "html", "head"]:
        for node in select(root, tag):
            node.unwrap()
    if root.tag in ("body", "html"):
        root.tag, root.attrs = "#root", {}
    for node in root.elements():
        bad = [k for k, v in node.attrs.items() if k in STRIPPED or k.startswith(("data-", "on")) or k in LINK_ATTRIBUTES and v.strip().lower().startswith("javascript:")]
        count["removed_attributes"] += len(bad)
        for k in bad:
            del node.attrs[k]
    out = f"<body>\n{render(root).strip()}\n</body>"
    return {"html": out} | count | {"source_bytes": len(page.encode()), "output_bytes": len(out.encode()), "problems": problems(out)}


def cleaned(page: Column, base_url: Column | None = None, assets: Column | None = None) -> Column:
    """struct of CLEANED for each page; null gives null in every part. ``assets`` is an array of ASSET for each page."""
    parts = ["html", *COUNTERS, "problems"]

    def one(p: str | None, base: str | None, listed) -> dict:
        if p is None:
            return dict.fromkeys(parts)
        return clean(p, base or "", None if listed is None else Manifest([a if isinstance(a, dict) else a.asDict() for a in listed]))

    def run(pages: pd.Series, bases: pd.Series, listed: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(*x) for x in zip(pages, bases, listed)], columns=parts)

    nothing = F.lit(None).cast(f"array<{ASSET}>")
    return F.pandas_udf(run, CLEANED)(page, base_url if base_url is not None else F.lit(""), assets if assets is not None else nothing)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(file, pos, kind, url, path, width, height, bytes, content_type, figure)`` of JSON manifests of images and of large figures."""
    one = "array<struct<kind:string,url:string,path:string,width:int,height:int,bytes:long,contentType:string,figure:int>>"
    files = spark.read.schema(f"assets {one}").option("multiLine", True).json(path).select(F.input_file_name().alias("file"), F.posexplode("assets").alias("pos", "a"))
    return files.select("file", "pos", F.coalesce("a.kind", F.when(F.col("a.figure").isNotNull(), F.lit("large"))).alias("kind"), "a.url", "a.path", "a.width", "a.height", "a.bytes", F.col("a.contentType").alias("content_type"), "a.figure")


def clean_pages(pages: DataFrame, manifest: DataFrame, contents: DataFrame) -> DataFrame:
    """``(page_id, c)``: pages (page_id, base_url, html) with the assets of their manifests embedded.

    ``manifest`` has page_id and the columns of read_manifest, ``contents`` path and content. A page carries its own assets
    only, which are brought to it by two joins; a page without manifest keeps nothing but the descriptions of its images.
    """
    held = manifest.join(contents.select("path", "content"), "path")
    fields = ["kind", "url", "path", "width", "height", "bytes", "content_type", "figure", "content"]
    listed = held.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("pos", *fields))).alias("a"))
    listed = listed.select("page_id", F.transform("a", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("assets"))
    all_of = pages.join(listed, "page_id", "left").withColumn("assets", F.coalesce("assets", F.array().cast(f"array<{ASSET}>")))
    return all_of.select("page_id", cleaned(F.col("html"), F.col("base_url"), F.col("assets")).alias("c"))


def write_fragments(rows: DataFrame, folder: str) -> None:
    """Fragments and their counts as a table, and the counts of all pages as JSON beside it."""
    rows.write.mode("overwrite").parquet(f"{folder}/fragments")
    totals = rows.agg(F.count(F.lit(1)).alias("pages"), *[F.sum(f"c.{c}").alias(c) for c in COUNTERS])
    totals.coalesce(1).write.mode("overwrite").json(f"{folder}/counts")


def without_noscript(page: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(page, r"(?s)<!--.*?-->", ""), r"(?i)</?noscript\b[^>]*>", "")


def forbidden_count(page: Column) -> Column:
    return F.regexp_count(page, F.lit(r"(?i)<(?:" + "|".join(FORBIDDEN) + r")\b")).cast("long")


def without_forbidden(page: Column) -> Column:
    """The page without paired forbidden elements that aren't nested, and without the void ones."""
    for tag in FORBIDDEN:
        page = F.regexp_replace(page, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    return F.regexp_replace(page, r"(?is)<(?:link|embed|input)\b[^>]*>", "")


ATTRIBUTE = r"(?i)\s(?:class|style|srcset|sizes|loading|decoding|data-[\w-]+|on[a-z]+)\s*=\s*(?:\"[^\"]*\"|'[^']*')"


def without_attributes(page: Column) -> Column:
    return F.regexp_replace(page, ATTRIBUTE, "")


def attribute_count(page: Column) -> Column:
    return F.regexp_count(page, F.lit(ATTRIBUTE)).cast("long")


def broken_promises(page: Column) -> Column:
    """Codes of what a fragment must not hold, as native expressions."""
    return F.array_compact(F.array(
        F.when(page.rlike(r"(?i)<!doctype"), F.lit("doctype")),
        F.when(page.rlike(r"(?i)<(?:html|head)\b"), F.lit("document")),
        F.when(F.regexp_count(page, F.lit(r"(?i)<body\b")) != 1, F.lit("body")),
        F.when(forbidden_count(page) > 0, F.lit("forbidden")),
    ))


def figure_number(alt: Column, *hints: Column) -> Column:
    """The number of a figure from its description, else from ids, file names and links, in this order; null without any."""
    tries = [F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for c in (alt, *hints) for p in FIGURE_NUMBER]
    return F.coalesce(*tries).cast("int")


# Assets.


def best_renditions(assets: DataFrame) -> DataFrame:
    """Of the images with one address the largest in area, then in bytes, then the one first in the manifest."""
    images = assets.where("kind = 'image'").withColumn("url", U.without_fragment(F.col("url")))
    order = F.struct((F.coalesce("width", F.lit(0)).cast("long") * F.coalesce("height", F.lit(0))).alias("area"), F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), (-F.col("pos")).alias("p"))
    return images.groupBy("url").agg(F.max_by("path", order).alias("path"), F.max_by("content_type", order).alias("content_type"))


def path_index(renditions: DataFrame) -> DataFrame:
    """``(key, path)`` of the address keys that only one address has."""
    keyed = renditions.withColumn("key", U.path_key(F.col("url")))
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")).where("n = 1").drop("n")


def resolve_assets(candidates: DataFrame, renditions: DataFrame) -> DataFrame:
    """``(page_id, image, pos, path)``: for each image the asset of its first candidate address that has one, by the address itself
    or else by its unambiguous key; path is null without any. ``candidates`` has page_id, image, pos and url."""
    c = candidates.withColumn("url", U.without_fragment(F.col("url"))).withColumn("key", U.path_key(F.col("url")))
    exact = c.join(renditions.select("url", F.col("path").alias("exact")), "url", "left")
    both = exact.join(path_index(renditions).withColumnRenamed("path", "by_key"), "key", "left").withColumn("path", F.coalesce("exact", "by_key"))
    first = F.min(F.when(F.col("path").isNotNull(), F.struct("pos", "path")))
    return both.groupBy("page_id", "image").agg(first.alias("m")).select("page_id", "image", F.col("m.pos").alias("pos"), F.col("m.path").alias("path"))


def keep_first(images: DataFrame, key: str = "path", order: str = "image", fill: str = "alt") -> DataFrame:
    """The first image of each page and asset; a description that it lacks comes from the first dropped image that has one.

    Two minima a group, so the rows of a page with a third of all images are combined before they are shuffled.
    """
    others = [c for c in images.columns if c not in ("page_id", key, order, fill)]
    whole = F.min_by(F.struct(*others, F.col(fill).alias(fill)), order) if others else None
    said = F.min_by(F.col(fill), F.when(F.nullif(F.col(fill), F.lit("")).isNotNull(), F.col(order)))
    grouped = images.groupBy("page_id", key).agg(F.min(order).alias(order), said.alias(fill), *([whole.alias("_first")] if others else []))
    return grouped.select(*[F.col(f"_first.{c}").alias(c) if c in others else F.col(c) for c in images.columns])


def data_url(content: Column, content_type: Column) -> Column:
    """Content as an address; base64 breaks lines after 76 characters, which an address doesn't."""
    return F.concat(F.lit("data:"), content_type, F.lit(";base64,"), F.replace(F.base64(content), F.lit("\r\n"), F.lit("")))
