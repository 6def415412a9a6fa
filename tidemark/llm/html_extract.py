"""Main text of web pages by template deduction over the pages of a host.

Tokens of a page are its elements (by their path of tags and classes) and its text blocks.
Tokens of a host with the same occurrence vector - as often on each page - form an
equivalence class. On every page the tokens of a class must come in the same order and
stand in the same gap between the elements of the host's widest class, its skeleton; tokens
that do not are taken out. Classes on enough pages that hold a valid element are nested that
way and make up the host's template. What a template holds as text is the site's; what is
left are its slots. The slots under menus, forms, notices and the like are not the article;
of the others those inside the article element count, or, on pages without one, all.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_PAGES, MIN_SHARE = 3, 0.5

# Names of HTML elements and usual class names.
_RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "select", "object", "canvas", "title"}
_DROPPED = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "head"}
_INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|header|masthead|"
    r"menu|modal|nav|navbar|navigation|newsletter|notices?|popup|promo|related|share|sharing|sidebar|social|sponsor\w*|"
    r"subscribe|toolbar|widget|contentinfo|complementary|search|replies|responses)(?:$|[\s_-])"
)
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[^<]++|<""", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")


def _attributes(text: str) -> dict[str, str]:
    return {n.lower(): html.unescape(v.strip("\"'")).lower() for n, v in _ATTRIBUTE.findall(text)} if text.strip() else {}


def _is_dropped(tag: str, attributes: dict[str, str]) -> bool:
    if tag in _DROPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    named = " ".join(attributes.get(n, "") for n in ("class", "id", "role"))
    return bool(named.strip()) and tag not in ("html", "body", "article", "main") and bool(_MARKS.search(named))


def blocks_of(page: str) -> tuple[list[tuple[str, str, bool, bool]], list[tuple[str, str | None]]]:
    """Text blocks (path, text, inside an article or main element, dropped) in page order, and
    elements that were opened (path, None) and blocks (path, text) in page order."""
    stack: list[tuple[str, str, bool, bool]] = []  # tag, path, in the article, dropped
    blocks: list[tuple[str, str, bool, bool]] = []
    order: list[tuple[str, str | None]] = []
    held: list[str] = []
    raw = ""

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            _, path, main, dropped = stack[-1] if stack else ("", "", False, False)
            blocks.append((path, text, main, dropped))
            order.append((path, text))

    for token in _TOKEN.finditer(page):
        found, tag = token.group(), token.group(2)
        if raw:
            if tag and token.group(1) and tag.lower() == raw:
                raw = ""
            continue
        if not tag:
            if found[0] != "<" or found == "<":
                held.append(html.unescape(found))
            continue
        tag = tag.lower()
        if tag in _INLINE:
            continue
        flush()
        if token.group(1):
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if at >= 0:
                del stack[at:]
            continue
        if tag in _RAW:
            if not token.group(3).endswith("/"):
                raw = tag
            continue
        if tag in _VOID:
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or re.fullmatch(r"h[1-6]|div|section|article|ul|ol|table|footer", tag):
            if stack and stack[-1][0] == "p":
                stack.pop()
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
                stack.pop()
        attributes = _attributes(token.group(3))
        _, path, main, dropped = stack[-1] if stack else ("", "", False, False)
        name = tag + "." + ".".join(sorted(attributes["class"].split())) if attributes.get("class") else tag
        main = main or tag in ("article", "main") or attributes.get("role") == "main"
        stack.append((tag, f"{path}/{name}", main, dropped or _is_dropped(tag, attributes)))
        order.append((f"{path}/{name}", None))
    flush()
    return blocks, order


def _token(kind: str, path: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}\0{path}\0{text}") - (1 << 63)


def page_tokens(page: str) -> list[tuple[int, bool]]:
    """The page's tokens in order, each with whether it is an element."""
    _, order = blocks_of(page)
    return [(_token("element", path, ""), True) if text is None else (_token("block", path, text), False) for path, text in order]


def places(tokens: list[int], classes: dict[int, int], skeleton: set[int]) -> Iterator[tuple[int, int, int, int]]:
    """For each occurrence of a class's token: token, the tokens of its class before and after
    it (the class taken as a ring), and the element of the skeleton that it follows."""
    rings: dict[int, list[tuple[int, int]]] = {}
    gap = 0
    for token in tokens:
        if token in skeleton:
            gap = token
        if token in classes:
            rings.setdefault(classes[token], []).append((token, 0 if token in skeleton else gap))
    for ring in rings.values():
        for i, (token, at) in enumerate(ring):
            yield token, ring[i - 1][0], ring[(i + 1) % len(ring)][0], at


def extract(page: str, template: set[int] | frozenset[int], root: str | None = None) -> str:
    """The article's text, given the host's template tokens: the slots that no mark rejects,
    under ``root`` if a path is given.

    An article element of whose text the template holds more than half is one of several
    copies of an article, and is kept whole.
    """
    blocks, _ = blocks_of(page)
    kept = [b for b in blocks if not b[3]]
    slots = [b for b in kept if _token("block", b[0], b[1]) not in template]
    if any(main for _, _, main, _ in blocks):
        whole, free = ([text for _, text, main, _ in found if main] for found in (kept, slots))
        return " ".join(free if 2 * sum(map(len, free)) >= sum(map(len, whole)) else whole)
    return " ".join(text for path, text, _, _ in slots if not root or f"{path}/".startswith(f"{root}/"))


def host_of(url: str) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def _pages(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    return pages.select(host_of(url).alias("host"), F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(page).alias("_html"))


def _list(batch: pa.RecordBatch, column: int, row: int) -> list:
    return batch.column(column)[row].as_py() or []


def classes_of(source: DataFrame) -> DataFrame:
    """Per host, four lists of equal length: token, class, whether it is an element, pages.

    A token's occurrence vector is kept as the sum and the exclusive or of hashed (page, count)
    pairs, so no task holds the pages of a host; counts are added up per task first. Only
    tokens on at least ``MIN_PAGES`` pages and ``MIN_SHARE`` of the host's pages are gathered,
    which bounds the lists by the tokens of two average pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for host, text, mark in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for (token, element), n in Counter(page_tokens(text or "")).items():
                    for column, value in zip(rows, (host, token, element, n, mark), strict=True):
                        column.append(value)
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["host", "token", "element", "n", "mark"]
            )

    marked = source.select("host", "_html", F.xxhash64("_key", "_url").alias("mark"))
    found = marked.mapInArrow(run, "host string, token long, element boolean, n long, mark long")
    pair = F.xxhash64("mark", "n")
    tokens = found.groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.bool_or("element").alias("element"), F.sum("n").alias("n"),
        F.bit_xor(pair).alias("xor"), F.sum(pair.bitwiseAND(F.lit((1 << 32) - 1))).alias("sum"),
    )
    counts = source.groupBy("host").agg(F.count("*").alias("host_pages"))
    wide = tokens.join(counts, "host").filter(
        (F.col("pages") >= MIN_PAGES) & (F.col("pages") >= F.col("host_pages") * F.lit(MIN_SHARE))
    )
    vector = F.xxhash64("pages", "n", "xor", "sum")
    lists = wide.groupBy("host").agg(F.collect_list(F.struct("token", vector.alias("class"), "element", "pages")).alias("found"))
    return lists.select("host", *(F.col(f"found.{c}").alias(f"_{c}") for c in ("token", "class", "element", "pages")))


def skeleton_of(tokens: list[int], classes: list[int], elements: list[bool], pages: list[int]) -> set[int]:
    """The elements of the class that is on most pages and, of several, has most elements."""
    by_class: dict[int, set[int]] = {}
    width = dict(zip(classes, pages, strict=True))
    for token, kind, element in zip(tokens, classes, elements, strict=True):
        if element:
            by_class.setdefault(kind, set()).add(token)
    return max(by_class.items(), key=lambda c: (width[c[0]], len(c[1]), c[0]), default=(0, set()))[1]


def templates(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per host: template (hashes of its block tokens)."""
    return _templates(_pages(pages, key, url, page))


def _templates(source: DataFrame) -> DataFrame:
    known = classes_of(source)
    names = ["host", "token", "class", "element", *(f"{f}_{c}" for c in ("before", "after", "gap") for f in ("min", "max"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, classes, elements, skeleton = None, {}, set(), set()
        for batch in batches:
            seen: dict[tuple[str, int, int, bool], list[int]] = {}
            usable = batch.column(4).is_valid().to_pylist()
            hosts = batch.column(0).to_pylist()
            for row in (i for i, use in enumerate(usable) if use):
                if hosts[row] != last:
                    last, lists = hosts[row], [_list(batch, i, row) for i in range(4, 8)]
                    classes, skeleton = dict(zip(lists[0], lists[1], strict=True)), skeleton_of(*lists)
                    elements = {t for t, e in zip(lists[0], lists[2], strict=True) if e}
                tokens = [t for t, _ in page_tokens(batch.column(3)[row].as_py() or "")]
                for token, *place in places(tokens, classes, skeleton):
                    ends = seen.setdefault((last, token, classes[token], token in elements), [v for p in place for v in (p, p)])
                    for i, value in enumerate(place):
                        ends[2 * i], ends[2 * i + 1] = min(ends[2 * i], value), max(ends[2 * i + 1], value)
            columns = list(zip(*((*k, *v) for k, v in seen.items()), strict=True)) or [()] * len(names)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = ", ".join(f"`{n}` {'string' if n == 'host' else 'boolean' if n == 'element' else 'long'}" for n in names)
    # the same exchange of the pages as in extract_pages: left, so that Spark can use it again
    placed = source.join(known, "host", "left").select(*source.columns, "_token", "_class", "_element", "_pages").mapInArrow(run, schema)
    ends = placed.groupBy("host", "token", "class", "element").agg(*(getattr(F, n[:3])(n).alias(n) for n in names[4:]))
    same = {c: F.col(f"min_{c}") == F.col(f"max_{c}") for c in ("before", "after", "gap")}
    # of two tokens that change places, both differ on both sides; their neighbours on one
    valid = ends.filter((same["before"] | same["after"]) & same["gap"])
    return (
        valid.groupBy("host", "class").agg(F.bool_or("element").alias("nested"), F.collect_list(F.when(~F.col("element"), F.col("token"))).alias("blocks"))
        .filter("nested").groupBy("host").agg(F.flatten(F.collect_list("blocks")).alias("template"))
    )


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of ``pages``: key, url, text (empty if there is none), n_chars.

    Null and empty pages give an empty text. Hosts with fewer than ``MIN_PAGES`` pages and urls
    without a host have no template. Null keys and repeated rows are pages like others; an
    empty table gives no rows; further columns are ignored.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (key, url)]
    source = _pages(pages, key, url, page)
    rows = source.join(_templates(source), "host", "left").select(*source.columns, "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: str | None = None
        template: frozenset[int] = frozenset()
        for batch in batches:
            texts = []
            for row, (host, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if host != last:
                    last, template = host, frozenset(_list(batch, 4, row))
                texts.append(extract(text or "", template))
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(texts, pa.string()), pa.array(sizes)], [key, url, "text", "n_chars"]
            )

    return rows.mapInArrow(run, f"`{key}` {kinds[0]}, `{url}` {kinds[1]}, text string, n_chars long")
