"""HTML extraction with a site style tree.

The DOMs of a host are merged by path (tag and class from the root down). A path has the style
nodes seen there (the sequences of child tags) and, where it holds text, the contents seen there.
Importance of a path's presentation is the entropy of its style nodes over the host's m pages,
to the base m; importance of a text there is 1 - log n / log m for a text that n of the pages with
that path have (on one page: 1; on every page: 0). Pages of a host with the same contents (paths
and texts) count as one, so copies of a page do not condemn its article. A block's importance mixes
both; few pages say little: PRIOR pages' worth of NEUTRAL is mixed in. What the page says of a block shifts it:

* menus, headers, footers, adverts, forms, scripts and the like: removed, each text by the elements
  that are open where it is read. Names of classes and ids count if all their parts are such words or words of
  layout ("related-posts"); else ("related-work", "menu-prices") they take WRAP;
* a form or an element so named that holds most of the main text (WHOLE of the text
  of the article and main elements, or of a page without them) or is itself an article or main
  element is a wrapper: WRAP less;
* inside an article or main element: MARK more, and paragraphs, headings, list items, quotations and table
  cells without such a name stay whatever the host repeats, as they are the article's own text;
* before it, on a page that has one: MARK less; after the last one (comments, teasers): AFTER less;
* on a page without such an element, or with several that hold less text than the rest (teaser cards): the statistics alone.

Branches below the threshold are removed from each page. The host's tree decides on all that stands outside
(a headline or lead before the article is a page's own and stays) and on bare or oddly named blocks inside.

Pages are dealt into blocks by a hash. A block sends the distinct (path, style) and (path, text)
pairs of its pages with their page counts, packed by a hash of the path, or of path and text, and
gets the host's counts back in the same order. A host with a third of all pages gives one entry
per block and feature, not one per page, and its texts are spread over all groups. Before that,
blocks send the distinct contents of their pages, and the first block of each content is told to
count it; the others send its features with a count of 0. All steps read the same exchange of pages.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import bound_batches, mix64, shuffle_partitions

#: Bytes of html in a block; weight of content against presentation; least importance.
BLOCK, GAMMA, LEAST = 8_000_000, 0.9, 0.4
#: Importance where nothing is known, and the pages that it counts for; what a main element adds inside, takes before
#: and takes after it.
NEUTRAL, PRIOR, MARK, AFTER = 0.6, 2, 0.25, 0.75
#: What a wrapper named like noise takes; share of the main text that makes an element a wrapper.
WRAP, WHOLE = 0.1, 0.75
#: Stands for the pages themselves among a path's styles; the two kinds of entries.
PAGES, STYLES, TEXTS = 0, 0, 1

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|title|textarea|noscript|template|iframe|xmp|noembed|noframes"
BLOCKS = frozenset("""html body p div section article main header footer nav aside ul ol li dl dt dd table thead
    tbody tfoot tr td th caption h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address details summary form
    fieldset hr center menu dialog search""".split())
CLOSES_P = BLOCKS - frozenset(("html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"))
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",), "p": ("p",)}
SCOPES = frozenset("table ul ol dl select body html article section main div td th".split())
NOISE = frozenset("""head nav footer aside button select option label script style noscript template iframe svg
    canvas audio video object menu dialog search input textarea""".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
# Words that name what is not the article, and words of layout that may stand beside them.
NOISE_WORDS = frozenset("""ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promos
    banner banners cookie cookies consent gdpr notice notices newsletter subscribe sidebar side-bar comment comments disqus
    reply replies discussion related recommended share sharing social breadcrumb breadcrumbs pagination pager menu nav navbar
    navigation footer popup modal overlay masthead login signup widget skip-link""".split())
LAYOUT_WORDS = frozenset("""box block wrap wrapper container section area bar list links link buttons button icons widget widgets
    inner outer top bottom left right main primary secondary site page global mobile desktop form slot unit frame panel post posts
    article articles item items row col column group holder js c l u is""".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th caption figcaption".split())
MAIN = frozenset(("article", "main"))
TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)|
    </(?P<end>[a-z][^\s/>]*)[^>]*(?:>|\Z)|<(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""",
                   re.X | re.I | re.S)
ATTR = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""", re.I)


def digest(*parts) -> int:
    return int.from_bytes(xxhash.xxh64_digest("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")),
                          "big", signed=True)


def named_like_noise(words: str) -> int:
    """2: a name of the class or id says that it is not the article; 1: a name has such a word among others; 0: none."""
    level = 0
    for name in words.split():
        parts = [x.lower() for x in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+|[^\x00-\x7f]+", name)]
        if name.lower() in NOISE_WORDS:
            return 2
        if any(x in NOISE_WORDS for x in parts) or "-".join(parts[:2]) in NOISE_WORDS:
            level = max(level, 2 if all(x in NOISE_WORDS or x in LAYOUT_WORDS or x.isdigit() for x in parts) else 1)
    return level


class Page:
    """Elements (path, style) and text blocks (text, path, less, place) of one page, in order. less: what names around
    the block take of its importance; place: INSIDE (with OWN: prose of the article) a main element, BEFORE or PAST the
    main elements. Noise gives no blocks."""

    BEFORE, PAST, INSIDE, OWN = range(4)

    def __init__(self, source: str):
        self.elements: list[tuple[int, int]] = []
        # open elements: tag, path, noise, main, children, elements named like noise around the text
        # (numbered, article and main elements below 0), whether one is named so in part
        self.open: list[tuple[str, int, bool, bool, list[str], tuple, bool]] = [("", 0, False, False, [], (), False)]
        self.named = self.mains = 0
        # texts of a block, the elements named like noise around each (None: noise), named in part
        self.text: list[tuple[str, tuple | None, bool]] = []
        self.read: list[tuple[list, int, bool, bool]] = []
        at = 0
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self._add(source[at:m.start()])
            at = m.end()
            if m["tag"]:
                self._start(m["tag"].lower(), m["attrs"])
            elif m["end"]:
                self._end(m["end"].lower())
        self._add(source[at:])
        self._pop_to(1)
        self._flush()
        self.blocks: list[tuple[str, int, float, int]] = self._blocks()
        own = sum(len(t) for t, _, _, place in self.blocks if place >= self.INSIDE)
        rest = sum(len(t) for t, _, _, place in self.blocks if place < self.INSIDE)
        self.has_main = own > 0 and (self.mains < 2 or own >= rest)

    def _add(self, text: str) -> None:
        _, _, noise, _, _, named, partly = self.open[-1]
        self.text.append((text, None if noise else named, partly))

    def _flush(self) -> None:
        if self.text:
            if any(named is not None for _, named, _ in self.text):
                tag = next((x[0] for x in reversed(self.open) if x[0] in BLOCKS), "")
                self.read.append((self.text, self.open[-1][1], self.open[-1][3], tag in PROSE))
            self.text = []

    def _blocks(self) -> list[tuple[str, int, float, int]]:
        wrappers = self._wrappers() if self.named else frozenset()
        out, last = [], -1
        for texts, path, main, prose in self.read:
            own = [(t, named, partly) if named is not None and wrappers.issuperset(named) else (" ", (), False) for t, named, partly in texts]
            text = " ".join(html.unescape("".join(t for t, _, _ in own)).split())
            if text:
                less = WRAP * (any(named for _, named, _ in own) + any(partly for _, _, partly in own))
                last = len(out) if main else last
                out.append((text, path, less, self.OWN if main and prose and not any(partly for _, _, partly in own) else
                            self.INSIDE if main else self.BEFORE))
        return [(t, p, less, self.PAST if last >= 0 and k > last else place) for k, (t, p, less, place) in enumerate(out)]

    def _wrappers(self) -> set[int]:
        """Elements named like noise that are wrappers."""
        size: Counter = Counter()
        inside: tuple[Counter, Counter] = (Counter(), Counter())
        for texts, _, main, _ in self.read:
            for t, named, _ in texts:
                if named is not None:
                    n = len("".join(t.split()))
                    size[main] += n
                    for k in named:
                        inside[main][k] += n
        main = size[True] > 0
        named = inside[True] + inside[False]
        return {k for k in named if k < 0 or inside[main][k] >= WHOLE * size[main]}

    def _pop_to(self, size: int) -> None:
        while len(self.open) > size:
            tag, path, _, _, children, _, _ = self.open[-1]
            if tag in BLOCKS:
                self._flush()
                self.elements.append((path, digest(*children)))
            self.open.pop()

    def _close(self, tags: tuple[str, ...]) -> None:
        """Close the nearest open element of ``tags`` inside the present scope."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] in tags:
                self._pop_to(k)
                return
            if self.open[k][0] in SCOPES:
                return

    def _start(self, tag: str, attrs: str) -> None:
        if tag in BLOCKS or tag == "option":
            if tag in CLOSES_P:
                self._close(("p",))
            if tag in SAME:
                self._close(SAME[tag])
            self._flush()
        if tag == "br":
            self._add(" ")
        parent = self.open[-1]
        if tag in BLOCKS:
            parent[4].append(tag)
        if tag in VOID:
            return
        names = {}
        if len(attrs) > 1:
            for a, x, y, z, hidden in ATTR.findall(attrs):
                names.setdefault((a or hidden).lower(), x or y or z)
        words = f"{names.get('class', '')} {names.get('id', '')}"
        own_main = tag in MAIN or names.get("role") == "main" or names.get("itemprop") == "articleBody"
        main = parent[3] or own_main
        noise = (parent[2] or tag in NOISE or tag == "header" and not main
                 or names.get("role") in NOISE_ROLES or "hidden" in names or names.get("aria-hidden") == "true"
                 or bool(re.search(r"display\s*:\s*none", names.get("style", ""))))
        self.mains += own_main and not parent[3]
        named, partly = parent[5], parent[6]
        level = named_like_noise(words) if words != " " and tag not in ("html", "body") else 0
        if tag == "form" or level == 2:
            self.named += 1
            named = (*named, -self.named if own_main else self.named)
        partly = partly or level == 1
        path = digest(parent[1], tag, names.get("class", "")) if tag in BLOCKS else parent[1]
        self.open.append((tag, path, noise, main, [], named, partly))

    def _end(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                self._pop_to(k)
                return
            if tag not in BLOCKS and self.open[k][0] in BLOCKS:
                return

    def features(self) -> set[tuple[int, int, int]]:
        """(kind, path, feature): styles and texts of the paths that hold text which may stay."""
        paths = {p for _, p, _, _ in self.blocks}
        out = {(STYLES, p, x) for p, x in self.elements if p in paths} | {(STYLES, p, PAGES) for p in paths}
        return out | {(TEXTS, p, digest(t)) for t, p, _, _ in self.blocks}

    def contents(self) -> int:
        """Paths and texts that may stay, as one number."""
        return digest(*[x for t, p, _, _ in self.blocks for x in (p, t)])

    def main_text(self, importance) -> str:
        """Blocks that stay; ``importance(path, text)`` is what the host's tree says, from 0 to 1."""
        kept = []
        for text, path, less, place in self.blocks:
            value = importance(path, text) - less
            if self.has_main:
                value += {self.BEFORE: -MARK, self.PAST: -AFTER}.get(place, MARK)
                if place == self.OWN:
                    value = 1.0
            if value >= LEAST:
                kept.append(text)
        return "\n\n".join(kept)


def weighed(pages: int, entropy: float, shared: int) -> float:
    """Importance of a text that ``shared`` of the ``pages`` pages with its path have, whose styles have this entropy."""
    known = (1 - GAMMA) * entropy + GAMMA * (1 - math.log(max(1, shared)) / math.log(pages)) if pages > 1 else NEUTRAL
    weight = max(0, pages - 1) / (max(0, pages - 1) + PRIOR)
    return weight * known + (1 - weight) * NEUTRAL


class Entries:
    """The (node, feature) pairs of a block of pages, node = host and path, in a fixed order. Counts
    are of pages with contents in ``counted``, copies of a page once."""

    def __init__(self, rows: pa.Table, groups: int, counted: set[int] = frozenset()):
        self.hosts, self.groups = rows.column("host").to_pylist(), groups
        self.pages = [Page(x) for x in rows.column("html").to_pylist()]
        self.nodes: dict[tuple[str, int], int] = {}
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        left = set(counted)
        for host, page in zip(self.hosts, self.pages):
            own = digest(host, page.contents()) if left else None
            counts = int(own in left)
            left.discard(own)
            for kind, path, feature in page.features():
                seen[kind][self.node(host, path), feature] += counts
        self.seen = []
        for kind in (STYLES, TEXTS):
            keys = np.array(list(seen[kind]), dtype=np.int64).reshape(-1, 2)
            n = np.fromiter(seen[kind].values(), np.int64, len(keys))
            spread = (keys[:, 0] if kind == STYLES else keys[:, 0] * 31 + keys[:, 1]).view(np.uint64)
            group = (mix64(spread) % np.uint64(groups)).astype(np.int64)
            order = np.lexsort((keys[:, 1], keys[:, 0], group))
            self.seen.append((keys[order], n[order], group[order]))

    def node(self, host: str, path: int) -> int:
        known = self.nodes.get((host, path))
        if known is None:
            known = self.nodes[host, path] = digest(host, path)
        return known

    def parts(self):
        """(kind, group, keys, page counts) of each packed row."""
        for kind, (keys, n, group) in enumerate(self.seen):
            cut = np.flatnonzero(np.diff(group, prepend=-1, append=self.groups))
            for x, y in zip(cut[:-1], cut[1:]):
                yield kind, int(group[x]), keys[x:y], n[x:y]


def _contents(rows: pa.Table, groups: int) -> pa.Table:
    """The distinct contents of a block's pages, in one packed row for each group."""
    hosts, sources = rows.column("host").to_pylist(), rows.column("html").to_pylist()
    keys = np.array(sorted({digest(h, Page(x).contents()) for h, x in zip(hosts, sources)}), dtype=np.int64)
    group = (mix64(keys.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
    parts = np.unique(group)
    return pa.table({"block": pa.array([rows.column("block")[0].as_py()] * len(parts), pa.int32()),
                     "part": pa.array(parts, pa.int32()),
                     "keys": pa.array([keys[group == g].tobytes() for g in parts], pa.binary())})


def _first(rows: pa.Table) -> pa.Table:
    """Of each block's contents those that no block before it has."""
    order = np.argsort(rows.column("block").to_numpy(), kind="stable")
    keys = [np.frombuffer(k, np.int64) for k in rows.column("keys").to_pylist()]
    new = np.unique(np.concatenate([keys[k] for k in order]), return_index=True)[1]
    new.sort()
    cut = np.searchsorted(new, np.cumsum([0] + [len(keys[k]) for k in order]))
    every = np.concatenate([keys[k] for k in order])[new]
    return pa.table({"block": rows.column("block").take(pa.array(order)),
                     "keys": pa.array([every[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])], pa.binary())})


def _ask(rows: pa.Table, first: pa.Table, groups: int) -> pa.Table:
    counted = {k for x in first.column("keys").to_pylist() for k in np.frombuffer(x, np.int64).tolist()}
    block, parts = rows.column("block")[0].as_py(), list(Entries(rows, groups, counted).parts())
    return pa.table({"block": pa.array([block] * len(parts), pa.int32()),
                     "kind": pa.array([k for k, _, _, _ in parts], pa.int32()),
                     "part": pa.array([g for _, g, _, _ in parts], pa.int32()),
                     "keys": pa.array([np.ascontiguousarray(k.T).tobytes() for _, _, k, _ in parts], pa.binary()),
                     "pages": pa.array([n.astype(np.uint32).tobytes() for _, _, _, n in parts], pa.binary())})


def _merge(rows: pa.Table) -> pa.Table:
    """One group of one kind over all blocks. Styles: (pages, entropy) of the node of each entry;
    texts: pages of each entry."""
    kind = rows.column("kind")[0].as_py()
    keys = [np.frombuffer(k, np.int64).reshape(2, -1) for k in rows.column("keys").to_pylist()]
    n = np.concatenate([np.frombuffer(x, np.uint32) for x in rows.column("pages").to_pylist()]).astype(np.int64)
    ends = np.cumsum([k.shape[1] for k in keys])
    node, feature = np.concatenate(keys, axis=1)
    order = np.lexsort((feature, node))
    new = np.r_[True, (np.diff(node[order]) != 0) | (np.diff(feature[order]) != 0)]
    pair = np.cumsum(new) - 1
    total = np.bincount(pair, weights=n[order])  # pages of each distinct pair
    back = np.empty(len(n), dtype=np.int64)
    back[order] = pair
    if kind == TEXTS:
        out = [total[back].astype(np.uint32)]
    else:
        at, style = node[order][new], feature[order][new]
        start = np.flatnonzero(np.r_[True, np.diff(at) != 0])
        of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(at)]))
        m = np.bincount(of, weights=np.where(style == PAGES, total, 0))
        own = np.where(style == PAGES, 0, total)  # the styles' share of all styles seen at the node
        share = own / np.maximum(1, np.bincount(of, weights=own))[of]
        bits = np.bincount(of, weights=-share * np.log(np.where(share > 0, share, 1)))
        entropy = np.where(m > 1, np.minimum(1, bits / np.log(np.maximum(m, 2))), 1.0)
        out = [m[of][back].astype(np.uint32), entropy[of][back].astype(np.float32)]
    cut = list(zip(np.r_[0, ends[:-1]], ends))
    return pa.table({"block": rows.column("block"), "kind": rows.column("kind"), "part": rows.column("part"),
                     "counts": pa.array([out[0][x:y].tobytes() for x, y in cut], pa.binary()),
                     "entropy": pa.array([out[-1][x:y].tobytes() if kind == STYLES else b"" for x, y in cut], pa.binary())})


def _extract(rows: pa.Table, replies: pa.Table, groups: int) -> pa.Table:
    e = Entries(rows, groups)
    reply = {(r["kind"], r["part"]): r for r in replies.to_pylist()}
    shown, shared = {}, {}
    for kind, part, keys, _ in e.parts():
        r = reply[kind, part]
        counts = np.frombuffer(r["counts"], np.uint32).tolist()
        if kind == STYLES:
            shown |= {k: x for k, *x in zip(keys[:, 0].tolist(), counts, np.frombuffer(r["entropy"], np.float32).tolist())}
        else:
            shared |= zip(map(tuple, keys.tolist()), counts)
    texts = []
    for host, page in zip(e.hosts, e.pages):
        def importance(path: int, text: str) -> float:
            node = e.node(host, path)
            m, entropy = shown[node]
            return weighed(m, entropy, shared[node, digest(text)])
        texts.append(page.main_text(importance))
    return pa.table({"page_id": rows.column("page_id"), "url": rows.column("url"),
                     "text": pa.array(texts, pa.string())})


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text): the main text of every page; blocks in page order, joined by two line
    feeds, white space inside a block turned into one space, character references decoded.

    A null html is read as empty; a page without main text has text ''. A null or odd url has the
    host ''. Repeated rows give one row each; no pages give no rows; other columns stay behind.
    """
    bound_batches(pages.sparkSession)
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), url.alias("url"),
        F.lower(F.coalesce(F.regexp_extract(url, r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))).alias("host"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    size = rows.agg(F.sum(F.octet_length("html").cast("long"))).first()[0] or 0
    # as many partitions as blocks, however few partitions a shuffle has by default
    blocks = groups = max(shuffle_partitions(pages.sparkSession), -(-size // BLOCK))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    contents = dealt.groupBy("block").applyInArrow(lambda t: _contents(t, groups), "block int, part int, keys binary")
    first = contents.repartition(blocks, "part").groupBy("part").applyInArrow(_first, "block int, keys binary")
    asked = dealt.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(
        lambda t, f: _ask(t, f, groups), "block int, kind int, part int, keys binary, pages binary")
    replies = asked.repartition(blocks, "kind", "part").groupBy("kind", "part").applyInArrow(
        _merge, "block int, kind int, part int, counts binary, entropy binary")
    id_type = rows.schema["page_id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        lambda t, r: _extract(t, r, groups), f"page_id {id_type}, url string, text string")
