"""Main text of web pages through wrappers inferred per host.

A wrapper is a regular expression without unions over the tags and texts of a host's pages, kept as a tree: an element, a text, an
optional part or a repeated group.  It begins as the first sample page and is aligned with one page after another:

* equal runs of neighbours fold into a repeated group, whose members are aligned with each other;
* an element on one side only becomes optional;
* a text that differs becomes a slot; one that never differs is part of the template.

Every page of a host takes part: pages of equal skeleton (their folded trees without the texts) merge into one, in tasks first, and all
different skeletons of a host are aligned, in SALTS parts that are then aligned with each other.

Each skeleton then says where its pages' main text is (the ``article``-like element whose slots hold the most text, else the
body); the host's wrapper says what is template: elements whose text is mostly links, and texts that no page (or no page
of a skeleton) changes.  An element with a class or id of MARKS is excluded, unless the page's only article is in it, or most of the text where there
is no article.  Repeated groups of an article whose members each have a person and a date of their own are comments of readers (nested
articles need one of both), on pages with a single member too, since the host's wrapper knows the group.  Every page is read whole; a page
that is all template is read by its own structure.
"""

from __future__ import annotations

import html
import json
import pickle
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import slices

#: how many different pages prove a text outside an article to be template, in a host's wrapper and in a skeleton alone
PROOF, SKELETON_PROOF = 3, 8
#: and one in an article, if it stands on half of the wrapper's pages too
ARTICLE_PROOF = 8
#: parts in which the skeletons of a host are aligned, and the skeletons that a task holds before it sends them on
SALTS, HELD = 64, 4096
#: plans that may be broadcast, in bytes; beyond that pages are joined with them
MAX_PLANS = 32 << 20
#: share of link text from which an element outside an article is a menu
LINKS = 0.6
#: nesting that is kept; deeper elements hang under the last one
MAX_DEPTH = 150
#: cells of an alignment table; longer neighbours are aligned without their order
MAX_CELLS = 250_000

# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {  # an opening tag ends an open element of these, up to the given boundary
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# elements that are never main text
NEVER = frozenset("aside button canvas dialog footer form head iframe math menu nav noembed noframes noscript object script select style svg template textarea title".split())
MAIN = frozenset("article main".split())

# a choice of this module, not fixed by HTML: roles, and words that authors of pages use in a class or id; where they stand in the way of the main
# text, the wrapper overrules them
ROLES = frozenset("alert banner complementary contentinfo dialog form navigation search".split())
MARKS = frozenset(
    "ad ads advert advertisement alert banner breadcrumb breadcrumbs consent cookie cookies disqus footer masthead menu modal nav navbar"
    " navigation newsletter notice pager pagination popup promo promotion related replies share sharing sidebar signup skip social sponsor sponsored subscribe toolbar".split()
)
COMMENT_MARK = re.compile(r"comment(?!ar(?:y|ies))")
PERSON_MARKS = frozenset("author byline commenter nickname poster user username vcard".split())
MAIN_MARKS = frozenset("article content entry main post story".split())
#: share of an article's text that must be outside of its groups of comments, or they are the main text (a forum, say)
OUTSIDE = 0.05

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|$)""", re.I)
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "key", "never", "marked", "main", "kids")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.kids = tag, []
        marks: set[str] = set()
        key = tag
        self.never, self.main = tag in NEVER, tag in MAIN
        self.marked = False  # by its class or id only; the wrapper decides
        if attributes:
            for name, value in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'").lower()
                if name in ("class", "id"):
                    marks.update(_WORD.findall(value))
                    if name == "class":
                        key += "." + ".".join(sorted(set(_WORD.findall(value))))
                elif name == "role":
                    self.never |= value in ROLES
                    self.main |= value == "main"
                else:
                    self.never |= name == "hidden" or value == "true"
            if tag not in ("html", "body", *MAIN):
                self.marked = (bool(marks & MARKS) or any(map(COMMENT_MARK.search, marks))) and not self.never
                self.main |= bool(marks & MAIN_MARKS) and tag in ("div", "section") and not self.never and not self.marked
        self.key = key


def parse(page: str) -> Node:
    """A tree of elements and texts; unclosed and misnested tags end where their container ends."""
    root = Node("html")
    stack, at = [root], 0
    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            break
        if m.start() > at:
            stack[-1].kids.append(page[at : m.start()])
        at = m.end()
        slash, tag, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag not in BLOCKS and stack[i].tag in BLOCKS:
                    break
            continue
        if tag == "html":
            continue
        if tag in BLOCKS:
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCKS:
                    break
        if tag in CLOSES:
            ends, bounds = (x.split() for x in CLOSES[tag])
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in bounds:
                    break
                if stack[i].tag in ends:
                    del stack[i:]
                    break
        if tag == "body" and stack[-1].tag == "head":
            stack.pop()
        node = Node(tag, attributes)
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}", re.I).search(page, at)
            stop = end.start() if end else len(page)
            node.kids.append(page[at:stop])
            at = stop
        if tag not in VOID and len(stack) < MAX_DEPTH:
            stack.append(node)
    if at < len(page):
        stack[-1].kids.append(page[at:])
    return root


# --- wrappers


class Part:
    """A part of a wrapper: an element (or a group, its key in brackets) with parts, or a text (key '#')."""

    __slots__ = ("key", "parts", "text", "always", "optional", "repeated", "never", "marked", "main", "chars", "links", "pages")

    def __init__(self, key, never=False, main=False, marked=False):
        self.key, self.never, self.main, self.marked = key, never, main, marked
        self.parts: list[Part] = []
        self.text: str | int | None = None  # of the template, or its hash; None: a slot (or no text)
        self.always: frozenset[int] = frozenset()  # hashes of the texts that each page with this part has in it
        self.optional = self.repeated = False
        self.chars = self.links = 0  # characters in the sample, and those of them in links
        self.pages = 1


def _tidy(text: str) -> str:
    return " ".join(html.unescape(text).split())


def fold(node: Node, link: bool = False) -> Part:
    """The wrapper of one page: its tree, repeated neighbours folded."""
    part = Part(node.key, node.never, node.main, node.marked)
    parts = []
    for kid in node.kids:
        if isinstance(kid, str):
            text = _tidy(kid) if node.tag not in ("script", "style") else ""
            if not text:
                continue
            p = Part("#")
            p.text, p.chars, p.links = text, len(text), len(text) if link else 0
            p.always = frozenset((xxhash.xxh3_64_intdigest(text),))
        else:
            p = fold(kid, link or kid.tag == "a")
        parts.append(p)
    part.parts = _repeat(parts)
    part.chars, part.links = sum(p.chars for p in parts), sum(p.links for p in parts)
    return part


def _repeat(parts: list[Part]) -> list[Part]:
    """Folds equal neighbours, then equal runs of two to four neighbours."""
    for size in (1, 2, 3, 4):
        out: list[Part] = []
        for p in parts:
            out.append(p)
            if len(out) >= 2 * size and [x.key for x in out[-size:]] == [x.key for x in out[-2 * size : -size]] and (size > 1 or p.key != "#"):
                tail = out[-size:]
                del out[-size:]
                for k, other in enumerate(tail):
                    out[k - size] = align(out[k - size], other, same_page=True)
                    out[k - size].repeated = True
        parts = out
    return parts


def _any_order(parts: list[Part]) -> list[Part]:
    """Very long irregular neighbours as one optional repeated part for each key, by key."""
    by_key: dict[str, Part] = {}
    for p in parts:
        by_key[p.key] = align(by_key[p.key], p, same_page=True) if p.key in by_key else p
        by_key[p.key].optional = by_key[p.key].repeated = True
    return [by_key[k] for k in sorted(by_key)]


def align(a: Part, b: Part, same_page: bool = False) -> Part:
    """One wrapper for both: common parts in order, the others optional, differing texts slots."""
    out = Part(a.key, a.never, a.main, a.marked)
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    out.chars, out.links = a.chars + b.chars, a.links + b.links
    out.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    if a.key == "#":
        out.text = a.text if a.text == b.text else None
        out.always = a.always | b.always if same_page else a.always & b.always
        return out
    x, y = a.parts, b.parts
    if len(x) * len(y) > MAX_CELLS:
        x, y = _any_order(x), _any_order(y)
    # longest common subsequence of keys
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i].key == y[j].key else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i].key == y[j].key:
            out.parts.append(align(x[i], y[j], same_page))
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
            x[i].optional = True
            out.parts.append(x[i])
            i += 1
        else:
            y[j].optional = True
            out.parts.append(y[j])
            j += 1
    return out


def skeleton(part: Part) -> str:
    """The folded tree without its texts."""
    mark = "*" * part.repeated + "?" * part.optional
    return f"#{mark}" if part.key == "#" else f"<{part.key}{mark} {int(part.never)}{int(part.main)}{int(part.marked)}>{''.join(map(skeleton, part.parts))}</>"


def merge(a: Part, b: Part) -> None:
    """Adds a page (or pages) of the same skeleton to ``a``."""
    a.chars, a.links = a.chars + b.chars, a.links + b.links
    if a.key == "#":
        a.text, a.always = a.text if a.text == b.text else None, a.always & b.always
    for x, y in zip(a.parts, b.parts):
        merge(x, y)


def _seen(part: Part, pages: int) -> None:
    part.pages = pages
    for p in part.parts:
        _seen(p, pages)


def _dump(part: Part) -> bytes:
    def flat(p: Part):
        text = xxhash.xxh3_64_intdigest(p.text) if isinstance(p.text, str) else p.text
        return (p.key, p.never, p.main, p.marked, p.optional, p.repeated, p.chars, p.links, p.pages, text, tuple(p.always), [flat(x) for x in p.parts])

    return zlib.compress(pickle.dumps(flat(part), 5), 1)


def _load(raw: bytes) -> Part:
    def build(f) -> Part:
        p = Part(*f[:4])
        p.optional, p.repeated, p.chars, p.links, p.pages, p.text = f[4:10]
        p.always, p.parts = frozenset(f[10]), [build(x) for x in f[11]]
        return p

    return build(pickle.loads(zlib.decompress(raw)))


def infer(pages: list[str]) -> Part | None:
    """The wrapper of some pages; equal pages count once, so that copies prove nothing."""
    wrapper = None
    for page in sorted(set(pages)):
        folded = fold(parse(page))
        wrapper = folded if wrapper is None else align(wrapper, folded)
    return wrapper


def expression(part: Part) -> str:
    """The wrapper as a regular expression, for people."""
    body = "#TEXT" if part.key == "#" and part.text is None else repr(part.text) if part.key == "#" else f"<{part.key}>" + " ".join(map(expression, part.parts)) + "</>"
    return f"( {body} )" + ("*" if part.optional else "+") if part.repeated else f"( {body} )?" if part.optional else body


def _slot_chars(part: Part, different: int, shut: frozenset = frozenset()) -> int:
    """Characters of a part that are no template and not excluded."""
    if part.key == "#":
        return 0 if part.text is not None and different >= PROOF and part.pages >= PROOF else part.chars
    return 0 if part.never or part in shut else sum(_slot_chars(p, different, shut) for p in part.parts)


def _has_article(part: Part) -> bool:
    return not part.never and ((part.main and part.chars > 0) or any(_has_article(p) for p in part.parts))


def _unmarked_chars(part: Part) -> int:
    return part.chars if part.key == "#" else sum(_unmarked_chars(p) for p in part.parts if not (p.never or p.marked))


def _shut(wrapper: Part, different: int) -> frozenset:
    """The marked parts that are excluded: all but those with the page's only article-like parts or, without any such, most of its slot text."""
    marked: list[Part] = []
    todo, article = [wrapper], False
    while todo:  # the outermost marked parts, and whether an article is outside of them
        part = todo.pop()
        if part.marked:
            marked.append(part)
        elif not part.never and part.key != "#":
            chars = _unmarked_chars(part) if part.main else 0  # of a container only a title may be outside
            article |= chars > 0 and (part.key.split(".")[0] == "article" or 10 * chars >= part.chars)
            todo += part.parts
    if not marked or article:
        return frozenset(marked)
    chars = _slot_chars(wrapper, different)
    keep = [p for p in marked if not p.never and _has_article(p)]
    keep = keep or [p for p in marked if 2 * _slot_chars(p, different) > chars and p.links < LINKS * p.chars]
    out = set(marked).difference(keep)
    for part in keep:
        part.marked = False
        try:
            out |= _shut(part, different)
        finally:
            part.marked = True
    return frozenset(out)


def _has_slot(part: Part) -> bool:
    return part.text is None and part.chars > 0 if part.key == "#" else any(map(_has_slot, part.parts))


def _own(part: Part, kind) -> int:
    """Characters of the first element of a kind that every member of a group has, with a text of its own."""
    for p in part.parts:
        if p.optional or p.key == "#":
            continue
        if chars := (p.chars if kind(p.key.split(".")) and _has_slot(p) else _own(p, kind)):
            return chars
    return 0


def _by_readers(part: Part, nested: bool) -> bool:
    """Whether a part is a group whose members each name their own person and date (a nested article: one of both) beside other text."""
    if not part.repeated or part.key == "#":
        return False
    person = _own(part, lambda key: key[0] == "address" or not PERSON_MARKS.isdisjoint(key[1:]))
    date = _own(part, lambda key: key[0] == "time")
    enough = (person and date) or (nested and part.key.split(".")[0] == "article" and (person or date))
    return bool(enough) and part.chars > person + date


def _prose(part: Part, without: set) -> int:
    """Characters outside of headings, of excluded elements and of some parts."""
    if part.key == "#":
        return part.chars
    return 0 if part.never or part in without or part.key.split(".")[0] in HEADINGS else sum(_prose(p, without) for p in part.parts)


def _comments(part: Part, nested: bool = False, inside: bool = False) -> set:
    """The groups of readers' comments in article-like elements, each with the container that holds but headings and forms beside it."""
    tag = part.key.split(".")[0]
    nested, inside = nested or tag == "article", inside or part.main
    found: set = set()
    for p in part.parts:
        if p.never or p.key == "#":
            continue
        found |= {p} if inside and _by_readers(p, nested) else _comments(p, nested, inside)
    if found and part.main:
        rest = _prose(part, found)
        return found if rest and rest >= OUTSIDE * part.chars else set()
    if found and not _prose(part, found):
        return {part}
    return found


def _refused(part: Part, groups: frozenset, path: str) -> tuple[dict, set]:
    """(parts at the paths ``groups``, and those of the paths beside which an article-like element of this page has no prose: there
    they are its main text)."""
    found, refused = {}, set()
    for p in part.parts:
        where = f"{path}/{p.key}"
        if where in groups:
            found[p] = where
        elif p.key != "#" and not p.never:
            more, no = _refused(p, groups, where)
            found, refused = found | more, refused | no
    if found and part.main and not _prose(part, set(found)):
        return {}, refused.union(found.values())
    return found, refused


def _mark(path: str, text: int) -> int:
    """A text at a path, as one number."""
    return xxhash.xxh3_64_intdigest(f"{path}\0{text}")


def plan(wrapper: Part, different: int, proof: int = PROOF) -> dict:
    """Where the main text is (a path of keys, or none), which paths are menus or comments, and which texts at which paths are template."""
    best, best_chars, drop, texts = None, 0, [], set()
    comments = _comments(wrapper)
    shut, opened, groups = _shut(wrapper, different) | comments, [], []
    stack = [(wrapper, (wrapper.key,), False)]
    while stack:
        part, path, inside = stack.pop()
        if part in comments:
            groups.append("/".join(path))
        if part.never or part in shut or part.key == "#":
            continue
        if part.marked:
            opened.append("/".join(path))
        if part.main and not inside:
            chars = _slot_chars(part, different, shut)
            # an article in a main element is the nearer one
            inner = [p for p in part.parts if p.key.split(".")[0] == "article" and _slot_chars(p, different, shut) * 2 > chars]
            if not inner and chars > best_chars:
                best, best_chars = path, chars
            inside = not inner
        elif not inside and len(path) > 2 and part.chars and part.links >= LINKS * part.chars:
            drop.append("/".join(path))
        # in an article a wrong proof loses main text: more pages, and most of the wrapper's
        least = max(proof, ARTICLE_PROOF, different / 2) if inside else proof
        texts.update(_mark("/".join(path), t) for p in part.parts if p.key == "#" and min(different, p.pages) >= least for t in p.always)
        stack += [(p, (*path, p.key), inside) for p in part.parts]
    return {"main": "/".join(best) if best else None, "open": sorted(set(opened)), "drop": sorted(set(drop)), "texts": sorted(texts), "comments": sorted(set(groups))}


def _choices(part: Part) -> int:
    """Elements of a wrapper that may hold the main text, and marked ones."""
    return 0 if part.never else part.main + part.marked + sum(_choices(p) for p in part.parts)


# --- extraction


def _blocks(node: Node, path: str, drop: frozenset, inside: bool, texts: frozenset = frozenset(), opened: frozenset = frozenset()) -> list[str]:
    """Texts of the blocks under a node, in page order, without the menus ``drop`` and the template's ``texts``."""
    out: list[str] = []
    held: list[str] = []

    def flush():
        text = _tidy("".join(held))
        if text:
            out.append(text)
        held.clear()

    todo: list = [(node, path)]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
            continue
        at, where = item
        if isinstance(at, str):
            if not (texts and (text := _tidy(at)) and _mark(where, xxhash.xxh3_64_intdigest(text)) in texts):
                held.append(at)
            continue
        if at.tag == "br":
            held.append(" ")
            continue
        if at.never or (at.marked and where not in opened) or (at.tag == "header" and not inside) or where in drop:
            flush() if at.tag in BLOCKS else None
            continue
        block = at.tag in BLOCKS
        if block:
            flush()
            todo.append(None)
        todo += [(kid, f"{where}/{kid.key}" if not isinstance(kid, str) else where) for kid in reversed(at.kids)]
    flush()
    return out


def _find(root: Node, path: list[str], opened: frozenset) -> list[Node]:
    """Elements at a path, not in excluded ones, in page order."""
    level, where = [root], path[0]
    for key in path[1:]:
        where = f"{where}/{key}"
        level = [k for n in level for k in n.kids if not isinstance(k, str) and k.key == key and not k.never and (not k.marked or where in opened)]
    return level


def extract(page: str | None, how: dict | None) -> str:
    """Main text of one page by the plan of its host and skeleton, or by its own structure where that finds nothing."""
    if not page:
        return ""
    root = parse(page)
    folded = fold(root)
    own, how = plan(folded, 1), how or {}
    mains = how.get("mains")
    mine = (mains.get(str(xxhash.xxh3_64_intdigest(skeleton(folded)))) if mains else None) or own
    choices = [(c["main"], frozenset(c["open"])) for c in ((mine, own) if mine is not own else (own,))]
    template, comments = frozenset(how.get("texts", ())), frozenset(own["comments"]).union(how.get("comments", ()))
    if comments:
        comments -= _refused(folded, comments, folded.key)[1]
    # a page that is all template, or all comments, is read with them
    tries = [(template, comments), (frozenset(), comments), (frozenset(), frozenset())]
    for texts, groups in dict.fromkeys(tries):
        for path, opened in choices:
            found = [b for n in _find(root, path.split("/"), opened) for b in _blocks(n, path, groups, True, texts, opened)] if path else []
            if found:
                return "\n\n".join(found)
        drop = groups.union(own["drop"]) | frozenset(how.get("drop", ()) if not mine["main"] else ())
        found = _blocks(root, root.key, drop, False, texts, choices[0][1])
        if found:
            break
    return "\n\n".join(found)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Runs of rows of equal keys, of batches sorted by them."""
    from itertools import groupby

    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, key=lambda row: tuple(row[k] for k in keys))


def _plans(rows: DataFrame) -> DataFrame:
    """(host, plan): the template of every host by all its pages, and the main path of each skeleton with several choices."""

    def fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}

        def send():
            keys, values = list(held), list(held.values())
            out = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64())]
            out += [pa.array([_dump(v[0]) for v in values], pa.binary()), pa.array([sorted(v[1]) for v in values], pa.list_(pa.int64()))]
            held.clear()
            return pa.RecordBatch.from_arrays(out, ["host", "skeleton", "part", "seen"])

        for batch in slices(batches, "html"):
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                if not page:
                    continue
                part = fold(parse(page))
                key = host, _signed(xxhash.xxh3_64_intdigest(skeleton(part)))
                name = _signed(xxhash.xxh3_64_intdigest(page))
                if key not in held:
                    held[key] = [part, {name}]
                elif name not in held[key][1]:  # copies prove nothing
                    merge(held[key][0], part)
                    held[key][1] = set(sorted(held[key][1] | {name})[:SKELETON_PROOF])
                if len(held) >= HELD:
                    yield send()
        if held:
            yield send()

    def merge_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (host, name), group in _grouped(batches, ["host", "skeleton"]):
            part, seen = None, set()
            for row in group:
                other = _load(row["part"])
                merge(part, other) if part else None
                part, seen = part or other, set(sorted(seen | set(row["seen"]))[:SKELETON_PROOF])
            _seen(part, len(seen))
            how = plan(part, len(seen), SKELETON_PROOF)
            more = {"mains": {str(name % (1 << 64)): {"main": how["main"], "open": how["open"]}} if (how["main"] or how["open"]) and _choices(part) > 1 else {}, "texts": how["texts"], "comments": how["comments"]}
            yield pa.RecordBatch.from_pylist([{"host": host, "skeleton": name, "part": _dump(part), "more": json.dumps(more)}], _ALIGNED)

    def align_all(batches: Iterator[pa.RecordBatch], keys: list[str], last: bool) -> Iterator[pa.RecordBatch]:
        for (host, *_), group in _grouped(batches, keys):
            wrapper, mains, texts, groups, first = None, {}, set(), set(), 0
            for row in group:
                other = _load(row["part"])
                wrapper, first = (align(wrapper, other), first) if wrapper else (other, row["skeleton"])
                more = json.loads(row["more"])
                mains |= more["mains"]
                texts.update(more["texts"])
                groups.update(more["comments"])
            if last:
                how = plan(wrapper, wrapper.pages)
                yield pa.RecordBatch.from_pylist([{"host": host, "plan": json.dumps({"drop": how["drop"], "texts": sorted(texts.union(how["texts"])), "comments": sorted(groups.union(how["comments"])), "mains": mains})}])
            else:
                yield pa.RecordBatch.from_pylist([{"host": host, "skeleton": first, "part": _dump(wrapper), "more": json.dumps({"mains": mains, "texts": sorted(texts), "comments": sorted(groups)})}], _ALIGNED)

    kinds = "host string, skeleton long, part binary, more string"
    folded = rows.select("host", "html").mapInArrow(fold_pages, "host string, skeleton long, part binary, seen array<long>")
    equal = folded.repartition("host", "skeleton").sortWithinPartitions("host", "skeleton", "seen").mapInArrow(merge_equal, kinds)
    salted = equal.withColumn("salt", F.pmod("skeleton", F.lit(SALTS))).repartition("host", "salt").sortWithinPartitions("host", "salt", "skeleton")
    parts = salted.mapInArrow(lambda batches: align_all(batches, ["host", "salt"], False), kinds)
    return parts.repartition("host").sortWithinPartitions("host", "skeleton").mapInArrow(lambda batches: align_all(batches, ["host"], True), "host string, plan string")


def _signed(name: int) -> int:
    return name - (1 << 64) if name >> 63 else name


_ALIGNED = pa.schema([("host", pa.string()), ("skeleton", pa.int64()), ("part", pa.binary()), ("more", pa.string())])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row: blocks joined by two line feeds, white space in a block made one space.

    Null or empty pages have the empty text.  A URL without a host (null too) shares one wrapper with its like.  Repeated rows stay
    and prove nothing; an empty table gives an empty result; other columns are ignored.  Elements are never cut
    short; nesting deeper than 150 is read as if it ended there.
    """
    spark = pages.sparkSession
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col).cast("string"), r"://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"), host.alias("host"))
    plans = materialize(_plans(rows))
    schema = f"id {pages.schema[id_col].dataType.simpleString()}, url {pages.schema[url_col].dataType.simpleString()}, text string, n_chars long"
    small = (plans.agg(F.sum(F.octet_length("host") + F.octet_length("plan"))).first()[0] or 0) <= MAX_PLANS
    shared = spark.sparkContext.broadcast(dict(plans.collect()) if small else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, dict] = {}
        for batch in slices(batches, "html"):
            hosts = batch.column("host").to_pylist()
            given = batch.column("plan").to_pylist() if "plan" in batch.schema.names else [shared.value.get(h) for h in hosts]
            texts = []
            for page, raw in zip(batch.column("html").to_pylist(), given):
                if raw is not None and raw not in read:
                    how = json.loads(raw)
                    read[raw] = how | {"texts": frozenset(how["texts"])}
                texts.append(extract(page, read.get(raw)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"]
            )

    with_plans = rows.select("id", "url", "html", "host") if small else rows.select("id", "url", "html", "host").join(plans, "host", "left")
    return with_plans.mapInArrow(run, schema).withColumnsRenamed({"id": id_col, "url": url_col})
