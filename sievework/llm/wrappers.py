"""Main-text extraction by wrappers: union-free regular expressions inferred from the pages of a host."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ddl, stage, text_of

# Fixed values of HTML: elements without content, raw-text elements, inline elements, elements that are never main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset("head nav aside form footer button select datalist dialog svg canvas object audio video map menu math fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form note".split())
BOILER_WORDS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside ad ads adv advert adverts advertisement advertising adsbygoogle sponsor "
    "sponsored promo promoted promotion banner cookie cookies consent gdpr notice notices popup modal overlay footer masthead header topbar toolbar comment comments disqus "
    "respond reply replies related recommended share sharing social newsletter subscribe subscription signup login search pagination pager widget toc skip copyright legal tags".split()
)
PREFIXES = frozenset("with has have no without not is for non".split())  # a class such as with-sidebar is not a sidebar
CONTENT_WORDS = frozenset("article articlebody content main post story entry".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"']+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([^\s=/"']+)""")
_WORD = re.compile(r"[a-z]+")


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        name = (m[1] or m[3]).lower()
        out.setdefault(name, unescape((m[2] or "").strip("\"'")))
    return out


class Element:
    """An open element on the stack."""

    __slots__ = ("key", "kids", "link", "name", "never", "path", "region")

    def __init__(self, name: str, raw: str, parent: Element | None):
        self.kids: dict[tuple[str, str], Element] = {}
        a = _attributes(raw) if raw and not raw.isspace() else {}
        marks = f"{a.get('class', '')} {a.get('id', '')}".strip()
        split = [_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()) for token in marks.split()]
        words = {w for token in split for w in token}
        boiler = any(token and token[0] not in PREFIXES and not BOILER_WORDS.isdisjoint(token) for token in split)
        role = a.get("role", "").lower()
        self.name = name
        self.key = f"<{name}.{' '.join(sorted(words))}>" if words else f"<{name}>"
        inside = parent is not None and parent.region
        style = a.get("style", "").replace(" ", "").lower()
        self.never = (
            (parent is not None and parent.never)
            or name in NEVER
            or (name == "header" and not inside)
            or role in ROLES
            or "hidden" in a
            or a.get("aria-hidden", "").lower() == "true"
            or "display:none" in style
            or (name not in ("html", "body", "main") and boiler)
        )
        region = name in ("article", "main") or role in ("main", "article") or a.get("itemprop", "").lower() == "articlebody"
        named = name in ("div", "section", "td") and bool(words) and not CONTENT_WORDS.isdisjoint(words)
        self.region = 0 if self.never else max(parent.region if parent else 0, 2 if region else 1 if named else 0)
        self.link = name == "a" or (parent is not None and parent.link)
        self.path = (parent.path if parent else "") + ("" if name in INLINE else self.key)


_ROOTS: dict[tuple[str, str], Element] = {}
_KNOWN = [0]


def _open(name: str, raw: str, parent: Element | None) -> Element:
    """An element; equal ones below equal parents are built once (they don't change), up to a bound."""
    kids = _ROOTS if parent is None else parent.kids
    found = kids.get((name, raw))
    if found is None:
        found = Element(name, raw, parent)
        if len(raw) <= 60:
            _KNOWN[0] += 1
            if _KNOWN[0] > 50_000:
                _ROOTS.clear()
                _KNOWN[0] = 0
            kids[name, raw] = found
    return found


def tokens(html: str) -> Iterator[tuple[str, str | None, Element | None]]:
    """(kind, text, element): kind '#' for decoded text, else a tag key; inline tags give none but 'br'.
    Unclosed paragraphs and items end where HTML ends them; stray end tags are ignored."""
    stack: list[Element] = []
    opened: Counter[str] = Counter()  # names on the stack
    at, size = 0, len(html)
    while at < size:
        m = _TAG.search(html, at)
        if m is None:
            yield "#", unescape(html[at:]), stack[-1] if stack else None
            return
        if m.start() > at:
            text = html[at : m.start()]
            yield "#", unescape(text) if "&" in text else text, stack[-1] if stack else None
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        name = name.lower()
        if m[1] or m[4]:
            if opened[name]:
                while stack:
                    e = stack.pop()
                    opened[e.name] -= 1
                    if e.name not in INLINE:
                        yield "/" + e.key, None, e
                    if e.name == name:
                        break
            continue
        raw = m[3] if m[2] else m[6]
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if name == "br":
            yield "br", None, stack[-1] if stack else None
        if name in VOID:
            continue
        if name not in INLINE:
            closes = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}.get(name, ())
            for stop in range(len(stack) - 1, -1, -1) if opened["p"] or any(opened[c] for c in closes) else ():
                inner = stack[stop].name
                if inner == "p" or inner in closes:
                    while len(stack) > stop:
                        e = stack.pop()
                        opened[e.name] -= 1
                        if e.name not in INLINE:
                            yield "/" + e.key, None, e
                    if inner == "p":
                        break
                elif inner not in INLINE:
                    break
        stack.append(_open(name, raw.rstrip("/"), stack[-1] if stack else None))
        opened[name] += 1
        if name not in INLINE:
            yield stack[-1].key, None, stack[-1]


def blocks(html: str) -> list[tuple[str, Element | None, int]]:
    """(text, element, characters inside links) of each block: white space folded and trimmed, none empty."""
    out: list[tuple[str, Element | None, int]] = []
    parts: list[str] = []
    owner: Element | None = None
    linked, blank = 0, True
    for kind, text, element in tokens(html):
        if kind == "#":
            if blank:
                owner = element
                blank = not text.strip()
            parts.append(text)
            if element is not None and element.link:
                linked += len(text.strip())
        elif kind == "br":
            parts.append(" ")
        else:
            if folded := " ".join("".join(parts).split()):
                out.append((folded, owner, min(linked, len(folded))))
            parts, linked, blank = [], 0, True
    if folded := " ".join("".join(parts).split()):
        out.append((folded, owner, min(linked, len(folded))))
    return out


# ---- wrappers: ["t", key] a tag, ["x", constant or None, path, chars, linked, pages] a text slot, ["o", items] optional, ["r", items] repeated


def _digest(text: str) -> str:
    return f"{zlib.crc32(text.encode()):08x}{len(text)}"


def _key(item: list) -> str:
    if item[0] == "t":
        return item[1]
    if item[0] == "x":
        return "#"
    return "(" + "".join(map(_key, item[1])) + (")?" if item[0] == "o" else ")+")


def _merge(a: list, b: list, one_page: bool = False) -> list:
    """Two items of equal key: unequal constants become a slot. Pages that show it add up, but for repeats in one page."""
    if a[0] == "t":
        return a
    if a[0] == "x":
        return ["x", a[1] if a[1] == b[1] else None, a[2], a[3] + b[3], a[4] + b[4], max(a[5], b[5]) if one_page else a[5] + b[5]]
    return [a[0], [_merge(x, y, one_page) for x, y in zip(a[1], b[1], strict=True)]]


def fold(items: list[list], longest: int = 16) -> list[list]:
    """Replace runs of an equal block by one repeated group, innermost first, until none is left."""
    while True:
        keys, out, i, changed = [_key(x) for x in items], [], 0, False
        while i < len(items):
            for n in range(1, min(longest, (len(items) - i) // 2) + 1):
                if keys[i] == keys[i + n] and keys[i : i + n] == keys[i + n : i + 2 * n] and (n > 1 or keys[i][-1] not in "+"):
                    body, j = items[i : i + n], i + n
                    while keys[i : i + n] == keys[j : j + n]:
                        body = [_merge(x, y, True) for x, y in zip(body, items[j : j + n], strict=True)]
                        j += n
                    out.append(["r", body])
                    i, changed = j, True
                    break
            else:
                out.append(items[i])
                i += 1
        items = out
        if not changed:
            return items


def _lift(items: list[list], groups: list[list]) -> list[list]:
    """Turn single occurrences of the blocks of `groups` into repeated groups, so that they align."""
    for g in groups:
        body = [_key(x) for x in g[1]]
        n, keys, out, i = len(body), [_key(x) for x in items], [], 0
        whole = _key(g)
        while i < len(items):
            if keys[i : i + n] == body:
                r = ["r", items[i : i + n]]
                i += n
            else:
                r = items[i]
                i += 1
            if out and _key(r) == whole and _key(out[-1]) == whole:
                out[-1] = _merge(out[-1], r, True)
            else:
                out.append(r)
        items = out
    return items


def align(a: list[list], b: list[list]) -> list[list]:
    """The wrapper of two wrappers: equal stretches merge, what only one of them has becomes optional."""
    if [_key(x) for x in a] == [_key(x) for x in b]:
        return [_merge(x, y) for x, y in zip(a, b, strict=True)]
    for _ in range(2):
        a = _lift(a, [x for x in b if x[0] == "r"])
        b = _lift(b, [x for x in a if x[0] == "r"])
    bare = lambda x: _key(x)[:-1] if x[0] == "o" else "(" + _key(x) + ")"
    out: list[list] = []
    for op, i, j, k, m in SequenceMatcher(None, [_key(x) for x in a], [_key(x) for x in b], autojunk=False).get_opcodes():
        if op == "equal":
            out += [_merge(x, y) for x, y in zip(a[i:j], b[k:m], strict=True)]
            continue
        # options that stand on either side meet by their bodies; other stretches become options
        left, right = _options(a[i:j]), _options(b[k:m])
        for x, y in _paired(left, right, bare):
            out.append(x if y is None else y if x is None else _merge(x, y))
    return out


def _options(items: list[list]) -> list[list]:
    out: list[list] = []
    run: list[list] = []
    for x in [*items, None]:
        if x is not None and x[0] != "o":
            run.append(x)
            continue
        if run:
            out.append(["o", run])
            run = []
        if x is not None:
            out.append(x)
    return out


def _paired(left: list[list], right: list[list], bare) -> Iterator[tuple[list | None, list | None]]:
    for op, i, j, k, m in SequenceMatcher(None, [bare(x) for x in left], [bare(x) for x in right], autojunk=False).get_opcodes():
        if op == "equal":
            yield from zip(left[i:j], right[k:m], strict=True)
        else:
            yield from ((x, None) for x in left[i:j])
            yield from ((None, y) for y in right[k:m])


def page_wrapper(html: str) -> list[list]:
    """A page as a wrapper of itself, its repeats folded."""
    items: list[list] = []
    parts: list[str] = []
    linked, path, blank = 0, "", True

    def text() -> None:
        nonlocal parts, linked, blank
        if folded := " ".join("".join(parts).split()):
            items.append(["x", _digest(folded), path, len(folded), min(linked, len(folded)), 1])
        parts, linked, blank = [], 0, True

    for kind, t, element in tokens(html):
        if kind == "#":
            if blank:
                path = "" if element is None else ("!" if element.never else "") + element.path
                blank = not t.strip()
            parts.append(t)
            if element is not None and element.link:
                linked += len(t.strip())
        elif kind == "br":
            parts.append(" ")
        else:
            text()
            items.append(["t", kind])
    text()
    return fold(items)


def slots(items: list[list]) -> Iterator[list]:
    for x in items:
        if x[0] == "x":
            yield x
        elif x[0] in "or":
            yield from slots(x[1])


def container(items: list[list]) -> str:
    """Where the host keeps its text: the path below which slots (not constants) hold the most characters
    outside links, the deepest such path that still holds nine tenths of them."""
    weight: dict[str, int] = {}
    for x in slots(items):
        if x[2][:1] != "!" and x[1] is None:
            steps = re.findall(r"<[^>]*>", x[2])
            for n in range(len(steps) + 1):
                p = "".join(steps[:n])
                weight[p] = weight.get(p, 0) + x[3] - x[4]
    whole = weight.get("", 0)
    good = [p for p, n in weight.items() if whole and n * 10 >= whole * 9 and not p.endswith(("<p>", "<li>", "<h1>", "<h2>", "<b>"))]
    return max(good, key=lambda p: (len(p), p), default="")


def _filled(slot: str, items: list[list]) -> Iterator[tuple]:
    """(slot, constant or None, path, chars, linked, pages) of the text slots of some items."""
    for k, x in enumerate(slots(items)):
        yield f"{slot}/{k}", *x[1:6]


def _named(option: list) -> str:
    return hashlib.sha1(_key(option).encode("utf-8", "surrogatepass")).hexdigest()


def prune(items: list[list], pages: int, most: int = 2000, spilled: list[tuple] | None = None) -> list[list]:
    """A wrapper of more than `most` items gives up options that fewer than one in fifty of its pages showed, and stays
    of bounded size. What their slots held goes to `spilled`, named by the option, and is added up outside."""
    if sum(1 for _ in _flat(items)) <= most:
        return items
    seen = lambda x: max((s[5] for s in slots(x[1])), default=0)
    out = []
    for x in items:
        if x[0] != "o" or 50 * seen(x) >= pages:
            out.append(x)
        elif spilled is not None:
            spilled += _filled(_named(x) + "/0", [x])
    return out


def filled(items: list[list]) -> Iterator[tuple]:
    """The slots of a wrapper: those of an option named by it and by how many like it stand before, so that the first
    adds up with what prune() gave up of the same option; others named by their place."""
    met: Counter[str] = Counter()
    for i, x in enumerate(items):
        if x[0] == "o":
            name = _named(x)
            yield from _filled(f"{name}/{met[name]}", [x])
            met[name] += 1
        else:
            yield from _filled(f"#{i}", [x])


def _flat(items: list[list]) -> Iterator[list]:
    for x in items:
        yield x
        if x[0] in "or":
            yield from _flat(x[1])


def summary(items: list[list], pages: int) -> dict:
    """What extraction needs of a wrapper: where slots hold text, and the constants that most pages show (three in five,
    two at least): text that stands on one page alone is no constant of its host."""
    fixed = sorted({x[1] for x in slots(items) if x[1] is not None and x[5] >= max(2, 0.6 * pages)})
    return {"pages": pages, "container": container(items), "constants": fixed}


def _own(blocks: list[tuple], wrapper: dict | None) -> list[tuple]:
    """The blocks that fill slots of the host's wrapper, without its constants. Constants that make up more than three
    tenths of the text are no frame but the text itself, as on hosts full of copies: then all stay."""
    if not wrapper or wrapper["pages"] < 2:
        return blocks
    fixed = set(wrapper["constants"])
    own = [b for b in blocks if _digest(b[0]) not in fixed]
    whole = sum(len(b[0]) for b in blocks)
    return own if sum(len(b[0]) for b in own) * 10 >= whole * 7 else blocks


def extract(html: str, wrapper: dict | None = None) -> str:
    """Main text of a page: of its blocks outside menus and the like, those that fill the slots of its host's wrapper.

    Marks are evidence on which slots hold the article: all of an article or main element; else elements that a
    class calls content, if they hold most of the text; else the wrapper's text container, without lists of links."""
    found = [b for b in blocks(html) if b[1] is None or not b[1].never]
    if marked := [b for b in found if b[1] is not None and b[1].region >= 2]:
        return " ".join(b[0] for b in _own(marked, wrapper))
    plain = [b for b in found if b[2] * 2 < len(b[0])]
    named = [b for b in found if b[1] is not None and b[1].region >= 1]
    if named and 2 * sum(len(b[0]) for b in named) >= sum(len(b[0]) for b in plain):
        return " ".join(b[0] for b in _own(named, wrapper))
    if wrapper and wrapper["pages"] > 1:
        fixed = set(wrapper["constants"])
        own = [b for b in plain if _digest(b[0]) not in fixed]
        inside = [b for b in own if b[1] is not None and b[1].path.startswith(wrapper["container"])]
        plain = inside or own or plain
    return " ".join(b[0] for b in plain)


_WRAPPER = pa.schema([("host", pa.string()), ("pages", pa.int64()), ("wrapper", pa.string())])
_FILLED = pa.schema([("slot", pa.string()), ("const", pa.string()), ("path", pa.string()), ("chars", pa.int64()), ("linked", pa.int64()), ("shown", pa.int64())])
_PART = pa.schema([*_WRAPPER, *_FILLED])  # a wrapper, or a slot that a wrapper gave up
_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _fold_hosts(rows: Iterable[tuple[str, int, list]], state: dict[str, tuple[int, list]], spilled: list[tuple] | None = None) -> None:
    """Align rows (host, pages, wrapper) into state; (host, slot, ...) of what pruned options held goes to spilled."""
    for host, n, items in rows:
        known = state.get(host)
        if known is not None:
            n, items = known[0] + n, align(known[1], items)
        gone: list[tuple] = []
        state[host] = (n, prune(items, n, spilled=gone))
        if spilled is not None:
            spilled += [(host, *x) for x in gone]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def infer_wrappers(pages: DataFrame, salt: int = 16, held: int = 5_000) -> tuple[DataFrame, DataFrame]:
    """(host, pages, wrapper): each host's pages aligned into one wrapper, all of them; and (host, slot, const, path,
    chars, linked, shown): the slots of the options that prune() took out of them on the way, for their totals.

    Alignment folds like a sum, so tasks first align the pages they read (up to `held` hosts at a time) and
    only wrappers are shuffled: those of a hot host meet in `salt` groups, then in one.
    """

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[str, tuple[int, list]] = {}
        spilled: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500).to_pydict()
                _fold_hosts(((h, 1, page_wrapper(x)) for h, x in zip(rows["host"], rows["html"], strict=True)), state, spilled)
                if len(state) > held:
                    yield dump(state, spilled)
                    state, spilled = {}, []
                elif spilled:
                    yield dump({}, spilled)
                    spilled = []
        if state:
            yield dump(state, spilled)

    def dump(state, spilled):
        return _batch([(h, n, json.dumps(w), *[None] * len(_FILLED)) for h, (n, w) in state.items()] + [(x[0], None, None, *x[1:]) for x in spilled], _PART)

    def join(table: pa.Table) -> pa.Table:
        state: dict[str, tuple[int, list]] = {}
        spilled: list[tuple] = []
        for batch in table.select(["host", "pages", "wrapper"]).to_batches():
            rows = batch.to_pydict()
            _fold_hosts(((h, n, json.loads(w)) for h, n, w in zip(rows["host"], rows["pages"], rows["wrapper"], strict=True)), state, spilled)
        return pa.Table.from_batches([dump(state, spilled)])

    parts = stage(pages.select("host", "html").mapInArrow(local, ddl(_PART)), "wrapper-parts")
    salted = parts.where("wrapper is not null").withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salt)))
    once = stage(salted.groupBy("host", "salt").applyInArrow(join, ddl(_PART)), "wrapper-parts")
    last = stage(once.where("wrapper is not null").groupBy("host").applyInArrow(join, ddl(_PART)), "wrapper-parts")
    spilled = parts.unionByName(once).unionByName(last).where("wrapper is null").select("host", *_FILLED.names)
    return last.where("wrapper is not null").select(*_WRAPPER.names), spilled


def _whole_summaries(wrappers: DataFrame, spilled: DataFrame) -> DataFrame:
    """(w_host, summary) as by summary(), of the hosts whose wrappers gave up options: the slots of both add up."""

    def left(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            for h, w in zip(rows["host"], rows["wrapper"], strict=True):
                yield _batch([(h, *x) for x in filled(json.loads(w))], schema)

    schema = pa.schema([("host", pa.string()), *_FILLED])
    mine = wrappers.join(spilled.select(F.col("host").alias("s_host")).distinct(), F.col("host") == F.col("s_host"), "left_semi")
    each = spilled.unionByName(mine.select("host", "wrapper").mapInArrow(left, ddl(schema)))
    one = (F.count("const") == F.count(F.lit(1))) & (F.min("const") == F.max("const"))
    each = each.groupBy("host", "slot").agg(F.when(one, F.min("const")).alias("const"), F.min("path").alias("path"), F.sum(F.col("chars") - F.col("linked")).alias("n"), F.sum("shown").alias("shown"))
    each = stage(each, "wrapper-slots")
    fixed = each.where("const is not null").join(mine.select(F.col("host").alias("m_host"), "pages"), F.col("host") == F.col("m_host")).where("shown >= greatest(2, 0.6D * pages)")
    fixed = fixed.groupBy(F.col("host").alias("f_host")).agg(F.sort_array(F.collect_set("const")).alias("constants"))
    steps = "regexp_extract_all(path, '<[^>]*>', 0)"
    ways = each.where("const is null and not startswith(path, '!')").select("host", "n", F.explode(F.expr(f"transform(sequence(0, size({steps})), k -> array_join(slice({steps}, 1, k), ''))")).alias("way"))
    ways = ways.groupBy("host", "way").agg(F.sum("n").alias("n"))
    whole = ways.where("way = ''").select(F.col("host").alias("h_host"), F.col("n").alias("whole"))
    ways = ways.join(whole, F.col("host") == F.col("h_host")).where(r"whole <> 0 AND n * 10 >= whole * 9 AND NOT way rlike '<(p|li|h1|h2|b)>$'")
    ways = ways.groupBy(F.col("host").alias("c_host")).agg(F.max(F.struct(F.length("way"), "way"))["way"].alias("container"))
    out = mine.join(fixed, mine.host == fixed.f_host, "left").join(ways, mine.host == ways.c_host, "left")
    told = F.struct("pages", F.coalesce("container", F.lit("")).alias("container"), F.coalesce("constants", F.expr("cast(array() as array<string>)")).alias("constants"))
    return out.select(F.col("host").alias("w_host"), F.to_json(told).alias("summary"))


def host_of(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its main text, '' if it has none.

    Null html: ''. Null url: the host ''. Repeated page_ids: a row each. No rows: none. Wrappers cover all
    pages of a host; a page joins its host's wrapper by a hash join that AQE may split.
    """
    keyed = pages.select("page_id", "url", text_of("html").alias("html"), host_of().alias("host"))

    def summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            out = [json.dumps(summary(json.loads(w), n)) for n, w in zip(rows["pages"], rows["wrapper"], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(rows["host"], pa.string()), pa.array(out, pa.string())], names=["w_host", "summary"])

    inferred, spilled = infer_wrappers(keyed)
    wrappers = inferred.mapInArrow(summaries, "w_host string, summary string")
    if not spilled.isEmpty():
        more = stage(_whole_summaries(inferred, spilled), "wrappers")
        wrappers = wrappers.join(more.select(F.col("w_host").alias("m_host")), F.col("w_host") == F.col("m_host"), "left_anti").unionByName(more)
    wrappers = stage(wrappers, "wrappers")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500).to_pydict()
                texts = [extract(h, s and json.loads(s)) for h, s in zip(rows["html"], rows["summary"], strict=True)]
                cols = rows["page_id"], rows["url"], texts, list(map(len, texts))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _TEXT, strict=True)], schema=_TEXT)

    joined = keyed.join(wrappers, keyed.host == wrappers.w_host, "left")
    return joined.select("page_id", "url", "html", "summary").mapInArrow(run, ddl(_TEXT))
