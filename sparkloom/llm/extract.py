"""Main text of web pages: wrappers inferred per host by aligning token streams, then applied to every page."""

import hashlib
import html
import json
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkloom.llm.url_filter import host_of
from sparkloom.operators.scale import byte_size, cut_lineage, hinted, lookup_join

# A container or tag is part of a host's template if it stands on at least one in this many of the host's pages, all of them counted.
TEMPLATE_PART = 8
# Structures that one task aligns; more of a host are aligned in groups of about this size, then the results.
ALIGNED = 64
# A container's text is fixed if it stands on that many pages with different main texts, and on this share of those that have the container.
FIXED_PAGES, FIXED_SHARE = 8, 0.5
# Groups up to this length are tried one by one as repetitions, longer ones where that many keys in a row recur at their distance.
_SHORT_GROUP = 24
# Tags and texts of distinct structures that a scan task holds before it sends them on.
_HELD = 200_000
# Bits of the alignment of two streams that are held at once (32 MB); longer streams are halved.
_IN_MEMORY = 1 << 28
# Containers nested deeper than this have no path; they are like the one around them.
_DEEPEST = 100
# Wrappers are broadcast up to this many bytes in all.
BROADCAST_BYTES = 16 << 20

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*|[^>]*)>""", re.DOTALL)
_NAMED = re.compile(r"""(?i)\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_RAW = {t: re.compile(rf"</{t}\s*>?", re.IGNORECASE) for t in ("script", "style", "title", "textarea", "noscript", "iframe", "template", "svg", "select", "button", "head")}

# Elements with an inside of their own; others (p, li, b, ...) may stay open and do not nest here.
_CONTAINERS = frozenset("body div section article main nav header footer aside form ul ol dl table tbody tr td figure blockquote fieldset dialog details menu".split())
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr th thead tfoot caption figcaption address center summary legend option".split())
_LEFT_OUT = frozenset("nav header footer aside form menu dialog".split())
_LEFT_OUT_NAMES = re.compile(
    r"(?i)(?:^|[-_\s])(?:ads?|advert\w*|adsense|banner|sidebar|navbar|nav|navigation|menu|header|masthead|footer|contentinfo|complementary|cookies?|consent|notices?|alert|comments?|respond|replies|"
    r"related|share|sharing|social|promo\w*|sponsor\w*|newsletter|subscribe|signup|login|search|breadcrumbs?|popup|modal|widget|toolbar|skip)(?:$|[-_\s])"
)
_ROOTS = ("article", "main", "role=main")
# Containers that are parts of a text, and the share of the text that an inferred root has to hold.
_PARTS = frozenset("section ul ol dl table tbody tr td figure blockquote details".split())
_NEARLY_ALL = 0.9


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """Stream of ``(kind, name, value)``: ``open`` and ``close`` tags, ``text`` runs; what holds no readable text is skipped.

    The name of a tag is its element with class, id and role; a text's value is still encoded.
    """
    at, end = 0, len(page)
    last = page.rfind(">")
    while at < end:
        if at > last:  # no tag can end any more; what is left is text up to a comment
            opened = page.find("<!--", at)
            yield "text", "#", page[at : opened if opened >= 0 else end]
            return
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            yield "text", "#", page[at:stop]
        if not m:
            return
        at = m.end()
        if not m[2]:
            continue
        element = m[2].lower()
        if m[1]:
            yield "close", element, ""
            continue
        if element in _RAW:
            closing = _RAW[element].search(page, at)
            at = closing.end() if closing else end
            continue
        named = "".join(f" {k.lower()}={(a or b or c).strip()}" for k, a, b, c in _NAMED.findall(m[3])) if m[3] else ""
        yield "open", element + named, ""


def left_out(name: str) -> bool:
    """Whether a container is a menu, header, footer, side bar, notice, advert, form or comments."""
    element, _, named = name.partition(" ")
    return element in _LEFT_OUT or bool(named) and any(_LEFT_OUT_NAMES.search(part.partition("=")[2]) for part in re.split(r" (?=class=|id=|role=)", named))


def _is_root(name: str, root: str) -> bool:
    """``article`` and ``main`` by element, ``role=main`` by role; never what is left out."""
    found = f" {root}" in name if "=" in root else name.partition(" ")[0] == root
    return found and not left_out(name)


# --- wrapper inference ---

Node = list  # ["<p>"], ["#", its text or a hash of several, None where they vary between pages, size], ["+", nodes, key], ["?", nodes, key]


def _key(node: Node) -> str:
    return node[2] if node[0] in "+?" else node[0]


def _group(kind: str, nodes: list[Node]) -> Node:
    return [kind, nodes, kind + "(" + "".join(map(_key, nodes)) + ")"]


def stream(page: str) -> list[Node]:
    """Tags and texts of a page as nodes; blank texts are left out."""
    out: list[Node] = []
    for kind, name, value in tokens(page):
        if kind == "text":
            value = " ".join(html.unescape(value).split())
            if value:
                out.append(["#", (value,), len(value)])
        else:
            out.append([f"<{name}>" if kind == "open" else f"</{name}>"])
    return out


def _merge(a: Node, b: Node, same_page: bool) -> Node:
    """Two equal nodes as one; of one page they keep a hash of all their texts, of two pages only what is the same."""
    if a[0] == "#":
        if same_page:
            texts = None if a[1] is None or b[1] is None else ("", _hash(a[1], b[1]))
        else:
            texts = a[1] if a[1] == b[1] else None
        return ["#", texts, a[2] + b[2]]
    return [a[0], [_merge(x, y, same_page) for x, y in zip(a[1], b[1])], a[2]] if a[0] in "+?" else a


def fold(nodes: list[Node]) -> list[Node]:
    """Neighbouring equal groups become one repeated group, short groups first, until nothing repeats."""
    size, keys = 1, [_key(n) for n in nodes]
    while size <= len(nodes) // 2:
        if sum(map(eq, keys, keys[size:])) < size:  # too few keys recur at this distance
            size = _next_size(nodes, size)
            continue
        out: list[Node] = []
        at, changed = 0, False
        while at < len(nodes):
            count = 1
            while keys[at : at + size] == keys[at + count * size : at + (count + 1) * size] and at + size <= len(nodes):
                count += 1
            if count > 1 and not (size == 1 and keys[at] == "#"):
                group = nodes[at : at + size]
                for k in range(1, count):
                    group = [_merge(x, y, True) for x, y in zip(group, nodes[at + k * size : at + (k + 1) * size])]
                out.append(group[0] if size == 1 and group[0][0] == "+" else _group("+", group))
                at += count * size
                changed = True
            else:
                out.append(nodes[at])
                at += 1
        nodes, keys = out, [_key(n) for n in out]
        size = 1 if changed else _next_size(nodes, size)
    return nodes


def _next_size(nodes: list[Node], size: int) -> int:
    """The next length of group that can repeat somewhere."""
    if size < _SHORT_GROUP:
        return size + 1
    numbers: dict[str, int] = {}
    keys = np.array([numbers.setdefault(_key(n), len(numbers)) for n in nodes], np.int32)
    for k in range(size + 1, len(nodes) // 2 + 1):
        same = keys[:-k] == keys[k:]
        if np.count_nonzero(same) >= k:
            sums = np.concatenate(([0], np.cumsum(same)))
            if (sums[k:] - sums[:-k]).max() == k:
                return k
    return len(nodes)


def _absorb(nodes: list[Node], groups: dict[str, list[str]]) -> list[Node]:
    """Single occurrences of groups that repeat on another page become repeated groups too."""
    for inside in groups.values():
        out, at, size = [], 0, len(inside)
        keys = [_key(n) for n in nodes]
        while at < len(nodes):
            if keys[at] == inside[0] and keys[at : at + size] == inside:
                out.append(_group("+", nodes[at : at + size]))
                at += size
            else:
                out.append(nodes[at])
                at += 1
        nodes = out
    return nodes


def _flat(nodes: list[Node]) -> tuple[list[Node], list[bool]]:
    """Nodes with optional groups opened, and whether each was in one."""
    opened = [(x, n[0] == "?") for n in nodes for x in (n[1] if n[0] == "?" else [n])]
    return [x for x, _ in opened], [optional for _, optional in opened]


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """Generalise two streams: differing texts become slots, unmatched stretches optional groups."""
    repeated = {_key(n): [_key(x) for x in n[1]] for n in (*a, *b) if n[0] == "+"}
    a, b = fold(_absorb(a, repeated)), fold(_absorb(b, repeated))
    (a, optional), (b, absent) = _flat(a), _flat(b)
    out: list[Node] = []

    def add(nodes: list[Node], is_optional: bool) -> None:
        if nodes and is_optional and out and out[-1][0] == "?":
            out[-1] = _group("?", out[-1][1] + nodes)
        elif nodes:
            out.extend([_group("?", nodes)] if is_optional else nodes)

    for what, i, j, k, m in _steps([_key(n) for n in a], [_key(n) for n in b]):
        if what == "equal":
            for x, y, one, other in zip(a[i:j], b[k:m], optional[i:j], absent[k:m]):
                add([_merge(x, y, False)], one or other)
        else:
            add(a[i:j], True)
            add(b[k:m], True)
    return out


def _rows(a: list[str], b: list[str]) -> Iterator[int]:
    """After each key of ``a`` the places of ``b`` as bits: 0 where one more key is in common than up to the place before."""
    places: dict[str, int] = defaultdict(int)
    for k, key in enumerate(b):
        places[key] |= 1 << k
    full = (1 << len(b)) - 1
    row = full
    for key in a:
        at = row & places.get(key, 0)
        row = ((row + at) | (row - at)) & full
        yield row


def _common(a: list[str], b: list[str]) -> list[int]:
    """Length of the longest common subsequence of ``a`` and every prefix of ``b``, the empty one first."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return [0, *np.cumsum(1 - bits.astype(np.int64)).tolist()]


def _matched(a: list[str], b: list[str], in_memory: int = _IN_MEMORY) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two lists of keys, of any length.

    Long lists are halved (Hirschberg), so that memory stays in bounds; the length found is the same.
    """
    if len(a) > 1 and len(a) * len(b) > in_memory:
        i = len(a) // 2
        up, down = _common(a[:i], b), _common(a[:i - 1 : -1], b[::-1])[::-1]
        j = max(range(len(b) + 1), key=lambda k: up[k] + down[k])
        return _matched(a[:i], b[:j], in_memory) + [(x + i, y + j) for x, y in _matched(a[i:], b[j:], in_memory)]
    rows = [*_rows(a, b)]
    i, j, out = len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            j -= 1
            out.append((i, j))
    return out[::-1]


def _steps(a: list[str], b: list[str]) -> list[tuple[str, int, int, int, int]]:
    """How to get from one list of keys to the other, keeping a longest common subsequence."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    middle = [(i + head, j + head) for i, j in _matched(a[head : len(a) - tail], b[head : len(b) - tail])]
    out: list[tuple[str, int, int, int, int]] = [("equal", 0, head, 0, head)]
    i = j = head
    for x, y in [*middle, (len(a) - tail, len(b) - tail)]:
        if x > i or y > j:
            out.append(("replace", i, x, j, y))
        if x < len(a) - tail:
            out.append(("equal", x, x + 1, y, y + 1))
        i, j = x + 1, y + 1
    return [*out, ("equal", len(a) - tail, len(a), len(b) - tail, len(b))]


def infer(pages: list[str]) -> list[Node]:
    """Wrapper of pages of one host: a union-free expression that fits all of them."""
    wrapper: list[Node] = []
    for k, page in enumerate(pages):
        nodes = fold(stream(page))
        wrapper = nodes if k == 0 else align(wrapper, nodes)
    return wrapper


def expression(nodes: list[Node]) -> str:
    """The wrapper as a regular expression over tags: ``#`` is a slot, fixed texts stand in quotes."""
    parts = []
    for n in nodes:
        if n[0] == "#":
            parts.append("#" if n[1] is None or len(n[1]) > 1 else json.dumps(n[1][0], ensure_ascii=False))
        else:
            parts.append(n[0] if n[0] not in "+?" else f"({expression(n[1])}){n[0]}")
    return "".join(parts)


def _events(nodes: list[Node], optional: bool = False) -> Iterator[tuple[str, str, Node]]:
    """The wrapper's tags and texts in order, groups opened; texts in optional groups vary, as not all pages have them."""
    for n in nodes:
        if n[0] in "+?":
            yield from _events(n[1], optional or n[0] == "?")
        elif n[0] == "#":
            yield "text", "#", ["#", None, n[2]] if optional else n
        elif n[0].startswith("</"):
            yield "close", n[0][2:-1], n
        else:
            yield "open", n[0][1:-1], n


def _nested(events: Iterator[tuple]) -> Iterator[tuple]:
    """Each event with the names of the containers that are open at it."""
    stack: list[str] = []
    opened: Counter[str] = Counter()
    for kind, name, value in events:
        element = name.partition(" ")[0]
        if kind == "open" and element in _CONTAINERS:
            stack.append(name)
            opened[element] += 1
        elif kind == "close" and opened[element]:
            last = ""
            while last != element:
                last = stack.pop().partition(" ")[0]
                opened[last] -= 1
        yield kind, name, value, stack


def _root_path(nodes: list[Node]) -> tuple[tuple[str, ...], frozenset[tuple[str, ...]]]:
    """Path of the container that holds the page's own text where neither ``article`` nor ``main`` is, and paths in it to leave out.

    From the page inwards, a container is entered while it holds nearly all of the text in slots, that is in texts
    that vary between pages, and nothing of it stands right beside it; where nothing varies, all texts count. Lists,
    tables and sections are parts of the text around them, never the root. If the root is the whole page, containers
    that hold the same on all pages are left out.
    """
    slots, texts = Counter(), Counter()
    for kind, _, node, stack in _nested(_events(nodes)):
        if kind == "text" and not any(map(left_out, stack)):
            inner = tuple(stack[:_DEEPEST])
            slots[inner] += node[2] if node[1] is None else 0
            texts[inner] += node[2]
    right_inside = slots if any(slots.values()) else texts
    below, inside = Counter(), defaultdict(set)
    for path, size in right_inside.items():
        for k in range(len(path) + 1):
            below[path[:k]] += size
        for k in range(len(path)):
            inside[path[:k]].add(path[: k + 1])
    root: tuple[str, ...] = ()
    while inside[root] and not right_inside[root]:
        most = max(sorted(inside[root]), key=lambda path: below[path])
        if most[-1].partition(" ")[0] in _PARTS or below[most] < _NEARLY_ALL * below[root]:
            break
        root = most
    whole_page = not root or root[-1].partition(" ")[0] == "body"
    return root, frozenset(path for path, size in below.items() if whole_page and len(path) > len(root) and not size)


def _marked_root(nodes: list[Node]) -> str:
    """The first of ``article``, ``main`` and ``role=main`` that the wrapper has, else nothing."""
    names = {name for kind, name, _ in _events(nodes) if kind == "open"}
    return next((root for root in _ROOTS if any(_is_root(n, root) for n in names)), "")


def content_root(nodes: list[Node]) -> str:
    """Name of the container that holds the page's own text: ``article``, else ``main``; else the one that ``_root_path`` finds."""
    marked = _marked_root(nodes)
    return marked or (_root_path(nodes)[0] or ("",))[-1]


def content_paths(nodes: list[Node], marked: str | None = None) -> dict[str, bool]:
    """What the wrapper says of every container path in it: whether texts right inside are main text.

    ``marked`` is the kind of root that the wrapper's pages have, where that is known.
    """
    marked = _marked_root(nodes) if marked is None else marked
    root, same = ((), frozenset()) if marked else _root_path(nodes)
    found = {"": not marked and not root}

    def held(stack: list[str]) -> bool:
        if marked:
            return any(_is_root(n, marked) for n in stack)
        # A container without class, id or role is known by its place only.
        within = tuple(stack[: len(root)]) == root or (" " in root[-1] and root[-1] in stack)
        return within and not any(tuple(stack[:k]) in same for k in range(len(root) + 1, len(stack) + 1))

    for kind, _, _, stack in _nested(_events(nodes)):
        if kind == "open" and 0 < len(stack) <= _DEEPEST:
            path = "".join(f" > {n}" for n in stack)
            if path not in found:
                found[path] = not any(map(left_out, stack)) and held(stack)
    return found


# --- what all pages of a host have in common ---


def _placed(nodes: list[Node]) -> Iterator[tuple[Node, int, bool]]:
    """Each tag and text of a stream with the hash of the container path around it, and whether it opens that container.

    A container's own tags stand in it.
    """
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    for node in nodes:
        closes = node[0].startswith("</")
        element = node[0][2:-1] if closes else node[0][1:-1].partition(" ")[0]
        inner = stack[-1][1] if stack else 0
        if closes and opened[element]:
            last = ""
            while last != element:
                last, inner = stack.pop()
                opened[last] -= 1
        elif not closes and element in _CONTAINERS:
            inner = _hash(inner, node[0]) if len(stack) < _DEEPEST else inner
            stack.append((element, inner))
            opened[element] += 1
            yield node, inner, True
            continue
        yield node, inner, False


def _part(node: Node, place: int) -> int:
    """Hash of a tag that is no container, at its place."""
    return _hash(place, node[0], "")


def page_parts(nodes: list[Node]) -> set[int]:
    """Hashes of the containers and the named tags that a page has, each with its place; 0 for the page."""
    return {0, *(place if opens else _part(node, place) for node, place, opens in _placed(nodes) if opens or " " in node[0])}


def template(nodes: list[Node], parts: frozenset[int]) -> list[Node]:
    """A page's stream without containers that are not in ``parts``, and without the names of other such tags."""
    out = []
    for node, place, opens in _placed(nodes):
        if place and place not in parts:
            continue
        rare = not opens and " " in node[0] and _part(node, place) not in parts
        out.append([node[0].partition(" ")[0] + ">"] if rare else node)
    return out


def _join_same(a: list[Node], b: list[Node]) -> list[Node]:
    """Two streams of equal keys as one, in any order: texts that differ become slots."""
    return [_merge(x, y, False) for x, y in zip(a, b)]


# --- applying a wrapper ---

_PRIME, _BASE = (1 << 61) - 1, 0x5BD1E9955BD1E995 % ((1 << 61) - 1)


def _hash(*parts: object) -> int:
    """Positive 63-bit hash that is the same in every task."""
    return int.from_bytes(hashlib.blake2b(repr(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") >> 1


def _blocks(page: str, paths: dict[str, bool]) -> tuple[list[str], list[tuple[int, int, int]], int]:
    """Texts of the blocks that the wrapper's paths call main text; containers in it; size of texts the wrapper cannot judge.

    A container that the wrapper has not seen is like the one around it, unless it is a menu or the like, or an ``article`` or ``main`` of its own.
    Containers are ``(hash of the path, first block, end)``, outer ones after those inside them.
    """
    blocks: list[str] = []
    pieces: list[str] = []
    containers: list[tuple[int, int, int]] = []
    unjudged = 0

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            blocks.append(text)
        pieces.clear()

    stack: list[tuple] = []  # what holds outside of each open container
    opened: Counter[str] = Counter()
    path, place, first, content, out, unseen = "", 0, 0, paths.get("", True), False, False

    def close() -> None:
        if content and len(blocks) > first:
            containers.append((place, first, len(blocks)))

    for kind, name, value in tokens(page):
        if kind == "text":
            if content:
                pieces.append(html.unescape(value))
            elif unseen and not out:
                unjudged += len(value.strip())
            continue
        element = name.partition(" ")[0]
        if element == "br":
            pieces.append(" ")
        if element not in _BLOCKS:
            continue
        flush()
        if element not in _CONTAINERS:
            continue
        if kind == "open":
            stack.append((element, path, place, first, content, out, unseen))
            opened[element] += 1
            out = out or left_out(name)
            content = not out and (content or any(_is_root(name, r) for r in _ROOTS))
            place, first = _hash(place, name), len(blocks)
            if len(stack) <= _DEEPEST:
                path = f"{path} > {name}"
                unseen = path not in paths
                content = paths.get(path, content)
        elif opened[element]:
            last = ""
            while last != element:
                close()
                last, path, place, first, content, out, unseen = stack.pop()
                opened[last] -= 1
    flush()
    while stack:
        close()
        _, _, place, first, content, _, _ = stack.pop()
    return blocks, containers, unjudged


Paths = dict[str, bool] | list[dict[str, bool]]


def _judged(page: str, paths: Paths | None) -> tuple[list[str], list[tuple[int, int, int]]]:
    """Blocks and containers of main text, by the first of the host's wrappers that fits. A page that none fits gets a
    wrapper of its own: one where nothing is found, or less than stands in containers that the wrapper has not seen."""
    if not page:
        return [], []
    for known in [paths] if isinstance(paths, dict) else paths or []:
        blocks, containers, unjudged = _blocks(page, known) if known else ([], [], 0)
        if unjudged < sum(map(len, blocks)):
            return blocks, containers
    return _blocks(page, content_paths(infer([page])))[:2]


def _keyed(blocks: list[str], containers: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Containers as ``(hash of path, hash of path and whole text, first block, end)``, in time linear in the blocks."""
    sums, powers = [0], [1]
    for block in blocks:
        sums.append((sums[-1] * _BASE + _hash(block)) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
    for place, first, end in containers:
        yield place, _hash(place, end - first, (sums[end] - sums[first] * powers[end - first]) % _PRIME), first, end


def container_rows(page: str, paths: Paths | None) -> set[tuple[int, int, int]]:
    """Rows ``(path, key, page)`` for the containers that hold at most half of the page's main text.

    ``key`` stands for the path with the container's text, ``page`` for the main text around and in it, so copies of a page count once.
    """
    blocks, containers = _judged(page, paths)
    sizes = [0]
    for block in blocks:
        sizes.append(sizes[-1] + len(block))
    minor = [(place, first, end) for place, first, end in containers if 2 * (sizes[end] - sizes[first]) <= sizes[-1]]
    if not minor:
        return set()
    whole = _hash(*blocks)
    return {(place, key, whole) for place, key, _, _ in _keyed(blocks, minor)}


def main_text(page: str, paths: Paths | None = None, fixed: frozenset[int] = frozenset()) -> str:
    """Main text of a page by the wrapper's paths, blocks joined by an empty line.

    Containers whose key is in ``fixed`` are left out, unless that leaves nothing.
    """
    blocks, containers = _judged(page, paths)
    if fixed:
        away = {k for _, key, first, end in _keyed(blocks, containers) if key in fixed for k in range(first, end)}
        blocks = [b for k, b in enumerate(blocks) if k not in away] or blocks
    return "\n\n".join(blocks)


_PARTS_SEEN = "host string, kind string, part bigint, n bigint"
_STRUCTURES = "host string, kind string, structure string, order bigint, nodes binary"
_WRAPPERS = "host string, kind string, root string, paths string, wrapper string"
_TEXTS = "page_id bigint, url string, host string, text string, n_chars bigint"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter[tuple[str, str, int]] = Counter()
        for host, page in zip(batch.column("host"), batch.column("html")):
            nodes = stream(page.as_py())
            key = host.as_py(), _marked_root(nodes)
            seen.update((*key, part) for part in page_parts(nodes))
        rows = [(*key, n) for key, n in sorted(seen.items())]
        kinds = pa.string(), pa.string(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["host", "kind", "part", "n"])


def _structures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct structures of the pages of each batch, texts that differ between their pages as slots."""
    for batch in batches:
        parts: dict[str, dict[str, frozenset[int]]] = {}
        known: dict[tuple, tuple[int, list[Node]]] = {}
        held = 0
        for host, order, page, text in zip(*(batch.column(c) for c in ("host", "order", "html", "parts"))):
            of_kind = text.as_py()
            if of_kind not in parts:
                parts[of_kind] = {k: frozenset(map(int, v.split(","))) for k, v in json.loads(of_kind).items()}
            raw = stream(page.as_py())
            kind = _marked_root(raw)
            nodes = template(raw, parts[of_kind][kind])
            key = host.as_py(), kind, "".join(map(_key, nodes))
            if key in known:
                first, others = known[key]
                known[key] = min(first, order.as_py()), _join_same(others, nodes)
            else:
                known[key] = order.as_py(), nodes
                held += len(nodes)
            if held > _HELD:
                yield _rows_of(known)
                known, held = {}, 0
        yield _rows_of(known)


def _rows_of(known: dict[tuple, tuple[int, list[Node]]]) -> pa.RecordBatch:
    """Rows of structures, repetitions folded."""
    rows = []
    for (host, kind, _), (order, nodes) in known.items():
        nodes = fold(nodes)
        structure = hashlib.blake2b("".join(map(_key, nodes)).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
        rows.append((host, kind, structure, order, pickle.dumps(nodes)))
    kinds = pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["host", "kind", "structure", "order", "nodes"])


def _folded(join: Callable[[list[Node], list[Node]], list[Node]], key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One row for several of a host, joined in an order that does not depend on tasks."""
    rows = rows.sort_values(["order", "structure", "nodes"])
    nodes = reduce(join, map(pickle.loads, rows["nodes"]))
    return pd.DataFrame({"host": [key[0]], "kind": [key[1]], "structure": [rows["structure"].min()], "order": [rows["order"].min()], "nodes": [pickle.dumps(nodes)]})


def _one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    return _folded(_join_same, key, rows)


def _aligned(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    return _folded(align, key, rows)


def _infer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    host, kind = key
    nodes = pickle.loads(_aligned(key, rows)["nodes"][0])
    paths = json.dumps(content_paths(nodes, kind), ensure_ascii=False)
    return pd.DataFrame({"host": [host], "kind": [kind], "root": [kind or content_root(nodes)], "paths": [paths], "wrapper": [expression(nodes)]})


def _paths_of(batch: pa.RecordBatch) -> Iterator[tuple[str, Paths | None]]:
    known: dict[str | None, Paths | None] = {None: None}
    for page, paths in zip(batch.column("html"), batch.column("paths")):
        key = paths.as_py()
        if key not in known:
            known[key] = json.loads(key)
        yield page.as_py() or "", known[key]


def _containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(host.as_py(), *row) for host, (page, paths) in zip(batch.column("host"), _paths_of(batch)) for row in sorted(container_rows(page, paths))]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=["host", "path", "key", "page"])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[str | None, frozenset[int]] = {None: frozenset()}
        texts = []
        for fixed, (page, paths) in zip(batch.column("fixed"), _paths_of(batch)):
            keys = fixed.as_py()
            if keys not in known:
                known[keys] = frozenset(map(int, keys.split(",")))
            texts.append(main_text(page, paths, known[keys]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "host", "text", "n_chars"],
        )


def template_parts(pages: DataFrame) -> DataFrame:
    """Rows ``(_host, parts)``: per kind of root, the containers and named tags on at least one in ``TEMPLATE_PART`` of all
    pages ``(host, html)`` of a host. Others, such as those named by a page's own number, are no part of a template;
    so a host has at most ``TEMPLATE_PART`` times as many as one page.
    """
    seen = cut_lineage(pages.mapInArrow(_parts, _PARTS_SEEN).groupBy("host", "kind", "part").agg(F.sum("n").alias("n")))
    totals = seen.filter("part = 0").select("host", "kind", F.col("n").alias("pages"))
    kept = lookup_join(seen, totals, ["host", "kind"], ["part"], "inner").filter(F.col("n") * TEMPLATE_PART >= F.col("pages"))
    by_kind = kept.groupBy("host", "kind").agg(F.array_join(F.sort_array(F.collect_list(F.col("part").cast("string"))), ",").alias("parts"))
    of_kinds = F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "parts")))))
    return cut_lineage(by_kind.groupBy(F.col("host").alias("_host")).agg(of_kinds.alias("parts")))


def host_wrappers(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows ``(host, kind, root, paths, wrapper)``: one wrapper per host and kind of marked root, from all its pages.

    Scan tasks join pages of one structure to one row; the structures of a host meet in groups of ``ALIGNED``, and their
    wrappers again, until one is left. So a host with a third of all pages is as small as the structures of its templates,
    and nothing depends on how pages are dealt to tasks.
    """
    order = F.xxhash64(F.col(id_col), F.col(html_col))
    pages = df.select(F.coalesce(host_of(F.col(url_col)), F.lit("")).alias("host"), order.alias("order"), F.col(html_col).alias("html")).filter(F.col("html") != "")
    found = _with_wrappers(pages, template_parts(pages.select("host", "html"))).mapInArrow(_structures, _STRUCTURES)
    rows = cut_lineage(found.groupBy("host", "kind", "structure").applyInPandas(_one, _STRUCTURES))
    while True:
        counts = rows.groupBy("host", "kind").agg(F.count("*").alias("_n"))
        if (counts.agg(F.max("_n")).first()[0] or 0) <= ALIGNED:
            return rows.groupBy("host", "kind").applyInPandas(_infer, _WRAPPERS)
        group = F.pmod(F.xxhash64("structure"), F.ceil(F.col("_n") / ALIGNED)).alias("_group")
        grouped = rows.join(counts, ["host", "kind"]).select(*rows.columns, group)
        rows = cut_lineage(grouped.groupBy("host", "kind", "_group").applyInPandas(_aligned, _STRUCTURES))


def _paths_by_host(wrappers: DataFrame) -> DataFrame:
    """Rows ``(_host, paths)``: the paths of a host's wrappers as a list, those with a marked root first."""
    rank = F.array_position(F.array(*map(F.lit, (*_ROOTS, ""))), F.col("kind"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "paths"))), lambda r: r["paths"])
    return wrappers.groupBy(F.col("host").alias("_host")).agg(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("paths"))


def fixed_containers(pages: DataFrame) -> DataFrame:
    """Rows ``(host, fixed)``: keys of the containers whose text is the same on most pages of the host that have them.

    ``pages`` has ``host`` (hash), ``html`` and ``paths``. All pages count, through sums: a container's text is fixed if it
    stands on at least ``FIXED_PAGES`` pages with different main texts, and on ``FIXED_SHARE`` of those with a container at that path. Such
    texts are no more than the host's templates hold, whatever its number of pages.
    """
    seen = cut_lineage(pages.mapInArrow(_containers, "host bigint, path bigint, key bigint, page bigint").distinct())
    texts = seen.groupBy("host", "path", "key").agg(F.count("*").alias("n")).filter(F.col("n") >= FIXED_PAGES)
    places = seen.groupBy("host", "path").agg(F.count_distinct("page").alias("pages"))
    fixed = lookup_join(texts, places, ["host", "path"], ["key"], "inner").filter(F.col("n") >= FIXED_SHARE * F.col("pages"))
    return fixed.groupBy("host").agg(F.array_join(F.sort_array(F.collect_set(F.col("key").cast("string"))), ",").alias("fixed"))


def _with_wrappers(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Pages with the row of their host, broadcast up to ``BROADCAST_BYTES``."""
    small = byte_size(wrappers) <= BROADCAST_BYTES
    return pages.join(hinted(wrappers, small), F.col("host") == F.col("_host"), "left").drop("_host")


def page_texts(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows ``(page_id, url, host, text, n_chars)``, one per row of ``df``; ``text`` is the whole main text.

    A wrapper tells where the main text of its host's pages is; containers in it that say the same on most of all
    pages of the host are left out. Wrappers are one short row per host. Up to ``BROADCAST_BYTES`` in all they are broadcast; beyond, pages
    are joined by host, where Spark splits a hot host because its wrapper is one row.

    A null or empty html gives an empty text. A page without a host shares a wrapper with others of that kind. Null
    ids and URLs stay null, repeated rows give repeated rows, other columns are not looked at.
    """
    wrappers = cut_lineage(_paths_by_host(host_wrappers(df, id_col, url_col, html_col)))
    pages = df.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    fixed = fixed_containers(_with_wrappers(pages.select("host", "html"), wrappers).withColumn("host", F.xxhash64("host")))
    both = cut_lineage(wrappers.join(fixed.withColumnRenamed("host", "_key"), F.xxhash64("_host") == F.col("_key"), "left").drop("_key"))
    return _with_wrappers(pages, both).mapInArrow(_apply, _TEXTS)
