"""Secret scans: fixed patterns, and assignments read as name-literal pairs with constants propagated."""

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("assign", "access", "hex", "literal")

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Parts of a target name that make its literal sensitive, with their weight.
SENSITIVE = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 2, "pass": 2, "secret": 3, "token": 3, "credential": 3, "credentials": 3,
    "apikey": 3, "accesskey": 3, "privatekey": 3, "authkey": 3, "signingkey": 3, "encryptionkey": 3, "auth": 1, "api": 1,
    "access": 1, "private": 1, "signing": 1, "encryption": 1, "key": 1, "salt": 1, "bearer": 2, "jwt": 2, "dsn": 1, "webhook": 1,
}
# Parts that say that the literal is about a secret, not one.
HARMLESS = {"name", "file", "path", "url", "field", "label", "length", "len", "count", "type", "min", "max", "public", "example", "prompt", "id", "ttl", "expiry", "hint"}
# Literals that stand where a secret will be filled in.
_PLACEHOLDER = re.compile(r"(?i)(?:x+|\*+|\.+|-+|changeme|change[-_]me|your[-_ ].*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|none|null|nil|true|false|undefined|example|placeholder|test|dummy|todo)")

# Strings of all kinds: three quotes and back-ticks run over lines, escaped quotes stand inside of another string.
_TRIPLE = re.compile(r"""[rbufRBUF]{0,2}(?P<quotes>\"{3}|'{3})""")
_TICK = "`"
_STRING = re.compile(
    r"""[rbufRBUF@]{0,2}"(?P<double>(?:[^"\\\n]|\\.)*+)"|[rbufRBUF@]{0,2}'(?P<single>(?:[^'\\\n]|\\.)*+)'|\\"(?P<escaped>[^"\\\n]*+)\\"|\\'(?P<lone>[^'\\\n]*+)\\'"""
)
# name : type = value, name := value, "name" => value, name: value, -Dname=value, obj.name = value, a["name"] = value
_PAIR = (
    r"""(?P<quote>\\?["']|)(?P<name>(?<![A-Za-z0-9_.])[A-Za-z_][A-Za-z0-9_.-]{0,80})(?P=quote)\]?[ \t]*"""
    r"""(?:(?::[ \t]*[A-Za-z_][\w.<>\[\]]*[ \t]*)?(?:=>|:=|\+=|=(?!=))|:(?!:|//))[ \t]*(?=["'`rbufA-Za-z0-9_+/$<{(\\|>@])"""
)
_ELEMENT = r"""<(?P<tag>[A-Za-z_][\w.:-]{0,80})(?:\s[^<>]*)?>(?P<inside>[^<>]+)</(?P=tag)\s*>"""
_OWNER = r"""(?<![\w.])(?P<keyword>def|class|function|func|fn|struct|interface|enum|namespace|object|module)[ \t]+(?P<owner>[A-Za-z_]\w{0,80})"""
# What the lexer stops at; all between is text or code without effect on pairs.
_TOKEN = re.compile(
    "|".join(
        [r"(?P<line>\n[ \t]*(?=\S))", r"""(?P<fence>\"{3}|'{3})""", _OWNER, _PAIR, _ELEMENT, r"""(?P<string>(?<![\w\\])(?:"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'))""", r"(?P<mark>[{}(),])"]
    )
)
_PYTHON_BODY = re.compile(r"[^\n{]{0,400}:[ \t]*(?:#[^\n]*)?(?=\n|\Z)")
_BLANKS, _SPACES = re.compile(r"[ \t]*"), re.compile(r"\s*")
_JOIN = re.compile(r"\+(?!=)|\.\.?|&(?!&)|\\\n")
_ELSE = re.compile(r"\|\||\?\?|\?:|or\b")
_REF = re.compile(
    r"""(?:\$\{?)?(?P<ref>[A-Za-z_]\w{0,80}(?:(?:\.|->|::)[A-Za-z_]\w{0,80}|\[["'][^"'\n\]]{0,80}["']\]){0,8})\}?"""
)
_REF_GAPS = re.compile(r"""->|::|\[["']|["']\]""")
_SHELL_DEFAULT = re.compile(r"\$\{\w{1,80}:?[-=](?P<default>[^}\n]*)\}")
_BLOCK = re.compile(r"[|>][+-]?[0-9]?[+-]?[ \t]*(?:#[^\n]*)?\n")
_BLOCK_LINE = re.compile(r"(?P<indent>[ \t]*)(?P<rest>[^\n]*)(?:\n|\Z)")
_HEREDOC = re.compile(r"""(?:\$\([ \t]*cat[ \t]+)?<<[<~-]?[ \t]*["']?(?P<end>[A-Za-z_]\w{0,40})["']?[^\n]*\n""")
_BARE = re.compile(r"[A-Za-z0-9+/_=.~!@#$%^&*-]+")
_DOTTED = re.compile(r"[A-Za-z_]+(?:\.[A-Za-z_]+)+")
# Calls that look a value up by its name: their only argument is that name, a second one the default.
_GETTER = re.compile(r"(?i)(?:env|get|config|setting|lookup|fetch|find|load|read|open|input|prompt|var|param|secret|option)")
_OWN = ("self.", "this.")
# A name that is joined to others gives at most this many of its last strings, or values that grow by themselves would fill the memory.
_JOINED = 64
_HINT = re.compile("(?i)pass|pwd|secret|token|cred|key|auth|api|access|private|signing|encryption|salt|bearer|jwt|dsn|webhook")
# What a literal with spaces has to have inside: the header of a key, or a word of letters and digits.
_SPACED = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY|(?<![^ ])(?=[^ ]*[0-9])(?=[^ ]*[A-Za-z])[^ ]{8,}")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def name_score(name: str) -> int:
    """How sensitive a target name is: weights of its parts and of neighbours read as one."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if any(p in HARMLESS for p in parts[-1:]):
        return 0
    pairs = ["".join(p) for p in zip(parts, parts[1:])]
    return sum(SENSITIVE.get(p, 0) for p in [*parts, *pairs])


def entropy(counts: Counter) -> float:
    n = counts.total()
    return -sum(c / n * math.log2(c / n) for c in counts.values() if c) if n else 0.0


def _shape(counts: Counter) -> int:
    """Points for the length, mixture and entropy of a literal with these characters."""
    used = [c for c, n in counts.items() if n]
    kinds = sum(any(re.match(p, c) for c in used) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return (kinds >= 2) + (kinds >= 3) + (entropy(counts) >= 3) + (counts.total() >= 16)


def literal_score(name: str, literal: str) -> int:
    """Points for the target name, and for length, mixture and entropy of the literal; 5 or more is a secret.

    Literals with spaces count if they hold a private key or a word of letters and digits, or stand for a passphrase.
    """
    points = name_score(name)
    if points < 2 or len(literal) < 8 or _PLACEHOLDER.fullmatch(literal):
        return 0
    if " " in literal.strip() and "passphrase" not in name.lower() and not _SPACED.search(literal):
        return 0
    return points + _shape(Counter(literal))


class Literal:
    """Places of a literal in the text, and the places of the pieces that make its value."""

    __slots__ = ("spans", "pieces")

    def __init__(self, spans: tuple[tuple[int, int], ...], pieces: tuple[tuple[int, int], ...]):
        self.spans, self.pieces = spans, pieces


class _Scope:
    """Names bound in a block: one in braces, or one with an indent deeper than its first line's (``indent``)."""

    def __init__(self, owner: str, indent: int | None):
        self.owner, self.indent, self.names = owner, indent, set()


class _Call:
    """A call that is the value of ``target``: its commas and its last literal argument."""

    def __init__(self, target: str, getter: bool, depth: int):
        self.target, self.getter, self.depth, self.commas, self.literal = target, getter, depth, 0, None


class _Lexer:
    """Pairs of target names and literals of one text. Every method is linear in what it moves over."""

    def __init__(self, text: str):
        self.text = text
        self.bound: dict[str, list[Literal | None]] = {}
        self.scopes = [_Scope("", None)]
        self.open_ended: set[str] = set()  # closing marks that do not come again
        self.bare_end = -1  # where the run of a bare value ends that was looked at last
        self.called: str | None = None  # name of the call that the last expression ended at

    def bind(self, name: str, literal: Literal | None) -> None:
        scope = self.scopes[-1]
        if name in scope.names:
            self.bound[name][-1] = literal
        elif literal or self.bound.get(name):
            scope.names.add(name)
            self.bound.setdefault(name, []).append(literal)

    def leave(self) -> None:
        """End the innermost scope: members stay known by their owner's name, fields of an object in its class."""
        scope = self.scopes.pop()
        ended = [(name, self.bound[name].pop()) for name in sorted(scope.names)]
        for name, literal in ended:
            if name.startswith(_OWN):
                self.bind(name, literal)
            elif scope.owner and len(name) <= 160:
                self.bind(f"{scope.owner}.{name}", literal)

    def looked_up(self, ref: str) -> Literal | None:
        found = self.bound.get(_REF_GAPS.sub(".", ref).rstrip("."))
        return found[-1] if found else None

    def closing(self, mark: str, at: int, end: int) -> int:
        """Place of the next ``mark``, -1 if there is none; a mark that is missing once is not looked for again."""
        if mark in self.open_ended:
            return -1
        place = self.text.find(mark, at, end)
        if place < 0:
            self.open_ended.add(mark)
        return place

    def string_at(self, at: int, end: int) -> tuple[int, int, int] | None:
        """Start and end of the content of the string that begins here, and the place behind it."""
        text = self.text
        if m := _TRIPLE.match(text, at, end):
            place = self.closing(m["quotes"], m.end(), end)
            if place >= 0:
                return m.end(), place, place + 3
        if text.startswith(_TICK, at, end):
            place = self.closing(_TICK, at + 1, end)
            return (at + 1, place, place + 1) if place >= 0 else None
        m = _STRING.match(text, at, end)
        return (*m.span(m.lastgroup), m.end()) if m else None

    def expression(self, at: int, end: int) -> tuple[list[Literal], int, bool]:
        """Literals that a value may be, the place behind it, and whether it is more than a bare value.

        Strings joined by an operator or standing side by side are one literal, and a bound name
        stands for its literal; ``or`` and the like begin another one.
        """
        text, found, parens, place, strings, compound = self.text, [], 0, at, [], False
        spans: list[tuple[int, int]] = []
        pieces: list[tuple[int, int]] = []
        run: tuple[int, int] | None = None  # strings of this expression that follow on each other
        alone: Literal | None = None  # what a name stands for that is all of the value so far
        self.called = None

        def done() -> None:
            nonlocal run, alone
            if run:
                spans.append(run)
            if alone:
                found.append(alone)
            elif pieces:
                found.append(Literal(tuple(spans), tuple(pieces)))
            spans.clear(), pieces.clear()
            run = alone = None

        while True:
            place = (_SPACES if parens else _BLANKS).match(text, place, end).end()
            if text.startswith("(", place, end):
                parens, place, compound = parens + 1, place + 1, True
                continue
            string = self.string_at(place, end)
            if string:
                a, b, place = string
                run, alone = (run[0] if run else a, b), None
                pieces.append((a, b))
                strings.append((a, b))
            elif ref := _REF.match(text, place, end):
                if text.startswith("(", ref.end(), end):
                    self.called, place = ref["ref"], ref.end()
                    break
                known = self.looked_up(ref["ref"])
                if run:
                    spans.append(run)
                    run = None
                alone = known if known and not pieces else None
                if known:
                    spans += known.spans[-_JOINED:]
                    pieces += known.pieces[-_JOINED:]
                compound = compound or text.startswith("[", ref.end(), end) or "[" in ref["ref"]
                place = ref.end()
            else:
                break
            while True:
                after = (_SPACES if parens else _BLANKS).match(text, place, end).end()
                if not (parens and text.startswith(")", after, end)):
                    break
                parens, place = parens - 1, after + 1
            if join := _JOIN.match(text, after, end):
                # A full stop behind a word ends a sentence, one beside a string joins.
                begins = _SPACES.match(text, join.end(), end).end()
                if string or join[0] not in (".", "..") or text.startswith(('"', "'"), begins, end):
                    compound, place = compound or after > place or begins > join.end(), begins
                    continue
                break
            if other := _ELSE.match(text, after, end):
                done()
                compound, place = True, other.end()
                continue
            if not (string and text.startswith(('"', "'"), after, end)):
                break
            place = after
        done()
        self.strings = strings
        return found, place, compound

    def block(self, at: int, end: int, indent: int) -> tuple[Literal | None, int]:
        """Lines below a YAML key that are indented deeper than it."""
        pieces, place = [], at
        while place < end:
            line = _BLOCK_LINE.match(self.text, place, end)
            if line["rest"] and len(line["indent"]) <= indent:
                break
            if line["rest"]:
                pieces.append(line.span("rest"))
            place = line.end()
        return (Literal(((pieces[0][0], pieces[-1][1]),), tuple(pieces)) if pieces else None), (pieces[-1][1] if pieces else at)

    def value(self, at: int, end: int, indent: int) -> tuple[list[Literal], int]:
        """Literals of the value that begins here, and the place to read on from."""
        text = self.text
        self.strings, self.called = [], None
        if m := _BLOCK.match(text, at, end):
            literal, place = self.block(m.end(), end, indent)
            return ([literal] if literal else []), place
        if m := _HEREDOC.match(text, at, end):
            place = self.closing("\n" + m["end"], m.end() - 1, end)
            if place < 0:
                place = self.closing_indented(m["end"], m.end() - 1, end)
            if place > m.end():
                return [Literal(((m.end(), place),), ((m.end(), place),))], place
            return [], at
        if m := _SHELL_DEFAULT.match(text, at, end):
            return [Literal((m.span("default"),), (m.span("default"),))], m.end()
        found, place, compound = self.expression(at, end)
        if found or self.called or compound:
            return found, place if found or self.called else at
        if at >= self.bare_end or self.bare_end > end:
            bare = _BARE.match(text, at, end)
            self.bare_end = bare.end() if bare else at
        if self.bare_end > at and not text.startswith(("(", "["), self.bare_end) and not _DOTTED.fullmatch(text, at, self.bare_end):
            return [Literal(((at, self.bare_end),), ((at, self.bare_end),))], at
        return [], at

    def closing_indented(self, mark: str, at: int, end: int) -> int:
        """Place of the line that holds the closing mark behind blanks."""
        key = "\n " + mark
        if key in self.open_ended:
            return -1
        m = re.compile(r"\n[ \t]+" + mark + r"\b").search(self.text, at, end)
        if not m:
            self.open_ended.add(key)
        return m.start() if m else -1

    def pairs(self, at: int, end: int) -> Iterator[tuple[str, Literal]]:
        """Pairs between two places; text inside of strings is read as a scope of its own."""
        text, base = self.text, len(self.scopes)
        self.scopes.append(_Scope("", None))
        indent = line = depth = 0
        owner = described = ""
        calls: list[_Call] = []
        while m := _TOKEN.search(text, at, end):
            at, kind = m.end(), m.lastgroup
            if kind == "line":
                indent, line = m.end() - m.start() - 1, m.end()
                while len(self.scopes) > base + 1 and self.scopes[-1].indent is not None and indent <= self.scopes[-1].indent:
                    self.leave()
            elif m["owner"] is not None:
                if m.start() == line and m["keyword"] in ("def", "class") and _PYTHON_BODY.match(text, at, end):
                    self.scopes.append(_Scope(m["owner"] if m["keyword"] == "class" else "", indent))
                else:
                    owner = m["owner"] if m["keyword"] in ("class", "struct", "interface", "enum", "namespace", "object", "module") else ""
            elif m["tag"] is not None:
                a, b = m.span("inside")
                a, b = a + len(m["inside"]) - len(m["inside"].lstrip()), b - len(m["inside"]) + len(m["inside"].rstrip())
                if b > a:
                    yield m["tag"], Literal(((a, b),), ((a, b),))
            elif m["string"] is not None:
                a, b, _ = self.string_at(m.start(), end) or (m.start() + 1, m.end() - 1, m.end())
                if calls and calls[-1].depth == depth:
                    calls[-1].literal = Literal(((a, b),), ((a, b),))
                yield from self.inside(a, b)
            elif m["name"] is not None:
                name = m["name"]
                found, at = self.value(m.end(), end, indent)
                strings, called = self.strings, self.called
                for literal in found:
                    yield name, literal
                    if described and name.lower() == "value":
                        yield described, literal
                one = found[-1] if found else None
                described = "".join(text[x:y] for x, y in one.pieces)[:80] if one and name.lower() in ("name", "key") else ""
                self.bind(name, one)
                if calls and calls[-1].depth == depth and one:
                    calls[-1].literal = one
                for a, b in strings:
                    yield from self.inside(a, b)
                if called:
                    calls.append(_Call(name, bool(_GETTER.search(called)), depth + 1))
                owner = name if text.startswith("{", at) else ""
            elif m["mark"] == "{":
                self.scopes.append(_Scope(owner, None))
                owner = ""
            elif m["mark"] == "}":
                while len(self.scopes) > base + 1:
                    braces = self.scopes[-1].indent is None
                    self.leave()
                    if braces:
                        break
            elif m["mark"] == "(":
                depth += 1
            elif m["mark"] == ",":
                if calls and calls[-1].depth == depth:
                    calls[-1].commas += 1
            elif m["mark"] == ")":
                if calls and calls[-1].depth >= depth:
                    call = calls.pop()
                    if call.literal and (call.commas or not call.getter):
                        yield call.target, call.literal
                        self.bind(call.target, call.literal)
                    if other := _ELSE.match(text, _BLANKS.match(text, at, end).end(), end):
                        found, at = self.expression(other.end(), end)[:2]
                        for literal in found:
                            yield call.target, literal
                            self.bind(call.target, literal)
                depth = max(0, depth - 1)
        while len(self.scopes) > base:
            self.leave()

    def inside(self, a: int, b: int) -> Iterator[tuple[str, Literal]]:
        """Pairs written inside of a string, such as JSON or a connection string."""
        if self.text.find("=", a, b) >= 0 or self.text.find(":", a, b) >= 0:
            yield from self.pairs(a, b)


def assignments(text: str) -> Iterator[tuple[str, Literal]]:
    """Pairs of a target name and a literal, as the text reads as source or configuration.

    A literal is a string of any kind (also over lines, and several joined ones as one), a block
    below a YAML key, a here-document, the inside of an element, or a bare value. A name that is
    bound in a scope around stands for its literal, ``A.k`` for a member of ``A``; a call stands
    for its default. ``name``/``key`` with ``value`` beside make a pair. Comments are read like
    code, since what is commented out leaks as well.
    """
    yield from _Lexer(text).pairs(0, len(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans ``(start, kind, end)`` of the fixed patterns, leftmost and non-overlapping per kind."""
    spans = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16] if "AKIA" in text else []
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return spans


def method_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of literals whose target names and shapes score as secrets; each place once."""
    if not _HINT.search(text):
        return []
    found, reported = set(), set()
    seen: dict[Literal, tuple[bool, bool, int]] = {}  # whether it can be a secret, also beside other names than a passphrase's, and its shape
    last: dict[int, tuple[int, Counter]] = {}  # characters of the last literal of one piece, by its end
    for name, literal in assignments(text):
        points = name_score(name)
        if points < 2:
            continue
        if literal in reported:
            continue
        if literal not in seen:
            (a, b), *more = literal.pieces
            if not more and b in last and last[b][0] <= a:  # the rest of the same run
                counts = last[b][1]
                counts.subtract(text[last[b][0] : a])
            else:
                counts = Counter("".join(text[x:y] for x, y in literal.pieces))
            if not more:
                last[b] = (a, counts)
            placeholder = _PLACEHOLDER.fullmatch("".join(text[x:y] for x, y in literal.pieces)) if more else _PLACEHOLDER.fullmatch(text, a, b)
            gaps = counts[" "] or counts["\n"]
            joined = "" if not gaps else "".join(text[x:y] for x, y in literal.pieces).strip()
            free = not (" " in joined or "\n" in joined) or bool(_SPACED.search(joined))
            seen[literal] = (counts.total() >= 8 and not placeholder, free, _shape(counts))
        possible, free, shape = seen[literal]
        if possible and (free or "passphrase" in name.lower()) and points + shape >= 5:
            reported.add(literal)
            found.update((a, 3, b) for a, b in literal.spans if b > a)
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    """``kind:start:end`` by start, then kind, joined by commas."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span as one ``[SECRET]``; overlapping spans are one."""
    out, at, until = [], 0, -1
    for start, _, end in sorted(spans):
        if start >= until:
            if until >= 0:
                out.append("[SECRET]")
                at = until
            out.append(text[at:start])
            until = end
        until = max(until, end)
    if until >= 0:
        out.append("[SECRET]")
        at = until
    return "".join(out) + text[at:]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            spans = base + method_spans(text)
            kinds = Counter(kind for _, kind, _ in spans)
            found = [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(spans)]
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            rows.append((kinds[0], kinds[1], kinds[2], digest, written(spans), found))
        n = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
        text = [pa.array([r[k] for r in rows], pa.string()) for k in (3, 4)]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), *n, *text, pa.array([r[5] for r in rows], kind)], names=_FOUND_NAMES)


_FOUND = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int>>"
_FOUND_NAMES = [part.split(" ")[0] for part in _FOUND.split(", ")]


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and spans of secrets, one row per row of ``df``, in code points with the end exclusive.

    Row by row, without a shuffle. A null text counts as an empty one, which has none. Null
    ids stay null, repeated rows give repeated rows, other columns are not looked at.
    """
    return df.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(_scan, _FOUND)


def _redact(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = []
            for text in batch.column(at):
                text = text.as_py()
                texts.append(text if text is None else redacted(text, base_spans(text) + method_spans(text)))
            columns = [pa.array(texts, batch.schema.field(at).type) if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def without_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df``, secrets in the text replaced by ``[SECRET]``; null texts stay null."""
    return df.mapInArrow(_redact(text_col), df.schema)
