"""Personal data: fixed patterns, and a linear-chain random field over word shapes."""

import hashlib
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

KINDS = ("email", "ip", "card", "phone", "crf_email", "crf_ip", "crf_card", "crf_phone")
LABELS = ("O", "B-email", "I-email", "B-ip", "I-ip", "B-card", "I-card", "B-phone", "I-phone")
FEATURES = 1 << 12

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, so later places in a run are not tried.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Tokens of the field: an address or number with the marks inside it.
_POSSIBLE = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address begins where the run before its ``@`` does, or at the end of the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at) if at >= done else None
        start = at
        if m:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
        if m and start < at:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans ``(kind, start, end)`` of the fixed patterns, leftmost and non-overlapping per kind; failing matches are dropped."""
    spans = [(0, a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    if "." in text:
        spans += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, m.start(), m.end()))
    if "+" in text:
        spans += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return spans


def _shape(word: str) -> str:
    """Word shape: runs of one kind are one sign, digits keep their number up to five."""
    out = []
    for m in re.finditer(r"[0-9]+|[a-z]+|[A-Z]+|[^\W\d_]+|.", word, re.DOTALL):
        part = m[0]
        if part[0].isdigit() and part.isascii():
            out.append("0" * min(len(part), 5))
        else:
            out.append("a" if part[0].islower() else "A" if part[0].isalpha() else part[0])
    return "".join(out[:24])


def _bare(word: str) -> str:
    return word.strip(".,;:!?\"'()[]{}<>|*#$%&")


def features(words: list[str], k: int) -> list[int]:
    """Numbers of the features of word ``k``: its shape, size and marks, and the shapes and words beside it."""

    def near(j: int) -> str:
        return _bare(words[j]) if 0 <= j < len(words) else "<end>"

    word = near(k)
    digits = sum(c.isdigit() for c in word)
    names = (
        "bias", "s=" + _shape(word), f"n={min(digits, 20)}", f"l={min(len(word), 12)}", f"at={'@' in word}", f"dots={min(word.count('.'), 4)}", f"dash={min(word.count('-'), 4)}",
        "first=" + words[k][:1], "p=" + near(k - 1).lower()[:12], "q=" + near(k - 2).lower()[:12], "f=" + near(k + 1).lower()[:12],
        "ps=" + _shape(near(k - 1)), "fs=" + _shape(near(k + 1)), "ps+s=" + _shape(near(k - 1)) + _shape(word), "s+fs=" + _shape(word) + _shape(near(k + 1)),
    )
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


def _steps(scores: np.ndarray, moves: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log sums of padded chains: ``scores`` is (chains, places, labels)."""
    n, t, _ = scores.shape
    fore, back = scores.copy(), np.zeros_like(scores)
    for k in range(1, t):
        step = np.logaddexp.reduce(fore[:, k - 1, :, None] + moves[None], axis=1) + scores[:, k]
        fore[:, k] = np.where((k < sizes)[:, None], step, fore[:, k - 1])
    for k in range(t - 2, -1, -1):
        step = np.logaddexp.reduce(moves[None] + (scores[:, k + 1] + back[:, k + 1])[:, None, :], axis=2)
        back[:, k] = np.where((k + 1 < sizes)[:, None], step, 0)
    return fore, back


class Field:
    """Linear-chain conditional random field; only words with a digit or ``@`` may carry a label but O."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    @staticmethod
    def _chains(rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers (chains, places, features), sizes, and which places are forced to O."""
        sizes = np.array([len(r) for r in rows])
        per = len(features(["x"], 0))
        found = np.zeros((len(rows), int(sizes.max()), per), np.int64)
        forced = np.ones(found.shape[:2], bool)
        for i, words in enumerate(rows):
            for k, w in enumerate(words):
                found[i, k] = features(words, k)
                forced[i, k] = not _POSSIBLE.search(w)
        return found, sizes, forced

    @classmethod
    def fit(cls, rows: list[tuple[list[str], list[str]]], rounds: int = 50, rate: float = 0.1, decay: float = 1e-3) -> "Field":
        """Maximum likelihood by Adam over all rows at once, with ``decay`` on the weights."""
        number = {name: k for k, name in enumerate(LABELS)}
        found, sizes, forced = cls._chains([words for words, _ in rows])
        n, t, per = found.shape
        gold = np.zeros((n, t), int)
        for i, (_, labels) in enumerate(rows):
            gold[i, : len(labels)] = [number[x] for x in labels]
        inside = np.arange(t)[None] < sizes[:, None]
        params = [np.zeros((FEATURES, len(LABELS))), np.zeros((len(LABELS), len(LABELS)))]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        eye = np.eye(len(LABELS))
        for step in range(1, rounds + 1):
            weights, moves = params
            scores = weights[found].sum(axis=2)
            scores[forced, 1:] = -1e4
            fore, back = _steps(scores, moves, sizes)
            total = np.logaddexp.reduce(fore[np.arange(n), sizes - 1], axis=1)
            seen = np.exp(fore + back - total[:, None, None]) * inside[:, :, None]
            wrong = seen - eye[gold] * inside[:, :, None]
            grad = np.zeros_like(weights)
            np.add.at(grad, found.reshape(-1), np.repeat(wrong.reshape(n * t, -1), per, axis=0))
            pair = fore[:, :-1, :, None] + moves[None, None] + (scores + back)[:, 1:, None, :] - total[:, None, None, None]
            both = (np.exp(np.minimum(pair, 0)) * inside[:, 1:, None, None]).sum(axis=(0, 1))
            counted = np.einsum("nta,ntb->ab", eye[gold[:, :-1]] * inside[:, 1:, None], eye[gold[:, 1:]] * inside[:, 1:, None])
            for k, g in enumerate((grad / n + decay * weights, (both - counted) / n + decay * moves)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] = params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return cls(params[0].astype(np.float32), params[1].astype(np.float32))

    def decode(self, chains: list[list[list[int]]]) -> list[np.ndarray]:
        """Best labels of chains of feature numbers, by Viterbi over all chains of similar length at once.

        Each chain is a run of words that may carry a label, so what stands before and
        after it is O.
        """
        out: list[np.ndarray] = [np.zeros(0, int)] * len(chains)
        order = sorted(range(len(chains)), key=lambda i: len(chains[i]))
        for at in range(0, len(order), 512):
            group = order[at : at + 512]
            sizes = np.array([len(chains[i]) for i in group])
            t = int(sizes.max())
            scores = np.zeros((len(group), t, len(LABELS)), np.float32)
            for row, i in enumerate(group):
                scores[row, : sizes[row]] = self.weights[np.array(chains[i])].sum(axis=1)
            best = scores[:, 0] + self.moves[0]
            steps = np.zeros((len(group), t, len(LABELS)), np.int8)
            for k in range(1, t):
                ways = best[:, :, None] + self.moves[None]
                live = (k < sizes)[:, None]
                steps[:, k] = np.where(live, ways.argmax(axis=1), np.arange(len(LABELS)))
                best = np.where(live, ways.max(axis=1) + scores[:, k], best)
            label = (best + self.moves[:, 0]).argmax(axis=1)
            path = np.zeros((len(group), t), int)
            for k in range(t - 1, -1, -1):
                path[:, k] = label
                label = steps[np.arange(len(group)), k, label]
            for row, i in enumerate(group):
                out[i] = path[row, : sizes[row]]
        return out


_TRIM_LEFT, _TRIM_RIGHT = "\"'([{<*#$%&|,;:", ".,;:!?\"')]}>|*#$%&"


def possible_runs(text: str) -> list[list[tuple[int, int, list[int]]]]:
    """Runs of neighbouring words with a digit or ``@``: each word's place and features."""
    runs: list[list[tuple[int, int, list[int]]]] = []
    if not _POSSIBLE.search(text):
        return runs
    for line in re.finditer(r"[^\n]+", text):
        if not _POSSIBLE.search(line[0]):
            continue
        found = [(m.start() + line.start(), m.end() + line.start(), m[0]) for m in _WORD.finditer(line[0])]
        words = [w for _, _, w in found]
        last = -2
        for k, (start, end, word) in enumerate(found):
            if _POSSIBLE.search(word):
                lo = max(0, k - 2)
                entry = (start, end, features(words[lo : k + 3], k - lo))
                if last == k - 1:
                    runs[-1].append(entry)
                else:
                    runs.append([entry])
                last = k
    return runs


def _tagged(text: str, run: list[tuple[int, int, list[int]]], labels: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Spans of the labels of one run, without the marks around them. A stretch that its kind cannot have is read word by word."""

    def span(kind: str, start: int, end: int) -> tuple[int, int, int] | None:
        while start < end and text[start] in _TRIM_LEFT and not (kind == "phone" and text[start] == "("):
            start += 1
        while end > start and text[end - 1] in _TRIM_RIGHT:
            end -= 1
        return (KINDS.index("crf_" + kind), start, end) if end > start and _plausible(kind, text[start:end]) else None

    k = 0
    while k < len(run):
        name = LABELS[labels[k]]
        j = k + 1
        if name != "O":
            kind = name[2:]
            while j < len(run) and LABELS[labels[j]] == "I-" + kind:
                j += 1
            whole = span(kind, run[k][0], run[j - 1][1])
            yield from filter(None, [whole] if whole else [span(kind, start, end) for start, end, _ in run[k:j]])
        k = j


def _plausible(kind: str, text: str) -> bool:
    """Sizes that the kind cannot have are turned away whatever the field says."""
    n = len(_DIGIT.findall(text))
    if kind != "email" and (any(map(str.isalpha, text)) or kind == "ip" and text.count(".") != 3):
        return False
    return {"email": "@" in text[1:], "ip": 4 <= n <= 12, "card": 13 <= n <= 19, "phone": 7 <= n <= 15}[kind]


def spans_of(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """For each text its base spans and those that the field adds, which overlap no base span."""
    out, chains, owners = [], [], []
    for i, text in enumerate(texts):
        out.append((base_spans(text), []))
        for run in possible_runs(text):
            chains.append([f for _, _, f in run])
            owners.append((i, run))
    for (i, run), labels in zip(owners, field.decode(chains)):
        out[i][1].extend(_tagged(texts[i], run, labels))
    return [(base, _outside(added, base)) for base, added in out]


def _outside(added: list, base: list) -> list:
    """Spans that overlap no base span; one pass over both in order of their starts."""
    if not added or not base:
        return added
    ordered, kept, at, until = sorted((a, b) for _, a, b in base), [], 0, -1
    for span in sorted(added, key=lambda s: s[1]):
        while at < len(ordered) and ordered[at][0] <= span[1]:
            until = max(until, ordered[at][1])
            at += 1
        if until <= span[1] and (at == len(ordered) or ordered[at][0] >= span[2]):
            kept.append(span)
    return kept


def written(spans: list[tuple[int, int, int]]) -> str:
    """``kind:start:end`` by kind, then start, joined by commas."""
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for kind, a, b in sorted(spans))


# Sentences labelled by hand, with personal data as [kind words]. The other digits in them are none.
HAND_LABELLED = """
You can reach Dr. Weiss at [phone (212) 555-0187] or by mail under [email weiss.lab@uni-klinik.example], office hours 9:00 to 17:30.
Please send the signed form to [email j.o'neill@post.example.ie] before 12/05/2021, room 4.217.
My new number is [phone 0171 5550 134], the old one from 2019 no longer works.
Ring [phone +44 20 7946 0321] and ask for extension 2204.
Fax: [phone 030/5550199], order no. 4401-77-2
The card [card 4929 1234 5678 9017] was declined on 2020-11-03 at 14:22, amount 1,299.00 EUR.
Card number [card 5398-2210-0047-6631] expires 08/27, the code on the back is 3 digits.
He typed [card 3714 496353 98431] into the form and got error 502.
Amex [card 371449635398432] and Visa [card 4929123456789018] were both charged 49.90.
Login from [ip 192.168.4.77] at 03:14:07, 12 failed attempts since 02:58.
Blocked [ip 203.0.113.250] after 300 requests in 60 seconds; version 2.4.1 of the filter was in use.
The server moved from [ip 10.20.30.41] to [ip 10.20.30.42] in release 7.10.3.
ping [ip 8.8.4.4] took 23.7 ms, 64 bytes, ttl 117
Escríbame a [email lucia.fernandez@correo] o llame al [phone 91 555 01 42] por la tarde.
Appelez le [phone 01 55 50 12 34], prix 24,90 EUR, code 75011 Paris.
Envoyez votre dossier à [email service-client@banque.example.fr], réf. 2021/443.
Tel. [phone 089-555-0147], Mo-Fr 8-18 Uhr, Kundennummer 20447
Die Nummer [phone +49 89 5550 1478] gilt seit 1.4.2018, Vorwahl 089 bleibt.
Contact [email root@localhost] if build 20211104 fails 3 times.
Call me on [phone 415.555.0132] after 5 pm, flat 12, 94110 San Francisco.
Her mail [email m_tran88@students.example.edu] bounced 4 times in 2022.
Mobile [phone 07700 900461], landline [phone 020 7946 0999], both before 8pm.
The population grew from 1834502 in 1990 to 2210334 in 2010, or 20.5 percent.
ISBN 978-3-16-148410-0, 344 pages, 19.99 USD, first printed 1987
Section 4.2.1 of RFC 2616 says that 304 has no body, see page 63.
Release 10.15.7 fixes 48 bugs of 10.15.6 and needs 8 GB of memory.
Flight LH 454 leaves at 10:05 from gate B42 and lands 12:45 local time.
The case of 14.03.1998 (no. 2 BvR 1438/95) was decided 5:3.
commit 9f8e7d6c5b4a39281706f5e4d3c2b1a098765432 changed 12 files, 340 lines
Order 100-2231987-5548203 ships in 2 parcels of 3.5 kg each.
Temperatures of 21.5 to 23.8 degrees, 1013 hPa, wind 12 km/h
In 1914 1915 1916 and 1917 the prices rose 4 6 9 and 14 percent.
twitter @anna_k42 has 10,230 followers and 1500 posts since 2011
Invoice 2021-000431 over 12.345,67 is due in 30 days.
Serial 7734-9921-0048 belongs to model X200, made 2015.
Copyright (c) 2003-2019, version 3.0, all 4 authors
sha1 = 2fd4e1c67a2d28fced849ee1bb76e7391b93eb12 size 4096
The scores were 21-19 17-21 21-15 after 64 minutes.
Coordinates 48.8584 2.2945, height 330 m, 1665 steps
Part 12-3456-789 replaces 12-3456-788 from 1 July 2020.
"""


def marked_rows(text: str) -> list[tuple[list[str], list[str]]]:
    """Words and labels of the lines of ``text``, where ``[kind words]`` marks personal data."""
    rows = []
    for line in filter(None, text.split("\n")):
        words, labels = [], []
        for m in re.finditer(r"\[(email|ip|card|phone) ([^\]]*)\](\S*)|\S+", line):
            part = m[2].split() if m[1] else [m[0]]
            labels += ["B-" + m[1]] + ["I-" + m[1]] * (len(part) - 1) if m[1] else ["O"]
            words += [*part[:-1], part[-1] + (m[3] or "")]
        rows.append((words, labels))
    return rows


def labelled_rows(n: int = 400, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """``n`` sentences from patterns, with digits from a fixed random stream.

    Numbers that are no personal data (years, prices, versions, dates, times) are among them.
    """
    rng = random.Random(seed)
    words = "the of and call me at write to our office please see le la et de der die und el en por with reach number is contact mail from phone on for".split()

    def digits(k):
        return "".join(rng.choice("0123456789") for _ in range(k))

    def word():
        return "".join(rng.choice("abcdefghilmnoprstuvw") for _ in range(rng.randint(2, 9)))

    def email():
        local = rng.choice([word(), word() + "." + word(), word() + "_" + digits(2), word() + digits(2)])
        return [local + "@" + word() + rng.choice([".com", ".example.org", ".net", ".co.uk", digits(1) + ".example.com", ""])]

    def phone():
        return rng.choice([
            [f"+1", f"({digits(3)})", f"{digits(3)}-{digits(4)}"], [f"({digits(3)})", f"{digits(3)}-{digits(4)}"], [f"{digits(3)}-{digits(3)}-{digits(4)}"],
            [f"+{digits(2)}", digits(3), digits(3), digits(4)], [f"+{digits(2)}{digits(9)}"], [f"{digits(3)}.{digits(3)}.{digits(4)}"], [f"0{digits(2)}/{digits(7)}"],
        ])

    def card():
        return rng.choice([[digits(16)], [digits(4) for _ in range(4)], ["-".join(digits(4) for _ in range(4))], [digits(4), digits(6), digits(5)]])

    def ip():
        return [".".join(str(rng.randint(0, 255)) for _ in range(4))]

    def other():
        year, money = str(rng.randint(1500, 2099)), digits(rng.randint(1, 4))
        return rng.choice([
            [year], [money + "%"], ["$" + money], [f"v{digits(1)}.{digits(1)}.{digits(1)}"], [f"{digits(2)}:{digits(2)}"], [f"{year}-{digits(2)}-{digits(2)}"], [digits(rng.randint(1, 6))],
            [f"{digits(1)}.{digits(2)}"], [digits(2), digits(2)], [f"{digits(2)}/{digits(2)}/{year}"], ["#" + digits(4)], [word() + digits(2)], [digits(3), digits(3)], ["@" + word()],
            ["".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(8, 40)))], [word() + "=" + word() + digits(rng.randint(2, 12)) + word()],
        ])

    kinds = (("email", email), ("phone", phone), ("card", card), ("ip", ip), (None, other), (None, other))
    rows = []
    for k in range(n):
        tokens, labels = [], []
        for _ in range(rng.randint(1, 3)):
            for w in [rng.choice([rng.choice(words), word()]) for _ in range(rng.randint(1, 4))]:
                tokens.append(w)
                labels.append("O")
            kind, make = kinds[(k + rng.randint(0, 5)) % len(kinds)]
            part = make()
            labels += ["O"] * len(part) if kind is None else ["B-" + kind] + ["I-" + kind] * (len(part) - 1)
            part[-1] += rng.choice(["", "", "", ".", ",", "***"])
            tokens += part
        tokens.append(word())
        labels.append("O")
        rows.append((tokens, labels))
    return rows


def labelled_table(spark: SparkSession, n: int = 400) -> DataFrame:
    """The small labelled table: sentences labelled by hand, and ``n`` from patterns."""
    return spark.createDataFrame(marked_rows(HAND_LABELLED) + labelled_rows(n), "words array<string>, labels array<string>")


def trained(labelled: DataFrame, most_rows: int = 5000) -> Field:
    """The field fitted in the driver on at most ``most_rows`` labelled rows, the first by their hash.

    Without any labelled word the field adds nothing.
    """
    order = F.xxhash64("words", "labels")
    rows = labelled.select("words", "labels").orderBy(order, "words", "labels").limit(most_rows).collect()
    usable = [(list(r["words"]), list(r["labels"])) for r in rows if r["words"]]
    return Field.fit(usable) if usable else Field(np.zeros((FEATURES, len(LABELS)), np.float32), np.zeros((len(LABELS), len(LABELS)), np.float32))


_FOUND = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int>>"
_FOUND_NAMES = [part.split(" ")[0] for part in _FOUND.split(", ")]


def _scan(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            rows = []
            for base, added in spans_of([t.as_py() or "" for t in batch.column(1)], field):
                kinds = Counter(k for k, _, _ in base)
                spans = sorted(base + added)
                found = [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]
                rows.append((*(kinds[k] for k in range(4)), hashlib.sha256(written(base).encode()).hexdigest(), written(spans), found))
            n = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            text = [pa.array([r[k] for r in rows], pa.string()) for k in (4, 5)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *n, *text, pa.array([r[6] for r in rows], kind)], names=_FOUND_NAMES)

    return run


def personal_data(df: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and spans of personal data, one row per row of ``df``, in code points with the end exclusive.

    Row by row, without a shuffle; the field travels with the tasks (150 kB). A null text
    counts as an empty one, which has none. Null ids stay null, repeated rows give
    repeated rows, other columns are not looked at.
    """
    return df.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(_scan(field), _FOUND)
