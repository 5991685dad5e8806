"""Encoding and decoding with a merge-type piece model, exact to its reference library."""

import hashlib
import re
import sys
import types
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"

# Segments kept with their ids in one worker, and token pairs with their verdicts.
_KNOWN_SEGMENTS = 250_000
_KNOWN_PAIRS = 400_000
_KNOWN_LENGTH = 64


class PieceEncoder:
    """Backtracking encoder for a merge-type model whose pieces carry the space in front only.

    A sequence of pieces is the merge result if every two neighbours are what their joined
    text merges to. So the encoder walks from the left with the longest piece at each place,
    goes back to shorter ones where neighbours do not fit, and marks places from which no
    end was reached. No piece spans the border before a space, so texts are cut there and
    frequent segments are looked up.
    """

    def __init__(self, model_file: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = self.library.get_piece_size()
        plain = [i for i in range(n) if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))]
        self.pieces = {self.library.id_to_piece(i): i for i in plain}
        self.texts = {i: p for p, i in self.pieces.items()}
        self.scores = {p: self.library.get_score(i) for p, i in self.pieces.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces) or any(c not in self.pieces for p in self.pieces for c in p):
            raise ValueError("pieces must carry spaces in front only, and every character in use must be a piece")
        self.characters = {p for p in self.pieces if len(p) == 1}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.automaton = ahocorasick.Automaton()
        self.size = n
        self.lengths, self.shorter = [0] * n, [-1] * n
        for p, i in self.pieces.items():
            self.automaton.add_word(p, (i, len(p) - 1))
            self.lengths[i] = len(p)
            self.shorter[i] = next((self.pieces[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.pieces), -1)
        self.automaton.make_automaton()
        self.segments: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def merge(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, the leftmost of equals, until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def judge(self, left: int, right: int) -> bool:
        """Whether two pieces are what their joined text merges to; with -1 in front, whether a piece stands alone."""
        a, b = [self.texts[left]] if left >= 0 else [], self.texts[right]
        verdict = self.merge("".join([*a, b])) == [*a, b]
        if len(self.pairs) >= _KNOWN_PAIRS:
            self.pairs.clear()
        self.pairs[(left + 1) * self.size + right] = verdict
        return verdict

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        # Matches come by their ends, so the longest one from a place is the last.
        longest = {end - rest: piece for end, (piece, rest) in self.automaton.iter(text)}
        lengths, shorter, known, size = self.lengths, self.shorter, self.pairs, self.size
        failed = bytearray(len(text) // 8 + 1)
        path: list[int] = []
        at, piece, last = 0, longest[0], -1
        while at < len(text):
            while piece >= 0:
                end = at + lengths[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    fit = known.get((last + 1) * size + piece)
                    if self.judge(last, piece) if fit is None else fit:
                        break
                piece = shorter[piece]
            if piece >= 0:
                path.append(piece)
                at, last = end, piece
                piece = longest.get(at, -1)
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = path.pop()
                at -= lengths[piece]
                piece, last = shorter[piece], path[-1] if path else -1
        return path

    def segment(self, text: str) -> bytes:
        if self.characters.issuperset(text):
            return np.array(self.backtrack(text), "<u4").tobytes()
        ids: list[int] = []
        start = 0
        for k, c in enumerate(text):
            if c not in self.pieces:
                if k > start:
                    ids += self.backtrack(text[start:k])
                ids += [self.bytes[b] for b in c.encode()]
                start = k + 1
        if start < len(text):
            ids += self.backtrack(text[start:])
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, four little-endian bytes each."""
        known, out = self.segments, []
        if text:
            for part in self.cut.findall(SPACE + text.replace(" ", SPACE)):
                ids = known.get(part)
                if ids is None:
                    ids = self.older.get(part) or self.segment(part)
                    if len(part) <= _KNOWN_LENGTH:
                        if len(known) >= _KNOWN_SEGMENTS:  # what was not met since the last turn is forgotten
                            self.older = known
                            known = self.segments = {}
                        known[part] = ids
                out.append(ids)
        ends = np.array([self.begin, self.end], "<u4").tobytes()
        return ends[:4] + b"".join(out) + ends[4:]

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


def _encoder(model_file: str) -> PieceEncoder:
    """One encoder per worker process and model; what it has learnt serves the next task."""
    kept = sys.modules.setdefault("_sparkloom_kept", types.ModuleType("_sparkloom_kept")).__dict__
    if model_file not in kept:
        kept[model_file] = PieceEncoder(model_file)
    return kept[model_file]


def _encode(model_file: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_file)
        for batch in batches:
            ids, sizes, id_digests, text_digests = [], [], [], []
            for text in batch.column(1):
                packed = encoder.encode(text.as_py() or "")
                sizes.append(len(packed) // 4)
                id_digests.append(hashlib.sha256(packed).hexdigest())
                text_digests.append(hashlib.sha256(encoder.decode(packed).encode()).hexdigest())
                if keep_ids:
                    ids.append(np.frombuffer(packed, "<u4").astype(np.int32))
            columns = [batch.column(0), *([pa.array(ids, pa.list_(pa.int32()))] if keep_ids else []), pa.array(sizes, pa.int64()), pa.array(id_digests), pa.array(text_digests)]
            names = ["doc_id", *(["ids"] if keep_ids else []), "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([c.cast(pa.string()) if pa.types.is_null(c.type) else c for c in columns], names=names)

    return run


def encoded(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Rows ``(doc_id, ids, n_tokens, ids_sha256, decoded_sha256)``, one per row of ``df``.

    Row by row, without a shuffle. ``model_file`` must be readable under this path on every executor.
    A null text counts as an empty one, which has the begin and end ids only. Null ids stay
    null, repeated rows give repeated rows, other columns are not looked at.
    ``keep_ids=False`` leaves the ids out where digests are enough.
    """
    schema = "doc_id bigint, " + ("ids array<int>, " if keep_ids else "") + "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return df.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(_encode(model_file, keep_ids), schema)
