"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

Symbols are the characters of the text; adjacent pairs whose joined text is a
piece wait in an agenda ordered by score, then position. The best pair is merged,
its new neighbours enter the agenda, and entries whose symbols have changed since
are skipped. Symbols that end up outside the vocabulary become byte pieces.

No piece holds a word mark after another character, so merges never cross the
start of a marked word (nor a line end, which is in no piece): the agenda runs per
word, and a bounded table keeps the words met last, from one task of a worker to the next. Every text is also
encoded and decoded by the ``sentencepiece`` library; a difference fails the task.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, map_batches, map_rows, once

MARK = "▁"
#: Words kept per worker (in each of two generations), with their ids.
KEEP_WORDS = 600_000
#: Kinds of pieces in the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def _fields(data: bytes) -> list[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message; lengths and varints only as the model file needs them."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at
    out, at = [], 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            n, at = varint(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at:at + n], at + n
        out.append((tag >> 3, value))
    return out


class Vocabulary:
    """Pieces, scores and flags of a model file; only BPE with identity normalisation is taken."""

    def __init__(self, model: bytes):
        top = _fields(model)
        self.pieces, self.scores, self.kinds = [], [], []
        for _, value in (x for x in top if x[0] == 1):
            f = dict(_fields(value))
            self.pieces.append(f[1].decode())
            self.scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
            self.kinds.append(f.get(3, NORMAL))
        trainer, rules = (dict(_fields(next((v for k, v in top if k == n), b""))) for n in (2, 3))
        if trainer.get(3, 1) != BPE:
            raise ValueError("the model is not of the merge type")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1) or USER in self.kinds or UNUSED in self.kinds:
            raise ValueError("the model normalises texts or has user-defined or unused pieces")
        self.prefix = bool(rules.get(3, 1))
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_surface = trainer.get(44, " ⁇ ".encode()).decode() if isinstance(trainer.get(44), bytes) else " ⁇ "
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}
        byte = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.byte_ids = [byte[b] for b in range(256)] if len(byte) == 256 else None
        self.cut_lines = not any("\n" in p for p in self.ids)
        if not self.prefix or MARK not in self.ids or any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("words can't be told apart by their marks")

    def merge(self, word: str) -> list[int]:
        """Ids of one marked word by the agenda."""
        ids, scores = self.ids, self.scores
        whole = list(word)
        n = len(whole)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            joined = whole[left] + whole[right]
            i = ids.get(joined)
            if i is not None:
                heappush(agenda, (-scores[i], left, right, joined))
        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, joined = heappop(agenda)
            if not whole[left] or not whole[right] or len(whole[left]) + len(whole[right]) != len(joined):
                continue   # a symbol of this pair has been merged meanwhile
            whole[left], whole[right] = joined, ""
            end = after[left] = after[right]
            if end < n:
                before[end] = left
                offer(left, end)
            if before[left] >= 0:
                offer(before[left], left)
        out: list[int] = []
        for s in whole:
            if s:
                i = ids.get(s)
                if i is not None:
                    out.append(i)
                elif self.byte_ids is not None:
                    out += [self.byte_ids[b] for b in s.encode()]
                elif not out or out[-1] != self.unknown:
                    out.append(self.unknown)
        return out

    def words(self, text: str) -> list[str]:
        """The text with marks for spaces, cut before each mark that follows another character."""
        if not text:
            return []
        marked = text.replace(" ", MARK)
        return _CUT[self.cut_lines].findall(MARK + marked if self.prefix else marked)

    def spaced(self, text: str) -> list[str]:
        """``words`` with spaces for marks, as they decode."""
        if not text:
            return []
        plain = text.replace(MARK, " ")
        return _CUT_SPACED[self.cut_lines].findall(" " + plain if self.prefix else plain)

    def encode(self, text: str) -> list[int]:
        return [i for w in self.words(text) for i in self.merge(w)]

    def surface(self) -> list[bytes | int | None]:
        """For decoding: a piece's text, the byte that it stands for, or None for a control piece.

        The unknown piece's text is told apart by a sign, as its leading space is never taken for the prefix.
        """
        out: list[bytes | int | None] = []
        for p, k in zip(self.pieces, self.kinds, strict=True):
            out.append(int(p[1:-1], 16) if k == BYTE else None if k == CONTROL else
                       UNKNOWN_SIGN + self.unknown_surface.encode() if k == UNKNOWN else p.replace(MARK, " ").encode())
        return out


#: Words; a line end, when no piece has one, is a word by itself.
_CUT = {False: re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), True: re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")}
_CUT_SPACED = {lines: re.compile(cut.pattern.replace(MARK, " ")) for lines, cut in _CUT.items()}
#: What a byte that is not part of a character decodes to (fixed value).
_LOST = "�"
UNKNOWN_SIGN = b"\0unknown"


def decode_bytes(run: bytes) -> str:
    """A run of byte pieces: whole characters as they are, every other byte as one replacement character."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at:at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(_LOST)
            at += 1
    return "".join(out)


def join_surface(parts: list[bytes | int | None], prefix: bool) -> str:
    """Text of pieces' surfaces: byte runs are read as UTF-8, controls vanish, the first piece loses the prefix's space."""
    out, run, first = [], bytearray(), True
    for p in parts:
        if isinstance(p, int):
            run.append(p)
            first = False
            continue
        if run:
            out.append(decode_bytes(bytes(run)))
            run = bytearray()
        if p is not None:
            out.append(p[1:].decode() if first and prefix and p[:1] == b" " else p.removeprefix(UNKNOWN_SIGN).decode())
            first = False
    if run:
        out.append(decode_bytes(bytes(run)))
    return "".join(out)


class WordAgenda:
    """The agenda of many words at once: a row per word, a column per symbol, the best pair of every row each round.

    ``rank`` orders pairs by score (equal scores share a rank, the leftmost pair wins), so each round merges in
    every word the pair that its own agenda would give next. Words of one length are merged together: every row
    that still has a pair loses one symbol a round, so the table has no empty columns. A pair is found at its left
    symbol's ``base`` plus its right symbol; bases are dealt so that no two pairs share a place, where ``pair`` has
    the left symbol and the rank.
    """

    NONE = np.int32(2**31 - 1)
    #: Longest words merged in tables; longer ones go through ``Vocabulary.merge``.
    LONGEST = 32

    def __init__(self, v: Vocabulary):
        self.v = v
        symbol = dict(v.ids)
        for p in v.ids:
            for c in p:
                symbol.setdefault(c, len(v.pieces) + len(symbol))
        other = max(symbol.values()) + 1   # any character of no piece: a symbol that no pair has
        points = {ord(p): i for p, i in symbol.items() if len(p) == 1}
        self.char = np.full(max(points) + 2, other, np.int32)   # the last place is for every higher character
        self.char[list(points)] = list(points.values())
        ordered = sorted({-v.scores[i] for i in v.ids.values()})
        rank = dict(zip(ordered, range(len(ordered)), strict=True))
        rows: dict[int, list[tuple[int, int]]] = {}
        for p, i in v.ids.items():
            for k in range(1, len(p)):
                if p[:k] in symbol and p[k:] in symbol:
                    rows.setdefault(symbol[p[:k]], []).append((symbol[p[k:]], i))
        self._deal(rows, other, {i: rank[-v.scores[i]] for i in v.ids.values()})

    def _deal(self, rows: dict[int, list[tuple[int, int]]], other: int, rank: dict[int, int]) -> None:
        """Bases and places of all pairs, the left symbols with most pairs first; the room grows until all of a row's places are free."""
        room = 4 * sum(map(len, rows.values())) + 1
        draw, taken = np.random.default_rng(0), np.zeros(room + other, bool)
        self.base = np.zeros(other + 1, np.int32)
        for left, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
            rights, tries = np.array([right for right, _ in row]), 0
            while taken[(at := int(draw.integers(room)) + rights)].any():
                tries += 1
                if tries % 64 == 0:
                    room, taken = 2 * room, np.concatenate([taken, np.zeros(room, bool)])
            taken[at] = True
            self.base[left] = at[0] - rights[0]
        self.pair = np.full(int(self.base.max()) + other + 1, -1, np.int64)
        self.merged = np.zeros(len(self.pair), np.int32)
        for left, row in rows.items():
            at = self.base[left] + np.array([right for right, _ in row])
            self.pair[at], self.merged[at] = [left << 32 | rank[i] for _, i in row], [i for _, i in row]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = self.pair[self.base[left] + right]
        return np.where(pair >> 32 == left, pair.astype(np.int32), self.NONE)

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of every word, as ``Vocabulary.merge`` gives them, four bytes each."""
        out, lengths = [b""] * len(words), np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == n).tolist()
            some = [words[i] for i in rows]
            ids = self._merge(some, n) if 0 < n <= self.LONGEST else [array("i", self.v.merge(w)).tobytes() for w in some]
            for i, x in zip(rows, ids, strict=True):
                out[i] = x
        return out

    def _spell(self, word: str, ids: list[int]) -> list[int]:
        """Byte pieces (or the unknown piece) for symbols outside the vocabulary, found again by their place."""
        out, at = [], 0
        for i in ids:
            if i < len(self.v.pieces):
                out.append(i)
                at += len(self.v.pieces[i])
            else:
                c, at = word[at], at + 1
                if self.v.byte_ids is not None:
                    out += [self.v.byte_ids[b] for b in c.encode()]
                elif not out or out[-1] != self.v.unknown:
                    out.append(self.v.unknown)
        return out

    def _merge(self, words: list[str], n: int) -> list[bytes]:
        """``merge`` of words of ``n`` characters each."""
        out = [b""] * len(words)

        def put(where: np.ndarray, s: np.ndarray) -> None:
            odd, flat, step = (s >= len(self.v.pieces)).any(1).tolist(), s.tobytes(), 4 * s.shape[1]
            for k, (i, o) in enumerate(zip(where.tolist(), odd, strict=True)):
                out[i] = array("i", self._spell(words[i], s[k].tolist())).tobytes() if o else flat[k * step:(k + 1) * step]
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), n)
        s = self.char[np.minimum(points, len(self.char) - 1)]
        r, where = self._rank(s[:, :-1], s[:, 1:]), np.arange(len(words))
        while r.shape[1]:
            j, rows = r.argmin(1), np.arange(len(where))
            live = r[rows, j] < self.NONE
            if not live.all():
                put(where[~live], s[~live])
                s, r, j, where = s[live], r[live], j[live], where[live]
                rows = rows[:len(where)]
            new = self.merged[self.base[s[rows, j]] + s[rows, j + 1]]
            s[rows, j] = new
            left, right = np.ones(s.shape, bool), np.ones(r.shape, bool)
            left[rows, j + 1] = right[rows, j] = False
            s, r = s[left].reshape(len(rows), s.shape[1] - 1), r[right].reshape(len(rows), r.shape[1] - 1)
            has = np.flatnonzero(j < r.shape[1])
            r[has, j[has]] = self._rank(new[has], s[has, j[has] + 1])
            has = np.flatnonzero(j > 0)
            r[has, j[has] - 1] = self._rank(s[has, j[has] - 1], new[has])
        put(where, s)
        return out


class WordTable:
    """Bounded table of words and their ids (four bytes each). The older half goes when it is full."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.surface, self.agenda = vocabulary, vocabulary.surface(), WordAgenda(vocabulary)
        #: The pieces' texts; byte pieces and the like have none alone and are ``partial``.
        self.plain = [p.decode() if isinstance(p, bytes) and not p.startswith(UNKNOWN_SIGN) else "" for p in self.surface]
        self.lengths = np.fromiter(map(len, self.plain), np.int64, len(self.plain))
        self.partial = self.lengths == 0
        #: Digits of every id, with a comma.
        self.digits = np.array([f"{i},".encode() for i in range(len(vocabulary.pieces))])
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        #: What those words decode to that don't decode to themselves.
        self.odd: dict[str, str] = {}

    def texts(self, texts: list[str | None]) -> Iterator[tuple[int, str, str, np.ndarray]]:
        """Per text: count of ids, the ids' digits, the decoded text, the ids. Every word is looked up once, however often it comes."""
        plain = [(" " if self.v.prefix else "") + t.replace(MARK, " ") if t else "" for t in texts]
        words, ends = self._cut(plain)
        coded = words.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = self._found(names)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        each, begin, index = np.frombuffer(b"".join(found), np.int32), np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        upto = np.concatenate([[0], np.cumsum(sizes[index])])
        ids = each[np.repeat(begin[index] - upto[:-1], sizes[index]) + np.arange(upto[-1])]
        digits, odd, at = self.digits[ids], {w: self.odd[w] for w in names if w in self.odd} if self.odd else {}, 0
        for t, p, end in zip(texts, plain, upto[ends].tolist(), strict=True):
            text = "".join(odd.get(w, w) for w in self.v.spaced(t or "")) if odd else p
            text = text[1:] if self.v.prefix and text[:1] == " " else text
            yield end - at, digits[at:end].tobytes().translate(None, b"\0")[:-1].decode(), text, ids[at:end]
            at = end

    def _cut(self, plain: list[str]) -> tuple[pa.StringArray, np.ndarray]:
        """Words of all texts in one array, as ``Vocabulary.spaced`` cuts them, and the number of words up to each text's end."""
        _, ends, data = pa.array(plain, pa.string()).buffers()
        ends = np.frombuffer(ends, np.int32)[:len(plain) + 1]
        raw = np.frombuffer(data, np.uint8)[:ends[-1]] if ends[-1] else np.zeros(0, np.uint8)
        start, space = np.zeros(len(raw) + 1, bool), raw == ord(" ")
        start[:-1] = space
        start[1:-1] &= ~space[:-1]
        if self.v.cut_lines:
            line = raw == ord("\n")
            start[:-1] |= line
            start[1:] |= line
        start[ends] = True
        at = np.flatnonzero(start).astype(np.int32)
        words = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)])
        return words, np.searchsorted(at, ends[1:])

    def _found(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words, which are entered where they are not known."""
        found = list(map(self.now.get, words))
        missing = [w for w, g in zip(words, found, strict=True) if g is None]
        if not missing:
            return found
        if len(self.now) + len(missing) > KEEP_WORDS:
            self.old, self.now = self.now, {}
            self.odd = {w: t for w, t in self.odd.items() if w in self.old}
        entered = iter(self._enter(missing))
        return [next(entered) if g is None else g for g in found]

    def _enter(self, missing: list[str]) -> list[bytes]:
        """The ids of words that the younger half lacks, entered there."""
        found = list(map(self.old.get, missing))
        new = [w for w, g in zip(missing, found, strict=True) if g is None]
        made = self.agenda.merge([w.replace(" ", MARK) for w in new])
        self._decode(new, made)
        entered = iter(made)
        found = [next(entered) if g is None else g for g in found]
        self.now.update(zip(missing, found, strict=True))
        return found

    def _decode(self, words: list[str], made: list[bytes]) -> None:
        """Decodes new words, all pieces in one pass, and keeps the texts that are not the words themselves."""
        ids = np.frombuffer(b"".join(made), np.int32)
        ends = np.cumsum(np.fromiter(map(len, made), np.int64, len(made)) // 4)
        text = "".join(map(self.plain.__getitem__, ids.tolist()))
        upto, parts = (np.concatenate([[0], np.cumsum(x[ids])[ends - 1]]).tolist() for x in (self.lengths, self.partial))
        for k, w in enumerate(words):
            if parts[k] < parts[k + 1]:   # a word's byte pieces spell whole characters, so its text stands alone
                whole = join_surface([self.surface[i] for i in array("i", made[k])], False)
            else:
                whole = text[upto[k]:upto[k + 1]]
            if whole != w:
                self.odd[w] = whole


def entry_ids(got: np.ndarray) -> bytes:
    """Ids of a text, four bytes each."""
    return got.tobytes()


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
           ) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens, ids, ids_sha256, decoded, decoded_sha256``.

    ``ids`` and ``decoded`` are null unless ``with_ids``. Null and empty texts have no ids and decode to the
    empty text; repeated rows are each returned; extra columns are not read; an empty table gives an empty
    result. ``model`` is the model file's content (half a megabyte: it travels with the task).
    """
    sc = docs.sparkSession.sparkContext
    sent, kept = sc.broadcast(model), sc.broadcast({})

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        import sentencepiece
        table = once(kept.value, "words", lambda: WordTable(Vocabulary(sent.value)))
        library = once(kept.value, "library", lambda: sentencepiece.SentencePieceProcessor(model_proto=sent.value))
        sha = hashlib.sha256
        for p in parts:
            texts = p.column("text").to_pylist()
            out: dict[str, list] = {n: [] for n in ("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")}
            for text, (n, digits, back, got) in zip(texts, table.texts(texts), strict=True):
                if text:
                    theirs = library.encode(text)
                    if array("i", theirs).tobytes() != entry_ids(got) or back != library.decode(theirs):
                        raise ValueError(f"ids or text differ from the library's: {text[:200]!r}")
                out["n_tokens"].append(n)
                out["ids"].append(got if with_ids else None)
                out["ids_sha256"].append(sha(digits.encode()).hexdigest())
                out["decoded"].append(back if with_ids else None)
                out["decoded_sha256"].append(sha(back.encode()).hexdigest())
            yield {"doc_id": p.column("id").to_pylist()} | out
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                       f"doc_id {kind}, n_tokens long, ids array<int>, ids_sha256 string, decoded string, decoded_sha256 string", run)


def decode(rows: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, decoded)`` of a column of id lists; null decodes to the empty text."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        vocabulary = Vocabulary(sent.value)
        surface = vocabulary.surface()
        for p in parts:
            yield {"doc_id": p["id"], "decoded": [join_surface([surface[i] for i in ids or []], vocabulary.prefix) for ids in p["ids"]]}
    kind = rows.select(id_col).schema[0].dataType.simpleString()
    return map_rows(rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")), f"doc_id {kind}, decoded string", run)


by_value(__name__)
