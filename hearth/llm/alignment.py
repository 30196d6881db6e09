"""Cross-tokenizer alignment by an associative monoid of byte-range fragments.

Two tokenizers, A (byte-level pairs, JSON) and B (sentencepiece pieces), cut the same
bytes. A group lies between two neighbouring places where tokens of both end. A
fragment of a byte range is what its tokens say of the groups without knowing the
rest: an open prefix (the tokens up to the first common end), closed groups, and an
open suffix (the tokens after the last). Two neighbouring fragments make one: the
left suffix and the right prefix are cut again at their common ends, and what is
between these is closed. That product is associative, so the fragments of a long
text are made in any tasks and multiplied in a tree.

Texts up to ``CHUNK`` characters are one fragment, made in the task that reads them,
out of the fragments of their words: a single space between other characters ends a
token of both tokenizers, so words are closed, and a bounded table keeps those met
last. Longer texts are dealt out in parts, each tokenizer's part at a place that is
safe for it alone, and their fragments meet in rounds of ``FAN``; only the open
tokens travel, closed groups stay written where they were made.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, hot_values, map_batches, map_rows, once, salted_join, write_scratch

#: Characters of a text from which it is dealt out in parts of that size, and fragments multiplied by a task of the tree.
CHUNK, FAN = 65_536, 8
#: Words kept per worker process (in each of two generations), and the longest of them.
KEEP_WORDS, KEEP_CHARS = 250_000, 40
#: New words coded at a time.
JOIN_WORDS = 2000
#: Pairs of ids sent to the tasks with their counts; a larger table is joined instead (same results).
SEND_PAIRS = 2_000_000
MARK = "▁"
#: How byte-level tokenizers split a text before their merges (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A single space between other characters: a token of either tokenizer ends before it.
_WORD_END = re.compile(r"(?<=\S) (?=\S)")
#: Where a token of A ends for sure: before white space, or before a sign after a plain letter or digit.
_A_SAFE = re.compile(r"(?<=\S)(?=\s)|(?<=[0-9A-Za-zぁ-ゖァ-ヺ一-龥])(?=[.,;:!?。，、；：！？])")
#: Where a token of B ends for sure: before the first space of a run, and before a line end.
_B_SAFE = re.compile(r"(?<=[^ ])(?= )|(?=\n)")


def byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable bytes are their own character, the others follow from U+0100 in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


#: Words whose characters every library puts in the same classes: these may go through the faster one.
_LATIN = re.compile(r"[!-~À-ɏ]{1,200}(?:\n[!-~À-ɏ]{1,200}){0,4}")


def _as_ranks(a_json: str):
    """The vocabulary of A for the rank library, or None if the file is not plain byte-level pairs in order of their ids."""
    import tiktoken
    file = json.loads(a_json)
    model, split = file["model"], file["pre_tokenizer"] or {}
    vocabulary, special = model["vocab"], {t["content"] for t in file["added_tokens"]}
    merged = [vocabulary.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    if (model["type"], split.get("type"), split.get("add_prefix_space"), split.get("use_regex")) != ("BPE", "ByteLevel", False, True) \
            or file["normalizer"] or model.get("ignore_merges") or None in merged or merged != sorted(merged):
        return None
    byte = byte_of_character()
    return tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={},
                             mergeable_ranks={bytes(byte[c] for c in p): i for p, i in vocabulary.items() if p not in special})


class Tokenizers:
    """Both tokenizers and the bytes of their ids."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.ranks = _as_ranks(a_json)
        byte = byte_of_character()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte[c] for c in piece)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_bytes = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode())
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        if any(MARK in self.b.id_to_piece(i).lstrip(MARK) or "\n" in self.b.id_to_piece(i) for i in range(self.b.vocab_size())):
            raise ValueError("pieces of B reach over word marks or line ends")

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def encode_latin(self, texts: list[str]) -> list[list[int]]:
        """As ``encode_a``, for texts of words that match ``_LATIN``."""
        return [self.ranks.encode_ordinary(t) for t in texts] if self.ranks else self.encode_a(texts)

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1) if texts else []

    def spells(self, a: list[int], b: list[int], a_want: bytes, b_want: bytes) -> bool:
        """Whether the joined bytes are what they should be."""
        return b"".join(map(self.a_bytes.__getitem__, a)) == a_want and b"".join(map(self.b_bytes.__getitem__, b)) == b_want


@dataclass
class Tokens:
    """Ids and byte ends of a run of tokens of each tokenizer."""
    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    @staticmethod
    def none() -> Tokens:
        return Tokens(*(np.zeros(0, np.int64) for _ in range(4)))

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in ("a", "a_end", "b", "b_end")))

    def between(self, low: int, high: int) -> Tokens:
        """The tokens that end after ``low``, up to ``high``."""
        i, j = np.searchsorted(self.a_end, [low, high], "right")
        k, m = np.searchsorted(self.b_end, [low, high], "right")
        return Tokens(self.a[i:j], self.a_end[i:j], self.b[k:m], self.b_end[k:m])

    def cuts(self) -> np.ndarray:
        return np.intersect1d(self.a_end, self.b_end, assume_unique=True)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the overlapping pairs: each stretch between neighbouring ends of either kind lies in one token of each."""
        ends = np.union1d(self.a_end, self.b_end)
        return self.a[np.searchsorted(self.a_end, ends)], self.b[np.searchsorted(self.b_end, ends)]

    def groups(self, cuts: np.ndarray) -> list[str]:
        """Each group as text, ``cuts`` being their ends."""
        out, a, b = [], list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        i = k = 0
        for j, m in zip(np.searchsorted(self.a_end, cuts, "right").tolist(), np.searchsorted(self.b_end, cuts, "right").tolist(), strict=True):
            out.append(f"{a[i]}|{b[k]}" if j - i == 1 == m - k else f"{','.join(a[i:j])}|{','.join(b[k:m])}")
            i, k = j, m
        return out


@dataclass
class Fragment:
    """A byte range's open prefix, the runs of tokens that are closed, and the open suffix; without a cut all is suffix."""
    cut: bool
    prefix: Tokens
    closed: list[Tokens]
    suffix: Tokens

    @staticmethod
    def of(tokens: Tokens) -> Fragment:
        cuts = tokens.cuts()
        if not len(cuts):
            return Fragment(False, Tokens.none(), [], tokens)
        first, last = int(cuts[0]), int(cuts[-1])
        inner = [tokens.between(first, last)] if last > first else []
        return Fragment(True, tokens.between(-1, first), inner, tokens.between(last, 1 << 62))

    def __mul__(self, other: Fragment) -> Fragment:
        """This fragment and the one that follows it; the identity is the fragment of no tokens."""
        middle = Fragment.of(self.suffix + (other.prefix if other.cut else other.suffix))
        if not self.cut:
            return middle if not other.cut else Fragment(True, middle.prefix, middle.closed + other.closed, other.suffix)
        met = [middle.prefix, *middle.closed] if middle.cut else []
        return Fragment(True, self.prefix, self.closed + met + other.closed, other.suffix if other.cut else middle.suffix)


class WordTable:
    """Bounded table of words and what they add to a text; the older half goes when it is full."""

    def __init__(self, tokenizers: Tokenizers):
        self.t, self.now, self.old = tokenizers, {}, {}

    def _entries(self, words: list[str], a_ids: list[int], b_ids: list[int]) -> list[tuple] | None:
        """(tokens of A, the groups' text, codes of the links) of each of ``words``, out of the tokens of all, joined by spaces.

        Their groups and links are found in one go, as a word's end is a common end; None if the bytes or the ends differ.
        """
        t, want = self.t, [w.encode() for w in words]
        whole = b" " + b" ".join(want)
        if not t.spells(a_ids, b_ids, whole, whole):
            return None
        a, b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        run = Tokens(a, np.cumsum(t.a_size[a]), b, np.cumsum(t.b_size[b]))
        cuts, word_ends = run.cuts(), np.cumsum([len(w) + 1 for w in want])
        upto = np.searchsorted(cuts, word_ends, "right")
        if len(cuts) == 0 or (cuts[upto - 1] != word_ends).any():
            return None
        ends, (p, q) = np.union1d(run.a_end, run.b_end), run.links()
        told, codes = run.groups(cuts), p * len(t.b_bytes) + q
        n_a = np.diff(np.searchsorted(run.a_end, word_ends, "right"), prepend=0).tolist()
        out, g, l = [], 0, 0
        for x, h, m in zip(n_a, upto.tolist(), np.searchsorted(ends, word_ends, "right").tolist(), strict=True):
            out.append((x, told[g] if h == g + 1 else ";".join(told[g:h]), codes[l:m]))
            g, l = h, m
        return out

    def _measure(self, words: list[str]) -> dict[str, tuple | None]:
        """Entries of new words, None where the bytes differ. Words without white space at their ends are coded many at a time."""
        latin, others, alone, out = [], [], [], {}
        for w in words:
            (latin if _LATIN.fullmatch(w) else alone if w[:1].isspace() or w[-1:].isspace() else others).append(w)
        for some, encode in ((latin, self.t.encode_latin), (others, self.t.encode_a)):
            runs = [some[i:i + JOIN_WORDS] for i in range(0, len(some), JOIN_WORDS)]
            joined = [" ".join(r) for r in runs]
            for r, a, b in zip(runs, encode([f" {x}" for x in joined]), self.t.encode_b(joined), strict=True):
                got = self._entries(r, a, b)
                if got is None:
                    alone += r
                else:
                    out.update(zip(r, got, strict=True))
        for w, a, b in zip(alone, self.t.encode_a([f" {w}" for w in alone]), self.t.encode_b(alone), strict=True):
            got = self._entries([w], a, b)
            out[w] = got[0] if got else None
        return out

    def texts(self, texts: list[str]) -> Iterator[list[tuple] | None]:
        """The entries of each text's words, in order; None where the bytes differ."""
        cut = [_WORD_END.split(t) if t and MARK not in t else [] for t in texts]
        missing = set().union(*cut).difference(self.now)
        if len(self.now) + len(missing) > KEEP_WORDS:
            self.old, self.now = self.now, {}
            missing = set().union(*cut)
        for w in [w for w in missing if w in self.old]:
            self.now[w] = self.old[w]
            missing.discard(w)
        new, passing = list(missing), {}
        for w, entry in self._measure(new).items():
            (self.now if len(w) <= KEEP_CHARS else passing)[w] = entry
        for words in cut:
            got = [self.now[w] for w in words] if not passing else [self.now[w] if w in self.now else passing[w] for w in words]
            yield None if not got or None in got else got


def _sums(codes: np.ndarray) -> tuple[list[int], list[int]]:
    values, times = np.unique(codes, return_counts=True)
    return values, times.astype(np.int32)


NOTHING = (0, 0, 0, 0, "", (), ())
_ROW = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<long>, times array<int>"
_NAMES = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times")


def _tokenizers(sent) -> Tokenizers:
    return once(sent.value, "tokenizers", lambda: Tokenizers(sent.value["a"], sent.value["b"]))


def _short(texts: DataFrame, kind: str, sent) -> DataFrame:
    """Aligned rows of texts that one task holds as one fragment."""
    def run(parts: Iterator[dict]) -> Iterator[dict]:
        table = once(sent.value, "words", lambda: WordTable(_tokenizers(sent)))
        for p in parts:
            rows = []
            for got in table.texts([t or "" for t in p["text"]]):
                if got is None:
                    rows.append(NOTHING)
                    continue
                a, told, codes = zip(*got, strict=True)
                whole, every = ";".join(told), np.concatenate(codes)
                # no ends meet within a group, so it has one link less than tokens
                n_a, groups, links = sum(a), whole.count(";") + 1, len(every)
                rows.append((n_a, links + groups - n_a, groups, links, hashlib.sha256(whole.encode()).hexdigest(), *_sums(every)))
            yield {"doc_id": p["id"]} | dict(zip(_NAMES, map(list, zip(*rows, strict=True)), strict=True))
    return map_rows(texts, f"doc_id {kind}, {_ROW}", run)


def _parts_of(text: str, chunk: int) -> list[tuple[int, str, int, str]]:
    """(byte offset, part of space+text for A, byte offset, for B) in order: each begins at the first safe place from a multiple of ``chunk`` on."""
    whole = f" {text}"

    def edges(safe: re.Pattern) -> list[int]:
        out = [0]
        for at in range(chunk, len(whole), chunk):
            m = safe.search(whole, max(at, out[-1] + 1)) if at > out[-1] else None
            out.append(m.start() if m else (out[-1] if at <= out[-1] else len(whole)))
        return [*out, len(whole)]

    def cut(at: list[int]) -> list[tuple[int, str]]:
        parts, offset = [], 0
        for i, j in zip(at, at[1:], strict=False):
            parts.append((offset, whole[i:j]))
            offset += len(whole[i:j].encode())
        return parts
    return [(*x, *y) for x, y in zip(cut(edges(_A_SAFE)), cut(edges(_B_SAFE)), strict=True)]


_TOKENS = ("a", "a_end", "b", "b_end")
_OPEN = ("row string, idx int, cut boolean, " + ", ".join(f"{s}_{f} array<long>" for s in ("prefix", "suffix") for f in _TOKENS)
         + ", start long, n_a long, n_b long, n_groups long, n_links long, groups string, codes array<long>, times array<int>, good boolean")
_OPEN_NAMES = [x.split()[0] for x in _OPEN.split(", ")]


def _closed(runs: list[Tokens], wide: int) -> tuple:
    """(start, tokens of A, of B, groups, links, their text, codes, times) of closed runs in order."""
    told, codes, n_a, n_b = [], [], 0, 0
    for run in runs:
        told += run.groups(run.cuts())
        p, q = run.links()
        codes.append(p * wide + q)
        n_a, n_b = n_a + len(run.a), n_b + len(run.b)
    every = np.concatenate([*codes, np.zeros(0, np.int64)])
    values, times = _sums(every)
    start = int(runs[0].a_end[0]) if runs else 0
    return start, n_a, n_b, len(told), len(every), ";".join(told), values.tolist(), times.tolist()


def _fragment_rows(row: str, idx: int, made: Fragment, good: bool, wide: int) -> list[tuple]:
    """The open ends of a fragment, and a row for each run that has been closed in making it (these have no number)."""
    ends = (*(getattr(t, f).tolist() for t in (made.prefix, made.suffix) for f in _TOKENS),)
    runs = [(row, None, None, *([None] * len(ends)), *_closed([run], wide), good) for run in made.closed]
    return [(row, idx, made.cut, *ends, *_closed([], wide), good), *runs]


def _read_fragment(r) -> Fragment:
    prefix, suffix = (Tokens(*(np.array(r[f"{s}_{f}"], np.int64) for f in _TOKENS)) for s in ("prefix", "suffix"))
    return Fragment(bool(r["cut"]), prefix, [], suffix)


def _long(texts: DataFrame, kind: str, sent, wide: int, chunk: int, fan: int) -> DataFrame:
    """Aligned rows of long texts: parts, their fragments, the tree, and each text's closed groups in order."""
    def deal(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            for i, text in zip(p["id"], p["text"], strict=True):
                row, cut = uuid.uuid4().hex, _parts_of(text, chunk)   # a row's name: the table is written, so it is drawn once
                for at in range(0, len(cut), 64):
                    some = cut[at:at + 64]
                    yield {"row": [row] * len(some), "id": [i] * len(some), "idx": [*range(at, at + len(some))], "of": [len(cut)] * len(some),
                           **dict(zip(("a_at", "a_text", "b_at", "b_text"), map(list, zip(*some, strict=True)), strict=True))}
    dealt = write_scratch(map_rows(texts, f"row string, id {kind}, idx int, of int, a_at long, a_text string, b_at long, b_text string", deal), "parts")
    most = dealt.agg(F.max("of")).first()[0]

    def begin(parts: Iterator[dict]) -> Iterator[dict]:
        t = _tokenizers(sent)
        for p in parts:
            rows = []
            for row, i, a_at, a_text, b_at, b_text in zip(*(p[c] for c in ("row", "idx", "a_at", "a_text", "b_at", "b_text")), strict=True):
                a = t.encode_a([a_text])[0] if a_text else []
                # the library puts a mark before a part: it stands for the part's space, or, before a line end, is taken off
                b = [t.b.piece_to_id(MARK)] if b_text == " " else t.encode_b([b_text.removeprefix(" ")])[0] if b_text else []
                b = b[1:] if b_text[:1] == "\n" else b
                good = MARK not in a_text and t.spells(a, b, a_text.encode(), b_text.encode())
                x, y = np.array(a, np.int64), np.array(b, np.int64)
                made = Fragment.of(Tokens(x, a_at + np.cumsum(t.a_size[x]), y, b_at + np.cumsum(t.b_size[y])) if good else Tokens.none())
                rows += _fragment_rows(row, i, made, good, wide)
            yield dict(zip(_OPEN_NAMES, map(list, zip(*rows, strict=True)), strict=True))
    level = write_scratch(map_rows(dealt.select("row", "idx", "a_at", "a_text", "b_at", "b_text").repartition("row", "idx"), _OPEN, begin), "fragments")
    summed = ("row", "start", "n_a", "n_b", "n_groups", "n_links", "groups", "codes", "times", "good")
    closed = level.select(*summed)

    def multiply(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        made = Fragment.of(Tokens.none())
        for _, r in rows.iterrows():
            made = made * _read_fragment(r)
        if most <= 1:   # the whole text: its prefix begins where the text does
            made = Fragment(made.cut, Tokens.none(), [made.prefix, *made.closed], made.suffix)
        first = rows.iloc[0]
        good = len(made.suffix.a) + len(made.suffix.b) == 0 if most <= 1 else True
        return pd.DataFrame(_fragment_rows(first["row"], int(first["idx"]) // fan, made, good, wide), columns=_OPEN_NAMES)
    open_only = [c for c in _OPEN_NAMES if c not in summed or c == "row"]
    while True:
        most = -(-most // fan) if most else 1
        level = write_scratch(level.where("idx is not null").select(*open_only).groupBy("row", F.expr(f"idx div {fan}").alias("node")).applyInPandas(multiply, _OPEN), "fragments")
        closed = closed.unionByName(level.select(*summed))
        if most <= 1:
            break
    ids = dealt.where("idx = 0").select(F.col("row").alias("name"), F.col("id").alias("doc_id"))

    def finish(parts: Iterator[dict]) -> Iterator[dict]:
        """Closed runs of a text come in order of their place: their text is digested as it passes."""
        now, done = None, []

        def result() -> None:
            sha, n, some, codes, times, good = state
            codes, times = np.concatenate([*codes, np.zeros(0, np.int64)]), np.concatenate([*times, np.zeros(0, np.int64)])
            values, at = np.unique(codes, return_inverse=True)
            every = np.bincount(at, times, len(values)).astype(np.int64)
            done.append((now, *(n if good else [0] * 4), sha.hexdigest() if good and some else "", *((values.tolist(), every.tolist()) if good else ([], []))))
        for p in parts:
            for r in zip(*(p[c] for c in summed), strict=True):
                if r[0] != now:
                    if now is not None:
                        result()
                    now, state = r[0], [hashlib.sha256(), [0] * 4, False, [], [], True]
                if r[6]:
                    state[0].update((";" * state[2] + r[6]).encode())
                    state[2] = True
                state[1] = [x + y for x, y in zip(state[1], r[2:6], strict=True)]
                state[3].append(np.array(r[7], np.int64))
                state[4].append(np.array(r[8], np.int64))
                if len(state[3]) >= 64:   # a text's distinct pairs are all that is held of it
                    values, at = np.unique(np.concatenate(state[3]), return_inverse=True)
                    state[3:5] = [values], [np.bincount(at, np.concatenate(state[4]), len(values)).astype(np.int64)]
                state[5] = state[5] and r[9]
            if done:
                yield dict(zip(("row", *_NAMES), map(list, zip(*done, strict=True)), strict=True))
                done.clear()
        if now is not None:
            result()
            yield dict(zip(("row", *_NAMES), map(list, zip(*done, strict=True)), strict=True))
    ordered = closed.repartition("row").sortWithinPartitions("row", "start")
    made = map_rows(ordered, f"row string, {_ROW}", finish)
    return ids.join(made, F.col("name") == F.col("row")).select("doc_id", *_NAMES)


def _counted(aligned: DataFrame, wide: int) -> DataFrame:
    """``(code, n, best)`` of all pairs of ids: documents that hold the pair linked, and if no pair of its A id is in more."""
    pairs = write_scratch(aligned.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")), "pairs")
    first: Column = F.expr(f"code div {wide}")
    most = pairs.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return write_scratch(pairs.join(most, first == F.col("a")).select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pairs-rated")


def _with_counts(aligned: DataFrame, pairs: DataFrame, kind: str) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum``: by a table sent to the tasks if it is small, else by a join."""
    out = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    kept = [c for c in out if c not in ("n_best", "count_sum")]
    if pairs.count() <= SEND_PAIRS:
        got = pairs.toPandas().sort_values("code")   # SEND_PAIRS rows at most
        sent = aligned.sparkSession.sparkContext.broadcast(tuple(got[c].to_numpy() for c in ("code", "n", "best")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            code, n, best = sent.value
            for batch in batches:
                codes, times = batch.column("codes"), batch.column("times").flatten().to_numpy().astype(np.int64)
                at = np.searchsorted(code, codes.flatten().to_numpy())
                ends = np.concatenate([[0], np.cumsum(pc.list_value_length(codes).to_numpy())])
                upto = [np.concatenate([[0], np.cumsum(x[at] * times)])[ends] for x in (best, n)]
                yield {c: batch.column(c) for c in kept} | {"n_best": np.diff(upto[0]), "count_sum": np.diff(upto[1])}
        return map_batches(aligned, f"doc_id {kind}, " + ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in out[1:]), run)
    rows = aligned.withColumn("_at", F.monotonically_increasing_id())
    links = rows.select("_at", F.inline(F.arrays_zip("codes", "times"))).withColumnRenamed("codes", "code")
    sums = salted_join(links, pairs, "code", hot_values(pairs, "code", "n")).groupBy("_at").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    return rows.join(sums, "_at", "left").fillna(0, ["n_best", "count_sum"]).select(*out)


def align(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text",
          chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Null and empty texts, and texts whose tokens don't spell space+text (those that hold the word mark itself, say)
    have zeros and an empty digest. Repeated rows and rows of a null id are each returned and counted; extra columns
    are not read; an empty table gives an empty result. A stretch without a safe place (no space, line end or sign)
    is one part whatever its length. The files' contents travel with the tasks (about three megabytes).
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast({"a": a_json, "b": b_model})
    wide = Tokenizers(a_json, b_model).b.vocab_size()
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = write_scratch(_short(texts.where(~is_long), kind, sent), "aligned")
    long = write_scratch(_long(texts.where(is_long), kind, sent, wide, chunk, fan), "aligned-long")
    aligned = short.unionByName(long)
    return _with_counts(aligned, _counted(aligned, wide), kind)


def read_tokenizers(a_path: str, b_path: str) -> tuple[str, bytes]:
    """The contents of both vocabulary files, read on the driver."""
    with open(a_path, encoding="utf-8") as f:
        a = f.read()
    json.loads(a)
    with open(b_path, "rb") as f:
        return a, f.read()


by_value(__name__)
