"""Personal data: base patterns, and information-theoretic sanitisation of what stands around them.

Entities are found by pattern (e-mail, IP, card, phone). A term discloses a kind
of entity when the corpus shows that it comes with it: with N documents, n(t) of
them holding term t, n(e) an entity of a kind and s(t, e) an entity of that kind
with t in its window, the term carries

    PMI(t; e) = log(s(t, e) * N / (n(t) * n(e)))

of the entity's information IC(e) = log(N / n(e)). Where that share reaches
``threshold``, and the term is in at least ``support`` documents and stands by as
many distinct entities, it is generalised to its kind wherever it stands in an entity's window. Copies of a
text with a clue add to s(t, e) as they do to n(t), so that they don't hide it; as ``support`` counts
distinct entities, a phrase that is merely copied with an address is not taken for a clue.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, fresh, map_rows, write_scratch

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: The contract's patterns in a form that takes time in proportion to the text: a run of characters is entered at its
#: beginning only (no later place in it could match where that fails), and never given back.
_EMAIL_NAME = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@")
_EMAIL_HOST = re.compile(r"[A-Za-z0-9-]++\.[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,40}")
#: Terms on each side of an entity that form its window.
WINDOW = 5
#: Bits of the sieve that lets a term through to counting (fixed size, whatever the corpus).
SIEVE_BITS = 1 << 20
#: Distinct terms whose counts a task holds before it gives them out.
HELD_TERMS = 200_000


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of addresses: each has one @, so each run of name characters before one is tried once."""
    end = 0
    for m in _EMAIL_NAME.finditer(text):
        start = max(m.start(), end)   # a run may begin within the last address
        host = _EMAIL_HOST.match(text, m.end()) if start < m.end() - 1 else None
        if host:
            end = host.end()
            yield start, end


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text)
                if all(len(x) <= 3 and int(x or "0") <= 255 for x in (y.lstrip("0") for y in m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := "".join(_DIGIT.findall(m[0]))) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def covered(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans, given in order, cover together."""
    starts: list[int] = []
    ends: list[int] = []
    for _, a, b in spans:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def overlaps(taken: tuple[list[int], list[int]], x: int, y: int) -> bool:
    """Whether a place shares a character with a covered stretch: the last one that begins before its end."""
    i = bisect_left(taken[0], y) - 1
    return i >= 0 and taken[1][i] > x


def window_terms(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """The terms next to a span, lower-cased, with their places: up to ``WINDOW`` on either side in its line.

    A window reaches over at most 48 characters a term, so that it costs the same in a text of any length.
    """
    reach = 48 * WINDOW
    left = max(text.rfind("\n", max(0, start - reach), start) + 1, start - reach)
    right = text.find("\n", end, end + reach)
    before = [m for m in _TERM.finditer(text, left, start) if m.start() > left or left == 0 or not text[left - 1].isalpha()]
    after = list(_TERM.finditer(text, end, right if right >= 0 else min(len(text), end + reach)))
    return [(m[0].lower(), *m.span()) for m in before[-WINDOW:] + after[:WINDOW]]


def _hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term) >> 1


def _encountered(docs: DataFrame) -> DataFrame:
    """``(term, kind, value, n)``: hashes of entities and the terms in their windows, once for each slice of rows.

    Rows without a value count the slice's documents with the term in a window of the kind (term '': with the kind).
    """
    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            got: Counter = Counter()
            for text in p["text"]:
                spans, here = base_spans(text or ""), set()
                taken = covered(spans)
                for kind, a, b in spans:
                    value = _hash(text[a:b].lower())
                    here.add(("", kind, value))
                    here.update((t, kind, value) for t, x, y in window_terms(text, a, b) if not overlaps(taken, x, y))
                got.update({(t, k, None) for t, k, _ in here})
                got.update(dict.fromkeys(here, 0))
            if got:
                t, k, v = zip(*got, strict=True)
                yield {"term": list(t), "kind": list(k), "value": list(v), "n": list(got.values())}
    return map_rows(docs, "term string, kind string, value long, n long", run)


def _term_counts(docs: DataFrame, sieve: np.ndarray) -> DataFrame:
    """``(term, n)``: document counts of the terms that pass the sieve, and of all documents (term '').

    A task adds up its counts and gives them out when ``HELD_TERMS`` are at hand, and at its end.
    """
    sent = docs.sparkSession.sparkContext.broadcast(sieve)

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        bits = np.unpackbits(sent.value, bitorder="little")
        passes: dict[str, bool] = {}
        counts: Counter = Counter()
        for p in parts:
            counts[""] += len(p["text"])
            for text in p["text"]:
                for t in set(_TERM.findall((text or "").lower())):
                    ok = passes.get(t)
                    if ok is None:
                        if len(passes) >= 500_000:
                            passes.clear()
                        ok = passes[t] = bool(bits[_hash(t) % SIEVE_BITS])
                    if ok:
                        counts[t] += 1
            if len(counts) >= HELD_TERMS:
                yield {"term": list(counts), "n": list(counts.values())}
                counts.clear()
        yield {"term": list(counts), "n": list(counts.values())}
    return map_rows(docs, "term string, n long", run)


def disclosing_terms(docs: DataFrame, text_col: str = "text", threshold: float = 0.8, support: int = 5) -> DataFrame:
    """``(term, kind, share)``: terms whose information about a kind of entity reaches ``threshold`` of its own.

    Two passes over all texts. The first finds the terms in windows; the second counts documents for those only,
    let through by a sieve of fixed size (what passes by chance is dropped by the join). Counts are shuffled
    already added up by slice. No texts, no entities or no clues give an empty result.
    """
    texts = docs.select(F.col(text_col).alias("text"))
    met = write_scratch(_encountered(texts).groupBy("term", "kind", "value").agg(F.sum("n").alias("n")).groupBy("term", "kind").agg(
        F.sum("n").alias("s"), F.count("value").alias("entities")), "windows")
    clues = met.where((F.col("term") != "") & (F.col("entities") >= support))
    sieve = np.zeros(SIEVE_BITS, np.uint8)
    bucket = F.expr(f"pmod(hash, {SIEVE_BITS})")
    hashed = map_rows(clues.select("term").distinct(), "hash long",
                      lambda parts: ({"hash": [_hash(t) for t in p["term"]]} for p in parts))
    positions = hashed.select(bucket.alias("b")).distinct().toPandas()["b"].to_numpy()   # at most SIEVE_BITS numbers
    sieve[positions.astype(np.int64)] = 1
    counted = write_scratch(_term_counts(texts, np.packbits(sieve, bitorder="little")).groupBy("term").agg(
        F.sum("n").alias("n")), "terms")
    total = (counted.where("term = ''").first() or {"n": 0})["n"]
    kinds = {r["kind"]: r["s"] for r in met.where("term = ''").collect()}   # four rows at most
    if not total or not kinds:
        return clues.select("term", "kind", F.lit(0.0).alias("share")).limit(0)
    of_kind = F.create_map(*[x for k, n in kinds.items() for x in (F.lit(k), F.lit(float(n)))])
    share = (F.log(F.col("s") * float(total) / (F.col("n") * of_kind[F.col("kind")]))
             / F.greatest(F.log(F.lit(float(total)) / of_kind[F.col("kind")]), F.lit(math.log(2))))
    return clues.join(counted, "term").withColumn("share", share).where((F.col("share") >= threshold) & (F.col("n") >= support)).select(
        "term", "kind", "share")


#: Clues sent to the workers with the task; a larger table is joined to the windows instead.
SEND_TERMS = 50_000


def _span_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def term_windows(text: str) -> list[tuple[str, str, int, int]]:
    """(term, kind, start, end) of all terms in the windows of a text's entities, outside the entities."""
    base = base_spans(text)
    taken = covered(base)
    return [(t, kind, x, y) for kind, a, b in base for t, x, y in window_terms(text, a, b) if not overlaps(taken, x, y)]


def _in_order(base: list, terms: set[tuple[int, int]]) -> list[tuple[str, int, int]]:
    order = {k: i for i, k in enumerate((*KINDS, TERM))}
    return sorted([*base, *((TERM, x, y) for x, y in terms)], key=lambda s: (s[1], order[s[0]], s[2]))


class _Clues:
    """Which terms of a text are clues: by a table sent with the task, or by a column of places found by a join.

    Both give the same spans. Texts are joined by their digest, so that copies are looked up once.
    """

    def __init__(self, docs: DataFrame, terms: DataFrame, text_col: str):
        rows = terms.select("term", "kind").limit(SEND_TERMS + 1).collect()
        self.docs, self.column = docs, fresh(docs, "_clues")
        if len(rows) <= SEND_TERMS:
            table = {(r["term"], r["kind"]) for r in rows}
            self.sent = docs.sparkSession.sparkContext.broadcast(table)
            return
        self.sent = None

        def windows(parts: Iterator[dict]) -> Iterator[dict]:
            for p in parts:
                got = {(hashlib.md5(t.encode()).hexdigest(), *w) for t in p["text"] if t for w in term_windows(t)}
                if got:
                    yield dict(zip(("digest", "term", "kind", "a", "b"), map(list, zip(*got, strict=True)), strict=True))
        places = (map_rows(docs.select(F.col(text_col).alias("text")), "digest string, term string, kind string, a int, b int", windows)
                  .distinct().join(terms.select("term", "kind"), ["term", "kind"])
                  .groupBy("digest").agg(F.collect_set(F.struct("a", "b")).alias("places")))
        key = fresh(docs, "_digest")
        texts = places.select(F.col("digest").alias(key), F.col("places").alias(self.column))
        self.docs = docs.withColumn(key, F.md5(F.col(text_col))).join(texts, key, "left").drop(key)

    def spans(self):
        """A function of (text, joined places) -> (base spans, all spans), for use in a task."""
        sent = self.sent

        def of(text: str, places: list | None) -> tuple[list, list]:
            base = base_spans(text)
            if sent is None:
                found = {(x["a"], x["b"]) for x in places or ()}
            else:
                found = {(x, y) for t, k, x, y in term_windows(text) if (t, k) in sent.value} if sent.value and base else set()
            return base, _in_order(base, found)
        return of


def find(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, counts by kind and of terms, ``base_sha256``, and ``spans`` as text.

    Null and empty texts have no spans; repeated rows are each returned; extra columns are not read; an empty
    table gives an empty result.
    """
    clues = _Clues(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), terms, "text")
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    names, spans_of, column = [f"n_{k}" for k in (*KINDS, TERM)], clues.spans(), clues.column

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            out: dict[str, list] = {n: [] for n in (*names, "base_sha256", "spans")}
            for text, places in zip(p["text"], p.get(column) or [None] * len(p["text"]), strict=True):
                base, every = spans_of(text or "", places)
                kinds = Counter(k for k, _, _ in every)
                for k in (*KINDS, TERM):
                    out[f"n_{k}"].append(kinds[k])
                out["base_sha256"].append(hashlib.sha256(_span_text(base).encode()).hexdigest())
                out["spans"].append(_span_text(every))
            yield {"doc_id": p["id"]} | out
    return map_rows(clues.docs, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string", run)


def sanitised_text(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with its spans replaced by their kind in angle brackets; spans that overlap are one, named by the first."""
    if not text:
        return text
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, terms: DataFrame | None = None, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data generalised in ``text_col``; ``chars_col``, if there, counts the new text.

    Nulls stay null; all other columns pass through unchanged. Without ``terms`` they are estimated from ``docs``.
    """
    clues = _Clues(docs, disclosing_terms(docs, text_col) if terms is None else terms, text_col)
    spans_of, column = clues.spans(), clues.column

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            places = p.pop(column, None) or [None] * len(p[text_col])
            yield p | {text_col: [sanitised_text(t, spans_of(t, x)[1]) if t else t for t, x in zip(p[text_col], places, strict=True)]}
    out = map_rows(clues.docs, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), run)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return out


by_value(__name__)
