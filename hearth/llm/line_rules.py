"""Quality rules, line first: judge each line, drop the failing ones, reject texts that lose too much.

A line fails if it is mostly symbols (punctuation), a row of separated short
items (navigation), shouted, a stutter of one word, of a known kind of boilerplate,
or (from four words on) the same as an earlier line of the document. A text that keeps fewer
than ``keep_share`` of its words, or that fails the base rules (too few words, or
more than half of its words in repeated three-word windows), is rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, map_rows

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_SEPARATED = re.compile(r"(?:^|[\x20\x09])(?:\||›|»|·|•|/|>)(?=[\x20\x09]|$)")
#: Lines that are notices of a site, not text (fixed values, matched as whole lower-cased lines): openings that prose may
#: share count in short lines only, notices in lines up to a long sentence, filler text in lines of any length.
_BOILERPLATE = tuple((words, re.compile(pattern)) for words, pattern in (
    (12, r"(?:click here.*|read more.*|sign (?:in|up)(?: .{0,30})?|log ?in|subscribe(?: .{0,40})?|share (?:on|this).*)"),
    (60, r"(?:cookie (?:policy|settings).*|accept (?:all )?cookies.*|(?:this|our) (?:web ?site|site) uses cookies.*|all rights reserved.*|"
         r"copyright (?:\(c\)|©).*|©.*|privacy policy.*|terms (?:of (?:use|service)|and conditions).*|please enable javascript.*)"),
    (None, r".*\blorem ipsum\b.*"),
))


@dataclass(frozen=True)
class LineRules:
    """Limits. A text is rejected when its kept lines hold less than ``keep_share`` of its words."""
    symbols_per_word: float = 0.5
    separators_per_word: float = 0.15
    shouted_words: int = 4
    shouted_share: float = 0.6
    stutter_words: int = 6
    stutter_share: float = 0.4
    repeated_words: int = 4
    keep_share: float = 0.5
    least_words: int = 50
    repeat_percent: int = 50


def line_fails(line: str, words: list[str], rules: LineRules) -> str | None:
    """Name of the rule that a line with words fails, if any."""
    n = len(words)
    if len(_SEPARATED.findall(line)) > rules.separators_per_word * n and n >= 3:
        return "navigation"
    if len(_SYMBOLS.findall(line)) > rules.symbols_per_word * n:
        return "punctuation"
    if n >= rules.shouted_words and sum(map(str.isupper, words)) > rules.shouted_share * n:
        return "shouting"
    if n >= rules.stutter_words and sum(a == b for a, b in zip(words, words[1:], strict=False)) > rules.stutter_share * n:
        return "stutter"
    low = line.strip().lower()
    if any((most is None or n <= most) and pattern.fullmatch(low) for most, pattern in _BOILERPLATE):
        return "boilerplate"
    return None


def repeated_words(words: list[str]) -> int:
    """Words that lie in a three-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    again = Counter(windows)
    if len(again) == len(windows):
        return 0
    marked, end = 0, 0
    for i, w in enumerate(windows):
        if again[w] > 1:
            marked += i + 3 - max(i, end)
            end = i + 3
    return marked


def judge(text: str | None, rules: LineRules = LineRules()) -> dict:
    """Counts, verdict and cleaned text of one document."""
    text = text or ""
    seen: set[str] = set()
    n_words = word_chars = dup_lines = kept_words = 0
    words: list[str] = []
    kept_lines, failed = [], Counter()
    for line in text.split("\n"):
        own = _WORDS.findall(line)
        if not own:
            kept_lines.append(line)
            continue
        n_words += len(own)
        words += own
        repeated = line in seen
        dup_lines += repeated
        seen.add(line)
        why = "repeated" if repeated and len(own) >= rules.repeated_words else line_fails(line, own, rules)
        if why:
            failed[why] += 1
        else:
            kept_words += len(own)
            kept_lines.append(line)
    word_chars = sum(map(len, words))
    repeats = repeated_words(words)
    base_failed = n_words < rules.least_words or 100 * repeats > rules.repeat_percent * n_words
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": len(_SYMBOLS.findall(text)),
            "n_dup_lines": dup_lines, "n_repeat_words": repeats, "base_failed": base_failed,
            "kept": not base_failed and kept_words >= rules.keep_share * n_words,
            "n_kept_words": kept_words, "n_failed_lines": sum(failed.values()),
            "cleaned": "\n".join(kept_lines) if failed else text}


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: LineRules = LineRules(),
                    with_text: bool = False) -> DataFrame:
    """Per row: ``doc_id``, the counts, ``base_failed, kept, n_kept_words, n_failed_lines`` (and ``cleaned``).

    Null and empty texts have no words and fail the base rules. Repeated rows are judged alike; extra columns
    are not read; an empty table gives an empty result. One pass over the texts, no shuffle.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_kept_words", "n_failed_lines"]
    fields += ["cleaned"] * with_text

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            found = [judge(t, rules) for t in p["text"]]
            yield {"doc_id": p["id"]} | {f: [x[f] for x in found] for f in fields}
    return map_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                    f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                    "base_failed boolean, kept boolean, n_kept_words long, n_failed_lines long" + ", cleaned string" * with_text, run)


def clean(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` without rejected rows and without failing lines; ``chars_col``, if there, counts the cleaned text.

    The other columns pass through unchanged, whatever their names.
    """
    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for p in parts:
            found = [judge(t, rules) for t in p[text_col]]
            keep = [i for i, x in enumerate(found) if x["kept"]]
            out = {c: [v[i] for i in keep] for c, v in p.items()}
            out[text_col] = [found[i]["cleaned"] for i in keep]
            yield out
    out = map_rows(docs, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), run)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return out


by_value(__name__)
