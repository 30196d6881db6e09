"""Secret scans over an incremental blob ledger.

Every historical version of a text is addressed by its content: a blob is the
SHA-256 of its UTF-8 bytes, whatever paths or versions hold it. The ledger is a
table of findings per (blob, version of the rules). A scan reads only the blobs
that the ledger has no row for under the present rules, each of them once, adds
their findings, and joins the findings of all blobs back to every path.

Which blobs repeat or are known is told to the readers of the texts by a sieve of
fixed size: a blob whose bit is clear is new and stands alone, so it is scanned
where its text lies. The texts of the others meet an exact table of the chosen
versions, one a blob.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, hot_values, map_rows, salted_join, write_scratch

#: Bits of the sieve (fixed size, whatever the corpus): a twenty-bit prefix of the digest is the place.
SIEVE_DIGITS = 5
SIEVE_BITS = 16 ** SIEVE_DIGITS
LEDGER = "blob string, n_assign long, n_access long, n_hex long, n_added long, base_sha256 string, spans string, rules string"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, the literals of which one is in every match (lower-cased text), and the least length of a group."""
    kind: str
    pattern: str
    needs: tuple[str, ...] = ()
    group: int = 0
    least: int = 1
    base: bool = False


_ANY_CASE = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
#: Base kinds, in the order of their contract (fixed values).
BASE = (
    Rule("assign", rf"({_ANY_CASE})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         ("passw", "secret", "token", "apikey", "api_key"), group=2, least=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", ("akia",), least=20, base=True),
    Rule("hex", r"[0-9a-f]{24,}", least=24, base=True),   # the runs are whole ones: shorter runs are dropped by their length
)
#: Kinds that the method adds: public forms of credentials (fixed values). None can be matched in more than linear time.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", ("private key-----",)),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,255}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,250}", ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}", ("aiza",)),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,500}\.eyJ[A-Za-z0-9_-]{10,500}", (".eyj",)),   # where it begins: a span may end in a longer one
    Rule("url_login", r"://[A-Za-z0-9._%-]{1,64}:[A-Za-z0-9._%!-]{3,64}@", ("://",)),
)
RULES = BASE + ADDED


def rules_version(rules: tuple[Rule, ...] = RULES) -> str:
    """Address of a set of rules: any change gives another one, so that all blobs are unseen under it."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


class Scanner:
    """The rules compiled, for use in a task."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = [(i, r, re.compile(r.pattern)) for i, r in enumerate(rules)]

    def spans(self, text: str) -> list[tuple[int, int, int, Rule]]:
        """(start, place of the kind, end, rule) in order; leftmost, non-overlapping per kind, code points."""
        low, out = text.lower(), []
        for i, rule, pattern in self.rules:
            if rule.needs and not any(x in low for x in rule.needs):
                continue
            for m in pattern.finditer(text):
                if len(m[rule.group]) >= rule.least:
                    out.append((m.start(), i, m.end(), rule))
        out.sort(key=lambda s: s[:3])
        return out

    def finding(self, text: str) -> tuple:
        """A ledger row without blob and rules."""
        spans = self.spans(text)
        kinds = Counter(s[3].kind for s in spans)
        told = [(f"{r.kind}:{a}:{b}", r.base) for a, _, b, r in spans]
        base = ",".join(t for t, of_base in told if of_base)
        return (kinds["assign"], kinds["access"], kinds["hex"], sum(not of_base for _, of_base in told),
                hashlib.sha256(base.encode()).hexdigest(), ",".join(t for t, _ in told))


def blob_address(text: Column) -> Column:
    """Content address of a text; a null text is the empty one."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _place(blob: Column) -> Column:
    return F.conv(F.substring(blob, 1, SIEVE_DIGITS), 16, 10).cast("int")


def _sieve(blobs: DataFrame) -> Column:
    """Whether a row's ``blob`` may be one of ``blobs``: a test of one bit of a literal of ``SIEVE_BITS`` bits."""
    bits = bytearray(SIEVE_BITS // 8)
    for r in blobs.select(_place(F.col("blob")).alias("p")).distinct().collect():   # SIEVE_BITS numbers at most
        bits[r["p"] >> 3] |= 1 << (r["p"] & 7)
    place = _place(F.col("blob"))
    byte = F.conv(F.hex(F.substring(F.lit(bytes(bits)), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0


def open_ledger(docs: DataFrame, path: str) -> DataFrame:
    """The ledger at ``path``, which is made there empty if there is none."""
    spark = docs.sparkSession
    schema = spark.createDataFrame([], LEDGER).schema
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy("rules").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _findings(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows without the rules' version, of rows ``(blob, text)``; a task scans a blob once."""
    def run(parts: Iterator[dict]) -> Iterator[dict]:
        scanner, seen = Scanner(rules), set()
        for p in parts:
            rows = []
            for blob, text in zip(p["blob"], p["text"], strict=True):
                key = bytes.fromhex(blob[:32])
                if key not in seen:
                    seen.add(key)
                    rows.append((blob, *scanner.finding(text or "")))
            if rows:
                yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))
    fields = LEDGER.rsplit(",", 1)[0]
    names = [f.split()[0] for f in fields.split(",")]
    return map_rows(texts, fields, run)


def scan(versions: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``versions``: ``doc_id, blob, n_assign, n_access, n_hex, n_added, base_sha256, spans``.

    ``versions`` holds a row per path and historical version, named by ``id_col``; ``ledger`` is a folder that all
    executors share. Blobs without a row in it under ``rules`` are scanned, each once: of the rows that hold a
    repeated blob the one of the least id is read (null ids last; rows equal in id and text at most once a task).
    The rows of a blob that two scans at once both found unseen are equal and count as one.

    Null texts are empty texts, and these have no spans; repeated rows are each returned; extra columns are not
    read; an empty table gives an empty result and leaves the ledger as it is. Patterns take time in proportion to
    the text's length.
    """
    version = rules_version(rules)
    known = open_ledger(versions, ledger).where(F.col("rules") == version)
    texts = versions.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), blob_address(F.col(text_col)).alias("blob"))
    paths = write_scratch(texts.select("id", "blob"), "versions")
    blobs = write_scratch(paths.groupBy("blob").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
                          .join(known.select("blob", F.lit(True).alias("known")).distinct(), "blob", "left"), "blobs")
    doubtful = _sieve(blobs.where("n > 1 or known"))
    todo = blobs.where("known is null").select(F.col("blob").alias("new"), "first")
    alone = texts.where(~doubtful).select("blob", "text")
    chosen = texts.where(doubtful).join(todo, (F.col("blob") == F.col("new")) & F.col("id").eqNullSafe(F.col("first")), "left_semi")
    found = _findings(alone, rules).unionByName(_findings(chosen.select("blob", "text"), rules).dropDuplicates(["blob"]))
    found.withColumn("rules", F.lit(version)).write.mode("append").partitionBy("rules").parquet(ledger)

    rows = open_ledger(versions, ledger).where(F.col("rules") == version).drop("rules").dropDuplicates(["blob"])
    hot = hot_values(blobs, "blob", "n")
    return salted_join(paths, rows, "blob", hot).withColumnRenamed("id", "doc_id")


by_value(__name__)
