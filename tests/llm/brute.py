"""Plain-Python versions of the operators' contracts, written from their definitions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def simhash(text, k=3):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=3):
    """{doc_id: least reachable id} over all pairs of [(doc_id, fingerprint)]."""
    ids = [i for i, _ in prints]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, (a, fa) in enumerate(prints):
        for b, fb in prints[:n]:
            if (fa ^ fb).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def targets(source_sizes, weights=(1, 2, 3), cap=3):
    """{source: target} by resharing the excess round after round."""
    order = sorted(source_sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(source_sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(cap * source_sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free} if free else {}
        over = {s for s in free if share[s] > cap * source_sizes[s]}
        if not over:
            return {s: share.get(s, cap * source_sizes[s]) for s in order}
        full |= over


def base_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i:i + 3])].append(i)
    repeated = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": dup, "n_repeat_words": len(repeated),
            "base_failed": len(words) < 50 or 100 * len(repeated) > 50 * len(words)}


def luhn_ok(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c)
        if i % 2:
            d = 2 * d if 2 * d < 10 else 2 * d - 9
        total += d
    return total % 10 == 0


def base_pii(text):
    text, out = text or "", []
    for n, (kind, pattern) in enumerate((
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn_ok(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}", kind))
    out.sort()
    return Counter(x[3] for x in out), [x[2] for x in out]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def edited(rows):
    """{doc_id: (n_chars, edited sha, edited text, next text)} of [(doc_id, text)] with distinct ids."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        new = text[:len(text) - cut] + after[:cut]
        out[i] = (len(text), sha(new), new, after)
    return out


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower_ascii(host), re.match(r"[^?#]*", rest[len(host):])[0]


def url_rule(host, path):
    best = None
    for verdict, h, p in (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
                          ("allow", "com", "/fr/"), ("block", "com", "/de/")):
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return best


def in_fold(doc_id, modulus, remainder):
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder
