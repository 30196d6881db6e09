"""Every operator on a table of odd rows, on an empty table, and against plain-Python versions."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import (iblt, license_digest, line_rules, mixing, pii, quality_gam, sentencepiece_codec, simhash, toxicity,
                        url_lm)
from hearth.llm.common import held_out
from hearth.llm.queries import QUERIES, model_bytes
from tests.conftest import SF_SMALL
from tests.llm import brute

PROSE = "The quick tide ran over flat stones, and nobody saw it turn.\nLater a lamp was lit; the boats came home one by one. "
# columns that clash with names the operators use themselves
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, taken long, fp long, target double, "
          "h long, id long, range int, source_r string, _row int, _keep_id int, _clues string, y int, digest string, key string")


def _texts():
    rng = random.Random(5)
    words = ["tide", "stone", "lamp", "boat", "grey", "salt", "rope", "gull", "mast", "fog", "Ärger", "niño", "日本", "x"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", ",", ".", ".\n"]) for _ in range(n))
    out = [None, "", "   \n\t ", "one", "one two", PROSE * 3, PROSE * 3, (PROSE * 3).upper(), PROSE.replace("lamp", "lantern") * 3]
    out += [prose(n) for n in (3, 40, 60, 200, 400, 20_000)]
    out += ["Home | About | News | Contact | Shop | Help\n" * 12, "### $$$ %%% &&& ***\n" * 30, "from " * 80,
            "mail me at a.b+c@mail.example.com or +44 (0) 20 7946 0958, host 10.0.0.300 or 10.1.2.3, card 4111 1111 1111 1111.",
            "1.2.3.4.5.6.7.8 4111-1111-1111-1112 +1234 @x.y a@b.c.d", "🙂 a\x00b \ud7ff ▁▁ <s> \r\n é",
            PROSE + "\nLicensed under the Apache Licence, version 2.0\nCopyright (c) 2001 Nobody", "Released under the MIT License."]
    return out


def _rows():
    texts = _texts()
    rows = [(i, t, "en", ["a", "b", None, "ä"][i % 4], len(t or ""), *[None] * 14) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[9], (None, PROSE * 3, None, "a", None, *[None] * 14), (None, None, None, None, None, *[None] * 14)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_simhash(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    same([(r["doc_id"], r["fp"] & (2**64 - 1)) for r in got], [(r[0], brute.simhash(r[1])) for r in _rows()])
    expected = brute.components([(i, brute.simhash(t)) for i, t in {r[0]: r[1] for r in _rows() if r[0] is not None}.items()])
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == expected
    assert simhash.near_duplicates(empty).count() == 0
    kept = [r["doc_id"] for r in simhash.deduplicate(odd).select("doc_id").collect()]
    same(kept, sorted(set(expected.values())))
    assert simhash.deduplicate(odd).columns == odd.columns


def test_deduplicate_keeps_one_row_of_each_component(spark):
    """Unrelated texts without an id, and two texts of one id, each stay; copies go, also those without an id."""
    other = [" ".join(random.Random(i).choices("tide stone lamp boat grey salt rope gull mast fog".split(), k=60)) for i in range(6)]
    rows = [(None, other[0]), (None, other[1]), (None, other[1]), (None, None), (None, ""),
            (7, other[2]), (7, other[3]), (8, other[3]), (None, other[3]), (9, other[4]), (9, other[4]), (5, other[5]), (None, other[5])]
    assert len(brute.components(list(enumerate(map(brute.simhash, other))))) == len(set(brute.components(list(enumerate(map(brute.simhash, other)))).values()))
    got = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    same([(r["doc_id"], r["text"] or "") for r in got],
         [(None, other[0]), (None, other[1]), (None, ""), (7, other[2]), (7, other[3]), (9, other[4]), (5, other[5])])


def test_covering_masks_miss_no_pair():
    masks = simhash.covering_masks(3)
    rng = random.Random(1)
    for _ in range(3000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(flips & m == 0 for m in masks)


def test_links_of_large_buckets_are_exact(spark, monkeypatch):
    """Clusters around two centres: pairs and hubs must give the components of all pairs, with any bucket limit."""
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for _ in range(2):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(24), rng.randint(0, 4))) for _ in range(120)}
    order = sorted(prints)
    expected = brute.components(list(enumerate(order)))
    for limit in (1, 64):
        monkeypatch.setattr(simhash, "PAIR_BUCKET", limit)
        nodes = spark.createDataFrame([(simhash._signed(p),) for p in order], "fp long")
        edges = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.fingerprint_links(nodes).collect()]
        place = {p: i for i, p in enumerate(order)}
        root = list(range(len(order)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in edges:
            x, y = find(place[a]), find(place[b])
            root[max(x, y)] = min(x, y)
        assert {i: find(i) for i in range(len(order))} == expected


def test_mixing(odd, empty, spark):
    plan = mixing.mix_plan(odd).collect()
    sizes = {}
    for r in plan:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    expected = brute.targets(sizes)
    assert all(r["target"] == pytest.approx(expected[r["source"]]) and r["source_size"] == sizes[r["source"]] for r in plan)
    same([tuple(r) for r in mixing.mix_plan(odd.repartition(2)).collect()], [tuple(r) for r in plan])
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r["copies"] for r in plan)
    assert mixing.mix_plan(empty).count() == 0 and mixing.mix(empty).count() == 0
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', 1 + id % 37)").alias("text"),
                                    F.expr("if(id % 3 = 0, 'hot', concat('s', id % 7))").alias("source"))
    taken = mixing.mix_plan(many).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("want")).collect()
    assert all(abs(r["t"] - r["want"]) <= 2 for r in taken)


@pytest.mark.parametrize("ids", ["cast(null as long)", "if(id % 3 = 0, null, id)", "id % 20", "id", "id div 200"])
def test_mixing_of_repeated_and_null_ids(spark, ids):
    """Equal documents under null, repeated and distinct ids: each source's words come within a document of its target, twice alike."""
    docs = spark.range(4000).select(F.expr(ids).alias("doc_id"), F.lit("w " * 20).alias("text"), F.expr("concat('s', id % 3)").alias("source"))
    plan = [tuple(r) for r in mixing.mix_plan(docs.repartition(5)).collect()]
    same(plan, [tuple(r) for r in mixing.mix_plan(docs.repartition(3)).collect()])
    taken = {}
    for _, source, _, _, target, _, words in plan:
        taken[source] = (target, taken.get(source, (0, 0))[1] + words)
    assert all(abs(target - words) <= 20 for target, words in taken.values())
    assert [round(taken[s][0]) for s in sorted(taken)] == [13333, 26667, 40000]


def test_mixing_by_document_weight(spark):
    """Weighted documents: the rate is found, capped documents stay at the cap, words still meet the targets."""
    docs = spark.range(2000).select(F.lit("only").alias("source"), F.lit(5).cast("long").alias("size"), F.col("id").alias("doc_id"),
                                    F.expr("if(id % 10 = 0, 50.0, 0.5)").alias("weight"), mixing.random_number(F.col("id")).alias("u"))
    got = mixing.allocate(docs, mixing.cuts(docs)).groupBy((F.col("weight") > 1).alias("heavy")).agg(F.avg("copies").alias("c"), F.sum("taken").alias("t")).collect()
    by = {r["heavy"]: r for r in got}
    assert by[True]["c"] == 3 and by[True]["t"] + by[False]["t"] == 10_000


def test_line_rules(odd, empty):
    got = line_rules.judge_documents(odd, with_text=True).collect()
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    same([(r["doc_id"], *(r[f] for f in fields)) for r in got], [(r[0], *brute.base_quality(r[1]).values()) for r in _rows()])
    assert all(not (r["kept"] and r["base_failed"]) for r in got)
    by = {r["doc_id"]: r for r in got}
    texts = _texts()
    assert by[13]["kept"] and set(by[13]["cleaned"].split("\n")) == set(texts[13].split("\n"))
    assert not any(by[i]["kept"] for i in (0, 1, 2, 3, 15, 16, 17))
    kept = line_rules.clean(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in got)
    assert line_rules.judge_documents(empty).count() == 0 and line_rules.clean(empty).count() == 0


def test_pii(odd, empty, spark, monkeypatch):
    found = pii.find(odd, pii.disclosing_terms(odd)).collect()
    expected = []
    for row in _rows():
        kinds, spans = brute.base_pii(row[1])
        expected.append((row[0], kinds["email"], kinds["ip"], kinds["card"], kinds["phone"], brute.sha(",".join(spans))))
    same([(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in found], expected)
    assert pii.find(empty, pii.disclosing_terms(empty)).count() == 0
    assert pii.sanitise(odd).columns == odd.columns
    # a word that stands by many different addresses, and hardly elsewhere, is a clue; a common word is not
    rows = [(i, f"the boats came home\nwrite to kontaktperson person{i}@mail.example.com about the boats" if i % 3 == 0
             else "the boats came home and the lamp was lit") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms = pii.disclosing_terms(docs)
    clues = {r["term"] for r in terms.collect()}
    assert "kontaktperson" in clues and not clues & {"the", "boats"}
    sent = {r["doc_id"]: r["spans"] for r in pii.find(docs, terms).collect()}
    assert "term:" in sent[0] and sent[1] == ""
    monkeypatch.setattr(pii, "SEND_TERMS", 0)   # the way for clues too many to send: the same spans by a join
    assert {r["doc_id"]: r["spans"] for r in pii.find(docs, terms).collect()} == sent
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, terms).collect()}
    assert "@" not in clean[0] and "kontaktperson" not in clean[0] and clean[1] == rows[1][1]


def test_pii_copies_hide_no_clue(spark):
    """Copies of the texts that hold a clue, or of those that hold none, change neither the clues nor their share."""
    texts = [f"write to kontaktperson person{i}@mail.example.com about it" for i in range(5)] + [f"the boats came home {i}" for i in range(95)]

    def clues(n, m):
        rows = [(t,) for i, t in enumerate(texts) for _ in range(n if i < 5 else m)] + [(None,)] * 3
        return {r["term"]: round(r["share"], 9) for r in pii.disclosing_terms(spark.createDataFrame(rows, "text string")).collect()}
    once = clues(1, 1)
    assert once["kontaktperson"] == 1 and clues(10, 1) == once and clues(1, 20) == once


def test_fingerprints(odd, empty):
    by_id = {r[0]: r[1] for r in _rows() if r[0] is not None}
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r["doc_id"]: r for r in iblt.version_fingerprints(docs).collect()}
    expected = brute.edited(list(by_id.items()))
    assert {i: (r["n_chars"], r["edited_sha256"]) for i, r in got.items()} == {i: x[:2] for i, x in expected.items()}

    def jaccard(a, b):
        x, y = set(map(int, iblt.digests(a))), set(map(int, iblt.digests(b)))
        return len(x & y) / len(x | y) if x | y else 1.0
    for i, (_, _, new, after) in expected.items():
        assert got[i]["near_edited"] == pytest.approx(jaccard(by_id[i] or "", new))
        assert got[i]["near_next"] == pytest.approx(jaccard(by_id[i] or "", after))
    assert got[5]["fingerprint"] == got[6]["fingerprint"] != got[7]["fingerprint"]
    assert iblt.version_fingerprints(odd).count() == len(_rows())
    assert iblt.version_fingerprints(empty).count() == 0
    alone = iblt.version_fingerprints(odd.where("doc_id = 13")).first()
    assert alone["near_next"] == 1.0


def test_fingerprints_of_a_hot_id(spark):
    """One id holds most rows, ids beyond 2**53 and null ids stand beside it: neighbours are those of the whole order."""
    rows = [(7, f"Note {i} of many. It says {i * i}.") for i in range(300)]
    rows += [(i, f"Text {i}. {PROSE}") for i in (1, 2, 2**60, 2**60 + 1, 9)] + [(None, "No id."), (None, "None either.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = docs.orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()).collect()
    expected = []
    for i, r in enumerate(order):
        new = iblt.edited_text(r["text"], order[(i + 1) % len(order)]["text"])
        expected.append((r["doc_id"], len(r["text"]), brute.sha(new)))
    got = iblt.version_fingerprints(docs)
    same([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got.collect()], expected)
    sizes = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 150


def test_sentencepiece(odd, empty, spark):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_proto=model_bytes())
    got = sentencepiece_codec.encode(odd, model_bytes()).collect()
    same([(r["doc_id"], r["ids"], r["decoded"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got],
         [(r[0], e := library.encode(r[1] or ""), d := library.decode(e), len(e), brute.sha(",".join(map(str, e))), brute.sha(d)) for r in _rows()])
    back = sentencepiece_codec.decode(spark.createDataFrame([(r["doc_id"], r["ids"]) for r in got], "doc_id long, ids array<int>"), model_bytes())
    same([tuple(r) for r in back.collect()], [(r["doc_id"], r["decoded"]) for r in got])
    assert sentencepiece_codec.encode(empty, model_bytes()).count() == 0


def test_word_agenda_matches_library():
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_proto=model_bytes())
    vocabulary = sentencepiece_codec.Vocabulary(model_bytes())
    table = sentencepiece_codec.WordTable(vocabulary)
    rng = random.Random(3)
    letters = " ▁abcdefghié\n\t🙂ñ01<>xß"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(1500)]
    for text, (n, digits, back, _) in zip(texts, table.texts(texts), strict=True):
        ids = library.encode(text)
        assert (n, digits, back) == (len(ids), ",".join(map(str, ids)), library.decode(ids))
        assert vocabulary.encode(text) == ids


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "http://ORG/", "http://a.example.org/es/1", "http://a.example.org/en/12?x", "http://example.org",
            "https://Ü.com/fr/9#t", "https://m.x.com/de/1", "ftp://x.net/en/a b\n/c", "http://evilorg/x", "https://a.b://c/d"]
    urls += [f"https://h{i % 7}.example.{'org' if i % 2 else 'com'}/{['en', 'fr', 'de', 'es'][i % 4]}/{i}" for i in range(200)]
    pages = spark.createDataFrame([(i, u, 7) for i, u in enumerate(urls)] + [(0, None, 7)], "page_id long, url string, s int")
    got = url_lm.judge(pages).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        host, path = brute.host_path(urls[r["page_id"]])
        rule = brute.url_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert r["verdict"] == rule[1] if rule else r["verdict"] in ("allow", "block")
    assert url_lm.judge(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in url_lm.judge(pages.where("page_id < 4")).collect()} == {"allow"}
    # rules of one verdict only: no threshold can be set
    one = spark.createDataFrame([(i, f"https://h{i}.org/{i}") for i in range(60)], "page_id long, url string")
    assert {r["verdict"] for r in url_lm.judge(one).collect()} == {"allow"}


def test_url_query_is_read_and_long_urls_end(spark):
    """What follows the path decides between URLs without a rule; a URL of a megabyte takes time in proportion."""
    import time
    rows = [f"https://a{i}.org/p{i}?ref=home" for i in range(150)] + [f"https://b{i}.com/de/p{i}?zzqqxx=zzqq" for i in range(150)]
    free = ["https://c.net/page?ref=home", "https://c.net/page?zzqqxx=zzqq", "mailto ref=home", "zzqqxx=zzqqxx=zzqq"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(rows + free + ["https://d.net/" + "ab/" * 350_000])], "page_id long, url string")
    begun = time.time()
    got = {r["page_id"]: r for r in url_lm.judge(pages).collect()}
    assert time.time() - begun < 120
    assert [got[300 + i]["verdict"] for i in range(4)] == ["allow", "block", "allow", "block"]
    assert len(got) == len(rows) + 5 and got[304]["path"].startswith("/ab/ab/") and got[304]["score"] is not None


def test_lines_that_are_no_text():
    """Filler of any length, notices in full sentences, lines of symbols with one separator; prose that shares a word stays."""
    rules = line_rules.LineRules()
    fails = lambda line: line_rules.line_fails(line, line.split(), rules)
    assert fails("Lorem ipsum dolor sit amet " + "consectetur adipiscing elit sed do " * 20) == "boilerplate"
    assert fails("This website uses cookies to make sure that you get the best experience of what we offer to you on it.") == "boilerplate"
    assert fails("All rights reserved. No part of this page may be copied in any form without the written leave of its owner and of its makers.") == "boilerplate"
    assert fails("### $$$ %%% &&& *** ### $$$ %%% &&& *** ### $$$ %%% &&& *** ### $$$ %%% &&& *** | ### ###") == "punctuation"
    assert fails("Home | News | Shop | Help") == "navigation"
    for prose in ("Read more slowly and you will find that the old man had seen the tide turn long before they did.", "She had to sign in with a name that nobody there had ever heard of until that one evening.",
                  "The rights reserved for the crown were few.", "He ate a cookie and looked out to sea."):
        assert fails(prose) is None


@pytest.mark.parametrize("unit", ["a", "0", "@a", "1.", "1 ", "10.1.2.3 ", "a@", "+1 (", "x@y.z ", "0" * 30 + "."])
def test_personal_data_in_long_texts(unit):
    """Five megabytes of each kind end soon; on short texts of the same signs the spans are those of the contract's patterns."""
    import time
    rng = random.Random(len(unit))
    for _ in range(3000):
        text = "".join(rng.choice([unit, rng.choice("a1.@-+ ()0\n%_é9")]) for _ in range(rng.randint(0, 30)))
        assert [f"{k}:{a}:{b}" for k, a, b in pii.base_spans(text)] == brute.base_pii(text)[1]
    begun = time.time()
    pii.term_windows("@" + unit * (5_000_000 // len(unit)))
    assert time.time() - begun < 90


def test_url_ratio_is_the_interpolated_models(spark):
    """Ratios against the recursion written out in Python."""
    import math
    counts = {"^^^^a": (3, 1), "^^^ab": (2, 0), "^^abc": (1, 4), "^abc$": (2, 2), "^^^aa": (0, 5)}
    counted = spark.createDataFrame([(g, a, r) for g, (a, r) in counts.items()], "g string, a long, r long")
    grams = spark.createDataFrame([(g,) for g in [*counts, "zzzzz", "^^abz", "xxabc"]], "g string")

    def probability(g, which):
        p = 1 / url_lm.SYMBOLS
        for k in range(url_lm.ORDER + 1):
            ctx = g[:4][4 - k:]
            following = {}
            for h, n in counts.items():
                if h[:4][4 - k:] == ctx:
                    following[h[4]] = following.get(h[4], 0) + n[which]
            every, kinds = sum(following.values()), sum(n > 0 for n in following.values())
            if every:
                p = (following.get(g[4], 0) + kinds * p) / (every + kinds)
        return p
    for r in url_lm._ratios(grams, url_lm._contexts(counted)).collect():
        assert r["ratio"] == pytest.approx(math.log(probability(r["g"], 0)) - math.log(probability(r["g"], 1)))


def test_license_scan(odd, empty, spark):
    got = {r["doc_id"]: r for r in license_digest.scan(odd).collect()}
    assert license_digest.scan(odd).count() == len(_rows()) and license_digest.scan(empty).count() == 0
    texts = _texts()
    notice = next(i for i, t in enumerate(texts) if t and "Apache" in t)
    assert (got[notice]["n_notices"], got[notice]["notice_licenses"], got[notice]["text_license"]) == (1, "Apache-2.0", None)
    assert got[notice + 1]["text_license"] == "MIT" and got[0]["n_notices"] == 0
    mit = next(t for n, t in license_digest.KNOWN if n == "MIT" and len(t) > 500)
    docs = spark.createDataFrame([(1, "Copyright (c) 2020 Some One\n\n" + mit.replace("sublicense", "sub-licence").upper()), (2, mit[:-30])], "doc_id long, text string")
    assert {r["doc_id"]: r["text_license"] for r in license_digest.scan(docs).collect()} == {1: "MIT", 2: None}


def test_license_texts_in_comments(spark):
    """Every known text is found whole behind comment marks, in other case and line breaks, below any usual copyright line."""
    heads = ["Copyright Jane Doe 2020", " * Copyright (c) 1999-2004 The Authors. All rights reserved.", "# © 2011 Someone", "// (c) Example Ltd", "Copyright 2020 X"]
    rows = []
    for i, (name, text) in enumerate(license_digest.KNOWN):
        words = text.upper().split()
        lines = [" * " + " ".join(words[at:at + 9]) for at in range(0, len(words), 9)]
        rows.append((i, "\n".join([heads[i % len(heads)], *lines])))
    got = {r["doc_id"]: r["text_license"] for r in license_digest.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got[i] for i, _ in rows} == {i: name for i, (name, _) in enumerate(license_digest.KNOWN)}
    assert {"BSD-2-Clause", "BSD-3-Clause", "Zlib", "Unlicense", "Apache-2.0"} <= set(got.values())


@pytest.mark.parametrize(("label", "modulus", "remainder", "module"), [("quality", 4, 2, quality_gam), ("toxic", 3, 1, toxicity)])
def test_classifiers(spark, odd, empty, label, modulus, remainder, module):
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet")
    learn = ~held_out(F.col("doc_id"), modulus, remainder)
    model = module.train(docs, labels, label, learn)
    scored = module.score(docs, model).join(labels, "doc_id").where(~learn).collect()
    right = sum((r["score"] >= 0.7) == (r[label] == 1) for r in scored) / len(scored)
    assert right >= 0.93 and all(0 <= r["score"] <= 1 for r in scored)
    assert module.score(odd, model).count() == len(_rows()) and module.score(empty, model).count() == 0
    nothing = module.train(odd, labels.limit(0), label, learn)
    assert all(0 <= r["score"] <= 1 for r in module.score(odd, nothing).collect())


def test_toxicity_votes_without_mined_terms(spark):
    """Seed insults and shouted abuse count in a text that holds no mined term, and where no term is mined at all."""
    seed, calm = sorted(toxicity.SEED), PROSE.lower().replace(";", "").replace(".", "").replace(",", "").split()
    rng = random.Random(3)
    for marker in ("blorf", ""):
        toxic = [f"{' '.join(rng.sample(calm, 5))} you {seed[i % len(seed)]} {rng.choice(calm)}!!! {marker} {i}" for i in range(5 * len(seed))]
        rows = [(i, t, 1) for i, t in enumerate(toxic)] + [(1000 + i, f"{' '.join(rng.sample(calm, 7))} you {i}", 0) for i in range(300)]
        docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
        labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
        model = toxicity.train(docs, labels, "toxic", F.lit(True))
        abuse, plain = "what you imbecile are, pathetic!!", "the lamp was lit"
        assert not model.read(abuse)[0]
        assert model.score(abuse) > 5 * model.score(plain) and (marker or model.score(abuse) > 0.7)


def test_pipeline_against_plain_python(spark):
    """The stages one by one: each result follows from its own input."""
    import corpus_pipeline
    import sentencepiece
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["quality rules"](spark, docs, SF_SMALL)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    judged = {i: line_rules.judge(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {i: x["cleaned"] for i, x in judged.items() if x["kept"]}
    single = stages["near duplicates"](spark, clean, SF_SMALL)
    prints = [(i, brute.simhash(x["cleaned"])) for i, x in sorted(judged.items()) if x["kept"]]
    assert {r["doc_id"] for r in single.collect()} == set(brute.components(prints).values())
    private = stages["personal data"](spark, single, SF_SMALL)
    assert private.columns == docs.columns
    assert not any(sum(brute.base_pii(r["text"])[0].values()) for r in private.collect())
    mixed = stages["source mix"](spark, private, SF_SMALL)
    assert mixed.columns == docs.columns
    out = stages["tokens"](spark, mixed, SF_SMALL).collect()
    library = sentencepiece.SentencePieceProcessor(model_proto=model_bytes())
    same([(r["doc_id"], r["ids"]) for r in out], [(r["doc_id"], library.encode(r["text"])) for r in mixed.collect()])


def test_registered_queries_return_whole_tables(spark):
    for name, query in QUERIES.items():
        key, table = {"op8": ("page_id", "pages"), "op12": ("vec_id", "embeddings")}.get(name.split("_")[0], ("doc_id", "documents"))
        want = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(key)
        got = query(spark, SF_SMALL).select(key)
        assert json.dumps(sorted(r[0] for r in got.collect())) == json.dumps(sorted(r[0] for r in want.collect())), name


def test_every_text_is_held_against_the_library(spark, monkeypatch):
    """A wrong encoding of any text ends the job, not only that of a slice's first one or of a short one."""
    from hearth.llm import sentencepiece_codec as codec
    from hearth.llm.queries import model_bytes
    plain = codec.WordTable

    class Off(plain):
        def texts(self, texts):
            for t, (n, digits, back, got) in zip(texts, super().texts(texts), strict=True):
                yield n, digits, back, got[:-1] if t and t.endswith("last") else got
    docs = spark.createDataFrame([(0, "a first text"), (1, "word " * 5000 + "last")], "doc_id long, text string").coalesce(1)
    assert codec.encode(docs, model_bytes()).count() == 2
    monkeypatch.setattr(codec, "WordTable", Off)
    with pytest.raises(Exception, match="differ from the library"):
        codec.encode(docs, model_bytes()).select("n_tokens").collect()


def test_words_are_kept_between_the_tasks_of_a_worker(spark):
    """A second task of one worker finds the words of the first: its texts are merged no more, and still held against the library."""
    from hearth.llm import sentencepiece_codec as codec
    table = codec.WordTable(codec.Vocabulary(model_bytes()))
    texts = ["one two ▁three  \n é🙂 " * 3, "", None, " two ▁", "one"]
    first = [(n, digits, back) for n, digits, back, _ in table.texts(texts)]
    table.agenda.merge = lambda words: [pytest.fail(f"merged again: {words}")] if words else []
    again = list(table.texts(texts))
    assert [(n, digits, back) for n, digits, back, _ in again] == first
    assert [np.frombuffer(codec.entry_ids(got), np.int32).tolist() for *_, got in again] == [
        [int(i) for i in digits.split(",") if i] for _, digits, _ in first]
    vocabulary = table.v
    assert all([w.replace(" ", "▁") for w in vocabulary.spaced(t or "")] == vocabulary.words(t or "") for t in texts)


def test_distinct_words_of_a_batch_are_looked_up_once():
    """A word that comes in many texts of a batch costs one look into the table; all texts still get their own ids and text."""
    import sentencepiece
    from hearth.llm import sentencepiece_codec as codec
    library = sentencepiece.SentencePieceProcessor(model_proto=model_bytes())
    asked = []

    class Counted(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)
    table = codec.WordTable(codec.Vocabulary(model_bytes()))
    table.now = Counted()
    texts = ["one two two\none  two ▁three é🙂\n\n two", " ", None, "\n", "", "two \n two"] * 40
    for _ in range(2):
        asked.clear()
        for text, (n, digits, back, got) in zip(texts, table.texts(texts), strict=True):
            ids = library.encode(text or "")
            assert (n, digits, back) == (len(ids), ",".join(map(str, ids)), library.decode(ids))
            assert np.frombuffer(codec.entry_ids(got), np.int32).tolist() == ids
        assert len(asked) == len(set(asked)) > 5


@pytest.mark.parametrize("bytes_known", [True, False])
def test_word_table_over_generations(monkeypatch, bytes_known):
    """Words of every length and with unknown characters, while the table's halves change places: as the agenda of a single word."""
    from hearth.llm import sentencepiece_codec as codec
    monkeypatch.setattr(codec, "KEEP_WORDS", 60)
    vocabulary = codec.Vocabulary(model_bytes())
    if not bytes_known:
        vocabulary.byte_ids = None
    table, surface = codec.WordTable(vocabulary), vocabulary.surface()
    rng = random.Random(11)
    pool = ["".join(rng.choice("theinrsaoué🙂\U0001F9FFЖ") for _ in range(n)) for n in range(1, 45) for _ in range(4)]
    assert [np.frombuffer(x, np.int32).tolist() for x in table.agenda.merge(pool)] == [vocabulary.merge(w) for w in pool]
    for _ in range(30):
        texts = [" ".join(rng.choices(pool, k=rng.randint(0, 12))) for _ in range(4)]
        for text, (n, digits, back, got) in zip(texts, table.texts(texts), strict=True):
            ids = vocabulary.encode(text)
            assert got.tolist() == ids and n == len(ids) and digits == ",".join(map(str, ids))
            assert back == codec.join_surface([surface[i] for i in ids], vocabulary.prefix)
        assert len(table.now) <= 60 and len(table.old) <= 60
        assert set(table.odd) <= set(table.now) | set(table.old)
