"""Each training-data operator against a plain brute-force version, and its defined cases."""

from __future__ import annotations

import gzip
import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest

from mentionlab.llm import bit_sliced, decontaminate, licenses, line_dedup, minhash, mixing, quality, spans, token_counts, warc
from mentionlab.llm.queries import TOKENIZER

DOC = "doc_id bigint, text string, source string, extra map<string,int>, n_words int, `Score` double"


def docs(spark, texts, source=None):
    """Rows with clashing and odd extra columns; ``texts`` as (id, text)."""
    rows = [(i, t, (source or {}).get(i, "s"), {"a": 1} if i else None, 7, None) for i, t in texts]
    return spark.createDataFrame(rows, DOC)


def prose(r, n, words=("alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa")):
    return " ".join(r.choice(words) + str(r.randint(0, 60)) for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (None, None), (4, "same text"), (4, "same text"), (5, "same text")]


# ---------------------------------------------------------------- token counts


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(TOKENIZER)
    tok = Tokenizer.from_file(path)
    r = random.Random(1)
    alphabet = "aAzZ'sdlmrevt 09#!<|>éÉßÿÞ÷×µªºİ́Σς\x7f\x00\x1c\x85\xa0 中🙂\n\t"
    texts = [(i, "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))) for i in range(300)]
    texts += [(1000, "x" * 50_000), (1001, "<|endoftext|>a<|startoftext|> <|EndOfText|>"), *ODD]
    for hot in (0, 20, 10_000):
        got = sorted(map(tuple, token_counts.token_counts(docs(spark, texts), path, hot=hot).collect()), key=repr)
        want = sorted(((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in texts),
                      key=repr)
        assert got == want


def test_token_counts_of_no_rows(spark):
    assert token_counts.token_counts(docs(spark, []), public_tokenizers.path(TOKENIZER)).collect() == []


# ---------------------------------------------------------------- near-duplicates


def brute_components(texts, k, percent):
    sets, up = {}, {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
        up[i] = i

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        shared, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if sets[a] and sets[b] and 100 * shared >= percent * union:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, k, percent):
    r = random.Random(k)
    texts, base = [], prose(r, 150)
    for n in range(120):  # one family with copies at every distance
        words = base.split()
        for _ in range(r.choice([0, 1, 2, 4, 6, 9, 14])):
            words[r.randrange(len(words))] = f"new{r.randint(0, 9999)}"
        texts.append((n, " ".join(words)))
    texts += [(200 + n, prose(r, r.randint(0, 40))) for n in range(60)]
    texts += [(300, "two words"), (301, "Two  WORDS"), (302, "one"), (303, None), (304, ""), (305, None)]
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept)
           for x in minhash.near_duplicates(docs(spark, texts), shingle=k, percent=percent).collect()}
    want = brute_components(texts, k, percent)
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_near_duplicates_without_centre_links(spark, monkeypatch):
    """The block step alone must find all links, over several blocks."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 2000)
    r = random.Random(9)
    base = prose(r, 120).split()
    texts = [(0, " ".join(base))]
    # two clusters away from the centre, near enough to share bands with it
    for cluster in (1, 2):
        mine = base.copy()
        for j in range(6):
            mine[10 + 9 * j + cluster] = f"c{cluster}{j}"
        for n in range(25):
            words = mine.copy()
            words[r.randrange(len(words))] = f"v{cluster}{n}"
            texts.append((100 * cluster + n, " ".join(words)))
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs(spark, texts), shingle=3, percent=85).collect()}
    assert got == {i: c for i, (_, c) in brute_components(texts, 3, 85).items()}
    assert len(set(got.values())) > 1


def test_near_duplicates_of_rows_without_id(spark):
    texts = [(None, "a b c d e f"), (None, "a b c d e f"), (9, "A b c d e f"), (None, "q r s t u"), (None, None)]
    got = sorted((x.n_shingles, x.component_id is None, x.kept) for x in
                 minhash.near_duplicates(docs(spark, texts), shingle=3, percent=85).collect())
    assert got == [(0, True, True), (3, True, True), (4, False, False), (4, False, False), (4, False, True)]
    assert minhash.near_duplicates(docs(spark, [])).collect() == []


def test_near_duplicates_of_ids_with_several_texts(spark):
    """An id's texts are one document: links of each of them count."""
    r = random.Random(41)
    one, two, other = prose(r, 60), prose(r, 60), prose(r, 60)
    texts = [(5, one), (5, two), (7, one), (9, two + " end"), (11, other), (11, one + " last"), (12, other), (20, prose(r, 60)),
             (None, two), (30, ""), (30, other.replace("alpha", "ALPHA"))]
    rows = minhash.near_duplicates(docs(spark, texts), shingle=3, percent=85, keys=True).collect()
    got = sorted(((x.doc_id, x.component_id, x.kept) for x in rows), key=repr)
    want = [(5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False), (11, 5, False), (11, 5, False), (12, 5, False),
            (20, 20, True), (None, 5, False), (30, 30, True), (30, 5, False)]
    assert got == sorted(want, key=repr)
    assert all((x.class_key is None) == (x.n_shingles == 0) for x in rows)


def test_bayes_bounds():
    table = minhash.least_matches(85, 120)
    assert [n for n, _ in table] == [20, 40, 60, 80, 100, 120]
    assert all(0 < m < 0.85 * n for n, m in table)
    assert minhash.bands_for(85) * minhash.ROWS >= 100


# ---------------------------------------------------------------- licences


def test_there_are_hundreds_of_rules_and_keywords_gate_them():
    found = licenses.rules()
    assert len(found) > 550
    assert all(rule.keyword in rule.regex.pattern for rule in found)


def sampled(pattern, r):
    """A text that a rule's pattern matches, by a random way through it."""
    from re import _constants as C
    from re import _parser

    def walk(tree):
        out = ""
        for op, arg in tree:
            if op is C.LITERAL:
                out += chr(arg)
            elif op is C.IN:
                picks = [chr(r.randint(a[0], a[1])) if o is C.RANGE else r.choice("0123456789") if o is C.CATEGORY else chr(a)
                         for o, a in arg]
                out += r.choice(picks)
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
                low, high, inner = arg
                out += "".join(walk(inner) for _ in range(r.randint(low, min(high, low + 3))))
            elif op is C.BRANCH:
                out += walk(r.choice(arg[1]))
            elif op is C.SUBPATTERN:
                out += walk(arg[3])
            elif op not in (C.ASSERT, C.ASSERT_NOT, C.AT):
                raise AssertionError(op)
        return out

    return walk(_parser.parse(pattern))


def test_every_way_of_a_rule_holds_its_keyword():
    r = random.Random(2)
    several = {}  # a name with two keywords has a rule for each
    for rule in licenses.rules():
        several.setdefault((rule.priority, rule.label, rule.regex.pattern), []).append(rule.keyword)
    for (_, label, pattern), keywords in several.items():
        inner = pattern.removeprefix(r"(?<!\S)").removesuffix(r"(?!\S)")
        for _ in range(40):
            text = sampled(inner, r)
            if not re.compile(pattern, re.ASCII).fullmatch(text):
                continue  # a class picked something that goes on elsewhere
            assert any(k in text.split() for k in keywords), (label, text)


def test_written_rules():
    assert len(licenses.WRITTEN) > 150 and len({p for *_, p in licenses.WRITTEN}) == len(licenses.WRITTEN)

    def labels(text):
        return licenses.report(text.encode())[5].split(",")

    for text, label in {
            "Licensed under GPLv3": "gpl-3.0", "GPL version 2 or later": "gpl-2.0", "LGPL-2.1+": "lgpl-2.1", "AGPLv3": "agpl-3.0",
            "License: Apache-2.0": "apache-2.0", "Apache 2.0 licensed": "apache-2.0", "license: mit": "mit", "MPL 2.0": "mpl-2.0",
            "EUPL v1.2": "eupl-1.2", "(c) 2020 Foo Inc.": "copyright", "© 2021 Foo": "copyright", "©": "copyright",
            'THE SOFTWARE IS PROVIDED "AS IS"': "warranty", "SPDX-License-Identifier: MIT OR Apache-2.0": "spdx-expression",
            "SPDX-License-Identifier: (GPL-2.0+ AND MIT)": "spdx-expression"}.items():
        assert label in labels(text), (text, labels(text))
    assert {"dual-license", "mit", "apache-2.0"} <= set(labels("dual licensed under MIT or Apache-2.0"))
    assert labels("json licenses are many") == [""]
    assert labels("vitamin c is good; we saw a gplv in the lab") == [""]
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software to use, copy, modify, "
           "merge, publish, distribute, sublicense, and/or sell copies of the Software")
    assert {"mit", "permission-grant"} <= set(labels(mit))


def test_license_detections():
    def labels(text):
        return licenses.report(text.encode())[5]

    assert labels("Licensed under the Apache License, Version 2.0.") == "apache-2.0"
    assert labels("Released under the MIT License.") == "mit"
    assert labels("This work is licensed under the GNU General Public License, version 3.") == "gpl,gpl-3.0"
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == "bsd-3-clause"
    assert "cc-by-nc-4.0" in labels("Licensed under CC BY-NC 4.0.")
    assert "cc-by-sa-3.0" in labels("http://creativecommons.org/licenses/by-sa/3.0/")
    assert labels("the limit of licensed mittens") == ""
    # the longer, more specific detection suppresses the ones inside it
    spans_ = licenses.report(b"Licensed under the Apache License, Version 2.0")[7]
    assert spans_ == [(0, 8, "apache-2.0")]


def test_license_names_have_keywords_in_every_form():
    for text, label in ((b"Licensed under the PSF License", "psf-2.0"), (b"the PNG Reference Library License", "libpng"),
                        (b"Python Software Foundation License", "psf-2.0"), (b"libpng license", "libpng")):
        assert licenses.report(text)[5] == label


def test_license_words_end_at_ascii_only():
    # other white space and digits belong to words
    assert licenses.report("cc by\xa0all, all rights reserved\u2003x".encode())[:6] == (5, 0, None, None, "", "")
    assert licenses.report("copyright 20२४ by".encode())[5] == "copyright"


def test_license_detections_of_long_texts():
    """Against the plain rule: no detection that stands lies within one accepted before."""
    r = random.Random(3)
    made = [licenses.Rule(r.randint(1, 4), 0.5, f"l{i}", "k", re.compile("k")) for i in range(12)]
    for n in (0, 1, 30, 400):
        found = []
        for i in range(n):
            start = r.randint(0, 300)
            found.append((start, start + r.randint(1, 40), i % 12, r.choice(made)))
        kept = []
        for s, e, _, rule in sorted(found, key=lambda d: (-d[3].priority, d[0] - d[1], d[2], d[0])):
            if not any(a <= s and e <= b for a, b, _ in kept):
                kept.append((s, e, rule))
        assert licenses.resolve(found) == sorted(kept, key=lambda d: (d[0], d[1]))
    text = b"Released under the MIT License, all rights reserved, copyright 2020 by me. " * 20_000
    n_words, n_base, first, last = licenses.report(text)[:4]
    assert (n_words, n_base, first, last) == (240_000, 20_000, 5, 239_993)


def test_license_base_figures_equal_plain_search(spark):
    """All documents of a table, phrase by phrase over lists of words."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {}
    for x in table.collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        found = [(i, label) for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
                 for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        places = [i for i, _ in found]
        want[x.doc_id] = (len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({b for _, b in found})))
    rows = licenses.license_scan(table).collect()
    assert {x.doc_id: (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) for x in rows} == want
    assert any(n for _, n, *_ in want.values())
    assert all(set(filter(None, x.base_labels.split(","))) <= set(x.labels.split(",")) and 0 <= x.score <= 1 for x in rows)


def test_license_base_figures(spark):
    texts = [(7, "CC BY here; all rights\nreserved. cc-by"), (8, "general public licenses"), *ODD]
    got = {(x.doc_id, x.n_words): x for x in licenses.license_scan(docs(spark, texts)).collect()}
    x = got[7, 8]
    assert (x.n_base, x.first_word, x.last_word, x.base_labels) == (3, 0, 6, "cc-by,reserved")
    assert 0 < x.score < 1
    y = got[8, 3]
    assert (y.n_base, y.first_word, y.base_labels) == (0, None, "")
    assert (got[1, 0].labels, got[1, 0].score) == ("", 0.0)
    assert licenses.license_scan(docs(spark, [])).collect() == []


# ---------------------------------------------------------------- exact top-k


def brute_top(rows, k, every):
    data = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, q in data:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in data if j != i and len(v) == len(q))[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("rows", [64, 10_000])
def test_top_k_equals_brute_force(spark, rows):
    r = random.Random(rows)
    vectors = [(i, [r.gauss(0, 0.2) for _ in range(16)]) for i in range(400)]
    vectors += [(1000 + i, [0.25] * 16) for i in range(90)]  # one vector many times: ties
    vectors += [(2000, [1.0] * 8), (2050, [-1.0] * 8), (2001, [0.5] * 8), (2100, [0.0] * 16)]
    vectors += [(None, [1.0] * 16), (3000, None), (3001, []), (3002, [1.0, None] * 8), (3050, [float("nan")] * 16),
                (3051, [float("inf")] * 16), (7, vectors[7][1])]
    data = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, bit_sliced.top_k(data, every=50, rows=rows, queries=3).collect()))
    assert got == brute_top(vectors, 5, 50)


def test_top_k_of_huge_components_and_no_rows(spark):
    vectors = [(0, [1e6, -1e6]), (1, [1e6, -1e6]), (2, [3e5, 2.0])]
    data = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    assert sorted(map(tuple, bit_sliced.top_k(data).collect())) == brute_top(vectors, 5, 50)
    assert bit_sliced.top_k(data.limit(0)).collect() == []


# ---------------------------------------------------------------- lines


def brute_lines(texts, min_length=10):
    key = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s.strip(" \t\n\x0b\f\r"))
    split = [(i, (t or "").split("\n")) for i, t in texts]
    order = lambda i: (i is None, i or 0)
    holders = {}
    for i, ls in split:
        for x in ls:
            if len(key(x)) >= min_length:
                holders.setdefault(key(x), set()).add(order(i))
    gone = lambda i, x: len(holders.get(key(x), ())) > 1 and min(holders[key(x)]) != order(i)
    return sorted(((i, "\n".join(x for x in ls if not gone(i, x)), len(ls), sum(gone(i, x) for x in ls)) for i, ls in split), key=repr)


def test_line_dedup_equals_brute_force(spark):
    r = random.Random(3)
    pool = ["a shared line of text", " A SHARED line of text\r", "ÉTÉ à la plage ici", "été à la plage ici", "short", "", "\t", "another longer line here"]
    texts = [(i, "\n".join(r.choice([*pool, f"own line number {i}"]) for _ in range(r.randint(0, 8)))) for i in range(60)]
    texts += [*ODD, (None, "a shared line of text\nonly without id"), (70, "rep\n" * 3000 + "a shared line of text\n" * 2000)]
    got = line_dedup.line_dedup(docs(spark, texts))
    assert sorted(((x.doc_id, x.text, x.n_lines, x.n_dropped) for x in got.collect()), key=repr) == brute_lines(texts)
    assert set(docs(spark, []).columns) < set(got.columns)
    assert line_dedup.line_dedup(docs(spark, [])).collect() == []


def test_added_columns_replace_clashing_ones(spark):
    line = "a line that two documents hold"
    texts = [(1, f"{line}\nown"), (2, f"{line}\nother"), (None, None)]
    clash = docs(spark, texts).withColumnsRenamed({"n_words": "n_lines", "Score": "N_Dropped"})
    rows = {x.doc_id: x for x in line_dedup.line_dedup(clash).collect()}
    assert (rows[1].text, rows[1].n_lines, rows[1].n_dropped) == (f"{line}\nown", 2, 0)
    assert (rows[2].text, rows[2].n_lines, rows[2].n_dropped) == ("other", 2, 1)
    assert (rows[None].text, rows[None].n_lines) == ("", 1)
    passage = prose(random.Random(1), 60) + "."
    clash = docs(spark, [(1, passage), (2, f"{passage}\nown"), (None, None)]).withColumnsRenamed(
        {"n_words": "n_removed", "Score": "Words_Removed", "source": "repeats_of"})
    out = spans.span_dedup(clash)
    assert sorted(out.columns) == sorted(["doc_id", "text", "extra", "n_removed", "words_removed", "repeats_of"])
    rows = {x.doc_id: x for x in out.collect()}
    assert (rows[1].text, rows[1].n_removed, rows[1].repeats_of) == (passage, 0, [])
    assert (rows[2].text, rows[2].n_removed, rows[2].words_removed, rows[2].repeats_of) == ("own", 1, 60, [1])
    assert rows[2].extra == {"a": 1} and rows[None].text == ""


def test_line_dedup_threshold(spark):
    texts = [(1, "the same long line"), (2, "the same long line"), (3, "other long line!!")]
    got = {x.doc_id: x.text for x in line_dedup.line_dedup(docs(spark, texts), min_docs=3).collect()}
    assert got == dict(texts)


# ---------------------------------------------------------------- mixing


def test_mix_hits_its_targets(spark):
    r = random.Random(5)
    source = {i: r.choice(["big"] * 6 + ["b", "c", None]) for i in range(900)}
    texts = [(i, prose(r, r.randint(0, 40))) for i in range(900)] + [(1000, None), (1001, "")]
    data = docs(spark, texts, source)
    rows = mixing.mix_sizes(data).collect()
    again = mixing.mix_sizes(data.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    total = sum(x["size"] for x in rows)
    by = {}
    for x in rows:
        s = by.setdefault(x.source, [x.target, x.source_size, 0])
        s[2] += x.copies * x["size"]
        assert 0 <= x.copies <= 3
    assert abs(sum(t for t, _, _ in by.values()) - total) < 1e-6 * total
    for target, size, taken in by.values():
        assert target <= 3 * size + 1e-9
        assert abs(taken - target) <= 3 * 40
    out = mixing.mix(data).collect()
    assert len(out) == sum(x.copies for x in rows)
    assert {x.doc_id for x in out} == {x.id for x in rows if x.copies}


def test_mix_waterfills(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 10), ("c", 100), (None, 5), ("e", 0)], "source string, size bigint")
    got = {x.source: x.target for x in mixing.source_targets(sizes).collect()}
    # a weighs 5, b 2, c 1, e 5, null 2: all but c are full, c takes the rest
    assert got == {"a": 30.0, "b": 30.0, "e": 0.0, None: 15.0, "c": 50.0}


def test_mix_of_many_equal_rows_without_id(spark):
    """Rows that nothing tells apart share the copies of all: none is lost, and no list holds them."""
    rows = [(None, "x y")] * 400 + [(None, None)] * 300 + [(i, prose(random.Random(i), 9)) for i in range(60)]
    source = {i: "b" for i in range(0, 60, 2)}
    data = docs(spark, rows, source).withColumnRenamed("extra", "nth")
    sizes = mixing.mix_sizes(data).collect()
    out = mixing.mix(data).collect()
    want, got = {}, {}
    for x in sizes:
        want[x.id, x["size"]] = want.get((x.id, x["size"]), 0) + x.copies
    for x in out:
        at = (x.doc_id, len((x.text or "").split()))
        got[at] = got.get(at, 0) + 1
    assert got == {k: n for k, n in want.items() if n}
    assert len({x.copies for x in sizes if x.id is None and x["size"] == 2}) == 2  # some of the equal rows take one more


def test_mix_of_repeated_rows_and_no_rows(spark):
    rows = [(1, "w w w")] * 40 + [(None, "x")] * 9 + [(2, None)]
    data = docs(spark, rows)
    assert mixing.mix(data).count() == sum(x.copies for x in mixing.mix_sizes(data).collect())
    assert mixing.mix_sizes(docs(spark, [])).collect() == []
    assert mixing.mix(docs(spark, [])).collect() == []


# ---------------------------------------------------------------- WARC


def test_warc_round_trip(spark, workdir):
    r = random.Random(2)
    pages = [(i, f"http://x/{i} ü\r\n", "".join(r.choice("aé中🙂\r\n<>") for _ in range(r.choice([0, 3, 99, 120, 9000]))))
             for i in range(40)]
    pages += [(50, "u", pages[4][2] * 2 + "z" * 200), (49, None, pages[4][2] * 2 + "z" * 200), (51, "%41", pages[4][2] * 2 + "z" * 200),
              (60, "w", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40), (61, "n", None), (62, "n", None), (63, "s", "tiny"), (64, "s", "tiny"), (65, " u\xa0", "tiny"), (66, "\x85", ""),
              (70, "d", "y" * 500), (70, "d", "y" * 500), (71, "d", "y" * 500), (None, "q", "y" * 500), (None, "q", "k" * 500)]
    data = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = warc.round_trip(data, f"{workdir}/a", segment=1000, per_file=7).collect()
    first = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, u, h in pages:
        body = (h or "").encode()
        refers = first[h] if h in first and first[h] != i else None
        want.append((i, u, "response" if refers is None else "revisit", body if refers is None else None, len(body),
                     hashlib.sha256(body).hexdigest(), refers, True))
    have = [(x.page_id, x.url, x.record_type, bytes(x.payload) if x.payload is not None else None, x.payload_bytes,
             x.payload_digest, x.refers_to, x.valid) for x in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    assert max(x.segments for x in got) > 5


def test_warc_references_name_records(spark, workdir):
    long = "payload " * 40
    rows = [(n, f"http://a/{n}", long if n % 3 == 0 else long + "x" if n % 3 == 1 else f"own {n}") for n in range(40)]
    rows += [(0, "http://a/0", long), (None, "http://a/x", long)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages.write.parquet(f"{workdir}/pages")
    for n, table in enumerate((pages, spark.read.parquet(f"{workdir}/pages"))):  # rows with and without a file to name
        warc.write_archives(warc.record_types(table), f"{workdir}/warc{n}")
        ids, refers = [], []
        for x in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{workdir}/warc{n}").collect():
            for f, _ in warc.parse(gzip.decompress(x.content)):
                ids.append(f["warc-record-id"])
                refers += [f["warc-refers-to"]] if "warc-refers-to" in f else []
        assert len(set(ids)) == len(ids) == len(rows) and len(refers) == 26 and set(refers) <= set(ids)
        back = {(x.page_id, x.refers_to) for x in warc.read_archives(spark, f"{workdir}/warc{n}").collect() if x.record_type == "revisit"}
        assert back == {(n, n % 3) for n in range(2, 40) if n % 3 < 2} | {(None, 0)}


def test_warc_faults_are_reported():
    part = lambda n, block, total=None: {"segment": n, "total": total, "kind": "response", "url": "u", "digest": "d",
                                         "refers": None, "block": block}
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    body = head + warc.chunked(b"abc")
    good = hashlib.sha256(b"abc").hexdigest()
    ok = [part(1, body[:20]) | {"digest": good}, part(2, body[20:], len(body))]
    assert warc.page_of("<urn:page:1:0>", ok)[-1]
    assert not warc.page_of("<urn:page:1:0>", ok[:1])[-1]
    assert not warc.page_of("<urn:page:1:0>", [ok[0], part(2, body[20:], len(body) + 1)])[-1]
    assert not warc.page_of("<urn:page:1:0>", [ok[0], part(3, body[20:], len(body))])[-1]
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\n\r\n") == b"abc"


def test_warc_of_no_pages(spark, workdir):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.round_trip(empty, f"{workdir}/e").collect() == []


# ---------------------------------------------------------------- decontamination


def brute_hits(text, items, window=10):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for i, t in items:
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at:at + n] == w[s:s + n]:
                    hit |= set(range(at, at + n))
                    found |= {str(i)} if i is not None else set()
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 300])
def test_decontaminate_equals_brute_force(spark, shard_bytes):
    r = random.Random(4)
    few = ("a", "b", "c")
    items = [(i, " ".join(r.choice(few) for _ in range(r.choice([1, 2, 3, 9, 10, 11, 14])))) for i in range(3, 15)]
    items += [(100, prose(r, 30)), (101, prose(r, 12)), (102, None), (103, "--"), (None, prose(r, 15)), (104, items[0][1])]
    items += [items[1]] * 5 + [(None, None)] * 2
    texts = [(i, " ".join(r.choice(few + ("d",)) for _ in range(r.randint(0, 60)))) for i in range(30)]
    for n, (_, t) in enumerate(items):
        w = (t or "").split()
        texts.append((200 + n, prose(r, 5) + ", " + " ".join(w[2:] if len(w) > 12 else w).upper() + "! " + prose(r, 5)))
    texts += ODD
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.decontaminate(docs(spark, texts), bench, shard_bytes=shard_bytes)
    have = sorted(((x.doc_id, x.n_words, x.n_hit, x["items"]) for x in got.collect()), key=repr)
    assert have == sorted(((i, *brute_hits(t, items)) for i, t in texts), key=repr)
    assert "extra" in got.columns
    assert decontaminate.decontaminate(docs(spark, []), bench).collect() == []
    assert all(x.n_hit == 0 for x in decontaminate.decontaminate(docs(spark, texts), bench.limit(0)).collect())


def test_decontaminate_tables_equal_plain_search_and_stay_small():
    for seed in range(200):
        r = random.Random(seed)
        items = [(r.choice([None, 1, 2, i]), " ".join(r.choice("abc") for _ in range(r.randint(0, 16))).encode()) for i in range(5)]
        words = [r.choice("abcd").encode() for _ in range(r.randint(0, 40))]
        window = r.choice([1, 2, 3, 4, 10])
        places, found = set(), set()
        for i, t in items:
            own = t.split()
            size = min(window, len(own))
            for a, b in itertools.product(range(len(own) - size + 1), range(len(words) - size + 1)):
                if size and own[a:a + size] == words[b:b + size]:
                    places.update(range(b, b + size))
                    found |= {str(i)} - {"None"}
        assert decontaminate.Searches(items, window).hits(words) == (sorted(places), sorted(found))
    r = random.Random(1)
    items = [(i, " ".join(f"w{r.randrange(50_000)}" for _ in range(90)).encode()) for i in range(2000)]
    size = sum(len(t) + 16 for _, t in items)
    tracemalloc.start()
    kept = decontaminate.Searches(items)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept.tables and held < 25 * size and peak < 75 * size  # 8 MB of items: 0.2 GB, and 0.6 GB while they are built


# ---------------------------------------------------------------- spans


def brute_pieces(text):
    """(words, number of the sentence) of every piece, written plainly."""
    word_hash, out, number = spans._Hashes(), [], 0
    for line in (text or "").split("\n"):
        sentence = []
        words = line.lower().split()
        for i, w in enumerate(words):
            sentence.append(w)
            if re.search(r"[.!?…。！？][\"')\]}»”’」』]*$", w) or i == len(words) - 1:
                rank = [int(spans._mixed(np.array([word_hash[x]], np.uint64), 0xD6E8FEB86659FD93)[0]) for x in sentence]
                piece = []
                for j, x in enumerate(sentence):
                    piece.append(x)
                    near = [rank[k] for k in range(max(0, j - spans.REACH), min(len(rank), j + spans.REACH + 1)) if k != j]
                    cut = len(sentence) > spans.SHORT and all(rank[j] < k for k in near)
                    if cut or j == len(sentence) - 1 or len(piece) == spans.LONGEST:
                        out.append((piece, number))
                        piece = []
                number += 1
                sentence = []
    return out


def brute_spans(texts):
    """{place in texts: (kept words, sentences that lose words, words removed)}, every run of pieces tried."""
    order = lambda i: (i is None, i or 0)
    pieces, first = [brute_pieces(t) for _, t in texts], {}

    def runs(p):
        for a in range(len(p)):
            for b in range(a + 1, len(p)):
                run = tuple(tuple(words) for words, _ in p[a:b + 1])
                if sum(map(len, run)) >= spans.MIN_WORDS:
                    yield a, b, run

    for (i, _), p in zip(texts, pieces, strict=True):
        for _, _, words in runs(p):
            first[words] = min(first.get(words, order(i)), order(i))
    out = []
    for (i, _), p in zip(texts, pieces, strict=True):
        covered = set()
        for a, b, words in runs(p):
            if first[words] < order(i):
                covered.update(range(a, b + 1))
        gone, at = set(), 0
        while at < len(p):
            end = at
            while end in covered:
                end += 1
            inside = range(at, end)
            by_sentence = {n: [k for k in range(len(p)) if p[k][1] == n] for n in {p[k][1] for k in inside}}
            full = {n for n, ks in by_sentence.items() if all(k in inside for k in ks)}
            if len(full) >= spans.MIN_SENTENCES or sum(len(p[k][0]) for k in inside) >= spans.FLOOR:
                for n, ks in by_sentence.items():
                    mine = [k for k in ks if k in inside]
                    if n in full or sum(len(p[k][0]) for k in mine) >= spans.EDGE:
                        gone.update(mine)
            at = max(end, at + 1)
        out.append(([w for k, (ws, _) in enumerate(p) if k not in gone for w in ws], len({p[k][1] for k in gone}),
                    sum(len(p[k][0]) for k in gone)))
    return out


def span_texts(seed):
    r = random.Random(seed)
    sentence = lambda: prose(r, r.choice([2, 4, 7, 9, 11, 14, 22])).capitalize() + r.choice([".", "!", '."', ""])
    passages = [[sentence() for _ in range(r.randint(3, 8))] for _ in range(4)]
    long = prose(r, 120).split()
    texts = []
    for i in range(60):
        parts = [sentence() for _ in range(r.randint(0, 8))]
        kind = r.random()
        if kind < 0.5:  # whole sentences
            at, p = r.randint(0, len(parts)), r.choice(passages)
            low = r.randint(0, len(p) - 1)
            parts[at:at] = [x.upper() if r.random() < 0.3 else x for x in p[low:]]
        elif kind < 0.8:  # any words of a passage, inside a sentence
            low = r.randint(0, 60)
            parts.insert(r.randint(0, len(parts)), " ".join([prose(r, r.randint(1, 6)), *long[low:low + r.randint(15, 60)], prose(r, 3)]) + ".")
        texts.append((i + 200, r.choice([" ", "\n", "  \n "]).join(parts)))
    r.shuffle(texts)
    return texts + [*ODD, (290, " ".join(passages[0] * 3)), (None, " ".join(passages[1])), (None, " ".join(passages[1]))]


@pytest.mark.parametrize("seed", [6, 7])
def test_span_dedup_equals_brute_force(spark, seed):
    texts = span_texts(seed)
    rows = spans.span_dedup(docs(spark, texts)).collect()
    assert len(rows) == len(texts)
    got = sorted(((x.doc_id, x.text.lower().split(), x.n_removed, x.words_removed) for x in rows), key=repr)
    want = sorted(((i, *w) for (i, _), w in zip(texts, brute_spans(texts), strict=True)), key=repr)
    assert got == want
    original = dict(texts)
    for x in rows:
        assert bool(x.repeats_of) == (x.n_removed > 0) and all(o != x.doc_id for o in x.repeats_of)
        if not x.n_removed and x.doc_id is not None:
            assert x.text == (original[x.doc_id] or "")
    assert spans.span_dedup(docs(spark, [])).collect() == []


def test_span_dedup_by_shuffle_joins(spark, monkeypatch):
    """More texts to cut than are broadcast."""
    texts = span_texts(8)
    want = sorted((tuple(x[:2]) + (x.n_removed,) for x in spans.span_dedup(docs(spark, texts)).collect()), key=repr)
    monkeypatch.setattr(spans, "FEW", -1)
    monkeypatch.setattr(spans, "bounded_broadcast", lambda df: df)
    assert sorted((tuple(x[:2]) + (x.n_removed,) for x in spans.span_dedup(docs(spark, texts)).collect()), key=repr) == want


def test_span_dedup_leaves_no_run_of_sentences(spark):
    """Three sentences in a row with twenty words, owned by a smaller document, go whole."""
    texts = span_texts(9)
    gone, owners = {}, {}
    plain = {}
    for i, t in texts:
        if i is None or i == 4:
            continue
        found = {}
        for words, n in brute_pieces(t):
            found.setdefault(n, []).extend(words)
        plain[i] = list(found.values())
    for i in sorted(plain):
        for n in range(len(plain[i]) - 2):
            run = tuple(map(tuple, plain[i][n:n + 3]))
            if sum(map(len, run)) >= 20 and owners.setdefault(run, i) != i:
                gone.setdefault(i, set()).update(range(n, n + 3))
    assert len(gone) >= 5
    for x in spans.span_dedup(docs(spark, texts)).collect():
        if x.doc_id in gone:
            left = [w for n, s in enumerate(plain[x.doc_id]) if n not in gone[x.doc_id] for w in s]
            assert len(x.text.split()) <= len(left)
            assert x.words_removed >= sum(len(plain[x.doc_id][n]) for n in gone[x.doc_id])


def test_span_dedup_at_any_word(spark):
    """Passages of over 50 words at arbitrary offsets in texts without marks."""
    r = random.Random(31)
    texts, held = [], {}
    for n in range(60):
        words = prose(r, 120).split()
        low = r.randint(0, 50)
        passage = words[low:low + r.randint(51, 60)]
        other = [*prose(r, r.randint(5, 60)).split(), *passage, *prose(r, r.randint(5, 60)).split()]
        texts += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(other))]
        held[2 * n + 1] = passage
    signs = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    chinese = "".join(r.choice(signs) + r.choice(["", "", "", "", "。"]) for _ in range(60))
    texts += [(900, chinese), (901, "".join(r.choices(signs, k=21)) + chinese + "".join(r.choices(signs, k=17)))]
    rows = {x.doc_id: x for x in spans.span_dedup(docs(spark, texts)).collect()}
    assert all(rows[2 * n].n_removed == 0 for n in range(60))
    found = [i for i in held if rows[i].n_removed]
    assert len(found) >= 57
    for i in found:
        assert rows[i].repeats_of == [i - 1]
        whole, left = dict(texts)[i].split(), rows[i].text.split()
        outside = len(whole) - len(held[i])
        assert len(left) - outside <= 20  # of the passage's ends a piece each stays
        assert rows[i].words_removed == len(whole) - len(left) <= len(held[i])
    assert rows[901].repeats_of == [900] and rows[901].words_removed >= 40


def test_span_dedup_leaves_clean_documents_alone(spark):
    r = random.Random(8)
    line = "A short common line."
    texts = [(i, "\n".join([line, prose(r, 25) + ".", line, prose(r, 30) + "."])) for i in range(20)]
    texts += [(50, "one two three four five. " * 40), (51, "la " * 300)]  # repeats inside one document only
    got = {x.doc_id: x.text for x in spans.span_dedup(docs(spark, texts)).collect()}
    assert got == dict(texts)


# ---------------------------------------------------------------- quality


def labelled(spark, n=260):
    r = random.Random(7)
    texts, labels = [], []
    for i in range(n):
        good = r.random() < 0.6
        body = prose(r, r.randint(5, 120))
        texts.append((i, body if good else " ".join(w + r.choice(["***", "$$$"]) for w in body.split())))
        labels.append((i, int(good), "x"))
    return docs(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int, text string"), dict((a, b) for a, b, _ in labels)


def test_quality_on_held_out_rows(spark):
    data, labels, truth = labelled(spark)
    model = quality.fit_quality(data, labels)
    rows = quality.quality_scores(data, model, keep=["doc_id"]).collect()
    held = [x for x in rows if zlib.crc32(str(x.doc_id).encode()) % 4 == 2]
    assert {x.doc_id for x in data.filter(quality.held_out(data.doc_id)).collect()} == {x.doc_id for x in held}
    right = sum((x.score >= quality.THRESHOLD) == bool(truth[x.doc_id]) for x in held)
    assert right >= 0.9 * len(held)
    # the score of a text doesn't hang on its neighbours, blocks or batches
    texts = [r.text.encode() for r in data.limit(20).collect()]
    alone = [float(model.score([t])[0]) for t in texts]
    assert alone == pytest.approx([float(s) for s in model.score(texts)], abs=2e-6)
    # a flaw far into a long text, over a block border, is seen
    clean = prose(random.Random(1), 100_000).encode()
    assert len(clean) > quality.BLOCK * quality.HALF
    assert model.score([clean])[0] > model.score([clean[:-4000] + b" ***".join(clean[-4000:].split())])[0]


def test_quality_defined_cases(spark):
    data, labels, _ = labelled(spark, 40)
    model = quality.fit_quality(data, labels.limit(0))
    assert {x.score for x in quality.quality_scores(docs(spark, ODD), model).collect()} == {1.0}
    one = quality.fit_quality(data, labels.filter("quality = 1"))
    assert len({x.score for x in quality.quality_scores(docs(spark, ODD), one).collect()}) == 1
    fitted = quality.fit_quality(data, labels)
    rows = quality.quality_scores(docs(spark, ODD), fitted).collect()
    assert len(rows) == len(ODD) and all(0 <= x.score <= 1 for x in rows)
    assert len({x.score for x in rows if not x.text}) == 1
    assert quality.quality_scores(docs(spark, []), fitted).collect() == []


def test_quality_sample_is_filled_up(spark):
    data, labels, _ = labelled(spark, 80)
    absent = spark.createDataFrame([(i, i % 2, "x") for i in range(10_000, 14_000)], labels.schema)
    some = quality.fit_quality(data, labels.union(absent), rows=50)
    assert getattr(some, "fixed", None) is None
    with pytest.raises(ValueError):
        quality.fit_quality(data, labels, row_bytes=1)


def test_network_equals_a_plain_forward_pass():
    """Chunk by chunk with loops: embedding, repeat flag, filters, maximum, hidden layer."""
    net = quality.Network(seed=3)
    r = random.Random(3)
    texts = [b"", b"a", b"some words " * 30, bytes(r.randrange(1, 256) for _ in range(1000)), b"abc" * quality.HALF, b"x\x00y" * 40]
    half, got = quality.HALF, net.score(texts)
    for text, score in zip(texts, got, strict=True):
        count = max(1, -(-len(text) // half))
        data = text + b"\0" * ((count + 1) * half - len(text))
        rows = []
        for i, byte in enumerate(data):
            flag = 0.0
            for lag in range(1, quality.LAGS + 1):
                run = [j for j in range(i - quality.RUN + 1, i + 1)]
                if byte and all(j - lag >= 0 and data[j] == data[j - lag] for j in run):
                    flag = 1.0
                    break
            rows.append([*net.p["emb"][byte].astype(float), flag])
        best = [-math.inf] * quality.FILTERS
        for c in range(count):
            x = [v for row in rows[c * half:(c + 2) * half] for v in row]
            w = net.p["w"].reshape(-1, quality.FILTERS).astype(float)
            for f, v in enumerate((np.array(x) @ w).tolist()):
                best[f] = max(best[f], v)
        a = [max(v + float(b), 0.0) for v, b in zip(best, net.p["b"], strict=True)]
        h = [math.tanh(sum(v * float(w) for v, w in zip(a, net.p["v"][:, k], strict=True)) + float(net.p["c"][k])) for k in range(quality.HIDDEN)]
        z = sum(v * float(w) for v, w in zip(h, net.p["u"], strict=True)) + float(net.p["d"][0])
        assert abs(score - 1 / (1 + math.exp(-z))) < 1e-4, text[:20]


def test_network_gradients():
    import numpy as np

    net = quality.Network(3)
    texts, y = [b"some bytes of a text that is longer than a chunk", b"short", b"another one"], np.array([1.0, 0.0, 1.0])

    def loss():
        p = net.head(net.pooled(*quality.layout(texts))[0])[2]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = net.gradients(texts, y)
    for name in ("w", "v", "b", "emb", "u"):
        flat = net.p[name].ravel()
        at = int(np.abs(grads[name]).argmax())
        old = flat[at]
        flat[at] = old + 1e-3
        up = loss()
        flat[at] = old - 1e-3
        down = loss()
        flat[at] = old
        assert abs((up - down) / 2e-3 - grads[name].ravel()[at]) < 0.15 * abs(grads[name].ravel()[at]) + 1e-4
