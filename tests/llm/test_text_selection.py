"""Quality rules, phrase mining and resampling against brute force, on a small corpus and on edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tallyframe.llm import phrases, quality_rules, resampling
from tallyframe.llm.phrases import collocations, phrase_frequencies
from tallyframe.llm.quality_rules import POLICIES, RULES, Policy, ablations, fired, judged, ledger, mask_of, quality_verdicts
from tallyframe.llm.resampling import resample

SCHEMA = "doc_id long, text string, lang string, chunk string, grp string, _text string, failed_bits string"  # names that operators use inside
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus():
    rng = random.Random(11)
    words = ["".join(rng.choice(["ka", "lo", "mi", "té", "ru", "Ñas"]) for _ in range(rng.randint(1, 3))) for _ in range(60)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n)) + rng.choice([".", "!", "", ", "])
    fixed = "Kalo mi ruru té"
    texts = ["\n".join(line(rng.randint(3, 30)) + (" " + fixed if rng.random() < 0.4 else "") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    texts += [None, "", " \n\t\x0b", "ab", "!!!", "... \r ;", "one two three", "a b \x1c c", "x" * 50_000, line(6000), "\n".join([line(9)] * 8), "the the the the the the the the the the the the"]
    texts += ["# $ % & | < > * " * 5 + line(10), "SHOUT " * 12 + "LOUD NOISE", "\n".join(["- " + line(4)] * 3), "- a b c...\n- d e f...\n", "\x00 \x00a nul\x00", "1 2 3 4 5 6 7 8 9 10 11", "a" * 13 + (" " + "b" * 14) * 20]
    rows = [(i, t, ["en", "de", None, "und"][i % 4], "c", None, f"t{i}", "9") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[0], "en", None, None, None, None), (None, texts[2], "en", None, None, None, None), (2**60 + 1, texts[5], "en", None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit), "n_lines": len(lines), "n_upper": sum("A" <= c <= "Z" for c in text), "n_letters": sum(c.isascii() and c.isalpha() for c in text),
        "n_exclaims": text.count("!"), "n_letter_words": sum(any(ord(c) > 127 or c.isalpha() for c in w) for w in words),
        "n_bullet_lines": sum(x.strip("\x20\t\n\x0b\x0c\r")[0] in "-*•" for x in lines), "n_open_lines": sum(x.strip("\x20\t\n\x0b\x0c\r").endswith(("...", "…")) for x in lines),
        "n_echo_words": sum(a == b for a, b in zip(words, words[1:], strict=False)),
    }


def test_quality_rules(docs, rows, none):
    got = quality_verdicts(docs).collect()
    assert len(got) == len(rows)
    want = Counter()
    for r in rows:
        m = measured(r[1])
        bits = sum(1 << k for k, (_, fails) in enumerate(RULES) if eval(fails, {}, m))  # the rules read the same in Python
        base = m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]
        want[(r[0], *m.values(), bits, base, bits == 0)] += 1
    assert Counter(tuple(r) for r in got) == want
    assert any(r.kept for r in got) and {k for k in range(len(RULES)) if any(r.failed_bits >> k & 1 for r in got)} >= {0, 1, 3, 4, 5, 6, 8, 10, 11}
    assert quality_verdicts(none).count() == 0


def test_policies_and_ablations_equal_a_second_look_at_every_row(docs):
    rows = ledger(docs, keep=("lang",)).cache()
    bits = [r.failed_bits for r in rows.collect()]
    for p in POLICIES.values():
        hard, soft = mask_of(p.hard), mask_of(p.soft)
        fails = lambda b, hard=hard, soft=soft, p=p: bool(b & hard) or (b & soft).bit_count() > p.most_soft
        base = mask_of(quality_rules.BASE)
        assert sorted((r.failed_bits, r.kept) for r in judged(rows, p).collect()) == sorted((b, not b & base and not fails(b)) for b in bits)
        for r in ablations(rows, (p,)).collect():
            one = mask_of((r.rule,))
            assert (r.n_failed, r.n_failed_alone) == (sum(b & one > 0 for b in bits), sum(b & (hard | soft) == one for b in bits))
            assert (r.n_kept, r.n_kept_without) == (sum(not fails(b) for b in bits), sum(not fails(b & ~one) for b in bits))
    assert ablations(rows).count() == sum(len({*p.hard, *p.soft}) for p in POLICIES.values())
    assert ablations(rows.where("false"), (Policy("none", ("symbols",)),)).collect()[0].n_kept == 0
    per = {r.lang: r for r in fired(rows, "lang").collect()}
    own = [r.failed_bits for r in rows.where("lang = 'de'").collect()]
    assert per["de"].any_bits == int(np.bitwise_or.reduce(own)) and per["de"].all_bits == int(np.bitwise_and.reduce(own)) and per["de"].odd_bits == int(np.bitwise_xor.reduce(own))


def test_quality_rules_stay_native(docs):
    plan = ledger(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "hashpartitioning" not in plan


def pieces_of(text):
    return [p for p in (re.findall(r"[^\x20\x09]+", x) for x in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER))) if p]


def brute_phrases(rows, longest, least, most):
    f, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = r[2] or "und"
        for p in pieces_of(r[1]):
            n[lang] += len(p)
            for k in range(1, longest + 1):
                f[lang].update(tuple(p[i : i + k]) for i in range(len(p) - k + 1))
    out = []
    for lang, own in f.items():
        good = {w: a for w, a in own.items() if len(w) > 1 and a >= least}
        scored = []
        for w, a in good.items():
            score, k = min((2_000_000 * a // (own[w[:k]] + own[w[k:]]), k) for k in range(1, len(w)))
            inside = [b for v, b in good.items() if len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))]
            if not any(100 * b >= 80 * a for b in inside):
                scored.append((-score, -a, " ".join(w).encode(), own[w[:k]], own[w[k:]]))
        out += [(lang, i, w.decode(), -a, left, right, n[lang], -s) for i, (s, a, w, left, right) in enumerate(sorted(scored)[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize(("shard_bytes", "keys", "longest", "least", "most"), [(8 << 20, 1 << 21, 4, 30, 2000), (900, 40, 4, 5, 25), (200, 7, 3, 4, 2000), (900, 40, 2, 3, 2000)])
def test_phrases(monkeypatch, docs, rows, shard_bytes, keys, longest, least, most):
    monkeypatch.setattr(phrases, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(phrases, "KEYS_A_GROUP", keys)
    got = sorted(tuple(r) for r in collocations(docs, longest=longest, least=least, most=most).collect())
    assert got == brute_phrases(rows, longest, least, most) and got


def test_phrases_of_nothing(spark, none):
    assert collocations(none).count() == 0
    empty = spark.createDataFrame([(1, None, None, "", "", "", ""), (2, " .,", "en", "", "", "", "")], SCHEMA)
    assert collocations(empty, least=1).count() == 0


def test_phrase_counts_of_a_suffix_array():
    rng = np.random.default_rng(5)
    for size, vocabulary in ((1, 2), (2, 2), (50, 2), (400, 3), (3000, 40)):
        ids = np.append(rng.integers(0, vocabulary, size), 0)
        want = [Counter(tuple(ids[i : i + k].tolist()) for i in range(len(ids) - k + 1) if (ids[i : i + k] > 0).all()) for k in range(1, 6)]
        got = phrases.phrase_counts(ids, 5)
        assert [{tuple(ids[h : h + k].tolist()): c for h, c in zip(*x, strict=True)} for k, x in enumerate(got, 1)] == [dict(w) for w in want]
    order = phrases.suffix_array(ids, len(ids))
    assert [ids[i:].tolist() for i in order] == sorted(ids[i:].tolist() for i in range(len(ids)))


def test_keys_that_two_phrases_share_change_no_count(monkeypatch, docs, rows):
    monkeypatch.setattr(phrases, "word_keys", lambda lang, words: np.array([0, *(len(w) % 3 for w in words)], np.uint64))
    _, counts = phrase_frequencies(docs, least=6)
    want = Counter()
    for r in rows:
        for p in pieces_of(r[1]):
            want.update((r[2] or "und", " ".join(p[i : i + k])) for k in range(1, 5) for i in range(len(p) - k + 1))
    assert {(r.lang, r.phrase): r.f for r in counts.collect()} == {k: n for k, n in want.items() if n >= 6}


def brute_resample(rows, target, share=25):
    def cut(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
        return len(words), [zlib.crc32(x.encode()) % 10000 for x in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]

    own, other = [(r[0], *cut(r[1])) for r in rows], Counter(b for t in target for b in cut(t)[1])
    s = Counter(b for _, _, f in own for b in f)
    whole_s, whole_t = sum(s.values()), sum(other.values())
    gain = lambda b: math.floor(1000 * math.log((other[b] + 1) * (whole_s + 10000) / ((s[b] + 1) * (whole_t + 10000))))
    out = []
    for i, n, f in own:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = Counter((r[0], *r[2:], k) for k, r in enumerate(able[: share * len(able) // 100], 1))
    return drawn + Counter((r[0], *r[2:], None) for r in [*able[share * len(able) // 100 :], *(r for r in out if r[1] < 20)])


@pytest.mark.parametrize(("chunk_docs", "salt_bytes"), [(4096, 32 << 20), (5, 3)])
def test_resample(monkeypatch, spark, docs, rows, chunk_docs, salt_bytes):
    monkeypatch.setattr(resampling, "CHUNK_DOCS", chunk_docs)
    monkeypatch.setattr(resampling, "SALT_BYTES", salt_bytes)
    items = [(1, rows[0][1]), (2, None), (3, "Kalo mi ruru té zwölf"), (3, "")]
    target = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(tuple(r) for r in resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank").collect())
    assert got == brute_resample(rows, [t for _, t in items])
    assert max(r[4] or 0 for r in got) == 25 * sum(1 for r in rows if len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r[1] or "")) >= 20) // 100


def test_resample_without_target_or_documents(spark, docs, rows, none):
    target = spark.createDataFrame([], "item_id long, text string")
    assert Counter(tuple(r) for r in resample(docs, target).collect()) == brute_resample(rows, [])
    assert resample(none, target).count() == 0


def test_packed_postings_come_back():
    b, d, n = np.array([0, 5, 127]), np.array([4095, 0, 7]), np.array([1, 70_000, 3])
    assert [x.tolist() for x in resampling.unpacked(resampling.packed(b, d, n))] == [b.tolist(), d.tolist(), n.tolist()]


def test_postings_lie_in_small_rows_and_row_groups(spark):
    """A chunk was a row of all its postings, and a file a row group of all its chunks, each held as a whole wherever it was read."""
    rng = random.Random(2)
    words = [str(rng.randrange(10**6)) for _ in range(20_000)]
    texts = [" ".join(words[k : k + 500]) for k in (rng.randrange(19_500) for _ in range(4000))]
    chunks = resampling.chunked(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), "doc_id", "text")
    metas = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in chunks.inputFiles()]
    sizes = [m.row_group(k).total_byte_size for m in metas for k in range(m.num_row_groups)]
    assert sum(sizes) > 20 << 20 and max(sizes) < 12 << 20
    longest, total, told, parts = chunks.selectExpr("max(length(block))", "sum(length(block))", "sum(bytes)", "count(distinct part)").first()
    assert longest < 1 << 20 and total == told and parts == resampling.PARTS


BSD_CLAUSES = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
"""
ENDORSE = "may be used to endorse or promote products derived from\n   this software without specific prior written permission"
HOLDERS = ("Google Inc.", "the copyright holder", "the University", "the <organization>", "Red Hat, Inc", "The Open Group", "Sun Microsystems, Inc.", "the Example Project", "Jane Q. Public", "the authors")
MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""


def gnu(name, kind="General", version="3", later=True):
    end = f"either version {version} of the License, or\n(at your option) any later version" if later else f"version {version} of the License"
    return f"""{name} is free software: you can redistribute it and/or modify
it under the terms of the GNU {kind} Public License as published by
the Free Software Foundation, {end}.

{name} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {kind} Public License for more details."""


def test_licences_with_names_in_their_holes(spark):
    from tallyframe.llm.licences import scan_licences

    cases = [(BSD_CLAUSES + f"3. Neither the name of {h} nor the names of its\n   contributors {ENDORSE}.\n", "BSD-3-Clause") for h in HOLDERS]
    cases += [(BSD_CLAUSES + f"3. The name of {h} may not be used to endorse or promote products derived from\n   this software without specific prior written permission.\n", "BSD-3-Clause") for h in HOLDERS]
    cases += [(BSD_CLAUSES + f"3. {more}\n", "unknown-conditions") for more in ("This software may not be used by the military.", "You must send a postcard to the author.", "Modified versions must carry another name.")]
    cases += [(BSD_CLAUSES, "BSD-2-Clause"), (BSD_CLAUSES + "\nTHIS SOFTWARE IS PROVIDED BY ACME LTD \"AS IS\".\n", "BSD-2-Clause")]
    cases += [(gnu(n), "GPL-3.0-or-later") for n in ("Bash", "GNU Emacs", "The Example Compiler 2", "This program")]
    cases += [(gnu("Foo", "Lesser General", "2.1"), "LGPL-2.1-or-later"), (gnu("Bar", "Affero General", "3", False), "AGPL-3.0-only"), (gnu("This library", "Lesser General", "3"), "LGPL-3.0-or-later")]
    cases += [(MIT_GRANT, "MIT"), (MIT_GRANT + "\nExcept as contained in this notice, the name of the X Consortium shall not be\nused in advertising or otherwise to promote the sale, use or other dealings in\nthis Software without prior written authorization from the X Consortium.\n", "X11")]
    cases += [("Permission to use, copy, modify, distribute, and sell this software and its\ndocumentation for any purpose is hereby granted without fee, provided that\nthe above copyright notice appear in all copies and that both that\ncopyright notice and this permission notice appear in supporting\ndocumentation, and that the name of Some Body not be used in advertising.", "HPND-sell-variant")]
    cases += [("            DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\n                    Version 2, December 2004\n\nCopyright (C) 2004 Some Body\n\n            DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\n   TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION\n\n  0. You just DO WHAT THE FUCK YOU WANT TO.\n", "WTFPL")]
    cases += [("1. Buy rights.\n2. Sell licences.\n3. Be useful.", None), ("Bash is free software, they say, and useful.", None)]
    got = scan_licences(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()
    assert [(r.licence, r.licences) for r in sorted(got, key=lambda r: r.doc_id)] == [(want, want or "") for _, want in cases]


def test_spans_of_the_model_pass_the_check_of_their_kind(spark):
    from tallyframe.llm import pii

    assert pii.holds("card", "4111-1111 1111 1111") and not pii.holds("card", "4111 1111 1111 1112") and not pii.holds("card", "4222222")
    assert pii.holds("ip", "10.0.0.255") and not pii.holds("ip", "10.0.0.256") and not pii.holds("ip", "1.2.3")
    assert pii.holds("phone", "(212) 555-0143") is True and not pii.holds("phone", "555-014") and pii.holds("secret", "x") and not pii.holds("email", "a@")
    rng = random.Random(1)
    texts = [f"paid with {''.join(rng.choice('0123456789') for _ in range(16))} on {rng.choice(['monday', 'the card'])}" for _ in range(300)]
    got = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    cards = [(texts[r.doc_id], x.split(":")) for r in got for x in r.spans.split(",") if x.startswith("card:")]
    assert cards and all(pii.luhn(t[int(a) : int(b)]) for t, (_, a, b) in cards)
