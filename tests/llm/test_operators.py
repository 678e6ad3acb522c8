"""The training-data operators against brute force on small fixtures, and their edge cases."""

import base64
import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corate.llm import decontam, graph, licenses, lm, mixing, neardup, neighbours, pii, tokens, toxicity, warc
from corate.llm.graph import components, merged
from corate.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, mix_size string, p_toxic string, spans int"
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def prose(seed: int, n: int = 60) -> list[str]:
    r = np.random.default_rng(seed)
    return ["".join(r.choice(list("abcdefghijklmnop"), 5)) for _ in range(n)]


def edge_rows():
    base = prose(1)
    near = base[:30] + ["changed"] + base[31:]
    far = base[:30] + prose(2)[:30]
    return [
        (1, " ".join(base), "en", "a", 10, "x", "y", 1), (2, " ".join(near), None, "a", None, None, None, None),
        (3, " ".join(base), "en", None, 1, "x", "y", 1), (4, None, None, None, None, None, None, None),
        (5, "", "en", "b", 0, "x", "y", 1), (6, " \t\n", "en", "b", 0, "x", "y", 1), (7, " ".join(far), "en", "b", 0, "x", "y", 1),
        (8, "one two", "en", "b", 0, "x", "y", 1), (8, "one two", "en", "b", 0, "x", "y", 1), (None, "ONE  two", "en", "c", 0, "x", "y", 1),
        (10, " ".join(prose(3, 4000)), "en", "c", 0, "x", "y", 1),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_mix_targets_and_copies(docs, none):
    rows = mixing.schedule(docs).collect()
    assert len(rows) == len(edge_rows())
    size = {s: sum(len((t or "").split()) for _, t, _, x, *_ in edge_rows() if x == s) for s in ("a", "b", "c", None)}
    taken = collections.Counter()
    for r in rows:
        assert r.mix_size == len((r.text or "").split()) and r.mix_source_size == size[r.source] and 0 <= r.mix_copies <= 3
        taken[r.source] += r.mix_size * r.mix_copies
    total, target = sum(size.values()), {r.source: r.mix_target for r in rows}
    assert math.isclose(sum(target.values()), total)
    full = {s for s in target if math.isclose(target[s], 3 * size[s])}
    weight = {"a": 5, "b": 2, "c": 1, None: 5}
    level = {round(target[s] / weight[s], 6) for s in target if s not in full}
    assert len(level) <= 1 and sum(taken.values()) <= total
    assert sorted(map(str, rows)) == sorted(map(str, mixing.schedule(docs).collect()))
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == sum(r.mix_copies for r in rows) and [m.mix_finish for m in mixed] == sorted(m.mix_finish for m in mixed)
    assert mixing.schedule(none).count() == 0 and mixing.mix(none).count() == 0


def test_templates_catch_other_values(spark, none):
    item = "A farmer named Hans sells 12 apples and 7 pears to Maria for 30 dollars each morning before Hans walks home."
    other = item.replace("Hans", "Otto").replace("12", "99").replace("Maria", "Erika").replace("30", "4").replace("dollars", "euros")
    mixed = item.replace("named Hans", "named Otto")  # two names for one: another question
    bench = spark.createDataFrame([(1, item), (1, item), (2, "too short"), (3, None)], "item_id long, text string")
    rows = [(1, "Before it. " + item + " After it."), (2, "Well, " + other), (3, mixed), (4, " ".join(prose(5))), (5, None), (6, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontam.contaminated(d, bench).collect()}
    assert got == {(1, 1): "verbatim", (2, 1): "reparameterised"}
    wide = d.withColumn("kind", F.lit("k")).withColumn("matched", F.lit(1))
    left = decontam.decontaminate(wide, bench)
    assert left.columns == wide.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6]
    assert decontam.contaminated(none, bench).count() == 0 and decontam.contaminated(d, bench.limit(0)).count() == 0


def test_templates_survive_inserted_and_missing_words(spark):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = bench.orderBy("item_id").collect()
    rows = []
    for k, r in enumerate(items):
        w = r.text.split()
        at = len(w) // 2
        rows += [(3 * k, "Well then. " + " ".join(w) + " So it is."), (3 * k + 1, "Then: " + " ".join([*w[:at], "really", *w[at:]])),
                 (3 * k + 2, "And. " + " ".join(w[:at] + w[at + 1:]) + " The end.")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_k1", F.lit("a")).withColumn("_K2", F.lit("b"))
    found = {r.doc_id for r in decontam.contaminated(d.drop("_k1", "_K2"), bench).collect()}
    for kind in range(3):
        assert len([i for i in found if i % 3 == kind]) >= 0.95 * len(items), kind
    left = decontam.decontaminate(d, bench).collect()
    assert {r.doc_id for r in left} == set(range(3 * len(items))) - found and all((r._k1, r._K2) == ("a", "b") for r in left)


def jaccard(a, b):
    def sh(t):
        w = t.lower().split()
        return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()
    x, y = sh(a), sh(b)
    total = sum((x | y).values())
    return sum((x & y).values()) / total if total else 0.0


def test_near_duplicates(docs, none, spark):
    got = {(r.doc_id, r.class_id) for r in neardup.near_duplicates(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 7), (8, 8), (None, 8), (10, 10)}  # null and '' are equal texts
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 7, 8, 10]
    assert neardup.near_duplicates(none).count() == 0 and neardup.deduplicate(none).count() == 0


def test_near_duplicates_find_all_links(spark):
    r = np.random.default_rng(7)
    texts = []
    for g in range(30):
        base = prose(100 + g, 200)
        for _ in range(4):
            t = list(base)
            for at in r.choice(200, r.integers(0, 4), replace=False):
                t[at] = "x" + str(r.integers(1000))
            texts.append(" ".join(t))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {x.doc_id: x.class_id for x in neardup.near_duplicates(d).collect()}
    for i in range(len(texts)):
        for j in range(i):
            s = jaccard(texts[i], texts[j])
            if s >= 0.84:
                assert got[i] == got[j], (i, j, s)
            if i // 4 != j // 4:
                assert got[i] != got[j]


def test_near_duplicates_in_a_large_group(spark):
    base = prose(500, 120)  # 16 versions, each with two words of its own, 20 copies of each: no two differ by less
    texts = [" ".join([*base[:4 + 7 * i], f"x{i}", f"y{i}", *base[6 + 7 * i:]]) for i in range(16)]
    assert all(0.8 <= jaccard(a, b) < 0.82 for a in texts for b in texts if a != b)
    rows = [(i, texts[i % 16]) for i in range(320)] + [(1000 + i, " ".join(prose(1000 + i))) for i in range(20)]
    got = {x.doc_id: x.class_id for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert all(got[i] == 0 for i in range(320)) and all(got[i] == i for i in range(1000, 1020))


@pytest.mark.parametrize("texts_per_cell", [neardup.CELL_TEXTS, 50])
def test_near_duplicates_of_many_classes_are_no_rows_of_pairs(spark, monkeypatch, texts_per_cell):
    r = np.random.default_rng(5)
    base = prose(700, 100)
    texts = []
    for i in range(28):  # two of eight places of the text are other words: only texts with the same two are similar
        a, b = [(x, y) for x in range(8) for y in range(x)][i]
        for _ in range(8):
            t = list(base)
            t[5 + 12 * a], t[5 + 12 * b] = (f"x{r.integers(10 ** 9)}" for _ in range(2))
            texts.append(" ".join(t))
    want = [min(j for j in range(len(texts)) if jaccard(texts[i], texts[j]) >= 0.8) for i in range(len(texts))]
    assert want == [i // 8 * 8 for i in range(len(texts))]
    made, write = [], neardup.write_stage

    def counted(df, name):
        out = write(df, name)
        if name == "dup-pairs":
            made.append(out.count())
        return out
    monkeypatch.setattr(neardup, "write_stage", counted)
    monkeypatch.setattr(neardup, "DAMPING", 0.0)
    monkeypatch.setattr(neardup, "CELL_TEXTS", texts_per_cell)
    got = {x.doc_id: x.class_id for x in neardup.near_duplicates(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert sum(made) <= 8 * len(texts)  # of 25,000 pairs


def test_links_of_a_cell_are_those_of_all_pairs():
    r = np.random.default_rng(6)
    sets = [neardup.shingles(r.integers(0, 3, 12 + i % 3)) for i in range(60)]
    idf = 1 + np.arange(1 << neardup.IDF_BITS) % 7
    t = [f"{i:02}" for i in range(60)]
    cell = pd.DataFrame({"_t": t, "_root": t, "_left": True, "_right": True, "_other": True, "_s": [s.tobytes() for s, _ in sets],
                         "_n": [c.astype(np.uint32).tobytes() for _, c in sets]})
    for least in (0.2, 0.4):
        want, got = list(range(60)), list(range(60))
        similar = [(i, j) for i in range(60) for j in range(i) if neardup.plain(sets[i], sets[j]) >= least or neardup.similarity(sets[i], sets[j], idf) >= least]
        for classes, pairs in ((want, similar), (got, [(int(a), int(b)) for a, b in neardup._cell_links(cell, idf, least)])):
            for a, b in pairs:
                lo, hi = sorted((classes[a], classes[b]))
                classes[:] = [lo if x == hi else x for x in classes]
        assert got == want and 1 < len(set(want)) < 60


def test_components(spark):
    pairs = [(f"{i:03}", f"{i + 1:03}") for i in range(40) if i not in (10, 25)] + [("100", "000")] + [("200", f"{i}") for i in range(201, 260)]
    got = {r.a: r.b for r in components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert {got.get(f"{i:03}", f"{i:03}") for i in range(11)} == {"000"} and got["100"] == "000"
    assert {got.get(f"{i:03}", f"{i:03}") for i in range(11, 26)} == {"011"} and got["259"] == "200"


def test_components_merge(spark):
    comp = spark.createDataFrame([("b", "a"), ("d", "c"), ("f", "e")], "a string, b string")
    between = components(spark.createDataFrame([("e", "c"), ("c", "x"), ("c", "e")], "a string, b string"))
    got = {(r.a, r.b) for r in merged(comp, between).collect()}
    assert got == {("b", "a"), ("d", "c"), ("e", "c"), ("f", "c"), ("x", "c")}


def luhn(d):
    return sum((v - 9 if v > 9 else v) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def brute_spans(t):
    out = [(m.start(), 0, f"email:{m.start()}:{m.end()}") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, f"ip:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        out += [(m.start(), 2, f"card:{m.start()}:{m.end()}")] if 12 <= len(d) <= 19 and luhn(d) else []
    out += [(m.start(), 3, f"phone:{m.start()}:{m.end()}") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [x[2] for x in sorted(out)]


def test_base_spans(spark):
    r = np.random.default_rng(3)
    bits = ["a.b@c.de", "%d@e.f.g", "@", "é", "10.0.0.1", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.00.1.7", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "+49 (30) 1234-567 8", "+1", " ", "x", "\U0001F600", "1 2 3 4 5 6 7 8 9 0 1 2 3", "5", "-", "99999999999.1.1.1"]
    texts = ["".join(r.choice(bits, r.integers(1, 14))) for _ in range(150)] + ["7 " * 3000, "1" * 5000, "a" * 5000 + "@", "", None]
    got = {x.i: x.s for x in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select(
        "i", pii._joined(pii._sorted_spans(pii.base_spans(F.coalesce("t", F.lit(""))))).alias("s")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == ",".join(brute_spans(t or "")), t


def test_disclosing_terms(spark, none):
    rows = [(i, f"Common filler zanzibar{'x'} writes to anna@example.com about quarterly matters") for i in range(4)]
    rows = [(i, f"Common filler Zanzibar number {i} writes to anna@example.com today") for i in range(4)]
    rows += [(10 + i, "Common filler number writes today to nobody " + " ".join(prose(i, 10))) for i in range(40)] + [(90, None), (91, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long")).withColumn("base", F.lit(1))
    f = {r.doc_id: r for r in pii.find(d).collect()}
    kinds = {s.value: s.kind for s in f[0].spans}
    assert kinds == {"anna@example.com": "email", "zanzibar": "remove"} and all(not f[i].spans for i in range(10, 50))
    out = pii.sanitise(d)
    s = {r.doc_id: r for r in out.collect()}
    assert out.columns == d.columns and s[0].text == "Common filler  number 0 writes to [EMAIL] today" and s[0].n_chars == len(s[0].text)
    assert s[10].text == dict(rows)[10] and s[90].text is None and s[91].text == ""
    assert pii.find(none).count() == 0 and pii.sanitise(none).count() == 0


def test_disclosing_terms_of_rare_entities(spark):
    rows = [(0, "Common filler Zanzibar writes to anna@example.com today"), (1, "Common filler Quixote writes to ben@example.com today"),
            (2, "Common filler Quixote writes again to ben@example.com today")]
    rows += [(10 + i, "Common filler again writes today to nobody") for i in range(60)]
    f = {r.doc_id: {s.value: s.kind for s in r.spans} for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert f[0] == {"anna@example.com": "email", "zanzibar": "generalise"} and not any(f[i] for i in range(10, 70))
    assert f[1] == f[2] == {"ben@example.com": "email", "quixote": "generalise"}


def test_disclosing_terms_anywhere_in_the_document(spark):
    far = "Common filler writes " * 12
    first = "Ann Zanzibar, mail anna@example.com " + far + "and Zanzibar again with Ann or 京子, in full 我是京子的朋友"
    rows = [(0, first), (1, far + "Kim: ben@example.com"), (2, "ben@example.com " + far + "Kim"), (3, "ben@example.com " + far + "KIM")]
    rows += [(10 + i, far + "and again mail with or in full to nobody") for i in range(60)]
    f = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for s in f[0]:
        assert first[s.start:s.stop].lower() == s.value
    where = lambda w: {m.start() for m in re.finditer(w, first)}
    for w in ("Zanzibar", "Ann", "京子"):
        assert {s.start for s in f[0] if s.value == w.lower() and s.kind == "generalise"} == where(w) and len(where(w)) == 2
    assert [[(s.kind, s.value) for s in f[i] if s.kind != "email"] for i in (1, 2, 3)] == [[("remove", "kim")]] * 3
    assert not any(f[i] for i in range(10, 70))


def test_components_equal_union_find(spark):
    r = random.Random(5)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(140)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(5001, 5030)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for x, y in links:
        x, y = root(x), root(y)
        up[max(x, y)] = min(x, y)
    got = [(e.a, e.b) for e in graph.components(spark.createDataFrame(links, "a long, b long")).collect()]
    assert sorted(got) == sorted((x, root(x)) for x in up if root(x) != x)


def test_licences(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "nothing here"), ("a/b/LICENSE", "Licensed under CC BY-NC 4.0."),
            ("a/y.py", "# Licensed under the Apache License, Version 2.0.\n" + " ".join(prose(1))), ("z.py", None), (None, ""), ("ab/x", "under the license of")]
    rows += [(f"q/{i}", " ".join(prose(i)) + " under the version") for i in range(30)]
    f = spark.createDataFrame([(p, t, "mine") for p, t in rows], "path string, text string, license string")
    got = {r.path: (r.license, r.license_origin, r.license_dir) for r in licenses.scan(f).collect()}
    assert got["a/b/c/x.py"] == ("CC-BY-NC-4.0", "inherited", "a/b") and got["a/y.py"] == ("Apache-2.0", "own", None)
    assert got["a/LICENSE"] == ("MIT", "own", None) and got["ab/x"] == got["z.py"] == got[None] == got["q/3"] == (None, None, None)
    assert licenses.scan(f.limit(0)).count() == 0


def test_licence_texts_headers_and_tags(spark):
    mit = ("MIT License\n\nCopyright (c) 2020 Jane Doe\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including")
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as\n"
           "# published by the Free Software Foundation, either version 3 of\n# the License, or (at your option) any later version.\n")
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    rows = {"m/LICENSE": (mit, "MIT"), "m/a.py": ("# Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use", "Apache-2.0"),
            "m/b.py": ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"), "m/c.py": (gpl + "import x", "GPL-3.0"),
            "m/d.py": (gpl.replace("General", "Lesser General"), "LGPL-3.0"), "m/e.py": ("SPDX-License-Identifier: EUPL-1.2", "unrecognised"),
            "m/f.py": (gpl.replace("version 3", "version 9") + "licensed under it", "unrecognised"), "m/g.py": ("SPDX-License-Identifier: MIT-0", "MIT-0"),
            "m/h.py": (bsd, "BSD-2-Clause"), "m/i.py": (bsd + " neither the name of Foo Inc nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission", "BSD-3-Clause"),
            "m/j.py": (" ".join(prose(3, 300)) + " licensed under CC BY-SA 4.0 " + " ".join(prose(4, 20000)), "CC-BY-SA-4.0"),
            "m/k.py": ("mit apache gnu spdx fee hereby", "MIT"), "m/l.py": ("mit", "MIT"), "m/m.py": ("spdx", "MIT"),
            "n/x.py": ("the mit press and the license of a driver", None)}
    f = spark.createDataFrame([(p, t) for p, (t, _) in rows.items()] * 2, "path string, text string")
    got = licenses.scan(f).collect()
    assert len(got) == 2 * len(rows) and {(r.path, r.license) for r in got} == {(p, want) for p, (_, want) in rows.items()}
    assert {r.path for r in got if r.license_origin == "inherited"} == {"m/k.py", "m/l.py", "m/m.py"}


def test_token_files(spark):
    enc = tokens._encoder(open(TOKENIZER, "rb").read())
    odd = [t for t in range(50256) if t >> 8 == 0x50][:40]  # high byte that starts a false separator
    low = [t for t in range(50256) if t & 255 == 0xC4][:40]
    texts = [enc.decode([a, b] * 5) for a, b in zip(odd, low, strict=True)] + ["", None, "<|endoftext|> x"] + [" ".join(prose(i, 300)) for i in range(20)]
    rows = [(i if i != 7 else -5, t) for i, t in enumerate(texts)] + [(None, "no id"), (1 << 62, "big")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = tokens.count_tokens(spark, tokens.write_token_files(d, scratch_path(spark, "t"))).collect()
        assert sorted(map(str, ((r.doc_id, r.n_tokens) for r in got))) == sorted(
            str((i, len(enc.encode_ordinary(t or "")))) for i, t in rows)
        assert tokens.count_tokens(spark, tokens.write_token_files(d.limit(0), scratch_path(spark, "t"))).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size", ["900", "10m"])
def test_archives_with_magic_in_payloads(spark, size):
    trap = "y WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n" * 3 + "é"
    rows = [(1, "http://a", "x" * 50), (2, "u\r\nv", trap), (3, None, None), (4, "c", trap), (5, "d", "WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n")]
    rows += [(i, "z", "WARC/1.1\r\n" * (i % 5) + str(i) * 200) for i in range(6, 60)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("type", F.lit(1)).repartition(2)
        got = {int(r.id[10:-1]): r for r in warc.read_archives(spark, warc.write_archives(pages, scratch_path(spark, "w"))).collect()}
        assert len(got) == len(rows) and all(r.intact for r in got.values())
        for i, _, h in rows:
            b = (h or "").encode()
            assert (got[i].payload_bytes, got[i].payload_digest) == (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode())
        assert got[4].type == "revisit" and got[4].refers == "<urn:page:2>" and got[2].uri == "u%0D%0Av"
        assert warc.read_archives(spark, warc.write_archives(pages.limit(0), scratch_path(spark, "w"))).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_class_model(docs, none):
    got = lm.scores(docs).collect()
    rows = [(i, (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) for i, t, *_ in edge_rows()]
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t), zlib.crc32(str(i if i is not None else "").encode()) % 10 == 0) for i, t in rows]
    c = collections.Counter(w for _, ws, held in words if not held for w in [*ws, "\0"])
    n, v = sum(c.values()), len(c)
    want = sorted(str((i, held, len(ws) + 1, sum(c[w] > 0 for w in [*ws, "\0"]), n,
                       round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*ws, "\0"]), 5))) for i, ws, held in words)
    assert sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5))) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.scores(none).count() == 0


def test_exchange_raises_likelihood():
    r = np.random.default_rng(0)
    kind = r.integers(0, 2, 40)
    n = np.where(kind[:, None] != kind, 50, 1) + r.integers(0, 3, (40, 40))  # two classes that alternate
    a, b = np.indices((40, 40)).reshape(2, -1)
    e = lm.Exchange(a, b, n.ravel(), 40, np.arange(40) % 8, 8)
    seen = e.run()
    assert all(x <= y + 1e-12 for x, y in zip(seen, seen[1:])) and seen[-1] > seen[0]
    assert all(len(set(kind[e.classes == c])) == 1 for c in set(e.classes))
    again = np.zeros((8, 8))
    np.add.at(again, (e.classes[a], e.classes[b]), n.ravel())
    assert np.allclose(again, e.n)   # the counts that followed the moves are those of the classes


def test_a_batch_is_taken_in_slices(monkeypatch):
    monkeypatch.setattr(lm, "SLICE", 50)
    seen, real = [], lm._sequence
    monkeypatch.setattr(lm, "_sequence", lambda pdf, own: seen.append(sum(len(x) + 1 for x in pdf["_h"])) or real(pdf, own))
    size = [0, 49, 1, 20, 30, 200, 0, 7, *[3] * 40]
    pdf = pd.DataFrame({"_h": [np.arange(n, dtype=np.int64) for n in size], "_e": [np.zeros(n, np.int32) for n in size]})
    own = type("own", (), {"value": np.arange(9, dtype=np.int64)})
    got = pd.concat(lm._bigrams(own)(iter([pdf, pdf.iloc[:0], pdf])))
    assert sum(seen) == 2 * sum(n + 1 for n in size) == got["n"].sum() and max(seen) == 201 and sorted(seen)[-3] <= 50
    assert len(list(lm._slices(iter([pdf])))) > 4 and pd.concat(lm._slices(iter([pdf]))).equals(pdf)


def test_words_beyond_the_table_are_counted_all_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 37}" for j in range(30))) for i in range(60)], "doc_id long, text string")

    def run():
        return sorted((r.doc_id, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in lm.scores(docs).collect())
    want = run()
    monkeypatch.setattr(lm, "TABLE", 3)
    monkeypatch.setattr(lm, "SLICE", 40)
    got = run()
    assert [x[:3] for x in got] == [x[:3] for x in want]


def test_no_round_lowers_the_likelihood_of_the_documents(spark, monkeypatch):
    seen, run = [], lm.Exchange.run
    monkeypatch.setattr(lm.Exchange, "run", lambda self: seen.append(run(self)))
    rows = lm.q_op6(spark, "/root/testdata/sf0.001").collect()
    assert len(seen) == 1 and len(seen[0]) >= 3 and all(x <= y + 1e-12 for x, y in zip(seen[0], seen[0][1:]))
    held = [x for x in rows if x.held_out]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)


def test_neighbours_recall_and_edges(spark):
    r = np.random.default_rng(5)
    centre = r.standard_normal((12, 24))
    x = (centre[r.integers(0, 12, 1500)] + 0.7 * r.standard_normal((1500, 24))) * r.uniform(0.5, 2, (1500, 1))
    rows = [(i, v.tolist(), 1.0) for i, v in enumerate(x)] + [(2000, None, 0.0), (2020, [0.0] * 24, 0.0), (2040, [float("nan")] * 24, 0.0),
                                                          (2060, [None] * 24, 0.0), (2080, [1.0, 2.0], 0.0), (None, x[0].tolist(), 0.0)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    got = collections.defaultdict(list)
    for q in neighbours.nearest(v, v.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        assert math.isclose(q.score, float(x[q.query_id] @ x[q.vec_id]), rel_tol=1e-12)
        got[q.query_id].append(q.vec_id)
    hit = 0
    for i in range(0, 1500, 20):
        s = x @ x[i]
        s[i] = -np.inf
        assert i not in got[i] and len(got[i]) == 20
        hit += len(set(np.lexsort((np.arange(1500), -s))[:20].tolist()) & set(got[i]))
    assert set(got) == set(range(0, 1500, 20)) and hit / (75 * 20) >= 0.9
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(q.rank, q.vec_id) for q in neighbours.nearest(few, few.filter("vec_id = 0")).orderBy("rank").collect()] == [(1, 2), (2, 3), (3, 1)]
    assert neighbours.nearest(v.limit(0), v.limit(0)).count() == 0


def test_toxicity_chain(spark, docs, none):
    bad = ["idiot", "moron", "clown"]
    rows, labels = [], []
    for i in range(400):
        w = prose(i, 30) + ["the", "of"] * 3
        tox = i % 5 == 0
        rows.append((i, " ".join(w[:10] + (bad if tox else []) + w[10:]), "p"))
        if i < 300:
            labels.append((i, i % 3 == 0, tox))
    d = spark.createDataFrame(rows, "doc_id long, text string, p_toxic string")
    lab = spark.createDataFrame([(i, int(q), int(t)) for i, q, t in labels] + [(0, 1, 1), (9999, 1, 1), (None, 1, 1), (301, None, None)], "doc_id long, quality int, toxic int")
    out = toxicity.reject_toxic(d, lab)
    assert out.columns == d.columns and sorted(r.doc_id for r in out.collect()) == [i for i in range(400) if i % 5]
    assert toxicity.score(docs, lab.limit(0)).filter("p_toxic > 0.01").count() == 0
    assert toxicity.score(none, lab).count() == 0 and toxicity.score(docs, lab.filter("toxic = 0")).count() == len(edge_rows())


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as c
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("no test tables")
    names = [n for n, _ in c.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "mixing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = c.run(spark, sf)
    assert set(docs.columns) <= set(out.columns)
    got = out.select("doc_id", "text").collect()
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert got and not any(b in r.text for r in got for b in bench)
    assert not any(re.search(r"[a-z]+\.[0-9]+@mail", r.text) for r in got)
