"""Conversation repair, importance resampling and bit-sliced search against brute force, and their edge cases."""

import collections
import functools
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corate.llm import bitsliced, conversation, resampling

SF = "/root/testdata/sf0.01"
SPACE = "\x20\x09-\x0D"


# -- conversation repair ----------------------------------------------------------------------

def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def brute_audit(rows):
    """One conversation; every edit at every turn, by recursion over the roles given so far."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        s = re.sub(f"[{SPACE}]+$", "", text)
        faults.append("blank" if not s else "duplicate" if (role, text) in seen else None if s[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = {r[1] for r in rows} - {None}

    @functools.cache
    def best(i, last):
        """(cost, audit, roles given) from turn i on; last: the role given before."""
        ways = []
        if i == len(rows) and last in ("", "a"):
            ways.append((0, "", ()))
        follow = "a" if last == "u" else "u"
        if i < len(rows):
            c, a, o = best(i + 1, last)
            ways.append((c + 3, "D" + a, o))
            if faults[i] not in ("blank", "duplicate"):
                role, more = rows[i][2][:1], faults[i] == "truncated"
                if role == follow or role == "s" and last == "":
                    c, a, o = best(i + 1, role)
                    ways.append((c + more, "K" + a, (f"{rows[i][2]}:{rows[i][3]}", *o)))
                c, a, o = best(i + 1, follow)
                ways.append((c + more + 2, "R" + a, (("user:" if follow == "u" else "assistant:") + rows[i][3], *o)))
        if i < len(rows) or last in ("s", "u"):
            # An insertion is followed by the pair's other half at most: three in a row can lose one pair.
            for n in (1, 2):
                now, names = last, []
                for _ in range(n):
                    now = "a" if now == "u" else "u"
                    names.append("user:" if now == "u" else "assistant:")
                nxt = without_insert(i, now)
                if nxt:
                    ways.append((nxt[0] + 2 * n, "I" * n + nxt[1], (*names, *nxt[2])))
        return min(ways) if ways else (10 ** 9, "", ())

    @functools.cache
    def without_insert(i, last):
        ways = []
        if i == len(rows):
            return (0, "", ()) if last in ("", "a") else None
        follow = "a" if last == "u" else "u"
        c, a, o = best(i + 1, last)
        ways.append((c + 3, "D" + a, o))
        if faults[i] not in ("blank", "duplicate"):
            role, more = rows[i][2][:1], faults[i] == "truncated"
            if role == follow or role == "s" and last == "":
                c, a, o = best(i + 1, role)
                ways.append((c + more, "K" + a, (f"{rows[i][2]}:{rows[i][3]}", *o)))
            c, a, o = best(i + 1, follow)
            ways.append((c + more + 2, "R" + a, (("user:" if follow == "u" else "assistant:") + rows[i][3], *o)))
        return min(ways)

    cost, audit, out = best(0, "")
    n = collections.Counter(faults)
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def by_conversation(rows):
    out = collections.defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


def random_rows(seed, n, longest):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for t in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
            text = r.choice(["Yes.", "no", "", None, " \t", "a. b", "What? \n", f"turn {t}!", f"turn {t}"])
            rows.append((conv if conv else None, r.choice([t, t, t, t + 3, None]), role, text))
    return rows


@pytest.mark.parametrize("longest", [6, 90])
def test_repair_is_the_cheapest(spark, longest):
    rows = random_rows(longest, 150 if longest < 10 else 12, longest)
    rows += rows[:5]
    d = spark.createDataFrame(rows, SCHEMA).withColumn("_c", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("edit", F.lit("e")).repartition(3)
    damaged = brute_damage(rows)
    assert sorted(map(str, conversation.damage(d).collect())) == sorted(map(str, spark.createDataFrame(damaged, SCHEMA).collect()))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in conversation.audit(conversation.damage(d), d.select("conv_id")).collect()}
    groups = by_conversation(damaged)
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        assert got[conv] == brute_audit(groups.get(conv, [])), conv


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (1, 2, "user", "cut"), (1, 2, "user", "cut"), (1, 3, "assistant", " "), (2, 5, "user", "U" * 1_000_000 + ".")]
    got = conversation.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "step").collect()
    assert [(r.edit, r.turn, r.role, r.text, r.fault) for r in got if r.conv_id == 1] == [
        ("K", 0, "system", "S.", None), ("I", None, "user", "", None), ("K", 1, "assistant", "A.", None), ("D", 2, "user", "cut", "truncated"),
        ("D", 2, "user", "cut", "duplicate"), ("D", 3, "assistant", " ", "blank")]
    assert [(r.edit, r.role, len(r.text)) for r in got if r.conv_id == 2] == [("K", "user", 1_000_001), ("I", "assistant", 0)]
    none = spark.createDataFrame([], SCHEMA)
    assert conversation.repair(none).count() == 0 and conversation.audit(none, none.select("conv_id")).count() == 0


def test_a_long_conversation_repeats_the_short_one(spark):
    """2,000 sound turns and one system turn too late: the pieces meet without a further edit."""
    rows = [(7, i, ("user", "assistant")[i % 2], f"t{i}.") for i in range(2000)]
    rows[1001] = (7, 1001, "system", "late.")
    r = conversation.audit(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()[0]
    assert (r.cost, r.audit, r.illegal) == (2, "K" * 1001 + "R" + "K" * 998, 1)


# -- importance resampling --------------------------------------------------------------------

def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def grams(t, n):
    w = words(t)
    return [" ".join(w[i: i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


TEXTS = ["The cat, the CAT; naïve Äpfel 42x7!", "", None, "a", " \t\n", "x" * 70_000 + " y " + "z" * 300, "日本語 text İstanbul", "one two three " * 4000] + [
    " ".join(random.Random(i).choices("alpha beta gamma delta epsilon zeta eta theta iota kappa".split(), k=5 + i)) for i in range(60)]


@pytest.mark.parametrize("n", [1, 3])
def test_crcs_of_all_word_runs(n):
    crcs, doc, count = resampling.ngram_crcs([None if t is None else t.encode() for t in TEXTS], n)
    assert count.tolist() == [len(words(t)) for t in TEXTS]
    for i, t in enumerate(TEXTS):
        assert sorted(crcs[doc == i].tolist()) == sorted(zlib.crc32(g.encode()) for g in grams(t, n))


def brute_resample(docs, target, n, buckets, share, least):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (collections.Counter(bucket(g) for x in texts for g in grams(x, n)) for texts in ([d[1] for d in docs], target))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for i, x in docs:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        g = grams(x, n)
        w = sum(gain(bucket(y)) for y in g)
        rows.append((i, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[: math.floor(share * len(able) / 100)])}
    return sorted(str((*r[:4], rank.get(id(r)))) for r in rows)


@pytest.mark.parametrize("n,buckets,share", [(1, 10_000, 10), (2, 97, 40), (2, 70_000, 100)])
def test_resampling(spark, n, buckets, share):
    docs = [(i if i != 9 else None, t) for i, t in enumerate(TEXTS)] + [(20, TEXTS[20]), (21, "another text under an id seen before " * 5)]
    target = ["alpha alpha beta the cat", None, "gamma delta iota one two"]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_id", F.lit("x")).withColumn("words", F.lit(1)).withColumn("rank", F.lit(2)).repartition(4)
    t = spark.createDataFrame([(x,) for x in target], "text string").withColumn("_none", F.lit("y"))
    got = resampling.resample(d, t, n=n, buckets=buckets, share=share)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = got.collect()
    # Rows that are equal may change places.
    plain = lambda rows: sorted(rows)
    assert plain(str(tuple(r)) for r in rows) == brute_resample(docs, target, n, buckets, share, 20)
    assert resampling.resample(d.limit(0), t, n=n, buckets=buckets).count() == 0
    assert resampling.resample(d, t.limit(0), n=n, buckets=buckets).count() == len(docs)


# -- bit-sliced search ------------------------------------------------------------------------

def brute_top(rows, queries, k):
    data = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = collections.defaultdict(list)
    for q, mine in {d for d in data if d[0] in queries}:
        found[q] += [(-sum(a * b for a, b in zip(mine, v, strict=True)), i) for i, v in data if i != q and len(v) == len(mine)]
    return [(q, r + 1, i, -x) for q in sorted(found) for r, (x, i) in enumerate(sorted(found[q])[:k])]


@pytest.mark.parametrize("block,chunk", [(100, 7), (8192, 2048)])
def test_bit_sliced_search(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(bitsliced, "CHUNK", chunk)
    monkeypatch.setattr(bitsliced.build_index, "__defaults__", (block,))
    r = np.random.default_rng(1)
    x = r.standard_normal((700, 12)) * r.uniform(0.01, 2, (700, 1))
    x[300:450] = x[299]                               # a group of copies
    x[500:520] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist()), (50, x[9].tolist()), (None, x[1].tolist()), (800, None), (850, [1.0, None] * 6),
                                                       (900, [float("inf")] + [0.0] * 11), (950, [1.0, -2.0]), (951, [3.0, 4.0]), (1000, [])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("whole", F.lit(1)).withColumn("_block", F.lit("b")).repartition(3)
    got = sorted(tuple(q) for q in bitsliced.top_k(d, d.filter("vec_id % 50 = 0")).collect())
    assert got == brute_top(rows, range(0, 2000, 50), 5)
    assert bitsliced.top_k(d.limit(0), d).count() == 0 and bitsliced.top_k(d, d.limit(0)).count() == 0


def test_bit_sliced_search_of_large_values(spark):
    rows = [(0, [8e6, -8e6, 1.0]), (1, [8e6, 0.5, 0.0]), (2, [-8e6, -8e6, 3.0]), (3, [0.0, 0.0, 0.0]), (4, [1.0, -1.0, 1.0])] + [(i, [i * 1000.0, -i / 1.0, 0.1]) for i in range(5, 30)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(q) for q in bitsliced.top_k(d, d.filter("vec_id % 50 = 0")).collect()) == brute_top(rows, [0], 5)
    huge = spark.createDataFrame([(0, [1e300] * 3), (1, [1e300] * 3), (2, [1.0] * 3), (3, [-1e300] * 3)], "vec_id long, embedding array<double>")
    assert [(q.vec_id, q.score) for q in bitsliced.top_k(huge, huge.filter("vec_id = 0")).orderBy("rank").collect()] == [
        (1, (1 << 63) - 1), (2, 3 * 256 << 31), (3, -(1 << 63))]
