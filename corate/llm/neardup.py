"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its shingles (five words in lower case; a text of fewer words is one
shingle): weight = occurrences x IDF, the latter damped: the shingles of a large group of near copies are
common because of the group, and at full weight the few that differ would part it. Document frequencies cover all documents and are kept for
``2**IDF_BITS`` hashed shingle features: the table has the same size for any corpus, and shingles too
rare to show in it all get the same, largest weight. Samples are drawn so that two texts share one
with the probability of their weighted Jaccard similarity; ``ROWS`` samples make a band, and texts that
share one of ``BANDS`` bands are candidates, verified by the exact weighted Jaccard similarity, or else
by that of the distinct shingles: a large group lowers the weight of what its own copies share.

Candidates are not expanded into all pairs of a bucket. First the members of a few bands are verified against
their bucket's smallest text: what these have linked the others need not test again. Then, of a bucket that still
holds several classes, all pairs of different classes are verified if these are at most ``EACH`` per member, and in a
larger one each member against the smallest text. The members of the larger ones are dealt anew by more samples, by
one more band at a time, each time with all pairs of what has become small enough and the smallest text of what has
not. So the work of these rounds grows with the members, however large a group of copies is. What they have not merged is settled exactly:
in each large bucket that still holds several classes, all pairs of different classes are verified, however many they are.

Pairs are rows only up to ``LISTED`` per member of a bucket. Beyond, the members outside a bucket's largest class meet all
members in cells of bounded size (``_cells``): the rows are members, not pairs, and a cell gives the links that join its
classes. In a cell, the shingles that one member alone has bound its similarity to every other, and the shingles that
two members share are counted for a member and all others at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import free_name, small_broadcast, table, text_or_empty, words, write_stage
from corate.llm.graph import ROW_BYTES, components, merged

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 4   # a pair at 0.8 shares no band with probability (1 - 0.8^4)^10 = 0.005
IDF_BITS = 18
DAMPING = 0.25        # power of the IDF
STARS = (0, 1)        # bands whose buckets' smallest texts are tested first
EACH = 16             # pairs that a member of a bucket may cost when all of them are verified
LISTED = 2            # pairs for each member of a bucket up to which they are rows of their own
CELL_TEXTS, CELL_WORDS = 1 << 11, 1 << 19   # members of a bucket on one side of a cell, and their words
CHUNK = 1 << 14       # shingles weighed at once in a task: what that takes stays in the cache

_P = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
              dtype=np.uint64)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingles(hashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (sorted) and their counts, from the hashes of a text's words."""
    w = np.asarray(hashes, dtype=np.int64).view(np.uint64)
    n = len(w)
    if n == 0:
        return w, np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        k = min(n, SHINGLE)
        s = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            s += w[j: n - k + 1 + j] * _P[j]
        s = _mix(s + np.uint64(k))
    s.sort()
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    return s[first], np.diff(np.append(first, n - k + 1))


def _feature(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - IDF_BITS)).astype(np.int64)


def _frequencies(batches):
    """Per task: in how many documents each hashed feature's shingles occur."""
    total = np.zeros(1 << IDF_BITS, np.int64)
    for pdf in batches:
        held = [_feature(shingles(h)[0]) for h in pdf["_h"]]
        if held:
            total += np.bincount(np.concatenate(held), minlength=1 << IDF_BITS)
    at = np.flatnonzero(total)
    for i in range(0, len(at), 1 << 16):
        part = at[i: i + (1 << 16)]
        yield pd.DataFrame({"feature": part, "n": total[part]})


def _gamma_table() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at 65536 midpoints."""
    x = np.concatenate((np.linspace(0, 1, 200_001) ** 2 * 2, np.linspace(2, 40, 400_001)[1:]))
    cdf = -np.expm1(-x) - x * np.exp(-x)
    return np.interp((np.arange(65536) + 0.5) / 65536, cdf, x)


def _mix32(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint32(16))) * np.uint32(0x7FEB352D)
    z = (z ^ (z >> np.uint32(15))) * np.uint32(0x846CA68B)
    return z ^ (z >> np.uint32(16))


def _sampler(idf):
    gamma = _gamma_table().astype(np.float32)
    log_gamma = np.log(gamma)
    seeds = _mix32(np.arange(1, BANDS * ROWS + 1, dtype=np.uint32) * np.uint32(0x9E3779B9))

    def band_keys(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For every non-empty weighted set its band keys, one row each."""
        start = np.concatenate(([0], np.cumsum([len(s) for s, _ in sets])[:-1]))
        whole = np.concatenate([s for s, _ in sets])
        logw = np.log(np.concatenate([c for _, c in sets]) * idf.value[_feature(whole)]).astype(np.float32)
        e = (whole ^ (whole >> np.uint64(32))).astype(np.uint32)
        place = np.arange(len(e), dtype=np.uint64)
        out = np.zeros((len(sets), BANDS), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(BANDS * ROWS):
                z = _mix32(e ^ seeds[k])
                r, logc = gamma[z & np.uint32(0xFFFF)], log_gamma[z >> np.uint32(16)]
                beta = _mix32(z + np.uint32(0x6C8E9CF5)).astype(np.float32) * np.float32(2.0 ** -32)
                t = np.floor(logw / r + beta)
                loga = logc - r * (t - beta) - r
                # The least of each set and its place: float bits in an order that integers have, the place below.
                u = loga.view(np.uint32)
                u = np.where(u >> np.uint32(31), ~u, u | np.uint32(0x80000000))
                at = np.minimum.reduceat((u.astype(np.uint64) << np.uint64(32)) | place, start) & np.uint64(0xFFFFFFFF)
                sample = _mix(whole[at] ^ _mix(t[at].astype(np.int64).view(np.uint64) + np.uint64(seeds[k])))
                out[:, k // ROWS] = _mix(out[:, k // ROWS] * _P[1] + sample)
            out ^= np.arange(BANDS, dtype=np.uint64) * _P[2]
        return out.view(np.int64)

    def sample(batches):
        for pdf in batches:
            held, rows, weight = [], [], 0
            keys: list = [[] for _ in range(len(pdf))]

            def flush():
                for row, k in zip(rows, band_keys(held), strict=True):
                    keys[row] = k
            for row, h in enumerate(pdf["_h"]):
                s = shingles(h)
                if len(s[0]):
                    held.append(s)
                    rows.append(row)
                    weight += len(s[0])
                if weight >= CHUNK:
                    flush()
                    held, rows, weight = [], [], 0
            if held:
                flush()
            yield pdf.drop(columns="_h").assign(_bands=keys)

    return sample


def _packed(batches):
    """The shingles of each text and their counts as bytes."""
    for pdf in batches:
        sets = [shingles(h) for h in pdf["_h"]]
        yield pd.DataFrame({"_t": pdf["_t"], "_s": [s.tobytes() for s, _ in sets], "_n": [c.astype(np.uint32).tobytes() for _, c in sets]})


def _unpacked(s: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(s, np.uint64), np.frombuffer(n, np.uint32).astype(np.int64)


def similarity(a: tuple, b: tuple, idf: np.ndarray) -> float:
    """Weighted Jaccard similarity of two weighted shingle sets."""
    (sa, ca), (sb, cb) = a, b
    wa, wb = ca * idf[_feature(sa)], cb * idf[_feature(sb)]
    _, i, j = np.intersect1d(sa, sb, assume_unique=True, return_indices=True)
    low = np.minimum(wa[i], wb[j]).sum()
    total = wa.sum() + wb.sum() - low
    return float(low / total) if total > 0 else 0.0


def plain(a: tuple, b: tuple) -> float:
    """Jaccard similarity of the distinct shingles of two texts."""
    both = len(np.intersect1d(a[0], b[0], assume_unique=True))
    total = len(a[0]) + len(b[0]) - both
    return both / total if total else 0.0


def _verifier(idf, least: float):
    def verify(batches):
        last, held = None, None
        for pdf in batches:
            keep = []
            for a, sa, na, sb, nb in zip(pdf["a"], pdf["_sa"], pdf["_na"], pdf["_sb"], pdf["_nb"], strict=True):
                if a != last:
                    last, held = a, _unpacked(sa, na)
                other = _unpacked(sb, nb)
                keep.append(plain(held, other) >= least or similarity(held, other, idf.value) >= least)
            yield pdf.loc[keep, ["_ra", "_rb"]]
    return verify


def _shared(sets: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray):
    """What the texts of a cell share. An element is a shingle and the how manieth of its occurrences it is, so the
    weighted intersection of two texts is the weight of their common elements: per text the distinct shingles and the
    weight, in all and of elements that another text has too, and a function from a text to both intersections with
    each text."""
    at = np.repeat(np.arange(len(sets)), [len(x) for x, _ in sets])
    whole, n = np.concatenate([x for x, _ in sets]), np.concatenate([c for _, c in sets])
    _, e = np.unique(whole, return_inverse=True)
    w, nth = idf[_feature(whole)], np.zeros(len(e), np.int64)
    if len(n) and n.max() > 1:
        row = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        _, e = np.unique(e[row] * int(n.max()) + nth, return_inverse=True)
        at, w = at[row], w[row]
    one = (nth == 0).astype(float)

    def per_text(x):
        return np.bincount(at, x, len(sets))
    held = np.bincount(e)[e] > 1
    figures = per_text(one), per_text(w), per_text(one * held), per_text(w * held)
    at, e, w, one = at[held], e[held], w[held], one[held]
    order = np.argsort(e, kind="stable")
    post, count = at[order], np.bincount(e)
    start, bounds = np.cumsum(count) - count, np.searchsorted(at, np.arange(len(sets) + 1))

    def intersections(i: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(bounds[i], bounds[i + 1])
        n = count[e[own]]
        texts = post[np.repeat(start[e[own]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return tuple(np.bincount(texts, np.repeat(x[own], n), len(sets)) for x in (one, w))
    return figures, intersections


def _cell_links(cell: pd.DataFrame, idf: np.ndarray, least: float) -> list[tuple[str, str]]:
    """Links of a cell that join all its classes that hold similar texts. Pairs are of a left and a right row; two texts
    outside the largest class of their bucket meet in either order, and count in one."""
    t, name = cell["_t"].to_numpy(), cell["_root"].to_numpy()
    left, right, other = (cell[c].to_numpy(bool) for c in ("_left", "_right", "_other"))
    sets = [_unpacked(x, n) for x, n in zip(cell["_s"], cell["_n"], strict=True)]
    _, root = np.unique(name, return_inverse=True)
    links, bound, intersections = [], None, None
    at_least = least - 1e-9    # rounding
    if left.sum() * right.sum() > EACH:
        (pn, pw, sn, sw), intersections = _shared(sets, idf)
        part = at_least / (1 + at_least)

        def bound(i):
            return (np.minimum(sn[i], sn) >= part * (pn[i] + pn)) | (np.minimum(sw[i], sw) >= part * (pw[i] + pw))
    for i in np.flatnonzero(left):
        can = right & (root != root[i]) & (~other | (t > t[i]))
        if bound is not None:
            can &= bound(i)
            if can.sum() > EACH:
                bn, bw = intersections(i)
                can &= (bn >= at_least * (pn[i] + pn - bn)) | (bw >= at_least * (pw[i] + pw - bw))
        for j in np.flatnonzero(can):
            if root[j] != root[i] and (plain(sets[i], sets[j]) >= least or similarity(sets[i], sets[j], idf) >= least):
                links.append((name[i], name[j]))
                root[root == root[j]] = root[i]
    return links


def _cell_verifier(idf, least: float):
    """``_cell_links`` of rows that come sorted by cell."""
    cell = ["_key", "_i", "_j"]

    def verify(batches):
        def links(pdf):
            return pd.DataFrame(_cell_links(pdf, idf.value, least), columns=["a", "b"], dtype=object)
        held = []
        for pdf in batches:
            if not len(pdf):
                continue
            k = pdf[cell].to_numpy()
            if held and (held[-1][cell].to_numpy()[-1] != k[0]).any():
                yield links(pd.concat(held))
                held = []
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1), len(k)]
            for lo, hi in zip(cuts, cuts[1:]):
                held.append(pdf.iloc[lo:hi])
                if hi < len(k):
                    yield links(pd.concat(held))
                    held = []
        if held:
            yield links(pd.concat(held))
    return verify


def _cells(m: DataFrame) -> DataFrame:
    """The rows of the members of buckets in their cells: each chunk of the members outside the largest class (left) meets
    each chunk of all members (right). A bucket of one cell gives each member once."""
    other = F.col("_root") != F.col("_big")
    chunk = F.xxhash64("_t")
    i, j = F.pmod(chunk, F.col("_left_n")).cast("int"), F.pmod(chunk, F.col("_right_n")).cast("int")

    def row(i, j, left, right):
        return F.struct(i.alias("_i"), j.alias("_j"), left.alias("_left"), right.alias("_right"))
    yes, no, zero = F.lit(True), F.lit(False), F.lit(0)

    def each(n):
        return F.sequence(zero, (F.col(n) - 1).cast("int"))
    lefts = F.filter(F.transform(each("_right_n"), lambda x: row(i, x, yes, no)), lambda _: other)
    rights = F.transform(each("_left_n"), lambda x: row(x, j, no, yes))
    rows = F.when((F.col("_left_n") == 1) & (F.col("_right_n") == 1), F.array(row(zero, zero, other, yes))).otherwise(F.concat(lefts, rights))
    return m.select("_key", "_t", "_root", other.alias("_other"), rows.alias("_at"))


def _hashes(text):
    return F.transform(words(F.lower(text)), lambda x: F.xxhash64(x))


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``(_t, _rep, class_id)``: every distinct text (by digest) with the smallest id that has it and
    the smallest id of its class. Written to the shared folder.

    Equal texts are one text from the start. Null and empty texts, and those of white space only, are
    in a class with equal ones alone. A class whose ids are all null has a null id. Rows listed twice
    change nothing; other columns are ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("_id"), F.md5(text_or_empty(text_col)).alias("_t"),
                       _hashes(text_or_empty(text_col)).alias("_h")).withColumn("_len", F.size("_h"))
    counts = slim.select("_h").mapInPandas(_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    n_docs = docs.count()
    freq = np.zeros(1 << IDF_BITS)
    got = counts.toPandas()  # at most 2**IDF_BITS rows for any corpus
    freq[got["feature"].to_numpy(dtype=np.int64)] = got["n"]
    idf = spark.sparkContext.broadcast(np.log1p(max(n_docs, 1) / np.maximum(freq, 1)) ** DAMPING)
    sig = write_stage(slim.mapInPandas(_sampler(idf), f"_id {docs.schema[id_col].dataType.simpleString()}, _t string, _len int, _bands array<long>"),
                      "dup-signatures")
    # One row per text; copies combine before the shuffle.
    texts = write_stage(sig.groupBy("_t").agg(F.min("_id").alias("_rep"), F.first("_bands").alias("_bands"),
                                         F.first("_len").alias("_len")), "dup-texts")
    member = texts.select("_t", "_len", F.posexplode("_bands").alias("_band", "_key"))
    member = write_stage(_buckets(member), "dup-buckets")

    nodes = member.select("_t").distinct().join(texts.select("_t", "_rep"), "_t")
    nodes = write_stage(nodes, "dup-nodes")
    body = docs.select(F.col(id_col).alias("_id"), F.md5(text_or_empty(text_col)).alias("_t"), text_or_empty(text_col).alias("_text"))
    near = small_broadcast(nodes.withColumnRenamed("_t", "_nt"), nodes.count(), 96)
    body = body.join(near, (F.col("_t") == F.col("_nt")) & F.col("_id").eqNullSafe(F.col("_rep")), "left_semi")
    body = body.select("_t", _hashes(F.col("_text")).alias("_h")).mapInPandas(_packed, "_t string, _s binary, _n binary")
    body = write_stage(body.groupBy("_t").agg(F.first("_s").alias("_s"), F.first("_n").alias("_n")), "dup-bodies")
    left, right = (body.select(F.col("_t").alias(t), F.col("_s").alias(f"_s{t}"), F.col("_n").alias(f"_n{t}")) for t in "ab")
    comp, n_comp, tested, n_tested = None, 0, None, 0

    def labelled(m: DataFrame, at: str, root: str) -> DataFrame:
        """``m`` with the class so far of the texts in column ``at``."""
        if comp is None:
            return m.withColumn(root, F.col(at))
        of = small_broadcast(comp.select(F.col("a").alias(at), F.col("b").alias(root)), n_comp, ROW_BYTES)
        return m.join(of, at, "left").withColumn(root, F.coalesce(root, at))

    def cell_links(m: DataFrame) -> DataFrame:
        """Links that join the classes of similar texts in each bucket of ``m``."""
        rows = _cells(m).join(body.select("_t", "_s", "_n"), "_t").select("_key", "_t", "_root", "_other", "_s", "_n", F.explode("_at").alias("_at"))
        rows = rows.select("_key", "_at._i", "_at._j", "_t", "_root", "_other", "_at._left", "_at._right", "_s", "_n")
        rows = rows.repartition("_key", "_i", "_j").sortWithinPartitions("_key", "_i", "_j")
        return rows.mapInPandas(_cell_verifier(idf, least), "a string, b string")

    def merge(links: DataFrame) -> None:
        nonlocal comp, n_comp
        links = write_stage(links, "dup-links")
        if comp is None:
            comp = components(links)
        elif links.take(1):
            comp = merged(comp, components(links))
        n_comp = comp.count()

    def link(pairs: DataFrame, more: DataFrame | None = None) -> None:
        """Verify the pairs of different classes and merge the classes of those that are similar, and those of the links
        ``more``."""
        nonlocal tested, n_tested
        pairs = pairs.distinct()   # several buckets name a pair
        if tested is not None:
            pairs = pairs.join(small_broadcast(tested, n_tested, ROW_BYTES), ["a", "b"], "left_anti")
        pairs = write_stage(pairs, "dup-pairs")
        n_tested += pairs.count()
        links = pairs.join(left, "a").join(right, "b").select("a", "b", "_ra", "_rb", "_sa", "_na", "_sb", "_nb").mapInPandas(
            _verifier(idf, least), "_ra string, _rb string").select(F.col("_ra").alias("a"), F.col("_rb").alias("b"))
        tested = pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b"))
        merge(links if more is None else links.unionByName(more))

    def star(m: DataFrame) -> DataFrame:
        """The pairs of each member of a bucket and the smallest, if their classes differ."""
        s = m.filter(F.col("_t") != F.col("_first")).select(F.col("_first").alias("a"), F.col("_t").alias("b"))
        return labelled(labelled(s, "a", "_ra"), "b", "_rb").filter("_ra <> _rb").select("a", "b", "_ra", "_rb")

    def parted(m: DataFrame) -> DataFrame:
        """The members of buckets that still hold several classes, with their classes, the bucket's largest one, its pairs of
        different classes, and the chunks of members outside the largest class and of all members."""
        label = labelled(m.select(*m.columns), "_t", "_root")
        each = label.groupBy("_key", "_root").agg(F.count("*").alias("_c"), F.sum("_len").alias("_l"))
        # Pairs of different classes in a bucket, from the sizes of its classes.
        n, same = F.sum("_c"), F.sum(F.col("_c").cast("double") * F.col("_c"))
        apart = each.groupBy("_key").agg(((n.cast("double") * n - same) / 2).alias("_apart"), n.alias("_size"), F.sum("_l").alias("_words"),
                                         F.max(F.struct("_c", "_l", "_root")).alias("_most")).filter("_apart > 0")

        def chunks(texts, words):
            return F.greatest(F.ceil(texts / CELL_TEXTS), F.ceil(words / CELL_WORDS), F.lit(1)).cast("long")
        apart = apart.select("_key", "_apart", "_size", F.col("_most._root").alias("_big"), chunks(F.col("_size"), F.col("_words")).alias("_right_n"),
                             chunks(F.col("_size") - F.col("_most._c"), F.col("_words") - F.col("_most._l")).alias("_left_n"))
        apart = write_stage(apart, "dup-apart")
        return write_stage(label.join(small_broadcast(apart, apart.count(), 128), "_key"), "dup-open")

    link(star(member.filter(F.col("_band").isin(*STARS))))
    first = None
    signature = texts.select("_t", "_bands")
    for depth in range(1, BANDS + 1):
        several = parted(member)
        small, large = several.filter(F.col("_apart") <= LISTED * F.col("_size")), several.filter(F.col("_apart") > EACH * F.col("_size"))
        medium = several.filter((F.col("_apart") > LISTED * F.col("_size")) & (F.col("_apart") <= EACH * F.col("_size")))
        first = large if first is None else first
        x = small.select("_key", F.col("_t").alias("a"), F.col("_root").alias("_ra"))
        y = small.select("_key", F.col("_t").alias("b"), F.col("_root").alias("_rb"))
        pairs = x.join(y, "_key").filter("a < b and _ra <> _rb").select("a", "b", "_ra", "_rb")
        link(pairs.unionByName(star(large)), cell_links(medium))
        if depth == BANDS or not large.take(1):
            break
        # One more band, the next of the text's: a row for each large bucket of a text.
        nxt = ((F.col("_band") + 1) % BANDS).cast("int")
        finer = large.select("_t", "_len", "_band", "_key").join(signature, "_t").select(
            "_t", "_len", nxt.alias("_band"), F.xxhash64("_key", F.get("_bands", nxt)).alias("_key"))
        member = write_stage(_buckets(finer), "dup-buckets")
    if first.take(1):
        merge(cell_links(parted(first.select("_key", "_t", "_len"))))
    label = labelled(texts.select("_t", "_rep"), "_t", "_root")
    names = label.groupBy("_root").agg(F.min("_rep").alias("class_id"))
    out = write_stage(label.join(names, "_root").select("_t", "_rep", "class_id"), "dup-classes")
    out._signatures = sig
    return out


def _buckets(member: DataFrame) -> DataFrame:
    """``member`` rows of keys that several texts have, with the smallest text of the key."""
    full = member.groupBy("_key").agg(F.count("*").alias("_size"), F.min("_t").alias("_first")).filter("_size > 1").drop("_size")
    return member.join(full, "_key")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row ``(<id_col>, class_id)`` per row of ``docs``; see ``classes`` for the cases."""
    c = classes(docs, id_col=id_col, text_col=text_col, least=least)
    return c._signatures.select("_id", "_t").join(c, "_t").select(F.col("_id").alias(id_col), "class_id")


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class, that with the smallest id; all columns stay. Rows
    listed twice go too."""
    c = classes(docs, id_col=id_col, text_col=text_col, least=least)
    rows = c._signatures.select("_id", "_t").join(c, "_t")
    t, gone_id, gone_t = (free_name(docs, x) for x in ("_t", "_gone_id", "_gone_t"))
    gone = write_stage(rows.filter(~F.col("_id").eqNullSafe(F.col("class_id")) | ~F.col("_id").eqNullSafe(F.col("_rep"))
                                   ).select(F.col("_id").alias(gone_id), F.col("_t").alias(gone_t)).distinct(), "dup-gone")
    keyed = docs.withColumn(t, F.md5(text_or_empty(text_col)))
    same = (F.col(t) == F.col(gone_t)) & F.col(id_col).eqNullSafe(F.col(gone_id))
    kept = keyed.join(small_broadcast(gone, gone.count(), 96), same, "left_anti")
    n = c._signatures.groupBy("_id", "_t").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    return (kept.dropDuplicates([id_col, t]) if n else kept).select(*docs.columns)


def q_op3(spark, sf_dir):
    """Near-duplicate classes of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
