"""Personal data and information-theoretic sanitisation (DataFrame operations only).

Four kinds of spans are found by pattern. Their values are the protected entities. A term in a document
of an entity discloses it as far as its pointwise mutual information with the entity,
``log2(n(e,t) * N / (n(e) * n(t)))``, comes near the entity's information content ``log2(N / n(e))``;
the ratio is 1 if the term occurs in no other document than those of the entity. A term seen with an
entity in ``n`` documents, fewer than ``SURE``, is less certain to disclose it: its information counts
by the rule of succession, ``(n + 1) / (n + 2)``. Terms are generalised from a ratio of ``GENERALISE``
on and removed from ``REMOVE`` on, wherever they stand in the documents that hold the entity, outside
the base spans. All counts are of whole documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import shielded, small_broadcast, table, text_or_empty, write_stage

SURE = 3            # documents from which on a co-occurrence counts in full
GENERALISE, REMOVE = 0.5, 0.8
KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind:string,start:int,stop:int,value:string>>"

# The patterns of the kinds, written so that no run is scanned twice: a match can only start where a
# run of its characters starts or the last match ended, and repeats never give back (all of them are
# followed by a character outside their class). Cards below 12 digits would be dropped anyway.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Terms are runs of letters; runs in a script without spaces stand for their pairs of characters.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}&&[\p{L}\p{M}]]"
TERM = rf"{UNSPACED}++|(?:(?!{UNSPACED})[\p{{L}}\p{{M}}])++"
BETWEEN = r"[^\p{L}\p{M}]++"


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """Spans ``(kind, start, stop, value)`` of the leftmost non-overlapping matches, in code points.
    The text between matches and the matches alternate; their lengths add up to the positions."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("out"))

    def add(acc, z):
        at = acc["pos"] + F.length(z["p"])
        stop = at + F.length(F.coalesce(z["m"], F.lit("")))
        span = F.struct(F.lit(kind).alias("kind"), at.alias("start"), stop.alias("stop"), z["m"].alias("value"))
        return F.struct(stop.alias("pos"), F.when(z["m"].isNull(), acc["out"]).otherwise(
            F.concat(acc["out"], F.array(span))).alias("out"))

    return F.aggregate(parts, start, add, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = F.reverse(_digits(value))
    each = F.transform(F.sequence(F.lit(0), F.length(d) - 1), lambda i: F.substring(d, i + 1, F.lit(1)).cast("int") * (1 + i % 2))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _kept(kind: str):
    if kind == "ip":
        return lambda s: F.forall(F.split(s["value"], r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3)
                                  & (F.coalesce(F.substring(F.regexp_replace(p, "^0+(?=.)", ""), 1, 4).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return lambda s: F.length(_digits(s["value"])).between(12, 19) & F.when(
            F.length(_digits(s["value"])).between(12, 19), _luhn(s["value"])).otherwise(False)
    if kind == "phone":
        return lambda s: F.length(_digits(s["value"])).between(9, 15)
    return lambda s: F.lit(True)


def base_spans(text: Column) -> Column:
    """All base spans of a text by start, then kind in the order of ``KINDS``."""
    none = F.array().cast(SPAN)
    may = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(PATTERNS["card"]),
           "phone": text.contains("+")}
    found = [F.when(may[k], F.filter(_matches(text, PATTERNS[k], k), _kept(k))).otherwise(none) for k in KINDS]
    return F.concat(*found)


def _sorted_spans(spans: Column) -> Column:
    order = F.array(*[F.lit(k) for k in (*KINDS, "generalise", "remove")])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(order, s["kind"]).alias("k"), s["stop"], s["kind"], s["value"]))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value")))


def _pairs_of(run: Column) -> Column:
    """The places and values ``(at, value)`` of the terms in a run of letters, lower case."""
    each = F.transform(F.sequence(F.lit(0), F.greatest(F.length(run) - 2, F.lit(0))),
                       lambda i: F.struct(i.alias("at"), F.lower(F.substring(run, i + 1, F.lit(2))).alias("value")))
    return F.when(run.rlike("^" + UNSPACED), each).otherwise(F.array(F.struct(F.lit(0).alias("at"), F.lower(run).alias("value"))))


def _term_values(text: Column) -> Column:
    """All terms of a text, in lower case."""
    runs = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    return F.when(text.rlike(UNSPACED), F.flatten(F.transform(runs, lambda r: _pairs_of(r)["value"]))).otherwise(
        F.transform(runs, lambda r: F.lower(r)))


def _blanked(text: Column, spans: Column) -> Column:
    """The text with blanks of the same length for its spans (sorted by start)."""
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def add(acc, s):
        at, stop = F.greatest(acc["pos"], s["start"]), F.greatest(acc["pos"], s["stop"])
        piece = F.array(F.substring(text, acc["pos"] + 1, at - acc["pos"]), F.repeat(F.lit(" "), stop - at))
        return F.struct(stop.alias("pos"), F.concat(acc["out"], piece).alias("out"))

    return F.aggregate(spans, start, add, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.lit(1 << 30))))


def _term_places(held: DataFrame) -> DataFrame:
    """``(_k1, _k2, _term, _start, _stop)``: every place of every term outside the base spans. Runs of
    letters and of other characters cover a text; their lengths before a run add up to its place."""
    runs = F.regexp_extract_all(_blanked(F.col("_t"), _sorted_spans(F.col("base"))), F.lit(f"{TERM}|{BETWEEN}"), F.lit(0))
    r = held.select("_k1", "_k2", runs.alias("_runs")).dropDuplicates(["_k1", "_k2"])
    r = r.select("_k1", "_k2", F.posexplode("_runs").alias("_i", "_run"))
    before = Window.partitionBy("_k1", "_k2").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("_at", F.coalesce(F.sum(F.length("_run")).over(before), F.lit(0)).cast("int")).filter(F.col("_run").rlike(r"^[\p{L}\p{M}]"))
    r = r.select("_k1", "_k2", "_at", F.length("_run").alias("_n"), F.col("_run").rlike("^" + UNSPACED).alias("_cjk"),
                 F.explode(_pairs_of(F.col("_run"))).alias("_p"))
    first = F.col("_at") + F.col("_p.at")
    stop = F.when(F.col("_cjk"), F.least(first + 2, F.col("_at") + F.col("_n"))).otherwise(first + F.col("_n"))
    return r.select("_k1", "_k2", F.col("_p.value").alias("_term"), first.alias("_start"), stop.alias("_stop"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.withColumn("_k1", F.xxhash64(id_col, text_col)).withColumn("_k2", F.hash(text_col, id_col))


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_k1, _k2, <id_col>, base, spans)`` for every row: the base spans and all spans (base, and
    terms to generalise or remove), each ``(kind, start, stop, value)`` by start.

    Null and empty texts have none. Rows listed twice give equal rows and count as one document in
    the co-occurrences. Other columns are ignored."""
    d = _keyed(docs.select(id_col, text_col), id_col, text_col).withColumn("_t", text_or_empty(text_col))
    d = d.withColumn("base", base_spans(F.col("_t")))
    kept = F.when(F.size("base") > 0, F.col("_t"))  # only texts with entities are read again
    per_doc = write_stage(d.select("_k1", "_k2", id_col, "base", kept.alias("_t")), "pii-base")

    held = per_doc.filter(F.size("base") > 0)
    e = held.select("_k1", "_k2", F.explode("base").alias("_e"))
    entity = F.concat_ws(":", "_e.kind", F.when(F.col("_e.kind").isin("card", "phone"), _digits(F.col("_e.value"))).otherwise(
        F.lower("_e.value")))
    e = write_stage(e.select("_k1", "_k2", entity.alias("_entity")).distinct(), "pii-entities")
    # Entities of the same documents disclose the same terms: they count as one group.
    ofs = e.groupBy("_entity").agg(F.count("*").alias("_ne"), F.bit_xor("_k1").alias("_x1"), F.bit_xor("_k2").alias("_x2"))
    group = e.join(ofs, "_entity").select("_k1", "_k2", F.xxhash64("_x1", "_x2", "_ne").alias("_group"), "_ne").distinct()
    t = write_stage(_term_places(held), "pii-terms")

    in_doc = write_stage(t.select("_k1", "_k2", "_term").distinct(), "pii-in-doc")
    wanted = write_stage(in_doc.select("_term").distinct(), "pii-wanted")
    seen = docs.select(F.explode(F.array_distinct(_term_values(text_or_empty(text_col)))).alias("_term"))
    df = write_stage(seen.join(small_broadcast(wanted, wanted.count(), 64), "_term", "left_semi").groupBy("_term").agg(
        F.count("*").alias("_nt")), "pii-frequencies")
    total = F.lit(float(per_doc.count()))
    group = write_stage(group.withColumn("_ic", F.log2(total / F.col("_ne"))).filter("_ic > 0"), "pii-groups")
    # n(e,t) is at most n(e): a term as frequent as this cannot reach GENERALISE (with room for rounding).
    may = F.log2(total / F.col("_nt")) >= GENERALISE * F.col("_ic") - 1e-9
    pairs = write_stage(in_doc.join(small_broadcast(df, wanted.count(), 64), "_term").join(group, ["_k1", "_k2"]).filter(may)
                        .select("_k1", "_k2", "_group", "_term", "_nt", "_ne", "_ic"), "pii-pairs")
    joint = pairs.groupBy("_group", "_term", "_nt", "_ne", "_ic").agg(F.count("*").alias("_net"))
    bits = joint.withColumn("_pmi", F.log2(F.col("_net") * total / (F.col("_ne") * F.col("_nt"))))
    known = F.col("_pmi") * F.when(F.col("_net") < SURE, (F.col("_net") + 1) / (F.col("_net") + 2)).otherwise(F.lit(1.0))
    flagged = write_stage(bits.filter(known >= GENERALISE * F.col("_ic")).select(
        "_group", "_term", (known >= REMOVE * F.col("_ic")).alias("_remove")), "pii-flagged")
    # Back to every place of the term in each document that holds an entity of the group.
    there = pairs.join(small_broadcast(flagged, flagged.count(), 96), ["_group", "_term"]).groupBy("_k1", "_k2", "_term").agg(
        F.max("_remove").alias("_remove"))
    add = t.join(there, ["_k1", "_k2", "_term"])
    span = F.struct(F.when(F.col("_remove"), "remove").otherwise("generalise").alias("kind"),
                    F.col("_start").alias("start"), F.col("_stop").alias("stop"), F.col("_term").alias("value"))
    add = add.groupBy("_k1", "_k2").agg(F.collect_list(span).alias("_add"))  # terms of one document
    all_spans = F.concat("base", F.coalesce("_add", F.array().cast(SPAN)))
    return per_doc.drop("_t").join(add, ["_k1", "_k2"], "left").select(
        "_k1", "_k2", id_col, _sorted_spans(F.col("base")).alias("base"), _sorted_spans(all_spans).alias("spans"))


def _spliced(text: Column, spans: Column) -> Column:
    """The text with its spans replaced; spans that overlap are replaced as one."""
    label = lambda s: F.when(s["kind"] == "remove", F.lit("")).when(s["kind"] == "generalise", F.lit("[TERM]")).otherwise(
        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def add(acc, s):
        piece = F.array(F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"]), label(s))
        return F.struct(F.greatest(acc["pos"], s["stop"]).alias("pos"),
                        F.when(s["start"] >= acc["pos"], F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, start, add, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.lit(1 << 30))))


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans replaced: kinds by ``[KIND]``, terms by ``[TERM]`` or nothing. No row
    goes; ``n_chars``, if there is one, follows the new text. Other columns stay."""
    names = docs.columns
    docs, restored = shielded(docs, id_col, text_col)
    s = find(docs, id_col=id_col, text_col=text_col).filter(F.size("spans") > 0).select("_k1", "_k2", F.col("spans").alias("_spans")).distinct()
    s = write_stage(s, "pii-spans")
    size = s.agg(F.count("*").alias("n"), F.sum(F.size("_spans")).alias("spans")).first()
    each = 64 + 96 * (size["spans"] or 0) // max(size["n"], 1)   # a span: two numbers and two short texts
    j = _keyed(docs, id_col, text_col).join(small_broadcast(s, size["n"], each), ["_k1", "_k2"], "left")
    has = F.col("_spans").isNotNull()
    new = F.when(has, _spliced(text_or_empty(text_col), F.col("_spans"))).otherwise(F.col(text_col))
    j = j.withColumn("_new", new)
    out = [F.col("_new").alias(c) if c == text_col else
           F.when(has, F.length("_new")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
           for c in docs.columns]
    return restored(j.select(*out)).select(*names)


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _is(kind: str):
    return lambda s: s["kind"] == kind


def q_op7(spark, sf_dir):
    """Personal data in all documents: counts and digest of the base spans, and all spans."""
    f = find(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return f.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
