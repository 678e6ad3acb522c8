"""Benchmark decontamination by template canonicalisation (DataFrame operations only).

Numbers, names and units are replaced by typed placeholders, so a question whose values were
changed keeps its template. Windows of ``WINDOW`` template tokens are hashed and joined with those
of the benchmark; hits on neighbouring diagonals (position in the document minus position in the item, up to
``DRIFT`` apart) are counted together, so that words inserted into an item or left out of it cost only the windows
that hold them. The values behind the placeholders must map consistently, each segment of an item by its own
diagonal: one benchmark value always to the same value of the document, and different names to different names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import free_name, small_broadcast, table, text_or_empty, write_stage

WINDOW = 8           # template tokens per window
MIN_LITERALS = 4     # of them not placeholders
COVERAGE = 0.5       # share of an item's windows that a document must hold on neighbouring diagonals
COVERED = 0.75       # or share of the tokens of its windows: a word inserted into a short item spoils most windows, few tokens
DRIFT = 3            # words that may be inserted or left out between the first and the last of them

# Words that count as units.
UNITS = ("km", "m", "cm", "mm", "kg", "g", "mg", "lb", "lbs", "oz", "l", "ml", "mph", "kmh", "miles", "mile", "meters",
         "metres", "feet", "inches", "yards", "hours", "hour", "minutes", "minute", "seconds", "second", "days", "day",
         "weeks", "week", "months", "month", "years", "year", "dollars", "dollar", "cents", "euros", "euro", "pounds",
         "percent", "degrees", "liters", "litres", "grams", "tons")
MARK = "\u0002"  # put before a word that starts a sentence: its capital does not make it a name
SENTENCE = r"([.!?:|][^\p{L}\p{N}]*[\x20\x09-\x0D][^\p{L}\p{N}]*)"
BETWEEN = r"[^\p{L}\p{N}\x02]*[\x20\x09-\x0D][^\p{L}\p{N}\x02]*"
MARKS = ("<num>", "<name>", "<unit>")


def tokens(text_col: str) -> Column:
    """Words without punctuation at their ends, sentence starts marked."""
    padded = F.concat(F.lit(". "), text_or_empty(text_col), F.lit(" ."))
    return F.array_remove(F.split(F.regexp_replace(padded, SENTENCE, "$1" + MARK), BETWEEN), "")


def _value(token: Column) -> Column:
    return F.when(F.substring(token, 1, 1) == MARK, F.substring(token, 2, 1 << 30)).otherwise(token)


def _typed(token: Column) -> Column:
    """Template token: a placeholder, or the word in lower case."""
    first = F.substring(token, 1, 1)
    low = F.lower(token)
    return (F.when(first == MARK, _plain(_value(token))).when(F.lower(first) != first, F.lit("<name>"))
            .otherwise(_plain(low)))


def _plain(word: Column) -> Column:
    first, low = F.substring(word, 1, 1), F.lower(word)
    return (F.when((first >= "0") & (first <= "9"), F.lit("<num>")).when(low.isin(*UNITS), F.lit("<unit>"))
            .otherwise(low))


def _with_windows(df: DataFrame, typed: str, out: str) -> DataFrame:
    """Adds the hashes of all windows of ``WINDOW`` template tokens by doubling: hashes of 1, 2, 4,
    8 tokens, each from two of the size before."""
    df = df.withColumn("_w1", F.transform(typed, lambda t: F.xxhash64(t))).withColumn("_n", F.size(typed))
    width = 1
    while width < WINDOW:
        col = F.col(f"_w{width}")
        df = df.withColumn(f"_w{2 * width}", F.zip_with(col, F.slice(col, width + 1, 1 << 30),
                                                        lambda x, y: F.xxhash64(x, y)))
        width *= 2
    df = df.withColumn(out, F.slice(f"_w{WINDOW}", 1, F.greatest(F.col("_n") - WINDOW + 1, F.lit(0))))
    return df.select(*[c for c in df.columns if c != "_n" and not (c.startswith("_w") and c[2:].isdigit())])


def _covered(qs: Column) -> Column:
    """Tokens that the windows at places ``qs`` cover."""
    return F.size(F.array_distinct(F.flatten(F.transform(qs, lambda q: F.sequence(q, q + (WINDOW - 1))))))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(_w, _item, _q)`` windows and ``(_item, _windows, _slots)`` items; ``_slots`` lists
    ``(pos, kind, value)`` of every placeholder. Windows with fewer than ``MIN_LITERALS`` literal
    tokens are left out: mere placeholders match anything."""
    b = benchmark.select(F.col(id_col).alias("_item"), tokens(text_col).alias("_tok")).dropDuplicates()
    b = write_stage(b.withColumn("_typed", F.transform("_tok", _typed)), "bench-typed")
    slots = F.filter(F.transform(F.arrays_zip("_tok", "_typed"), lambda x, i: F.struct(
        i.alias("pos"), x["_typed"].alias("kind"), _value(x["_tok"]).alias("value"))),
        lambda s: s["kind"].isin(*MARKS))
    literal = F.transform("_typed", lambda t, i: F.size(F.filter(
        F.slice(F.col("_typed"), i + 1, WINDOW), lambda u: ~u.isin(*MARKS))) >= MIN_LITERALS)
    b = _with_windows(b.withColumn("_slots", slots).withColumn("_ok", literal), "_typed", "_ws")
    w = (b.select("_item", F.posexplode(F.arrays_zip("_ws", F.slice("_ok", 1, F.size("_ws")).alias("_ok"))).alias("_q", "_z"))
         .filter(F.col("_z._ok")).select(F.col("_z._ws").alias("_w"), "_item", "_q"))
    items_of = b.select("_item", "_slots")
    counts = w.groupBy("_item").agg(F.countDistinct("_q").alias("_windows"), _covered(F.collect_set("_q")).alias("_tokens"))
    items = items_of.join(counts, "_item")
    return w, items


def _keyed(docs: DataFrame, id_col: str, text_col: str, one: str = "_k1", two: str = "_k2") -> DataFrame:
    """Two hashes of id and text stand for a row: equal rows give equal results."""
    return docs.withColumn(one, F.xxhash64(id_col, text_col)).withColumn(two, F.hash(text_col, id_col))


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 coverage: float = COVERAGE) -> DataFrame:
    """``(<id_col>, item_id, matched, coverage, kind, _k1, _k2)``: documents that hold an item, and
    whether ``verbatim`` or ``reparameterised``.

    Null and empty texts hold nothing; items with fewer than ``WINDOW`` tokens (or none with
    ``MIN_LITERALS`` literals) are too short to be recognised; items listed twice count once; equal
    documents give equal rows, once per distinct (id, text). Other columns are ignored."""
    d = _keyed(docs.select(id_col, text_col), id_col, text_col)
    win, items = benchmark_windows(benchmark)
    win, items = write_stage(win, "bench-windows"), write_stage(items, "bench-items")
    t = d.select("_k1", "_k2", F.transform(tokens(text_col), _typed).alias("_typed"))
    # "outer": else the optimizer infers a filter on the array's size and computes the array twice.
    ws = _with_windows(t, "_typed", "_ws").select("_k1", "_k2", F.posexplode_outer("_ws").alias("_p", "_w"))
    hits = ws.join(small_broadcast(win, win.count(), 48), "_w")
    # A segment: the windows of an item on one diagonal; at most as many as the item has.
    seg = hits.groupBy("_k1", "_k2", "_item", (F.col("_p") - F.col("_q")).alias("_diag")).agg(
        F.collect_set("_q").alias("_qs"), F.min("_q").alias("_from"), F.max("_q").alias("_to"))
    near = Window.partitionBy("_k1", "_k2", "_item").orderBy("_diag").rangeBetween(0, DRIFT)
    found = seg.withColumn("_segments", F.collect_list(F.struct("_diag", "_from", "_to")).over(near)).withColumn(
        "_all", F.array_distinct(F.flatten(F.collect_list("_qs").over(near)))).drop("_qs", "_from", "_to")
    found = found.withColumn("_matched", F.size("_all")).join(items, "_item")
    found = found.filter((F.col("_matched") >= F.lit(coverage) * F.col("_windows")) | (_covered(F.col("_all")) >= F.lit(COVERED) * F.col("_tokens"))).drop("_all", "_tokens")
    found = write_stage(found, "bench-hits")
    figures = found.agg(F.count("*").alias("n"), F.sum(F.size("_slots") * 64 + F.size("_segments") * 48 + 128).alias("bytes")).first()
    tok = d.withColumn("_tok", tokens(text_col)).drop(text_col)
    j = tok.join(small_broadcast(found, figures["n"], -(-(figures["bytes"] or 0) // max(figures["n"], 1)), 64 << 20), ["_k1", "_k2"])
    pair = F.flatten(F.transform("_segments", lambda g: F.transform(
        F.filter("_slots", lambda s: (s["pos"] >= g["_from"]) & (s["pos"] < g["_to"] + WINDOW)),
        lambda s: F.struct(s["kind"].alias("kind"), s["value"].alias("a"), _value(F.get(F.col("_tok"), s["pos"] + g["_diag"])).alias("b")))))
    j = j.withColumn("_pairs", F.array_distinct(pair)).drop("_tok", "_slots", "_segments")
    keys = F.array_distinct(F.transform("_pairs", lambda p: F.struct(p["kind"], p["a"])))
    names = F.filter("_pairs", lambda p: p["kind"] == "<name>")
    targets = F.array_distinct(F.transform(names, lambda p: p["b"]))
    ok = (F.size(keys) == F.size("_pairs")) & (F.size(targets) == F.size(names))
    same = F.forall("_pairs", lambda p: p["a"].eqNullSafe(p["b"]))
    j = j.filter(ok).select(id_col, F.col("_item").alias("item_id"), "_k1", "_k2",
                            F.col("_matched").alias("matched"), (F.col("_matched") / F.col("_windows")).alias("coverage"),
                            F.when(same, F.lit("verbatim")).otherwise(F.lit("reparameterised")).alias("kind"))
    best = Window.partitionBy("_k1", "_k2", "item_id").orderBy(F.col("matched").desc(), F.col("kind").desc())
    return j.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones; all columns stay."""
    bad = contaminated(docs, benchmark, id_col=id_col, text_col=text_col).select("_k1", "_k2").distinct()
    one, two = free_name(docs, "_k1"), free_name(docs, "_k2")
    bad = write_stage(bad.select(F.col("_k1").alias(one), F.col("_k2").alias(two)), "bench-bad")
    keyed = _keyed(docs, id_col, text_col, one, two)
    return keyed.join(small_broadcast(bad, bad.count(), 48), [one, two], "left_anti").select(*docs.columns)


def q_op4(spark, sf_dir):
    """Documents that hold a benchmark item, verbatim or with other values."""
    c = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return c.select("doc_id", "item_id", F.col("matched").cast("long").alias("matched"), "coverage", "kind")


def _sql_tokens(name: str, key: str, source: str) -> str:
    units = ", ".join(f"'{u}'" for u in UNITS)
    sentence, between = SENTENCE.replace(r"\p{L}", r"\pL").replace(r"\p{N}", r"\pN"), BETWEEN.replace(
        r"\p{L}", r"\pL").replace(r"\p{N}", r"\pN")
    return f"""
{name}_w AS (SELECT {key} AS id, list_filter(string_split_regex(regexp_replace('. ' || coalesce(text, '') || ' .',
    '{sentence}', '\\1' || chr(2), 'g'), '{between}'), lambda x: x <> '') AS tok FROM {source}),
{name}_u AS (SELECT id, generate_subscripts(tok, 1) - 1 AS pos, unnest(tok) AS raw FROM {name}_w),
{name}_t AS (SELECT id, pos, ltrim(raw, chr(2)) AS v, raw[1] = chr(2) AS starts FROM {name}_u),
{name}_c AS (SELECT id, pos, v, CASE WHEN NOT starts AND lower(v[1]) <> v[1] THEN '<name>'
    WHEN v[1] >= '0' AND v[1] <= '9' THEN '<num>' WHEN lower(v) IN ({units}) THEN '<unit>' ELSE lower(v) END AS t
    FROM {name}_t),
{name}_x AS (SELECT id, pos, list(t) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS w
    FROM {name}_c)"""


SQL = "WITH " + _sql_tokens("d", "doc_id", "documents") + "," + _sql_tokens("b", "item_id", "benchmark") + f""",
bw AS (SELECT id, pos, w FROM b_x WHERE len(w) = {WINDOW}
       AND len(list_filter(w, lambda t: t NOT IN ('<num>', '<name>', '<unit>'))) >= {MIN_LITERALS}),
bn AS (SELECT id, count(DISTINCT pos) AS n, count(DISTINCT pos + i) AS tokens FROM bw, (SELECT unnest(range({WINDOW})) AS i) GROUP BY id),
h AS (SELECT DISTINCT d_x.id AS doc, bw.id AS item, d_x.pos - bw.pos AS diag, bw.pos AS q FROM d_x JOIN bw USING (w)),
e AS (SELECT doc, item, diag, min(q) AS lo, max(q) AS hi FROM h GROUP BY ALL),
m AS (SELECT e.doc, e.item, e.diag AS base, count(DISTINCT h.q) AS m, count(DISTINCT h.q + i) AS covered FROM e JOIN h ON h.doc = e.doc AND h.item = e.item
      AND h.diag BETWEEN e.diag AND e.diag + {DRIFT}, (SELECT unnest(range({WINDOW})) AS i) GROUP BY ALL),
f AS (SELECT m.*, bn.n FROM m JOIN bn ON m.item = bn.id WHERE m >= {COVERAGE} * n OR covered >= {COVERED} * tokens),
p AS (SELECT DISTINCT f.doc, f.item, f.base, b_c.t AS kind, b_c.v AS a, d_c.v AS b
      FROM f JOIN e ON e.doc = f.doc AND e.item = f.item AND e.diag BETWEEN f.base AND f.base + {DRIFT}
      JOIN b_c ON b_c.id = f.item AND b_c.pos >= e.lo AND b_c.pos < e.hi + {WINDOW} AND b_c.t IN ('<num>', '<name>', '<unit>')
      LEFT JOIN d_c ON d_c.id = f.doc AND d_c.pos = b_c.pos + e.diag),
g AS (SELECT doc, item, base, count(*) AS pairs, count(DISTINCT (kind, a)) AS keys,
        count(*) FILTER (kind = '<name>') AS names, count(DISTINCT b) FILTER (kind = '<name>') AS targets,
        bool_and(a IS NOT DISTINCT FROM b) AS same FROM p GROUP BY ALL),
z AS (SELECT f.doc, f.item, f.m, f.m / f.n AS cov,
        CASE WHEN coalesce(g.same, true) THEN 'verbatim' ELSE 'reparameterised' END AS kind
      FROM f LEFT JOIN g USING (doc, item, base) WHERE g.doc IS NULL OR (pairs = keys AND names = targets))
SELECT doc AS doc_id, item AS item_id, CAST(m AS BIGINT) AS matched, CAST(cov AS DOUBLE) AS coverage, kind FROM z
QUALIFY row_number() OVER (PARTITION BY doc, item ORDER BY m DESC, kind DESC) = 1"""
