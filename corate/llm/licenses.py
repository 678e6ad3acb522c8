"""Licence scans (DataFrame operations only): sparse TF-IDF cosine of headers and licence files to
licence templates, and inheritance from the nearest ancestor directory with a licence file.

Every template (a notice, a standard header, a title, a passage of a full licence text, an SPDX tag)
names an anchor word. Each place of that word in a file, anywhere in its whole text, gives a window of
the template's length laid around it: line breaks, comment leaders and running lines do not matter, and
the work grows with the anchor words found. Document frequencies count all files.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import shielded, small_broadcast, table, text_or_empty, write_stage

MIN_COSINE = 0.75
TOKEN = r"[\p{L}\p{N}]+(?:\.[0-9]+)*"
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)([.-].*)?$"
# A file with one of these, but without a template, declares a licence that is not known here.
DECLARES = r"(?i)spdx-license-identifier[ \t]*:|\blicen[cs]ed[ \t]+under\b"
UNKNOWN = "unrecognised"

# Identifiers of licences in SPDX tags.
SPDX = ("0BSD AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GPL-2.0 "
        "GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MIT-0 MPL-2.0 Unlicense Zlib").split()

# Texts by which licences are declared: licence, anchor word, words without which it is another licence, text.
NOTICES = [
    ("0BSD", "fee", "purpose", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("AGPL-3.0", "gnu", "affero 3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "gnu", "affero 3", "GNU Affero General Public License Version 3"),
    ("Apache-2.0", "apache", "2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "apache", "2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", "redistribution", "source binary", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "endorse", "contributors promote",
     "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSL-1.0", "boost", "1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("BSL-1.0", "boost", "1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("CC-BY-4.0", "cc", "by 4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "commons", "attribution 4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "cc", "by nc 4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "commons", "attribution noncommercial 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-SA-4.0", "cc", "by sa 4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "commons", "attribution sharealike 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC0-1.0", "cc0", "1.0", "CC0 1.0 Universal"),
    ("EPL-2.0", "eclipse", "2.0", "Eclipse Public License v 2.0"),
    ("GPL-2.0", "gnu", "2", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License"),
    ("GPL-2.0", "gnu", "2", "licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "gnu", "2 1991", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "gnu", "3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-3.0", "gnu", "3", "licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "gnu", "3 2007", "GNU General Public License Version 3, 29 June 2007"),
    ("ISC", "fee", "purpose provided", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies"),
    ("LGPL-2.1", "gnu", "lesser 2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License"),
    ("LGPL-3.0", "gnu", "lesser 3", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "gnu", "lesser 3", "licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "gnu", "lesser 3 2007", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MIT", "mit", "license", "Released under the MIT License"),
    ("MIT", "mit", "license", "Licensed under the MIT License"),
    ("MIT", "hereby", "charge obtaining deal", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "mozilla", "2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "mozilla", "2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "unencumbered", "free domain", "This is free and unencumbered software released into the public domain"),
    ("Zlib", "misrepresented", "origin", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software"),
]


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:\.[0-9]+)*", text.lower())


def templates() -> list[tuple[int, str, str, list[str], int, list[str]]]:
    """``(number, licence, anchor, required words, words before the anchor, words)`` of every template."""
    rows = [(name, anchor, need.split(), _words(text)) for name, anchor, need, text in NOTICES]
    rows += [(name, "spdx", _words(name), _words(f"SPDX-License-Identifier: {name}")) for name in SPDX]
    return [(i, name, anchor, [anchor, *need], w.index(anchor), w) for i, (name, anchor, need, w) in enumerate(rows)]


def _windows(files: DataFrame, text_col: str) -> DataFrame:
    """``(_k1, _k2, _id, _win)``: the windows of every file that hold the words their template requires."""
    spark = files.sparkSession
    rows = templates()
    anchors = sorted({r[2] for r in rows})
    before, after = max(r[4] for r in rows), max(len(r[5]) - r[4] for r in rows)
    shapes = F.broadcast(spark.createDataFrame(
        [(i, anchor, need, at, len(w)) for i, _, anchor, need, at, w in rows],
        "_id int, _anchor string, _need array<string>, _at int, _len int"))
    # Cheap test first: the text holds an anchor somewhere, whole word or not.
    some = files.filter(F.lower(text_or_empty(text_col)).rlike("|".join(anchors))).select("_k1", "_k2", _tokens(text_or_empty(text_col)).alias("_tok"))
    places = F.filter(F.transform("_tok", lambda t, i: F.when(t.isin(anchors), i)), lambda i: i.isNotNull())
    # Only the words around an anchor go on, not the text.
    around = F.transform("_at", lambda i: F.struct(
        F.get("_tok", i).alias("_anchor"), F.least(i, F.lit(before)).alias("_left"),
        F.slice("_tok", F.greatest(i - before, F.lit(0)) + 1, F.least(i, F.lit(before)) + after).alias("_words")))
    hits = some.select("_k1", "_k2", "_tok", places.alias("_at")).filter("size(_at) > 0").select("_k1", "_k2", F.explode(around).alias("_h"))
    hits = hits.select("_k1", "_k2", "_h.*").dropDuplicates(["_k1", "_k2", "_anchor", "_left", "_words"])
    cut = F.slice("_words", F.greatest(F.col("_left") - F.col("_at"), F.lit(0)) + 1, F.col("_len") + F.least(F.col("_left") - F.col("_at"), F.lit(0)))
    return (hits.join(shapes, "_anchor").withColumn("_win", cut).filter(F.size(F.array_except("_need", "_win")) == 0)
            .select("_k1", "_k2", "_id", "_win").distinct())


def own_licenses(files: DataFrame, text_col: str = "text") -> DataFrame:
    """``(_k1, _k2, _license, _cosine)``: the best window and template of every file that reaches ``MIN_COSINE``
    (``files`` has the row keys ``_k1, _k2``). Ties go to the longer template, then to the first name. A
    file that only says that it declares a licence (``DECLARES``) has ``UNKNOWN`` with a null cosine."""
    spark = files.sparkSession
    n = float(files.count())
    rows = templates()
    windows = write_stage(_windows(files, text_col), "license-windows")
    # Copies of a header are one window to weigh.
    distinct = write_stage(windows.groupBy("_id", "_win").agg(F.count("*").alias("_files")), "license-distinct")
    own = spark.createDataFrame([(i, t) for i, *_, w in rows for t in w], "_id int, _term string").groupBy("_id", "_term").agg(F.count("*").alias("_c"))
    wanted = write_stage(distinct.select(F.explode("_win").alias("_term")).union(own.select("_term")).distinct(), "license-vocabulary")
    # Counted before the join: a common line puts its terms into it once, not once per file.
    # (An inner join with the distinct terms: a semi join would be moved below the counting again.)
    seen = files.select(F.explode(F.array_distinct(_tokens(text_or_empty(text_col)))).alias("_term")).groupBy("_term").agg(F.count("*").alias("_df"))
    idf = write_stage(small_broadcast(wanted, wanted.count(), 64).join(seen, "_term", "left").select(
        "_term", (F.log((1 + n) / (1 + F.coalesce("_df", F.lit(0)))) + 1).alias("_idf")), "license-idf")
    weights = own.join(idf, "_term").select("_id", "_term", (F.col("_c") * F.col("_idf")).alias("_w"))
    weights = weights.withColumn("_tnorm", F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("_id"))))
    names = spark.createDataFrame([(i, name, len(w)) for i, name, *_, w in rows], "_id int, _license string, _len int")
    x = (distinct.select("_id", "_win", F.explode("_win").alias("_term")).groupBy("_id", "_win", "_term").agg(F.count("*").alias("_tf"))
         .join(idf, "_term").withColumn("_x", F.col("_tf") * F.col("_idf")))
    cos = (x.join(F.broadcast(weights), ["_id", "_term"], "left").groupBy("_id", "_win")
           .agg((F.sum(F.col("_x") * F.col("_w") / F.col("_tnorm")) / F.sqrt(F.sum(F.col("_x") * F.col("_x")))).alias("_c")))
    cos = cos.withColumn("_cosine", F.round("_c", 6)).filter(F.col("_cosine") >= MIN_COSINE).join(F.broadcast(names), "_id")
    best = (windows.join(cos, ["_id", "_win"]).groupBy("_k1", "_k2")
            .agg(F.min(F.struct((-F.col("_cosine")).alias("c"), (-F.col("_len")).alias("l"), F.col("_license").alias("n"))).alias("_b"))
            .select("_k1", "_k2", F.col("_b.n").alias("_license"), (-F.col("_b.c")).alias("_cosine")))
    best = write_stage(best, "license-best")
    says = files.filter(text_or_empty(text_col).rlike(DECLARES)).select("_k1", "_k2").distinct()
    unknown = says.join(best, ["_k1", "_k2"], "left_anti").select("_k1", "_k2", F.lit(UNKNOWN).alias("_license"), F.lit(None).cast("double").alias("_cosine"))
    return best.unionByName(unknown)


def scan(files: DataFrame, *, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Every row of ``files`` with ``license``, ``license_cosine``, ``license_origin`` (``own``,
    ``inherited`` or null) and ``license_dir``, the directory it was inherited from.

    A licence file (``LICENSE_FILE``) stands for its directory; with several, the best cosine counts,
    then the first path. A declaration that is not known (``UNKNOWN``) is the file's own and does not
    inherit. Of an SPDX expression the first identifier counts. Null and empty texts declare nothing but
    inherit; a null path inherits nothing; very long texts are read whole; an empty table gives no rows;
    rows listed twice give equal rows; columns with the four names above are replaced."""
    names = [c for c in files.columns if c not in ("license", "license_cosine", "license_origin", "license_dir")]
    files, restored = shielded(files.select(*names), path_col, text_col)
    kept, names = names, files.columns
    f = files.withColumn("_k1", F.xxhash64(path_col, text_col)).withColumn("_k2", F.hash(text_col, path_col))
    parts = F.split(F.col(path_col), "/")
    f = f.withColumn("_dir", F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/"))
    own = write_stage(own_licenses(f, text_col), "license-own")
    n_own = own.count()
    slim = f.select("_k1", "_k2", "_dir", F.col(path_col).alias("_path"))
    holders = (slim.filter(F.element_at(F.split("_path", "/"), -1).rlike(LICENSE_FILE))
               .join(small_broadcast(own, n_own, 96), ["_k1", "_k2"])
               .groupBy("_dir").agg(F.min_by("_license", F.struct(-F.coalesce("_cosine", F.lit(0.0)), F.col("_path"))).alias("_up")))
    dirs = slim.filter("_dir is not null").select("_dir").distinct()
    p = F.split("_dir", "/")
    above = dirs.select("_dir", F.explode(F.sequence(F.lit(0), F.size(p))).alias("_depth")).withColumn(
        "_above", F.array_join(F.slice(F.split("_dir", "/"), 1, F.col("_depth")), "/"))
    nearest = above.join(holders.withColumnRenamed("_dir", "_above"), "_above").groupBy("_dir").agg(
        F.max_by(F.struct("_up", "_above"), "_depth").alias("_near"))
    j = f.join(small_broadcast(own, n_own, 96), ["_k1", "_k2"], "left").join(nearest, "_dir", "left")
    mine = F.col("_license").isNotNull()
    out = j.select(*names, F.coalesce("_license", "_near._up").alias("license"), F.col("_cosine").alias("license_cosine"),
                   F.when(mine, "own").when(F.col("_near").isNotNull(), "inherited").alias("license_origin"),
                   F.when(~mine, F.col("_near._above")).alias("license_dir"))
    return restored(out).select(*kept, "license", "license_cosine", "license_origin", "license_dir")


def document_paths(docs: DataFrame) -> DataFrame:
    """The tables carry no paths: documents get ``source/<id div 1000>/<id div 100>/<id div 10>/doc<id>.txt``,
    and every tenth is the licence file of its directory (every hundredth, of the one above)."""
    i = F.col("doc_id")
    at = lambda k: F.floor(i / k).cast("string")
    depth = F.when(i % 1000 == 0, 1).when(i % 100 == 0, 2).otherwise(3)
    full = F.array(at(1000), at(100), at(10))
    name = F.when(i % 10 == 0, F.lit("LICENSE")).otherwise(F.concat(F.lit("doc"), i.cast("string"), F.lit(".txt")))
    return docs.withColumn("path", F.concat_ws("/", F.coalesce("source", F.lit("none")), F.array_join(F.slice(full, 1, depth), "/"), name))


def q_op10(spark, sf_dir):
    """The licence of every document, declared or inherited."""
    docs = document_paths(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return scan(docs).select("doc_id", "path", "license", "license_cosine", "license_origin", "license_dir")


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_VALUES = ",\n".join(f"({i}, '{name}', '{anchor}', {_sql_list(need)}, {at}, {_sql_list(w)})" for i, name, anchor, need, at, w in templates())
SQL = rf"""
WITH v(id, lic, anchor, need, before, words) AS (VALUES {_VALUES}),
p AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, 'none') || '/' || (doc_id // 1000)
    || CASE WHEN doc_id % 1000 = 0 THEN '' ELSE '/' || (doc_id // 100) END
    || CASE WHEN doc_id % 100 = 0 THEN '' ELSE '/' || (doc_id // 10) END AS dir,
    CASE WHEN doc_id % 10 = 0 THEN 'LICENSE' ELSE 'doc' || doc_id || '.txt' END AS name FROM documents),
n AS (SELECT count(*) AS n FROM p),
a AS (SELECT doc_id, regexp_extract_all(lower(text), '[\pL\pN]+(?:\.[0-9]+)*') AS a FROM p),
tk AS (SELECT doc_id, unnest(a) AS term, generate_subscripts(a, 1) AS i FROM a),
idf AS (SELECT term, ln((1 + any_value(n)) / (1 + count(DISTINCT doc_id))) + 1 AS idf FROM tk, n GROUP BY term),
win AS (SELECT doc_id, id, need, i, list_slice(a, greatest(i - before, 1), i - before + len(words) - 1) AS w
        FROM tk JOIN v ON term = anchor JOIN a USING (doc_id)),
ok AS (SELECT * FROM win WHERE list_has_all(w, need)),
tw AS (SELECT id, term, count(*) * coalesce(any_value(idf), (SELECT ln(1 + n) + 1 FROM n)) AS w
       FROM (SELECT id, unnest(words) AS term FROM v) LEFT JOIN idf USING (term) GROUP BY ALL),
tn AS (SELECT id, sqrt(sum(w * w)) AS tnorm FROM tw GROUP BY id),
x AS (SELECT doc_id, id, i, term, count(*) * any_value(idf) AS x
      FROM (SELECT doc_id, id, i, unnest(w) AS term FROM ok) JOIN idf USING (term) GROUP BY ALL),
c AS (SELECT doc_id, id, i, round(sum(x * w / tnorm) / sqrt(sum(x * x)), 6) AS cos
      FROM x LEFT JOIN tw USING (id, term) LEFT JOIN tn USING (id) GROUP BY ALL),
best AS (SELECT doc_id, lic, cos FROM c JOIN v USING (id) WHERE cos >= {MIN_COSINE}
         QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cos DESC, len(words) DESC, lic) = 1),
own AS (SELECT * FROM best UNION ALL SELECT doc_id, '{UNKNOWN}', NULL FROM p
        WHERE regexp_matches(text, '{DECLARES}') AND doc_id NOT IN (SELECT doc_id FROM best)),
h AS (SELECT dir, lic FROM p JOIN own USING (doc_id) WHERE name = 'LICENSE'
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cos DESC NULLS LAST, name) = 1),
near AS (SELECT p.doc_id, h.lic, h.dir FROM p JOIN h ON p.dir = h.dir OR starts_with(p.dir, h.dir || '/')
         QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY length(h.dir) DESC) = 1)
SELECT p.doc_id, p.dir || '/' || p.name AS path, coalesce(own.lic, near.lic) AS license, own.cos AS license_cosine,
  CASE WHEN own.lic IS NOT NULL THEN 'own' WHEN near.lic IS NOT NULL THEN 'inherited' END AS license_origin,
  CASE WHEN own.lic IS NULL THEN near.dir END AS license_dir
FROM p LEFT JOIN own USING (doc_id) LEFT JOIN near USING (doc_id)"""
