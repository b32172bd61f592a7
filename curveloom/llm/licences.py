"""Licences of files: TF-IDF cosine of their passages to templates, then inheritance from the nearest directory above.

DataFrame functions only. A passage is one to ``PASSAGE`` consecutive lines, so a header counts however it is wrapped. It can
only be as similar as asked if it holds one of a template's cue terms: those without which the rest of the template weighs too
little (Cauchy and Schwarz). Passages without any cue are never laid out, and none that would match is lost. All terms are weighed
by the lines of the whole table that have them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import fresh, prepare, whole_text, written

# Licences and the statements by which files and licence texts name them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
)
LEAST = 0.6
DIGITS = 6
PASSAGE = 4
TERM = "[a-z0-9]+"


def terms(line: str) -> str:
    """SQL for the terms of a line."""
    return f"regexp_extract_all(lower({line}), '{TERM}', 0)"


def page_path(url: Column) -> Column:
    """Host and path of an address, without its query and anchor."""
    plain = F.regexp_replace(F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "(?s)[?#].*$", "")
    return F.regexp_replace(plain, "^([^/]+)$", "$1/")  # a host alone is its own directory


def page_lines(html: Column) -> Column:
    """Each element's text on lines of its own."""
    return F.regexp_replace(html, "<[^<>]*>", "\n")


def _templates(spark) -> DataFrame:
    """``(template, licence, term, tf)``."""
    rows = spark.createDataFrame([(n, licence, text) for n, (licence, text) in enumerate(TEMPLATES)], "template int, licence string, text string")
    each = rows.select("template", "licence", F.explode(F.expr(terms("text"))).alias("term"))
    return each.groupBy("template", "licence", "term").agg(F.count("*").alias("tf"))


def _nearest(own: DataFrame, notices: DataFrame) -> DataFrame:
    """For each directory of files the licence of the deepest directory at or above it that has one."""
    wanted = own.select("folder").distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))
    chains = wanted.select("folder", F.explode(above).alias("a")).select("folder", "a.depth", "a.above")
    given = notices.groupBy(F.col("folder").alias("above")).agg(
        F.min(F.struct((-F.col("similarity")).alias("far"), "path", "licence")).alias("best"))
    found = chains.join(given, "above")
    return found.groupBy("folder").agg(F.max(F.struct("depth", "best.path", "best.licence")).alias("near")).select(
        "folder", F.col("near.licence").alias("given"), F.col("near.path").alias("given_by"))


def _computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with a column that is computed once a row. Of a plain column an optimiser may repeat the expression
    wherever it is used, which inside of lambdas is once for each element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def licences(files: DataFrame, path: Column, text: Column, is_notice: Column | None = None, least: float = LEAST) -> DataFrame:
    """Every row of ``files`` with ``licence``, ``similarity`` (rounded) and ``licence_from``.

    ``path`` has ``/`` between its parts. A file's own licence is the template most similar to any of its passages of up to
    ``PASSAGE`` lines with terms, if the cosine is ``least`` or more; of equals the first licence by name. ``is_notice`` tells which files with a licence
    speak for their directory and those below it (default: names like LICENSE, COPYING or NOTICE); the most similar one
    does, then the first by path. Files without a licence of their own take that of the nearest directory above;
    ``licence_from`` is then the notice's path and ``similarity`` is null, and for files without any all three are.
    Missing paths are files at the top and missing texts are empty. Rows that repeat get equal results; added columns get
    underscores in front if the input has columns of their names.
    """
    spark = files.sparkSession
    prepare(spark)
    licence, similarity, licence_from = fresh(files, "licence", "similarity", "licence_from")
    speaks = F.lower(F.element_at(F.split("path", "/"), -1)).rlike("^(licen[cs]e|copying|notice|unlicense)") if is_notice is None else F.col("notice")
    keyed = files.select(F.xxhash64(whole_text(path), whole_text(text)).alias("key"), whole_text(path).alias("path"),
                         F.coalesce(F.lit(None).cast("boolean") if is_notice is None else is_notice, F.lit(False)).alias("notice"),
                         whole_text(text).alias("text"))
    wanted = F.filter(F.transform(F.split("text", "\n+"), lambda line: F.regexp_extract_all(F.lower(line), F.lit(TERM), 0)), lambda t: F.size(t) > 0)
    kept_lines = _computed(keyed, "lines", wanted).select("key", "path", "notice", "lines").where("size(lines) > 0")
    # In how many lines a term is, and, for the empty term, how many lines there are.
    each_line = kept_lines.select(F.explode("lines").alias("terms"))
    frequencies = written(each_line.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct("terms"))).alias("term")).groupBy("term").agg(
        F.count("*").alias("n")), "line-frequencies")
    total = F.col("total").cast("double")
    counts = frequencies.where("term <> ''").withColumn("total", frequencies.where("term = ''").agg(F.coalesce(F.max("n"), F.lit(0))).scalar())
    weights = counts.select("term", (F.log((1 + total) / (1 + F.col("n"))) + 1).alias("idf"))
    base = _templates(spark)
    # A template's terms that no line has get the weight of what is not there; their number is that of the templates' words.
    lines_in_all = frequencies.where("term = ''").agg(F.coalesce(F.max("n"), F.lit(0))).scalar()
    vectors = base.join(weights, "term", "left").select(
        "template", "licence", "term", (F.col("tf") * F.coalesce("idf", F.log(1 + lines_in_all.cast("double")) + 1)).alias("weight"))
    vectors = written(vectors, "templates")
    listed = F.array(*map(F.lit, _cues(vectors.collect(), least)))
    # The lines that have a cue, and from there the passages that hold one of them.
    cued = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda i: F.arrays_overlap(F.element_at("lines", i), listed))
    found = _computed(kept_lines, "cued", cued).where("size(cued) > 0")
    begins = F.array_distinct(F.flatten(F.transform("cued", lambda i: F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(PASSAGE - 1)), lambda back: i - back), lambda start: start >= 1))))
    starts = found.select("key", "path", "notice", "cued", "lines", F.explode(begins).alias("start"))
    own_lines = F.slice("lines", F.col("start"), PASSAGE)
    lengths = F.filter(F.sequence(F.lit(1), F.size(own_lines)), lambda n: F.exists("cued", lambda i: i.between(F.col("start"), F.col("start") + n - 1)))
    passages = starts.select("key", "path", "notice", F.explode(F.transform(lengths, lambda n: F.flatten(F.slice(own_lines, 1, n)))).alias("terms"))
    some = written(passages.distinct().withColumn("line", F.monotonically_increasing_id()), "licence-passages")
    each = some.select("line", F.explode("terms").alias("term")).groupBy("line", "term").agg(F.count("*").alias("tf"))
    each = each.join(weights, "term").select("line", "term", (F.col("tf") * F.col("idf")).alias("held"))
    sizes = each.groupBy("line").agg(F.sqrt(F.sum(F.col("held") * F.col("held"))).alias("size"))
    norms = vectors.groupBy("template", "licence").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    products = each.join(vectors, "term").groupBy("line", "template").agg(F.sum(F.col("held") * F.col("weight")).alias("product"))
    cosines = products.join(norms, "template").join(sizes, "line").select(
        "line", "licence", F.round(F.col("product") / (F.col("length") * F.col("size")), DIGITS).alias("similarity"))
    folder = F.regexp_replace("path", "/?[^/]*$", "").alias("folder")
    own = cosines.where(F.col("similarity") >= least).join(some.select("line", "key", "path", "notice"), "line").groupBy("key", "path", "notice").agg(
        F.min(F.struct((-F.col("similarity")).alias("far"), "licence")).alias("best"))
    own = written(own.select("key", "path", "notice", folder, "best.licence", (-F.col("best.far")).alias("similarity")), "own-licences")
    # One row a directory, written so that a directory of many files is one that Spark can split in the join.
    given = written(_nearest(keyed.select(folder), own.where(speaks)), "inherited-licences")
    mine = own.groupBy("key", "path").agg(F.min("licence").alias("_own"), F.max("similarity").alias("_similarity"))
    names = fresh(files, "_key", "_path", "_folder", "_own", "_own_similarity", "_given", "_given_by")
    at, there, above, own_licence, own_similarity, given_licence, given_by = names
    marked = files.withColumns({at: F.xxhash64(whole_text(path), whole_text(text)), there: whole_text(path)}).withColumn(
        above, F.regexp_replace(there, "/?[^/]*$", ""))
    joined = marked.join(mine.toDF(at, there, own_licence, own_similarity), [at, there], "left").join(
        given.toDF(above, given_licence, given_by), above, "left")
    return joined.select(
        *files.columns, F.coalesce(own_licence, given_licence).alias(licence), F.col(own_similarity).alias(similarity),
        F.when(F.col(own_licence).isNotNull(), F.col(there)).otherwise(F.col(given_by)).alias(licence_from))


def _cues(rows, least: float) -> list[str]:
    """Terms of each template, the heaviest first, until the rest has less than ``least`` of its length."""
    out: set[str] = set()
    for template in {r["template"] for r in rows}:
        own = sorted(((r["weight"], r["term"]) for r in rows if r["template"] == template), reverse=True)
        left = whole = sum(w * w for w, _ in own)
        for weight, term in own:
            if left < (least - 1e-6) ** 2 * whole:
                break
            out.add(term)
            left -= weight * weight
    return sorted(out)
