"""License scans by diagonal voting.

Every run of ``GRAM`` words of every text is hashed and joined with the same hashes of the
license templates; a meeting at word ``p`` of the text and ``t`` of the template votes for
the diagonal ``p - t``, on which an uninterrupted copy puts all its votes. Diagonals that
lie close together belong to one copy with words added or left out and are merged. A merged
span is accepted if it covers enough of its template and is not much longer. The templates
are a fixed list of a few hundred runs, so they are broadcast, and only votes are shuffled.
Nothing but DataFrame operations.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import lower_ascii, table
from riskloom.session import durable

# Phrases that stand for a license wherever their words follow each other.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Wordings of the licenses' own texts and notices, found also with changes.
TEMPLATES = {
    "apache-2": [
        "licensed under the apache license version 2 0 the license you may not use this file except in"
        " compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is"
        " distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided"
        " that the following conditions are met",
    ],
    "cc-by-nc": [
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is"
        " hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "lgpl": [
        "this library is free software you can redistribute it and or modify it under the terms of the gnu"
        " lesser general public license as published by the free software foundation",
    ],
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction including"
        " without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
        " copies of the software",
    ],
    "mpl-2": [
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl"
        " was not distributed with this file you can obtain one at",
    ],
    "unlicense": [
        "this is free and unencumbered software released into the public domain",
    ],
}

#: Words of a run; no base phrase is shorter.
GRAM = 3
#: Diagonals that are this close belong to one copy.
SLACK = 4
#: Share of a template's runs that a copy must have, and its length as a multiple of the template's.
COVERAGE, STRETCH = 0.8, 1.5
_SCALE = 1_000_000
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _templates() -> list[tuple[int, str, bool, int, list[str]]]:
    """(number, label, whether it is a base phrase, runs, words)."""
    known = [(label, True, phrase) for phrase, label in BASE_PHRASES.items()]
    known += [(label, False, text) for label, texts in TEMPLATES.items() for text in texts]
    return [(i, label, base, len(text.split()) - GRAM + 1, text.split()) for i, (label, base, text) in enumerate(known)]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BREAK), "")


def _template_runs(spark: SparkSession) -> DataFrame:
    rows = [(i, label, base, runs, at, *words[at:at + GRAM])
            for i, label, base, runs, words in _templates() for at in range(runs)]
    names = [f"w{i}" for i in range(GRAM)]
    schema = "template int, label string, base boolean, runs int, at int, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(rows, schema).withColumn("gram", F.xxhash64(*names)).drop(*names)


def votes(docs: DataFrame) -> DataFrame:
    """Meetings of texts and templates, once each: ``doc_id, text_hash, template, label, base,
    runs, at, place, diagonal``."""
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    words = words.where(F.size("words") >= GRAM)
    at = lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(GRAM)])
    grams = words.select(
        "doc_id", "text_hash",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.size("words") - GRAM), at)).alias("place", "gram"))
    met = grams.join(F.broadcast(_template_runs(docs.sparkSession)), "gram")
    return met.drop("gram").distinct().withColumn("diagonal", F.col("place") - F.col("at"))


def spans(found: DataFrame) -> DataFrame:
    """Accepted copies: ``doc_id, text_hash, template, label, base, first, last, coverage``, where
    ``first`` and ``last`` number the words of the text from 0. A base phrase must be there
    word for word on one diagonal; other templates may be changed. Of copies that overlap or lie
    close to each other, one is returned."""
    base = found.where("base").groupBy("doc_id", "text_hash", "template", "label", "base", "runs", "diagonal").agg(
        F.count("*").alias("n")).where("n = runs").select(
        "doc_id", "text_hash", "template", "label", "base", F.col("diagonal").alias("first"),
        (F.col("diagonal") + F.col("runs") + GRAM - 2).alias("last"), F.lit(1.0).alias("coverage"))
    along = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    merged = found.where("not base").withColumn("_new", F.when(gap > SLACK, 1).otherwise(0)).withColumn(
        "copy", F.sum("_new").over(along))
    group = ["doc_id", "text_hash", "template", "label", "base", "runs", "copy"]
    # Runs of a copy may start so many places after its first one.
    reach = F.floor((F.col("runs") + GRAM - 1) * F.lit(STRETCH)) - GRAM
    whole = merged.groupBy(*group).agg(
        F.count_distinct("at").alias("n"), F.min("place").alias("first"), F.max("place").alias("final"))
    whole = whole.where(F.col("n") >= COVERAGE * F.col("runs"))
    short = F.col("final") - F.col("first") <= reach
    # Stray runs, say of a phrase that goes on and on, can chain many diagonals to one long group.
    # The copy in it is verified by itself: the stretch of text with the most runs.
    long = merged.join(whole.where(~short).select(*group), group, "left_semi").withColumn(
        "_scaled", F.floor(F.col("place").cast("bigint") * _SCALE / reach))
    ahead = Window.partitionBy("doc_id", "text_hash", "template", "copy").orderBy("_scaled").rangeBetween(0, _SCALE)
    best = long.withColumn("n", F.size(F.collect_set("at").over(ahead))).groupBy(*group).agg(
        F.max("n").alias("n"), F.max_by("place", F.struct("n", -F.col("place"))).alias("first"))
    best = best.where(F.col("n") >= COVERAGE * F.col("runs")).withColumn("final", F.col("first") + reach)
    other = whole.where(short).unionByName(best).withColumn("last", F.col("final") + GRAM - 1).withColumn(
        "coverage", F.col("n") / F.col("runs"))
    return base.unionByName(other.select(*base.columns))


def scan(docs: DataFrame) -> DataFrame:
    """License findings of each row of ``docs(doc_id, text)``.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``:
    all places of base phrases, the first words of the first and last of them (null without
    any), their labels, those of all accepted copies too, and the best coverage, 0 without
    a finding and 1 with a base phrase. Null and empty texts have no words; a text of any
    length is read whole. Labels tie with nothing: all are named, in alphabetical order. Rows that repeat
    both identifier and text have the same finding each. An empty table gives an empty
    result; other columns are ignored.
    """
    found = spans(durable(votes(docs)))
    joined = lambda c: F.concat_ws(",", F.array_sort(c))
    per_text = found.groupBy("doc_id", "text_hash").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
        joined(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"), F.max("coverage").alias("score"),
    ).withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    return rows.join(
        per_text, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left"
    ).select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def op3_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _oracle() -> str:
    runs = ", ".join(
        f"({i}, '{label}', {str(base).lower()}, {n}, {at}, '{' '.join(words[at:at + GRAM])}')"
        for i, label, base, n, words in _templates() for at in range(n))
    gram = " || ' ' || ".join(f"words[place + {k + 1}]" for k in range(GRAM))
    return f"""
WITH runs(template, label, base, runs, spot, gram) AS (VALUES {runs}),
texts AS (
  SELECT doc_id, row_number() OVER () AS line,
         regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
places AS (SELECT line, words, unnest(range(0, len(words) - {GRAM - 1})) AS place FROM texts WHERE len(words) >= {GRAM}),
grams AS (SELECT line, place, {gram} AS gram FROM places),
votes AS (SELECT line, place, template, label, base, runs, spot, place - spot AS diagonal FROM grams JOIN runs USING (gram)),
base_spans AS (
  SELECT line, label, true AS base, diagonal AS first, 1.0::double AS coverage FROM votes WHERE base
  GROUP BY line, template, label, runs, diagonal HAVING count(*) = runs),
gaps AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY line, template ORDER BY diagonal) AS gap FROM votes WHERE NOT base),
copies AS (SELECT *, sum(CASE WHEN gap > {SLACK} THEN 1 ELSE 0 END) OVER (
             PARTITION BY line, template ORDER BY diagonal) AS piece,
             floor((runs + {GRAM - 1}) * {STRETCH})::bigint - {GRAM} AS reach FROM gaps),
whole AS (
  SELECT line, template, label, runs, piece, min(place) AS first, max(place) - min(place) <= any_value(reach) AS short,
         count(DISTINCT spot) AS n FROM copies
  GROUP BY line, template, label, runs, piece HAVING count(DISTINCT spot) >= {COVERAGE} * runs),
ahead AS (
  SELECT c.*, count(DISTINCT spot) OVER (PARTITION BY c.line, c.template, c.piece ORDER BY c.place * {_SCALE} // reach
             RANGE BETWEEN CURRENT ROW AND {_SCALE} FOLLOWING) AS n
  FROM copies c SEMI JOIN (SELECT * FROM whole WHERE NOT short) w USING (line, template, piece)),
other_spans AS (
  SELECT line, label, false AS base, first, n / runs::double AS coverage FROM whole WHERE short
  UNION ALL
  SELECT line, label, false, min(place), max(n) / runs::double FROM ahead
  GROUP BY line, template, label, runs, piece HAVING max(n) >= {COVERAGE} * runs),
spans AS (SELECT * FROM base_spans UNION ALL SELECT * FROM other_spans),
found AS (
  SELECT line, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
  FROM spans GROUP BY line)
SELECT doc_id, len(words)::bigint AS n_words, coalesce(n_base, 0)::bigint AS n_base, first_word::bigint AS first_word,
       last_word::bigint AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::double AS score
FROM texts LEFT JOIN found USING (line)
"""


OP3_SQL = _oracle()
