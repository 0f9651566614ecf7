"""License texts in documents by diagonal voting over word k-grams.

Method: templates (short notices and openings of license texts) are cut into word k-grams with their positions. Every
rolling word k-gram of every document is looked up; hits are joined with the template positions and add up by diagonal
(document position less template position). Neighbouring diagonals of one template merge, so that left out or added
words do not break a match. A merged run is verified: the words it covers must be ``MIN_COVER`` of the template, in a
span not much longer than it, and it must hold what tells the template from each sibling. A sibling is a notice of another
label whose own text would cover as much; telling k-grams are those that the sibling lacks ("version 3 of"), and one of
them must be in the run. A phrase stands at a place if one diagonal has all its k-grams.

k is 3, or the words of a shorter template. Documents drop k-grams that no template has before the join (a lookup in the
templates' own hashes; templates are a parameter of at most ``MOST_GRAMS`` k-grams), so the shuffle holds hits only.

Defined cases: a null or empty text has no words, no labels and score 0. Every row gets its row, rows that repeat an id
or text too; null ids stay null. Other columns are not read. No documents give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmart.llm.text import grams, raw, slices, word_codes, words
from loanmart.session import settled

K, MIN_COVER, NEIGHBOURS, MOST_GRAMS = 3, 0.8, 3, 100_000

# The phrases whose places count, and public license notices.
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2.0", "gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

_SCANNED = "doc_id long, n_words long, at array<int>, gram array<long>"


def _parsed(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def template_grams(templates: Sequence[tuple[str, str, bool]]) -> list[tuple[int, str, bool, int, int, int, int]]:
    """(template, label, counts places, words, k, position, hash) for every k-gram of the templates with words."""
    out = []
    for t, (label, text, phrase) in enumerate(templates):
        w = words(*raw(pa.array([text])), word_codes())
        k = min(K, len(w.hash))
        if k:
            first, h = grams(w, k)
            out += [(t, label, phrase, len(w.hash), k, int(p), int(g)) for p, g in zip(first, h.view(np.int64))]
    if len(out) > MOST_GRAMS:
        raise ValueError(f"{len(out)} template k-grams; at most {MOST_GRAMS}")
    return out


def telling(listed: Sequence[tuple], min_cover: float = MIN_COVER) -> dict[int, list[list[int]]]:
    """For each notice and each of its siblings the positions of the k-grams that the sibling lacks."""
    notices: dict[int, list[tuple]] = {}
    for row in listed:
        if not row[2]:
            notices.setdefault(row[0], []).append(row)
    held = {u: {r[6] for r in rows} for u, rows in notices.items()}
    out: dict[int, list[list[int]]] = {}
    for t, rows in notices.items():
        (_, label, _, n, k, _, _), sets = rows[0], []
        for u, others in notices.items():
            lacks = [r[5] for r in rows if r[6] not in held[u]]
            covered = {r[5] + j for r in rows if r[6] in held[u] for j in range(k)}
            if others[0][1] != label and lacks and len(covered) >= min_cover * n:
                sets.append(lacks)
        out[t] = sets
    return out


def _scan(known: np.ndarray, sizes: list[int]):
    def run(batches):
        codes = word_codes()
        for batch in slices(batches):
            w = words(*raw(batch.column("text")), codes)
            at, gram = [], []
            for k in sizes:
                first, h = grams(w, k)
                h = h.view(np.int64)
                place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = known[place] == h
                at.append(first[hit])
                gram.append(h[hit])
            at, gram = np.concatenate(at), np.concatenate(gram)
            order = np.argsort(at, kind="stable")
            at, gram = at[order], gram[order]
            doc = w.doc[at]
            ends = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(w.counts, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(at - w.bounds[doc], pa.int32())),
                                              pa.ListArray.from_arrays(ends, pa.array(gram))], ["doc_id", "n_words", "at", "gram"])

    return run


def license_scan(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score`` (best cover of a template), ``spans`` (label:first:last word, of verified notices, sorted)."""
    spark = docs.sparkSession
    listed = template_grams([(*p, True) for p in phrases] + [(*n, False) for n in notices])
    known = np.unique(np.array([r[6] for r in listed], dtype=np.int64))
    tells = spark.createDataFrame(list(telling(listed).items()) or [(-1, [])], "template int, tells array<array<int>>")
    positions = spark.createDataFrame(listed, "template int, label string, phrase boolean, n int, k int, tpos int, gram long")
    own = docs.select(F.col("doc_id").cast("long"), "text")
    scanned = settled(own.mapInArrow(_scan(known, sorted({r[4] for r in listed})), _SCANNED).withColumn("row", F.monotonically_increasing_id()), "scanned")
    hits = scanned.select("row", F.explode(F.arrays_zip("at", "gram")).alias("x")).select("row", "x.at", "x.gram")
    # at most MOST_GRAMS rows
    votes = hits.join(F.broadcast(positions), "gram").groupBy("row", "template", "label", "phrase", "n", "k", (F.col("at") - F.col("tpos")).alias("diagonal")).agg(
        F.collect_set("tpos").alias("tpos"), F.min("at").alias("first"), F.max("at").alias("last"))
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    opens = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by)) > NEIGHBOURS, F.lit(True))
    runs = votes.withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(by))
    covered = F.size(F.array_distinct(F.flatten(F.transform("tpos", lambda p: F.sequence(p, p + F.col("k") - 1)))))
    merged = runs.groupBy("row", "template", "label", "phrase", "n", "k", "run").agg(
        F.array_distinct(F.flatten(F.collect_list("tpos"))).alias("tpos"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.count_if(F.col("phrase") & (F.size("tpos") == F.col("n") - F.col("k") + 1)).alias("places"),
        F.min(F.when(F.size("tpos") == F.col("n") - F.col("k") + 1, F.col("diagonal"))).alias("low"),
        F.max(F.when(F.size("tpos") == F.col("n") - F.col("k") + 1, F.col("diagonal"))).alias("high"))
    cover = F.least(covered / F.col("n"), F.lit(1.0))
    end = F.col("last") + F.col("k") - 1
    # several places of one template may lie on neighbouring diagonals, so a run of whole places has no length to keep to
    sound = (cover >= MIN_COVER) & ((end - F.col("first") + 1 <= F.ceil(F.col("n") * 1.25) + 2) | F.col("low").isNotNull())
    told = F.forall(F.coalesce("tells", F.array().cast("array<array<int>>")), lambda some: F.arrays_overlap(some, "tpos"))
    # one row for each template
    judged = merged.join(F.broadcast(tells), "template", "left").withColumn("cover", cover).withColumn("sound", sound & told & ~F.col("phrase"))
    base = F.col("phrase") & (F.col("places") > 0)
    span = F.concat_ws(":", "label", F.lpad(F.col("first").cast("string"), 10, "0"), F.lpad(end.cast("string"), 10, "0"))
    facts = judged.groupBy("row").agg(
        F.sum("places").alias("n_base"), F.min(F.when(base, F.col("low"))).alias("first_word"), F.max(F.when(base, F.col("high"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(base | F.col("sound"), F.col("label")))), ",").alias("labels"),
        F.max(F.when(base, 1.0).when(F.col("phrase"), 0.0).otherwise(F.col("cover"))).alias("score"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("sound"), span))), ",").alias("spans"))
    return scanned.select("row", "doc_id", "n_words").join(facts, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_labels", "labels")], F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("spans", F.lit("")).alias("spans"))
