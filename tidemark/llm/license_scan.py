"""Licence notices in documents, by a trained classifier of stretches and the wording of notices.

A paragraph is the lines between two lines without letters or digits, joined; what marks comments
goes. It is cut into overlapping stretches. Sparse logistic regression over hashed word uni- and
bigrams weighs every family against ``unknown`` and names the families that are likelier than
unknown by a calibrated measure and likelier than the families are on average. Template comparison
confirms a named family: its telling words stand in the stretch (the name with its version, or
wording of its own) and it holds enough of the bigrams of one of its notices. Nothing stands that
the classifier does not name.

``SIGNS`` stands wherever telling words do, so stretches without it could never be confirmed and are
not scored. The classifier learns the unknown class from all stretches that are scored and hold
little of a notice, but for a half of them by hash, which calibrates it. What it is to find are
thinned-out copies of notices, a fixed number, set into as many paragraphs as ``DRAWN`` says; these
are learned without the notice as well. Built-in functions and the library's estimator only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

DRAWN = 4_000  # paragraphs for the copies of notices that are learned, and as many for those held out
WEIGHT = 16_000  # rows that the unknown class weighs at most, however many there are
COPIES = 10  # thinned-out copies of each notice
HELD = 2  # copies that are not learned but calibrate
FEATURES = 1 << 13
STEP = 48  # words from one stretch to the next, which is as long again; no notice is longer
PASSING = 0.999  # share of ordinary held-out stretches in which no family is named, unless
LEAST = 0.05  # no family is named below this probability
FOUND = 0.99  # this share of the held-out notices needs a lower probability
SHORT = 12  # words of the short stretches that are learned as well
ALIKE = 0.5  # least share of a notice's bigrams
LIKE = 0.3  # from here a sampled stretch is not ordinary


def _version(number: str) -> str:
    return rf"(?:version |v )?v?{number}"


_TWO, _THREE = r"2(?:\.0)?", r"3(?:\.0)?"
_PUBLISHED = r"(?:a?l?gpl )?(?:as published by the free software foundation )?(?:either )?"


def _gnu(before: str, short: str, number: str) -> str:
    return (rf"{before}general public licen[cs]e {_PUBLISHED}{_version(number)} "
            rf"| {short} (?:licen[cs]e )?{_version(number)} | {short}v{number} ")


# Fixed values: (names in a sentence, telling words in blank-separated text, notices of its own).
_FAMILIES = {
    "MIT": (["MIT License"], r" mit licen[cs]e | (?:identifier|under|under the) mit "
            r"|any person obtaining a copy of this software and associated documentation", [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction",
    ]),
    "Apache-2.0": (["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license"],
                   rf" apache (?:software )?(?:licen[cs]e )?{_version(_TWO)} ", [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
    ]),
    "BSD-3-Clause": (["BSD 3-Clause License", "3-Clause BSD License"],
                     r" bsd style licen[cs]e | (?:(?:3|three) clause|new|modified|revised) bsd "
                     r"| bsd (?:3|three) clause |redistribution and use in source and binary forms", [
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ]),
    "BSD-2-Clause": (["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
                     r" (?:(?:2|two) clause|simplified) bsd | bsd (?:2|two) clause ", []),
    "ISC": (["ISC License"], r" isc licen[cs]e | identifier isc "
            r"|permission to use copy modify and or distribute this software", [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ]),
    "MPL-2.0": (["Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
                rf" (?:mozilla public licen[cs]e|mpl) {_version(_TWO)} ", [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ]),
    "EPL-2.0": (["Eclipse Public License 2.0", "Eclipse Public License, v. 2.0"],
                rf" (?:eclipse public licen[cs]e|epl) {_version(_TWO)} ", [
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0",
    ]),
    "BSL-1.0": (["Boost Software License, Version 1.0"],
                rf" boost software licen[cs]e {_version('1.0')} | bsl 1.0 ", []),
    "Unlicense": (["Unlicense"], r" (?:the|identifier) unlicense |free and unencumbered software", [
        "This is free and unencumbered software released into the public domain.",
    ]),
    "CC0-1.0": (["CC0 1.0", "Creative Commons CC0 1.0 Universal license"], r" cc0 ", []),
}
for _name, _before, _title, _number in (
        ("GPL-2.0", r"(?<!lesser )(?<!library )(?<!affero )", "GNU General Public License", "2"),
        ("GPL-3.0", r"(?<!lesser )(?<!library )(?<!affero )", "GNU General Public License", "3"),
        ("LGPL-2.1", "lesser ", "GNU Lesser General Public License", "2.1"),
        ("LGPL-3.0", "lesser ", "GNU Lesser General Public License", "3"),
        ("AGPL-3.0", "affero ", "GNU Affero General Public License", "3")):
    _short = _name.split("-")[0]
    _FAMILIES[_name] = (
        [f"{_title}, version {_number}", f"{_title} v{_number}", f"{_short} v{_number}", f"{_short}v{_number}"],
        _gnu(_before, _short.lower(), {"2": _TWO, "3": _THREE}.get(_number, _number)),
        ["This program is free software: you can redistribute it and/or modify it under the terms "
         f"of the {_title} as published by the Free Software Foundation, either "
         f"version {_number} of the License, or (at your option) any later version."])
_PARTS = {"BY": ("Attribution", "attribution"), "NC": ("NonCommercial", "non ?commercial"),
          "SA": ("ShareAlike", "share ?alike"), "ND": ("NoDerivatives", "no ?deriv(?:ative)?s")}
for _parts in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
    for _number in ("2.0", "2.5", "3.0", "4.0"):
        _own = [_PARTS[p] for p in _parts.split("-")]
        _long = "-".join(n for n, _ in _own)
        _FAMILIES[f"CC-{_parts}-{_number}"] = (
            [f"CC {_parts} {_number}", f"Creative Commons {_long} {_number} License",
             f"Creative Commons {_long} {_number} International License"],
            rf" cc {_parts.lower().replace('-', ' ')} {_version(_number)} "
            rf"| {' '.join(t for _, t in _own)} {_version(_number)} ", [])

# The notices by which licences ask to be named, and usual short forms.
NOTICES = {
    f: [form.format(name) for name in names for form in (
        "Licensed under {}.", "Released under the {}.",
        "This work is licensed under the terms of the {}.", "This work is licensed under a {}.")]
    + [f"SPDX-License-Identifier: {f}", *own] for f, (names, _, own) in _FAMILIES.items()}
TELLING = {f: telling for f, (_, telling, _) in _FAMILIES.items()}
# Words one of which stands wherever telling words do, in lower-case text as it came.
SIGNS = (r"licen[cs]|permission|redistribut|obtaining[^a-z0-9]+a|gpl|general[^a-z0-9]+public"
         r"|creative[^a-z0-9]+commons|attribution|\bcc[^a-z0-9]+by|\bcc0|unencumbered"
         r"|apache[^a-z0-9]+(?:software|v|2)|under[^a-z0-9]+(?:the[^a-z0-9]+)?mit\b|\b[me]pl\b|\bbsd\b"
         r"|\bbsl\b|identifier[^a-z0-9]+(?:isc|mit)\b")
# Sentences with words of notices that are none.
OTHER = [
    "His driving license was taken away.", "The work is free of charge.",
    "Permission to land was granted by the tower.", "A new version of the software came out.",
    "The general public is not admitted.", "Use of this source is at your own risk.",
]
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *NOTICES]


def words(text: Column) -> Column:
    """Letters and digits, with dots inside."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9.]+|[.]+(?![a-z0-9])|(?<![a-z0-9])[.]+"),
                    lambda w: w != "")


def bigrams(tokens: Column) -> Column:
    return F.zip_with(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
                      F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))),
                      lambda a, b: F.concat_ws(" ", a, b))


def _tokens(df: DataFrame, tokens: Column) -> DataFrame:
    return df.withColumn("_words", tokens).withColumn(
        "_pairs", bigrams(F.col("_words"))).withColumn("_grams", F.concat("_words", "_pairs"))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _two, _at, _paragraph): the lines between lines without letters or digits, where they
    have letters; null and empty texts have none. _two: the text has two of the three BSD clauses."""
    low = F.lower(F.col(text).cast("string"))
    two = (low.rlike("binary[^a-z0-9]+form[^a-z0-9]+must[^a-z0-9]+reproduce")
           & ~low.rlike("neither[^a-z0-9]+the[^a-z0-9]+names?[^a-z0-9]"))
    found = docs.select(F.col(id_col).alias("_doc"), two.alias("_two"), F.posexplode(
        F.split(F.col(text).cast("string"), "\n[^A-Za-z0-9]*\n")).alias("_at", "_paragraph"))
    return found.filter(F.col("_paragraph").rlike("[A-Za-z]"))


def _stretches(tokens: Column) -> Column:
    """Overlapping stretches of 2 * STEP words; any STEP neighbours are together in one."""
    starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size(tokens) - 1) / STEP) - 1, F.lit(0)).cast("int"))
    return F.transform(starts, lambda i: F.slice(tokens, i * STEP + 1, 2 * STEP))


def _notices(df: DataFrame) -> DataFrame:
    """(label, _copy, _paragraph): the notices, and copies of them with a fifth of the words left out."""
    rows = [(FAMILIES.index(f), t) for f, ts in NOTICES.items() for t in ts]
    rows += [(0, t) for t in OTHER]
    full = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(float(n)).alias("label"), F.lit(t).alias("_paragraph")) for n, t in rows])))
    copy = F.explode(F.sequence(F.lit(0), F.lit(COPIES + HELD - 1)))
    thin = F.concat_ws(" ", F.filter(
        F.split("_paragraph", " "),
        lambda w, i: (F.col("_copy") == 0) | (F.pmod(F.xxhash64(w, i, "_copy"), F.lit(5)) > 0)))
    return full.withColumn("_copy", copy).select("label", "_copy", thin.alias("_paragraph"))


@dataclass(frozen=True)
class Model:
    regression: LogisticRegressionModel
    least: float


def _hashed(df: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams",
                     outputCol="_features").transform(df)


def _chances(df: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """With _chances, of each family against unknown, zero where it is less likely than the families
    are on average. Each is weighed by itself, so a stretch may name several."""
    scored = model.transform(_hashed(df)).withColumn("_raw", vector_to_array("rawPrediction"))
    named = scored.withColumn("_own", F.slice("_raw", 2, len(NOTICES))).withColumn(
        "_mean", F.aggregate("_own", F.lit(0.0), lambda s, x: s + x) / len(NOTICES))
    return named.withColumn("_chances", F.transform("_own", lambda x: F.when(
        x > F.col("_mean"), 1 / (1 + F.exp(F.element_at("_raw", 1) - x))).otherwise(0.0)))


def _known(df: DataFrame) -> DataFrame:
    """(_family, _number, _known): the bigrams of each family's notices; a fixed number of rows."""
    rows = [F.struct(F.lit(f).alias("_family"), F.lit(FAMILIES.index(f)).alias("_number"),
                     F.array(*[F.lit(t) for t in ts]).alias("_texts")) for f, ts in NOTICES.items()]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows))).select(
        "_family", "_number",
        F.transform("_texts", lambda t: F.array_distinct(bigrams(words(t)))).alias("_known"))


def contained(pairs: Column, known: Column) -> Column:
    """The largest share of a notice's bigrams that is found."""
    return F.array_max(F.transform(
        known, lambda own: F.size(F.array_intersect(own, pairs)) / F.size(own)))


def _set_in(notices: DataFrame, ordinary: DataFrame) -> DataFrame:
    """(label, _words): each copy of a notice with up to a stretch of ordinary words around it."""
    numbered = ordinary.select("_words", (F.row_number().over(Window.orderBy("_h")) - 1).alias("_n"))
    count = max(1, ordinary.count())  # some DRAWN rows
    draw = F.xxhash64("label", "_paragraph", "_copy")
    placed = notices.withColumn("_n", F.pmod(draw, F.lit(count))).withColumn(
        "_own", words(F.col("_paragraph"))).join(numbered, "_n", "left")
    around = F.coalesce("_words", F.array().cast("array<string>"))
    room = F.least(F.size(around), F.greatest(2 * STEP - F.size("_own"), F.lit(0)))
    # A sixth of the copies stand alone, the others in a fifth of the room and more.
    length = F.floor(room * F.pmod(F.xxhash64("_copy", "_paragraph"), F.lit(6)) / 5).cast("int")
    placed = placed.withColumn("_around", around).withColumn("_length", length).withColumn(
        "_before", F.pmod(draw, F.col("_length") + 1).cast("int"))
    return placed.select("label", F.concat(
        F.slice("_around", F.lit(1), F.col("_before")), "_own",
        F.slice("_around", F.col("_before") + 1, F.col("_length") - F.col("_before"))).alias("_words"))


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
          cut: DataFrame | None = None) -> Model:
    """From the notices, set into a stretch each of ``DRAWN`` different paragraphs, and from all
    different stretches with signs. Those that hold much of a notice are not taken for ordinary.
    The least probability leaves ``PASSING`` of the held-out half unknown, or is what names
    ``FOUND`` of the held-out notices where that is lower: template comparison still refuses, and
    what is not named is lost. It is ``LEAST`` at least. ``cut``: what ``signed`` found, if known."""
    lines = paragraphs(docs, id_col, text).withColumn("_h", F.xxhash64("_paragraph"))
    chosen = lines.select("_h").distinct().orderBy("_h").limit(2 * DRAWN)
    drawn = lines.join(F.broadcast(chosen), "_h").select("_h", words(F.col("_paragraph")).alias("_all"))
    # One stretch of each, its place drawn by hash.
    place = F.pmod(F.xxhash64("_h"), F.greatest(F.size("_all") - 2 * STEP, F.lit(0)) + 1).cast("int")
    drawn = drawn.select("_h", F.slice("_all", place + 1, 2 * STEP).alias("_words"))
    every = _known(docs).agg(F.flatten(F.collect_list("_known")).alias("_known"))

    def ordinary(rows: DataFrame, name: str) -> list[DataFrame]:
        """The halves, learned and kept, of different stretches without much of a notice."""
        each = _tokens(rows.groupBy("_h").agg(F.min("_words").alias("_words")), F.col("_words"))
        halves = stored(
            each.crossJoin(F.broadcast(every))  # one row
            .filter(F.coalesce(contained(F.col("_pairs"), F.col("_known")), F.lit(0.0)) < LIKE)
            .select("_h", F.pmod(F.xxhash64("_h", F.lit(1)), F.lit(2)).alias("_half"), "_words"), name)
        return [halves.filter(F.col("_half") == n).select("_h", "_words") for n in (0, 1)]

    learned, kept = ordinary(drawn, "ordinary-stretches")
    cut = signed(docs, id_col, text) if cut is None else cut
    scored = cut.filter("_words IS NOT NULL").select(
        F.xxhash64("_words").alias("_h"), "_words")
    scored_learned, scored_kept = ordinary(scored, "scored-stretches")

    def plain(rows: DataFrame) -> DataFrame:
        both = F.explode(F.array("_words", F.slice("_words", 1, SHORT)))
        return rows.select(F.lit(0.0).alias("label"), both.alias("_words"))

    copies = _notices(docs)
    unknown = plain(learned.unionByName(scored_learned))
    weight = min(1.0, WEIGHT / max(1, unknown.count()))
    given = _tokens(
        _set_in(copies.filter(F.col("_copy") < COPIES), learned).withColumn("_weight", F.lit(1.0))
        .unionByName(unknown.withColumn("_weight", F.lit(weight))), F.col("_words"))
    model = LogisticRegression(
        featuresCol="_features", labelCol="label", weightCol="_weight", family="multinomial",
        regParam=1e-3, maxIter=40).fit(stored(
            _hashed(given).select("label", "_weight", "_features"), "learned-stretches"))

    def quantile(rows: DataFrame, chance: Column, share: float) -> float | None:
        return _chances(_tokens(rows, F.col("_words")), model).agg(
            F.percentile_approx(chance, share)).first()[0]

    passing = quantile(plain(kept.unionByName(scored_kept)), F.array_max("_chances"), PASSING)
    held = _set_in(copies.filter((F.col("_copy") >= COPIES) & (F.col("label") > 0)), kept)
    found = quantile(held, F.element_at("_chances", F.col("label").cast("int")), 1 - FOUND)
    return Model(model, max(LEAST, min(passing or 0.5, found)))


def named(df: DataFrame, model: Model) -> DataFrame:
    """A row for each family that the classifier names in a stretch of ``_words``, with
    ``_family``, ``probability`` (against unknown) and the family's ``_known`` bigrams."""
    scored = _chances(_tokens(df, F.col("_words")), model.regression)
    likely = scored.select(*df.columns, "_pairs", F.posexplode("_chances").alias("_place", "probability"))
    return likely.filter(F.col("probability") >= model.least).withColumn(
        "_number", F.col("_place") + 1).join(F.broadcast(_known(df)), "_number")


def confirmed(df: DataFrame) -> DataFrame:
    """What template comparison leaves of named families, with ``similarity``."""
    said = F.concat(F.lit(" "), F.concat_ws(" ", "_words"), F.lit(" "))
    tells = F.coalesce(*[F.when(F.col("_family") == f, F.col("_said").rlike(t)) for f, t in TELLING.items()])
    return df.withColumn("_said", said).filter(tells).withColumn(
        "similarity", contained(F.col("_pairs"), F.col("_known"))).filter(F.col("similarity") >= ALIKE)


def signed(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _at, _two, _words): the stretches with signs of paragraphs with signs, or null for none."""
    signs = F.lower(F.col(text).cast("string")).rlike(SIGNS)
    lines = paragraphs(docs.filter(signs), id_col, text).filter(F.lower("_paragraph").rlike(SIGNS))
    cut = lines.select("_doc", "_at", "_two", words(F.col("_paragraph")).alias("_all"))
    found = F.filter(_stretches(F.col("_all")), lambda s: F.concat_ws(" ", s).rlike(SIGNS))
    return stored(cut.select("_doc", "_at", "_two", F.explode_outer(found).alias("_words")), "stretches")


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text",
         cut: DataFrame | None = None) -> DataFrame:
    """One row per paragraph with a sign of a notice and family in it: id, paragraph number, family,
    probability, similarity (share of a notice found). A paragraph with signs in which no family
    stands has one row, ``unknown``, with neither. ``cut``: what ``signed`` found, if known."""
    cut = signed(docs, id_col, text) if cut is None else cut
    alike = confirmed(named(cut.filter("_words IS NOT NULL"), model))
    two = F.col("_two") & (F.col("_family") == "BSD-3-Clause") & F.array_contains("_pairs", "binary forms")
    stands = alike.select(
        "_doc", "_at", F.when(two, "BSD-2-Clause").otherwise(F.col("_family")).alias("family"),
        "probability", "similarity")
    none = F.lit(None)
    every = stands.unionByName(cut.select(
        "_doc", "_at", none.cast("string").alias("family"), none.cast("double").alias("probability"),
        none.cast("double").alias("similarity")))
    # The surest of each family first, so a paragraph's list has one entry a family.
    each = every.groupBy("_doc", "_at", "family").agg(F.max(F.struct("probability", "similarity")).alias("_s"))
    found = each.groupBy("_doc", "_at").agg(F.collect_list(F.when(F.col("family").isNotNull(), F.struct(
        "family", "_s"))).alias("_best"))
    return found.select("_doc", "_at", F.explode_outer("_best").alias("_b")).select(
        F.col("_doc").alias(id_col), F.col("_at").cast("bigint").alias("paragraph"),
        F.coalesce("_b.family", F.lit(UNKNOWN)).alias("family"), F.col("_b._s.probability").alias("probability"),
        F.col("_b._s.similarity").alias("similarity"))


def license_report(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text",
                   cut: DataFrame | None = None) -> DataFrame:
    """One row per row: id, licenses (families in alphabetical order, null without one),
    n_notices, n_unknown (paragraphs with signs but no confirmed family), probability (of the
    surest notice). A paragraph's notices of one family count once. Rows that share an id share their notices; null ids count as one id."""
    known = F.col("family") != UNKNOWN
    found = scan(docs, model, id_col, text, cut).groupBy(F.col(id_col).alias("_id")).agg(
        F.concat_ws(", ", F.array_sort(F.collect_set(F.when(known, F.col("family"))))).alias("licenses"),
        F.count_if(known).alias("n_notices"), F.count_if(~known).alias("n_unknown"),
        F.max(F.when(known, F.col("probability"))).alias("probability"))
    zero = F.lit(0).cast("bigint")
    return docs.select(id_col).join(found, F.col(id_col).eqNullSafe(F.col("_id")), "left").select(
        id_col, F.when(F.col("licenses") != "", F.col("licenses")).alias("licenses"),
        F.coalesce("n_notices", zero).alias("n_notices"),
        F.coalesce("n_unknown", zero).alias("n_unknown"), "probability")
