"""License scans with a positional index of rare words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import SEPARATORS

# Base phrases by label.
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
# Templates of well-known grants, each with the phrase that must stand in it.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted"),
    ("mit", "released under the mit license", "mit license"),
    ("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", "general public license"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "into the public domain"),
    ("cc", "licensed under a creative commons attribution license", "creative commons"),
)
# Share of a template's word weight that must stand in place.
LEAST = 0.7


def words(text: Column) -> Column:
    """Lower-cased words of a text; the Kelvin sign, whose lower case is an ASCII letter, stays apart."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u2126")))
    return F.array_remove(F.split(plain, SEPARATORS), "")


def _index(docs: DataFrame) -> DataFrame:
    """One row: the number of documents, and of those with each licence word."""
    held = docs.select(words(F.col("text")).alias("w")).select(
        F.array_distinct(F.filter("w", lambda w: w.isin(*_vocabulary()))).alias("w")
    )
    per_word = held.select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return per_word.agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("found"))


def _vocabulary() -> list[str]:
    return sorted({w for _, t, *_ in (*BASE, *TEMPLATES) for w in t.split()})


def _templates() -> Column:
    """All templates as an array of structs, from the columns ``n_docs`` and ``found``.

    The weight of a word is its inverse document frequency over the whole table.
    """

    def listed(values) -> str:
        return f"array({', '.join(values)})"

    def quoted(words: list[str]) -> str:
        return listed(f"'{w}'" for w in words)

    rows = []
    for i, (label, text, *key) in enumerate((*BASE, *TEMPLATES)):
        tokens = text.split()
        phrase = (key[0] if key else text).split()
        at = next(k for k in range(len(tokens)) if tokens[k : k + len(phrase)] == phrase)
        idf = listed(f"ln((n_docs + 2.0D) / (coalesce(element_at(found, '{w}'), 0) + 1.0D))" for w in tokens)
        rows.append(
            f"named_struct('label', '{label}', 'base', {i < len(BASE)}, 'words', {quoted(tokens)}, 'idf', {idf}, "
            f"'key_at', {at}, 'key', {quoted(phrase)}, 'least', {1.0 if i < len(BASE) else LEAST}D)"
        )
    return F.expr(listed(rows))


def _rare(t: Column) -> Column:
    """Positions of a template's heaviest words, as few as together outweigh the allowed miss.

    Every match holds one of them at least.
    """
    ranked = F.sort_array(F.transform(t["idf"], lambda x, i: F.struct(x.alias("w"), (-i).alias("i"))), asc=False)
    total = F.aggregate(t["idf"], F.lit(0.0), lambda a, x: a + x)
    allowed = (1.0 - t["least"]) * total
    start = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<int>").alias("at"))
    kept = F.aggregate(
        ranked, start,
        lambda a, r: F.when(
            (a["sum"] <= allowed + 1e-9) | (F.size(a["at"]) == 0),
            F.struct((a["sum"] + r["w"]).alias("sum"), F.concat(a["at"], F.array(-r["i"])).alias("at")),
        ).otherwise(a),
    )
    return kept["at"]


def license_scan(docs: DataFrame) -> DataFrame:
    """Licences named or granted in every whole text.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.
    The index holds every template word with its position. Of a template, only its rarest
    words (by document frequency over the table) are looked up in a text; each place of one,
    less its position in the template, is a candidate start, at which the other words are
    compared by position and the key phrase must stand whole. Base phrases must match in all
    words and give the counts and places; templates need a LEAST share of their weight. The
    score is the largest share found, 0 without a licence.

    Everything happens within a row, so no text is shuffled and no row is large because of
    another. A null or empty text has no words, null places, empty labels and score 0;
    repeated rows are scanned one by one, an empty table gives no rows, other columns are
    ignored.
    """
    # Two bounded figures: the number of rows, and one count for each licence word.
    n_docs = docs.select(F.count("*").cast("double").alias("n")).scalar()
    filled = F.coalesce(F.col("found"), F.create_map().cast("map<string,bigint>"))
    heads = _index(docs).select(filled.alias("found")).withColumn("n_docs", n_docs).select(_templates().alias("t"))
    heads = heads.select(F.transform("t", lambda t: t.withField("rare", _rare(t))).alias("t"))
    heads = heads.select(
        F.transform("t", lambda t: t.withField("total", F.aggregate(t["idf"], F.lit(0.0), lambda a, x: a + x))).alias("t")
    )
    anchors = F.array_distinct(F.flatten(F.transform("t", lambda t: F.transform(t["rare"], lambda j: t["words"][j]))))
    index = heads.select(F.struct(anchors.alias("anchors"), "t")).scalar()

    def anchored(w: Column) -> Column:
        # The fixed list settles most words, by hash; the rare ones are a few of it.
        return w.isin(*_vocabulary()) & F.array_contains(F.col("index")["anchors"], w)

    hits = F.filter(
        F.transform("w", lambda w, i: F.when(anchored(w), F.struct(w.alias("word"), i.alias("at")))), lambda h: h.isNotNull()
    )
    found = docs.select("doc_id", words(F.col("text")).alias("w"), index.alias("index")).withColumn("hits", hits)
    found = found.withColumn("n_words", F.size("w").cast("long"))
    found = found.withColumn("templates", F.when(F.size("hits") > 0, F.col("index")["t"]))

    def share(t: Column, start: Column) -> Column:
        held = F.aggregate(
            F.transform(t["words"], lambda w, j: F.when(F.get(F.col("w"), start + j) == w, t["idf"][j]).otherwise(0.0)),
            F.lit(0.0), lambda a, x: a + x,
        )
        return held / t["total"]

    def starts(t: Column) -> Column:
        from_rare = F.flatten(
            F.transform(t["rare"], lambda j: F.transform(F.filter("hits", lambda h: h["word"] == t["words"][j]), lambda h: h["at"] - j))
        )
        inside = F.filter(F.array_distinct(from_rare), lambda s: (s >= 0) & (s + F.size(t["words"]) <= F.size("w")))
        key_stands = F.filter(inside, lambda s: F.slice(F.col("w"), s + t["key_at"] + 1, F.size(t["key"])) == t["key"])
        scored = F.transform(key_stands, lambda s: F.struct(s.alias("at"), share(t, s).alias("share")))
        return F.filter(scored, lambda m: m["share"] >= t["least"] - 1e-9)

    matches = F.transform(
        "templates",
        lambda t: F.struct(t["label"].alias("label"), t["base"].alias("base"), F.size(t["words"]).alias("n"), starts(t).alias("m")),
    )
    found = found.withColumn("matches", F.filter(matches, lambda m: F.size(m["m"]) > 0))
    base = F.filter("matches", lambda m: m["base"])
    places = F.flatten(F.transform(base, lambda m: m["m"]["at"]))
    found = found.select(
        "doc_id", "n_words", "matches", F.coalesce(places, F.array().cast("array<int>")).alias("places"),
        F.coalesce(base, F.slice("matches", 1, 0)).alias("base"),
    )
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        _joined(F.col("base")).alias("base_labels"), _joined(F.col("matches")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.flatten(F.transform("matches", lambda m: m["m"]["share"]))), F.lit(0.0)), 6).alias("score"),
    )


def _joined(matches: Column) -> Column:
    return F.coalesce(F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"])))), F.lit(""))
