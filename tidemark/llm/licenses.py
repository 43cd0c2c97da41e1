"""License scan with ordered signature rules, in DataFrame functions only.

A text is lower-cased (A-Z), its words are put in one line with single blanks,
and a keyword prefilter decides which rules run at all.  A rule is a regex over
whole words with a label, a priority and a weight; the table is built from
hand-written license names, versions and phrasings.  Every detection is an
interval of word numbers.  A detection inside a longer one, or on the same
words with a lower priority, is suppressed: "gnu general public license" inside
"gnu lesser general public license version 3" says nothing of its own.  Labels
of base phrases always stay.

Everything happens within the row: no shuffle, no join, no Python.  Texts
without any keyword cost one pass.

Edge cases: null text is empty: no words, no labels, score 0.  Repeated rows are
scanned each; an empty table gives no row; a very long text is scanned whole, in
one task; a caller's column named like an output is replaced by it.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table, unpack

#: Fixed by the contract: phrase and label.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: (keyword, name regex, label, versions).  Every match of the regex has the
#: keyword at the beginning of a word, so a name without it has its own row.
FAMILIES = (
    ("general public", "gnu affero general public licen[cs]e", "agpl", ("1", "3")),
    ("general public", "gnu (?:lesser|library) general public licen[cs]e", "lgpl", ("2", "2 1", "3")),
    ("affero gpl", "affero gpl", "agpl", ("1", "3")),
    ("agpl", "agpl|gnu agpl", "agpl", ("1", "3")),
    ("lgpl", "lgpl|gnu lgpl", "lgpl", ("2", "2 1", "3")),
    ("gpl", "gpl|gnu gpl", "gpl", ("1", "2", "3")),
    ("general public", "gnu general public licen[cs]e|general public licen[cs]e", "gpl", ("1", "2", "3")),
    ("free documentation", "gnu free documentation licen[cs]e", "gfdl", ("1 1", "1 2", "1 3")),
    ("gfdl", "gfdl", "gfdl", ("1 1", "1 2", "1 3")),
    ("apache", "apache (?:software )?licen[cs]e", "apache", ("1 0", "1 1", "2 0", "2")),
    ("mit ", "mit licen[cs]e|mit x11 licen[cs]e", "mit", ()),
    ("expat ", "expat licen[cs]e", "mit", ()),
    ("bsd", "bsd(?: style)? licen[cs]e", "bsd", ("2 clause", "3 clause", "4 clause")),
    ("berkeley", "berkeley software distribution licen[cs]e", "bsd", ("2 clause", "3 clause", "4 clause")),
    ("bsd", "(?:new|simplified|modified|revised) bsd licen[cs]e", "bsd", ()),
    ("mozilla", "mozilla public licen[cs]e", "mpl", ("1 0", "1 1", "2 0")),
    ("mpl ", "mpl", "mpl", ("1 0", "1 1", "2 0")),
    ("eclipse", "eclipse public licen[cs]e", "epl", ("1 0", "2 0")),
    ("epl ", "epl", "epl", ("1 0", "2 0")),
    ("cc ", "cc by nc nd", "cc-by-nc-nd", ("2 0", "2 5", "3 0", "4 0")),
    ("cc ", "cc by nc sa", "cc-by-nc-sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc ", "cc by nc", "cc-by-nc", ("2 0", "2 5", "3 0", "4 0")),
    ("cc ", "cc by nd", "cc-by-nd", ("2 0", "2 5", "3 0", "4 0")),
    ("cc ", "cc by sa", "cc-by-sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc ", "cc by", "cc-by", ("2 0", "2 5", "3 0", "4 0")),
    ("cc0 ", "cc0", "cc0", ("1 0",)),
    ("creative commons", "creative commons zero", "cc0", ("1 0",)),
    ("creative commons", "creative commons attribution share ?alike", "cc-by-sa", ("2 0", "2 5", "3 0", "4 0")),
    ("creative commons", "creative commons attribution non ?commercial", "cc-by-nc", ("2 0", "2 5", "3 0", "4 0")),
    ("creative commons", "creative commons attribution no ?deriv(?:ative)?s", "cc-by-nd", ("2 0", "2 5", "3 0", "4 0")),
    ("creative commons", "creative commons attribution", "cc-by", ("2 0", "2 5", "3 0", "4 0")),
    ("artistic", "artistic licen[cs]e", "artistic", ("1 0", "2 0")),
    ("boost", "boost software licen[cs]e", "bsl", ("1 0",)),
    ("isc ", "isc licen[cs]e", "isc", ()),
    ("zlib", "zlib(?: libpng)? licen[cs]e", "zlib", ()),
    ("unlicense", "the unlicense|unlicense", "unlicense", ()),
    ("wtfpl", "wtfpl", "wtfpl", ("2",)),
    ("do what the", "do what the fuck you want to public licen[cs]e", "wtfpl", ("2",)),
    ("european union", "european union public licen[cs]e", "eupl", ("1 0", "1 1", "1 2")),
    ("common development", "common development and distribution licen[cs]e", "cddl", ("1 0", "1 1")),
    ("common public", "common public licen[cs]e", "cpl", ("1 0",)),
    ("microsoft", "microsoft public licen[cs]e", "ms-pl", ()),
    ("microsoft", "microsoft reciprocal licen[cs]e", "ms-rl", ()),
    ("python", "python software foundation licen[cs]e", "psf", ("2", "2 0")),
    ("psf ", "psf licen[cs]e", "psf", ("2", "2 0")),
    ("open database", "open database licen[cs]e", "odbl", ("1 0",)),
    ("odbl", "odbl", "odbl", ("1 0",)),
    ("open font", "sil open font licen[cs]e|open font licen[cs]e", "ofl", ("1 0", "1 1")),
    ("academic free", "academic free licen[cs]e", "afl", ("2 0", "2 1", "3 0")),
    ("server side", "server side public licen[cs]e", "sspl", ("1",)),
)
#: Single phrases: keyword, regex, label, priority, weight.
PHRASES = (
    ("public domain", "(?:dedicated to|released into|in) the public domain", "public-domain", 6, 0.8),
    ("all rights reserved", "all rights reserved", "all-rights-reserved", 4, 0.6),
    ("proprietary", "proprietary and confidential", "proprietary", 6, 0.9),
    ("permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", "mit", 8, 1.0),
    ("redistribution and use", "redistribution and use in source and binary forms with or without modification", "bsd", 8, 1.0),
    ("permission to use", "permission to use copy modify and or distribute this software for any purpose", "isc", 8, 1.0),
    ("free software", "this program is free software you can redistribute it and or modify", "gpl", 7, 0.9),
    ("as is", "provided as is without warranty of any kind", "no-warranty", 3, 0.4),
)
#: Phrasings of a family: regex with {n} for the name and {v} for a version; priority; weight.
NAMED = (("{n}", 5, 0.7),
         ("(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?(?:{n})", 7, 0.9),
         ("spdx license identifier (?:{n})", 9, 1.0))
VERSIONED = (("(?:{n}) (?:version |v)?{v}", 6, 0.9),
             ("(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?(?:{n}) (?:version |v)?{v}", 8, 1.0))


def rules() -> list[tuple[str, str, str, int, float, bool]]:
    """(keyword, regex, label, priority, weight, base) of all rules."""
    out = [(phrase.split(" ")[0] + " ", phrase, label, 5, 0.7, True) for phrase, label in BASE]
    for keyword, name, label, versions in FAMILIES:
        out += [(keyword, f.format(n=name), label, p, w, False) for f, p, w in NAMED]
        out += [(keyword, f.format(n=name, v=v), f"{label}-{v.replace(' ', '-' if 'clause' in v else '.')}", p, w, False)
                for v in versions for f, p, w in VERSIONED]
    return out + [(k, r, label, p, w, False) for k, r, label, p, w in PHRASES]


_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _spans(line: Column, pattern: Column) -> Column:
    """First and last-plus-one word of every place of a regex in a line of
    words that begins and ends with a blank."""
    whole = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    found = F.regexp_extract_all(line, whole, F.lit(0))
    sizes = F.transform(F.arrays_zip(F.split(line, whole, -1).alias("b"), found.alias("f")),
                        lambda x: F.struct(_blanks(x["b"]).alias("b"), _blanks(x["f"]).alias("f")))
    nowhere = F.array().cast("array<struct<s:int,e:int>>")
    step = lambda a, x: F.struct(
        (a["at"] + x["b"] + F.coalesce(x["f"], F.lit(0))).alias("at"),
        F.when(x["f"].isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(F.struct(
            (a["at"] + x["b"]).alias("s"), (a["at"] + x["b"] + x["f"] + 1).alias("e"))))).alias("out"))
    return F.aggregate(sizes, F.struct(F.lit(-1).alias("at"), nowhere.alias("out")), step)["out"]


_HIT = "array<struct<s:int,e:int,label:string,p:int,w:double,base:boolean>>"


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score`` and ``detections`` (those left)."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    line = F.concat(F.lit(" "), F.regexp_replace(low, _GAP, " "), F.lit(" "))
    line = F.regexp_replace(line, "^ +| +$", " ")
    gated: dict[str, list[dict]] = {}
    for k, *rule in rules():
        gated.setdefault(k, []).append(dict(zip(("r", "label", "p", "w", "base"), rule)))
    table_ = F.from_json(F.lit(json.dumps([{"k": k, "rules": r} for k, r in gated.items()])),
                         "array<struct<k:string,rules:array<struct<r:string,label:string,p:int,w:double,base:boolean>>>>")
    work = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("rec"), line.alias("line"))
    has = lambda k: F.contains(F.col("line"), F.concat(F.lit(" "), k))
    keyword = reduce(or_, [has(F.lit(k)) for k in sorted(gated)])

    def hits_of(r: Column) -> Column:
        return F.transform(_spans(F.col("line"), r["r"]), lambda x: F.struct(
            x["s"], x["e"], r["label"].alias("label"), r["p"].alias("p"), r["w"].alias("w"), r["base"].alias("base")))

    run = F.flatten(F.transform(F.filter(table_, lambda g: has(g["k"])), lambda g: g["rules"]))
    found = F.flatten(F.transform(run, hits_of)).cast(_HIT)
    work = work.select("rec", F.greatest(_blanks(F.col("line")) - 1, F.lit(0)).cast("bigint").alias("n_words"),
                       F.when(keyword, found).otherwise(F.array().cast(_HIT)).alias("hits"))
    hits = F.col("hits")
    inside = lambda x: F.exists(hits, lambda y: (y["s"] <= x["s"]) & (y["e"] >= x["e"]) & (
        (y["e"] - y["s"] > x["e"] - x["s"]) | (y["p"] > x["p"])))
    base = F.filter(hits, lambda x: x["base"])
    work = work.select("rec", "n_words", base.alias("base"), F.filter(hits, lambda x: ~inside(x)).alias("left"))
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: x["label"]))), ",")
    both = F.concat("base", "left")
    return work.select(*unpack(docs.columns, {
        "n_words": F.col("n_words"), "n_base": F.size("base").cast("bigint"),
        "first_word": F.array_min(F.transform("base", lambda x: x["s"])).cast("bigint"),
        "last_word": F.array_max(F.transform("base", lambda x: x["s"])).cast("bigint"),
        "base_labels": names(F.col("base")), "labels": names(both),
        "score": F.coalesce(F.array_max(F.transform(both, lambda x: x["w"])), F.lit(0.0)),
        "detections": F.col("left")}))


def op9_signature_rules(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "detections")
