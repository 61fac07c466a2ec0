"""License scan: ordered signature rules over the words of a text, DataFrame functions only.

Words are runs of letters, digits and non-ASCII characters, compared in
lower case (A-Z). A rule is a regular expression over words, with keywords
that every match of it contains, a priority and a confidence. A text goes
through the rules only if it holds some keyword, and each rule is tried only
where its own keywords stand. Matches are word intervals; one that lies inside
another of at least its priority is suppressed (of equal intervals the higher
priority, then the earlier rule stays). Base phrases are found beside the
rules and always keep their labels.

Defined results: null and empty texts have no words and no labels; every place
of a phrase counts, however often it repeats; rows are judged one by one, so
repeated rows agree; an empty table gives no rows. A result column replaces an
input column of its name; all other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NON_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
BASE_CONFIDENCE = 0.5

# Family: (label, words one of which every way of writing it holds, how its name is written,
# versions, a short name that stands alone)
FAMILIES = (
    ("mit", "mit / expat / x11", "(?:the )?(?:mit|expat|x11)", (), None),
    ("apache", "apache", "(?:the )?apache(?: software)?", ("2 0", "1 1", "1 0"), "apache"),
    ("bsd", "bsd / berkeley", "(?:the )?(?:new |modified |simplified |original )?(?:bsd|berkeley software distribution)",
     ("3 clause", "2 clause", "4 clause", "0 clause"), "bsd"),
    ("gpl", "general public / gpl", "(?:the )?(?:gnu )?(?:general public|gpl)", ("3 0", "2 0", "3", "2", "1"), "gpl"),
    ("lgpl", "lesser general / library general / lgpl", "(?:the )?(?:gnu )?(?:lesser general public|library general public|lgpl)",
     ("3 0", "2 1", "2 0", "3", "2"), "lgpl"),
    ("agpl", "affero / agpl", "(?:the )?(?:gnu )?(?:affero general public|agpl)", ("3 0", "3", "1 0"), "agpl"),
    ("gfdl", "free documentation / gfdl", "(?:the )?(?:gnu )?(?:free documentation|gfdl)", ("1 3", "1 2", "1 1"), "gfdl"),
    ("mpl", "mozilla / mpl", "(?:the )?(?:mozilla public|mpl)", ("2 0", "1 1", "1 0"), "mpl"),
    ("epl", "eclipse / epl", "(?:the )?(?:eclipse public|epl)", ("2 0", "1 0"), "epl"),
    ("cddl", "common development / cddl", "(?:the )?(?:common development and distribution|cddl)", ("1 1", "1 0"), "cddl"),
    ("cpl", "common public", "(?:the )?(?:common public)", ("1 0",), None),
    ("eupl", "european union / eupl", "(?:the )?(?:european union public|eupl)", ("1 2", "1 1"), "eupl"),
    ("artistic", "artistic", "(?:the )?artistic", ("2 0", "1 0"), None),
    ("boost", "boost software", "(?:the )?boost software", ("1 0",), None),
    ("isc", "isc", "(?:the )?isc", (), None),
    ("zlib", "zlib", "(?:the )?zlib(?: libpng)?", (), "zlib"),
    ("unlicense", "unlicense", "(?:the )?unlicense", (), "unlicense"),
    ("wtfpl", "you want to public / wtfpl", "(?:the )?(?:do what the fuck you want to public|wtfpl)", ("2",), "wtfpl"),
    ("python", "python", "(?:the )?python(?: software foundation)?", ("2 0",), None),
    ("ofl", "open font / ofl", "(?:the )?(?:sil )?(?:open font|ofl)", ("1 1", "1 0"), "ofl"),
    ("osl", "open software / osl", "(?:the )?(?:open software|osl)", ("3 0", "2 1"), None),
    ("ms-pl", "microsoft public / ms pl", "(?:the )?(?:microsoft public|ms pl)", (), None),
    ("odbl", "open database / odbl", "(?:the )?(?:open database|odbl)", ("1 0",), "odbl"),
    ("postgresql", "postgresql", "(?:the )?postgresql", (), None),
    ("cc0", "commons zero / cc0 / cc 0 / cc zero", "(?:the )?(?:creative commons zero|cc ?0|cc zero)", ("1 0",), "cc0"),
    ("cc-by-nc-nd", "creative commons / cc", "(?:the )?(?:creative commons |cc )(?:by nc nd|attribution non ?commercial no ?deriv\\w*)",
     ("4 0", "3 0", "2 5", "2 0"), "cc by nc nd"),
    ("cc-by-nc-sa", "creative commons / cc", "(?:the )?(?:creative commons |cc )(?:by nc sa|attribution non ?commercial share ?alike)",
     ("4 0", "3 0", "2 5", "2 0"), "cc by nc sa"),
    ("cc-by-nc", "creative commons / cc", "(?:the )?(?:creative commons |cc )(?:by nc|attribution non ?commercial)",
     ("4 0", "3 0", "2 5", "2 0"), "cc by nc"),
    ("cc-by-nd", "creative commons / cc", "(?:the )?(?:creative commons |cc )(?:by nd|attribution no ?deriv\\w*)",
     ("4 0", "3 0", "2 5", "2 0"), "cc by nd"),
    ("cc-by-sa", "creative commons / cc", "(?:the )?(?:creative commons |cc )(?:by sa|attribution share ?alike)",
     ("4 0", "3 0", "2 5", "2 0"), "cc by sa"),
    ("cc-by", "creative commons / cc", "(?:the )?(?:creative commons |cc )(?:by|attribution)", ("4 0", "3 0", "2 5", "2 0"),
     "cc by"),
)
# Phrases without a family: (label, words, keyword, priority, confidence)
PHRASES = (
    ("copyright", "copyright(?: c)?(?: by)? (?:19|20)[0-9][0-9]", "copyright", 2, 0.8),
    ("copyright", "(?:19|20)[0-9][0-9] copyright", "copyright", 2, 0.7),
    ("copyright", "copyright holders?", "copyright", 1, 0.4),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain",
     "public domain", 3, 0.9),
    ("public-domain", "public domain", "public domain", 1, 0.5),
    ("proprietary", "all rights reserved", "rights reserved", 1, 0.6),
    ("proprietary", "no part of this (?:work|publication|document) may be reproduced",
     "reproduced", 3, 0.9),
    ("warranty", "provided as is without warranty", "without warranty", 2, 0.6),
    ("mit", "permission is hereby granted free of charge to any person", "hereby granted", 4, 1.0),
    ("isc", "permission to use copy modify and or distribute this software", "copy modify", 4, 0.9),
    ("bsd", "redistribution and use in source and binary forms", "redistribution", 4, 0.9),
    ("license", "(?:see|read) the licen[cs]e (?:file|for)", "licen", 1, 0.4),
)
GRANTED = ("licensed", "released", "distributed", "published", "available", "provided", "offered")
GRANT = f"(?:{'|'.join(GRANTED)}) under (?:the )?(?:terms (?:of|and conditions of) )?"
LICENSE = "(?: public)?(?: licen[cs]e)?"


def signature_rules() -> list[tuple]:
    """``(order, label, words, needs, names, priority, confidence)``, in rule order.

    Every match holds all of ``needs`` and one of ``names`` (if there are any).
    Four forms of every family and version: an SPDX tag, a grant, the license by
    name, and the short name with its version.
    """
    rules = []
    for label, keys, name, versions, short in FAMILIES:
        names, tag = tuple(keys.split(" / ")), label.replace("-", " ")
        spdx = f"spdx license identifier {tag}"
        for version in versions:
            full = f"{label}-{version.replace(' clause', '-clause').replace(' ', '.')}"
            rules.append((full, f"{spdx} {version}(?: only| or later)?", ("spdx", tag, version),
                          (), 4, 1.0))
            rules.append((full, f"{GRANT}{name}{LICENSE}(?: version)? v?{version}(?: or later)?",
                          (" under ", version), names, 3, 0.95))
            rules.append((full, f"{name} licen[cs]e(?: version)? v?{version}", ("licen", version),
                          names, 3, 0.9))
            if short:
                rules.append((full, f"{short}(?: version)? ?v?{version}", (short, version), (),
                              2, 0.8))
        rules.append((label, f"{spdx}(?: only| or later)?", ("spdx", tag), (), 4, 1.0))
        rules.append((label, f"{GRANT}{name}{LICENSE}", (" under ",), names, 2, 0.85))
        rules.append((label, f"{name} licen[cs]e", ("licen",), names, 1, 0.7))
    rules += [(label, words, (key,), (), priority, confidence)
              for label, words, key, priority, confidence in PHRASES]
    return [(i, *rule) for i, rule in enumerate(rules)]


LEVELS = 4
_SPAN = "struct<start:bigint,stop:bigint,priority:int,rule:int,label:string,confidence:double>"


def _keywords() -> str:
    """Pattern on the raw text that holds wherever a rule or a base phrase can match.

    It is made of the rules: the first of each rule's needs, the verbs of the grants
    before "under", and the base phrases. Each stands at the start of a word in
    every match, which spares most places.
    """
    words = {needs[0] for _, _, _, needs, *_ in signature_rules()} - {" under "}
    words |= {f"{verb} under" for verb in GRANTED} | {phrase for phrase, _ in BASE}
    spaced = sorted(w.strip().replace(" ", NON_WORD) for w in words)
    return "(?i)(?<![0-9a-z])(?:" + "|".join(spaced) + ")"


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def normalise(text: Column) -> Column:
    """``" w0 w1 ... "``: the words in lower case, one space around each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER),
                                                        NON_WORD, " ")), F.lit(" "))


def _rule_spans(norm: Column, rule: Column) -> Column:
    """Word intervals of all matches of one rule, left to right."""
    # \G starts each piece where the last ended: what lies between, then the match.
    # (?s): words may hold U+0085, U+2028 and U+2029, which '.' alone would not cross.
    pieces = F.regexp_extract_all(norm, F.concat(
        F.lit(r"(?s)\G.*?( (?:"), rule["words"], F.lit(r")(?= ))")), 0)
    match = F.concat(F.lit(r"(?s)^.*?( (?:"), rule["words"], F.lit("))$"))
    walk = F.aggregate(
        F.transform(pieces, lambda p: F.struct(_spaces(p).alias("both"), _spaces(
            F.call_function("regexp_extract", p, match, F.lit(1))).alias("width"))),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out")),
        lambda acc, m: F.struct(
            (acc["at"] + m["both"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + m["both"] - m["width"]).alias("start"),
                (acc["at"] + m["both"]).alias("stop"),
                rule["priority"].alias("priority"), rule["rule"].alias("rule"),
                rule["label"].alias("label"), rule["confidence"].alias("confidence"))))
            .alias("out")))
    return walk["out"]


def _suppress(spans: Column) -> Column:
    """Drop intervals inside another of at least their priority (one sorted walk)."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["stop"]).alias("back"), (-s["priority"]).alias("low"),
        s["rule"].alias("rule"), s.alias("span"))))
    reach = F.array(*[F.lit(-1).cast("long")] * LEVELS)
    walk = F.aggregate(
        ordered, F.struct(reach.alias("reach"), F.array().cast(f"array<{_SPAN}>").alias("kept")),
        lambda acc, o: F.struct(
            F.transform(acc["reach"], lambda r, i: F.when(
                o["span"]["priority"] > i, F.greatest(r, o["span"]["stop"])).otherwise(r))
            .alias("reach"),
            F.when(F.element_at(acc["reach"], o["span"]["priority"]) >= o["span"]["stop"],
                   acc["kept"]).otherwise(F.concat(acc["kept"], F.array(o["span"])))
            .alias("kept")))
    return walk["kept"]


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``lic_words`` (long), ``lic_spans`` (kept detections) and ``lic_base``
    (one struct per base phrase: label, places, first and last start)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    strings = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    rules = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(label).alias("label"),
                               F.lit(words).alias("words"), strings(needs).alias("needs"),
                               strings(names).alias("names"), F.lit(priority).alias("priority"),
                               F.lit(conf).alias("confidence"))
                      for i, label, words, needs, names, priority, conf in signature_rules()])
    norm = F.col("lic_norm")
    n = F.col("lic_words")

    def base(phrase: str, label: str) -> Column:
        whole, width = f" {phrase} ", len(phrase.split())
        there = norm.contains(whole)
        return F.struct(
            F.lit(label).alias("label"),
            F.coalesce(F.regexp_count(norm, F.lit(f" {phrase}(?= )")), F.lit(0)).cast("long")
            .alias("places"),
            F.when(there, _spaces(F.substring_index(norm, whole, 1))).alias("first"),
            F.when(there, n - width - _spaces(F.substring_index(norm, whole, -1))).alias("last"))

    may = F.filter(rules, lambda r: F.forall(r["needs"], lambda k: F.contains(norm, k))
                   & ((F.size(r["names"]) == 0)
                      | F.exists(r["names"], lambda k: F.contains(norm, k))))
    found = F.flatten(F.transform(may, lambda r: _rule_spans(norm, r)))
    none = F.array().cast(f"array<{_SPAN}>")
    return (docs.withColumn("lic_words", F.regexp_count(text, F.lit(WORD)).cast("long"))
            .withColumn("lic_norm", F.when(text.rlike(_keywords()), normalise(text)))
            .withColumn("lic_spans", F.when(norm.isNotNull(), _suppress(found)).otherwise(none))
            .withColumn("lic_base", F.array(*[base(p, label) for p, label in BASE]))
            .drop("lic_norm"))


def summary(scanned: DataFrame) -> DataFrame:
    """Add ``n_base, first_word, last_word, base_labels, labels, score``."""
    spans, base = F.col("lic_spans"), F.col("lic_base")
    there = F.transform(F.filter(base, lambda b: b["places"] > 0), lambda b: b["label"])
    named = F.array_union(there, F.transform(spans, lambda s: s["label"]))
    join = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    confidence = F.array_max(F.concat(
        F.transform(spans, lambda s: s["confidence"]),
        F.transform(there, lambda _: F.lit(BASE_CONFIDENCE)), F.array(F.lit(0.0))))
    return (scanned
            .withColumn("n_base", F.aggregate(base, F.lit(0).cast("long"),
                                              lambda acc, b: acc + b["places"]))
            .withColumn("first_word", F.array_min(F.transform(base, lambda b: b["first"])))
            .withColumn("last_word", F.array_max(F.transform(base, lambda b: b["last"])))
            .withColumn("base_labels", join(there)).withColumn("labels", join(named))
            .withColumn("score", confidence))
