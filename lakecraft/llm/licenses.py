"""License scans by ordered signature rules.

Texts become words: ASCII upper case is lowered, and runs of ASCII letters,
digits and any non-ASCII characters are words. A rule is a regex over the words
from its first word on, with a label, a priority and a confidence. The rules
come from hand-written lists of license families (names and versions), of
phrases that licenses are granted in, and of wording from license texts
themselves, which tell a license that is not named: a few hundred regexes.

1. Prefilter: one regex over the text, made of the words that no rule can do
   without; other texts are only counted.
2. A rule is tried where its first word stands, if its keyword is in the next
   words.
3. Detections are ordered by start, length and priority; one that lies within an
   earlier one of that order is suppressed (same span: the better priority stays).

Everything is computed within the row by DataFrame functions: no shuffle, no
join, no Python; the rules are a literal of fixed size. Of one place the first
detection suppresses the others, so each is compared with at most ``SPAN`` before
it, and the work on a text grows with its length.

Defined cases: null and empty texts have no words and score 0; repeated rows
give equal results; very long texts are read whole; overlapping detections none of
which contains another all stay; columns named like a result are replaced.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecraft.llm.tools import documents, without

#: Words that a rule may cover.
SPAN = 20

# License families as label, names (in words) and versions (in words).
_CC = ("1 0", "2 0", "2 5", "3 0", "4 0")
FAMILIES = [
    ("gpl", ("gnu general public license", "general public license", "gnu gpl", "gpl"), ("1 0", "1", "2 0", "2", "3 0", "3")),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "lesser general public license", "gnu lgpl", "lgpl"), ("2 0", "2 1", "2", "3 0", "3")),
    ("agpl", ("gnu affero general public license", "affero general public license", "gnu agpl", "agpl"), ("1 0", "3 0", "3")),
    ("gfdl", ("gnu free documentation license", "gfdl"), ("1 1", "1 2", "1 3")),
    ("apache", ("apache license", "apache software license"), ("1 0", "1 1", "2 0", "2")),
    ("mit", ("mit license", "expat license", "mit x11 license", "x11 license"), ()),
    ("bsd", ("bsd license", "bsd style license", "berkeley software distribution license"), ()),
    ("bsd-2-clause", ("bsd 2 clause", "2 clause bsd", "simplified bsd license", "freebsd license"), ()),
    ("bsd-3-clause", ("bsd 3 clause", "3 clause bsd", "new bsd license", "modified bsd license", "revised bsd license"), ()),
    ("bsd-4-clause", ("bsd 4 clause", "4 clause bsd", "original bsd license"), ()),
    ("mpl", ("mozilla public license",), ("1 0", "1 1", "2 0")),
    ("epl", ("eclipse public license",), ("1 0", "2 0")),
    ("cddl", ("common development and distribution license", "cddl"), ("1 0", "1 1")),
    ("cpl", ("common public license",), ("1 0",)),
    ("isc", ("isc license",), ()),
    ("zlib", ("zlib license", "zlib libpng license"), ()),
    ("bsl", ("boost software license",), ("1 0",)),
    ("artistic", ("artistic license",), ("1 0", "2 0")),
    ("unlicense", ("the unlicense", "unlicense org"), ()),
    ("wtfpl", ("wtfpl", "do what the fuck you want to public license"), ("2",)),
    ("ofl", ("sil open font license", "open font license"), ("1 0", "1 1")),
    ("openssl", ("openssl license",), ()),
    ("php", ("php license",), ("3 0", "3 01")),
    ("psf", ("python software foundation license", "psf license"), ("2",)),
    ("ruby", ("ruby license",), ()),
    ("eupl", ("european union public license", "european union public licence"), ("1 1", "1 2")),
    ("osl", ("open software license",), ("1 0", "2 0", "2 1", "3 0")),
    ("afl", ("academic free license",), ("2 1", "3 0")),
    ("ms-pl", ("microsoft public license",), ()),
    ("ms-rl", ("microsoft reciprocal license",), ()),
    ("ncsa", ("university of illinois ncsa open source license", "ncsa open source license"), ()),
    ("postgresql", ("postgresql license",), ()),
    ("w3c", ("w3c software license", "w3c software notice and license"), ()),
    ("zpl", ("zope public license",), ("2 0", "2 1")),
    ("sspl", ("server side public license",), ("1",)),
    ("busl", ("business source license",), ("1 1",)),
    ("elastic", ("elastic license",), ("2 0",)),
    ("odbl", ("open database license", "odc open database license"), ("1 0",)),
    ("pddl", ("public domain dedication and license",), ("1 0",)),
    ("odc-by", ("open data commons attribution license",), ("1 0",)),
    ("cc0", ("cc0", "creative commons zero"), ("1 0",)),
    ("cc-by", ("cc by", "creative commons attribution"), _CC),
    ("cc-by-sa", ("cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"), _CC),
    ("cc-by-nc", ("cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"), _CC),
    ("cc-by-nd", ("cc by nd", "creative commons attribution noderivatives", "creative commons attribution noderivs"), _CC),
    ("cc-by-nc-sa", ("cc by nc sa", "creative commons attribution noncommercial sharealike"), _CC),
    ("cc-by-nc-nd", ("cc by nc nd", "creative commons attribution noncommercial noderivatives", "creative commons attribution noncommercial noderivs"), _CC),
    ("public-domain", ("public domain",), ()),
    ("all-rights-reserved", ("all rights reserved",), ()),
]
# The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Wording of license texts as label, keyword and pattern (in words; of SPAN words at most). The keyword is
# part of the wording; a text without any keyword or name is not searched.
BODIES = [
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "permission notice shall", "above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions"),
    ("bsl-1.0", "hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying"),
    ("isc", "without fee", "permission to use copy modify (?:and |or |and or )distribute this software for any purpose with or without fee is hereby granted"),
    ("postgresql", "without fee", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without"),
    ("bsd", "binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "following acknowledgement", "advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache-2.0", "agreed to in writing", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on"),
    ("apache-2.0", "irrevocable copyright", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("zlib", "plainly marked", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "be misrepresented", "origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("gpl", "can redistribute", "free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "can redistribute", "free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "can redistribute", "free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gfdl", "this document under", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", "source code form", "source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "and unencumbered", "free and unencumbered software released into the public domain"),
    ("wtfpl", "just do what", "just do what the fuck you want to"),
    ("ncsa", "deal with the software", "deal with the software without restriction"),
    ("ofl", "the font software", "neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("openssl", "openssl project", "product includes software developed by the openssl project"),
    ("psf", "grants licensee", "psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce"),
    ("cc0", "irrevocably and unconditionally", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc", "licensed rights", "exercising the licensed rights (?:defined below )?you accept and agree to be bound by"),
    ("busl", "non production use", "licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use"),
    ("elastic", "hosted or managed", "provide the software to third parties as a hosted or managed service"),
]
# Words that grant a license, and the words that may follow them.
GRANTS = ("licensed", "released", "distributed", "available", "published", "provided")
_UNDER = "under (?:the |a )?(?:terms of |conditions of )?(?:the |a )?"


def _words(text: str) -> str:
    """A name as a pattern over words that all end in a space; both spellings of license."""
    return "".join(("licen[cs]e" if w == "license" else re.escape(w)) + " " for w in text.split())


def _wording(text: str) -> str:
    """A wording as a pattern over words that all end in a space; groups may hold several words."""
    return "^" + re.sub(r"licen[cs]e(?= |$)", "licen[cs]e", text) + " "


def _version(v: str) -> str:
    """A version behind a name, said in one of the usual ways."""
    a, _, b = v.partition(" ")
    tail = f"{a} {b} " if b else f"{a} (?!0 )"
    return f"(?:(?:version |v |ver )?{tail}|v{tail})(?:or later |or any later version |international |unported |generic )?"


def _label(label: str, v: str) -> str:
    return f"{label}-{v.replace(' ', '.')}" if " " in v else f"{label}-{v}.0"


def rules() -> list[tuple]:
    """(first word, keyword, pattern, label, priority, confidence, base) in order of priority."""
    out = []
    for phrase, label in BASE.items():
        out.append((phrase.split()[0], phrase.split()[1], "^" + "".join(w + " " for w in phrase.split()), label, 9, 0.6, True))
    out += [(text.split()[0], key.split()[-1], _wording(text), label, 2, 0.95, False) for label, key, text in BODIES]
    for label, names, versions in FAMILIES:
        for name in names:
            first, key = name.split()[0], name.split()[-1][:5]
            out.append((first, key, f"^{_words(name)}", label, 5, 0.7, False))
            out += [(first, key, f"^{_words(name)}{_version(v)}", _label(label, v), 3, 0.9, False) for v in versions]
        either = "(?:" + "|".join(_words(n) for n in names) + ")"
        for grant in GRANTS:
            out.append((grant, "under", f"^{grant} {_UNDER}{either}", label, 4, 0.9, False))
        for v, grant in product(versions, GRANTS[:2]):
            out.append((grant, "under", f"^{grant} {_UNDER}{either}{_version(v)}", _label(label, v), 2, 1.0, False))
        if label not in ("public-domain", "all-rights-reserved"):
            spdx = "".join(w + " " for w in label.split("-"))
            out.append(("spdx", "identifier", f"^spdx license identifier {spdx}", label, 2, 0.95, False))
            out += [("spdx", "identifier", f"^spdx license identifier {spdx}{_version(v)}", _label(label, v), 1, 1.0, False) for v in versions]
    return sorted(set(out), key=lambda r: (r[4], r[0], r[2], r[3]))


_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def prefilter() -> str:
    """A regex that holds wherever some rule can."""
    need = set()
    for name in [n for _, names, _ in FAMILIES for n in names] + list(BASE):
        words = name.split()
        need.add("licen[cs]e" if "license" in words or "licence" in words else _GAP.join(map(re.escape, words)))
    need.add(f"spdx{_GAP}licen[cs]e")
    need |= {_GAP.join(map(re.escape, key.split())) for _, key, _ in BODIES}
    # a name that contains another needs no branch of its own
    kept = [n for n in need if not any(o != n and re.search(re.escape(o), n) for o in need)]
    return "(?i)(?:" + "|".join(sorted(kept)) + ")"


_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _literal(table: list[tuple]) -> Column:
    fields = ("word", "key", "pattern", "label", "priority", "confidence", "base")
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, r)]) for r in table])


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_words, found (base detections, in order of place), kept (the others that
    remain after suppression), n_base, first_word, last_word, base_labels, labels and score. A
    detection has start and stop (in words), label and confidence."""
    table = rules()
    first = sorted({r[0] for r in table})
    by_word = F.map_from_arrays(F.array(*map(F.lit, first)), F.array(*[_literal([r for r in table if r[0] == w]) for w in first]))
    made = ("n_words", "found", "kept", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    df = without(docs, *made).withColumn("_llm_t", F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn("n_words", F.regexp_count("_llm_t", F.lit(_WORD)).cast("long"))
    folded = F.translate("_llm_t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.when(F.col("_llm_t").rlike(prefilter()), F.regexp_extract_all(folded, F.lit(f"({_WORD})"), F.lit(1)))
    df = df.withColumn("_llm_w", F.coalesce(words, F.array().cast("array<string>"))).drop("_llm_t")
    known = F.array(*map(F.lit, first))
    at = F.filter(F.transform("_llm_w", lambda w, i: F.when(F.array_contains(known, w), i)), lambda i: i.isNotNull())
    near = lambda i: F.concat(F.array_join(F.slice("_llm_w", i + 1, SPAN), " "), F.lit(" "))
    df = df.withColumn("_llm_at", F.transform(at, lambda i: F.struct(i.alias("i"), F.element_at("_llm_w", i + 1).alias("w"), near(i).alias("c"))))

    def tried(a, r):
        span = F.size(F.split(F.call_function("regexp_extract", a["c"], r["pattern"], F.lit(0)), " ")) - 1
        return F.struct(a["i"].alias("start"), F.when(F.contains(a["c"], r["key"]), -a["i"] - span).otherwise(-a["i"]).alias("back"),
                        r["priority"].alias("priority"), r["label"].alias("label"), r["confidence"].alias("confidence"), r["base"].alias("base"))

    here = F.transform("_llm_at", lambda a: F.array_sort(F.filter(F.transform(by_word[a["w"]], lambda r: tried(a, r)), lambda d: -d["back"] > d["start"])))
    hits = F.flatten(F.transform(here, lambda ds: F.concat(F.filter(ds, lambda d: d["base"]), F.slice(F.filter(ds, lambda d: ~d["base"]), 1, 1))))
    df = df.withColumn("_llm_d", hits).drop("_llm_at", "_llm_w")
    shown = lambda d: F.struct(d["start"].cast("long").alias("start"), (-d["back"]).cast("long").alias("stop"), d["label"].alias("label"), d["confidence"].alias("confidence"))
    df = df.withColumn("found", F.transform(F.filter("_llm_d", lambda d: d["base"]), shown))
    rest = F.transform(F.filter("_llm_d", lambda d: ~d["base"]), shown)
    # at most one per start, and none is longer than SPAN: what contains a detection is among the SPAN before it
    before = lambda ds, i: F.slice(ds, F.greatest(i - SPAN + 1, F.lit(1)), F.least(i, F.lit(SPAN)))
    free = lambda ds: F.filter(ds, lambda d, i: ~F.exists(before(ds, i), lambda e: e["stop"] >= d["stop"]))
    df = df.withColumn("kept", F.transform(F.array(rest), free)[0]).drop("_llm_d")
    joined = lambda *a: F.array_join(F.array_sort(F.array_distinct(F.concat(*a))), ",")
    return (df.withColumn("n_base", F.size("found").cast("long"))
            .withColumns({"first_word": F.array_min("found.start"), "last_word": F.array_max("found.start"),
                          "base_labels": joined("found.label"), "labels": joined("found.label", "kept.label"),
                          "score": F.coalesce(F.array_max(F.concat("found.confidence", "kept.confidence")), F.lit(0.0))}))


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """Contract op10 over every whole text of ``documents``."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
