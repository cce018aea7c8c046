"""Licence recognition by sentence rules: sentences become licence-sentence identifiers, whose sequences are matched with ordered rules.

All of it happens within a document's row, in DataFrame expressions; nothing is shuffled.  A sentence is known as a whole, or by its
start ("This project is licensed under ...") and the name of a licence, or as an SPDX line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Normalised licence sentences and their identifiers.  A normalised sentence is in lower case; all but a-z, 0-9, full stops within
# words, slashes, plus and minus signs is one blank.
BASE_SENTENCES = {
    "released under the mit license": "mit-named",
    "licensed under the mit license": "mit-named",
    "this software is released under the mit license": "mit-named",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
    "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
    "fitness for a particular purpose and noninfringement": "as-is",
    "licensed under the apache license version 2.0": "apache-2-named",
    "licensed under the apache license version 2.0 the license": "apache-2-named",
    "you may not use this file except in compliance with the license": "apache-comply",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission": "bsd-names",
    "this work is licensed under the gnu general public license version 3": "gpl-3-named",
    "this work is licensed under the gnu general public license version 2": "gpl-2-named",
    "this program is free software": "gpl-free",
    "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation "
    "either version 3 of the license or at your option any later version": "gpl-3-later",
    "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation "
    "either version 2 of the license or at your option any later version": "gpl-2-later",
    "licensed under cc by-nc 4.0": "cc-by-nc-4-named",
    "licensed under cc by-sa 4.0": "cc-by-sa-4-named",
    "licensed under cc by 4.0": "cc-by-4-named",
    "this work is licensed under a creative commons attribution 4.0 international license": "cc-by-4-named",
    "all rights reserved": "reserved",
}
# Rules in order.  The identifiers of a rule must follow one another, others may stand between; what a rule has used is not
# open to later ones.
BASE_RULES = (
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-named",)),
    ("Apache-2.0", ("apache-2-named", "apache-comply")),
    ("Apache-2.0", ("apache-2-named",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-later")),
    ("GPL-3.0-only", ("gpl-3-named",)),
    ("GPL-2.0-only", ("gpl-2-named",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-named",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-named",)),
    ("CC-BY-4.0", ("cc-by-4-named",)),
    ("LicenseRef-reserved", ("reserved",)),
)
_TERMS = "you can redistribute it and/or modify it under the terms of the gnu {}general public license as published by the free software foundation"
_EITHER = "either version {} of the license or at your option any later version"
_GNU = {"": ("gpl", ("2", "3")), "lesser ": ("lgpl", ("2.1", "3")), "affero ": ("agpl", ("3",))}
# The same for more licences; headers of the GNU family have a comma or a semicolon before "either".
SENTENCES = BASE_SENTENCES | {
    "this library is free software": "gpl-free",
    "this file is free software": "gpl-free",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to "
    "the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-disclaimer",
    "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted provided that the above "
    "copyright notice and this permission notice appear in all copies": "isc-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "this source code form is subject to the terms of the mozilla public license v": "mpl-2-form",  # cut after "v."
    "this source code form is subject to the terms of the mozilla public license version 2.0": "mpl-2-named",
} | {_TERMS.format(kind): f"{name}-terms" for kind, (name, _) in _GNU.items()} | {
    _EITHER.format(v): f"later-{v}" for v in ("2", "2.1", "3")} | {
    f"{_TERMS.format(kind)} {_EITHER.format(v)}": f"{name}-{v}-later" for kind, (name, versions) in _GNU.items() if kind for v in versions}
# SPDX names, the identifier of each, and other names that follow "licensed under the".
NAMES = {
    "MIT": ("mit-named", "mit license", "mit licence", "mit"),
    "Apache-2.0": ("apache-2-named", "apache license version 2.0", "apache license 2.0", "apache 2.0 license", "apache license version 2.0 the license"),
    "BSD-3-Clause": ("bsd-3-named", "bsd 3-clause license", "3-clause bsd license", "new bsd license"),
    "BSD-2-Clause": ("bsd-2-named", "bsd 2-clause license", "2-clause bsd license", "simplified bsd license"),
    "ISC": ("isc-named", "isc license"),
    "MPL-2.0": ("mpl-2-named", "mozilla public license version 2.0", "mozilla public license 2.0"),
    "Unlicense": ("unlicense-named", "unlicense"),
    "CC0-1.0": ("cc0-named", "cc0 1.0 universal", "cc0 1.0 universal license", "cc0 1.0", "cc0"),
    "CC-BY-4.0": ("cc-by-4-named", "cc by 4.0", "creative commons attribution 4.0 international license"),
    "CC-BY-SA-4.0": ("cc-by-sa-4-named", "cc by-sa 4.0", "creative commons attribution-sharealike 4.0 international license"),
    "CC-BY-NC-4.0": ("cc-by-nc-4-named", "cc by-nc 4.0", "creative commons attribution-noncommercial 4.0 international license"),
} | {f"{short.upper()}-{v}-{kind}": (f"{short}-{v.removesuffix('.0')}-{'named' if kind == 'only' else 'later-named'}", *(
        f"{name} {x}{v.removesuffix('.0')}{tail}" for name in (f"gnu {long}general public license", f"gnu {short}", short) for x in ("version ", "v", "")
        for tail in (("", " only") if kind == "only" else (" or later", " or any later version"))))
     for short, long, versions in (("gpl", "", ("2.0", "3.0")), ("lgpl", "lesser ", ("2.1", "3.0")), ("agpl", "affero ", ("3.0",)))
     for v in versions for kind in ("only", "or-later")}
UNKNOWN = "spdx-unknown"  # identifier of an SPDX name that is not in the table
SPDX = {n.lower(): ident for n, (ident, *_) in NAMES.items()} | {
    old: NAMES[n][0] for n in NAMES if n.startswith(("GPL", "LGPL", "AGPL"))
    for old in [n.lower().removesuffix("-only") if n.endswith("-only") else n.lower().removesuffix("-or-later") + "+"]}
RULES = BASE_RULES + tuple(
    (f"{name.upper()}-{v if '.' in v else v + '.0'}-or-later", wanted) for name, versions in _GNU.values() for v in versions
    for wanted in (("gpl-free", f"{name}-{v}-later"), ("gpl-free", f"{name}-terms", f"later-{v}")) if (name, len(wanted)) != ("gpl", 2)
) + (("ISC", ("isc-grant",)), ("MPL-2.0", ("mpl-2-form",)), ("Unlicense", ("unlicense-grant",))) + tuple(
    (name, (ident,)) for name, (ident, *_) in NAMES.items() if (name, (ident,)) not in BASE_RULES) + (("LicenseRef-unknown", (UNKNOWN,)),)
LEAD = (
    "^(?:(?:this|the)(?: [a-z0-9./+-]+){1,4} (?:is|are) )?(?:hereby |also |dual )?(?:released|licensed|distributed|available|made available|published|provided)"
    " under (?:either(?: of)? |both )?(?:the )?(?:terms of (?:either(?: of)? |both )?(?:the )?)?")
TAIL = "(?: see (?:the )?(?:file )?licen[sc]e.*)$"
TAG = "spdx-license-identifier "
# Before cutting: comment and list marks at line starts go, and an SPDX line is a sentence of its own.
MARKS = r"(?m)^[ \t]*(?:(?://+[!/]?|/\*+!?|\*+/?|#+|--+|;+|%+|<!--|[-+\u2022])(?:[ \t]+|$)){1,4}"
SPDX_LINE = r"(?i)SPDX-License-Identifier:[ \t]*([^\r\n]*)"
# A licence's name may be wrapped before a capitalised word.
WRAPPED = r"(GNU|Lesser|Affero|General|Public|Free|Software|Mozilla|Apache)[ \t]*\r?\n[ \t]*(Lesser|Affero|General|Public|License|Software|Foundation)\b"
# A line that ends with one of these goes on in the next, whatever that begins with.
GOES_ON = r"(?i)\b(the|this|of|in|and|or|to|a|an|any|all|under|for|with|without|by|from|that|which)[ \t]*\r?\n[ \t]*(?=\p{Lu})"
# Names that a licence leaves to its user: what stands there is replaced by what the known sentence has.
SLOTS = (
    ("^neither the names? of .+ nor the names of (?:its|any|the|their) contributors may be used",
     "neither the name of the copyright holder nor the names of its contributors may be used"),
    ("^this software is provided by .+ as is and any express", "this software is provided by the copyright holders and contributors as is and any express"),
)
# A sentence ends with a mark before white space or the end, at an empty line, and at a line end before a capitalised word; other line ends are
# wraps.  Replacements of those by CUT, in order:
CUT = "\x01"
ENDS = (("[.;:!?]+([ \t\r\n]+|$)", CUT), ("\r?\n[ \t\r]*\n", CUT), ("\n[ \t]*(\\p{Lu}\\P{Lu})", f"{CUT}{{0}}"))
NOISE = "[^a-z0-9./+-]+"
BETWEEN = "((?:<[^>]*>)*?)"


def sentences(text: Column) -> Column:
    """Normalised sentences of a text in order, empty ones included; a null text is one empty sentence."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), MARKS, "")
    marked = F.regexp_replace(F.regexp_replace(marked, WRAPPED, "$1 $2"), GOES_ON, "$1 ")
    marked = F.regexp_replace(marked, SPDX_LINE, f"{CUT}{TAG}$1{CUT}")
    for pattern, cut in ENDS:
        marked = F.regexp_replace(marked, pattern, cut.format("$1"))
    plain = F.transform(F.split(marked, CUT), lambda s: F.regexp_replace(F.trim(F.regexp_replace(F.lower(s), NOISE, " ")), "(?: [/+-]+)+$", ""))
    for pattern, wanted in SLOTS:
        start = pattern.strip("^").split(" ", 1)[0]  # most sentences begin otherwise
        plain = F.transform(plain, lambda s: F.when(s.startswith(start), F.regexp_replace(s, pattern, wanted)).otherwise(s))
    return plain


def identifiers(text: Column, known: dict[str, str]) -> Column:
    """Identifiers of the known sentences in order; an SPDX line gives one for each licence that it names."""
    def lookup(table: dict[str, str], s: Column) -> Column:
        return F.try_element_at(F.map_from_arrays(F.array(*map(F.lit, table)), F.array(*map(F.lit, table.values()))), s)

    names = {n: ident for ident, *others in NAMES.values() for n in others} | SPDX

    def one(s: Column) -> Column:
        name = F.regexp_replace(F.regexp_replace(s, LEAD, ""), TAIL, "")
        # One name, "or later" included, or several of which each is known or not.
        several = F.transform(F.split(name, " (?:or|and|and/or) (?:under )?(?:the )?(?:terms of the )?"), lambda x: lookup(names, x))
        named = F.when(lookup(names, name).isNotNull(), F.array(lookup(names, name))).otherwise(several)
        whole = F.when(lookup(known, s).isNotNull(), F.array(lookup(known, s))).when(s.rlike(LEAD), named)
        listed = F.transform(F.split(F.substr(s, F.lit(len(TAG) + 1)), " (?:or|and) "), lambda x: F.coalesce(
            lookup(SPDX, F.regexp_replace(x, " with .*$", "")), F.lit(UNKNOWN)))
        return F.coalesce(F.when(s.startswith(TAG), listed).otherwise(whole), F.array().cast("array<string>"))

    return F.array_compact(F.flatten(F.transform(sentences(text), one)))


def rule_pattern(wanted: tuple[str, ...]) -> str:
    return BETWEEN.join(f"<{name}>" for name in wanted)


def rest(wanted: tuple[str, ...], mark: str) -> str:
    """What a match leaves: the identifiers between those that it uses."""
    return "".join(f"{mark}{i}" for i in range(1, len(wanted)))


def licences(docs: DataFrame, key: str = "doc_id", text: str = "text", known: dict[str, str] = SENTENCES, rules: tuple = RULES) -> DataFrame:
    """``key``, ``n_licence_sentences``, their identifiers in order as ``idents``, and the ``licences`` that rules found, in rule order.

    A null or empty text, and one without a known sentence, has no licences (empty texts in both columns); null keys and repeated rows
    are read like any other; a licence named twice is listed once; no documents give no rows.
    """
    named = identifiers(F.col(text), known)
    df = docs.select(F.col(key).alias("_key"), named.alias("_idents"))
    df = df.withColumn("_left", F.array_join(F.transform("_idents", lambda s: F.concat(F.lit("<"), s, F.lit(">"))), ""))
    for at, (_, wanted) in enumerate(rules):
        pattern = rule_pattern(wanted)
        df = df.withColumns({f"_n{at}": F.regexp_count("_left", F.lit(pattern)), "_left": F.regexp_replace("_left", pattern, rest(wanted, "$"))})
    found = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(f"_n{at}") > 0, licence) for at, (licence, _) in enumerate(rules)])))
    return df.select(
        F.col("_key").alias(key), F.size("_idents").cast("bigint").alias("n_licence_sentences"), F.array_join("_idents", " ").alias("idents"),
        F.array_join(found, ",").alias("licences"))


def _oracle() -> str:
    """SQL for the base sentences and rules; tests/llm/test_license.py has the others."""
    marked = "coalesce(text, '')"
    for pattern, cut in ENDS:
        marked = f"regexp_replace({marked}, '{pattern}', '{cut.format(chr(92) + '1')}', 'g')"
    table = "map([" + ", ".join(f"'{s}'" for s in BASE_SENTENCES) + "], [" + ", ".join(f"'{i}'" for i in BASE_SENTENCES.values()) + "])"
    steps, last = [], "named"
    for at, (_, wanted) in enumerate(BASE_RULES):
        kept = rest(wanted, chr(92))
        steps.append(
            f"r{at} AS (SELECT * EXCLUDE (remaining), len(regexp_extract_all(remaining, '{rule_pattern(wanted)}')) AS n{at}, "
            f"regexp_replace(remaining, '{rule_pattern(wanted)}', '{kept}', 'g') AS remaining FROM {last})")
        last = f"r{at}"
    found = ", ".join(f"CASE WHEN n{at} > 0 THEN '{licence}' END" for at, (licence, _) in enumerate(BASE_RULES))
    names = list(dict.fromkeys(licence for licence, _ in BASE_RULES))
    return f"""
WITH sentences AS (
  SELECT doc_id, list_transform(string_split({marked}, '{CUT}'), lambda s: trim(regexp_replace(lower(s), '{NOISE}', ' ', 'g'))) AS parts FROM documents),
idents AS (
  SELECT doc_id, list_filter(list_transform(parts, lambda s: {table}[s]), lambda s: s IS NOT NULL) AS idents FROM sentences),
named AS (
  SELECT doc_id, idents, coalesce(array_to_string(list_transform(idents, lambda s: '<' || s || '>'), ''), '') AS remaining FROM idents),
{", ".join(steps)}
SELECT doc_id, len(idents)::BIGINT AS n_licence_sentences, coalesce(array_to_string(idents, ' '), '') AS idents,
  coalesce(array_to_string(list_filter({names}, lambda x: list_contains([{found}], x)), ','), '') AS licences
FROM {last}"""


ORACLE = _oracle()
