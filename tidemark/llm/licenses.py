"""Licence scan (operator 10): sentence identifiers, then ordered rules.

Texts are normalised (lower case, letters and digits only; a line break is a
blank, so wrapped lines are joined; a full stop before a blank, and an empty
line, end a sentence). Known sentences, also inside longer ones, become
identifiers, and the identifier sequence of a text is matched against ordered
rules. SPDX tags count by themselves, after the sentences. DataFrame functions
only. A null text is an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_UNDER = ("(?<! not)(?<! never) (?:dual |re)?(?:licen[cs]ed|released|distributed|provided|published|available|covered|governed|(?:re)?distribute|modify)"
          "(?: it)?(?: to you)? (?:under|by)(?: the)?(?: terms (?:and conditions )?of(?: the)?| conditions of the)? ")
_LAW = "(?:licen[cs]e|licence)"
_LATER = " (?:of the licen[cs]e )?(?:or at your option any later version|or any later version|or later)"
_FSF = "(?: as published by the free software foundation)?(?: either)?"
_FAMILIES = (("agpl", "(?:gnu )?affero general public licen[cs]e|(?:gnu )?agpl", (("3", "3(?: 0)?"), ("1", "1(?: 0)?"))),
             ("lgpl", "(?:gnu )?(?:lesser|library) general public licen[cs]e|(?:gnu )?lgpl",
              (("2.1", "2 1"), ("3", "3(?: 0)?"), ("2", "2(?: 0)?"))),
             ("gpl", "(?:gnu )?general public licen[cs]e|(?:gnu )?gpl", (("3", "3(?: 0)?"), ("2", "2(?: 0)?"), ("1", "1(?: 0)?"))))
_CC = (("by-nc-sa", "by nc sa|attribution non ?commercial share ?alike"), ("by-nc-nd", "by nc nd|attribution non ?commercial no ?deriv(?:ative)?s?"),
       ("by-nc", "by nc|attribution non ?commercial"), ("by-sa", "by sa|attribution share ?alike"),
       ("by-nd", "by nd|attribution no ?deriv(?:ative)?s?"), ("by", "by|attribution"))

#: Identifier and pattern of a normalised licence sentence; earlier ones win.
SENTENCES = [
    ("mit-ref", _UNDER + "(?:mit|expat|x11) " + _LAW),
    ("mit-grant", " permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("as-is", " the software is provided as is (?:and |)without warranty of any kind"),
    ("isc-grant", " permission to use copy modify and (?:or )?distribute this software(?: and its documentation)? for any purpose "
                  "with or without fee is hereby granted"),
    ("isc-as-is", " the software is provided as is and [a-z0-9 ]+? disclaims? all warranties"),
    ("isc-ref", _UNDER + "isc " + _LAW),
    ("bsd-grant", " redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-advert", " all advertising materials mentioning features or use of this software must display"),
    ("bsd-endorse", " may (?:not )?be used to endorse or promote products derived from this software without"),
    ("bsd3-ref", _UNDER + "(?:(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: " + _LAW + ")?)"),
    ("bsd2-ref", _UNDER + "(?:(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: " + _LAW + ")?)"),
    ("apache2-ref", _UNDER + "apache (?:software )?(?:" + _LAW + " )?(?:version |v )?(?:v)?2(?: 0)?(?: " + _LAW + ")?"),
    ("mpl2-ref", "(?: subject to the terms of the|" + _UNDER + ")\\s?(?:mozilla public " + _LAW + "|mpl)(?: version| v)? ?2(?: 0)?"),
    ("mpl1.1-ref", "(?: subject to the|" + _UNDER + ")\\s?(?:mozilla public " + _LAW + "|mpl)(?: version| v)? ?1 1"),
    ("cc0-ref", "(?:" + _UNDER + ")(?:a )?(?:creative commons )?cc ?0(?: 1 0)?(?: universal)?"),
]
#: Licence and the pattern of the identifiers that must follow one another.
RULES = [("MIT", ",mit-ref,"), ("MIT", ",mit-grant,(.*,)?as-is,"), ("ISC", ",isc-ref,"),
         ("ISC", ",isc-grant,(.*,)?isc-as-is,"), ("BSD-4-Clause", ",bsd-grant,(.*,)?bsd-advert,"),
         ("BSD-3-Clause", ",bsd3-ref,"), ("BSD-3-Clause", "^(?!.*,bsd-advert,).*,bsd-grant,(.*,)?bsd-endorse,"),
         ("BSD-2-Clause", ",bsd2-ref,"), ("BSD-2-Clause", "^(?!.*,bsd-(advert|endorse),).*,bsd-grant,"),
         ("Apache-2.0", ",apache2-ref,"), ("MPL-2.0", ",mpl2-ref,"), ("MPL-1.1", ",mpl1.1-ref,"), ("CC0-1.0", ",cc0-ref,")]
for _f, _name, _versions in _FAMILIES:
    for _v, _p in _versions:
        for _l, _more in (("-or-later", _LATER), ("", "")):
            SENTENCES.append((f"{_f}{_v}{_l}-ref", f"{_UNDER}(?:{_name}){_FSF}(?: version| v)? ?{_p}{_more}"))
            _d = _v if "." in _v else f"{_v}.0"
            RULES.append((f"{_f.upper()}-{_d}{_l}", f",{_f}{_v}{_l}-ref,"))
for _c, _p in _CC:
    for _v, _q in (("4", "4 0"), ("3", "3 0"), ("2.5", "2 5"), ("2", "2 0")):
        SENTENCES.append((f"cc{_c.replace('-', '')}{_v}-ref",
                          f"{_UNDER}(?:a )?(?:cc|creative commons) (?:{_p})(?: (?:international|unported|{_LAW}))*"
                          f"(?: version)? {_q}"))
        RULES.append((f"CC-{_c.upper()}-{_v if '.' in _v else _v + '.0'}", f",cc{_c.replace('-', '')}{_v}-ref,"))
#: A text without one of these words holds no known sentence: each verb of ``_UNDER`` and a word of each other sentence.
HINT = r"(?i)licen[cs]|permission|distribut|released|provided|published|available|covered|governed|modify|endorse|subject|advertising"
TAG = r"(?i)SPDX-License-Identifier:[ \t]*([^\n]*)"


def sentence_sequence(text):
    """Array of the identifiers of known sentences, in order."""
    x = F.regexp_replace(F.lower(text), r"(?<!\bv)[.!?]+(?=\s|$)|\n[^a-z0-9\n]*\n", " § ")
    # a comment mark or blank of a wrapped line goes with all other marks
    x = F.concat(F.lit(" "), F.regexp_replace(x, "[^a-z0-9§]+", " "), F.lit(" "))
    for name, pattern in SENTENCES:
        x = F.regexp_replace(x, f"{pattern}(?= )", f" §<{name}>§")
    return F.regexp_extract_all(x, F.lit("§<([^>]*)>"), F.lit(1))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids (comma-joined, in order, tags last), licenses (sorted, comma-joined)."""
    text = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<string>")
    ids = F.when(text.rlike(HINT), sentence_sequence(text)).otherwise(none)
    words = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(TAG), F.lit(1)), lambda t: F.split(
        F.regexp_replace(t, r"(?i)\bWITH\s+[\w.+-]+", " "), r"[^A-Za-z0-9.+-]+")))
    tags = F.when(text.rlike(TAG), F.filter(words, lambda w: w.rlike("^[A-Za-z0-9]")
                                            & ~F.upper(w).isin("AND", "OR", "WITH"))).otherwise(none)
    seq = F.concat(F.lit(","), F.array_join("ids", ","), F.lit(","))
    hits = F.array(*[F.when(seq.rlike(rule), F.lit(name)) for name, rule in RULES])
    found = F.when(F.size("ids") > 0, F.array_compact(hits)).otherwise(none)
    return docs.select("doc_id", ids.alias("ids"), tags.alias("tags")).select(
        "doc_id", F.array_join(F.concat("ids", F.transform("tags", lambda t: F.concat(F.lit("spdx:"), t))), ",")
        .alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(found, "tags"))), ",").alias("licenses"))
