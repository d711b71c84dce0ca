"""License scans by sentence rules.

A text is cut into sentences, sentences that may speak of a licence are normalised and mapped to the
identifiers of known licence sentences, some of which have slots for holders, notes and links, and the sequence of identifiers is matched against ordered rules.
A rule takes the identifiers that it matches, so a later and shorter rule does not see them again.
Everything is built-in expressions on one row; nothing is shuffled.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifiers of known licence sentences, normalised (letters and digits, lower case).
SENTENCES = {
    "MitGrant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MitNotice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MitRef": "released under the mit license",
    "MitRef2": "licensed under the mit license",
    "MitRef3": "this project is licensed under the mit license",
    "AsIs": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "NoLiability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "BsdGrant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BsdSource": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BsdBinary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "BsdNames": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "Apache2Ref": "licensed under the apache license version 2 0",
    "Apache2Grant": "licensed under the apache license version 2 0 the license",
    "Apache2Use": "you may not use this file except in compliance with the license",
    "Apache2Copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "GplFree": "this program is free software",
    "Gpl2Plus": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "Gpl3Plus": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "Gpl2Ref": "this work is licensed under the gnu general public license version 2",
    "Gpl3Ref": "this work is licensed under the gnu general public license version 3",
    "MplRef": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "GplTerms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "LgplTerms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "LibraryGplTerms": "you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation",
    "AgplTerms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "Either2": "either version 2 of the license or at your option any later version",
    "Either21": "either version 2 1 of the license or at your option any later version",
    "Either3": "either version 3 of the license or at your option any later version",
    "Lgpl21Plus": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "Lgpl3Plus": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "Agpl3Plus": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "LibraryFree": "this library is free software",
    "MplNotice": "this source code form is subject to the terms of the mozilla public license v",
    "Apache2CopyAt": "you may obtain a copy of the license at",
    "Apache2Url": "http www apache org licenses license 2 0",
    "IscGrant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "IscGrant2": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "Cc0Purpose": "the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights defined below upon the creator and subsequent owner s each and all an owner of an original work of authorship and or a database each a work",
    "Cc0Ref": "licensed under cc0 1 0",
    "UnlicenseGrant": "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain",
    "Epl2Notice": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "Epl2Notice2": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at http www eclipse org legal epl 2 0",
    "Epl1Notice": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    "CcByNcRef": "licensed under cc by nc 4 0",
    "CcByRef": "licensed under cc by 4 0",
    "CcBySaRef": "licensed under cc by sa 4 0",
    "AllRights": "all rights reserved",
    "Bsd2Ref": "licensed under the bsd 2 clause license",
    "Bsd3Ref": "licensed under the bsd 3 clause license",
    "IscRef": "licensed under the isc license",
}

_ENDORSE = "may{} be used to endorse or promote products derived from this software without specific prior written permission$"
_UNDER = "^(.* )?(licensed|released|distributed|available|published) under (the )?(terms of )?(the )?{}( .*)?$"
_LICENSE = "licen[cs]e"

# Sentences with a slot, as patterns of the normalised sentence, in the order in which they are tried; one
# may stand for several identifiers.
SLOTS = [
    ("BsdNames", "^(.* )?nor the names of (its|their|the|any) contributors " + _ENDORSE.format("")),
    ("BsdNames", "^(the )?names? of .* " + _ENDORSE.format(" not")),
    ("BsdSource", "^[0-9a-z]{1,2} " + SENTENCES["BsdSource"] + "$"),
    ("BsdBinary", "^[0-9a-z]{1,2} " + SENTENCES["BsdBinary"] + "$"),
    ("MitNotice", "^the above copyright notice and this permission notice .* shall be included in all copies or substantial portions of the software$"),
]
REFERENCES = [
    ("MitRef Apache2Ref", _UNDER.format(f"(either of )?(the )?mit( {_LICENSE})? (or|and) (the )?apache( {_LICENSE})? (version |v)?2 0")),
    ("Apache2Ref MitRef", _UNDER.format(f"(either of )?(the )?apache( {_LICENSE})? (version |v)?2 0( {_LICENSE})? (or|and) (the )?mit")),
    ("MitRef", _UNDER.format(f"(mit|expat) {_LICENSE}")),
    ("Apache2Ref", _UNDER.format(f"apache( {_LICENSE})? (version |v)?2 0")),
    ("Bsd2Ref", _UNDER.format(f"(bsd 2 clause|2 clause bsd|simplified bsd) {_LICENSE}")),
    ("Bsd3Ref", _UNDER.format(f"(bsd 3 clause|3 clause bsd|new bsd|modified bsd) {_LICENSE}")),
    ("IscRef", _UNDER.format(f"isc {_LICENSE}")),
    ("MplRef", _UNDER.format(f"mozilla public {_LICENSE}( (version |v)?2 0| v)")),
]
# A reference that is denied is none.
DENIED = "(^| )(not|never|isn t|aren t) "

# Names in a line that begins with this, and what they stand for.
SPDX_LINE = "spdx license identifier "
SPDX = {
    "mit": "MitRef", "apache 2 0": "Apache2Ref", "bsd 2 clause": "Bsd2Ref", "bsd 3 clause": "Bsd3Ref", "isc": "IscRef", "mpl 2 0": "MplRef",
    "gpl 2 0": "Gpl2Ref", "gpl 2 0 only": "Gpl2Ref", "gpl 2 0 orlater": "Gpl2Plus", "gpl 3 0": "Gpl3Ref", "gpl 3 0 only": "Gpl3Ref",
    "gpl 3 0 orlater": "Gpl3Plus", "lgpl 2 1 orlater": "Lgpl21Plus", "lgpl 3 0 orlater": "Lgpl3Plus", "agpl 3 0 orlater": "Agpl3Plus",
    "cc0 1 0": "Cc0Ref", "unlicense": "UnlicenseGrant", "epl 1 0": "Epl1Notice", "epl 2 0": "Epl2Notice", "cc by 4 0": "CcByRef", "cc by sa 4 0": "CcBySaRef", "cc by nc 4 0": "CcByNcRef",
}

# Ordered rules, from a sequence of identifiers to a licence.
RULES = [
    ("BSD-3-Clause", "BsdGrant BsdSource BsdBinary BsdNames"),
    ("BSD-2-Clause", "BsdGrant BsdSource BsdBinary"),
    ("MIT", "MitGrant MitNotice AsIs NoLiability"),
    ("MIT", "MitGrant MitNotice"),
    ("Apache-2.0", "Apache2Grant Apache2Use Apache2CopyAt Apache2Url"),
    ("Apache-2.0", "Apache2Grant Apache2Use Apache2Copy"),
    ("Apache-2.0", "Apache2Grant Apache2Use"),
    ("Apache-2.0", "Apache2Grant"),
    ("Apache-2.0", "Apache2Ref"),
    ("GPL-2.0-or-later", "GplFree GplTerms Either2"),
    ("LGPL-2.1-or-later", "LibraryFree LgplTerms Either21"),
    ("GPL-2.0-or-later", "GplTerms Either2"),
    ("GPL-3.0-or-later", "GplTerms Either3"),
    ("LGPL-2.1-or-later", "LgplTerms Either21"),
    ("LGPL-3.0-or-later", "LgplTerms Either3"),
    ("LGPL-2.0-or-later", "LibraryGplTerms Either2"),
    ("AGPL-3.0-or-later", "AgplTerms Either3"),
    ("LGPL-2.1-or-later", "LibraryFree Lgpl21Plus"),
    ("LGPL-3.0-or-later", "LibraryFree Lgpl3Plus"),
    ("LGPL-3.0-or-later", "GplFree Lgpl3Plus"),
    ("AGPL-3.0-or-later", "GplFree Agpl3Plus"),
    ("GPL-2.0-or-later", "GplFree Gpl2Plus"),
    ("GPL-3.0-or-later", "GplFree Gpl3Plus"),
    ("GPL-2.0-or-later", "Gpl2Plus"),
    ("GPL-3.0-or-later", "Gpl3Plus"),
    ("GPL-2.0", "Gpl2Ref"),
    ("GPL-3.0", "Gpl3Ref"),
    ("MIT", "MitRef"),
    ("MIT", "MitRef2"),
    ("MIT", "MitRef3"),
    ("MPL-2.0", "MplRef"),
    ("LGPL-2.1-or-later", "Lgpl21Plus"),
    ("LGPL-3.0-or-later", "Lgpl3Plus"),
    ("AGPL-3.0-or-later", "Agpl3Plus"),
    ("MPL-2.0", "MplNotice"),
    ("ISC", "IscGrant"),
    ("ISC", "IscGrant2"),
    ("CC0-1.0", "Cc0Purpose"),
    ("CC0-1.0", "Cc0Ref"),
    ("Unlicense", "UnlicenseGrant"),
    ("EPL-2.0", "Epl2Notice"),
    ("EPL-2.0", "Epl2Notice2"),
    ("EPL-1.0", "Epl1Notice"),
    ("CC-BY-NC-4.0", "CcByNcRef"),
    ("CC-BY-SA-4.0", "CcBySaRef"),
    ("CC-BY-4.0", "CcByRef"),
    ("BSD-2-Clause", "Bsd2Ref"),
    ("BSD-3-Clause", "Bsd3Ref"),
    ("ISC", "IscRef"),
    ("All-Rights-Reserved", "AllRights"),
]

# Words without which a sentence is not looked at.
CRITICAL = ["licen", "copyright", "permission", "permitted", "redistribut", "warrant", "liable", "rights reserved", "free software", "promote products"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = r"[.!?:;]+[\x20\x09-\x0D]+|\n[\x20\x09\x0D]*\n"
BREAK = END + r"|\n"
UNKNOWN = "?"


def any_case(word: str) -> str:
    """A pattern for a word in any case of A-Z."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


SPEAKS = "|".join(map(any_case, CRITICAL))
SPEAKS_NORMAL = "|".join(CRITICAL)


def normalised(sentence: Column) -> Column:
    """Lower case of A-Z, and one blank for each run of other characters than letters and digits."""
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), "[^a-z0-9]+", " "))


# The name of a licence is part of its line, and a plus means that later versions will do.
_PREPARED = [("SPDX-License-Identifier[: \\t]+", "SPDX-License-Identifier ", False), ("(GPL-[0-9.]+)[+]", "{}-or-later", True)]


def prepared(text: Column) -> Column:
    for pattern, by, group in _PREPARED:
        text = F.regexp_replace(text, pattern, by.format("$1") if group else by)
    return text


def _with_slots(s: Column) -> Column:
    """The identifiers of a sentence that is not known word by word; null if it fits no slot."""
    found = F.lit(None).cast("string")
    for name, pattern in reversed(REFERENCES):
        found = F.when(s.rlike(pattern), name).otherwise(found)
    found = F.when(~s.rlike(DENIED), found)
    for name, pattern in reversed(SLOTS):
        found = F.when(s.rlike(pattern), name).otherwise(found)
    line = F.regexp_replace(s, " or later", " orlater")
    listed = F.split(F.substring(line, len(SPDX_LINE) + 1, 1 << 30), " or | and | with ")
    names = F.create_map(*(F.lit(x) for x in chain.from_iterable(SPDX.items())))
    spdx = F.array_join(F.filter(F.transform(listed, lambda n: names[n]), lambda n: n.isNotNull()), " ")
    return F.when(s.startswith(SPDX_LINE), F.when(spdx != "", spdx)).otherwise(found)


def sentence_ids(text: Column, breaks: str) -> Column:
    """The identifiers of the critical sentences in order, blank-separated; ``?`` for one that is not known."""
    known = F.create_map(*(F.lit(x) for x in chain.from_iterable((s, name) for name, s in SENTENCES.items())))
    critical = F.filter(F.transform(F.split(prepared(text), breaks), normalised), lambda s: s.rlike(SPEAKS_NORMAL))
    return F.array_join(F.transform(critical, lambda s: F.coalesce(known[s], _with_slots(s), F.lit(UNKNOWN))), " ")


def matched(sequence: Column) -> Column:
    """The sequence with all that a rule matches replaced by ``<licence>``, rule by rule in order."""
    return reduce(
        lambda s, rule: F.regexp_replace(s, rf"\b{rule[1]}\b", f"<{rule[0]}>"), RULES, sequence
    )


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, sentence_ids, licenses, n_licenses, n_unknown.

    licenses are the names found, sorted, each once, comma-separated; none gives an empty string.
    Sentences end at punctuation before white space and at blank lines. They are read once with every line break as an end
    and once with line breaks as blanks, since licence texts are often wrapped: sentence_ids and
    n_unknown (critical sentences that no rule took) are of the first reading, licenses of both. A null
    or empty text has no sentences; a very long one is read whole, as any other. Repeated rows and null identifiers
    each give their row; an empty table gives none; other columns aren't read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    speaks = text.rlike(SPEAKS)
    read = docs.select(
        F.col(id_col).alias("doc_id"),
        *(F.when(speaks, sentence_ids(text, b)).otherwise(F.lit("")).alias(name) for b, name in ((BREAK, "sentence_ids"), (END, "wrapped_ids"))),
    )
    taken = read.select("doc_id", "sentence_ids", *(matched(F.col(c)).alias(t) for c, t in (("sentence_ids", "by_line"), ("wrapped_ids", "wrapped"))))
    names = F.array_sort(
        F.array_distinct(F.regexp_extract_all(F.concat("by_line", F.lit(" "), "wrapped"), F.lit("<([^>]+)>"), F.lit(1)))
    )
    return taken.select(
        "doc_id",
        "sentence_ids",
        F.array_join(names, ",").alias("licenses"),
        F.size(names).cast("bigint").alias("n_licenses"),
        (F.length("by_line") - F.length(F.replace(F.col("by_line"), F.lit(UNKNOWN), F.lit("")))).cast("bigint").alias("n_unknown"),
    )


def _sql_slots() -> str:
    slots = " ".join(f"WHEN regexp_matches(s, '{pattern}') THEN '{name}'" for name, pattern in SLOTS)
    references = " ".join(f"WHEN regexp_matches(s, '{pattern}') THEN '{name}'" for name, pattern in REFERENCES)
    names = " ".join(f"WHEN '{n}' THEN '{name}'" for n, name in SPDX.items())
    listed = f"string_split(regexp_replace(replace(s[{len(SPDX_LINE) + 1}:], ' or later', ' orlater'), ' or | and | with ', chr(2), 'g'), chr(2))"
    spdx = f"nullif(array_to_string(list_filter(list_transform({listed}, lambda n: CASE n {names} END), lambda n: n IS NOT NULL), ' '), '')"
    return f"CASE WHEN starts_with(s, '{SPDX_LINE}') THEN {spdx} {slots} WHEN regexp_matches(s, '{DENIED}') THEN NULL {references} END"


def _sql_ids(breaks: str) -> str:
    cases = " ".join(f"WHEN '{s}' THEN '{name}'" for name, s in SENTENCES.items())
    body = "body"
    for pattern, by, group in _PREPARED:
        body = f"regexp_replace({body}, '{pattern}', '{by.format(chr(92) + '1') if group else by}', 'g')"
    clean = f"trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
    # A break is marked by a character that no sentence keeps.
    parts = f"string_split(regexp_replace({body}, '{breaks}', chr(1), 'g'), chr(1))"
    critical = f"list_filter(list_transform({parts}, lambda s: {clean}), lambda s: regexp_matches(s, '{SPEAKS_NORMAL}'))"
    return f"array_to_string(list_transform({critical}, lambda s: coalesce(CASE s {cases} END, {_sql_slots()}, '{UNKNOWN}')), ' ')"


def _sql_matched(column: str) -> str:
    return reduce(lambda s, rule: rf"regexp_replace({s}, '\b{rule[1]}\b', '<{rule[0]}>', 'g')", RULES, column)


# The same in SQL; a text with the character U+0001 might be cut there in the SQL alone.
ORACLE_SQL = f"""
WITH read AS (
  SELECT doc_id, {_sql_ids(BREAK)} AS sentence_ids, {_sql_ids(END)} AS wrapped_ids
  FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)),
taken AS (
  SELECT doc_id, sentence_ids, {_sql_matched('sentence_ids')} AS by_line, {_sql_matched('wrapped_ids')} AS wrapped FROM read),
named AS (
  SELECT *, list_sort(list_distinct(regexp_extract_all(by_line || ' ' || wrapped, '<([^>]+)>', 1))) AS names FROM taken)
SELECT doc_id, sentence_ids, array_to_string(names, ',') AS licenses, CAST(len(names) AS BIGINT) AS n_licenses,
       CAST(length(by_line) - length(replace(by_line, '{UNKNOWN}', '')) AS BIGINT) AS n_unknown
FROM named
"""
