"""Licence scan by sentence rules, with Catalyst expressions only.

A text is cut into sentences; each is normalised (lower case, runs of anything
but letters and digits become one space) and looked up among known licence
sentences. The identifiers in order of appearance form the text's sequence,
against which the licence rules are matched in their order: a rule whose
identifiers occur as a run of the sequence yields its licence and uses them up.
Identifiers that no rule uses yield nothing but stay in the sequence, and so do sentences
that speak of licensing but aren't known: no run reaches across one. These are counted.
"All rights reserved", which stands in permissive notices too, counts only where no
rule matched.

Null and empty texts have no sentences, so no licences.

References ("This project is licensed under the MIT License", "SPDX-License-Identifier:
MIT") are known by the name behind their lead, whatever the lead. A reference may be an
expression: names joined by "or" and "and", each with an exception; all of its names count, and if
one isn't known the sentence isn't.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import keep_columns

#: Known licence sentences (normalised) by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "apache2_ref": ("licensed under the apache license version 2 0",
                    "licensed under the apache license version 2 0 the license",
                    "the asf licenses this file to you under the apache license version 2 0 the license"),
    # Where the lines break elsewhere, the reference and the next sentence are one.
    "apache2_terms": ("licensed under the apache license version 2 0 the license you may not use this file except in "
                      "compliance with the license",
                      "the asf licenses this file to you under the apache license version 2 0 the license you may not use "
                      "this file except in compliance with the license"),
    "apache2_comply": ("you may not use this file except in compliance with the license",),
    # In the standard header the address stands behind a blank line.
    "apache2_copy": ("you may obtain a copy of the license at",
                     "you may obtain a copy of the license at https www apache org licenses license 2 0",
                     "you may obtain a copy of the license at http www apache org licenses license 2 0",),
    "apache2_asis": ("unless required by applicable law or agreed to in writing software distributed under the license is "
                     "distributed on an as is basis without warranties or conditions of any kind either express or implied",),
    "apache2_see": ("see the license for the specific language governing permissions and limitations under the license",),
    "mit_ref": ("released under the mit license", "licensed under the mit license", "mit license", "the mit license"),
    "mit_grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                  "documentation files the software to deal in the software without restriction including without limitation "
                  "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
                  "permit persons to whom the software is furnished to do so subject to the following conditions",),
    "mit_notice": ("the above copyright notice and this permission notice shall be included in all copies or substantial "
                   "portions of the software",),
    "mit_asis": ("the software is provided as is without warranty of any kind express or implied including but not limited to "
                 "the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "bsd_grant": ("redistribution and use in source and binary forms with or without modification are permitted provided that "
                  "the following conditions are met",),
    "bsd_source": ("redistributions of source code must retain the above copyright notice this list of conditions and the "
                   "following disclaimer",),
    "bsd_binary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
                   "following disclaimer in the documentation and or other materials provided with the distribution",),
    "bsd_name": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                 "products derived from this software without specific prior written permission",),
    "isc_grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                  "granted provided that the above copyright notice and this permission notice appear in all copies",),
    "0bsd_grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is "
                   "hereby granted",),
    "boost_grant": ("permission is hereby granted free of charge to any person or organization obtaining a copy of the "
                    "software and accompanying documentation covered by this license the software to use reproduce display "
                    "distribute execute and transmit the software and to prepare derivative works of the software and to "
                    "permit third parties to whom the software is furnished to do so all subject to the following",),
    "unlicense_free": ("this is free and unencumbered software released into the public domain",),
    "epl2_ref": ("this program and the accompanying materials are made available under the terms of the eclipse public "
                 "license 2 0 which is available at https www eclipse org legal epl 2 0",
                 "this program and the accompanying materials are made available under the terms of the eclipse public "
                 "license 2 0 which accompanies this distribution and is available at https www eclipse org legal epl 2 0"),
    "epl1_ref": ("this program and the accompanying materials are made available under the terms of the eclipse public "
                 "license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",),
    "lgpl21_free": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
                    "general public license as published by the free software foundation either version 2 1 of the license "
                    "or at your option any later version",),
    "lgpl3_free": tuple(f"this {what} is free software you can redistribute it and or modify it under the terms of the gnu "
                        "lesser general public license as published by the free software foundation either version 3 of the "
                        "license or at your option any later version" for what in ("library", "program")),
    "lgpl_warranty": ("this library is distributed in the hope that it will be useful but without any warranty without even "
                      "the implied warranty of merchantability or fitness for a particular purpose",),
    "lgpl_see": ("see the gnu lesser general public license for more details",),
    "agpl3_free": ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
                   "general public license as published by the free software foundation either version 3 of the license or "
                   "at your option any later version",),
    "agpl_see": ("see the gnu affero general public license for more details",),
    "gpl3_ref": ("this work is licensed under the gnu general public license version 3",),
    "gpl_free": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                 "public license as published by the free software foundation either version 3 of the license or at your "
                 "option any later version",),
    "gpl2_free": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                  "public license as published by the free software foundation either version 2 of the license or at your "
                  "option any later version",),
    "gpl_warranty": ("this program is distributed in the hope that it will be useful but without any warranty without even the "
                     "implied warranty of merchantability or fitness for a particular purpose",),
    "gpl_see": ("see the gnu general public license for more details",),
    "mpl2_ref": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "ccbync4_ref": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"),
    "ccby4_ref": ("licensed under cc by 4 0", "this work is licensed under cc by 4 0",
                  "this work is licensed under a creative commons attribution 4 0 international license"),
    "ccbysa4_ref": ("licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0"),
    "cc0_ref": ("this work is dedicated to the public domain", "licensed under cc0 1 0"),
    "reserved": ("all rights reserved",),
}

#: Names of licences behind a reference's lead, by identifier.
NAMES: dict[str, tuple[str, ...]] = {
    "apache2_ref": ("apache 2 0", "apache2", "apache license 2 0", "apache license version 2 0", "apache license v2 0",
                    "apache license version 2 0 the license", "apache 2 0 license"),
    "mit_ref": ("mit", "mit license", "mit licence"),
    "bsd3_ref": ("bsd 3 clause", "bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"),
    "bsd2_ref": ("bsd 2 clause", "bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "isc_ref": ("isc", "isc license"),
    "0bsd_ref": ("0bsd", "zero clause bsd license", "bsd zero clause license"),
    "boost_ref": ("bsl 1 0", "boost software license", "boost software license 1 0", "boost software license version 1 0"),
    "unlicense_ref": ("unlicense",),
    "gpl3_ref": ("gpl 3 0", "gpl 3 0 only", "gplv3", "gpl v3", "gnu gpl v3", "gnu gplv3", "gnu general public license v3 0",
                 "gnu general public license version 3", "gnu general public license v3"),
    "gpl3_later_ref": ("gpl 3 0 or later", "gplv3 or later", "gnu general public license v3 0 or later",
                       "gnu general public license version 3 or later"),
    "gpl2_ref": ("gpl 2 0", "gpl 2 0 only", "gplv2", "gpl v2", "gnu gpl v2", "gnu gplv2", "gnu general public license v2 0",
                 "gnu general public license version 2", "gnu general public license v2"),
    "gpl2_later_ref": ("gpl 2 0 or later", "gplv2 or later", "gnu general public license v2 0 or later",
                       "gnu general public license version 2 or later"),
    "lgpl3_ref": ("lgpl 3 0", "lgpl 3 0 only", "lgplv3", "lgpl v3", "gnu lgpl v3", "gnu lesser general public license v3 0",
                  "gnu lesser general public license version 3", "gnu lesser general public license v3"),
    "lgpl3_later_ref": ("lgpl 3 0 or later", "lgplv3 or later", "gnu lesser general public license version 3 or later"),
    "lgpl21_ref": ("lgpl 2 1", "lgpl 2 1 only", "lgplv2 1", "lgpl v2 1", "gnu lesser general public license v2 1",
                   "gnu lesser general public license version 2 1"),
    "lgpl21_later_ref": ("lgpl 2 1 or later", "lgplv2 1 or later", "gnu lesser general public license version 2 1 or later"),
    "agpl3_ref": ("agpl 3 0", "agpl 3 0 only", "agplv3", "agpl v3", "gnu agpl v3", "gnu agplv3",
                  "gnu affero general public license v3 0", "gnu affero general public license version 3",
                  "gnu affero general public license v3"),
    "agpl3_later_ref": ("agpl 3 0 or later", "agplv3 or later", "gnu affero general public license version 3 or later"),
    "mpl2_ref": ("mpl 2 0", "mozilla public license 2 0", "mozilla public license v 2 0", "mozilla public license version 2 0"),
    "epl2_ref": ("epl 2 0", "eclipse public license 2 0", "eclipse public license v 2 0", "eclipse public license v2 0",
                 "eclipse public license version 2 0"),
    "epl1_ref": ("epl 1 0", "eclipse public license 1 0", "eclipse public license v1 0", "eclipse public license version 1 0"),
    "busl_ref": ("busl 1 1", "business source license 1 1", "business source license", "business source license version 1 1"),
    "ccbync4_ref": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "ccbysa4_ref": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "ccby4_ref": ("cc by 4 0", "creative commons attribution 4 0 international license"),
    "cc0_ref": ("cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal"),
}
#: What stands in front of a name and behind it in a normalised reference.
LEAD = (r"^(?:(?:this|the|our) (?:[a-z0-9]+ )?(?:project|software|code|work|repository|repo|package|library|program|module|file|"
        r"files|tool|plugin|document|documentation|content|text|site|website|dataset|data|app|application|framework) (?:is|are) )?"
        r"(?:dual(?:ly)? )?(?:(?:licen[sc]ed|released|distributed|published|provided|available|made available) under |covered by |"
        r"spdx license identifier |licen[sc]e )(?:the terms of )?(?:the )?")
TAIL = r" (?:please )?see (?:the )?(?:accompanying )?(?:file )?(?:licen[sc]e|copying)(?: [a-z0-9]+){0,8}$"
for _name, _forms in NAMES.items():
    SENTENCES[_name] = SENTENCES.get(_name, ()) + tuple(f"licensed under {x}" for x in _forms)

#: Fixed: the titles that licence texts begin with, normalised.
TITLES: dict[str, tuple[str, ...]] = {
    "apache2_title": ("apache license version 2 0 january 2004", "apache license version 2 0 january 2004 http www apache org licenses",
                      "apache license version 2 0 january 2004 https www apache org licenses"),
    "mit_title": ("mit license", "the mit license", "the mit license mit", "mit license mit"),
    "bsd3_title": ("bsd 3 clause license", "the 3 clause bsd license", "bsd 3 clause new or revised license"),
    "bsd2_title": ("bsd 2 clause license", "the 2 clause bsd license", "bsd 2 clause simplified license"),
    "isc_title": ("isc license", "the isc license"),
    "boost_title": ("boost software license version 1 0 august 17th 2003",),
    "gpl3_title": ("gnu general public license version 3 29 june 2007",),
    "gpl2_title": ("gnu general public license version 2 june 1991",),
    "lgpl3_title": ("gnu lesser general public license version 3 29 june 2007",),
    "lgpl21_title": ("gnu lesser general public license version 2 1 february 1999",),
    "agpl3_title": ("gnu affero general public license version 3 19 november 2007",),
    "mpl2_title": ("mozilla public license version 2 0",),
    "epl2_title": ("eclipse public license v 2 0",),
    "cc0_title": ("creative commons legal code cc0 1 0 universal", "cc0 1 0 universal"),
}
SENTENCES |= TITLES

#: Rules in order: licence, class, the run of identifiers that proves it.
RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("Apache-2.0", "permissive", ("apache2_ref", "apache2_comply", "apache2_copy", "apache2_asis", "apache2_see")),
    ("Apache-2.0", "permissive", ("apache2_terms", "apache2_copy", "apache2_asis", "apache2_see")),
    ("Apache-2.0", "permissive", ("apache2_ref",)),
    ("Apache-2.0", "permissive", ("apache2_terms",)),
    ("MIT", "permissive", ("mit_grant", "mit_notice", "mit_asis")),
    ("MIT", "permissive", ("mit_ref",)),
    ("BSD-3-Clause", "permissive", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_name")),
    ("BSD-2-Clause", "permissive", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("BSD-3-Clause", "permissive", ("bsd3_ref",)),
    ("BSD-2-Clause", "permissive", ("bsd2_ref",)),
    ("ISC", "permissive", ("isc_grant",)),
    ("ISC", "permissive", ("isc_ref",)),
    ("0BSD", "permissive", ("0bsd_grant",)),
    ("0BSD", "permissive", ("0bsd_ref",)),
    ("BSL-1.0", "permissive", ("boost_grant",)),
    ("BSL-1.0", "permissive", ("boost_ref",)),
    ("Unlicense", "permissive", ("unlicense_free",)),
    ("Unlicense", "permissive", ("unlicense_ref",)),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl21_free", "lgpl_warranty", "lgpl_see")),
    ("LGPL-3.0-or-later", "copyleft", ("lgpl3_free", "lgpl_warranty", "lgpl_see")),
    ("LGPL-3.0-or-later", "copyleft", ("lgpl3_free", "gpl_warranty", "lgpl_see")),
    ("AGPL-3.0-or-later", "copyleft", ("agpl3_free", "gpl_warranty", "agpl_see")),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl21_free",)),
    ("LGPL-3.0-or-later", "copyleft", ("lgpl3_free",)),
    ("AGPL-3.0-or-later", "copyleft", ("agpl3_free",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl_free", "gpl_warranty", "gpl_see")),
    ("GPL-2.0-or-later", "copyleft", ("gpl2_free", "gpl_warranty", "gpl_see")),
    ("GPL-3.0-or-later", "copyleft", ("gpl_free",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl2_free",)),
    ("GPL-3.0", "copyleft", ("gpl3_ref",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl3_later_ref",)),
    ("GPL-2.0", "copyleft", ("gpl2_ref",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl2_later_ref",)),
    ("LGPL-3.0", "copyleft", ("lgpl3_ref",)),
    ("LGPL-3.0-or-later", "copyleft", ("lgpl3_later_ref",)),
    ("LGPL-2.1", "copyleft", ("lgpl21_ref",)),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl21_later_ref",)),
    ("AGPL-3.0", "copyleft", ("agpl3_ref",)),
    ("AGPL-3.0-or-later", "copyleft", ("agpl3_later_ref",)),
    ("MPL-2.0", "copyleft", ("mpl2_ref",)),
    ("EPL-2.0", "copyleft", ("epl2_ref",)),
    ("EPL-1.0", "copyleft", ("epl1_ref",)),
    ("BUSL-1.1", "restricted", ("busl_ref",)),
    ("CC-BY-NC-4.0", "restricted", ("ccbync4_ref",)),
    ("CC-BY-SA-4.0", "copyleft", ("ccbysa4_ref",)),
    ("CC-BY-4.0", "permissive", ("ccby4_ref",)),
    ("CC0-1.0", "permissive", ("cc0_ref",)),
    ("Apache-2.0", "permissive", ("apache2_title",)),
    ("MIT", "permissive", ("mit_title",)),
    ("BSD-3-Clause", "permissive", ("bsd3_title",)),
    ("BSD-2-Clause", "permissive", ("bsd2_title",)),
    ("ISC", "permissive", ("isc_title",)),
    ("BSL-1.0", "permissive", ("boost_title",)),
    ("GPL-3.0", "copyleft", ("gpl3_title",)),
    ("GPL-2.0", "copyleft", ("gpl2_title",)),
    ("LGPL-3.0", "copyleft", ("lgpl3_title",)),
    ("LGPL-2.1", "copyleft", ("lgpl21_title",)),
    ("AGPL-3.0", "copyleft", ("agpl3_title",)),
    ("MPL-2.0", "copyleft", ("mpl2_title",)),
    ("EPL-2.0", "copyleft", ("epl2_title",)),
    ("CC0-1.0", "permissive", ("cc0_title",)),
)
# Said beside most licences, so it counts only where no rule matched.
RESERVED = ("All-rights-reserved", "restricted", "reserved")

#: Every known sentence has one of these words, so texts without them need no cutting.
KEYWORDS = r"(?i)licen[sc]e|copyright|permission|warrant|redistribut|public domain|rights reserved"
# Sentences end behind these marks before white space (but not "v." before a number), behind colons at the end of a line
# and at blank lines; an unknown sentence is tried line by line. Comment marks in front of lines don't count.
SENTENCE_END = r"(?<=[.!?])(?!(?<=\b[vV]\.)\s+[0-9])\s+|(?<=[:;])[\x20\t]*\n\s*|\n[\x20\t]*\n"
COMMENT = r"(?m)^[\x20\t]*(?:#+|//+|\*+|--+|;+)[\x20\t]*"


# Between the names of one expression, and the exceptions that may follow a name.
CHOICE = r" (?:or(?! later)|and) (?:the )?"
EXCEPTION = r" with (?:the )?[a-z0-9 ]{1,60}?exception(?: [0-9]+)*(?= (?:or|and) |$)"
# The known sentences lie in so many maps, by their CRC, as a map is searched entry by entry.
LOOKUP_MAPS = 128


def _known_forms() -> dict[str, str]:
    return {form: name for name, forms in SENTENCES.items() for form in forms}


def _lookup(sentence: Column) -> Column:
    """The identifier of a normalised sentence, null if it isn't known."""
    maps: list[list[Column]] = [[] for _ in range(LOOKUP_MAPS)]
    for form, name in _known_forms().items():
        maps[zlib.crc32(form.encode()) % LOOKUP_MAPS] += [F.lit(form), F.lit(name)]
    empty = F.create_map(F.lit(""), F.lit(None).cast("string"))
    table = F.array(*[F.create_map(*x) if x else empty for x in maps])
    at = (F.crc32(sentence.cast("binary")) % LOOKUP_MAPS).cast("int")
    return F.element_at(F.get(table, at), sentence)


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order; "?" for sentences that
    speak of licensing but aren't known."""
    def named(sentence: Column) -> Column:
        # An expression's names, each known behind "licensed under"; all of them must be.
        rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(sentence, LEAD, ""), TAIL, ""), EXCEPTION, "")
        ids = F.transform(F.split(rest, CHOICE, -1), lambda x: _lookup(F.concat(F.lit("licensed under "), x)))
        return F.when(sentence.rlike(LEAD), F.element_at(F.transform(F.array(ids), lambda x: F.when(
            F.forall(x, lambda i: i.isNotNull()), F.array_join(F.array_distinct(x), ","))), 1))

    def look(sentence: Column) -> Column:
        return F.coalesce(F.element_at(F.transform(F.array(normalised(sentence)), lambda x: F.coalesce(
                              _lookup(x), named(x))), 1),
                          F.when(sentence.rlike(KEYWORDS), F.lit("?")).otherwise(F.lit("")))

    def by_line(sentence: Column) -> Column:
        whole = look(sentence)
        lines = F.filter(F.transform(F.split(sentence, "\n", -1), look), lambda x: x != "")
        return F.when(whole != "?", F.array(whole)).otherwise(lines)

    sentences = F.filter(F.split(F.regexp_replace(text, COMMENT, ""), SENTENCE_END, -1), lambda s: s.rlike(KEYWORDS))
    found = F.filter(F.flatten(F.transform(sentences, by_line)), lambda x: x != "")
    found = F.split(F.array_join(found, ","), ",", -1)  # an expression has several
    found = F.filter(found, lambda x: x != "")
    return F.when(text.rlike(KEYWORDS), found).otherwise(F.array().cast("array<string>"))


def matched_licences(ids: Column) -> Column:
    """Licences of the rules that match, in rule order; each uses up what it matched, and an
    unknown sentence ("?") ends every run. If none matches, reserved rights count."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(f",{','.join(run)},").alias("run")) for name, _, run in RULES])

    def apply(now: Column, rule: Column) -> Column:
        hit = F.instr(now["left"], rule["run"]) > 0
        # Used identifiers leave a bar, so that no run reaches across them.
        return F.when(hit, F.struct(
            F.replace(now["left"], rule["run"], F.lit(",|,")).alias("left"),
            F.array_union(now["found"], F.array(rule["name"])).alias("found"))).otherwise(now)

    start = F.struct(F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(",")).alias("left"),
                     F.array().cast("array<string>").alias("found"))
    rules = F.transform(rules, lambda r: F.struct(r["name"].alias("name"), F.replace(r["run"], F.lit(","), F.lit(",,")).alias("run")))
    rules = F.transform(rules, lambda r: F.struct(r["name"].alias("name"), F.substring(r["run"], F.lit(2), F.length(r["run"]) - 2).alias("run")))
    return F.aggregate(rules, start, apply, lambda done: F.when(
        (F.size(done["found"]) == 0) & F.array_contains(ids, RESERVED[2]), F.array(F.lit(RESERVED[0]))).otherwise(done["found"]))


def scan_licences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with licences, licence_class, sentence_ids and n_unknown per row.

    licence_class is the strictest class found (restricted, copyleft, permissive),
    or "none". Columns with these names are replaced; repeated rows are scanned alike.
    """
    added = ["licences", "licence_class", "sentence_ids", "n_unknown"]
    kept = keep_columns(docs, added)
    ids = docs.select(*kept, sentence_ids(F.coalesce(F.col(text_col), F.lit(""))).alias("__ids__"))
    some = F.filter("__ids__", lambda x: x != "?")
    found = ids.select(*kept, F.when(F.size(some) > 0, matched_licences(F.col("__ids__"))).otherwise(
        F.array().cast("array<string>")).alias("licences"), some.alias("sentence_ids"),
        F.size(F.filter("__ids__", lambda x: x == "?")).cast("long").alias("n_unknown"))
    kind = F.lit("none")
    for name in ("permissive", "copyleft", "restricted"):
        kind = F.when(F.arrays_overlap("licences", F.array(*[F.lit(n) for n, k, _ in (*RULES, RESERVED) if k == name])), name).otherwise(kind)
    return found.withColumn("licence_class", kind).select(*kept, *added)
