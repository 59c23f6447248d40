"""Licence scan: known sentences become identifiers, identifier sequences meet ordered rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Names and wordings of public licences.
GNU = {"gpl": "GNU General Public License", "lgpl": "GNU Lesser General Public License", "agpl": "GNU Affero General Public License"}
GNU_VERSIONS = {"gpl": ("2", "3"), "lgpl": ("2.1", "3"), "agpl": ("3",)}
GNU_DATES = {"gpl2": "June 1991", "gpl3": "29 June 2007", "lgpl2.1": "February 1999", "lgpl3": "29 June 2007", "agpl3": "19 November 2007"}
SPDX = (
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "Unlicense", "BSL-1.0", "MPL-2.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
)
CC = {"CC-BY-4.0": "Attribution", "CC-BY-SA-4.0": "Attribution-ShareAlike", "CC-BY-NC-4.0": "Attribution-NonCommercial", "CC-BY-ND-4.0": "Attribution-NoDerivatives"}

#: Sentences of public licence texts and notices, by identifier.
SENTENCES: dict[str, str] = {
    "apache2-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "apache2-terms": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "apache2-notice": "Licensed under the Apache License, Version 2.0",
    "apache2-notice-file": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apache2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2-copy-https": "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    "apache2-copy-at": "You may obtain a copy of the License at",
    "apache2-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache2-see": "See the License for the specific language governing permissions and limitations under the License",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2",
    "mit-notice": "Released under the MIT License",
    "mit-notice-licensed": "Licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-keep-paragraph": "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-credit": "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the University of California, Berkeley and its contributors",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-names-author": "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission",
    "x11-names": "Except as contained in this notice, the name of the holder shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the holder",
    "hpnd-sell-grant": "Permission to use, copy, modify, distribute, and sell this software and its documentation for any purpose is hereby granted without fee, provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation",
    "wtfpl-title": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "wtfpl-title-version": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004",
    "wtfpl-terms": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION",
    "wtfpl-do": "You just DO WHAT THE FUCK YOU WANT TO",
    "bsd-names-university": "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "mpl2-copy-http": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "epl2-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2-notice-http": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0/",
    "epl2-title": "Eclipse Public License - v 2.0",
    "unlicense-free": "This is free and unencumbered software released into the public domain",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "bsl1-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "bsl1-notice": "Distributed under the Boost Software License, Version 1.0",
    "cc-by-4-notice": "Licensed under CC BY 4.0",
    "cc-by-sa-4-notice": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-4-notice": "Licensed under CC BY-NC 4.0",
    "cc0-notice": "Licensed under CC0 1.0",
    "all-rights-reserved": "All rights reserved",
}
SENTENCES |= {
    f"gnu-hope-{what}": f"This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"
    for what in ("program", "library")
}
GNU_RULES: list[tuple[str, tuple[str, ...]]] = []
for _key, _name in GNU.items():
    SENTENCES[f"{_key}-see"] = f"See the {_name} for more details"
    for _v in GNU_VERSIONS[_key]:
        _id = f"{_key.upper()}-{_v if '.' in _v else _v + '.0'}"
        SENTENCES[f"{_key}{_v}-title"] = f"{_name} Version {_v}, {GNU_DATES[_key + _v]}"
        for _what in ("program", "library"):
            _said = f"This {_what} is free software: you can redistribute it and/or modify it under the terms of the {_name} as published by the Free Software Foundation"
            SENTENCES[f"{_key}{_v}-later-{_what}"] = f"{_said}, either version {_v} of the License, or (at your option) any later version"
            SENTENCES[f"{_key}{_v}-only-{_what}"] = f"{_said}, version {_v} of the License"
            for _how, _end in (("later", "or-later"), ("only", "only")):
                GNU_RULES.append((f"{_id}-{_end}", (f"{_key}{_v}-{_how}-{_what}", f"gnu-hope-{_what}", f"{_key}-see")))
                GNU_RULES.append((f"{_id}-{_end}", (f"{_key}{_v}-{_how}-{_what}",)))
        GNU_RULES.append((_id, (f"{_key}{_v}-title",)))
GNU_RULES.sort(key=lambda r: -len(r[1]))
SENTENCES |= {f"spdx-{x.lower()}": f"SPDX-License-Identifier: {x}" for x in SPDX}
SENTENCES |= {f"{k.lower()}-work": f"This work is licensed under a Creative Commons {v} 4.0 International License" for k, v in CC.items()}


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


#: Holes in known sentences, of normalised text: what may stand for a holder, program or organisation, and the wording that then is looked up.
#: The wordings are fixed values; a sentence that is known as it stands is not looked at for holes.
HOLE = "[a-z0-9][a-z0-9 ]{0,160}"
HOLES: tuple[tuple[str, str], ...] = (
    (f"^neither the names? of {HOLE} nor the names? of (?:its|their|any|other|the) contributors may be used", "neither the name of the copyright holder nor the names of its contributors may be used"),
    (f"^neither {HOLE} nor the names of its contributors may be used", "neither the name of the copyright holder nor the names of its contributors may be used"),
    (f"^the names? of {HOLE} may not be used to endorse", "the name of the author may not be used to endorse"),
    ("derived from this software without (?:specific )?prior written (?:permission|consent)(?: from| of)?.*$", "derived from this software without specific prior written permission"),
    (f"^this software is provided by {HOLE} as is and any express or implied", "this software is provided by the copyright holders and contributors as is and any express or implied"),
    (f"this product includes software developed by {HOLE}$", "this product includes software developed by the university of california berkeley and its contributors"),
    (f"^except as contained in this notice the names? of {HOLE} shall not be used in advertising (.*) authorization from {HOLE}$", "except as contained in this notice the name of the holder shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization from the holder"),
    (f"^{HOLE} is free software you can redistribute it and or modify (?:it|them) under the terms of the gnu", "this program is free software you can redistribute it and or modify it under the terms of the gnu"),
    (f"^{HOLE} (?:is|are) distributed in the hope that (?:it|they) will be useful", "this program is distributed in the hope that it will be useful"),
    ("permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation .*$",
     "permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation"),
)
#: An item of a list that is no known sentence. It counts where it follows a clause of a list of conditions, which then is not the known licence.
UNKNOWN_ITEM, LISTED = "clause-unknown", "bsd-"
#: Stands before items of lists until sentences are cut.
ITEM_MARK = "\x1e"


def filled(sentence: str) -> str:
    """A normalised sentence with its holes filled as the known one has them."""
    for pattern, wording in HOLES:
        sentence = re.sub(pattern, wording, sentence)
    return sentence


KNOWN = {normal(said): key for key, said in SENTENCES.items()}

NAMES = (("bsd-names",), ("bsd-names-university",), ("bsd-names-author",))
BSD = tuple(("bsd-grant", "bsd-source", "bsd-binary", *more) for more in (*(("bsd-credit", *n) for n in (*NAMES, ())), *NAMES, ()))

LONG: tuple[tuple[str, tuple[str, ...]], ...] = (
    *(("Apache-2.0", ("apache2-notice-file", copy, "apache2-as-is", "apache2-see")) for copy in ("apache2-copy", "apache2-copy-https", "apache2-copy-at")),
    ("Apache-2.0", ("apache2-title", "apache2-terms")),
    *(("unknown-conditions", (*ids, UNKNOWN_ITEM)) for ids in BSD),
    *(("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-credit", *names)) for names in (*NAMES, ())),
    *(("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", *names)) for names in NAMES),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    *(("X11", (*title, "mit-grant", keep, "mit-as-is", "mit-liable", "x11-names")) for title in (("mit-title",), ()) for keep in ("mit-keep", "mit-keep-paragraph")),
    *(("MIT", ("mit-title", "mit-grant", keep, "mit-as-is", "mit-liable")) for keep in ("mit-keep", "mit-keep-paragraph")),
    *(("MIT", ("mit-grant", keep, "mit-as-is", "mit-liable")) for keep in ("mit-keep", "mit-keep-paragraph")),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("ISC", ("isc-grant-and", "isc-as-is")),
    ("HPND-sell-variant", ("hpnd-sell-grant",)),
    *(("WTFPL", (*title, "wtfpl-terms", "wtfpl-do")) for title in (("wtfpl-title-version",), ("wtfpl-title",), ())),
    ("MPL-2.0", ("mpl-notice", "mpl2-copy")),
    ("MPL-2.0", ("mpl-notice", "mpl2-copy-http")),
    ("Unlicense", ("unlicense-free", "unlicense-anyone")),
    ("Zlib", ("zlib-as-is", "zlib-liable", "zlib-grant")),
)
#: Ordered rules: licence, then the identifiers that must follow each other among a text's known sentences. Long rules come first, and with a
#: reservation of rights before them, which the licence then grants.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    *((name, ("all-rights-reserved", *ids)) for name, ids in LONG),
    *LONG,
    *GNU_RULES,
    ("MIT", ("mit-title", "mit-grant")),
    ("MIT", ("mit-grant",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-grant-and",)),
    ("Apache-2.0", ("apache2-notice-file",)),
    ("Apache-2.0", ("apache2-notice",)),
    ("Apache-2.0", ("apache2-title",)),
    ("MPL-2.0", ("mpl2-title",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("EPL-2.0", ("epl2-notice-http",)),
    ("EPL-2.0", ("epl2-title",)),
    ("BSL-1.0", ("bsl1-title",)),
    ("BSL-1.0", ("bsl1-notice",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-2.0", ("gpl2-notice",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-licensed",)),
    ("MIT", ("mit-title",)),
    ("CC-BY-4.0", ("cc-by-4-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    *(("WTFPL", (x,)) for x in ("wtfpl-title-version", "wtfpl-title", "wtfpl-do")),
    *((x, (f"spdx-{x.lower()}",)) for x in SPDX),
    *((x, (f"{x.lower()}-work",)) for x in CC),
    ("proprietary", ("all-rights-reserved",)),
)

#: Every known sentence holds one of these; texts without any are not cut at all.
HINTS = ("licen", "software", "rights", "permi", "redistribut", "warrant", "liab", "terms and", "mpl", "fuck you want", "endorse", "useful")
#: Comment marks before and after a line's words; marks of a list's items.
LEADER, TRAILER = r"^[ \t]*(?:(?:/[/*]+|[*#;%>|]+|--+|<!--)[ \t]+)*[ \t]*", r"[ \t]*(?:\*+/|-->)?[ \t]*\z"
ITEM = r"^(?:\(?(?:[0-9]{1,2}|[A-Za-z])[.)]|[-•])[ \t]+"
#: A list that goes on in a line of running text.
INLINE_ITEM = r":[ \t\n]+\(?[0-9]{1,2}[.)][ \t\n]+"
#: Where a sentence ends: a mark before white space or the end, or an empty line.
SENTENCE_END = r"""[.!?]+["')\]]*(?:[ \t\n]+|\z)|\n[ \t]*\n[ \t\n]*"""
#: Marks that end no sentence: of a company before a small letter, of a person's middle initial.
NO_END = ((r"\b(Inc|Ltd|Co|Corp|LLC)\.([ \t\n]+[a-z])"), (r"([A-Z][a-z]+ [A-Z])\.([ \t\n]+[A-Z][a-z])"))
#: A line that goes on with what stands before it.
GOES_ON = "^[a-z(]"


def normal_column(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def sentences_of(text: Column) -> Column:
    """The sentences of a text whose lines may be wrapped, commented or listed.

    Comment marks go; a line goes on in the next one unless a sentence ends, an
    empty line follows or the next is an item of a list. A line that is a known
    sentence by itself stands for itself, unless the next one goes on in small
    letters or a bracket.
    """
    known = F.create_map(*(F.lit(x) for pair in KNOWN.items() for x in pair))
    bare = lambda x: F.regexp_replace(F.regexp_replace(F.concat(x, F.lit(" ")), LEADER, ""), TRAILER, "")
    lines = F.transform(F.split(text, r"\r?\n"), bare)

    def joined(lines: Column) -> Column:
        def part(x: Column, i: Column) -> Column:
            after = F.coalesce(F.get(lines, i + 1), F.lit(""))
            alone = known[normal_column(x)].isNotNull() & (~after.rlike(GOES_ON) | F.lower(x).startswith("spdx"))
            return F.when(alone, F.concat(F.lit("\n\n"), x, F.lit("\n\n"))).when(x.rlike(ITEM), F.concat(F.lit(f"\n\n{ITEM_MARK}"), F.regexp_replace(x, ITEM, ""))).otherwise(F.concat(F.lit("\n"), x))

        return F.array_join(F.transform(lines, part), "")

    # A transform over one element holds the lines, so that they are made once.
    whole = F.get(F.transform(F.array(lines), joined), F.lit(0))
    whole = F.regexp_replace(whole, INLINE_ITEM, f":\n\n{ITEM_MARK}")
    for pattern in NO_END:
        whole = F.regexp_replace(whole, pattern, "$1$2")
    return F.split(whole, SENTENCE_END)


def known_sentences(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = F.create_map(*(F.lit(x) for pair in KNOWN.items() for x in pair))
    low = F.lower(text)
    some = F.lit(False)
    for hint in HINTS:
        some = some | F.contains(low, F.lit(hint))

    def of(s: Column) -> Column:
        filled = normal_column(s)
        for pattern, wording in HOLES:
            filled = F.regexp_replace(filled, pattern, wording)
        return F.coalesce(known[normal_column(s)], known[filled], F.when(s.startswith(ITEM_MARK), UNKNOWN_ITEM))

    found = F.filter(F.transform(sentences_of(text), of), lambda k: k.isNotNull())
    # A transform over one element holds the identifiers, so that they are found once.
    after = lambda ids: F.filter(ids, lambda k, i: (k != UNKNOWN_ITEM) | F.coalesce(F.get(ids, i - 1).startswith(LISTED), F.lit(False)))
    found = F.get(F.transform(F.array(found), after), F.lit(0))
    return F.when(some, found).otherwise(F.array().cast("array<string>"))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its known licence sentences and the licences they amount to.

    A text is cut into sentences (``sentences_of``), each reduced to lower-case
    words of letters and digits and looked up among the known ones, if need be
    with the names in its holes (holder, program, organisation) replaced by those of the known
    sentence. An item of a list that is unknown and follows a clause of a list of conditions counts as
    ``clause-unknown``: such a list is ``unknown-conditions``, not the licence that it begins like. The
    identifiers found, in order, are matched against the rules, each of which
    wants its identifiers next to each other. Rules are tried in order; what a
    rule matched is taken out before the next is tried, so that parts of a long
    licence do not count again. ``licences`` has the distinct licences in rule
    order, ``licence`` the first (null if there is none). Null and empty texts
    have none; texts may be of any length; repeated rows count each for itself;
    other columns of ``docs``, whatever their names, are not touched; an empty
    table gives no rows.

    It is one projection over the scan, without a shuffle; rules and sentences
    are constants of the expression, and only texts that hold a word of some
    known sentence are cut.
    """
    rules = F.array(*(F.struct(F.lit(name).alias("name"), F.lit("".join(f" {x} " for x in wanted)).alias("pattern")) for name, wanted in RULES))
    rows = docs.select(docs[id_col].alias(id_col), known_sentences(text_of(docs, text_col)).alias("_ids"))
    start = F.struct(F.concat(F.lit(" "), F.array_join("_ids", "  "), F.lit(" ")).alias("left"), F.array().cast("array<string>").alias("found"))
    tried = F.aggregate(rules, start, lambda acc, r: F.when(F.contains(acc["left"], r["pattern"]), F.struct(
        F.replace(acc["left"], r["pattern"], F.lit(" | ")).alias("left"), F.array_union(acc["found"], F.array(r["name"])).alias("found"),
    )).otherwise(acc), lambda acc: acc["found"])
    out = rows.select(id_col, "_ids", F.when(F.size("_ids") > 0, tried).otherwise(F.array().cast("array<string>")).alias("_found"))
    return out.select(
        F.col(id_col),
        F.size("_ids").cast("long").alias("n_sentences"),
        F.array_join("_ids", ",").alias("sentence_ids"),
        F.array_join("_found", ",").alias("licences"),
        F.get("_found", F.lit(0)).alias("licence"),
    )


def oracle_sql() -> str:
    """The same scan of ``documents`` as DuckDB SQL, by joins and windows over lines."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in KNOWN.items())
    plain = lambda x: f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"
    cut = f"regexp_replace(t, {quote(INLINE_ITEM)}, ':' || repeat(chr(10), 2) || chr(30), 'g')"
    for pattern in NO_END:
        cut = f"regexp_replace({cut}, {quote(pattern)}, '\\1\\2', 'g')"
    full = "p"
    for pattern, wording in HOLES:
        full = f"regexp_replace({full}, {quote(pattern)}, {quote(wording)}, 'g')"
    steps = ""
    for i, (name, wanted) in enumerate(RULES):
        pattern = quote("".join(f" {x} " for x in wanted))
        steps += f""", r{i + 1} as (
            select row, doc_id, n, ids, replace(l, {pattern}, ' | ') l,
                   case when contains(l, {pattern}) and not contains(',' || f || ',', {quote(f",{name},")}) then concat_ws(',', nullif(f, ''), {quote(name)}) else f end f
            from r{i})"""
    return f"""
        with known(s, id) as (values {known}), d as (
            select row_number() over () as row, doc_id, coalesce(text, '') t from documents
        ), lines as (
            select row, unnest(range(len(a))) i, unnest(a) x from (select row, regexp_split_to_array(t, '\\r?\\n') a from d)
        ), bare as (
            select row, i, regexp_replace(regexp_replace(x || ' ', {quote(LEADER)}, ''), {quote(TRAILER)}, '') x from lines
        ), told as (
            select row, i, x, id, lead(x, 1, '') over (partition by row order by i) nx from bare left join known on known.s = {plain("x")}
        ), whole as (
            select row, string_agg(case when id is not null and (not regexp_matches(nx, '{GOES_ON}') or starts_with(lower(x), 'spdx')) then repeat(chr(10), 2) || x || repeat(chr(10), 2)
                when regexp_matches(x, {quote(ITEM)}) then repeat(chr(10), 2) || chr(30) || regexp_replace(x, {quote(ITEM)}, '') else chr(10) || x end, '' order by i) t from told group by row
        ), cut as (
            select row, unnest(a) s, unnest(range(len(a))) i
            from (select row, regexp_split_to_array({cut}, {quote(SENTENCE_END)}) a from whole)
        ), tried as (
            select row, i, starts_with(s, chr(30)) item, {plain("cut.s")} p from cut
        ), full_ as (
            select row, i, item, p, {full} f from tried
        ), named as (
            select row, i, coalesce(a.id, b.id, case when item then '{UNKNOWN_ITEM}' end) id from full_ left join known a on a.s = p left join known b on b.s = f
        ), kept as (
            select row, i, id, lag(id, 1, '') over (partition by row order by i) before from named where id is not null
        ), found as (
            select row, count(*) n, string_agg(id, ',' order by i) ids from kept where id <> '{UNKNOWN_ITEM}' or starts_with(before, '{LISTED}') group by 1
        ), r0 as (
            select row, doc_id, coalesce(n, 0) n, coalesce(ids, '') ids, ' ' || replace(coalesce(ids, ''), ',', '  ') || ' ' l, '' f from d left join found using (row)
        ){steps}
        select doc_id, n::bigint n_sentences, ids sentence_ids, f licences, nullif(string_split(f, ',')[1], '') licence from r{len(RULES)}
    """
