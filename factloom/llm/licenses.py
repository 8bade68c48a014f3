"""Licence scans by sentence rules: known sentences become identifiers, whose sequences match ordered rules."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import text_of

# Sentences of public licence texts and notices, by identifier, as normalise() writes them.
SENTENCES = {
    "mit-line": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license", "this work is licensed under the mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "no-liability": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "apache-line": ["licensed under the apache license version 2 0", "this work is licensed under the apache license version 2 0", "released under the apache license version 2 0", "licensed under the apache license 2 0", "licensed under the apache license version 2 0 the license"],
    "apache-comply": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at https www apache org licenses license 2 0"],
    "apache-as-is": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "apache-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "gpl3-line": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3", "licensed under the gpl version 3"],
    "gpl2-line": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2", "released under the gnu general public license version 2"],
    "gpl3-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl2-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gpl-details": ["see the gnu general public license for more details"],
    "gpl-copy": ["you should have received a copy of the gnu general public license along with this program"],
    "lgpl-line": ["licensed under the gnu lesser general public license version 3", "this work is licensed under the gnu lesser general public license version 3"],
    "agpl-line": ["licensed under the gnu affero general public license version 3", "this work is licensed under the gnu affero general public license version 3"],
    "mpl-terms": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "mpl-copy": ["if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"],
    "mpl-line": ["licensed under the mozilla public license version 2 0", "released under the mozilla public license 2 0"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-name": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-as-is": ["this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"],
    "bsd-no-liability": ["in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services"],
    "bsd-damage": ["or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"],
    "bsd-line": ["released under the bsd license", "licensed under the bsd 3 clause license", "released under the bsd 3 clause license"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "isc-as-is": ["the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"],
    "isc-no-liability": ["in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"],
    "cc-by-line": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license", "released under cc by 4 0"],
    "cc-by-sa-line": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "released under cc by sa 4 0"],
    "cc-by-nc-line": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "released under cc by nc 4 0"],
    "cc-by-nd-line": ["licensed under cc by nd 4 0", "released under cc by nd 4 0"],
    "cc0-line": ["licensed under cc0 1 0", "released under cc0 1 0", "this work is licensed under cc0 1 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "proprietary": ["all rights reserved", "copyright all rights reserved"],
}

#: Rules: a licence's name and the identifiers that must follow one another among the known sentences.
RULES = [
    ("apache-2.0", ["apache-line", "apache-comply", "apache-copy", "apache-as-is", "apache-see"]),
    ("apache-2.0", ["apache-line", "apache-comply", "apache-copy"]),
    ("apache-2.0", ["apache-line"]),
    ("agpl-3.0", ["agpl-line"]),
    ("bsd-3-clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is", "bsd-no-liability", "bsd-damage"]),
    ("bsd-3-clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("bsd-2-clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-no-liability", "bsd-damage"]),
    ("bsd-2-clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("bsd", ["bsd-line"]),
    ("cc-by-4.0", ["cc-by-line"]),
    ("cc-by-nc-4.0", ["cc-by-nc-line"]),
    ("cc-by-nd-4.0", ["cc-by-nd-line"]),
    ("cc-by-sa-4.0", ["cc-by-sa-line"]),
    ("cc0-1.0", ["cc0-line"]),
    ("gpl-2.0", ["gpl2-line"]),
    ("gpl-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-details", "gpl-copy"]),
    ("gpl-2.0-or-later", ["gpl2-free"]),
    ("gpl-3.0", ["gpl3-line"]),
    ("gpl-3.0-or-later", ["gpl3-free", "gpl-hope", "gpl-details", "gpl-copy"]),
    ("gpl-3.0-or-later", ["gpl3-free"]),
    ("isc", ["isc-grant", "isc-as-is", "isc-no-liability"]),
    ("isc", ["isc-grant"]),
    ("lgpl-3.0", ["lgpl-line"]),
    ("mit", ["mit-line", "mit-grant", "mit-notice", "as-is", "no-liability"]),
    ("mit", ["mit-grant", "mit-notice", "as-is", "no-liability"]),
    ("mit", ["mit-grant", "mit-notice"]),
    ("mit", ["mit-line"]),
    ("mpl-2.0", ["mpl-terms", "mpl-copy"]),
    ("mpl-2.0", ["mpl-line"]),
    ("proprietary", ["proprietary"]),
    ("unlicense", ["unlicense"]),
]

#: Every known sentence holds one of these, so a text without them has none. They meet lower-cased raw texts, where any
#: run of other signs may stand for a sentence's space.
ANCHORS = "licen[sc]e|in no event shall|theory of liability|copyright|permission|warrant|redistribution|free software|rights reserved|unencumbered|gnu general|cc by|cc0|mpl".replace(" ", "[^a-z0-9]+")
#: Each match of ANCHORS holds one of these as it is; plain search for them spares most texts the pattern.
SIGNS = ("licen", "copyright", "permission", "warrant", "redistribution", "software", "reserved", "unencumbered", "gnu", "event", "liability", "cc", "mpl")
#: A sentence ends at a stop before white space or the text's end. A line's end ends one too, or else
#: is white space but for an empty line.
STOP = r"[.!?;:]+(?:[ \t\n\x0B\f\r]+|\z)"
LINE = r"[\r\n]+"
BLANK = r"\r?\n[ \t]*\r?\n[ \t\r\n]*"


def _known() -> dict[str, str]:
    return {sentence: name for name, written in SENTENCES.items() for sentence in written}


def _pattern() -> str:
    """The rules over a document's identifiers, each written <name>; the longer of two that begin alike comes first."""
    return "|".join("".join(f"<{name}>" for name in names) for _, names in sorted(RULES, key=lambda r: (-len(r[1]), r[1])))


def _licences() -> dict[str, str]:
    return {"".join(f"<{name}>" for name in names): licence for licence, names in RULES}


def normalise(text: Column, lines_end: bool) -> Column:
    """The sentences of a text (array): lower case, runs of anything but a-z and 0-9 as one space, trimmed."""
    ended = F.regexp_replace(F.lower(text), f"{LINE}|{STOP}" if lines_end else f"{BLANK}|{STOP}", "\x01")
    parts = F.split(F.regexp_replace(ended, "[^a-z0-9\x01]+", " "), "\x01")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


def identifiers(text: Column, lines_end: bool) -> Column:
    """The identifiers of the known sentences, in order, as one string of <name> parts."""
    known = _known()
    found = F.filter(normalise(text, lines_end), lambda s: s.isin(list(known)))
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.concat_ws("", F.transform(found, lambda s: F.concat(F.lit("<"), F.element_at(table, s), F.lit(">"))))


def scan(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """keep, then sentences (identifiers by line and stop), wrapped (the same with line ends as spaces) and licences.

    licences: the distinct names of all rules that match either sequence from left to right, the longest at each
    place, sorted. Texts are read whole, in one pass without a shuffle; null and empty texts have none. Columns of keep
    with the results' names are left out.
    """
    keep = [c for c in keep if c not in ("sentences", "wrapped", "licences")]
    held = df.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], text_of(f"`{text}`").alias("_text"), F.lower(text_of(f"`{text}`")).alias("_lower"))
    signs = reduce(or_, [F.contains("_lower", F.lit(s)) for s in SIGNS])
    maybe = F.when(signs & F.col("_lower").rlike(ANCHORS), F.col("_text")).otherwise(F.lit(""))
    names = F.create_map(*[F.lit(x) for pair in _licences().items() for x in pair])

    def matched(column: str) -> Column:
        return F.transform(F.regexp_extract_all(column, F.lit(f"({_pattern()})"), F.lit(1)), lambda m: F.element_at(names, m))

    rows = held.select(*[f"_k{i}" for i in range(len(keep))], identifiers(maybe, True).alias("sentences"), identifiers(maybe, False).alias("wrapped"))
    return rows.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "sentences", "wrapped", F.array_sort(F.array_distinct(F.concat(matched("sentences"), matched("wrapped")))).alias("licences"))


def op10_sentence_rules(documents: DataFrame) -> DataFrame:
    """Per row, repeated rows and null ids included: doc_id, sentences and wrapped (identifiers in order), n_licences and
    licences (joined by commas); empty strings and 0 for null and empty texts."""
    found = scan(documents, "text", ["doc_id"])
    return found.select("doc_id", "sentences", "wrapped", F.size("licences").alias("n_licences"), F.concat_ws(",", "licences").alias("licences"))


def oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known, licences = _known(), _licences()
    table = lambda d: f"MAP {{{', '.join(f'{quoted(k)}: {quoted(v)}' for k, v in d.items())}}}"

    def sequence(ends: str) -> str:
        parts = f"string_split(regexp_replace(regexp_replace(t, {quoted(ends)}, chr(1), 'g'), '[^a-z0-9\\x01]+', ' ', 'g'), chr(1))"
        return f"array_to_string(list_transform(list_filter(list_transform({parts}, lambda x: trim(x)), lambda x: map_contains(known, x)), lambda x: '<' || known[x] || '>'), '')"

    matched = lambda c: f"list_transform(regexp_extract_all({c}, {quoted(_pattern())}), lambda x: rules[x])"
    return f"""
WITH lowered AS (SELECT doc_id, lower(coalesce(text, '')) AS t, {table(known)} AS known, {table(licences)} AS rules FROM documents),
found AS (SELECT doc_id, {sequence(f'{LINE}|{STOP}')} AS sentences, {sequence(f'{BLANK}|{STOP}')} AS wrapped, rules FROM lowered),
named AS (SELECT doc_id, sentences, wrapped, list_sort(list_distinct(list_concat({matched('sentences')}, {matched('wrapped')}))) AS l FROM found)
SELECT doc_id, sentences, wrapped, CAST(len(l) AS INTEGER) AS n_licences, array_to_string(l, ',') AS licences FROM named"""
