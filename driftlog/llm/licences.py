"""Licence recognition by sentence rules, in DataFrame functions only.

A text is cut into sentences: at blank lines (or lines without a letter or
digit), around copyright notices, and after ``. ! ? ; :`` before a blank or
line end; a sentence may go on over several lines, as wrapped licences do.
Sentences that hold a critical word are normalised (lower case, every
run of other characters one blank) and mapped to the identifier of a known
licence sentence. One that is not known is read line by line, for licence
lines without a full stop among others; if no line is known either, it is one
``unknown``. Copyright notices are named, but stand outside the rules.
The row of identifiers is then matched
against licence rules in their order: a rule is a row of identifiers, and
where it occurs the row is replaced by the licence, so longer rules come
before rules that are parts of them, and what is left unmatched stays
visible.

One narrow pass over the table: no shuffle, no Python. Texts without a
critical word are never cut. Null and empty texts have no sentences. Every
input row gives one row; other columns of the input are never read.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of which every known sentence holds one.
CRITICAL = ("licens", "licenc", "warrant", "redistribut", "permission", "copyright", "liable", "public domain")

# Normalised sentence -> identifier.
SENTENCES = {
    "mit license": "mit-title",
    "the mit license": "mit-title",
    "the mit license mit": "mit-title",
    "released under the mit license": "mit-name",
    "licensed under the mit license": "mit-name",
    "this project is licensed under the mit license": "mit-name",
    "this file is mit licensed": "mit-name",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied": "mit-warranty",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
    "an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
    "other dealings in the software": "mit-liable",
    "isc license": "isc-title",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including "
    "all implied warranties of merchantability and fitness": "isc-warranty",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages "
    "whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other "
    "tortious action arising out of or in connection with the use or performance of this software": "isc-liable",
    "licensed under the apache license version 2 0": "apache-name",
    "licensed under the apache license version 2 0 the license": "apache-name",
    "you may not use this file except in compliance with the license": "apache-use",
    "you may obtain a copy of the license at": "apache-copy",
    "http www apache org licenses license 2 0": "apache-url",
    "https www apache org licenses license 2 0": "apache-url",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
    "on an as is basis without warranties or conditions of any kind either express or implied": "apache-warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "this work is licensed under the gnu general public license version 3": "gpl3-name",
    "licensed under the gnu general public license version 3": "gpl3-name",
    "this work is licensed under the gnu general public license version 2": "gpl2-name",
    "licensed under the gnu general public license version 2": "gpl2-name",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or at your option any later "
    "version": "gpl3-later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
    "free software foundation either version 3 of the license or at your option any later version": "gpl3-later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
    "free software foundation either version 2 of the license or at your option any later version": "gpl2-later",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-warranty",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-implied",
    "see the gnu general public license for more details": "gpl-see",
    "you should have received a copy of the gnu general public license along with this program": "gpl-copy",
    "if not see http www gnu org licenses": "gpl-url",
    "if not see https www gnu org licenses": "gpl-url",
    "licensed under cc by nc 4 0": "cc-by-nc-name",
    "licensed under cc by 4 0": "cc-by-name",
    "licensed under cc by sa 4 0": "cc-by-sa-name",
    "bsd 2 clause license": "bsd2-title",
    "bsd 3 clause license": "bsd3-title",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
    "disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd-names",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
    "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed": "bsd-warranty",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special "
    "exemplary or consequential damages including but not limited to procurement of substitute goods or "
    "services": "bsd-liable",
    "in no event shall the copyright owner or contributors be liable for any direct indirect incidental special "
    "exemplary or consequential damages including but not limited to procurement of substitute goods or "
    "services": "bsd-liable",
    "this work is dedicated to the public domain": "public-domain",
    "all rights reserved no licence is granted": "no-licence",
}

# Identifiers that licence tags in file headers name.
TAGS = ("MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later",
        "GPL-3.0-only", "GPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense")

# Licence rules in the order they are tried.
RULES = (
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-warranty", "mit-liable")),
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "mit-warranty", "mit-liable")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liable")),
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("ISC", ("isc-title", "isc-grant", "isc-warranty", "isc-liable")),
    ("ISC", ("isc-grant", "isc-warranty", "isc-liable")),
    ("Apache-2.0", ("apache-name", "apache-use", "apache-copy", "apache-url", "apache-warranty", "apache-see")),
    ("Apache-2.0", ("apache-name", "apache-use", "apache-copy", "apache-url", "apache-warranty")),
    ("Apache-2.0", ("apache-name", "apache-use", "apache-copy", "apache-warranty")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty", "gpl-implied", "gpl-see", "gpl-copy", "gpl-url")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty", "gpl-implied", "gpl-see", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty", "gpl-implied", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty", "gpl-implied", "gpl-see", "gpl-copy", "gpl-url")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty", "gpl-implied", "gpl-see", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty", "gpl-implied", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty")),
    ("BSD-3-Clause", ("bsd3-title", "bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty", "bsd-liable")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty", "bsd-liable")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd2-title", "bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liable")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liable")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache-name",)),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("GPL-3.0-only", ("gpl3-name",)),
    ("GPL-2.0-only", ("gpl2-name",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-name",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-name",)),
    ("CC-BY-4.0", ("cc-by-name",)),
    ("Public-Domain", ("public-domain",)),
    ("No-Licence", ("no-licence",)),
)
SENTENCES |= {"spdx license identifier " + re.sub("[^a-z0-9]+", " ", tag.lower()): f"tag-{tag}" for tag in TAGS}
RULES += tuple((tag, (f"tag-{tag}",)) for tag in TAGS)

UNKNOWN, NOTICE = "unknown", "copyright"
_CRITICAL = "|".join(CRITICAL)
_CRITICAL_RAW = _CRITICAL.replace(" ", "[^a-z0-9]+")      # before normalising
_NOTICE = "^copyright (c |[0-9])"
_CUT = chr(30)
#: (pattern, groups kept, with a cut before / between / after them), in both engines' common syntax
_CUTS = (
    ("(?i)(spdx-license-identifier):[ \\t]*", "1 "),                                     # a tag keeps its value
    ("(?i)(^|\\n)([^a-z0-9\\n]*copyright[ \\t]+(?:\\(c\\)|©|[0-9])[^\\n]*)", "1|2|"),  # a notice is a line
    ("\\n[^A-Za-z0-9]*\\n", "|"),                                                      # a blank line
    ("([.!?;:])[ \\t\\r\\n]+", "1|"),                                                  # the end of a sentence
)


def normalised(sentence: Column) -> Column:
    """Lower case, other characters than a-z and 0-9 one blank."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the critical sentences of a text, in order."""
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])

    def named(s: Column) -> Column:
        return F.coalesce(F.element_at(known, s), F.when(s.rlike(_NOTICE), F.lit(NOTICE)))

    def by_line(raw: Column) -> Column:
        """Where lines of their own were joined: the identifiers of the lines, if any is known."""
        lines = F.filter(F.transform(F.split(raw, "\n"), normalised), lambda s: s.rlike(_CRITICAL))
        ids = F.transform(lines, lambda s: F.coalesce(named(s), F.lit(UNKNOWN)))
        return F.when(F.exists(ids, lambda i: i != UNKNOWN), ids).otherwise(F.array(F.lit(UNKNOWN)))

    cut = text
    for pattern, kept in _CUTS:
        cut = F.regexp_replace(cut, pattern, re.sub("([12])", r"$\1", kept).replace("|", _CUT))
    said = F.transform(F.split(cut, _CUT), lambda x: F.struct(normalised(x).alias("s"), x.alias("raw")))
    said = F.filter(said, lambda x: x["s"].rlike(_CRITICAL))
    ids = F.flatten(F.transform(said, lambda x: F.when(named(x["s"]).isNotNull(), F.array(named(x["s"]))).otherwise(by_line(x["raw"]))))
    return F.when(F.lower(text).rlike(_CRITICAL_RAW), ids).otherwise(F.array().cast("array<string>"))


def matched(ids: Column) -> Column:
    """The row of identifiers as text, with the licences of matched rules in braces."""
    ids = F.array_remove(ids, NOTICE)      # a notice may stand anywhere in a licence
    row = F.concat(F.lit("<"), F.array_join(ids, "><"), F.lit(">"))
    row = F.when(F.size(ids) > 0, row).otherwise(F.lit(""))
    return reduce(lambda out, rule: F.replace(out, F.lit("".join(f"<{x}>" for x in rule[1])), F.lit("{" + rule[0] + "}")),
                  RULES, row)


def licence_scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_sentences, sentences, licences, n_unmatched`` of every row.

    ``sentences`` holds the identifiers, blank separated; ``licences`` the
    distinct licences in order of the text; ``n_unmatched`` counts
    identifiers that no rule took.
    """
    ids = docs.select(F.col(id_column), sentence_ids(F.col(text)).alias("_ids")).withColumn("_row", matched(F.col("_ids")))
    found = F.regexp_extract_all("_row", F.lit("\\{([^}]+)\\}"), F.lit(1))
    return ids.select(
        id_column, F.size("_ids").cast("bigint").alias("n_sentences"), F.array_join("_ids", " ").alias("sentences"),
        F.array_join(F.array_distinct(found), " ").alias("licences"),
        F.length(F.regexp_replace("_row", "[^<]", "")).cast("bigint").alias("n_unmatched"))


def licence_sql(table: str = "documents", id_column: str = "doc_id", text: str = "text") -> str:
    """DuckDB SQL for ``licence_scan``."""
    known = "MAP {" + ", ".join(f"'{s}': '{i}'" for s, i in SENTENCES.items()) + "}"
    row = "CASE WHEN len(ids) > 0 THEN '<' || array_to_string(ids, '><') || '>' ELSE '' END"
    for name, rule in RULES:
        row = f"replace({row}, '{''.join(f'<{x}>' for x in rule)}', '{{{name}}}')"
    cut = text
    for pattern, kept in _CUTS:
        kept = re.sub("([12])", r"\\\1", kept).replace("|", "' || chr(30) || '")
        cut = f"regexp_replace({cut}, '{pattern}', '{kept}', 'g')"

    def normal(x):
        return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"

    def named(x):
        return f"coalesce({known}[{x}], CASE WHEN regexp_matches({x}, '{_NOTICE}') THEN '{NOTICE}' END)"

    return f"""
    WITH cut AS (
      SELECT {id_column}, CASE WHEN {text} IS NULL OR NOT regexp_matches(lower({text}), '{_CRITICAL_RAW}')
        THEN [] ELSE string_split({cut}, chr(30)) END AS said
      FROM {table}),
    sentences AS (
      SELECT {id_column}, list_filter(list_transform(said, lambda x: {{'s': {normal("x")}, 'raw': x}}),
        lambda x: regexp_matches(x.s, '{_CRITICAL}')) AS said FROM cut),
    lines AS (
      SELECT {id_column}, list_transform(said, lambda x: {{'whole': {named("x.s")}, 'lines': list_transform(list_filter(
        list_transform(string_split(x.raw, chr(10)), lambda y: {normal("y")}), lambda y: regexp_matches(y, '{_CRITICAL}')),
        lambda y: coalesce({named("y")}, '{UNKNOWN}'))}}) AS said FROM sentences),
    named AS (
      SELECT {id_column}, coalesce(flatten(list_transform(said, lambda x: CASE WHEN x.whole IS NOT NULL THEN [x.whole]
        WHEN len(list_filter(x.lines, lambda y: y <> '{UNKNOWN}')) > 0 THEN x.lines ELSE ['{UNKNOWN}'] END)), [])::VARCHAR[] AS said
      FROM lines),
    ruled AS (SELECT {id_column}, said, list_filter(said, lambda x: x <> '{NOTICE}') AS ids FROM named),
    matched AS (SELECT *, {row} AS r FROM ruled),
    found AS (SELECT *, regexp_extract_all(r, '\\{{([^}}]+)\\}}', 1) AS f FROM matched)
    SELECT {id_column}, len(said)::BIGINT AS n_sentences, coalesce(array_to_string(said, ' '), '') AS sentences,
      coalesce(array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i), ' '), '') AS licences,
      length(regexp_replace(r, '[^<]', '', 'g'))::BIGINT AS n_unmatched
    FROM found"""
