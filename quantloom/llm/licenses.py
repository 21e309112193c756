"""Licence recognition by sentences and rules, with DataFrame functions alone.

A text is cut into sentences, a sentence is normalised (lower case, runs of other characters than
letters a-z and digits as one space) and looked up among known licence sentences. What is left of a
document is a sequence of identifiers. A licence rule is an ordered list of identifiers; it applies
where they stand one after another in that sequence, unknown sentences between them set aside.

A sentence may be wrapped over lines, with comment marks before them: it ends at end punctuation or a
line without a letter or digit, and a line with a copyright year or mark stands alone. A sentence unknown
as a whole is looked up line by line. The colon of an SPDX tag ends no sentence. ``n_sentences`` counts pieces between line ends and end punctuation.

Nulls: a null or empty text has no sentences. Rows are independent, so that repeated rows, ties and columns
of other names change nothing (those with the names of added ones give way). Work on a text is in proportion to its length. An empty table gives an
empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Sentences as licences state them.
SENTENCES = {
    "apache2-line": "Licensed under the Apache License, Version 2.0.",
    "apache2-header": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache2-may-not": "you may not use this file except in compliance with the License",
    "apache2-copy": "You may obtain a copy of the License at",
    "apache2-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache2-see": "See the License for the specific language governing permissions and limitations under the License",
    "mit-line": "Released under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software",
    "gpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-nc4-line": "Licensed under CC BY-NC 4.0.",
    "cc-by4-line": "Licensed under CC BY 4.0.",
    "cc0-line": "To the extent possible under law, the author has dedicated all copyright to the public domain.",
    "apache2-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "apache2-terms": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "gnu-verbatim": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed",
    "lib-free": "This library is free software",
    "lib-warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "lgpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "lgpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gnu-version2": "either version 2 of the License, or (at your option) any later version",
    "gnu-version21": "either version 2.1 of the License, or (at your option) any later version",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "mpl2-contributor": "\"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software",
    "mpl2-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "unlicense-free": "This is free and unencumbered software released into the public domain",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "epl2-title": "Eclipse Public License - v 2.0",
    "epl2-provided": "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\")",
    "epl2-available": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "bsl1-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "bsl1-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
    "bsl1-line": "Distributed under the Boost Software License, Version 1.0.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
}
# Identifier of a licence's short form, the licence, and its names in running text.
NAMED = [
    ("gpl2", "GPL-2.0", ["GNU General Public License, version 2", "GNU General Public License v2.0"]),
    ("lgpl21", "LGPL-2.1", ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1"]),
    ("lgpl3", "LGPL-3.0", ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0"]),
    ("agpl3", "AGPL-3.0", ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0"]),
    ("mpl2", "MPL-2.0", ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"]),
    ("isc", "ISC", ["ISC License"]),
    ("unlicense", "Unlicense", ["Unlicense"]),
    ("epl2", "EPL-2.0", ["Eclipse Public License, Version 2.0", "Eclipse Public License 2.0"]),
    ("bsl1", "BSL-1.0", ["Boost Software License, Version 1.0", "Boost Software License 1.0"]),
    ("zlib", "Zlib", ["zlib License"]),
    ("bsd2", "BSD-2-Clause", ["BSD 2-Clause License"]),
    ("bsd3", "BSD-3-Clause", ["BSD 3-Clause License"]),
]
FORMS = ["Licensed under the {}", "Released under the {}", "Distributed under the {}", "This project is licensed under the {}", "This project is licensed under the terms of the {}", "This work is licensed under the {}"]
# Licences that a tag may name: what follows "SPDX-License-Identifier:".
TAGS = ["Apache-2.0", "MIT", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later"]
TAGS += ["MPL-2.0", "ISC", "0BSD", "Unlicense", "EPL-2.0", "BSL-1.0", "Zlib", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-NC-4.0", "CC-BY-4.0", "CC0-1.0"]
# Other ways to state the same.
VARIANTS = [
    ("apache2-line", "Licensed under the Apache License 2.0"),
    ("apache2-line", "This project is licensed under the Apache License, Version 2.0"),
    ("apache2-line", "This project is licensed under the Apache License 2.0"),
    ("mit-line", "Licensed under the MIT License"),
    ("mit-line", "This project is licensed under the MIT License"),
    ("mit-line", "This project is licensed under the terms of the MIT License"),
    ("mit-line", "Distributed under the MIT License"),
    ("gpl3-line", "Licensed under the GNU General Public License, version 3"),
    ("gpl3-line", "Licensed under the GNU General Public License v3.0"),
    ("gpl3-line", "This project is licensed under the GNU General Public License v3.0"),
    ("bsd-names", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission of the copyright holder"),
    ("cc-by-nc4-line", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by4-line", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by4-line", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("cc0-line", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("mpl2-copy", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("epl2-available", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("gpl-free", "This file is free software"),
    ("gnu-verbatim", "Everyone is permitted to copy and distribute verbatim copies"),
    ("zlib-as-is", "This software is provided 'as-is', without any express or implied warranties"),
]
VARIANTS += [(f"{k}-line", form.format(name)) for k, _, names in NAMED for name in names for form in FORMS if f"{k}-line" not in SENTENCES or form.format(name) + "." != SENTENCES[f"{k}-line"]]
VARIANTS += [(f"{tag.lower()}-tag", f"SPDX-License-Identifier {tag}") for tag in TAGS]
# (rule, licence, identifiers in their order)
RULES = [
    ("apache2-short", "Apache-2.0", ["apache2-line"]),
    ("apache2-notice", "Apache-2.0", ["apache2-header", "apache2-may-not", "apache2-copy", "apache2-as-is", "apache2-see"]),
    ("mit-short", "MIT", ["mit-line"]),
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("gpl3-short", "GPL-3.0", ["gpl3-line"]),
    ("gpl3-notice", "GPL-3.0", ["gpl-free", "gpl3-redistribute", "gpl-warranty"]),
    ("bsd3-text", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("bsd2-text", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("cc-by-nc4-short", "CC-BY-NC-4.0", ["cc-by-nc4-line"]),
    ("cc-by4-short", "CC-BY-4.0", ["cc-by4-line"]),
    ("cc0-short", "CC0-1.0", ["cc0-line"]),
    ("apache2-full", "Apache-2.0", ["apache2-title", "apache2-terms"]),
    ("gpl2-full", "GPL-2.0", ["gpl2-title", "gnu-verbatim"]),
    ("gpl3-full", "GPL-3.0", ["gpl3-title", "gnu-verbatim"]),
    ("lgpl21-full", "LGPL-2.1", ["lgpl21-title", "gnu-verbatim"]),
    ("lgpl3-full", "LGPL-3.0", ["lgpl3-title", "gnu-verbatim"]),
    ("agpl3-full", "AGPL-3.0", ["agpl3-title", "gnu-verbatim"]),
    ("gpl2-notice", "GPL-2.0", ["gpl-free", "gpl-redistribute", "gnu-version2", "gpl-warranty"]),
    ("lgpl21-notice", "LGPL-2.1", ["lib-free", "lgpl-redistribute", "gnu-version21", "lib-warranty"]),
    ("lgpl3-notice", "LGPL-3.0", ["gpl-free", "lgpl3-redistribute", "gpl-warranty"]),
    ("lgpl3-lib-notice", "LGPL-3.0", ["lib-free", "lgpl3-redistribute", "lib-warranty"]),
    ("agpl3-notice", "AGPL-3.0", ["gpl-free", "agpl3-redistribute", "gpl-warranty"]),
    ("mpl2-full", "MPL-2.0", ["mpl2-title", "mpl2-contributor"]),
    ("mpl2-notice", "MPL-2.0", ["mpl2-form", "mpl2-copy"]),
    ("isc-text", "ISC", ["isc-grant", "isc-as-is"]),
    ("0bsd-text", "0BSD", ["0bsd-grant", "isc-as-is"]),
    ("unlicense-text", "Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("epl2-full", "EPL-2.0", ["epl2-title", "epl2-provided"]),
    ("epl2-notice", "EPL-2.0", ["epl2-available"]),
    ("bsl1-full", "BSL-1.0", ["bsl1-title", "bsl1-grant"]),
    ("zlib-text", "Zlib", ["zlib-as-is", "zlib-liable", "zlib-grant"]),
]
RULES += [(f"{k}-short", licence, [f"{k}-line"]) for k, licence, _ in NAMED]
RULES += [(f"{tag.lower()}-tag", tag.removesuffix("-only").removesuffix("-or-later"), [f"{tag.lower()}-tag"]) for tag in TAGS]
# A sentence that is known has one of these in it (tested): texts without any are not cut up.
MARKS = ["licens", "permi", "redistribut", "warrant", "liable", "software", "domain", "reproduction", "mozilla", "compiled"]
TAG = "(?i)(spdx-license-identifier):[ \\t]*"
BREAK = "[.!?;:][ \\t-\\r]+|\\n"
WRAPPED_BREAK = "[.!?;:][ \\t-\\r]+|\\n[^\\p{L}\\p{N}\\n]*\\n"
OWNER = "(?im)^([^\\p{L}\\p{N}\\n]*copyright[ \\t]*(?:\\(c\\)|\u00a9|[0-9])[^\\n]*)\\n"


def normalise(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def known() -> dict[str, str]:
    """Normalised sentence or variant -> identifier; some two hundred entries, a constant of the program."""
    return {normalise(s): k for k, s in [*SENTENCES.items(), *VARIANTS]}


def recognise(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_sentences, ``sentence_ids`` (in order) and ``rules`` (those that apply, a rule within a longer one that applies left out)."""
    docs = docs.drop("n_sentences", "sentence_ids", "rules")
    spaced = lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    body = F.coalesce(F.col(text), F.lit(""))
    names = known()
    is_known = lambda s: s.isin(*names)
    pieces = F.split(F.regexp_replace(F.regexp_replace(body, TAG, "$1 "), OWNER, "$1\n\n"), WRAPPED_BREAK, -1)
    whole = F.transform(pieces, lambda p: F.struct(p.alias("p"), spaced(p).alias("s")))
    lines = lambda p: F.when(p.contains("\n"), F.transform(F.split(p, "\n", -1), spaced)).otherwise(F.array().cast("array<string>"))
    said = F.filter(F.flatten(F.transform(whole, lambda x: F.when(is_known(x["s"]), F.array(x["s"])).otherwise(lines(x["p"])))), is_known)
    ids = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    none = F.array().cast("array<string>")
    df = docs.withColumns({
        "n_sentences": F.size(F.filter(F.split(F.lower(body), BREAK, -1), lambda s: s.rlike("[a-z0-9]"))).cast("long"),
        "sentence_ids": F.when(F.lower(body).rlike("|".join(MARKS)), F.transform(said, lambda s: F.try_element_at(ids, s))).otherwise(none),
    })
    line = F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(","))
    within = lambda seq: f",{','.join(seq)},"
    longer = lambda seq: [within(other) for _, _, other in RULES if len(other) > len(seq) and within(seq) in within(other)]
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(within(seq)).alias("seq"), F.array(*map(F.lit, longer(seq))).cast("array<string>").alias("outer")) for name, _, seq in RULES])
    applies = F.filter(rules, lambda r: line.contains(r["seq"]) & ~F.exists(r["outer"], lambda o: line.contains(o)))
    return df.withColumn("rules", F.when(F.size("sentence_ids") > 0, F.transform(applies, lambda r: r["name"])).otherwise(none))


def licences(rules: Column) -> Column:
    names = F.create_map(*[F.lit(x) for name, licence, _ in RULES for x in (name, licence)])
    return F.array_sort(F.array_distinct(F.transform(rules, lambda r: names[r])))


def op9_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recognise(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        "n_sentences",
        F.size("sentence_ids").cast("long").alias("n_known"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("rules", ",").alias("rules"),
        F.array_join(licences(F.col("rules")), ",").alias("licences"),
        (F.size("rules") > 0).alias("licensed"),
    )


def _op9_sql() -> str:
    rules = ", ".join(f"({i}, '{name}', '{licence}', ',{','.join(seq)},')" for i, (name, licence, seq) in enumerate(RULES))
    entries = ", ".join(f"('{s}', '{k}')" for s, k in known().items())
    spaced = lambda x: f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"
    return rf"""
WITH rule(i, rule, licence, seq) AS (VALUES {rules}),
said(s, k) AS (VALUES {entries}),
cut AS (SELECT doc_id, len(list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '{BREAK}'), lambda x: {spaced("x")}), lambda x: x <> ''))::BIGINT AS n_sentences,
               regexp_split_to_array(regexp_replace(regexp_replace(coalesce(text, ''), '{TAG}', '\1 ', 'g'), '{OWNER}', '\1' || chr(10) || chr(10), 'g'), '{WRAPPED_BREAK}') AS sentences FROM documents),
sentence AS (SELECT doc_id, pos, sentences[pos] AS t, {spaced("sentences[pos]")} AS whole FROM cut, unnest(range(1, len(sentences) + 1)) u(pos)),
line AS (SELECT doc_id, pos, 0 AS part, whole AS s FROM sentence WHERE whole IN (SELECT s FROM said)
         UNION ALL SELECT doc_id, pos, part, {spaced("lines[part]")} FROM (SELECT doc_id, pos, string_split(t, chr(10)) AS lines FROM sentence WHERE whole NOT IN (SELECT s FROM said)) z, unnest(range(1, len(lines) + 1)) v(part)),
ids AS (SELECT doc_id, string_agg(k, ',' ORDER BY pos, part) AS ids, count(*) AS n FROM line JOIN said USING (s) GROUP BY doc_id),
hit AS (SELECT doc_id, i, rule, licence, seq FROM ids, rule WHERE contains(',' || ids || ',', seq)),
best AS (SELECT * FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit o WHERE o.doc_id = h.doc_id AND length(o.seq) > length(h.seq) AND contains(o.seq, h.seq))),
agg AS (SELECT doc_id, string_agg(rule, ',' ORDER BY i) AS rules, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM best GROUP BY doc_id)
SELECT cut.doc_id, n_sentences, coalesce(n, 0)::BIGINT AS n_known, coalesce(ids, '') AS sentence_ids,
       coalesce(rules, '') AS rules, coalesce(licences, '') AS licences, rules IS NOT NULL AS licensed
FROM cut LEFT JOIN ids USING (doc_id) LEFT JOIN agg USING (doc_id)
"""


OP9_SQL = _op9_sql()
