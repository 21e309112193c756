"""Licences as their texts stand in files: wrapped, commented, whole texts' first lines, tags."""

import duckdb
import pyarrow as pa

from quantloom.llm import licenses

TEXTS = {
    "mpl2-notice": """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
int main() {}""",
    "mpl2-full": """Mozilla Public License Version 2.0
==================================

1. Definitions
--------------

1.1. "Contributor"
    means each individual or legal entity that creates, contributes to
    the creation of, or owns Covered Software.

1.2. "Contributor Version"
    means the combination of the Contributions of others""",
    "gpl2-notice": """# Copyright (C) 2011 Somebody
#
# This program is free software; you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version 2 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.""",
    "gpl2-full": """                    GNU GENERAL PUBLIC LICENSE
                       Version 2, June 1991

 Copyright (C) 1989, 1991 Free Software Foundation, Inc.,
 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble""",
    "gpl3-full": """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble""",
    "agpl3-full": """                    GNU AFFERO GENERAL PUBLIC LICENSE
                       Version 3, 19 November 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.
""",
    "lgpl21-notice": """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
 *
 * This library is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of""",
    "lgpl3-notice": """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU Lesser General Public License as published
// by the Free Software Foundation, either version 3 of the License, or
// (at your option) any later version.
//
// This program is distributed in the hope that it will be useful,
// but WITHOUT ANY WARRANTY; without even the implied warranty of""",
    "agpl3-notice": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU Affero General Public License as published
    by the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of""",
    "apache2-full": """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.""",
    "isc-text": """Copyright (c) 2015, Somebody

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE""",
    "0bsd-text": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT""",
    "unlicense-text": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.""",
    "epl2-notice": """ * This program and the accompanying materials are made
 * available under the terms of the Eclipse Public License 2.0
 * which is available at https://www.eclipse.org/legal/epl-2.0/
 *""",
    "epl2-full": """Eclipse Public License - v 2.0

    THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE
    PUBLIC LICENSE ("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION
    OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.""",
    "bsl1-full": """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:""",
    "bsl1-short": """//  Distributed under the Boost Software License, Version 1.0.
//  (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)""",
    "zlib-text": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
    "lgpl-2.1-or-later-tag": "/* SPDX-License-Identifier: LGPL-2.1-or-later */\n#include <x.h>",
    "bsd-2-clause-tag": "#!/bin/sh\n# spdx-license-identifier:BSD-2-Clause\necho",
    "mpl2-short": "Notes.\n\nThis project is licensed under the terms of the Mozilla Public License 2.0.",
    "bsd3-short": "Released under the BSD 3-Clause License",
}
CLEAN = ["The software licence was discussed. Permission was granted to no one; the warranty lapsed.", "MIT\nApache-2.0\nISC", "Mozilla and the public domain", "SPDX-License-Identifier: Unknown-1.0", "This program is free software. It is in the public domain.", "İ K ẞ"]


def test_texts_as_they_stand_in_files(spark):
    rows = [*enumerate(TEXTS.values()), *enumerate(CLEAN, len(TEXTS))]
    found = licenses.recognise(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r for r in found.withColumn("named", licenses.licences(found["rules"])).collect()}
    assert [(name, found[i].rules) for i, name in enumerate(TEXTS)] == [(name, [name]) for name in TEXTS]
    assert all(found[i].rules == [] for i in range(len(TEXTS), len(rows)))
    assert {n for r in found.values() for n in r.named} >= {"MPL-2.0", "GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "ISC", "0BSD", "Unlicense", "EPL-2.0", "BSL-1.0", "Zlib"}
    documents = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})  # noqa: F841  the SQL reads it
    sql = {r[0]: r[1:] for r in duckdb.connect().execute(f"SELECT doc_id, rules, sentence_ids, n_sentences FROM ({licenses.OP9_SQL})").fetchall()}
    assert sql == {i: (",".join(r.rules), ",".join(r.sentence_ids), r.n_sentences) for i, r in found.items()}


def test_every_rule_on_its_own_sentences(spark):
    """A rule's sentences in their order give the rule; in another order they don't. What is known has a mark, so that a text without marks has nothing known."""
    says = {k: s for s, k in reversed(licenses.known().items())}
    rows = [(i, "\n\n".join(says[k] for k in seq)) for i, (_, _, seq) in enumerate(licenses.RULES)]
    turned = [(1000 + i, "\n\n".join(says[k] for k in reversed(seq))) for i, (_, _, seq) in enumerate(licenses.RULES) if len(seq) > 1]
    got = {r.doc_id: r.rules for r in licenses.recognise(spark.createDataFrame(rows + turned, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == [[name] for name, _, _ in licenses.RULES]
    assert all(licenses.RULES[i - 1000][0] not in got[i] for i, _ in turned)
    assert all(any(m in s for m in licenses.MARKS) for s in licenses.known())
