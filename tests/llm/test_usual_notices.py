"""The usual licences' notices and identifiers, as they stand in files and with words put in or left out."""

from tests.llm import shared
from tracelark.llm import licenses

NOTICES = [
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
             "and redistribute it freely, subject to the following restrictions:"),
    ("boost", "Distributed under the Boost Software License, Version 1.0."),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
              "accompanying documentation covered by this license (the \"Software\")"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("mit", "// SPDX-License-Identifier: MIT"),
    ("apache-2.0", "# SPDX-License-Identifier: Apache-2.0"),
    ("gpl-3", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl-2.1", "SPDX-License-Identifier: LGPL-2.1-only"),
]


def test_usual_notices(spark):
    rows = [(i, f"{shared.prose(i, 9)}\n{text}\n{shared.prose(i + 1, 9)}") for i, (_, text) in enumerate(NOTICES)]
    for r in licenses.scanned(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        assert NOTICES[r.doc_id][0] in r.labels.split(",") and r.score > 0.9
        assert ("mit" in r.labels.split(",")) == (NOTICES[r.doc_id][0] == "mit")


def test_words_put_in_or_left_out(spark):
    rows, expected = [], []
    for t in (t for t in licenses.TEMPLATES if t.mandatory):
        words = t.words
        fixed = {i + k for p in map(str.split, t.mandatory) for i in range(len(words)) if words[i : i + len(p)] == p for k in range(1, len(p))}
        for i in range(1, len(words)):
            if i in fixed:  # inside a phrase that must be whole
                continue
            for more in (1, 2):
                rows.append((len(rows), " ".join(["before", *words[:i], *["extra"] * more, *words[i:], "after"])))
                expected.append(t.label)
            if i + 1 not in fixed:  # nor its first word
                rows.append((len(rows), " ".join(["before", *words[:i], *words[i + 1 :], "after"])))
                expected.append(t.label)
    for r in licenses.scanned(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        assert expected[r.doc_id] in r.labels.split(","), rows[r.doc_id]
