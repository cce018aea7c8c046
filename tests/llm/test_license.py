"""Licence sentences and rules, against SQL and a plain reading."""

from __future__ import annotations

import re

from terraloom.llm import license
from tests.compare import connect, differences
from tests.llm.conftest import SF_DIR

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


def plain(idents):
    """Rules in order; each takes the first of its identifiers in order, again and again."""
    left, found = list(idents), []
    for licence, wanted in license.RULES:
        while True:
            picked, at = [], 0
            for name in wanted:
                if name not in left[at:]:
                    break
                at = left.index(name, at) + 1
                picked.append(at - 1)
            if len(picked) < len(wanted):
                break
            left = [x for i, x in enumerate(left) if i not in picked]
            found.append(licence)
    return ",".join(dict.fromkeys(found))


def test_texts(make_docs, awkward):
    rows = [
        *awkward, (20, f"Some prose. {MIT}\nmore"), (21, GPL), (22, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (23, "not released under the MIT License today."), (24, MIT.split("\n\n")[1] + "\n" + MIT.split("\n\n")[0]),
        (25, "All rights reserved! Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.")]
    out = {(r.doc_id, r.idents): r for r in license.licences(make_docs(rows, True)).collect()}
    by = {r.doc_id: r for r in out.values()}
    assert by[20].licences == "MIT" and by[20].idents == "mit-grant mit-notice as-is"
    assert by[21].licences == "GPL-3.0-or-later" and by[22].licences == "MIT,CC-BY-NC-4.0" and by[23].licences == ""
    assert by[24].licences == "MIT" and by[24].n_licence_sentences == 2
    assert by[25].licences == "Apache-2.0,LicenseRef-reserved"
    assert by[1].licences == by[2].licences == by[7].idents == ""
    for r in out.values():
        assert r.licences == plain(r.idents.split())


def test_empty_table(make_docs):
    assert license.licences(make_docs([])).count() == 0


def test_against_sql(sf_docs):
    assert differences(license.licences(sf_docs), connect(SF_DIR), license.ORACLE) == []


def test_named_lines_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r.licences for r in license.licences(docs).collect()}
    lines = {k: re.findall(r"(?m)^Licensed under CC BY-NC 4\.0\.$", t or "") for k, t in texts.items()}
    assert any(lines.values()) and all("CC-BY-NC-4.0" in found[k] for k, v in lines.items() if v)


def test_marked_lines_and_more_licences(make_docs):
    gnu = ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by "
           "the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.")
    want = {
        "// Licensed under the Apache License, Version 2.0\n// More": "Apache-2.0",
        "/* Released under the MIT License. */": "MIT",
        "This project is licensed under the MIT License.": "MIT",
        "This project is not licensed under the MIT License.": "",
        "# SPDX-License-Identifier: MIT OR AGPL-3.0-or-later\nx = 1": "MIT,AGPL-3.0-or-later",
        "/* SPDX-License-Identifier: GPL-2.0+ */": "GPL-2.0-or-later",
        gnu: "LGPL-2.1-or-later",
        "".join(f" * {line}\n" for line in gnu.split("\n")): "LGPL-2.1-or-later",
        "This is free and unencumbered software released into the public domain.": "Unlicense",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.": "ISC",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "MPL-2.0",
        "This work is released under the CC0 1.0 Universal license.": "CC0-1.0",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
        "- Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
        "- Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.": "BSD-2-Clause",
    }
    bsd = next(t for t, found in want.items() if found == "BSD-2-Clause")
    want |= {
        bsd + "\n- Neither the name of the University of Somewhere nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.": "BSD-3-Clause",
        MIT.replace("copy of this software", "copy of\nthis software").replace('to deal in the Software', 'to deal in the\nSoftware').replace("copies of the Software,", "copies of the\n  Software,"): "MIT",
        "// SPDX-License-Identifier: BSL-1.0": "LicenseRef-unknown",
        "SPDX-License-Identifier: " + "MIT OR " * 2000 + "ISC": "MIT,ISC",
        "This project is licensed under the terms of the MIT license and the Apache License, Version 2.0.": "MIT,Apache-2.0",
        "Licensed under either of Apache License, Version 2.0 or MIT license.": "MIT,Apache-2.0",
        "This work is licensed under the GNU General Public License version 2 or later.": "GPL-2.0-or-later",
    }
    out = {r.doc_id: r.licences for r in license.licences(make_docs(list(enumerate(want)))).collect()}
    assert {t: out[i] for i, t in enumerate(want)} == want
